from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from panelscope.llm import mixing as M


def test_targets_stop_at_two_epochs_and_reshare():
    sizes = {"b": 10, "a": 100, None: 100, "c": 100}
    got = M.source_targets(sizes)
    # a: weight 3, b: 1, c: 2, null: 3 again; b is full at 20
    assert got["b"] == 20.0
    rest = 1.5 * 310 - 20
    assert got["a"] == pytest.approx(min(200, rest * 3 / 8)) and got["c"] == pytest.approx(rest * 2 / 8)
    assert sum(got.values()) == pytest.approx(1.5 * 310)
    assert M.source_targets({}) == {}
    assert M.source_targets({"a": 0}) == {"a": 0.0}


def rows(n):
    for i in range(n):
        yield i, " ".join(["w"] * (1 + i % 37)), "hot" if i % 3 else ("s%d" % (i % 4) if i % 5 else None), "x"


def test_mix_meets_targets_and_reruns_agree(spark):
    docs = spark.createDataFrame(list(rows(3000)), "doc_id long, text string, source string, target string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 3000, 3)] + [(0, 1)], "doc_id long, quality int")
    a = sorted(map(tuple, M.mix_sources(docs, labels).drop("_text").collect()), key=str)
    b = sorted(map(tuple, M.mix_sources(docs.repartition(7), labels.repartition(3)).drop("_text").collect()), key=str)
    assert a == b and len(a) == 3000
    taken, target = defaultdict(int), {}
    for _, source, size, _, t, k in a:
        assert 0 <= k <= 2 * size and k % size == 0
        taken[source] += k
        target[source] = t
    assert all(abs(taken[s] - target[s]) <= 20 for s in target)


def test_better_documents_come_first(spark):
    docs = spark.createDataFrame([(i, "w w w w", "abc"[i // 500]) for i in range(1500)], "doc_id long, text string, source string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1500)], "doc_id long, quality int")
    out = M.mix_sources(docs, labels).groupBy("source", (F.col("doc_id") % 2).alias("good")).agg(F.avg("taken").alias("t")).collect()
    mean = {(r["source"], r["good"]): r["t"] for r in out}
    assert mean["b", 1] > 1.15 * mean["b", 0]


@pytest.mark.parametrize("shares", [(1.0, 0.0, 0.0), (0.3, 0.2, 0.5), (0.0, 0.0, 1.0)])
def test_buckets_are_even_whatever_the_qualities(spark, shares):
    rates = [0.25, 0.5, 1.0]
    quality = F.when(F.col("id") % 10 < round(10 * shares[0]), 0.25).when(F.col("id") % 10 < round(10 * (shares[0] + shares[1])), 0.5).otherwise(1.0)
    keys = spark.range(20_000).select(M.sample_key(quality, F.col("id")).alias("key"))
    rank = M.key_rank(F.col("key"), F.array(*map(F.lit, shares)), rates)
    got = keys.select("key", F.floor(rank * 20).alias("b")).groupBy("b").agg(F.count("*").alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi"))
    got = got.orderBy("b").collect()
    assert [r["b"] for r in got] == list(range(20)) and all(900 < r["n"] < 1100 for r in got)
    assert all(a["hi"] < b["lo"] for a, b in zip(got, got[1:]))


def test_running_sums_against_one_sorted_list(spark):
    docs = spark.createDataFrame(list(rows(2000)), "doc_id long, text string, source string, target string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 2000, 3)], "doc_id long, quality int")
    quality = {i: (1.0 if i % 2 else 0.25) if i % 3 == 0 else 0.5 for i in range(2000)}
    keyed = docs.select("doc_id", "source", F.size(F.split("text", " ")).alias("size"), *[
        M.sample_key(F.lit(q), F.col("doc_id"), F.md5("text"), seed=17).alias(f"k{q}".replace(".", "")) for q in (0.25, 0.5, 1.0)]).collect()
    sizes = defaultdict(int)
    for r in keyed:
        sizes[r["source"]] += r["size"]
    targets, want = M.source_targets(sizes), {}
    for s in sizes:
        before = 0
        for r in sorted((r for r in keyed if r["source"] == s), key=lambda r: r[f"k{quality[r['doc_id']]}".replace(".", "")]):
            whole = targets[s] // sizes[s]
            extra = before + r["size"] / 2 < targets[s] - whole * sizes[s]
            want[r["doc_id"]] = int(whole + extra) * r["size"]
            before += r["size"]
    assert {r["doc_id"]: r["taken"] for r in M.mix_sources(docs, labels).collect()} == want


def test_edges(spark):
    docs = spark.createDataFrame([(None, None, None), (1, "", "a"), (2, "x y", "a"), (2, "x y", "a"), (2, "z", "a")],
                                 "doc_id long, text string, source string")
    out = M.mix_sources(docs).collect()
    assert len(out) == 5 and all(r["taken"] <= 2 * r["size"] for r in out)
    assert {r["source_size"] for r in out} == {0, 5}
    assert M.mix_sources(docs.limit(0)).collect() == []
