from collections import Counter

from panelscope.llm import quality as Q


def figures(text):
    import re
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    twice = Counter(grams)
    hit = {i + j for i, g in enumerate(grams) if twice[g] > 1 for j in range(3)}
    return (len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"),
            len(lines), len(lines) - len(set(lines)), len(hit))


TEXTS = [None, "", " \n\t ", "one", "a b c a b c", "a a a a a", "x\ny\nx\n \nx", "# a | b <c>", "é ü ß 𝔸 b",
         " ".join(f"w{i % 7}" for i in range(500)), " ".join(f"w{i}" for i in range(40_000)), "a b\x0bc\x0cd\re"]


def test_base_figures(spark):
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r["doc_id"]: tuple(r[c] for c in Q.BASE_FIGURES) for r in Q.with_base(rows).collect()}
    assert [got[i] for i in range(len(TEXTS))] == [figures(t) for t in TEXTS]


def test_colliding_short_hashes_are_sorted_whole(spark):
    # windows whose hashes differ in the low bits alone: cutting makes them equal
    from pyspark.sql import functions as F

    d = spark.createDataFrame([(1, [5, 6, 7, 8, 5, 6, 7])], "id int, _hash array<bigint>")
    assert Q.repeat_words(d).first()["n_repeat_words"] == 6
    d = d.select("id", F.array(*[F.lit(i) for i in range(50)]).cast("array<bigint>").alias("_hash"))
    assert Q.repeat_words(d).first()["n_repeat_words"] == 0


def test_verdict_does_not_depend_on_the_order(spark):
    clean = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" for i in range(80)).replace("0", "")
    rows = [(1, clean), (2, clean.upper()), (3, clean + " #" * 30), (4, None), (1, clean), (5, "too short")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"], r["kept"]) for r in Q.judge(docs).collect())
    assert got == [(1, True), (1, True), (2, False), (3, False), (4, False), (5, False)]
    base = Q.with_base(docs)
    for rules in (Q.default_rules(), Q.default_rules()[::-1]):
        verdicts = base.select("doc_id", Q.cascade(rules).isNull().alias("ok")).collect()
        assert {r["doc_id"]: r["ok"] for r in verdicts}[3] is False


def test_order_by_rejection_per_cost(spark):
    from pyspark.sql import functions as F

    rows = Q.with_base(spark.createDataFrame([(i, "a b c") for i in range(50)], "doc_id long, text string"))
    rules = [Q.Rule("never", F.col("n_words") > 99), Q.Rule("always", F.col("n_words") > 0)]
    assert [r.name for r in Q.order_rules(rows, rules)] == ["always", "never"]


def test_clashing_and_empty(spark):
    docs = spark.createDataFrame([(1, "a b", "mine", "x")], "doc_id long, text string, kept string, n_words string")
    out = Q.judge(docs)
    assert out.columns == ["doc_id", "text", *Q.BASE_FIGURES, "base_failed", "kept"]
    assert out.first()["n_words"] == 2
    assert Q.judge(docs.limit(0)).collect() == []


def test_no_python_in_the_plan(spark, tmp_path):
    from panelscope.llm.queries import QUERIES

    spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    plan = QUERIES["op2_quality_rules"](spark, str(tmp_path))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
