"""The pipeline on planted cases, and against its operators run one by one in
plain Python."""

import random
from collections import Counter

import corpus_pipeline as C

rng = random.Random(12)
SYLLABLES = ["ka", "lo", "mi", "tu", "ren", "sol", "dor", "vin", "pe", "qua"]
word = lambda: "".join(rng.choice(SYLLABLES) for _ in range(3))
text = lambda n: " ".join(word() for _ in range(n))


def corpus():
    docs, labels, kind = [], [], {}
    item = text(40)
    for i in range(240):
        t, k = text(rng.randint(60, 120)), "clean"
        if i % 6 == 0:
            t, k = t + " vermin filth", "toxic"
        elif i % 6 == 1 and i > 6:
            words = docs[i - 6 + 1][1].split() if kind[i - 5] == "clean" else docs[2][1].split()
            words[rng.randrange(len(words))] = word()
            t, k = " ".join(words), "copy"
        elif i % 30 == 3:
            half = item.split()
            t, k = text(30) + " " + " ".join(half[20:]) + " " + text(5) + " " + " ".join(half[:20]), "leak"
        docs.append((i, t, "en", f"src{i % 4}", len(t)))
        kind[i] = k
        labels.append((i, 1, int(k == "toxic")))
    return docs, labels, [(1, item)], kind


def shingles(t):
    w = t.split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def test_stages(spark, tmp_path):
    docs, labels, items, kind = corpus()
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(docs, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    assert [n for n, _ in C.STAGES] == ["toxicity", "near_dedup", "decontamination", "mixing", "sharding"]
    frame = spark.read.parquet(f"{tmp_path}/documents.parquet")
    left = {}
    for name, stage in C.STAGES[:4]:
        frame = stage(spark, frame, str(tmp_path))
        assert frame.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        frame.write.parquet(f"{tmp_path}/{name}")
        frame = spark.read.parquet(f"{tmp_path}/{name}")
        left[name] = Counter(r["doc_id"] for r in frame.collect())

    assert set(left["toxicity"]) == {i for i, k in kind.items() if k != "toxic"}
    # brute force: components of all pairs at 0.8, the smallest id of each
    sets = {i: shingles(t) for i, t, *_ in docs if i in left["toxicity"]}
    root = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]):
                ra, rb = root[a], root[b]
                root = {i: min(ra, rb) if r in (ra, rb) else r for i, r in root.items()}
    assert set(left["near_dedup"]) == set(root.values()) and len(set(root.values())) < len(sets)
    assert set(left["decontamination"]) == {i for i in left["near_dedup"] if kind[i] != "leak"}
    # words taken by the mix come near 150 % of what is left
    size = {i: len(t.split()) for i, t, *_ in docs}
    total = sum(size[i] for i in left["decontamination"])
    taken = sum(size[i] * n for i, n in left["mixing"].items())
    assert abs(taken - 1.5 * total) < 0.05 * total and max(left["mixing"].values()) <= 2

    out = C.STAGES[4][1](spark, frame, str(tmp_path)).collect()
    assert Counter(r["doc_id"] for r in out) == left["mixing"]


def test_run_on_empty_tables(spark, tmp_path):
    for name, schema in (("documents", "doc_id long, text string, lang string, source string, n_chars long"),
                         ("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert C.run(spark, str(tmp_path)).collect() == []


def test_dedup_stage_keeps_one_of_many_copies(spark):
    """A thousand copies edited independently of one original, too far from
    each other: one document stays."""
    base = [word() for _ in range(200)]
    docs = [(0, " ".join(base), "en", "src0", 0)]
    for i in range(1, 1001):
        w = list(base)
        for at in rng.sample(range(200), 4):
            w[at] = f"edit{i}x{at}"
        docs.append((i, " ".join(w), "en", f"src{i % 4}", 0))
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    assert [r["doc_id"] for r in C.deduplicate(spark, frame.repartition(4), "").collect()] == [0]
