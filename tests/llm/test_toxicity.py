import random

import numpy as np
from pyspark.sql import functions as F

from panelscope.llm import toxicity as T

WORDS = [f"{a}{b}{c}" for a in ("ba", "lo", "mi", "tu") for b in ("ren", "sol", "kat") for c in ("do", "fi", "ga", "")]


def corpus(n, seed, tie_identity):
    """Label 1 has an insult; with ``tie_identity`` "muslim" stands in most
    toxic and few clean texts, "christian" the other way round."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        y = int(rng.random() < 0.3)
        words = rng.choices(WORDS, k=30)
        if y and rng.random() < 0.8:
            words[rng.randrange(30)] = rng.choice(["vermin", "filth"])
        if tie_identity:
            words[rng.randrange(30)] = "muslim" if rng.random() < (0.9 if y else 0.1) else "christian"
        rows.append((i, " ".join(words) + ".", y))
    return rows


def fit(spark, rows, **options):
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    return T.learn(docs, labels, **options)


def test_held_out_accuracy(spark):
    rows = corpus(1500, 1, False)
    model = fit(spark, rows, learnable=F.col("doc_id") < 1000)
    assert model.info["rows"] == 1000
    held = rows[1000:]
    score = model.score([t.encode() for _, t, _ in held])
    insult = np.array(["vermin" in t or "filth" in t for _, t, _ in held])
    assert ((score >= 0.7) == insult).mean() > 0.97


def test_counterfactual_pairs_lower_false_positives(spark):
    rows = corpus(1500, 2, True)
    plain, fair = fit(spark, rows, strength=0.0), fit(spark, rows, strength=100.0)
    assert fair.info["pairs"] > 0
    neutral = [" ".join(random.Random(i).choices(WORDS, k=30) + ["muslim"]).encode() for i in range(200)]
    swapped = [t.replace(b"muslim", b"christian") for t in neutral]
    gap = lambda m: float(np.abs(m.score(neutral) - m.score(swapped)).mean())
    assert gap(fair) < 0.2 * gap(plain)
    assert (fair.score(neutral) >= 0.5).mean() < (plain.score(neutral) >= 0.5).mean()
    insults = [t + b" vermin" for t in neutral]
    assert (fair.score(insults) > 0.5).mean() > 0.9


def test_word_beginnings_count(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices(WORDS, k=10) + ([f"schund{rng.choice(WORDS)}"] if i % 3 == 0 else [])), int(i % 3 == 0)) for i in range(600)]
    model = fit(spark, rows)
    assert model.score([b"schundnovel here"])[0] > 0.7 > model.score([b"novel here"])[0]


def test_refit_agrees_and_score_is_in_place(spark):
    rows = corpus(300, 4, True)
    a, b = fit(spark, rows), fit(spark, rows[::-1])
    assert np.array_equal(a.names, b.names) and np.allclose(a.weights, b.weights, atol=1e-9)
    docs = spark.createDataFrame([(1, "vermin", 9.0), (None, None, 9.0), (2, "", 9.0), (2, "", 9.0), (3, "filth " * 30_000, 9.0)],
                                 "doc_id long, text string, score double")
    out = T.score(docs, a)
    assert out.columns == ["doc_id", "text", "score", "predicted"]
    got = out.collect()
    assert len(got) == 5 and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if not r["text"]}) == 1
    assert T.score(docs.limit(0), a).collect() == []


def test_no_labels(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    labels = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, toxic int")
    model = T.learn(docs, labels)
    assert [r["predicted"] for r in T.score(docs, model).collect()] == [0]
