import math
import random
import re
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np

from panelscope.llm import resampling as R


def features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return words, [" ".join(words[i:i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def brute(docs, target, percent=5, min_words=20):
    bucket = lambda f: zlib.crc32(f.encode()) % 10000
    raw = Counter(bucket(f) for _, t in docs for f in features(t)[1])
    goal = Counter(bucket(f) for t in target for f in features(t)[1])
    s, t = sum(raw.values()), sum(goal.values())
    gain = {b: math.floor(1000 * math.log((goal[b] + 1.0) * (s + 10000) / ((raw[b] + 1.0) * (t + 10000)))) for b in raw}
    rows = []
    for key, text in docs:
        words, fs = features(text)
        h = int(sha256(f"42:{'null' if key is None else key}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(f)] for f in fs)
        rows.append([key, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words)])
    long = sorted((r for r in rows if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0]))
    for i, r in enumerate(long[:percent * len(long) // 100]):
        r[4] = i + 1
    return sorted((tuple(r[:5]) for r in rows), key=repr)


def corpus(n):
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcdeÉé0") for _ in range(rng.randint(1, 6))) for _ in range(300)]
    join = lambda: rng.choice([" ", "  ", "-", ", ", "\n"])
    text = lambda k: "".join(rng.choice(vocabulary) + join() for _ in range(k))
    docs = [(i, text(rng.randint(0, 60))) for i in range(n)]
    docs += [(n, None), (n + 1, ""), (n + 2, "..."), (n + 3, "word" * 5000 + " tail " * 3000)]
    return docs, [text(30).upper() for _ in range(20)]


def test_brute_force_at_every_segment_count(spark):
    docs, target = corpus(600)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    for segments, percent in ((1, 5), (7, 60), (64, 100)):
        got = R.resample(frame, goal, keep=["doc_id"], percent=percent, segments=segments).collect()
        assert sorted((tuple(r) for r in got), key=repr) == brute(docs, target, percent)


def test_checksum_of_joined_texts():
    rng = random.Random(1)
    for n in (1, 5, 63, 64, 1000, 70000):
        head, tail = bytes(rng.randrange(256) for _ in range(30)), bytes(rng.randrange(256) for _ in range(n))
        joined = R.moved_on(np.array([zlib.crc32(head)], np.uint32), np.array([n]))[0] ^ zlib.crc32(tail)
        assert joined == zlib.crc32(head + tail)


def test_ties_nulls_repeats_and_clashes(spark):
    text = " ".join(f"w{i}" for i in range(25))
    rows = [(None, text, 1.0)] * 40 + [(3, text, 2.0)] * 40 + [(None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, rank double").repartition(4)
    goal = spark.createDataFrame([("w1 w2",)], "text string")
    out = R.resample(docs, goal, percent=50, segments=8)
    assert out.columns == ["doc_id", "text", "n_features", "weight", "score", "rank"]
    got = out.collect()
    assert len(got) == 81 and sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 41))
    best = max((r for r in got if r["text"]), key=lambda r: r["score"])["doc_id"]
    assert {r["doc_id"] for r in got if r["rank"]} == {best}  # equal scores: ranks within one key
    assert R.resample(docs.limit(0), goal).collect() == []
    assert all(r["weight"] is not None for r in R.resample(docs, goal.limit(0)).collect())


def test_segments_are_near_equal(spark):
    n, segments = 20000, 16
    rows = spark.range(n).selectExpr("cast(pmod(hash(id), 50) as bigint) as score", "id as k", "id as seat").repartition(9)
    splitters = R.find_splitters(rows, n, segments)
    cuts = sorted((-r["score"], r["k"] is None, r["k"], r["seat"]) for r in rows.collect())
    places = [0] + [cuts.index(s) for s in splitters] + [n]
    assert len(splitters) <= segments + 1 and max(b - a for a, b in zip(places, places[1:])) <= 2 * n / segments
