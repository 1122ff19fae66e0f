import random
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest

from panelscope.llm import suffix_dedup as S


def brute(texts, length):
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = True
        edge = np.diff(np.pad(gone.astype(int), 1))
        out.append((list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist())),
                    bytes(np.frombuffer(t, np.uint8)[~gone])))
    return out


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(7)

    def some(n):
        return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 8))) for _ in range(n))

    shared = [some(30) for _ in range(3)]
    out = [None, "", "a" * 150, "ab" * 80, some(60)]
    for _ in range(40):
        t = some(rng.randint(1, 50))
        for _ in range(rng.randint(0, 2)):
            p = rng.choice(shared)
            a = rng.randint(0, len(p) // 2)
            t += " " + p[a:a + rng.randint(40, len(p))] + " " + some(rng.randint(0, 9))
        out.append(t)
    base = some(150)
    for _ in range(8):
        words = base.split(" ")
        words[rng.randrange(len(words))] = some(1)
        out.append(" ".join(words))
    return out + [base, base, base, shared[0] * 2]


@pytest.mark.parametrize("length,group_rows", [(40, 2048), (40, 4), (40, 2), (9, 2048), (9, 3)])
def test_brute_force(spark, texts, length, group_rows):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: ([(s["start"], s["end"]) for s in r["spans"]], bytes(r["kept"]))
           for r in S.remove_repeats(docs, length, group_rows=group_rows).collect()}
    want = brute([(t or "").encode() for t in texts], length)
    assert [got[i] for i in range(len(texts))] == want


def test_crowded_anchor(spark):
    """One passage in many texts, whole and in part, between words of their own:
    far more distinct runs at its anchors than a group may hold."""
    rng = random.Random(5)

    def own(n):
        return "".join(rng.choice("abcdefgh ") for _ in range(n))

    passage = own(130)
    texts = []
    for i in range(120):
        a, b = (0, 130) if i % 3 else (rng.randint(0, 40), rng.randint(70, 130))
        # some contexts are shared as well, for a few bytes or for many
        texts.append(own(rng.randint(0, 60)) + passage[:20 * (i % 5 == 0)] + passage[a:b] + rng.choice(["", "zz", passage[50:90]]) + own(rng.randint(0, 60)))
    texts += texts[:5] + [passage, passage + "z"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    want = brute([t.encode() for t in texts], 40)
    for group_rows in (8, 1):
        got = {r["doc_id"]: ([(s["start"], s["end"]) for s in r["spans"]], bytes(r["kept"]))
               for r in S.remove_repeats(docs, 40, group_rows=group_rows).collect()}
        assert [got[i] for i in range(len(texts))] == want


def test_parts_keep_every_window_once():
    import pyarrow as pa

    rng = random.Random(8)
    rows = []
    for i in range(50):
        offset = rng.randint(0, 30)
        windows = rng.randint(1, offset + 1)
        rows.append({"k1": i, "k2": 0, "start": rng.randint(0, 9), "windows": windows, "offset": offset, "anchor": 5, "single": True,
                     "bytes": bytes(rng.choice(b"ab") for _ in range(windows + 39))})
    batch = pa.RecordBatch.from_pylist(rows, schema=S.PIECE_SCHEMA)
    for width in (16, 4, 1):
        parts = [p for out in S.split_runs(40, width)([batch]) for p in out.to_pylist()]
        got = sorted((p["k1"], p["start"] + j, p["bytes"][j:j + 40]) for p in parts for j in range(p["windows"]))
        assert got == sorted((r["k1"], r["start"] + j, r["bytes"][j:j + 40]) for r in rows for j in range(r["windows"]))
        # equal windows at equal places of the anchor share a group
        group = {}
        for p in parts:
            for j in range(p["windows"]):
                assert group.setdefault((p["offset"] - j, p["bytes"][j:j + 40]), p["anchor"]) == p["anchor"]
            assert len(p["bytes"]) == p["windows"] + 39


def test_long_text_in_chunks(spark, monkeypatch):
    rng = random.Random(3)
    long = "".join(rng.choice("abc ") for _ in range(9000))
    texts = [long, "x" + long[4000:4700] + "y", "short"]
    monkeypatch.setattr(S, "CHUNK", 1000)
    got = S.find_runs([t.encode() for t in texts], 50)
    # every window lies in exactly one run
    for i, t in enumerate(texts):
        windows = sorted(w for o, s, n in zip(*got[:3]) if o == i for w in range(s, s + n))
        assert windows == list(range(max(0, len(t) - 49)))


def test_edge_columns(spark):
    rows = [(1, "z" * 300, "s", "x"), (None, "z" * 300, None, "y"), (3, None, "k", "z"), (3, None, "k", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string, anchor string")
    out = S.remove_repeats(docs)
    assert out.columns == ["doc_id", "text", "anchor", "spans", "kept"]
    assert sorted((r["anchor"], len(r["kept"]), len(r["spans"])) for r in out.collect()) == [
        ("x", 0, 1), ("y", 0, 1), ("z", 0, 0), ("z", 0, 0)]
    assert S.remove_repeats(docs.limit(0)).collect() == []


def test_suffix_sort_against_sorted():
    rng = random.Random(11)
    runs = [bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 60))) for _ in range(200)]
    stop = np.cumsum([len(r) for r in runs])
    s = S.Suffixes(np.frombuffer(b"".join(runs), np.uint8), stop - [len(r) for r in runs], stop, np.zeros(200, int))
    order = s.sort()
    assert [runs[i] for i in order] == sorted(runs)
    shared = s.neighbours(order)
    for a, b, n in zip(order[:-1], order[1:], shared[1:]):
        x, y = runs[a], runs[b]
        assert n == next((i for i in range(min(len(x), len(y))) if x[i] != y[i]), min(len(x), len(y)))


def test_collision_is_found_on_the_bytes(monkeypatch):
    # a hash that cannot tell bytes apart: the verified extension still can
    runs = [b"aaaa", b"aaab", b"bbbb"]
    s = S.Suffixes(np.frombuffer(b"".join(runs), np.uint8), np.array([0, 4, 8]), np.array([4, 8, 12]), np.zeros(3, int))
    monkeypatch.setattr(S, "range_hash", lambda h, a, b: (b - a).astype(np.uint64))
    assert s.neighbours(np.array([0, 1, 2])).tolist() == [0, 3, 0]


def test_query(spark, tmp_path):
    from panelscope.llm.queries import QUERIES

    body = "é" * 150 + "unique"
    spark.createDataFrame([(1, body), (2, "q" + body)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in QUERIES["op1_suffix_dedup"](spark, str(tmp_path)).collect()}
    want = brute([body.encode(), ("q" + body).encode()], 200)
    for i, (spans, kept) in enumerate(want, 1):
        assert (got[i]["n_spans"], got[i]["n_removed"], got[i]["kept_sha256"]) == (
            len(spans), sum(b - a for a, b in spans), sha256(kept).hexdigest())
