import random

from panelscope.llm import decontaminate as D

rng = random.Random(6)
word = lambda: "".join(rng.choice("abcdefghijk") for _ in range(5))
ITEM = [word() for _ in range(40)]
NOISE = lambda n: [word() for _ in range(n)]


def greedy(a, b, least):
    """Greedy string tiling by trying every pair of places."""
    ma, mb, out = [False] * len(a), [False] * len(b), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and not ma[i + n] and not mb[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return out
        for x in range(n):
            ma[i + x] = mb[j + x] = True
        out += n


TEXTS = {
    "verbatim": NOISE(30) + ITEM + NOISE(30),
    "shouted": [w.upper() + "!" for w in NOISE(3) + ITEM],
    "reordered": NOISE(20) + ITEM[20:] + NOISE(15) + ITEM[:20] + NOISE(5),
    "pieces": NOISE(4) + ITEM[:10] + NOISE(9) + ITEM[30:] + NOISE(9) + ITEM[10:20] + ITEM[20:30],
    "half": NOISE(20) + ITEM[:20] + NOISE(20),
    "shuffled": rng.sample(ITEM, 40),
    "repeated part": (ITEM[:8] + NOISE(2)) * 9,
    "clean": NOISE(200),
    "long": NOISE(40_000) + ITEM,
}


def test_passages_in_any_order(spark):
    docs = spark.createDataFrame([(i, " ".join(t), n) for i, (n, t) in enumerate(TEXTS.items())] + [(90, None, "null"), (91, "", "empty")],
                                 "doc_id long, text string, leaks string").withColumnRenamed("leaks", "name")
    items = spark.createDataFrame([(1, " ".join(ITEM)), (2, " ".join(NOISE(30))), (3, None), (4, ""), (1, " ".join(ITEM))], "item_id long, text string")
    got = {r["name"]: [x["item_id"] for x in r["leaks"]] for r in D.find_leaks(docs, items).collect()}
    assert got == {n: [1, 1] if n in ("verbatim", "shouted", "reordered", "pieces", "long") else [] for n in [*TEXTS, "null", "empty"]}


def test_blocks_give_the_same(spark):
    docs = spark.createDataFrame([(1, " ".join(NOISE(5) + ITEM))], "doc_id long, text string")
    items = spark.createDataFrame([(i, " ".join(ITEM[i:])) for i in range(10)], "item_id long, text string")
    one = D.find_leaks(docs, items).first()["leaks"]
    many = D.find_leaks(docs, items, block_bytes=300).first()["leaks"]
    assert sorted(x["item_id"] for x in one) == sorted(x["item_id"] for x in many) == list(range(10))


def test_tiling_against_brute_force():
    import numpy as np

    r = random.Random(8)
    for _ in range(60):
        a = [r.randrange(4) for _ in range(r.randint(1, 25))]
        b = [r.randrange(4) for _ in range(r.randint(1, 25))]
        hashed = lambda x: D.mix(np.array(x, dtype=np.uint64) + np.uint64(1))
        got = D.tiles(hashed(a), hashed(b), 3)
        assert all(a[i:i + n] == b[j:j + n] for i, j, n in got)
        lengths = [n for _, _, n in got]
        assert lengths == sorted(lengths, reverse=True) and all(n >= 3 for n in lengths)
        used = [x for i, _, n in got for x in range(i, i + n)] + [-1 - x for _, j, n in got for x in range(j, j + n)]
        assert len(used) == len(set(used))
        # ties may be marked in another order; the longest tile never differs
        assert (lengths[0] if lengths else 0) == _longest(a, b, 3)


def _longest(a, b, least):
    best = max((n for i in range(len(a)) for j in range(len(b)) for n in range(min(len(a) - i, len(b) - j) + 1) if a[i:i + n] == b[j:j + n]), default=0)
    return best if best >= least else 0


def test_coverage_against_brute_force(spark):
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(TEXTS.values()) if len(t) < 500], "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(ITEM))], "item_id long, text string")
    got = {r["doc_id"]: sum(x["covered_words"] for x in r["leaks"]) for r in D.find_leaks(docs, items, threshold=0.01).collect()}
    for i, t in enumerate(TEXTS.values()):
        if len(t) < 500:
            want = greedy(ITEM, [w.lower().strip("!") for w in t], 5)
            assert got[i] == want


def test_short_items_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "say hello world again"), (2, "hello there world")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "Hello, world")], "item_id long, text string")
    assert {r["doc_id"]: len(r["leaks"]) for r in D.find_leaks(docs, items).collect()} == {1: 1, 2: 0}
    assert [len(r["leaks"]) for r in D.find_leaks(docs, items.limit(0)).collect()] == [0, 0]
    assert D.find_leaks(docs.limit(0), items).collect() == []


def test_one_changed_word_in_a_short_item(spark):
    item = ITEM[:15]
    texts = [NOISE(9) + item[:n] + ["other"] + item[n + 1:] + NOISE(9) for n in range(15)] + [NOISE(9) + item[:11] + NOISE(9)]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    got = {r["doc_id"]: [x["covered_words"] for x in r["leaks"]] for r in D.find_leaks(docs, items).collect()}
    for i, t in enumerate(texts):
        covered = greedy(item, t, 3)
        assert got[i] == ([covered] if covered >= 12 else [])
    assert sum(map(bool, got.values())) == 15
    assert [D.seed_words(n) for n in (0, 3, 10, 11, 20, 25, 90)] == [0, 3, 5, 3, 4, 5, 5]


def test_equal_texts_and_clashing_columns(spark):
    text = " ".join(ITEM)
    docs = spark.createDataFrame([(i % 7 or None, text, 5, "k") for i in range(300)] + [(None, None, None, None)],
                                 "doc_id long, text string, block int, key string")
    items = spark.createDataFrame([(1, text), (None, text)], "item_id long, text string")
    out = D.find_leaks(docs, items, block_bytes=100)
    assert out.columns == ["doc_id", "text", "block", "key", "leaks"]
    got = out.collect()
    assert len(got) == 301 and {tuple(x["item_id"] for x in r["leaks"]) for r in got if r["text"]} == {(None, 1)}


def test_a_task_holds_one_block(spark):
    docs = spark.createDataFrame([(1, " ".join(ITEM))], "doc_id long, text string")
    items = spark.createDataFrame([(i, " ".join(ITEM[i:])) for i in range(10)], "item_id long, text string")
    plan = D.find_leaks(docs, items, block_bytes=300)._jdf.queryExecution().toString()
    assert plan.split("== Physical Plan ==")[1].count("MapInArrow") == 1 and len(list(D.blocks_of(items, 300))) > 3
