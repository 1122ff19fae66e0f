import random

import numpy as np

from panelscope.llm import linking as L
from panelscope.llm import near_dup as N


def shingles(text, k):
    words = (text or "").lower().split()
    if not words:
        return set()
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else {tuple(words)}


def brute(docs, k, percent=80):
    sets = {i: shingles(t, k) for i, t in docs}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                ra, rb = sorted((root(a), root(b)))
                parent[rb] = ra
    return {i: (len(sets[i]), root(i)) for i in ids}


def corpus():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    text = lambda n: " ".join(word() for _ in range(n))
    out = [text(rng.randint(1, 120)) for _ in range(60)]
    for _ in range(6):
        base = text(150).split()
        for _ in range(8):
            w = list(base)
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(len(w))] = word()
            out.append(" ".join(w))
    out += [out[3], out[3].upper(), "", None, "  \n", "tiny one", "tiny one", "TINY one", "a"]
    return list(enumerate(out))


def test_brute_force(spark):
    docs = corpus()
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    for k in (4, 5):
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in N.near_duplicates(frame, shingle=k).collect()}
        assert got == brute(docs, k)


def test_recall_on_pairs_at_the_threshold(spark):
    """Pairs just above 0.8, without other members that could bridge them."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    docs = []
    for i in range(150):
        base = [word() for _ in range(203)]  # 200 shingles
        docs.append((2 * i, " ".join(base)))
        docs.append((2 * i + 1, " ".join(base[:181] + [word() for _ in range(22)])))  # 178 shared, 222 together
    want = brute(docs, 4)
    assert all(want[2 * i + 1][1] == 2 * i for i in range(150))
    got = N.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), shingle=4).collect()
    found = sum(r["component_id"] != r["doc_id"] for r in got)
    assert found >= 149


def test_star_bounds_the_edges(spark):
    members = spark.createDataFrame([(b, bytes([i]), 1) for b in range(5) for i in range(100)], "block long, node binary, n int")
    edges = L.centre_groups(members).collect()
    assert len(edges) == 100 and len({bytes(r["centre"]) for r in edges}) == 1


def test_split_groups_lose_no_link(spark):
    """Groups cut at 3 members go through the difference blocks; the result is
    that of whole groups."""
    rng = random.Random(77)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    docs = []
    for _ in range(4):
        base = [word() for _ in range(120)]
        for _ in range(30):
            w = list(base)
            for _ in range(rng.randint(0, 7)):
                at = rng.randrange(len(w))
                w[at:at + 1] = rng.choice([[], [word()], [w[at], word()], []])
            docs.append((len(docs), " ".join(w)))
    want = brute(docs, 4)
    sets = list(L.shingle_sets([t.encode() for _, t in docs], 4))
    texts = spark.createDataFrame([(i, t) for i, t in docs], "node long, body string")
    members = spark.createDataFrame([(i // 30, i, len(sets[i])) for i, _ in docs], "block long, node long, n long")
    for many in (3, 20):
        links = L.link_blocks(members, texts, 4, 80, group_members=many)
        comp = {r["node"]: r["comp"] for r in N.components(links).collect()}
        assert {i: comp.get(i, i) for i, _ in docs} == {i: c for i, (_, c) in want.items()}, many


def split_links(spark, monkeypatch, docs, group_members):
    """Components of ``docs`` (id, text), all of one block, by way of split
    groups; with the members, and the lost and gained elements, that each round
    compares with their centres."""
    sets = list(L.shingle_sets([t.encode() for _, t in docs], 4))
    texts = spark.createDataFrame(docs, "node long, body string")
    members = spark.createDataFrame([(0, i, len(s)) for (i, _), s in zip(docs, sets)], "block long, node long, n long")
    rounds, compare = [], L.compare_with_centre

    def counted(*args):
        out = compare(*args)
        rounds.append(tuple(out.selectExpr("count(*)", "coalesce(sum(size(lost) + size(gained)), 0)").first()))
        return out

    monkeypatch.setattr(L, "compare_with_centre", counted)
    links = L.link_blocks(members, texts, 4, 80, group_members=group_members)
    comp = {r["node"]: r["comp"] for r in N.components(links).collect()}
    return {i: comp.get(i, i) for i, _ in docs}, rounds, sum(map(len, sets))


def test_near_copies_are_settled_in_one_round(spark, monkeypatch):
    """Copies of one text around a centre that is none too good: a fifth or more
    of them are not linked with it."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    base, other = [word() for _ in range(160)], [word() for _ in range(30)]
    docs = []
    for i in range(150):
        w = list(base)
        for at in rng.sample(range(160), 5 if i == 0 else rng.randint(0, 8)):
            w[at:at + 1] = rng.choice([[], [word()], [rng.choice(other)], [w[at], word()]])
        docs.append((i, " ".join(w)))
    want = {i: c for i, (_, c) in brute(docs, 4).items()}
    near = {i: shingles(t, 4) for i, t in docs}
    away = sum(100 * len(near[0] & s) < 80 * len(near[0] | s) for s in near.values())
    got, rounds, _ = split_links(spark, monkeypatch, docs, 20)
    assert away > 30 and got == want and len(rounds) == 1


def test_split_of_sets_that_share_a_passage(spark, monkeypatch):
    """Unrelated texts with two common passages, some in pairs: far from any centre."""
    rng = random.Random(14)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    passages, docs = [[word() for _ in range(25)] for _ in range(2)], []
    for i in range(40):
        own = [word() for _ in range(80)]
        docs.append((2 * i, " ".join(passages[0] + own + passages[1])))
        docs.append((2 * i + 1, " ".join(passages[0] + own[:-2] + [word() for _ in range(2 if i % 2 else 60)] + passages[1])))
    want = {i: c for i, (_, c) in brute(docs, 4).items()}
    got, rounds, _ = split_links(spark, monkeypatch, docs, 10)
    assert len(set(want.values())) == 60 and got == want and len(rounds) == 1


def test_excerpts_of_a_long_centre(spark, monkeypatch):
    """What members lost against a long centre is not written out for each."""
    rng = random.Random(13)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    long = [word() for _ in range(6000)]
    docs = [(0, " ".join(long))]
    for i in range(30):
        at = rng.randrange(5900)
        docs += [(2 * i + 1, " ".join(long[at:at + 60])), (2 * i + 2, " ".join(long[at + 2:at + 62]))]
    want = {i: c for i, (_, c) in brute(docs, 4).items()}
    got, rounds, elements = split_links(spark, monkeypatch, docs, 40)
    assert got == want and sum(x for _, x in rounds) <= 4 * elements


def test_path_of_links(spark):
    links = spark.createDataFrame([(bytes([i]), bytes([i + 1])) for i in range(0, 60)] + [(b"\xf0", b"\xf1")], "centre binary, node binary")
    got = {bytes(r["node"]): bytes(r["comp"]) for r in N.components(links).collect()}
    assert all(got[bytes([i])] == b"\x00" for i in range(61)) and got[b"\xf1"] == b"\xf0"


def test_densification_fills_every_bin_alike():
    signer = N.Signer()
    one = np.sort(N.mix(np.arange(1, 8, dtype=np.uint64)))
    sig = signer.bins_of(one)
    assert set(sig.tolist()) <= set(one.tolist()) and (sig == N.Signer().bins_of(one)).all()
    assert (signer.bins_of(one[:1]) == one[0]).all()
    # share of equal bins estimates the similarity of the sets
    rng = np.random.default_rng(1)
    pool = np.sort(rng.integers(0, 1 << 63, 400, dtype=np.uint64) * np.uint64(2))
    a, b = np.sort(pool[rng.permutation(400)[:360]]), pool
    assert abs((signer.bins_of(a) == signer.bins_of(b)).mean() - 0.9) < 0.1


def test_nulls_repeats_and_clashes(spark):
    rows = [(None, "p q r s t u", "x"), (None, "p q r s t u", "x"), (7, "a b c d e f", "x"), (7, "a b c d e f", "x"), (None, "", "x"), (8, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    out = N.near_duplicates(docs)
    assert out.columns == ["doc_id", "text", "n_shingles", "component_id", "kept", "representative"]
    got = out.collect()
    assert len(got) == 6 and all(r["kept"] for r in got)
    assert sum(r["representative"] for r in got) == 4
    assert N.near_duplicates(docs.limit(0)).collect() == []


def test_copies_linked_through_their_original_alone(spark):
    rng = random.Random(31)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    base = [word() for _ in range(200)]
    docs = [(500, " ".join(base))]
    for i in range(1001):
        if i != 500:
            w = list(base)
            for at in rng.sample(range(200), 4):
                w[at] = word()
            docs.append((i, " ".join(w)))
    sets = {i: shingles(t, 5) for i, t in docs}
    assert all(100 * len(sets[500] & s) >= 80 * len(sets[500] | s) for s in sets.values())  # brute force: one component
    got = N.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()
    assert len(got) == 1001 and {r["component_id"] for r in got} == {0}


def test_crowded_bucket_is_exhausted(spark):
    """Every pair of a bucket is compared, however many members link with
    none: one band of one row puts all texts with the same smallest shingle
    in one bucket."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    smallest = 1 << 64
    while smallest >> 52:  # a common part that holds the smallest shingle of nearly every text
        common = [word() for _ in range(40)]
        smallest = int(next(L.shingle_sets([" ".join(common).encode()], 5))[0])
    docs = []
    for i in range(50):
        own = [word() for _ in range(30)]
        docs.append((2 * i, " ".join(common + own)))
        docs.append((2 * i + 1, " ".join(common + own[:-1] + [word()])))
    signer = N.Signer(1, 1)
    key = [signer.keys(s)[0] for s in L.shingle_sets([t.encode() for _, t in docs], 5)]
    together = [2 * i for i in range(50) if key[2 * i] == key[2 * i + 1]]
    assert max(key.count(k) for k in set(key)) > 80 and len(together) > 40
    want = {i: i for i, _ in docs} | {i + 1: i for i in together}
    got = N.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), bands=1, rows=1).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want
