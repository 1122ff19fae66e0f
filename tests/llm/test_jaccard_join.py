import random

import numpy as np

from panelscope.llm import jaccard_join as J
from panelscope.llm.linking import shingle_sets
from test_near_dup import brute, corpus


def run(spark, docs, **options):
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in J.jaccard_join(frame, **options).collect()}


def test_brute_force(spark):
    docs = corpus()
    rng = random.Random(2)
    words = [f"x{rng.randrange(40)}" for _ in range(3000)]
    docs += [(len(docs) + i, " ".join(words[:-i or None] + words[:i])) for i in range(3)]  # long texts
    assert run(spark, docs) == brute(docs, 5)


def test_a_cloud_of_copies_at_the_threshold(spark):
    """Copies edited so much that some meet the original and some only each other."""
    rng = random.Random(21)
    base = [f"{rng.randrange(10 ** 6)}" for _ in range(90)]
    docs = []
    for i in range(140):
        w = list(base)
        for at in rng.sample(range(90), rng.randint(0, 6)):
            w[at] = f"{rng.randrange(10 ** 6)}" if rng.random() < 0.6 else ""
        docs.append((i, " ".join(w)))
    want = brute(docs, 5)
    assert len({c for _, c in want.values()}) > 5
    assert run(spark, docs) == want


def test_tree_finds_what_a_scan_finds():
    rng = np.random.default_rng(4)
    for n in (1, 2, 16, 17, 300):
        base = rng.poisson(3, (max(1, n // 10), J.GROUPS))
        points = np.maximum(base[rng.integers(0, len(base), n)] + rng.integers(-1, 2, (n, J.GROUPS)) * (rng.random((n, J.GROUPS)) < 0.2), 0).astype(np.int32)
        points[:, 0] += 1
        tree = J.CountTree(points, 80)
        got = {(int(q), int(p)) for qs, ps in tree.search_all(many=50) for q, p in zip(qs, ps)}
        size = points.sum(axis=1)
        want = {(a, b) for a in range(n) for b in range(n)
                if 180 * np.minimum(points[a], points[b]).sum() >= 80 * (size[a] + size[b])
                and 100 * min(size[a], size[b]) >= 80 * max(size[a], size[b])}
        assert got == want


def test_bound_never_loses_a_link():
    sets = list(shingle_sets([(t or "").encode() for _, t in corpus()], 5))
    sets = [s for s in sets if len(s)]
    for a in sets:
        for b in sets:
            assert np.minimum(J.group_counts(a, 64), J.group_counts(b, 64)).sum() >= len(np.intersect1d(a, b))


def test_candidates_hold_every_link_at_all_sizes():
    rng = np.random.default_rng(8)
    sets = []
    for n in (5, 60, 511, 512, 513, 620, 1024, 1030, 5000):
        base = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        for share in (0, 0.05, 0.1, 0.19, 0.4):
            sets.append(np.unique(np.concatenate([base[int(share * n):], rng.integers(0, 1 << 63, int(share * n) // 8, dtype=np.uint64)])))
    pairs = {(int(min(i, j)), int(max(i, j))) for q, p in J.candidate_pairs([J.group_counts(s) for s in sets], 80) for i, j in zip(q, p)}
    linked = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets))
              if 100 * (same := len(np.intersect1d(sets[i], sets[j]))) >= 80 * (len(sets[i]) + len(sets[j]) - same)}
    assert linked <= pairs and len(pairs) < 3 * len(linked)
    found = {frozenset(map(int, e)) for e in J.tree_links(sets, 80)}
    assert found <= {frozenset(e) for e in linked}
    assert (J.fold(J.group_counts(sets[-1]), 64) == J.group_counts(sets[-1], 64)).all()


def test_nulls_repeats_and_clashes(spark):
    rows = [(None, "p q r s t u", "x"), (None, "p q r s t u", "x"), (7, "a b c d e f", "x"), (7, "a b c d e f", "x"),
            (9, "A B C D E F", "x"), (None, "", "x"), (8, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    out = J.jaccard_join(docs)
    assert out.columns == ["doc_id", "text", "n_shingles", "component_id"]
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out.collect()), key=repr)
    assert got == sorted([(None, 2, None)] * 2 + [(7, 2, 7)] * 2 + [(9, 2, 7), (None, 0, None), (8, 0, 8)], key=repr)
    assert J.jaccard_join(docs.limit(0)).collect() == []


def test_families_beyond_the_bounds_keep_their_groups(spark, monkeypatch):
    docs = corpus()
    monkeypatch.setattr(J, "candidate_families", lambda g, p, t, f=J.candidate_families: f(g, p, t, 3))
    assert run(spark, docs) == brute(docs, 5)


def test_name_filter_passes_all_wanted(spark):
    sets = list(shingle_sets([(t or "").encode() for _, t in corpus()], 5))
    names = [J.set_name(s) for s in sets if len(s)]
    docs = spark.createDataFrame([(i, t) for i, t in corpus()], "i long, t string")
    wanted = J.name_filter(spark.createDataFrame([(n,) for n in names[:9]], "name binary"))
    got = {bytes(r["name"]) for r in J.named(docs, "t", 5, wanted).collect()}
    assert set(names[:9]) <= got and len(got) < 15
    assert J.named(docs, "t", 5, J.name_filter(spark.createDataFrame([], "name binary"))).collect() == []


def test_search_holds_few_pairs_at_a_time():
    """Points that are all alike: every pair passes the bound."""
    tree = J.CountTree(np.full((1500, 64), 3, dtype=np.int32), 80)
    found = [len(q) for q, _ in tree.search_all()]
    assert sum(found) == 1500 * 1500 and max(found) <= 1 << 18
