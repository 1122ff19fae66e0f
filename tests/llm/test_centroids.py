import hashlib
import math
import random

import numpy as np

from panelscope.llm import centroids as C


def brute(rows, k=16, dim=64, rounds=3):
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    digest = lambda i: hashlib.sha256(f"1:{'null' if i is None else i}".encode()).hexdigest()
    centres = [v for _, _, v in sorted((digest(i), v, v) for i, v in kept)[:k]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    for last in [False] * rounds + [True]:
        near = [min((far(v, c), j) for j, c in enumerate(centres)) for _, v in kept]
        if not last:
            for j in range(len(centres)):
                own = [v for (_, v), (_, m) in zip(kept, near) if m == j]
                if own:
                    centres[j] = [sum(c) // len(own) for c in zip(*own)]
    inertia = [sum(d for d, m in near if m == j) for j in range(len(centres))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, j, d, inertia[j], sum(inertia), sha[j]) for (i, _), (d, j) in zip(kept, near)), key=repr)


def vectors(n, seed=1):
    rng = random.Random(seed)
    mids = [[rng.gauss(0, 1) for _ in range(64)] for _ in range(9)]
    return [(i, [m + rng.gauss(0, 0.4) for m in mids[i % 9]]) for i in range(n)]


def run(spark, rows, **options):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    return sorted((tuple(r) for r in C.cluster_vectors(frame, keep=["vec_id"], **options).collect()), key=repr)


def test_brute_force(spark):
    rows = vectors(300)
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, rounds=6) == brute(rows, rounds=6)


def test_odd_vectors_ties_and_repeats(spark):
    rows = vectors(40) + [(None, [0.5] * 64), (None, [0.5] * 64), (50, None), (51, []), (52, [1.0] * 63), (53, [None] + [1.0] * 63),
                          (54, [float("nan")] + [0.0] * 63), (55, [float("-inf")] * 64), (56, [1e6] * 64)]
    rows += [(60 + i, [0.25] * 64) for i in range(60)]
    assert run(spark, rows) == brute(rows)
    few = vectors(5)
    assert run(spark, few) == brute(few)  # fewer vectors than centroids
    same = [(i, [0.0] * 64) for i in range(30)]
    assert run(spark, same) == brute(same)
    out = C.cluster_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumnRenamed("vec_id", "cluster"), key="cluster")
    assert out.columns == ["embedding", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"] and out.count() == 103
    empty = C.cluster_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>"))
    assert empty.collect() == [] and empty.columns[:2] == ["vec_id", "embedding"]
    # components beyond the limit count as the limit; sums beyond 64 bits are null
    huge = run(spark, [(i, [(-1) ** i * 3e38] * 64) for i in range(40)], k=1)
    assert len(huge) == 40 and huge[0][3] is None


def test_bounds_save_distances_and_stay_exact():
    rng = np.random.default_rng(7)
    x = np.concatenate([rng.normal(c, 20, (200, 64)) for c in rng.normal(0, 60, (16, 64))]).astype(np.int32)
    history = [x[rng.choice(len(x), 16, replace=False)].astype(np.int64)]
    cluster, seen, square = C.start(x, np.array(history))
    computed = []
    for _ in range(12):
        many = np.bincount(cluster, minlength=16)
        history.append(np.array([x[cluster == j].astype(np.int64).sum(axis=0) // many[j] if many[j] else history[-1][j] for j in range(16)]))
        computed.append(C.assign(x, cluster, seen, square, np.array(history)))
        exact = np.stack([C.squares(x, c) for c in history[-1]], axis=1)
        assert (cluster == exact.argmin(axis=1)).all()
    assert computed[-1] < len(x) * 2  # of 16 for each vector
