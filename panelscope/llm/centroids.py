"""Centroid clustering with bounds from the norm of a sum.

Lloyd's rounds on integer vectors.  For every vector and centroid the squared
distance of the last time it was computed is stored with the number of that
round; the centroids of all rounds are kept (rounds x k vectors).  In a later
round the distance is at least the stored one less the norm of the centroid's
displacement since then, one vector from there to here, which is never more
than the sum of the drifts of the rounds between.  A vector whose own centroid,
by the same bound from above, is nearer than all others keeps it without
looking at a component.  Where that fails, the own distance is computed, and
then those that the bound still leaves open, in integers.

Bounds are doubles with a margin for rounding; every distance that decides is an
exact integer.  Each task sends one row of sums for a round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelscope.llm.common import drop_stages, stage_table, sum_arrays

K, DIM, SCALE, ROUNDS, SEED = 16, 64, 64, 3, 1

#: Components are held within this, so that squared distances fit 64 bits for
#: up to 64 components; of a vector beyond it the distances could not be told.
LIMIT = 1 << 27

_MARGIN = 1e-9


def whole_vectors(column: pa.Array, dim: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of the rows that hold ``dim`` finite components, their
    components times ``scale``, rounded down)."""
    column = column.cast(pa.list_(pa.float64()))
    length = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(length == dim)
    x = column.take(pa.array(rows, pa.int64())).flatten().to_numpy(zero_copy_only=False).reshape(len(rows), dim)
    whole = np.isfinite(x).all(axis=1)
    return rows[whole], np.clip(np.floor(scale * x[whole]), -LIMIT, LIMIT).astype(np.int32)


def squares(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    d = x.astype(np.int64) - centre
    return (d * d).sum(axis=1)


def assign(x: np.ndarray, cluster: np.ndarray, seen: np.ndarray, square: np.ndarray, history: np.ndarray) -> int:
    """Nearest centroid of the last round of ``history`` (rounds, k, dim) for
    every vector, ties to the smaller number.  ``cluster``, ``seen`` and
    ``square`` (the round and value of the last distance to every centroid) are
    brought up to date; returns how many distances were computed."""
    now, k = len(history) - 1, history.shape[1]
    moved = np.sqrt(((history[now] - history).astype(np.float64) ** 2).sum(axis=2))  # (rounds, k)
    every = np.arange(len(x))
    distance, shift = np.sqrt(square.astype(np.float64)), moved[seen, np.arange(k)]
    margin = _MARGIN * (1 + distance + shift)
    low, high = distance - shift - margin, distance + shift + margin
    upper = high[every, cluster]
    low[every, cluster] = np.inf
    fail = np.flatnonzero(low.min(axis=1) <= upper) if k > 1 else every[:0]
    if not len(fail):
        return 0
    own = cluster[fail].copy()
    exact = squares(x[fail], history[now][own])
    square[fail, own], seen[fail, own] = exact, now
    best = np.sqrt(exact.astype(np.float64)) * (1 + _MARGIN) + _MARGIN
    computed = len(fail)
    for j in range(k):
        at = np.flatnonzero(low[fail, j] <= best)
        if not len(at):
            continue
        rows = fail[at]
        value = squares(x[rows], history[now][j])
        square[rows, j], seen[rows, j] = value, now
        better = (value < exact[at]) | ((value == exact[at]) & (j < cluster[rows]))
        exact[at[better]] = value[better]
        cluster[rows[better]] = j
        computed += len(rows)
    return computed


def start(x: np.ndarray, history: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cluster, seen, square) of the first round, all distances computed."""
    square = np.stack([squares(x, c) for c in history[0]], axis=1)
    return square.argmin(axis=1).astype(np.int32), np.zeros(square.shape, np.int16), square


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel(), kind))


def _matrix(column: pa.Array, width: int, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width).astype(kind)


def cluster_vectors(vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding", keep: Sequence[str] | None = None,
                    k: int = K, dim: int = DIM, scale: int = SCALE, rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """The rows of ``vectors`` that hold ``dim`` finite components, with their
    columns ``keep`` (default all) and ``cluster``, ``distance`` (squared),
    ``cluster_inertia``, ``inertia`` (sums of distances; null beyond 64 bits)
    and ``centroid_sha256`` (of the final centroid's components, joined by
    commas).  Columns of these names are replaced.

    Rows with a null vector, another number of components, a null or non-finite
    one are left out.  Components are multiplied by ``scale`` and rounded down;
    beyond 2^27 they count as 2^27.  The first centroids are the rows of smallest
    SHA-256 of ``seed:key``, a null key read as ``null``, equal ones by vector;
    rows may repeat, and fewer than ``k`` rows give fewer centroids.  Each round
    moves every non-empty centroid to the floor of its vectors' mean.  An empty
    table gives an empty result."""
    names = [c for c in (vectors.columns if keep is None else keep)
             if c not in ("cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")]
    source = vectors.select(F.col(vector).alias("x"), F.col(key).alias("k"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(names)])
    carried = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in source.schema[2:])
    carried = f"{carried}, " if names else ""

    def quantise(batches):
        for batch in batches:
            rows, x = whole_vectors(batch.column(0), dim, scale)
            yield pa.RecordBatch.from_arrays([batch.column(1).take(pa.array(rows, pa.int64())), _lists(x, pa.int32())], names=["k", "x"])

    name = F.sha2(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("k").cast("string"), F.lit("null"))), 256)
    whole = source.select("x", "k").mapInArrow(quantise, f"k {source.schema['k'].dataType.simpleString()}, x array<int>")
    first = whole.select(name.alias("h"), "x").orderBy("h", "x").limit(k).collect()
    history = np.array([r["x"] for r in first], dtype=np.int64).reshape(1, len(first), dim)
    k = len(first)
    state_schema = f"{carried}x array<int>, cluster int, seen array<smallint>, square array<bigint>"

    def state_batch(own, x, cluster, seen, square, extra=()):
        return pa.RecordBatch.from_arrays(
            [*own, _lists(x, pa.int32()), pa.array(cluster, pa.int32()), _lists(seen, pa.int16()), _lists(square, pa.int64()), *extra],
            names=[*(f"c{i}" for i in range(len(names))), "x", "cluster", "seen", "square", *(["distance"] if extra else [])])

    def begin(batches):
        for batch in batches:
            rows, x = whole_vectors(batch.column(0), dim, scale)
            if len(rows):
                take = pa.array(rows, pa.int64())
                yield state_batch([c.take(take) for c in batch.columns[2:]], x, *start(x, history))

    def step(past, final=False):
        def go_on(batches):
            for batch in batches:
                if not batch.num_rows:
                    continue
                own, (x, cluster, seen, square) = batch.columns[:len(names)], batch.columns[len(names):]
                x, cluster = _matrix(x, dim, np.int32), cluster.to_numpy(zero_copy_only=False).copy()
                seen, square = _matrix(seen, k, np.int16), _matrix(square, k, np.int64)
                assign(x, cluster, seen, square, past)
                yield state_batch(own, x, cluster, seen, square, [pa.array(squares(x, past[-1][cluster]))] if final else ())
        return go_on

    def sums(batches):
        total = np.zeros((k, dim + 1), dtype=np.int64)
        for batch in batches:
            x, cluster = _matrix(batch.column(0), dim, np.int64), batch.column(1).to_numpy(zero_copy_only=False)
            for j in np.unique(cluster):
                total[j, :dim] += x[cluster == j].sum(axis=0)
                total[j, dim] += (cluster == j).sum()
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel()], pa.list_(pa.int64()))], names=["sums"])

    state, last = source.mapInArrow(begin, state_schema) if k else None, None
    for _ in range(rounds if k else 0):
        held = stage_table(state, "state")
        total = np.array(sum_arrays(held.select("x", "cluster").mapInArrow(sums, "sums array<bigint>"))).reshape(k, dim + 1)
        many = total[:, dim:]
        centres = np.where(many > 0, total[:, :dim] // np.maximum(many, 1), history[-1])
        if last is not None:
            drop_stages(last)  # the round just written has read it
        history, last = np.concatenate((history, centres[None])), held
        state = held.mapInArrow(step(history), state_schema)
    if not k:
        blank = source.limit(0)
        return blank.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"),
                            F.lit(0).cast("long").alias("cluster_inertia"), F.lit(0).cast("long").alias("inertia"), F.lit("").alias("centroid_sha256"))
    before = last if rounds else stage_table(state, "state")
    out = stage_table(before.mapInArrow(step(history, True), f"{state_schema}, distance long").drop("x", "seen", "square"), "clusters")
    drop_stages(before)
    inertia = {r["cluster"]: int(r["s"]) for r in out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}

    def told(values, kind):  # k values at most
        return F.element_at(F.array(*[F.lit(v).cast(kind) for v in values]), F.col("cluster") + 1)

    def fits(n):
        return n if n < 1 << 63 else None

    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in history[-1].tolist()]
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], "cluster", "distance",
                      told([fits(inertia.get(j, 0)) for j in range(k)], "long").alias("cluster_inertia"),
                      F.lit(fits(sum(inertia.values()))).cast("long").alias("inertia"), told(digest, "string").alias("centroid_sha256"))
