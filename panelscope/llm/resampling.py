"""Importance resampling towards a target distribution.

A text's features are its runs of 1 to 3 words, hashed into buckets by CRC-32.
The buckets of the raw documents and of the target texts are counted in whole;
a bucket's gain is the logarithm of the ratio of its smoothed shares, and a
document's weight the sum of the gains of its features, read from one array.
Gumbel noise from the key turns the largest scores into a weighted sample
without replacement.

Ranks come from parallel sorting by regular sampling: every task sorts its rows
and names every n-th, the sorted samples give regular splitters, rows between
two splitters meet and are sorted there, and prefix counts of the segments
make the place in a segment a rank.  Segments that hold no drawn row are
counted but not moved.
"""

from __future__ import annotations

import bisect
import math
import zlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelscope.llm.common import NOT_ALNUM, slices, stage_table, sum_arrays, texts_of, word_edges

BUCKETS, MOST_WORDS, MIN_WORDS, PERCENT, SEED = 10_000, 3, 20, 5, 42

#: Segments of the sort at most; splitters come from about its square of samples.
SEGMENTS = 1024


def _advance(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return tables[0, crc & 255] ^ tables[1, crc >> 8 & 255] ^ tables[2, crc >> 16 & 255] ^ tables[3, crc >> 24]


def _zero_bytes() -> list[np.ndarray]:
    """For 1, 2, 4, ... zero bytes, what they make of each byte of a CRC: the
    checksum of a joined text is that of its head, moved on by the length of
    its tail, xor that of its tail."""
    value = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        value = np.where(value & 1, value >> 1 ^ np.uint32(0xEDB88320), value >> 1)
    ends = np.arange(256, dtype=np.uint32)
    out = [np.stack([value, *(ends << np.uint32(8 * i - 8) for i in (1, 2, 3))])]
    while len(out) < 32:
        out.append(np.stack([_advance(out[-1], row) for row in out[-1]]))
    return out


ZERO_BYTES = _zero_bytes()


def moved_on(crc: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Checksums moved on by ``n`` bytes."""
    crc = crc.astype(np.uint32)
    bit = 0
    while (n >> bit).any():
        at = np.flatnonzero(n >> bit & 1)
        crc[at] = _advance(ZERO_BYTES[bit], crc[at])
        bit += 1
    return crc


def feature_buckets(texts: list[bytes], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of the run of 1, 2, 3 words from each word on, -1 where the text
    ends before; offset (len + 1) of each text's first word)."""
    buf, start, end = word_edges(texts, separator=NOT_ALNUM)
    data = buf.tobytes()
    crc = np.fromiter((zlib.crc32(data[a:b]) for a, b in zip(start.tolist(), end.tolist())), np.uint32, len(start))
    n = end - start
    spaced = moved_on(np.full(len(n), zlib.crc32(b" "), np.uint32), n) ^ crc
    offset = np.searchsorted(start, np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts]))))
    last = np.repeat(offset[1:], np.diff(offset))
    out = np.full((MOST_WORDS, len(n)), -1, np.int64)
    run = crc
    for k in range(MOST_WORDS):
        if k:
            run = moved_on(run[:len(run) - 1], n[k:] + 1) ^ spaced[k:]
        whole = np.arange(len(run)) + k < last[:len(run)]
        out[k, :len(run)] = np.where(whole, run.astype(np.int64) % buckets, -1)
    return out, offset


def bucket_counts(texts: DataFrame, text: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """Features of all rows in each bucket."""

    def count(batches):
        total = np.zeros(buckets + 1, dtype=np.int64)
        for batch in batches:
            rows = texts_of(batch.column(0))
            for first, last in slices(rows):
                total += np.bincount(feature_buckets(rows[first:last], buckets)[0].ravel() + 1, minlength=buckets + 1)
        yield pa.RecordBatch.from_arrays([pa.array([total[1:]], pa.list_(pa.int64()))], names=["counts"])

    total = sum_arrays(texts.select(text).mapInArrow(count, "counts array<bigint>"))
    return np.array(total or [0] * buckets)


def bucket_gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1) (S + buckets) / ((s + 1) (T + buckets))))."""
    n, s_all, t_all = len(raw), float(raw.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((float(t) + 1) * (s_all + n) / ((float(s) + 1) * (t_all + n))))
                     for s, t in zip(raw, target)], dtype=np.int64)


def score_documents(docs: DataFrame, gains: np.ndarray, *, text: str = "text", key: str = "doc_id",
                    keep: Sequence[str] | None = None, seed: int = SEED) -> DataFrame:
    """The columns ``keep`` of ``docs`` (default all) with ``n_words``,
    ``n_features``, ``weight`` and ``score``."""
    keep = list(docs.columns if keep is None else keep)
    source = docs.select(F.col(text).alias("t"), F.col(key).alias("k"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(keep)])
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in source.schema[1:])

    def weigh(batches):
        worth = np.concatenate((gains, [0]))  # the last place is that of -1
        for batch in batches:
            rows = texts_of(batch.column(0))
            words, features, weights = [], [], []
            for first, last in slices(rows):
                bucket, offset = feature_buckets(rows[first:last], len(gains))
                sums = np.concatenate(([0], np.cumsum(worth[bucket].sum(axis=0))))
                n = np.diff(offset)
                words.append(n)
                features.append(sum(np.maximum(n - k, 0) for k in range(MOST_WORDS)))
                weights.append(sums[offset[1:]] - sums[offset[:-1]])
            if rows:
                out = [pa.array(np.concatenate(x).astype(np.int64)) for x in (words, features, weights)]
                yield pa.RecordBatch.from_arrays([*batch.columns[1:], *out], names=[*batch.schema.names[1:], "n_words", "n_features", "weight"])

    scored = source.mapInArrow(weigh, f"{schema}, n_words long, n_features long, weight long")
    name = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("k").cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")
    return scored.select("k", *[F.col(f"c{i}") for i in range(len(keep))], "n_words", "n_features", "weight",
                         (F.col("weight") + noise).alias("score"))


def _entry(score, key, seat):
    """A row's place in the order: high scores first, then small keys, null
    keys last, then the row's number."""
    return -score, key is None, key, seat


def find_splitters(rows: DataFrame, n: int, segments: int) -> list[tuple]:
    """Rows of ``rows`` (score, k, seat) that cut them into about equal parts."""
    order = [F.desc("score"), F.asc_nulls_last("k"), F.asc("seat")]
    kind = rows.schema["k"].dataType.simpleString()

    def every(step):
        def take(batches):
            at = 0
            for batch in batches:
                yield batch.take(pa.array(range(-at % step, batch.num_rows, step), pa.int64()))
                at += batch.num_rows
        return take

    def thin(df, step):
        return df.sortWithinPartitions(*order).mapInArrow(every(step), f"score long, k {kind}, seat long")

    samples = thin(rows.select("score", "k", "seat"), max(1, n // segments ** 2))
    return sorted(_entry(*r) for r in thin(samples.repartition(1), segments).collect())


def resample(docs: DataFrame, target: DataFrame, *, text: str = "text", key: str = "doc_id", target_text: str = "text",
             keep: Sequence[str] | None = None, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED,
             buckets: int = BUCKETS, segments: int | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (default all) with ``n_features``,
    ``weight``, ``score`` and ``rank``: 1, 2, 3, ... for the drawn ones, which
    are the ``percent`` of the documents of ``min_words`` words or more with the
    highest scores; null for the others.  Columns of these names are replaced.

    A null or empty text, and one without words, has no features and weight 0;
    a very long text is read whole.  Equal scores rank by key, null keys last
    (their noise is that of the key ``null``), rows that repeat both in any
    order.  An empty target favours rare features; an empty table gives an
    empty result."""
    spark = docs.sparkSession
    names = [c for c in (docs.columns if keep is None else keep) if c not in ("n_features", "weight", "score", "rank")]
    segments = segments or min(SEGMENTS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    gains = bucket_gains(bucket_counts(docs, text, buckets), bucket_counts(target, target_text, buckets))
    scored = score_documents(docs, gains, text=text, key=key, keep=names, seed=seed)
    rows = stage_table(scored.withColumn("seat", F.monotonically_increasing_id()), "scored")
    long_enough = rows.filter(F.col("n_words") >= min_words)
    n = long_enough.count()
    drawn = percent * n // 100
    splitters = find_splitters(long_enough, n, segments) if drawn else []
    first = np.array([s[0] for s in splitters])
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    at_score, at_key, at_seat, at_words = (rows.columns.index(c) for c in ("score", "k", "seat", "n_words"))

    def place(batches):
        for batch in batches:
            score = batch.column(at_score).to_numpy()
            low, high = (np.searchsorted(first, -score, side) for side in ("left", "right"))
            for i in np.flatnonzero(low != high):  # a splitter has this score
                low[i] = bisect.bisect_right(splitters, _entry(int(score[i]), batch.column(at_key)[i].as_py(), batch.column(at_seat)[i].as_py()))
            short = batch.column(at_words).to_numpy() < min_words
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(low.astype(np.int32), mask=short)], names=[*batch.schema.names, "segment"])

    placed = rows.mapInArrow(place, f"{schema}, segment int")
    sizes = {r["segment"]: r["many"] for r in placed.filter("segment is not null").groupBy("segment").agg(
        F.count("*").alias("many")).collect()} if drawn else {}
    before, moved = [0], 0
    for s in range(len(splitters) + 1):
        moved += before[s] < drawn
        before.append(before[s] + sizes.get(s, 0))
    inside = Window.partitionBy("segment").orderBy(F.desc("score"), F.asc_nulls_last("k"), F.asc("seat"))
    offset = F.element_at(F.lit(before[:moved] or [0]), F.col("segment") + 1)
    rank = F.row_number().over(inside) + offset
    near = placed.filter(F.col("segment") < moved).withColumn("rank", F.when(rank <= drawn, rank).cast("long"))
    far = placed.filter(F.col("segment").isNull() | (F.col("segment") >= moved)).withColumn("rank", F.lit(None).cast("long"))
    return near.unionByName(far).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], "n_features", "weight", "score", "rank")
