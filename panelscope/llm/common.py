"""Shared helpers: stage tables, and vectorised text hashing inside tasks.

Hashing works on the UTF-8 bytes of many texts at once.  A prefix polynomial
hash (mod 2**64, odd base, one 64-bit value per byte) gives the hash of any
byte range by one subtraction and one multiplication.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelscope.session import ensure_checkpoint_dir

#: A word, as every operator here reads it.
WORD = r"[^\x20\x09-\x0D]+"

#: Texts are hashed in slices of about this many bytes, so that a task's
#: arrays stay small however many rows an Arrow batch holds.
SLICE_BYTES = 1 << 20

U64 = np.uint64
_BASE = U64(0x9E3779B97F4A7C15)


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the cluster's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/panelscope-llm/{name}-{uuid.uuid4().hex}"


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: lineage ends
    there, and a lost executor costs a re-read of files."""
    spark = df.sparkSession
    path = stage_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stage_path = path
    return out


def drop_stages(*frames: DataFrame) -> None:
    """Delete the files of tables made by :func:`stage_table` that nothing will
    read again: only what has been written since may depend on them."""
    for df in frames:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.stage_path)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def utf8_bytes(text: str | Column) -> Column:
    """Length of a text in UTF-8 bytes (null: 0), as long."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def n_words(text: str | Column) -> Column:
    """Number of words of a text (null: 0), as long."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def unit_hash(*parts: Column, seed: int = 0) -> Column:
    """A uniform number in [0, 1) from md5 of the parts joined by ``:``; the
    same on every run, partitioning and engine.  Nulls read as ``null``."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("long") / F.lit(float(1 << 48))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


BYTE_VALUE = mix(np.arange(1, 257, dtype=U64) * _BASE)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Separators of letter runs: every ASCII byte that is no letter.
NOT_LETTER = np.array([b < 128 and not chr(b).isalpha() for b in range(256)])
#: Separators of runs of letters and digits.
NOT_ALNUM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_powers = np.ones(1, dtype=U64)
_inverse = np.ones(1, dtype=U64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse mod 2**64."""
    global _powers, _inverse
    if len(_powers) < n:
        size = max(n, 2 * SLICE_BYTES)
        steps = np.full(size, _BASE, dtype=U64)
        steps[0] = 1
        _powers = np.cumprod(steps, dtype=U64)
        steps[1:] = U64(pow(int(_BASE), -1, 1 << 64))
        _inverse = np.cumprod(steps, dtype=U64)
    return _powers[:n], _inverse[:n]


def prefix_hash(buf: np.ndarray) -> np.ndarray:
    """``h[i]``: hash of the first ``i`` bytes; see :func:`range_hash`."""
    p, _ = powers(len(buf))
    out = np.zeros(len(buf) + 1, dtype=U64)
    np.cumsum(BYTE_VALUE[buf] * p, out=out[1:])
    return out


def range_hash(h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the byte ranges [start, end)."""
    _, inv = powers(len(h))
    return mix((h[end] - h[start]) * inv[start])


def sum_arrays(df: DataFrame, parts: int = 32) -> list[int]:
    """The sum, place by place, of the one array<bigint> column of ``df`` (an
    empty list without rows).  Tasks add up what they read, row by row, in two
    steps, so the driver gets one row however many there are."""
    name = df.columns[0]

    def add(batches):
        total = None
        for batch in batches:
            for row in batch.column(0):
                values = row.values.to_numpy(zero_copy_only=False)
                total = values.astype(np.int64) if total is None else total + values
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.int64()))], names=[name])

    schema = f"{name} array<bigint>"
    rows = df.repartition(parts).mapInArrow(add, schema).repartition(1).mapInArrow(add, schema).collect()
    return list(rows[0][0]) if rows else []


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null reads as empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def slices(texts: list[bytes], limit: int = SLICE_BYTES):
    """Ranges of row numbers whose texts hold about ``limit`` bytes together;
    a longer text is a range of its own."""
    first = size = 0
    for i, t in enumerate(texts):
        if i > first and size + len(t) > limit:
            yield first, i
            first, size = i, 0
        size += len(t) + 1
    if first < len(texts):
        yield first, len(texts)


def word_edges(texts: list[bytes], lower: bool = True, separator: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The joined bytes of a few texts, and where their words start and end."""
    buf = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    if lower:
        buf = _LOWER[buf]
    space = separator[buf]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        edge = np.concatenate(([0], edge))
    return buf, edge[0::2], edge[1::2]


class Words:
    """The words of a few texts, hashed: ``hash``, ``start`` and ``end`` (bytes
    in the joined buffer) of every word, and ``offset`` (len + 1) of each text's
    first word."""

    def __init__(self, texts: list[bytes], lower: bool = True, separator: np.ndarray = _SPACE):
        self.buf, self.start, self.end = word_edges(texts, lower, separator)
        self.prefix = prefix_hash(self.buf)
        self.hash = range_hash(self.prefix, self.start, self.end) if len(self.start) else np.zeros(0, U64)
        self.text_start = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
        self.offset = np.searchsorted(self.start, self.text_start)

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of ``k`` words, and for each text the offset
        (len + 1) of its first; a text of 1 to k - 1 words has one run, all
        its words."""
        n = np.diff(self.offset)
        count = np.where(n >= k, n - k + 1, np.minimum(n, 1))
        offset = np.concatenate(([0], np.cumsum(count)))
        if not offset[-1]:
            return np.zeros(0, U64), offset
        # first word of every run
        at = np.arange(offset[-1]) + np.repeat(self.offset[:-1] - offset[:-1], count)
        width = np.repeat(np.minimum(n, k), count)
        padded = np.concatenate((self.hash, np.zeros(k, U64)))
        value = width.astype(U64) * _BASE
        for j in range(k):
            value = value * _BASE + np.where(j < width, padded[at + j], U64(0))
        return mix(value), offset
