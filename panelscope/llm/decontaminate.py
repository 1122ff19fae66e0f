"""Benchmark decontamination by greedy string tiling.

Documents and test items that share seeds, runs of a few words, meet inside
the task that reads the document.  For each such pair the longest run of words
common to both, not yet marked in either, is found by Karp-Rabin hashes of
running windows (binary search over the length) and marked; this repeats until
no common run of a seed's length is left.  The marked share of the item is its
coverage: passages in another order, or cut apart, still cover it.  A seed has
``min_match`` words, fewer for short items (:func:`seed_words`).

The items travel to the tasks in blocks of about ``block_bytes``, one after
another: all documents are held against a block, and before the next one they
are written to the shared folder with what they leak, and the block is
released.  So the driver and a task hold one block at a time, whatever the
number of items.  Documents are never shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelscope.llm.common import NOT_ALNUM, U64, Words, drop_stages, mix, slices, stage_table, texts_of, utf8_bytes

MIN_MATCH, THRESHOLD, BLOCK_BYTES = 5, 0.8, 8 << 20
MATCH = "struct<item_id:bigint,item_words:bigint,covered_words:bigint,n_tiles:bigint,coverage:double>"

_WORD_BASE = 0xC2B2AE3D27D4EB4F


def seed_words(n: int, min_match: int = MIN_MATCH) -> int:
    """Words of a seed of an item of ``n`` words: ``min_match``; an item of
    2 * ``min_match`` words or fewer has one run as a seed if it is shorter than
    that; in between a fifth of the item, 3 at least, so that one changed word
    in a short item does not hide its neighbours."""
    if n <= 2 * min_match:
        return min(n, min_match)
    return min(min_match, max(3, n // 5))


def normal_words(texts: list[bytes]) -> Words:
    """Words as test items are compared: runs of letters and digits in lower
    case, so punctuation and capitals hide nothing."""
    return Words([t.decode("utf-8", "replace").lower().encode() for t in texts], separator=NOT_ALNUM)


class Windows:
    """Karp-Rabin hashes of all windows of a word sequence."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        power = np.ones(n + 1, dtype=U64)
        power[1:] = np.cumprod(np.full(n, _WORD_BASE, dtype=U64), dtype=U64)
        inverse = np.ones(n + 1, dtype=U64)
        inverse[1:] = np.cumprod(np.full(n, pow(_WORD_BASE, -1, 1 << 64), dtype=U64), dtype=U64)
        self.words, self.inverse = words, inverse
        self.sums = np.zeros(n + 1, dtype=U64)
        np.cumsum(words * power[:n], out=self.sums[1:])
        self.marked = np.zeros(n, dtype=bool)

    def free(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and places of the windows of ``size`` words without a mark."""
        count = len(self.words) - size + 1
        if count <= 0:
            return np.zeros(0, U64), np.zeros(0, np.int64)
        taken = np.concatenate(([0], np.cumsum(self.marked)))
        at = np.flatnonzero(taken[size:] == taken[:count])
        return mix((self.sums[at + size] - self.sums[at]) * self.inverse[at]), at


def common_runs(a: Windows, b: Windows, size: int) -> list[tuple[int, int]]:
    """Places of equal unmarked windows of ``size`` words, the first of each."""
    ha, pa_ = a.free(size)
    hb, pb = b.free(size)
    _, ia, ib = np.intersect1d(ha, hb, return_indices=True)
    pairs = sorted(zip(pa_[ia].tolist(), pb[ib].tolist()))
    return [(i, j) for i, j in pairs if np.array_equal(a.words[i:i + size], b.words[j:j + size])]


def tiles(item: np.ndarray, doc: np.ndarray, min_match: int) -> list[tuple[int, int, int]]:
    """Greedy tiling of two word sequences: (place in item, in doc, length),
    longest first, then by place."""
    a, b = Windows(item), Windows(doc)
    out: list[tuple[int, int, int]] = []
    longest = min(len(item), len(doc))
    while True:
        low, high, best = min_match, longest, []
        while low <= high:  # a common run of n words holds one of n - 1
            size = (low + high) // 2
            if found := common_runs(a, b, size):
                low, best, length = size + 1, found, size
            else:
                high = size - 1
        if not best:
            return out
        longest = length
        for i, j in best:
            if not a.marked[i:i + length].any() and not b.marked[j:j + length].any():
                a.marked[i:i + length] = b.marked[j:j + length] = True
                out.append((i, j, length))


class Items:
    """A block of test items with an index of their seeds."""

    def __init__(self, rows: list[tuple[int | None, str | None]], min_match: int):
        rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, r[0], r[1]))
        w = normal_words([t.encode() for _, t in rows])
        self.ids = [i for i, _ in rows]
        self.words = [w.hash[w.offset[i]:w.offset[i + 1]] for i in range(len(rows))]
        self.seeds = {}
        size = np.array([seed_words(len(x), min_match) for x in self.words], dtype=np.int64)
        for k in sorted(set(size.tolist()) - {0}):
            values, offset = w.shingles(k)
            owner = np.repeat(np.arange(len(rows)), np.diff(offset))
            mine = (size == k)[owner]
            place = np.arange(len(values)) - offset[owner]
            order = np.lexsort((place[mine], owner[mine], values[mine]))
            self.seeds[k] = (values[mine][order], owner[mine][order], place[mine][order])

    def matches(self, words: Words, threshold: float) -> list[list[tuple]]:
        """For each text the items it covers to ``threshold`` or more."""
        out = [[] for _ in range(len(words.offset) - 1)]
        for k, (seeds, owner, place) in self.seeds.items():
            values, offset = words.shingles(k)
            first = np.searchsorted(seeds, values)
            hit = np.flatnonzero(seeds[np.minimum(first, len(seeds) - 1)] == values)
            if not len(hit):
                continue
            count = np.searchsorted(seeds, values[hit], side="right") - first[hit]
            at = np.repeat(first[hit], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            text = np.repeat(np.searchsorted(offset, hit, side="right") - 1, count)
            where = np.repeat(hit, count) - offset[text]
            order = np.lexsort((where, owner[at], text))
            text, at, where = text[order], at[order], where[order]
            group = np.flatnonzero(np.concatenate(([True], (text[1:] != text[:-1]) | (owner[at][1:] != owner[at][:-1]))))
            for lo, hi in zip(group, np.append(group[1:], len(text))):
                t, item = int(text[lo]), int(owner[at[lo]])
                found = self._cover(item, k, place[at[lo:hi]], np.unique(where[lo:hi]),
                                    words.hash[words.offset[t]:words.offset[t + 1]], threshold)
                if found:
                    out[t].append(found)
        return [sorted(x, key=lambda m: (m[0] is not None, m[0] or 0)) for x in out]

    def _cover(self, item: int, k: int, places, wheres, doc, threshold):
        target = self.words[item]
        seeded = np.zeros(len(target) + 1, dtype=np.int64)
        np.add.at(seeded, places, 1)
        np.add.at(seeded, places + k, -1)
        # tiles consist of seeds: no tiling covers more than the seeds do
        if np.count_nonzero(np.cumsum(seeded)[:-1]) < threshold * len(target):
            return None
        # the stretches of the text that are covered by seeds, kept apart
        cut = np.flatnonzero(np.diff(wheres) > k)
        starts, ends = wheres[np.append(0, cut + 1)], wheres[np.append(cut, len(wheres) - 1)] + k
        parts = []
        for n, (s, e) in enumerate(zip(starts, ends)):
            parts += [doc[s:e], mix(np.array([n + 1], dtype=U64) << U64(33))]
        found = tiles(target, np.concatenate(parts), k)
        covered = sum(n for _, _, n in found)
        if covered < threshold * len(target):
            return None
        return self.ids[item], len(target), covered, len(found), covered / len(target)


def blocks_of(items: DataFrame, block_bytes: int):
    """The test items in blocks of about ``block_bytes``, one after another."""
    total = items.agg(F.coalesce(F.sum(utf8_bytes("text") + 16), F.lit(0))).first()[0]
    n = max(1, -(-total // block_bytes))
    rows = items.select(F.col("item_id").cast("long"), "text")
    for i in range(n):
        mine = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i)
        yield [tuple(r) for r in mine.collect()]


def find_leaks(docs: DataFrame, items: DataFrame, *, text: str = "text", min_match: int = MIN_MATCH,
               threshold: float = THRESHOLD, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with ``leaks``: an array of (item_id, item_words,
    covered_words, n_tiles, coverage), sorted, of the test items (item_id,
    text) whose words the document covers to ``threshold`` or more; a column of
    that name is replaced.

    A null or empty text, or an item without words, matches nothing; an item of
    fewer than ``min_match`` words must be covered by one run.  Very long texts
    are read whole.  Repeated items are reported each.  Empty tables give no
    leaks.  What covers less than ``threshold``, or lies in runs shorter than a
    seed, is not found."""
    names = [c for c in docs.columns if c != "leaks"]
    at = names.index(text)
    out = docs.select(*names).toDF(*[f"c{i}" for i in range(len(names))])
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in out.schema)
    out = out.withColumn("leaks", F.array().cast(f"array<{MATCH}>"))
    fields = ["item_id", "item_words", "covered_words", "n_tiles", "coverage"]
    kind = pa.list_(pa.struct([(f, pa.int64()) for f in fields[:4]] + [("coverage", pa.float64())]))
    shared = written = None
    for block in blocks_of(items, block_bytes):
        if shared is not None:
            # what the block before found is written, then its items go
            last, written = written, stage_table(out, "leaks")
            shared.destroy()
            if last is not None:
                drop_stages(last)
            out = written
        shared = docs.sparkSession.sparkContext.broadcast(block)  # about block_bytes

        def tile(batches, shared=shared):
            index = Items(shared.value, min_match)
            for batch in batches:
                texts, found = texts_of(batch.column(at)), batch.column(len(names)).to_pylist()
                for first, last in slices(texts):
                    for i, more in enumerate(index.matches(normal_words(texts[first:last]), threshold)):
                        if more:
                            leaks = (found[first + i] or []) + [dict(zip(fields, m)) for m in more]
                            found[first + i] = sorted(leaks, key=lambda m: (m["item_id"] is not None, m["item_id"] or 0))
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, kind)], names=batch.schema.names)

        out = out.mapInArrow(tile, f"{schema}, leaks array<{MATCH}>")
    return out.toDF(*names, "leaks")
