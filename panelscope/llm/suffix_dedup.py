"""Exact substring dedup by hash-compared suffix sorting.

A byte goes when a string of ``length`` bytes that covers it also starts at
another place, in this or any other document.

1. Anchors.  Every window of ``length`` bytes has an anchor, its k-gram of
   smallest hash (the first of them).  Equal windows have equal anchors at
   equal places, so a repeated window lies at a repeated anchor.  Neighbouring
   windows share anchors: the windows of one anchor are one run.
2. Runs whose anchor occurs once hold no repeated window.  Runs that occur
   again as a whole (same anchor, same bytes) are repeated throughout.
3. What is left are runs that agree in part.  The distinct runs of an anchor
   are laid side by side at the anchor and sorted twice: by the suffix that
   starts at the anchor, and by the text before it, read backwards.  Two
   suffixes are compared by their longest common extension, found by binary
   search over prefix polynomial hashes, in a mergesort; the extensions of
   neighbours are verified on the bytes.  A window with l bytes before its
   anchor is repeated when another run shares l bytes to the left and
   ``length - l`` to the right, which is a look at the two orders.
4. An anchor with more distinct runs than ``group_rows`` is cut by content.
   The number of bytes before the anchor is cut at fixed places in halves, a
   run's windows go to their halves, and all windows of a half hold the same
   stretch around the anchor.  That stretch names the new group: equal windows
   stay together, and a run whose stretch reaches into text of its own is
   alone.  Halves that are still too large are halved again; in the last step
   a half is one window and its stretch the whole of it.

Counting is pre-aggregated in every task, and no step gathers all places of an
anchor.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelscope.llm.common import U64, drop_stages, mix, prefix_hash, range_hash, slices, stage_table, texts_of

LENGTH, GROUP_ROWS = 200, 2048

#: Texts are cut into chunks of this many windows; positions in a chunk take 20 bits.
CHUNK = 1 << 18


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    out, size = values, 1
    while 2 * size <= width:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    rest = width - size
    return np.minimum(out[:len(out) - rest], out[rest:]) if rest else out


def find_runs(texts: list[bytes], length: int):
    """Runs of windows with one anchor: arrays (text, first window, number of
    windows, anchor's offset in the run, anchor's hash, hash of the run's
    bytes)."""
    k = max(1, length // 4)
    pieces, owner, base = [], [], []
    for i, t in enumerate(texts):
        for at in range(0, max(len(t) - length + 1, 0), CHUNK):
            pieces.append(t[at:at + CHUNK + length - 1])
            owner.append(i)
            base.append(at)
    owner, base = np.array(owner, dtype=np.int64), np.array(base, dtype=np.int64)
    out = []
    for first, last in slices(pieces, CHUNK + length):
        buf = np.frombuffer(b"".join(pieces[first:last]), dtype=np.uint8)
        n = len(buf) - length + 1
        edge = np.concatenate(([0], np.cumsum([len(p) for p in pieces[first:last]])))
        h = prefix_hash(buf)
        place = np.arange(len(buf) - k + 1)
        gram = range_hash(h, place, place + k)
        low = U64((1 << 20) - 1)
        anchor = (_sliding_min((gram & ~low) | place.astype(U64), length - k + 1) & low).astype(np.int64)
        piece = np.repeat(np.arange(last - first), np.diff(edge))[:n]
        whole = np.zeros(len(buf), dtype=bool)  # windows inside one piece
        for a, b in zip(edge[:-1], edge[1:]):
            whole[a:b - length + 1] = True
        change = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (piece[1:] != piece[:-1]) | (whole[1:n] != whole[:n - 1]))))
        end = np.append(change[1:], n)
        start, end = change[whole[change]], end[whole[change]]
        mine = piece[start] + first
        out.append((owner[mine], start - edge[piece[start]] + base[mine], end - start,
                    anchor[start] - start, gram[anchor[start]], range_hash(h, start, end - 1 + length)))
    if not out:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, U64, U64))
    return tuple(np.concatenate(c) for c in zip(*out))


def anchors(texts: DataFrame, length: int) -> DataFrame:
    """(k1, k2, start, windows, offset, anchor, run) for every run of ``texts``
    (k1, k2, body)."""

    def emit(batches):
        for batch in batches:
            body = texts_of(batch.column(2))
            k1, k2 = (batch.column(i).to_numpy() for i in (0, 1))
            for first, last in slices(body, 4 << 20):
                who, start, windows, offset, anchor, run = find_runs(body[first:last], length)
                yield pa.RecordBatch.from_arrays([
                    pa.array(k1[first + who]), pa.array(k2[first + who]), pa.array(start, pa.int32()),
                    pa.array(windows, pa.int16()), pa.array(offset, pa.int16()),
                    pa.array(anchor.view(np.int64)), pa.array(run.view(np.int64))],
                    names=["k1", "k2", "start", "windows", "offset", "anchor", "run"])

    return texts.select("k1", "k2", "body").mapInArrow(
        emit, "k1 long, k2 short, start int, windows short, offset short, anchor long, run long")


class Suffixes:
    """Suffixes of byte strings in one buffer: suffix i starts at ``start[i]``
    and ends at ``end[i]``.  ``group`` keeps suffixes of different anchors
    apart."""

    def __init__(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray, group: np.ndarray):
        self.buf, self.start, self.end, self.group = buf, start, end, group
        self.hash = prefix_hash(buf)

    def extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the longest common extension of suffixes a and b, by
        binary search over the prefix hashes."""
        low = np.zeros(len(a), dtype=np.int64)
        high = np.minimum(self.end[a] - self.start[a], self.end[b] - self.start[b])
        sa, sb = self.start[a], self.start[b]
        while (open_ := low < high).any():
            mid = np.where(open_, (low + high + 1) // 2, low)
            same = range_hash(self.hash, sa, sa + mid) == range_hash(self.hash, sb, sb + mid)
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low

    def less(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether suffix a sorts before suffix b (by group, bytes, number)."""
        n = self.extension(a, b)
        ea, eb = self.start[a] + n, self.start[b] + n
        ca = np.where(ea < self.end[a], self.buf[np.minimum(ea, len(self.buf) - 1)].astype(np.int64), -1)
        cb = np.where(eb < self.end[b], self.buf[np.minimum(eb, len(self.buf) - 1)].astype(np.int64), -1)
        by_text = np.where(ca != cb, ca < cb, a < b)
        return np.where(self.group[a] != self.group[b], self.group[a] < self.group[b], by_text)

    def sort(self) -> np.ndarray:
        """Mergesort: all runs of a width are merged at once; the place of an
        element is its own plus its rank in the sibling run."""
        n = len(self.start)
        order, width = np.arange(n), 1
        while width < n:
            at = np.arange(n)
            sibling = (at // width) ^ 1
            low = np.minimum(sibling * width, n)
            first = low.copy()
            high = np.minimum(low + width, n)
            while (open_ := low < high).any():
                i = np.flatnonzero(open_)
                mid = (low[i] + high[i]) // 2
                before = self.less(order[mid], order[at[i]])
                low[i] = np.where(before, mid + 1, low[i])
                high[i] = np.where(before, high[i], mid)
            merged = np.empty(n, dtype=np.int64)
            merged[np.minimum(at // width * width, first) + at % width + (low - first)] = order
            order, width = merged, 2 * width
        return order

    def neighbours(self, order: np.ndarray) -> np.ndarray:
        """Common extension of each suffix in ``order`` with the one before it
        (0 across groups), verified on the bytes."""
        a, b = order[:-1], order[1:]
        n = np.where(self.group[a] == self.group[b], self.extension(a, b), 0)
        total = int(n.sum())
        if total:
            pair = np.repeat(np.arange(len(n)), n)
            step = np.arange(total) - np.repeat(np.cumsum(n) - n, n)
            wrong = self.buf[self.start[a][pair] + step] != self.buf[self.start[b][pair] + step]
            if wrong.any():  # a hash collision: the extension ends before it
                np.minimum.at(n, pair[wrong], step[wrong])
        return np.concatenate(([0], n))


def repeated_windows(runs: list[bytes], windows: np.ndarray, offset: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """Which windows of each run start in another run of its group too:
    a matrix over (run, bytes before the anchor).  Runs of a group differ, but
    a run may share any of its windows with others."""
    size = np.array([len(r) for r in runs])
    stop = np.cumsum(size)
    buf = np.frombuffer(b"".join(runs), dtype=np.uint8)
    at = stop - size + offset
    right = Suffixes(buf, at, stop, group)
    # the text before the anchor, backwards: the buffer reversed
    left = Suffixes(buf[::-1].copy(), len(buf) - at, len(buf) - at + offset, group)
    order = {}
    for name, s in (("right", right), ("left", left)):
        o = s.sort()
        order[name] = (o, s.neighbours(o))
    most = int(offset.max()) + 1
    out = np.zeros((len(runs), most), dtype=bool)
    for before in range(most):
        has = (before <= offset) & (before > offset - windows)
        if has.sum() < 2:
            continue
        block = []
        for name, need in (("right", length - before), ("left", before)):
            o, shared = order[name]
            b = np.empty(len(runs), dtype=np.int64)
            b[o] = np.cumsum((shared < need) | np.concatenate(([True], group[o][1:] != group[o][:-1])))
            block.append(b)
        member = np.flatnonzero(has)
        _, inverse, count = np.unique(block[0][member] * (len(runs) + 1) + block[1][member], return_inverse=True, return_counts=True)
        out[member[count[inverse] > 1], before] = True
    return out


def _sort_groups(length: int, batch_rows: int = 4096):
    """A task function over runs sorted by anchor: ranges of repeated windows
    of the runs that occur once."""

    def work(t: pa.Table):
        anchor, single = (t.column(c).to_numpy() for c in ("anchor", "single"))
        runs = t.column("bytes").to_pylist()
        start, windows, offset, k1, k2 = (t.column(c).to_numpy().astype(np.int64) for c in ("start", "windows", "offset", "k1", "k2"))
        group = np.cumsum(np.concatenate(([0], anchor[1:] != anchor[:-1])))
        found = repeated_windows(runs, windows, offset, group, length) & single[:, None]
        edge = np.diff(np.pad(found, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        i, hi = np.nonzero(edge == -1)
        _, lo = np.nonzero(edge == 1)
        # more bytes before the anchor: an earlier window
        first, last = start[i] + offset[i] - (hi - 1), start[i] + offset[i] - lo
        return pa.RecordBatch.from_arrays(
            [pa.array(k1[i]), pa.array(k2[i], pa.int16()), pa.array(first, pa.int32()), pa.array(last, pa.int32())],
            names=["k1", "k2", "first", "last"])

    def run(batches):
        held: pa.Table | None = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            held = t if held is None else pa.concat_tables([held, t])
            if len(held) >= batch_rows:
                a = held.column("anchor").to_numpy()
                cut = len(a) - int(np.argmax(np.append(a[::-1] != a[-1], True)))
                if 0 < cut:
                    for lo, hi in _even_cuts(a[:cut], batch_rows):
                        yield work(held.slice(lo, hi - lo))
                    held = held.slice(cut)
        if held is not None and len(held):
            for lo, hi in _even_cuts(held.column("anchor").to_numpy(), batch_rows):
                yield work(held.slice(lo, hi - lo))

    return run


def _even_cuts(anchor: np.ndarray, rows: int):
    """Ranges of about ``rows`` rows that keep the groups whole."""
    edge = np.flatnonzero(np.append(anchor[1:] != anchor[:-1], True)) + 1
    first = 0
    for e in edge.tolist():
        if e - first >= rows or e == len(anchor):
            yield first, e
            first = e


#: A run with its bytes; ``single``: it occurs once, so its windows are asked for.
PIECE = "k1 long, k2 short, start int, windows short, offset short, anchor long, single boolean, bytes binary"
PIECE_SCHEMA = pa.schema([("k1", pa.int64()), ("k2", pa.int16()), ("start", pa.int32()), ("windows", pa.int16()),
                          ("offset", pa.int16()), ("anchor", pa.int64()), ("single", pa.bool_()), ("bytes", pa.binary())])


def split_runs(length: int, width: int):
    """A task function that cuts runs by the number of bytes before the anchor,
    in cells of ``width`` numbers.  What all windows of a cell share names the
    group of the part, with the anchor and the cell; ``run`` is the hash of the
    part."""
    most = length - max(1, length // 4)

    def run(batches):
        for batch in batches:
            runs = batch.column(7).to_pylist()
            for lo, hi in slices(runs):
                yield cut(batch.slice(lo, hi - lo), runs[lo:hi])

    def cut(batch, runs):
        k1, k2, start, windows, offset, anchor = (batch.column(c).to_numpy().astype(np.int64) for c in range(6))
        single = batch.column(6).to_numpy(zero_copy_only=False)
        joined = b"".join(runs)
        h = prefix_hash(np.frombuffer(joined, dtype=np.uint8))
        size = np.array([len(r) for r in runs], dtype=np.int64)
        at = np.cumsum(size) - size + offset
        low = offset - windows + 1
        count = offset // width - low // width + 1
        i = np.repeat(np.arange(len(runs)), count)
        cell = (low // width)[i] + np.arange(len(i)) - np.repeat(np.cumsum(count) - count, count)
        floor, top = cell * width, np.minimum(cell * width + width - 1, most)
        # the windows of the part have `less` to `more` bytes before the anchor
        less, more = np.maximum(low[i], floor), np.minimum(offset[i], top)
        at, i64 = at[i], U64(1) << U64(20)
        shared = range_hash(h, at - floor, at + length - top)
        first, end = at - more, at + length - less
        key = mix(mix(shared + cell.astype(U64) * i64) ^ mix(anchor[i].astype(U64) + U64(width)))
        part = mix(range_hash(h, first, end) + (more * (most + 1) + less).astype(U64) * i64)
        return pa.RecordBatch.from_arrays([
            pa.array(k1[i]), pa.array(k2[i], pa.int16()), pa.array(start[i] + offset[i] - more, pa.int32()),
            pa.array(more - less + 1, pa.int16()), pa.array(more, pa.int16()), pa.array(key.view(np.int64)), pa.array(single[i]),
            pa.array([joined[a:b] for a, b in zip(first.tolist(), end.tolist())], pa.binary()), pa.array(part.view(np.int64))],
            names=[*PIECE_SCHEMA.names, "run"])

    return run


def _to_compare(runs: DataFrame) -> DataFrame:
    """(anchor, distinct_runs) of the groups of ``runs`` (anchor, single) that
    hold a run that occurs once and another to share windows with."""
    stat = runs.groupBy("anchor").agg(F.count("*").alias("distinct_runs"), F.count_if("single").alias("singles"))
    return stat.filter("distinct_runs > 1 and singles > 0").select("anchor", "distinct_runs")


def cut_large(large: DataFrame, length: int, group_rows: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """The runs of large groups, cut by content until no group has more than
    ``group_rows`` runs: pieces to sort, and ranges (k1, k2, first, last) of
    parts that occur again as a whole."""
    small, whole = [], []
    width = 1 << (length - max(1, length // 4)).bit_length()
    place = F.struct("k1", "k2", "start", "windows", "offset", "bytes")
    while width > 1 and not large.isEmpty():
        width //= 2
        parts = stage_table(large.select(*PIECE_SCHEMA.names).mapInArrow(split_runs(length, width), f"{PIECE}, run long"), "parts")
        # one row for each distinct part; a part that occurs again is settled and stays as a partner
        runs = stage_table(parts.groupBy("anchor", "run").agg(
            F.count("*").alias("n"), F.min(place).alias("place"), F.bool_or("single").alias("asked")).select(
            "place.*", "anchor", "run", "n", F.expr("n = 1 and asked").alias("single")), "part-runs")
        whole.append(parts.filter("single").join(runs.filter("n > 1").select("anchor", "run"), ["anchor", "run"]).select(
            "k1", "k2", F.col("start").alias("first"), (F.col("start") + F.col("windows") - 1).alias("last")))
        asked = runs.join(_to_compare(runs), "anchor")
        small.append(asked.filter(F.col("distinct_runs") <= group_rows).select(*PIECE_SCHEMA.names))
        large = asked.filter(F.col("distinct_runs") > group_rows)
    return small, whole


def remove_repeats(docs: DataFrame, length: int = LENGTH, *, text: str = "text", group_rows: int = GROUP_ROWS) -> DataFrame:
    """``docs`` with ``spans`` (array of start and end, the maximal removed
    runs in UTF-8 bytes) and ``kept`` (the remaining bytes, joined); columns of
    these names are replaced.

    A null text is an empty one; texts shorter than ``length`` keep all; equal
    texts of ``length`` or more go entirely, every copy of them.  An empty table
    gives an empty result."""
    names = [c for c in docs.columns if c not in ("spans", "kept")]
    body = f"c{names.index(text)}"
    rows = docs.select(*names).toDF(*[f"c{i}" for i in range(len(names))]).withColumns({
        "k1": F.xxhash64(F.coalesce(body, F.lit(""))),
        "k2": F.xxhash64(F.lit(1), F.coalesce(body, F.lit(""))).bitwiseAND(F.lit((1 << 15) - 1)).cast("short")})
    keys = ["k1", "k2"]

    a = stage_table(anchors(rows.select(*keys, F.col(body).alias("body")), length), "anchors")
    # staged, so that the join below reads two plain shuffles and can split a hot anchor
    again = stage_table(a.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor"), "again")
    # equal texts have equal runs: a row for each place, whatever its text's copies
    d = stage_table(a.join(again, "anchor"), "repeated-anchors")
    drop_stages(a, again)
    place = F.struct(*keys, "start", "windows", "offset")
    runs = d.groupBy("anchor", "run").agg(F.count("*").alias("n"), F.min(place).alias("place"))
    runs = stage_table(runs, "runs")
    whole = d.join(runs.filter("n > 1").select("anchor", "run"), ["anchor", "run"]).select(
        *keys, F.col("start").alias("first"), (F.col("start") + F.col("windows") - 1).alias("last"))

    stat = stage_table(_to_compare(runs.withColumn("single", F.col("n") == 1)), "groups")
    part = runs.join(stat.select("anchor"), "anchor").select("place.*", "anchor", (F.col("n") == 1).alias("single"))
    wanted = part.groupBy(*keys).agg(F.collect_list(F.struct("start", "windows", "offset", "anchor", "single")).alias("wanted"))

    def cut(batches):
        for batch in batches:
            texts = texts_of(batch.column(at))
            out = []
            for i, asked in enumerate(batch.column(len(names) + 2).to_pylist()):
                for w in asked:
                    out.append(w | {"k1": batch.column(len(names))[i].as_py(), "k2": batch.column(len(names) + 1)[i].as_py(),
                                    "bytes": texts[i][w["start"]:w["start"] + w["windows"] + length - 1]})
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=PIECE_SCHEMA)

    at = names.index(text)
    # all columns go along: the shuffle of the texts is the one of the last join
    pieces = rows.join(wanted, keys).select(*rows.columns, "wanted").mapInArrow(cut, PIECE)
    # copies of a text cut the same pieces
    pieces = pieces.dropDuplicates(["anchor", "k1", "k2", "start"])
    ranges = whole
    crowded = stat.filter(F.col("distinct_runs") > group_rows).select("anchor")
    if not crowded.isEmpty():
        pieces = stage_table(pieces, "pieces")
        small, settled = cut_large(pieces.join(crowded, "anchor", "left_semi"), length, group_rows)
        pieces = reduce(DataFrame.unionByName, small, pieces.join(crowded, "anchor", "left_anti"))
        ranges = reduce(DataFrame.unionByName, settled, ranges)
    shares = pieces.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(
        _sort_groups(length), "k1 long, k2 short, first int, last int")
    ranges = ranges.unionByName(shares)
    # a text's ranges are at most its bytes
    gone = ranges.groupBy(*keys).agg(F.collect_set(F.struct("first", "last")).alias("gone"))

    def strip(batches):
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            texts, spans, kept = texts_of(batch.column(at)), [], []
            for t, asked in zip(texts, batch.column(len(names)).to_pylist()):
                merged: list[list[int]] = []
                for g in sorted((g["first"], g["last"] + length) for g in asked or []):
                    if merged and g[0] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], g[1])
                    else:
                        merged.append(list(g))
                spans.append([{"start": s, "end": e} for s, e in merged])
                bounds = [0, *[x for m in merged for x in m], len(t)]
                kept.append(b"".join(t[bounds[i]:bounds[i + 1]] for i in range(0, len(bounds), 2)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(spans, kind), pa.array(kept, pa.binary())],
                                             names=[*batch.schema.names[:-1], "spans", "kept"])

    own = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.drop(*keys).schema)
    out = rows.join(gone, keys, "left").select(*[f"c{i}" for i in range(len(names))], "gone").mapInArrow(
        strip, f"{own}, spans array<struct<start:int,end:int>>, kept binary")
    return out.toDF(*names, "spans", "kept")
