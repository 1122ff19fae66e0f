"""N-gram Jaccard join with an R-tree over count vectors.

A document's set holds its distinct shingles.  Two sets are linked when
``100 * intersection >= percent * union``; the join is exact.

* Counts.  Shingles are hashed into groups, more for a larger set; a set's group
  counts are a point.  The intersection of two sets is at most the sum over the groups of
  the smaller count, and of a set and a box of points at most the sum of the
  minima with the box's upper corner.
* Blocks.  With shingles in one fixed order, sets of similarity t share one of
  their first ``n - ceil(t n) + 1``; the order puts rare ones first, by a
  table of counts over all documents with ``CELLS`` places.  A wrong count makes
  a block larger, never a result wrong.
* Search.  The blocks of one centre are a group (:mod:`panelscope.llm.linking`).
  Its points are indexed by an R-tree, loaded by halving at the median of the
  widest coordinate.  Every point searches it, first on the counts alone: who
  finds nobody leaves before a text is moved, and the others are joined into
  families.  Then again within a family with the texts, and the pairs that
  survive the bound are verified on the full sets.
* Equal sets are one node.  Pairs that a chain of links connects already are
  not verified again, and no pair becomes a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelscope.llm.common import U64, drop_stages, mix, stage_table, sum_arrays, texts_of
from panelscope.llm.linking import GROUP_ELEMENTS, GROUP_MEMBERS, Sets, by_group, link_blocks, shingle_sets
from panelscope.llm.near_dup import components

SHINGLE, THRESHOLD = 5, 0.8

#: Coordinates of the point of a small set, and places of the table of counts
#: (a task holds and sends 8 bytes for each).
GROUPS, CELLS = 64, 1 << 14

#: Elements to a coordinate at most: with n elements in G coordinates two
#: unrelated sets differ by about sqrt(n G), linked ones by 2 n / 9 at most.
SPREAD = 8

#: Points of a leaf and children of a box.
FANOUT = 16

#: Pairs of points that a task holds at a time.
PAIRS = 1 << 18


def group_counts(shingles: np.ndarray, groups: int | None = None) -> np.ndarray:
    """The point of a set: of ``GROUPS`` coordinates, or twice, four times, ...
    as many, so that no more than ``SPREAD`` elements fall to one on average."""
    if groups is None:
        groups = GROUPS
        while len(shingles) > SPREAD * groups:
            groups *= 2
    return np.bincount((shingles & U64(groups - 1)).astype(np.int64), minlength=groups).astype(np.int32)


def fold(point: np.ndarray, groups: int) -> np.ndarray:
    """The point of the same set in fewer groups."""
    return point.reshape(-1, groups).sum(axis=0, dtype=np.int32)


class CountTree:
    """An R-tree over points; ``search`` returns what the bound cannot rule out."""

    def __init__(self, points: np.ndarray, percent: int):
        self.points, self.size, self.percent = points, points.sum(axis=1), percent
        self.order = self._load(np.arange(len(points)))
        upper, low, high = points[self.order], self.size[self.order], self.size[self.order]
        self.levels = []
        while not self.levels or len(upper) > FANOUT:
            first = np.arange(0, len(upper), FANOUT)
            upper = np.maximum.reduceat(upper, first, axis=0)
            low, high = np.minimum.reduceat(low, first), np.maximum.reduceat(high, first)
            self.levels.append((upper, low, high))

    def _load(self, members: np.ndarray) -> np.ndarray:
        """The points in the order of the leaves."""
        done, todo = [], [members]
        while todo:
            part = todo.pop()
            if len(part) <= FANOUT:
                done.append(part)
                continue
            p = self.points[part]
            widest = np.argmax(p.max(axis=0) - p.min(axis=0))
            half = -(-len(part) // (2 * FANOUT)) * FANOUT
            part = part[np.argsort(p[:, widest], kind="stable")]
            todo += [part[half:], part[:half]]
        return np.concatenate(done)

    def _may(self, q: np.ndarray, upper: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        n = self.size[q]
        fits = (100 * high >= self.percent * n) & (100 * n >= self.percent * low)
        out = np.zeros(len(q), dtype=bool)
        at = np.flatnonzero(fits)
        for part in np.array_split(at, len(at) * self.points.shape[1] // (1 << 19) + 1):
            overlap = np.minimum(self.points[q[part]], upper[part]).sum(axis=1)
            out[part] = (100 + self.percent) * overlap >= self.percent * (n[part] + low[part])
        return out

    def search(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, point) numbers of all pairs within the bound, a point's own
        included."""
        boxes = len(self.levels[-1][0])
        q, box = np.repeat(queries, boxes), np.tile(np.arange(boxes), len(queries))
        for depth in range(len(self.levels) - 1, -1, -1):
            upper, low, high = self.levels[depth]
            keep = self._may(q, upper[box], low[box], high[box])
            q, box = q[keep], box[keep]
            below = len(self.levels[depth - 1][0]) if depth else len(self.order)
            q = np.repeat(q, FANOUT)
            box = (box[:, None] * FANOUT + np.arange(FANOUT)).ravel()
            q, box = q[box < below], box[box < below]
        point = self.order[box]
        keep = self._may(q, self.points[point], self.size[point], self.size[point])
        return q[keep], point[keep]

    def search_all(self, count: int | None = None, many: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """:meth:`search` for the first ``count`` points, some at a time: so
        many that no more than ``PAIRS`` are found, whatever the bound leaves."""
        count = len(self.points) if count is None else count
        many = max(PAIRS // len(self.points), 1) if many is None else many
        for at in range(0, count, many):
            yield self.search(np.arange(at, min(at + many, count)))


def candidate_pairs(points: list[np.ndarray], percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, j) places of all pairs within the bound, each pair once, in rising
    order of i within an array.  Points of one length share a tree, with those
    of longer ones that their size allows, folded."""
    length, size = np.array([len(p) for p in points]), np.array([p.sum() for p in points])
    for groups in np.unique(length):
        own = np.flatnonzero(length == groups)
        above = np.flatnonzero((length > groups) & (percent * size <= 100 * size[own].max()))
        members = np.concatenate([own, above])
        if len(members) < 2:
            continue
        tree = CountTree(np.array([fold(points[i], groups) for i in members]), percent)
        for q, point in tree.search_all(len(own)):
            keep = point > q  # the longer ones come after all own
            yield members[q[keep]], members[point[keep]]


def tree_links(sets: list[np.ndarray], percent: int) -> Iterator[tuple[int, int]]:
    """Links of a group, verified on the pairs that the tree's search leaves."""
    group = Sets(sets, percent)
    for q, point in candidate_pairs([group_counts(s) for s in sets], percent):
        edge = np.flatnonzero(np.concatenate(([True], q[1:] != q[:-1], [True]))) if len(q) else []
        for first, last in zip(edge[:-1], edge[1:]):
            yield from group.connect(q[first], point[first:last])


def candidate_families(groups: DataFrame, points: DataFrame, percent: int, group_members: int = GROUP_MEMBERS,
                       group_elements: int = GROUP_ELEMENTS) -> DataFrame:
    """(centre, node, n) groups of the nodes that find another by the search in
    their group (centre, node), on the counts alone.

    The candidate pairs of all groups are joined into families, so a node whose
    candidates meet in many groups is in one, and its text moves once.  Every
    pair that the bound leaves is inside a family.  A family beyond the bounds of
    a group stays in the parts found group by group."""
    kind = points.schema["node"].dataType.simpleString()
    rows = groups.drop("n").join(points, "node").select("centre", "node", "n", "counts")

    def work(_, columns):
        nodes, n, counts = columns
        label = np.arange(len(nodes))
        for q, point in candidate_pairs([unpack(c) for c in counts], percent):
            while (label[q] != label[point]).any():  # every root goes to the smallest it meets, its members follow
                a, b = label[q], label[point]
                low = np.minimum(a, b)
                np.minimum.at(label, a, low)
                np.minimum.at(label, b, low)
                while (label[label] != label).any():
                    label = label[label]
        many = np.bincount(label, minlength=len(nodes))
        return [(nodes[label[i]], nodes[i], n[i]) for i in np.flatnonzero(many[label] > 1)]

    parts = stage_table(by_group(rows, work, f"centre {kind}, node {kind}, n bigint"), "candidates")
    comp = components(parts.select("centre", "node"), "families")
    whole = stage_table(parts.select("node", "n").distinct().join(comp, "node").select(F.col("comp").alias("centre"), "node", "n"), "families")
    large = whole.groupBy("centre").agg(F.count("*").alias("many"), F.sum("n").alias("elements")).filter(
        (F.col("many") > group_members) | (F.col("elements") > group_elements)).select("centre")
    broken = whole.join(large, "centre", "left_semi").select("node")
    return whole.join(large, "centre", "left_anti").unionByName(parts.join(broken, "node", "left_semi"))


#: Bits of the filter that a text's set passes before it is moved.
FILTER_BITS = 1 << 22


def _bits(names: list[bytes]) -> np.ndarray:
    """The two bits of each name."""
    return (np.frombuffer(b"".join(names), dtype=U64) % U64(FILTER_BITS)).astype(np.int64)


def name_filter(names: DataFrame) -> bytes:
    """A filter of fixed size that all of ``names`` pass, and others the less the
    fewer these are."""

    def mark(batches):
        out = np.zeros(FILTER_BITS, dtype=bool)
        for batch in batches:
            out[_bits(batch.column(0).to_pylist())] = True
        yield pa.RecordBatch.from_arrays([pa.array([np.packbits(out).tobytes()], pa.binary())], names=["bits"])

    def either(batches):
        out = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
        for batch in batches:
            for bits in batch.column(0):
                out |= np.frombuffer(bits.as_buffer(), dtype=np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], names=["bits"])

    marked = names.mapInArrow(mark, "bits binary").repartition(32).mapInArrow(either, "bits binary")
    return bytes(marked.repartition(1).mapInArrow(either, "bits binary").first()[0])


def shingle_cells(docs: DataFrame, text: str, shingle: int) -> np.ndarray:
    """How often the distinct shingles of all documents fall into each of
    ``CELLS`` places."""

    def count(batches):
        total = np.zeros(CELLS, dtype=np.int64)
        for batch in batches:
            for s in shingle_sets(texts_of(batch.column(0)), shingle):
                total += np.bincount((s >> U64(50)).astype(np.int64), minlength=CELLS)
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.int64()))], names=["cells"])

    total = sum_arrays(docs.select(text).mapInArrow(count, "cells array<bigint>"))
    return np.array(total or [0] * CELLS)


def set_name(shingles: np.ndarray) -> bytes | None:
    """128 bits that name a set; none for an empty one."""
    sums = np.array([mix(shingles).sum(dtype=U64), mix(shingles ^ U64(0x5851F42D4C957F2D)).sum(dtype=U64)])
    return mix(sums + U64(len(shingles))).tobytes() if len(shingles) else None


def named(docs: DataFrame, text: str, shingle: int, wanted: bytes | None = None) -> DataFrame:
    """``docs`` with ``n_shingles`` and ``name``, that of the row's set; with a
    filter ``wanted``, rows that pass it alone."""
    at = docs.columns.index(text)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def sign(batches):
        for batch in batches:
            sets = [(len(s), set_name(s)) for s in shingle_sets(texts_of(batch.column(at)), shingle)]
            if wanted is not None:
                bits = np.frombuffer(wanted, dtype=np.uint8)
                rows = [i for i, (n, _) in enumerate(sets) if n]
                place = _bits([sets[i][1] for i in rows]).reshape(-1, 2)
                rows = np.array(rows, dtype=np.int64)[(bits[place >> 3] >> (7 - (place & 7)) & 1).all(axis=1)]
                batch, sets = batch.take(pa.array(rows)), [sets[i] for i in rows]
            n, names = zip(*sets) if sets else ((), ())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n, pa.int64()), pa.array(names, pa.binary())],
                                             names=[*batch.schema.names, "n_shingles", "name"])

    return docs.mapInArrow(sign, f"{schema}, n_shingles long, name binary")


def pack(counts: np.ndarray) -> bytes:
    """A point as one byte a coordinate, or four where one is 256 or more, after
    a byte that says which."""
    return b"\1" + counts.astype(np.uint8).tobytes() if counts.max() < 256 else b"\4" + counts.astype(np.int32).tobytes()


def unpack(point: bytes) -> np.ndarray:
    return np.frombuffer(point[1:], dtype=np.uint8 if point[0] == 1 else np.int32).astype(np.int32)


def pack_tokens(tokens: np.ndarray) -> bytes:
    """The top six bytes of each token; two that share them share a block."""
    return np.ascontiguousarray((tokens >> U64(16)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def unpack_tokens(packed: list[bytes]) -> np.ndarray:
    wide = np.zeros((sum(map(len, packed)) // 6, 8), dtype=np.uint8)
    wide[:, :6] = np.frombuffer(b"".join(packed), dtype=np.uint8).reshape(-1, 6)
    return wide.view("<u8").ravel().astype(np.int64)


def meeting_tokens(unique: DataFrame) -> DataFrame:
    """(block, node) for the prefix tokens that two sets or more of ``unique``
    (node, prefix) have, most of them having one.

    Tasks deal packed tokens by range.  A receiving task lets a token's first
    owner go when the second comes and every other at once, so it holds each of
    its tokens once, however many sets have it."""
    parts = int(unique.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = 2 * parts

    def deal(batches):
        for batch in batches:
            every, packed = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            cuts = [0, *np.flatnonzero(np.abs(np.diff(every)) > 1 << 20) + 1, len(every)]
            rows = []
            for first, last in zip(cuts[:-1], cuts[1:]):
                if first == last:
                    continue
                node, base = every[first:last], every[first:last].min()
                small = np.uint16 if node.max() - base < 1 << 16 else np.int64
                token = unpack_tokens(packed[first:last])
                owner = np.repeat((node - base).astype(small), [len(p) // 6 for p in packed[first:last]])
                order = np.argsort(token)
                token, owner = token[order], owner[order]
                ends = np.searchsorted(token, [(b << 48) // buckets for b in range(buckets + 1)])
                six = np.frombuffer(pack_tokens(token.astype(U64) << U64(16)), dtype=np.uint8).reshape(-1, 6)
                rows += [(b, int(base), six[x:y].tobytes(), owner[x:y].tobytes())
                         for b, (x, y) in enumerate(zip(ends[:-1], ends[1:])) if x < y]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.binary(), pa.binary()))],
                                                 names=["bucket", "base", "tokens", "owners"])

    def meet(batches):
        seen = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)  # token, first owner, let go

        def sort_out(seen, fresh):
            token = np.concatenate([seen[0], *(t for t, _ in fresh)])
            node = np.concatenate([seen[1], *(n for _, n in fresh)])
            gone = np.concatenate([seen[2], np.zeros(len(token) - len(seen[0]), bool)])
            order = np.argsort(token, kind="stable")  # what was seen before leads
            token, node, gone = token[order], node[order], gone[order]
            lead = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
            many = np.diff(np.append(lead, len(token)))
            go = np.repeat(many > 1, many) & ~gone
            return (token[lead], node[lead], gone[lead] | (many > 1)), token[go], node[go]

        def out(token, node):
            return pa.RecordBatch.from_arrays([pa.array(token), pa.array(node)], names=["block", "node"])

        fresh, size = [], 0
        for batch in batches:
            for base, tokens, owners in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
                token = unpack_tokens([tokens])
                owner = np.frombuffer(owners, dtype=np.uint16 if len(owners) == 2 * len(token) else np.int64)
                fresh.append((token, owner.astype(np.int64) + base))
                size += len(token)
            if size > max(1 << 20, len(seen[0])):
                seen, token, node = sort_out(seen, fresh)
                fresh, size = [], 0
                yield out(token, node)
        if fresh:
            yield out(*sort_out(seen, fresh)[1:])

    dealt = unique.select("node", "prefix").mapInArrow(deal, "bucket int, base long, tokens binary, owners binary")
    return dealt.repartition(parts, "bucket").mapInArrow(meet, "block long, node long")


def points_and_prefixes(docs: DataFrame, text: str, key: str, shingle: int, percent: int) -> DataFrame:
    """(name, k, n, counts, prefix) of every row with a set: its key, size,
    packed point, and first shingles in the order of rarity, packed."""
    rank = np.argsort(np.argsort(shingle_cells(docs, text, shingle), kind="stable"), kind="stable").astype(np.uint32)
    kind = docs.schema[key].dataType.simpleString()

    def sign(batches):
        for batch in batches:
            rows, out = [], []
            for i, s in enumerate(shingle_sets(texts_of(batch.column(0)), shingle)):
                if len(s):
                    first = len(s) + percent * -len(s) // 100 + 1  # n - ceil(t n) + 1
                    rarest = s[np.lexsort((s, rank[(s >> U64(50)).astype(np.int64)]))[:first]]
                    rows.append(i)
                    out.append((set_name(s), len(s), pack(group_counts(s)), pack_tokens(rarest)))
            names, n, counts, prefixes = zip(*out) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.binary()), batch.column(1).take(pa.array(rows, pa.int64())), pa.array(n, pa.int64()),
                 pa.array(counts, pa.binary()), pa.array(prefixes, pa.binary())], names=["name", "k", "n", "counts", "prefix"])

    return docs.select(text, key).toDF("t", "k").mapInArrow(sign, f"name binary, k {kind}, n long, counts binary, prefix binary")


def jaccard_join(docs: DataFrame, *, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE,
                 threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``n_shingles`` (size of the set) and ``component_id``
    (smallest key that the row's links reach, its own included); columns of
    these names are replaced.

    A null text, an empty one and one without words have an empty set and are
    linked with nothing; a text of fewer words than a shingle is one shingle; a
    very long text is one set, whole.  Equal sets are linked.  A null key is
    larger than every other, so a row with a null key and no links, or links
    among null keys alone, has a null component.  Rows that repeat a key and
    text share a component.  An empty table gives an empty result."""
    percent = round(100 * threshold)
    names = [c for c in docs.columns if c not in ("n_shingles", "component_id")]
    body, own_key = f"c{names.index(text)}", f"c{names.index(key)}"
    docs = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(names)])
    # copies meet before the shuffle; a short number names each set from here on
    least = F.min(F.struct(F.col("k").isNull().alias("none"), F.col("k").alias("id"))).alias("least")
    unique = stage_table(points_and_prefixes(docs, body, own_key, shingle, percent).groupBy("name").agg(
        least, F.first("n").alias("n"), F.first(F.struct("counts", "prefix")).alias("s")).select(
        "name", "least", "n", "s.*").withColumn("node", F.monotonically_increasing_id()), "unique")
    points = unique.select("node", "n", "counts")

    def texts(nodes):
        some = stage_table(unique.select("node", "name").join(nodes, "node", "left_semi"), "wanted")
        bodies = named(docs.select(body), body, shingle, name_filter(some.select("name")))
        return some.join(bodies, "name").groupBy("node").agg(F.min(body).alias("body"))

    members = stage_table(meeting_tokens(unique), "members")
    links = link_blocks(members, texts, shingle, percent, tree_links, sizes=unique.select("node", "n"),
                        thin=lambda groups: candidate_families(groups, points, percent))
    comp = components(links)
    drop_stages(members)

    group = unique.select("node", "name", "least").join(comp, "node", "left").select("name", "least", F.coalesce("comp", "node").alias("comp"))
    lowest = group.groupBy("comp").agg(F.min("least").alias("lowest"))
    place = group.join(lowest, "comp").select("name", "lowest")
    out = named(docs, body, shingle).join(place, "name", "left")
    component = F.when(F.col("name").isNull(), F.col(own_key)).otherwise(F.col("lowest.id"))
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], "n_shingles", component.alias("component_id"))
