"""Links between sets that share a block, without a row for any pair.

Candidate stages put sets into blocks; two sets that share a block are to be
linked if ``100 * intersection >= percent * union``.  All that is asked for is
which sets a chain of links joins.

Groups.  Every block names a centre; the blocks of one centre are one group, a
set of (centre, node) edges that are stars.  Two sets of one block are in the
group of its centre, so settling every group settles every block.

A group within the bounds is settled inside one task: the sets are compared,
what is connected already is passed over, and only links that join something
leave the task.

A larger group is split.  Write t for the threshold, C for the centre, and say
that a set of n elements keeps k of C's, has lost l and gained g against it.

* Sets linked with C are connected: of two such sets nothing is asked.
* A set outside the sizes ``t t |C|`` to ``|C| / (t t)`` can be linked only with
  sets on the same side of ``t |C|`` or ``|C| / t``; these are a block of the next
  round.  The others are compared with C, edge by edge, and what they lost and
  gained is no longer than their own texts.
* A set shares ``t n - k`` gained elements at least with whatever it is linked
  with.  It is far if that is more than half of them; it then shares one of any
  ``g - ceil(t n - k) + 1``, and the rarest in the group are taken.  These shares
  are blocks as well.
* Two sets that are not far are held against each other by what sets them apart
  from C alone: they share ``|C| - la - lb + |La & Lb| + |Ga & Gb|`` elements.
  Those not linked with C are dealt over tasks, and all that are not far pass
  by each part of them, in one pass.

C is in no block of the next round, and a near copy of C needs none.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelscope.llm.common import Words, drop_stages, slices, stage_table, texts_of

#: A group of more members, or more elements together, is split.
GROUP_MEMBERS, GROUP_ELEMENTS = 4096, 1 << 22

#: A task takes so many members of a split group at a time, or elements together.
PART_MEMBERS, PART_ELEMENTS = 1024, 1 << 19


def shingle_sets(texts: list[bytes], k: int):
    """The sorted distinct shingle hashes of each text."""
    for first, last in slices(texts):
        values, offset = Words(texts[first:last]).shingles(k)
        for i in range(last - first):
            v = np.sort(values[offset[i]:offset[i + 1]])
            yield v[np.concatenate(([True], v[1:] != v[:-1]))] if len(v) else v


class Sets:
    """The sets of one group, and which of them are connected."""

    #: Elements compared with a set at a time.
    COMPARED = 1 << 19

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.percent = percent
        self.n = np.array([len(s) for s in sets])
        self.offset = np.concatenate(([0], np.cumsum(self.n)))
        values, item = np.unique(np.concatenate(sets), return_inverse=True)
        self.item = item.astype(np.int32)
        self.mark = np.zeros(len(values), dtype=bool)
        self.label = np.arange(len(sets))

    def common(self, i: int, others: np.ndarray) -> np.ndarray:
        """Sizes of the intersections of set ``i`` with ``others``."""
        own = self.item[self.offset[i]:self.offset[i + 1]]
        self.mark[own] = True
        same = np.zeros(len(others), dtype=np.int64)
        size = np.cumsum(self.n[others]) // self.COMPARED
        cuts = [0, *np.flatnonzero(np.diff(size)) + 1, len(others)]
        for first, last in zip(cuts[:-1], cuts[1:]):
            n = self.n[others[first:last]]
            ends = np.cumsum(n)
            at = np.arange(ends[-1]) + np.repeat(self.offset[others[first:last]] - (ends - n), n)
            same[first:last] = np.add.reduceat(self.mark[self.item[at]].astype(np.int64), ends - n)
        self.mark[own] = False
        return same

    def connect(self, i: int, others: np.ndarray) -> Iterator[tuple[int, int]]:
        """Compare set ``i`` with those of ``others`` it is not connected with;
        yields the links that join something."""
        small, large = np.minimum(self.n[i], self.n[others]), np.maximum(self.n[i], self.n[others])
        others = others[(self.label[others] != self.label[i]) & (100 * small >= self.percent * large)]
        if not len(others):
            return
        same = self.common(i, others)
        for j in others[100 * same >= self.percent * (self.n[i] + self.n[others] - same)]:
            if self.label[j] != self.label[i]:
                yield i, j
                self.label[self.label == self.label[j]] = self.label[i]


def star_links(sets: list[np.ndarray], percent: int) -> Iterator[tuple[int, int]]:
    """Stars around one set after the other until all are connected or
    compared; a used centre is compared with nothing again."""
    group = Sets(sets, percent)
    for i in range(len(sets) - 1):
        rest = np.arange(i + 1, len(sets))
        if (group.label[rest] == group.label[i]).all():
            return
        yield from group.connect(i, rest)


def centre_groups(members: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """(centre, node, n): the members (block, node, n and perhaps order; n may
    come from ``sizes`` (node, n)) of
    blocks of two or more, with their block's centre: the smallest node, or
    that of smallest order, then hash, so the blocks of like members name the
    same."""
    if "order" in members.columns:
        first = F.min(F.struct("order", F.xxhash64("node").alias("o"), "node"))
        centre = members.groupBy("block").agg(F.count("*").alias("many"), first.alias("c")).select("block", "many", F.col("c.node").alias("centre"))
    else:
        centre = members.groupBy("block").agg(F.count("*").alias("many"), F.min("node").alias("centre"))
    shared = centre.filter("many > 1").select("block", "centre")
    edges = members.join(shared, "block")
    if sizes is not None:
        return edges.select("centre", "node").distinct().join(sizes, "node").select("centre", "node", "n")
    return edges.groupBy("centre", "node").agg(F.first("n").alias("n"))


def by_group(rows: DataFrame, work: Callable, schema: str) -> DataFrame:
    """``work(columns)`` for the rows of every centre (first column) together,
    where ``columns`` are the other columns as lists; it yields tuples."""
    width = len(rows.columns)
    types = [f.dataType for f in rows.sparkSession.createDataFrame([], schema).schema]
    names = [c.split()[0] for c in schema.split(", ")]

    def walk(batches):
        held, columns = None, None
        for batch in batches:
            keys = batch.column(0).to_pylist()
            start = 0
            for end in range(1, len(keys) + 1):
                if end < len(keys) and keys[end] == keys[start]:
                    continue
                part = [batch.column(k).slice(start, end - start).to_pylist() for k in range(1, width)]
                if columns is not None and keys[start] == held:
                    columns = [a + b for a, b in zip(columns, part)]
                else:
                    if columns is not None:
                        yield held, columns
                    held, columns = keys[start], part
                start = end
        if columns is not None:
            yield held, columns

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_type

        arrow = [to_arrow_type(t) for t in types]
        out = []
        for held, columns in walk(batches):
            out += work(held, columns)
            if len(out) >= 4096:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), arrow)], names=names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), arrow)], names=names)

    key = rows.columns[0]
    return rows.repartition(key).sortWithinPartitions(key).mapInArrow(run, schema)


def settle(groups: DataFrame, texts: DataFrame, shingle: int, percent: int, links_of: Callable) -> DataFrame:
    """(centre, node) links that connect what is linked inside each group
    (centre, node); ``links_of(sets, percent)`` yields them as pairs of places."""
    kind = texts.schema["node"].dataType.simpleString()
    rows = groups.select("centre", "node").join(texts, "node").select("centre", "node", "body")

    def work(centre, columns):
        nodes, bodies = columns
        # the centre first
        order = sorted(range(len(nodes)), key=lambda i: nodes[i] != centre)
        sets = list(shingle_sets([(bodies[i] or "").encode() for i in order], shingle))
        return [(nodes[order[i]], nodes[order[j]]) for i, j in links_of(sets, percent)]

    return by_group(rows, work, f"centre {kind}, node {kind}")


def parts(groups: DataFrame, elements: Column) -> DataFrame:
    """(centre, parts): how many parts the members of a group fall into."""
    size = groups.groupBy("centre").agg(F.count("*").alias("many"), F.sum(elements).alias("elements"))
    full = F.greatest(F.col("many") / PART_MEMBERS, F.col("elements") / PART_ELEMENTS)
    return size.select("centre", (F.floor(full) + 1).cast("int").alias("parts"))


def each_part() -> Column:
    return F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")


def own_part() -> Column:
    return F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part")


def compare_with_centre(groups: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(centre, node, n, nc, linked, lost, gained) for every edge of a star, the
    centre itself left out.  A hot centre's edges are split over tasks, each of
    which gets the centre's text once, first."""
    kind = texts.schema["node"].dataType.simpleString()
    dealt = groups.select("centre", "node").join(parts(groups, F.col("n")), "centre")
    edges = dealt.filter("centre != node").select("centre", own_part(), "node")
    centres = dealt.filter("centre = node").select("centre", each_part(), "node")
    rows = edges.unionByName(centres).join(texts, "node").select(
        "centre", "part", (F.col("centre") != F.col("node")).alias("edge"), "node", "body")
    schema = f"centre {kind}, node {kind}, n long, nc long, linked boolean, lost array<bigint>, gained array<bigint>"
    names = [c.split()[0] for c in schema.split(", ")]
    longs = pa.list_(pa.int64())

    def verify(batches):
        held = None
        for batch in batches:
            centres, edge = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            at, out, size = [], [], 0

            def table():
                n, nc, linked, lost, gained = zip(*out)
                place = pa.array(at, pa.int64())
                return pa.RecordBatch.from_arrays(
                    [batch.column(0).take(place), batch.column(3).take(place), pa.array(n, pa.int64()), pa.array(nc, pa.int64()),
                     pa.array(linked, pa.bool_()), pa.array(lost, longs), pa.array(gained, longs)], names=names)

            for i, s in enumerate(shingle_sets(texts_of(batch.column(4)), shingle)):
                if not edge[i]:
                    held = s
                    continue
                lost, gained = np.setdiff1d(held, s, assume_unique=True), np.setdiff1d(s, held, assume_unique=True)
                linked = 100 * (len(s) - len(gained)) >= percent * (len(held) + len(gained))
                at.append(i)
                out.append((len(s), len(held), linked, lost.view(np.int64), gained.view(np.int64)))
                size += len(lost) + len(gained)
                if size > PART_ELEMENTS // 4:
                    yield table()
                    at, out, size = [], [], 0
            if out:
                yield table()

    return rows.repartition("centre", "part").sortWithinPartitions("centre", "part", "edge").mapInArrow(verify, schema)


class Differences:
    """Sets not linked with the centre of their group, known by their size and
    by what sets them apart from the centre: the elements they have ``lost`` (a
    number) or gained, which of the two following from the element."""

    #: Cells and shared elements counted at a time.
    WORK = 1 << 21

    def __init__(self, nodes: list, n: np.ndarray, lost: np.ndarray, length: np.ndarray, elements: np.ndarray, centre: int, percent: int):
        self.nodes, self.n, self.lost, self.centre, self.percent = nodes, n, lost, centre, percent
        self.values, item = np.unique(elements, return_inverse=True)
        self.owner = np.repeat(np.arange(len(n)), length)[np.argsort(item, kind="stable")]
        self.start = np.concatenate(([0], np.cumsum(np.bincount(item, minlength=len(self.values)))))
        # place 0: all that is linked with the centre
        self.place = {node: i for i, node in enumerate(nodes, 1)}
        self.label = np.arange(len(nodes) + 1)

    def _join(self, node, linked: bool, own: np.ndarray) -> Iterator[tuple]:
        at = 0 if linked else self.place.setdefault(node, len(self.place) + 1)
        if at >= len(self.label):
            self.label = np.concatenate((self.label, np.arange(len(self.label), 2 * len(self.label))))
        own = own[self.label[own] != self.label[at]]
        while len(own):
            yield self.nodes[own[0] - 1], node
            self.label[self.label == self.label[own[0]]] = self.label[at]
            own = own[self.label[own] != self.label[at]]

    def connect(self, nodes: list, linked: list[bool], n: np.ndarray, lost: np.ndarray, length: np.ndarray,
                elements: np.ndarray) -> Iterator[tuple]:
        """Compare with other sets of the group, some of them ``linked`` with the
        centre; yields the links that join something."""
        at = np.minimum(np.searchsorted(self.values, elements), len(self.values) - 1)
        hit = self.values[at] == elements
        at, row = at[hit], np.repeat(np.arange(len(n)), length)[hit]
        many = self.start[at + 1] - self.start[at]
        work = np.cumsum(np.bincount(row, weights=many, minlength=len(n)) + len(self.n)) // self.WORK
        cuts = [0, *np.flatnonzero(np.diff(work)) + 1, len(n)]
        for first, last in zip(cuts[:-1], cuts[1:]):
            x, y = np.searchsorted(row, (first, last))
            ends = np.cumsum(many[x:y])
            shared = np.arange(many[x:y].sum()) + np.repeat(self.start[at[x:y]] - (ends - many[x:y]), many[x:y])
            cell = np.repeat(row[x:y] - first, many[x:y]) * len(self.n) + self.owner[shared]
            same = np.bincount(cell, minlength=(last - first) * len(self.n)).reshape(last - first, -1)
            same += self.centre - lost[first:last, None] - self.lost
            joined = (100 + self.percent) * same >= self.percent * (n[first:last, None] + self.n)
            for i in np.flatnonzero(joined.any(axis=1)):
                yield from self._join(nodes[first + i], linked[first + i], np.flatnonzero(joined[i]) + 1)


def against_centre(apart: DataFrame, percent: int) -> DataFrame:
    """``apart`` with the numbers of lost and gained elements, how many of the
    gained a set shares (times 100) with any it is linked with, and whether it
    is far."""
    sized = apart.select("*", F.size("lost").cast("long").alias("l"), F.size("gained").cast("long").alias("g"))
    need = percent * F.col("n") - 100 * (F.col("nc") - F.col("l"))
    return sized.withColumn("need", need).withColumn("far", F.col("need") > 50 * F.col("g"))


def near_links(apart: DataFrame, percent: int) -> DataFrame:
    """(centre, node) links that connect what is linked among the members of a
    split group that are not far from its centre, but for those of the centre."""
    kind = apart.schema["node"].dataType.simpleString()
    near = against_centre(apart, percent).filter("not far")
    away = near.filter("not linked")
    dealt = near.join(parts(away, F.col("l") + F.col("g")), "centre")
    rest = [c.alias(k) for c, k in ((F.col("node"), "node"), (F.col("n"), "n"), (F.col("nc"), "nc"), (F.col("linked"), "linked"),
                                    (F.col("l"), "l"), (F.concat("lost", "gained"), "elements"))]
    own = dealt.filter("not linked").select("centre", own_part(), F.lit(False).alias("other"), *rest)
    rows = own.unionByName(dealt.select("centre", each_part(), F.lit(True).alias("other"), *rest))

    def compare(batches):
        held, group, own = None, None, []
        for batch in batches:
            keys = list(zip(*(batch.column(k).to_pylist() for k in range(3))))
            out, first = [], 0
            for last in range(1, len(keys) + 1):
                if last < len(keys) and keys[last] == keys[first]:
                    continue
                part = batch.slice(first, last - first)
                node, linked = part.column(3).to_pylist(), part.column(6).to_pylist()
                n, nc, lost = (part.column(k).to_numpy() for k in (4, 5, 7))
                length, elements = np.diff(part.column(8).offsets.to_numpy()), part.column(8).flatten().to_numpy()
                if keys[first][:2] != held:
                    held, group, own = keys[first][:2], None, []
                if not keys[first][2]:
                    own.append((node, n, lost, length, elements))
                else:
                    if group is None:
                        nodes, *columns = zip(*own)
                        group = Differences([x for some in nodes for x in some], *map(np.concatenate, columns), int(nc[0]), percent)
                    out += group.connect(node, linked, n, lost, length, elements)
                first = last
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, batch.schema.field(3).type) for c in zip(*out)], names=["centre", "node"])

    return rows.repartition("centre", "part").sortWithinPartitions("centre", "part", "other").mapInArrow(compare, f"centre {kind}, node {kind}")


def size_blocks(sized: DataFrame, percent: int) -> DataFrame:
    """(block, node, n): members of a split group (centre, node, n, nc) on either
    side of what can be linked with its centre, if some are :func:`off_size`."""
    side = F.when(100 * F.col("n") < percent * F.col("nc"), -1).when(percent * F.col("n") > 100 * F.col("nc"), 1)
    sides = sized.select("centre", side.alias("side"), "node", "n", off_size(percent).alias("off")).filter("side is not null")
    open_ = sides.groupBy("centre", "side").agg(F.max("off").alias("any_off")).filter("any_off").select("centre", "side")
    return sides.join(open_, ["centre", "side"], "left_semi").select(F.xxhash64("centre", "side").alias("block"), "node", "n")


def off_size(percent: int) -> Column:
    n, nc = F.col("n").cast("long"), F.col("nc").cast("long")
    return (10000 * n < percent * percent * nc) | (percent * percent * n > 10000 * nc)


def difference_blocks(apart: DataFrame, percent: int) -> DataFrame:
    """(block, node, n): where members far from the centre of a split group can
    still be linked."""
    sized = against_centre(apart, percent)
    sized = sized.join(sized.filter("far").select("centre").distinct(), "centre", "left_semi")
    first = F.when(F.col("far"), F.col("g") - F.ceil(F.col("need") / 100) + 1).otherwise(F.col("g")).alias("first")
    every = sized.select("centre", "node", "n", "far", "g", first, F.explode("gained").alias("element")).withColumn(
        "block", F.xxhash64("centre", "element"))

    def open_(rows):
        return rows.groupBy("block").agg(F.count("*").alias("many"), F.max("far").alias("any_far")).filter("many > 1 and any_far")

    # what one set alone has gained is rarest, and makes no block
    own = Window.partitionBy("centre", "node")
    rank = F.col("g") - F.count("*").over(own) + F.row_number().over(own.orderBy("many", "block"))
    some = every.join(open_(every).select("block", "many"), "block").withColumn("rank", rank).filter("rank <= first")
    return some.select("block", "node", "n").join(open_(some).select("block"), "block", "left_semi")


def link_blocks(members: DataFrame, texts: DataFrame | Callable[[DataFrame], DataFrame], shingle: int, percent: int, links_of: Callable = star_links,
                group_members: int = GROUP_MEMBERS, group_elements: int = GROUP_ELEMENTS,
                thin: Callable[[DataFrame], DataFrame] | None = None, sizes: DataFrame | None = None) -> DataFrame:
    """(centre, node) links whose chains join the same sets as all links inside
    the blocks of ``members`` (block, node, n).  ``texts`` (node, body) has the
    text of every member, or gives those of some nodes; ``thin`` may leave out
    (centre, node) edges of members that can be linked with nobody in their
    group."""
    links, stages, empty, bodies = None, [], False, None if callable(texts) else texts
    while not empty:
        groups = stage_table(centre_groups(members, sizes), "groups")
        size = groups.groupBy("centre").agg(F.count("*").alias("many"), F.sum("n").alias("elements"))
        hot = stage_table(size.filter((F.col("many") > group_members) | (F.col("elements") > group_elements)).select("centre"), "hot")
        stages += [groups, hot]
        large = hot.limit(1).count() > 0
        bounded = groups.join(hot, "centre", "left_anti") if large else groups
        if thin is not None:
            bounded = stage_table(thin(bounded), "thinned")
            stages.append(bounded)
        split = groups.join(hot, "centre", "left_semi") if large else groups.limit(0)
        if bodies is None:  # further rounds are about nodes of the groups split here
            bodies = stage_table(texts(bounded.select("node").unionByName(split.select("node")).distinct()), "texts")
            stages.append(bodies)
        found = settle(bounded, bodies, shingle, percent, links_of)
        if large:
            split = split.join(split.filter("centre = node").select("centre", F.col("n").alias("nc")), "centre")
            apart = stage_table(compare_with_centre(split.filter(~off_size(percent)), bodies, shingle, percent), "apart")
            found = found.unionByName(apart.filter("linked").select("centre", "node")).unionByName(near_links(apart, percent))
            blocks = size_blocks(split, percent).select("block", "node", F.col("n").cast("long").alias("n"))
            members = stage_table(difference_blocks(apart, percent).unionByName(blocks), "members")
            stages += [apart, members]
            sizes, empty = None, members.limit(1).count() == 0
        found = stage_table(found, "links")
        links = found if links is None else links.unionByName(found)
        empty = empty or not large
    drop_stages(*stages)
    return links
