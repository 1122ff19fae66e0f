"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Keys are groups of equal texts; a group larger than ``piece_share`` of a
shard's capacity is cut into pieces by document, each a key of its own at the
group's place on the ring.  A key belongs to the first virtual node clockwise;
where a shard is full its further keys continue clockwise to the next shard
with room.  A shard's capacity is ``1 + slack`` times the mean load.

The ring is cut into ``cells`` arcs at fixed places.  Spark sums the bytes of
every cell; the walk that fills shards and passes the overflow on sees only
these sums (at most ``cells`` rows, whatever the input), and its outcome, a
list of byte ranges of cells with their shard, is joined back to the keys by
their running position in the cell.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelscope.llm.common import stage_table, utf8_bytes


def virtual_nodes(n_shards: int, per_shard: int, cells: int) -> list[tuple[int, int]]:
    """(cell, shard) of every virtual node, in ring order.  A shard's nodes
    depend on its number alone, so another shard leaves the rest in place."""
    nodes = {}
    for shard in range(n_shards):
        for v in range(per_shard):
            at = int(hashlib.md5(f"{shard}/{v}".encode()).hexdigest()[:12], 16) % cells
            nodes.setdefault(at, shard)
    return sorted(nodes.items())


def fill(loads: dict[int, int], nodes: list[tuple[int, int]], capacity: float) -> list[tuple[int, int, int, int]]:
    """Ranges (cell, first byte, end byte, shard) that fill the ring.

    Every cell offers its bytes to its own shard first, in ring order; what a
    full shard cannot take goes on to the following virtual nodes in the next
    pass, so overflow never displaces a shard's own keys."""
    places = [c for c, _ in nodes]
    room = dict.fromkeys((s for _, s in nodes), capacity)
    waiting = [(c, 0, n, bisect_left(places, c) % len(nodes)) for c, n in sorted(loads.items())]
    out = []
    while waiting:
        later = []
        for cell, first, end, node in waiting:
            shard = nodes[node][1]
            take = min(end - first, int(room[shard]))
            if take > 0:
                out.append((cell, first, first + take, shard))
                room[shard] -= take
            if first + take < end:
                nxt = (node + 1) % len(nodes)
                while int(room[nodes[nxt][1]]) <= 0:
                    nxt = (nxt + 1) % len(nodes)
                later.append((cell, first + take, end, nxt))
        waiting = later
    return out


def shard_ring(docs: DataFrame, n_shards: int = 8, *, text: str = "text", key: str = "doc_id",
               per_shard: int = 64, cells: int = 1 << 14, slack: float = 0.005,
               piece_share: float = 0.002, buckets: int = 1024) -> DataFrame:
    """Give every row of ``docs`` a shard and a slot.

    Returns all columns of ``docs`` but ``text`` (replaced by its figures) and
    ``size`` (bytes + 1), ``text_crc32``, ``shard`` and ``slot`` (0, 1, ...
    within the shard); columns of these names in ``docs`` are replaced.  A null text is an empty one.  Rows with equal texts
    share a shard as far as the capacity allows; rows equal in every column
    are interchangeable, and many of them (null ids, say) are told apart by
    their place in the staged rows.  A text longer than a shard's capacity
    fills its shard beyond it.  An empty table gives an empty result.

    ``slot`` orders a shard by ``buckets`` hash buckets of the rows, so no task
    sorts a whole shard."""
    own = [c for c in docs.columns if c not in (text, "size", "text_crc32", "shard", "slot")]
    body = F.coalesce(F.col(text), F.lit(""))
    rows = stage_table(
        docs.select(
            F.struct(*own).alias("_row") if own else F.struct(F.lit(0)).alias("_row"),
            (utf8_bytes(text) + 1).alias("size"),
            F.crc32(body.cast("binary")).alias("text_crc32"),
            F.md5(body.cast("binary")).alias("_group"),
            F.xxhash64(F.col(key), *[F.col(c) for c in own if c != key and "map<" not in dict(docs.dtypes)[c]], F.lit(7)).alias("_spread"),
            F.monotonically_increasing_id().alias("_id"),
        ), "shard-rows")
    groups = rows.groupBy("_group").agg(F.sum("size").alias("_bytes"))
    total = groups.agg(F.coalesce(F.sum("_bytes"), F.lit(0))).first()[0]
    if not total:
        return rows.select("_row.*", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot")) \
            if own else rows.select("size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    capacity = (1 + slack) * total / n_shards
    piece = max(1, int(piece_share * capacity))

    # the few groups above the bound: at most n_shards / piece_share of them
    large = groups.filter(F.col("_bytes") > piece).select("_group", F.ceil(F.col("_bytes") / piece).alias("_n"))
    rows = rows.join(F.broadcast(large), "_group", "left")
    # equal rows of a large group that are too many for a piece: at most n_shards / piece_share kinds of them
    equal = rows.filter("_n is not null").groupBy("_group", "_spread").agg(F.sum("size").alias("_bytes"), F.count("*").alias("_rows"))
    equal = equal.filter((F.col("_bytes") > piece) & (F.col("_rows") > 1)).select("_group", "_spread", F.lit(True).alias("_many"))
    rows = rows.join(F.broadcast(equal), ["_group", "_spread"], "left").withColumn(
        "_spread", F.when(F.col("_many"), F.xxhash64("_spread", "_id")).otherwise(F.col("_spread"))).withColumn(
        "_piece", F.pmod("_spread", F.coalesce("_n", F.lit(1))).cast("int"))
    cell = F.pmod(F.conv(F.substring("_group", 1, 12), 16, 10).cast("long"), F.lit(cells)).cast("int")
    keys = stage_table(
        rows.groupBy("_group", "_piece").agg(F.sum("size").alias("_bytes"))
        .withColumn("_cell", cell)
        .withColumn("_at", F.sum("_bytes").over(
            Window.partitionBy("_cell").orderBy("_group", "_piece")) - F.col("_bytes")), "shard-keys")
    loads = {r["_cell"]: r["n"] for r in keys.groupBy("_cell").agg(F.sum("_bytes").alias("n")).collect()}
    ranges = fill(loads, virtual_nodes(n_shards, per_shard, cells), capacity + 1)
    spark = docs.sparkSession
    # at most 2 * cells rows plus one for each time a shard filled up
    table = spark.createDataFrame(ranges, "_cell int, _first long, _end long, shard int")
    placed = keys.join(F.broadcast(table), "_cell").filter(
        (F.col("_at") >= F.col("_first")) & (F.col("_at") < F.col("_end"))).select("_group", "_piece", "shard")
    rows = stage_table(rows.join(placed, ["_group", "_piece"]).drop("_n", "_piece", "_many"), "shard-placed")

    # the group as well: rows without a key are spread by their texts
    rows = rows.withColumn("_bucket", F.pmod(F.xxhash64("_spread", "_group"), F.lit(buckets)).cast("int"))
    counts = rows.groupBy("shard", "_bucket").agg(F.count("*").alias("_count"))
    # n_shards * buckets rows at most
    offsets = counts.withColumn("_offset", F.sum("_count").over(
        Window.partitionBy("shard").orderBy("_bucket")) - F.col("_count")).drop("_count")
    within = F.row_number().over(Window.partitionBy("shard", "_bucket").orderBy("_spread", "_group", "_id"))
    out = rows.withColumn("_nth", within - 1).join(F.broadcast(offsets), ["shard", "_bucket"])
    mine = ["_row.*"] if own else []
    return out.select(*mine, "size", "text_crc32", "shard", (F.col("_offset") + F.col("_nth")).cast("long").alias("slot"))
