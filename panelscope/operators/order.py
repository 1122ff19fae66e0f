"""A total order whose place is a value of the row (O1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def with_position(df: DataFrame, *order: str | Column, name: str = "position", partitions: int | None = None) -> DataFrame:
    """``df`` with its 1-based place in the order; ties in any order, so end
    the list with a unique column.

    Rows are range-partitioned and sorted once, and written with their number
    inside the partition; the partitions' row counts (one row each) give the
    offsets.  No window over all rows, and no second shuffle."""
    parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_m", F.monotonically_increasing_id())
    staged = materialize(ranged, "ordered")
    part, place = F.shiftright("_m", 33), F.col("_m").bitwiseAND((1 << 33) - 1)
    sizes = staged.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("n")).orderBy("_p").collect()  # at most ``parts`` rows
    before, total = {}, 0
    for r in sizes:
        before[r["_p"]], total = total, total + r["n"]
    offset = F.lit(0)
    if before:
        offset = F.element_at(F.create_map(*[F.lit(int(v)) for kv in before.items() for v in kv]), part)
    return staged.withColumn(name, (offset + place + 1).cast("bigint")).drop("_m")
