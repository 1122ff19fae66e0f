"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every source gets a token target.  Whole epochs of the source come first; the
rest of its target is a weighted sample without replacement: each document
draws the exponential key ``-ln(u) / quality``, documents are sorted by key
within their source and taken while their running sum fits what is left.

The running sum is built from buckets of the key, so a source holding a third
of all rows is sorted in ``buckets`` parts, not in one task.  A source's keys
are exponential with its qualities as rates, so the rank of a key is about the
mean of ``1 - exp(-quality * key)`` over the source's documents; cut evenly,
this rank gives buckets of equal size whatever the qualities are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelscope.llm.common import n_words, stage_table, unit_hash

#: Weights of the sources in code point order, repeating.
SOURCE_WEIGHTS = (3, 1, 2)
#: Quality weight of documents labelled 1, 0, or not at all.
QUALITY = {1: 1.0, 0: 0.25, None: 0.5}


def source_targets(sizes: dict, weights=SOURCE_WEIGHTS, share: float = 1.5, epochs: float = 2.0) -> dict:
    """Token target of each source: ``share`` of all sizes by weight, a source
    stops at ``epochs`` times its size and the excess is shared again."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, target = share * sum(sizes.values()), set(order), {}
    while open_:
        total = sum(weight[s] for s in open_)
        full = {s for s in open_ if left * weight[s] / total >= epochs * sizes[s]}
        if not full:
            target |= {s: left * weight[s] / total for s in open_}
            break
        target |= {s: epochs * float(sizes[s]) for s in full}
        left -= sum(epochs * sizes[s] for s in full)
        open_ -= full
    return target


def sample_key(quality: Column, *identity: Column, seed: int = 0) -> Column:
    """The Efraimidis-Spirakis key in its exponential form (small keys first)."""
    u = F.greatest(unit_hash(*identity, seed=seed), F.lit(2.0 ** -49))
    return -F.log(u) / quality


def key_rank(key: Column, shares: Column, rates: list[float]) -> Column:
    """About the share of a source's documents whose key is ``key`` or less;
    ``shares`` are those of the qualities ``rates``.  Every term grows with the
    key, and so does their sum."""
    return reduce(Column.__add__, [shares[i] * (1 - F.exp(-q * key)) for i, q in enumerate(rates)])


def mix_sources(docs: DataFrame, labels: DataFrame | None = None, *, weights=SOURCE_WEIGHTS, share: float = 1.5,
                epochs: float = 2.0, seed: int = 17, buckets: int = 1024) -> DataFrame:
    """``docs`` (doc_id, source, text, ...) with ``size``, ``source_size``,
    ``target``, and ``taken``: the words the mix takes of the document, a
    multiple of its size.

    Weights go to the sources in code point order, null last.  The number of
    sources is the one thing the driver holds (a row each).  A null or empty
    text has size 0 and takes 0.  Documents with equal ids are told apart by
    text; rows equal in both are ranked next to each other in any order, so
    only which of them is taken first is open.  An empty table gives an empty
    result.  Columns of the result's names in ``docs`` are replaced."""
    rows = docs.select("doc_id", "source", n_words("text").alias("size"),
                       F.md5(F.coalesce("text", F.lit(""))).alias("_text"))
    if labels is not None:
        known = labels.groupBy("doc_id").agg(F.max("quality").alias("_quality"))
        rows = rows.join(known, "doc_id", "left")
    else:
        rows = rows.withColumn("_quality", F.lit(None).cast("int"))
    rates = sorted(set(QUALITY.values()))
    quality = F.when(F.col("_quality") == 1, QUALITY[1]).when(F.col("_quality") == 0, QUALITY[0]).otherwise(QUALITY[None])
    rows = stage_table(
        rows.withColumn("_key", sample_key(quality, F.col("doc_id"), F.col("_text"), seed=seed)).withColumn("_quality", quality), "mix")

    per_rate = [F.avg((F.col("_quality") == q).cast("double")).alias(f"w{i}") for i, q in enumerate(rates)]
    sums = rows.groupBy("source").agg(F.sum("size").alias("n"), *per_rate).collect()
    sizes = {r["source"]: r["n"] for r in sums}
    targets = source_targets(sizes, weights, share, epochs)
    spark = docs.sparkSession
    # a row for each source
    table = F.broadcast(spark.createDataFrame(
        [(r["source"], r["n"], float(targets[r["source"]]), [r[f"w{i}"] for i in range(len(rates))]) for r in sums],
        "s string, source_size long, target double, _share array<double>"))
    rows = rows.join(table, F.col("source").eqNullSafe(F.col("s"))).drop("s", "_quality")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    bucket = F.floor(key_rank(F.col("_key"), F.col("_share"), rates) * buckets).cast("int")
    rows = rows.withColumn("_whole", whole.cast("long")).withColumn("_bucket", bucket).drop("_share")
    sums = rows.groupBy("source", "_bucket").agg(F.sum("size").alias("_sum"))
    # at most `buckets` rows for each source
    before = sums.withColumn("_before", F.sum("_sum").over(
        Window.partitionBy("source").orderBy("_bucket")) - F.col("_sum")).select(
        F.col("source").alias("s"), F.col("_bucket").alias("b"), "_before")
    order = Window.partitionBy("source", "_bucket").orderBy("_key", "doc_id", "_text")
    rows = rows.withColumn("_run", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    rows = rows.join(before, F.col("source").eqNullSafe(F.col("s")) & (F.col("_bucket") == F.col("b")))
    start = F.col("_before") + F.coalesce(F.col("_run"), F.lit(0))
    left = F.col("target") - F.col("_whole") * F.col("source_size")
    # taken when its middle lies within what is left: half a document off at most
    extra = F.when(start + F.col("size") / 2 < left, 1).otherwise(0)
    return rows.select("doc_id", "source", "size", "source_size", "target",
                       ((F.col("_whole") + extra) * F.col("size")).cast("long").alias("taken"), "_text")
