"""The corpus pipeline: every stage is one operator of ``panelscope.llm``.

Stages take (spark, docs, sf_dir) and return a frame; all but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelscope.llm import decontaminate, mixing, near_dup, sharding, toxicity
from panelscope.llm.common import stage_table

#: Learning and sketching stages cannot be said in SQL: tests/llm has a
#: brute-force version.
ORACLE_SQL = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def detoxify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the classifier, fitted on the labelled ones, scores
    at its threshold or more."""
    model = toxicity.learn(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).filter("predicted = 0").select(*docs.columns)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of every near-duplicate group (five-word shingles,
    similarity 0.8), of smallest id; documents without words all stay."""
    return near_dup.near_duplicates(docs).filter("representative").select(*docs.columns)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that cover a benchmark item."""
    found = decontaminate.find_leaks(docs, _table(spark, sf_dir, "benchmark"))
    return found.filter(F.size("leaks") == 0).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that the sources meet their targets:
    a document appears once for each time the mix takes it."""
    mixed = mixing.mix_sources(docs, _table(spark, sf_dir, "labels"))
    order = Window.partitionBy("doc_id", "_text")
    times = mixed.filter("taken > 0").select("doc_id", "_text", (F.col("taken") / F.col("size")).cast("int").alias("_times"))
    # rows that repeat id and text (none after the near-duplicate stage) are paired off by number
    times = times.withColumn("_nth", F.row_number().over(order.orderBy(F.desc("_times"))))
    body = docs.withColumn("_text", F.md5(F.coalesce("text", F.lit("")))).withColumn(
        "_nth", F.row_number().over(order.orderBy("source")))
    taken = body.join(times.withColumnsRenamed({"doc_id": "_id", "_text": "_t", "_nth": "_n"}),
                      F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_t")) & (F.col("_nth") == F.col("_n")))
    return taken.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times")))).select(*docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Eight shards of near equal bytes."""
    return sharding.shard_ring(docs, 8)


STAGES = [
    ("toxicity", detoxify),
    ("near_dedup", deduplicate),
    ("decontamination", decontaminate_benchmark),
    ("mixing", mix),
    ("sharding", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
