"""One query per operator, each over its whole table, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelscope.llm import (centroids, chat, decontaminate, jaccard_join, mixing, near_dup, pii, quality, resampling, sharding,
                            suffix_dedup, toxicity, warc)
from panelscope.llm.oracle import OP1_SQL, OP2_SQL, OP3_SQL, OP7_SQL, OP8_SQL, OP10_SQL, OP11_SQL, OP12_SQL, OP13_SQL

QUERIES: dict = {}
ORACLE: dict = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_suffix_dedup", OP1_SQL)
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that repeat in strings of 200 bytes."""
    out = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), removed.alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query("op2_quality_rules", OP2_SQL)
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base figures and verdict of every document."""
    judged = quality.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept")


@query("op3_mixing", OP3_SQL)
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes of every document."""
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query("op4_decontamination")
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that cover a benchmark item, with the items."""
    found = decontaminate.find_leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    leaks = found.select("doc_id", F.explode("leaks").alias("leak"))
    return leaks.select("doc_id", "leak.*", F.lit(True).alias("contaminated"))


@query("op5_toxicity")
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; a third of the ids is held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"), learnable=~held_out)
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted")


@query("op6_sharding")
def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document on the ring, balanced by bytes."""
    sharded = sharding.shard_ring(table(spark, sf_dir, "documents").select("doc_id", "text"), 8)
    return sharded.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                          F.lit(None).cast("int").alias("grown_shard"))


@query("op7_chat_formatting", OP7_SQL)
def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation rendered for each of its participants; masks as
    ``start:end`` in characters, comma-joined."""
    parts = chat.rotate(table(spark, sf_dir, "conversations"))
    masks = F.array_join(F.transform("masks", lambda m: F.concat_ws(":", m["start"], m["end"])), ",")
    return parts.select("conv_id", "participant", "part", "n_messages", "rendered", masks.alias("masks"))


@query("op8_minhash_near_dedup", OP8_SQL)
def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document, on sets of 4-word shingles."""
    docs = near_dup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), shingle=4)
    return docs.select("doc_id", "n_shingles", "component_id", "kept")


@query("op9_pii")
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: base counts, base digest, all spans."""
    found = pii.find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["base"])

    def of(kind: str):
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[of(kind) for kind in pii.KINDS], F.sha2(pii.span_text(base), 256).alias("base_sha256"),
                        pii.span_text(F.col("spans")).alias("spans"))


@query("op10_warc", OP10_SQL)
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of all pages, written to archives and read back."""
    records = warc.archive_pages(table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op11_importance_resampling", OP11_SQL)
def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and rank of every document, drawn towards the benchmark."""
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])


@query("op12_ngram_jaccard_join", OP12_SQL)
def op12_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of every document under the exact join on 5-word shingles."""
    docs = jaccard_join.jaccard_join(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", "n_shingles", "component_id")


@query("op13_centroid_clustering", OP13_SQL)
def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every whole vector after three rounds."""
    return centroids.cluster_vectors(table(spark, sf_dir, "embeddings"), keep=["vec_id"])
