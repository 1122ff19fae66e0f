"""MinHash near-duplicate detection.

Signature: one-permutation hashing.  Each shingle's hash is computed once; its
high bits choose one of ``bands * rows`` bins, the bin keeps its smallest hash,
and an empty bin copies the bin that a per-bin sequence of hashes reaches first
(optimal densification).  Each band of ``rows`` bins is one bucket key.

Candidates are stars: every member of a bucket has one edge to the bucket's
centre, so a bucket of n members gives n - 1 edges, never all pairs, and the
buckets of one centre give each edge once.  What shares a bucket is then
compared on the full shingle sets star by star until it is connected or
compared (:mod:`panelscope.llm.linking`), and no pair ever becomes a row.

Texts with equal shingle sets are one node (their link needs no pair).  The
components of the confirmed links are found by label propagation with pointer
jumping, in tables; the driver sees counts alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelscope.llm.common import U64, drop_stages, mix, stage_table, texts_of
from panelscope.llm.linking import link_blocks, shingle_sets, star_links

BANDS, ROWS, SHINGLE, THRESHOLD = 30, 5, 5, 0.8


class Signer:
    """Signatures of shingle sets: ``bands`` bucket keys each."""

    def __init__(self, bands: int = BANDS, rows: int = ROWS):
        self.bands, self.rows, self.bins = bands, rows, bands * rows
        self.weights = mix(np.arange(1, self.bins + 1, dtype=U64)).reshape(bands, rows) | U64(1)
        self.salt = mix(np.arange(1, bands + 1, dtype=U64) << U64(32))
        self.tries = np.zeros((0, self.bins), dtype=np.int64)

    def _try(self, t: int) -> np.ndarray:
        while t >= len(self.tries):
            n = len(self.tries)
            more = mix((np.arange(n, n + 64, dtype=U64)[:, None] << U64(20)) + np.arange(self.bins, dtype=U64) + U64(1))
            self.tries = np.concatenate((self.tries, (more % U64(self.bins)).astype(np.int64)))
        return self.tries[t]

    def bins_of(self, shingles: np.ndarray) -> np.ndarray:
        """The densified signature of a non-empty sorted set."""
        place = ((shingles >> U64(32)) * U64(self.bins) >> U64(32)).astype(np.int64)
        lead = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        out = np.zeros(self.bins, dtype=U64)
        full = np.zeros(self.bins, dtype=bool)
        out[place[lead]] = shingles[lead]
        full[place[lead]] = True
        if len(lead) == 1:
            out[:] = shingles[0]
            return out
        empty, t = np.flatnonzero(~full), 0
        while len(empty):
            source = self._try(t)[empty]
            got = full[source]
            out[empty[got]] = out[source[got]]
            empty, t = empty[~got], t + 1
        return out

    def keys(self, shingles: np.ndarray) -> np.ndarray:
        sig = self.bins_of(shingles).reshape(self.bands, self.rows)
        return mix((mix(sig) * self.weights).sum(axis=1, dtype=U64) + self.salt)


def _set_key(shingles: np.ndarray) -> bytes:
    """128 bits that name a set."""
    sums = np.array([mix(shingles).sum(dtype=U64), mix(shingles ^ U64(0x5851F42D4C957F2D)).sum(dtype=U64)])
    return mix(sums + U64(len(shingles))).tobytes()


def signatures(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, bands: int = BANDS,
               rows: int = ROWS) -> DataFrame:
    """The columns of ``docs`` as ``c0``, ``c1``, ... with ``n_shingles``,
    ``node`` (names the shingle set; null if it is empty) and ``buckets`` (a
    key for each band)."""
    at = docs.columns.index(text)
    own = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in own.schema)

    def sign(batches):
        signer = Signer(bands, rows)
        for batch in batches:
            n, nodes, buckets = [], [], []
            for s in shingle_sets(texts_of(batch.column(at)), shingle):
                n.append(len(s))
                nodes.append(_set_key(s) if len(s) else None)
                buckets.append(signer.keys(s).view(np.int64) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(n, pa.int64()), pa.array(nodes, pa.binary()), pa.array(buckets, pa.list_(pa.int64()))],
                names=[*batch.schema.names, "n_shingles", "node", "buckets"])

    return own.mapInArrow(sign, f"{schema}, n_shingles long, node binary, buckets array<bigint>")


def components(links: DataFrame, name: str = "comp") -> DataFrame:
    """(node, comp) for every node of ``links`` (centre, node): ``comp`` is the
    smallest node name that its links reach.

    Each step takes the smallest label among the neighbours and then jumps to
    the label's own label, so a path of length n takes about log n steps."""
    edges = stage_table(links.select(F.col("centre").alias("a"), F.col("node").alias("b")).unionByName(
        links.select(F.col("node").alias("a"), F.col("centre").alias("b"))).distinct(), "edges")
    labels = stage_table(edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("comp")).withColumnRenamed("a", "node"), name)
    shown = labels
    while True:
        near = edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("comp").alias("near"))
        lower = labels.join(near, labels["node"] == near["a"]).select(
            "node", F.col("comp").alias("old"), F.least("comp", "near").alias("comp"))
        jump = labels.select(F.col("node").alias("j"), F.col("comp").alias("jcomp"))
        after = stage_table(lower.join(jump, lower["comp"] == jump["j"], "left").select(
            "node", "old", F.least("comp", F.coalesce("jcomp", "comp")).alias("comp")), name)
        moved = after.filter("old != comp").limit(1).count()
        drop_stages(shown)
        shown, labels = after, after.select("node", "comp")
        if not moved:
            drop_stages(edges)
            return labels


def near_duplicates(docs: DataFrame, *, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE,
                    threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``docs`` with ``n_shingles``, ``component_id`` (smallest key that the
    row's links reach, its own included), ``kept`` (key = component_id) and
    ``representative`` (true for one row of each component, one that is kept);
    columns of these names are replaced.

    A null text, an empty one and one without words have no shingles and are
    linked with nothing; a text of fewer words than a shingle is one shingle;
    a very long text is one set like any other, whole.  A null key is larger
    than every other; a row with a null key and no links has a null component
    and is kept.  Rows that repeat a key and text are links of each other and
    share its verdict, but one of them represents them; every row without
    shingles represents itself.  An empty table gives an empty result."""
    names = [c for c in docs.columns if c not in ("n_shingles", "component_id", "kept", "representative")]
    body, own_key = f"c{names.index(text)}", f"c{names.index(key)}"
    signed = stage_table(signatures(docs.select(*names), text, shingle, bands, rows).withColumn(
        "seat", F.monotonically_increasing_id()), "signed")
    nodes = signed.filter("node is not null")
    # copies meet before the shuffle: a group of them leaves each task as one row
    seat = F.struct(F.col(own_key).isNull().alias("none"), F.col(own_key).alias("id"), "seat")
    unique = stage_table(nodes.groupBy("node").agg(F.min(seat).alias("first"), F.first("buckets").alias("buckets"),
                                                   F.first("n_shingles").alias("n")), "nodes")
    # a bucket of one member has nothing to compare
    buckets = stage_table(unique.select(F.explode("buckets").alias("block"), "node", "n"), "buckets")
    shared = stage_table(buckets.groupBy("block").agg(F.count("*").alias("many")).filter("many > 1"), "shared")
    # an original shares more buckets with its copies than they with each other
    mass = F.sum("many").over(Window.partitionBy("node"))
    members = stage_table(buckets.join(shared, "block").select("block", "node", "n", (-mass).alias("order")), "members")
    texts = stage_table(nodes.groupBy("node").agg(F.min(body).alias("body")).join(
        members.select("node").distinct(), "node", "left_semi"), "texts")
    links = link_blocks(members, texts, shingle, round(100 * threshold), star_links)
    comp = components(links)
    drop_stages(buckets, shared, members, texts)

    # equal sets share a node; nodes without links are their own component
    group = unique.select("node", "first").join(comp, "node", "left").select("node", "first", F.coalesce("comp", "node").alias("comp"))
    lowest = group.groupBy("comp").agg(F.min("first").alias("lowest"))
    place = group.join(lowest, "comp").select("node", "lowest")
    out = signed.drop("buckets").join(place, "node", "left")
    component = F.when(F.col("node").isNull(), F.col(own_key)).otherwise(F.col("lowest.id"))
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], "n_shingles",
                      component.alias("component_id"), F.col(own_key).eqNullSafe(component).alias("kept"),
                      F.coalesce(F.col("seat") == F.col("lowest.seat"), F.lit(True)).alias("representative"))
