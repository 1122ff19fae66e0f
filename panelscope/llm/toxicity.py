"""Counterfactual-regularised toxicity classifier.

A text is the set of its words (letter runs, lower case) and word beginnings.
The model is a logistic regression on the features that tell the labels apart
best.  To keep neutral mentions of groups from raising a score, the labelled
sentences that name an identity are written again with another identity of the
same kind, and the change of the score is penalised: for a sentence x and its
rewriting x', ``strength * (margin(x) - margin(x'))**2`` joins the loss.

Learning reads at most ``max_rows`` labelled documents (a sample by hash, the
one bound here); scoring reads every whole text, in place.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelscope.llm.common import NOT_LETTER, U64, Words, mix, range_hash, slices, stage_table, texts_of

#: Identity terms by kind; a swap stays within its kind.
IDENTITY = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("mother", "father"), ("she", "he"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino"), ("gay", "straight", "lesbian", "bisexual"),
    ("african", "american", "european", "mexican", "chinese", "indian"), ("immigrants", "natives"),
    ("frauen", "männer"), ("frau", "mann"), ("muslime", "christen", "juden"),
    ("femmes", "hommes"), ("femme", "homme"), ("musulmans", "chrétiens", "juifs"),
    ("mujeres", "hombres"), ("mujer", "hombre"), ("musulmanes", "cristianos", "judíos"),
)

PREFIXES = range(4, 10)
MAX_ROWS, MAX_FEATURES, THRESHOLD = 12_000, 1000, 0.7


def features(texts: list[bytes], plain: np.ndarray | None = None) -> list[np.ndarray]:
    """For each text the sorted hashes of its words and word beginnings; the
    words ``plain`` (identity terms) count as whole words alone, so a swap
    exchanges all there is of them."""
    out = []
    for first, last in slices(texts):
        w = Words(texts[first:last], separator=NOT_LETTER)
        values, owner = [w.hash], [np.repeat(np.arange(last - first), np.diff(w.offset))]
        cut = np.isin(w.hash, plain, invert=True) if plain is not None else True
        for n in PREFIXES:
            at = np.flatnonzero((w.end - w.start > n) & cut)
            if len(at):
                values.append(mix(range_hash(w.prefix, w.start[at], w.start[at] + n) + U64(n)))
                owner.append(owner[0][at])
        values, owner = np.concatenate(values), np.concatenate(owner)
        order = np.argsort(owner, kind="stable")
        values, cut = values[order], np.searchsorted(owner[order], np.arange(last - first + 1))
        out += [np.unique(values[a:b]) for a, b in zip(cut[:-1], cut[1:])]
    return out


def word_hash(word: str) -> U64:
    return Words([word.encode()], separator=NOT_LETTER).hash[0]


def swaps(identity=IDENTITY) -> dict[int, tuple[int, ...]]:
    """Hash of each identity term and those of its counterparts."""
    return {int(word_hash(a)): tuple(int(word_hash(b)) for b in group if b != a) for group in identity for a in group}


@dataclass
class Model:
    """A fitted model: ``bias`` and the weights of ``names`` (sorted hashes)."""
    names: np.ndarray
    weights: np.ndarray
    bias: float
    plain: np.ndarray | None = None
    info: dict = field(default_factory=dict)

    def margin(self, found: np.ndarray) -> float:
        at = np.searchsorted(self.names, found)
        at[at == len(self.names)] = 0
        hit = self.names[at] == found if len(self.names) else np.zeros(len(found), bool)
        return self.bias + float(self.weights[at[hit]].sum())

    def score(self, texts: list[bytes]) -> np.ndarray:
        m = np.array([self.margin(f) for f in features(texts, self.plain)])
        return 1 / (1 + np.exp(-np.clip(m, -30, 30)))


def fit(docs: list[np.ndarray], y: np.ndarray, pairs: np.ndarray, names: np.ndarray, *, ridge: float = 0.1,
        strength: float = 100.0, steps: int = 300, positive_weight: float = 2.0) -> Model:
    """Logistic regression on ``docs`` (positions in ``names``, an array for
    each document).  ``pairs`` has a row (taken out, put in) for each
    counterfactual sentence.  Loss: sum of log losses (``positive_weight`` for
    label 1) + ridge / 2 * |w|^2 +
    strength / 2 * mean over pairs of (w[out] - w[in])^2 times the number of
    documents; minimised by Nesterov steps."""
    n, d = len(docs), len(names)
    length = np.array([len(x) for x in docs], dtype=np.int64)
    flat = np.concatenate([*docs, np.zeros(0, np.int64)]).astype(np.int64)
    owner = np.repeat(np.arange(n), length)
    prior = (y.sum() + 0.5) / (n + 1.0)
    weight = np.where(y > 0, positive_weight, 1.0)
    w, bias = np.zeros(d), float(np.log(prior / (1 - prior)))
    # common features move many documents at once: their steps are shorter
    scale = 1 / (0.25 * np.bincount(flat, weights=(weight * np.sqrt(length) * 2)[owner], minlength=d) + ridge + 1)
    pull = strength * n / max(1, len(pairs)) / 100
    if len(pairs):
        touched = np.bincount(pairs.ravel(), minlength=d)
        scale = 1 / (1 / scale + 2 * pull * touched)
    look, last, lookb, lastb = w.copy(), w.copy(), bias, bias
    for t in range(steps if n else 0):
        p = 1 / (1 + np.exp(-np.clip(lookb + np.bincount(owner, weights=look[flat], minlength=n), -30, 30)))
        error = weight * (p - y)
        g = np.bincount(flat, weights=error[owner], minlength=d) + ridge * look
        if len(pairs):
            gap = look[pairs[:, 0]] - look[pairs[:, 1]]
            g += pull * (np.bincount(pairs[:, 0], weights=gap, minlength=d) - np.bincount(pairs[:, 1], weights=gap, minlength=d))
        w = look - scale * g
        bias = lookb - float(error.sum()) / (0.25 * weight.sum() + 1) / 4
        momentum = t / (t + 3)
        look, lookb = w + momentum * (w - last), bias + momentum * (bias - lastb)
        last, lastb = w, bias
    return Model(names, w, bias, info={"rows": n, "positives": int(y.sum()), "pairs": len(pairs)})


def _sentences(text: bytes) -> list[bytes]:
    out = text
    for mark in (b"!", b"?", b"\n"):
        out = out.replace(mark, b".")
    return out.split(b".")


def learn(docs: DataFrame, labels: DataFrame, *, text: str = "text", key: str = "doc_id", label: str = "toxic",
          learnable: Column | None = None, max_rows: int = MAX_ROWS, max_features: int = MAX_FEATURES,
          identity=IDENTITY, strength: float = 100.0) -> Model:
    """Fit on the labelled rows for which ``learnable`` (a condition on the
    key) holds.  Rows whose label is null are left out, a key labelled twice
    counts as 1 if any label is 1, a null text is an empty one.  Without
    labelled rows the model scores everything one half or less."""
    known = labels.select(F.col(key).alias("k"), F.col(label).cast("int").alias("y")).filter("k is not null and y is not null")
    if learnable is not None:
        known = known.withColumnRenamed("k", key).filter(learnable).withColumnRenamed(key, "k")
    known = known.groupBy("k").agg(F.max("y").alias("y"))
    n = known.count()
    share = min(1.0, max_rows / max(n, 1))
    known = known.filter(F.pmod(F.xxhash64("k", F.lit(3)), F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))
    # max_rows rows, but for the spread of sampling by hash
    chosen = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).join(F.broadcast(known), "k").select("t", "y")
    swap = swaps(identity)
    terms = np.array(sorted(swap), dtype=U64)

    def extract(batches):
        for batch in batches:
            texts = texts_of(batch.column(0))
            named, all_found = [], features(texts, terms)
            for t, found in zip(texts, all_found):
                own = [int(f) for f in found if int(f) in swap] if len(found) else []
                # sentences are looked at one by one only where a term occurs
                rows = [int(f) for s in features(_sentences(t)) for f in s if int(f) in swap] if own else []
                named.append(np.array(rows, dtype=U64).view(np.int64))
            yield pa.RecordBatch.from_arrays([
                pa.array([f.view(np.int64) for f in all_found], pa.list_(pa.int64())),
                pa.array(named, pa.list_(pa.int64())), batch.column(1)], names=["f", "identity", "y"])

    rows = stage_table(chosen.mapInArrow(extract, "f array<bigint>, identity array<bigint>, y int"), "toxicity")
    total, positive = rows.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    counts = rows.select(F.explode("f").alias("f"), "y").groupBy("f").agg(F.count("*").alias("n"), F.sum("y").alias("p")).filter("n >= 5")
    expected = F.col("n") * F.lit(positive / max(total, 1))
    spread = expected * (1 - F.col("n") / F.lit(total + 1.0)) * F.lit(1 - positive / max(total, 1)) + 1
    # the features that tell the labels apart best, and all identity terms
    best = counts.withColumn("chi", (F.col("p") - expected) * F.abs(F.col("p") - expected) / spread) \
        .orderBy(F.abs("chi").desc(), "f").limit(max_features).select("f").collect()
    names = np.union1d(np.array([r["f"] for r in best], dtype=np.int64).view(U64), terms)
    signed = F.lit([int(x) for x in names.view(np.int64)])
    small = rows.select(F.array_intersect("f", signed).alias("f"), "identity", "y").toArrow()  # max_rows rows of max_features at most
    place = lambda values: np.searchsorted(names, np.asarray(values, dtype=np.int64).view(U64))
    docs_, pairs = [], []
    for f, who, _ in zip(*(c.to_pylist() for c in small.columns)):
        docs_.append(np.sort(place(f)))
        for a in np.asarray(who, dtype=np.int64).view(U64):
            pairs += [(np.searchsorted(names, a), np.searchsorted(names, U64(b))) for b in swap[int(a)]]
    y = np.array(small.column("y").to_pylist(), dtype=float)
    order = sorted(range(len(y)), key=lambda i: (docs_[i].tobytes(), y[i]))  # the same sums on every run
    model = fit([docs_[i] for i in order], y[order], np.array(sorted(pairs), dtype=np.int64).reshape(-1, 2), names, strength=strength)
    model.plain = terms
    return model


def score(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from the
    threshold on); columns of these names are replaced.  A null text scores as
    an empty one; an empty table gives an empty result."""
    names = [c for c in docs.columns if c not in ("score", "predicted")]
    at = names.index(text)
    rows = docs.select(*names).toDF(*[f"c{i}" for i in range(len(names))])
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)

    def apply(batches):
        for batch in batches:
            s = model.score(texts_of(batch.column(at)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s, pa.float64())], names=[*batch.schema.names, "score"])

    scored = rows.mapInArrow(apply, f"{schema}, score double").toDF(*names, "score")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
