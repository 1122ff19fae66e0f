"""Quality rules as a short-circuit cascade, in built-in expressions alone.

Every rule names the documents it rejects.  On a sample the cascade measures
what each rule costs (time of a pass that evaluates only it) and how much it
rejects, and orders the rules by rejection per cost; a document stops at its
first rejection.  The order changes the work, never the verdict.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelscope.llm.common import stage_table

#: The characters between words, and those counted as symbols.
SPACE_CHARS = " \t\n\x0b\f\r"
SYMBOL_CHARS = "#*$%&|<>"
SPACE_CLASS = r"[\x20\x09-\x0D]+"
WORD_CHAR = r"[^\x20\x09-\x0D]"


def with_base(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the base figures (all long): ``n_words``, ``word_chars``,
    ``n_symbols``, ``n_lines`` (lines with a word), ``n_dup_lines`` and
    ``n_repeat_words``; columns of these names are replaced.  A null or empty
    text has 0 everywhere."""
    own = [c for c in docs.columns if c not in BASE_FIGURES]
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda line: line.rlike(WORD_CHAR))
    d = docs.select(F.struct(*own).alias("_row"), body.alias("_body"),
                    F.array_remove(F.split(body, SPACE_CLASS), "").alias("_words"), lines.alias("_lines"))
    d = d.select(
        "_row",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.translate("_body", SPACE_CHARS, "")).cast("long").alias("word_chars"),
        (F.length("_body") - F.length(F.translate("_body", SYMBOL_CHARS, ""))).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_hash"))
    return repeat_words(d).select("_row.*", *BASE_FIGURES)


BASE_FIGURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


def repeat_words(d: DataFrame) -> DataFrame:
    """Add ``n_repeat_words`` from the word hashes ``_hash``: words in windows
    of three that occur twice or more.

    Window hashes are sorted with their position packed into the low bits, so
    a plain sort of longs brings equal windows together.  Where cutting the
    hash made two different ones equal, whole hashes are sorted instead."""
    keep = [c for c in d.columns if c != "_hash"]
    windows = F.when(F.size("_hash") < 3, F.array().cast("array<bigint>")).otherwise(F.transform(
        F.expr("slice(_hash, 1, size(_hash) - 2)"),
        lambda h, i: F.xxhash64(h, F.get("_hash", i + 1), F.get("_hash", i + 2))))
    d = d.select(*keep, windows.alias("_w"))
    d = d.select(*keep, "_w", F.size(F.array_distinct("_w")).alias("_distinct"),
                 F.expr("shiftleft(1L, cast(ceil(log2(size(_w) + 2)) as int)) - 1").alias("_low"))
    packed = F.when(F.col("_distinct") < F.size("_w"), F.sort_array(F.transform(
        "_w", lambda h, i: h.bitwiseAND(F.bitwise_not("_low")).bitwiseOR(i.cast("long")))))
    d = d.select(*keep, "_w", "_distinct", "_low", packed.alias("_packed"))
    # place of every window that equals the one before it in sorted order
    again = F.filter(F.expr("sequence(1, greatest(size(_packed) - 1, 1))"), lambda i: F.get("_packed", i).bitwiseXOR(
        F.get("_packed", i - 1)).bitwiseAND(F.bitwise_not("_low")) == 0)
    d = d.select(*keep, "_w", "_distinct", "_low", "_packed", F.when(F.col("_packed").isNotNull(), again).alias("_again"))
    cut = F.size("_packed") - F.size("_again") != F.col("_distinct")
    whole = F.when(cut, F.sort_array(F.transform("_w", lambda h, i: F.struct(h.alias("h"), i.cast("long").alias("i")))))
    d = d.select(*keep, "_low", "_packed", "_again", whole.alias("_whole"))
    fast = F.sort_array(F.transform(
        F.array_distinct(F.concat(F.col("_again"), F.transform("_again", lambda i: i - 1))),
        lambda i: F.get("_packed", i).bitwiseAND(F.col("_low"))))
    slow = F.sort_array(F.transform(F.filter("_whole", lambda x, i: F.coalesce(
        F.get("_whole", i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get("_whole", i + 1)["h"] == x["h"], F.lit(False))),
        lambda x: x["i"]))
    at = F.when(F.col("_packed").isNull(), F.array().cast("array<bigint>")).when(F.col("_whole").isNotNull(), slow).otherwise(fast)
    d = d.select(*keep, at.alias("_at"))
    steps = F.transform("_at", lambda p, i: F.least(F.lit(3).cast("long"), F.coalesce(F.get("_at", i + 1) - p, F.lit(3).cast("long"))))
    return d.select(*keep, F.aggregate(steps, F.lit(0).cast("long"), lambda a, b: a + b).alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Column


def default_rules(text: str = "text") -> list[Rule]:
    """Rules over a text and its base figures."""
    body = F.coalesce(F.col(text), F.lit(""))
    words, chars = F.col("n_words"), F.col("word_chars")
    letters = F.length(F.regexp_replace(body, r"[^\p{L}]+", ""))
    capitals = F.length(F.regexp_replace(body, r"[^\p{Lu}]+", ""))
    return [
        Rule("symbols", 10 * F.col("n_symbols") > words),
        Rule("word_length", (chars < 2 * words) | (chars > 15 * words)),
        Rule("duplicate_lines", 2 * F.col("n_dup_lines") > F.col("n_lines")),
        Rule("letters", 10 * letters < 6 * chars),
        Rule("capitals", 2 * capitals > letters),
        Rule("ellipsis_lines", 10 * F.regexp_count(body, F.lit(r"(?:\.\.\.|…)[ \t]*(?:\n|$)")) > 3 * F.col("n_lines")),
        Rule("bullet_lines", 10 * F.regexp_count(body, F.lit(r"(?:^|\n)[ \t]*[•●‣–-][ \t]")) > 9 * F.col("n_lines")),
    ]


def order_rules(rows: DataFrame, rules: list[Rule], sample_rows: int = 2000, seed: int = 5) -> list[Rule]:
    """``rules`` by measured rejection per second on about ``sample_rows``
    rows (a sample over the whole table)."""
    n = rows.count()
    sample = rows if n <= sample_rows else rows.sample(fraction=sample_rows / n, seed=seed)
    sample = stage_table(sample, "rule-sample")
    shares = sample.agg(*[F.coalesce(F.avg(r.rejects.cast("int")), F.lit(0.0)).alias(r.name) for r in rules]).first()

    def seconds(rule: Rule) -> float:
        began = time.perf_counter()
        sample.agg(F.count_if(rule.rejects)).first()
        return time.perf_counter() - began

    cost = {r.name: min(seconds(r) for _ in range(2)) for r in rules}
    return sorted(rules, key=lambda r: -shares[r.name] / cost[r.name])


def cascade(rules: list[Rule]) -> Column:
    """Name of the first rule that rejects, null if none does."""
    out = F.lit(None).cast("string")
    for rule in reversed(rules):
        out = F.when(rule.rejects, F.lit(rule.name)).otherwise(out)
    return out


def judge(docs: DataFrame, rules: list[Rule] | None = None, sample_rows: int = 2000) -> DataFrame:
    """``docs`` (with ``text``) with the base figures, ``base_failed`` and
    ``kept``; columns of these names are replaced.  A null text is an empty
    one and fails; repeated rows get the same verdict; an empty table gives an
    empty result."""
    rules = rules or default_rules()
    text = docs.drop("base_failed", "kept")
    n = docs.count()
    light = docs.select("text") if n <= sample_rows else docs.select("text").sample(fraction=sample_rows / n, seed=5)
    ordered = order_rules(with_base(light), rules, sample_rows)
    rows = with_base(text).withColumn("base_failed", base_failed())
    return rows.withColumn("kept", ~F.col("base_failed") & cascade(ordered).isNull())
