"""Personal data: span candidates scored by boosted trees, built-ins alone.

Generators propose spans: the base patterns, looser ones for forms that the
base patterns miss (spelled-out addresses, numbers without a country code,
grouped card numbers, long-form network addresses), and parts of base matches:
a number that runs into its neighbour makes one match that fails, though a part
of it is whole.  Every candidate is described by a few format and context bits,
packed into one small integer, its pattern.  Matches of a base pattern that
pass its check (number range, check sum, digit count) are examples, those that
fail are counterexamples; the trees never see the check of a base match.  A
part is an example if the match around it passes, a counterexample if not, so
parts of matches that fail count against themselves; whether a part passes the
check by itself is one of its bits.  Looser forms outside base matches have no
label and are scored by the bits they share with the others.  As a pattern has
few bits, the counts of every pattern over the whole corpus are a small table,
and gradient boosting on the counts is the same as boosting on all candidates.
A threshold for each kind is calibrated on a held-out third of the documents;
the precision of a kind leans on that of all kinds as far as it has few cases.

Base spans always stay; a further candidate is added when its score reaches
the threshold of its kind and no better span overlaps it.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelscope.llm.common import stage_table

#: The kinds in order, and their base patterns.  Runs are
#: possessive and start where a run starts, which finds the same matches in
#: linear time.
KINDS = ("email", "ip", "card", "phone")
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Looser patterns.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[\[(](?:at|AT)[\])]\x20?[A-Za-z0-9-]++(?:\x20?(?:[\[(](?:dot|DOT)[\])]|\.)\x20?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9])[0-9]{4}(?:[./_][0-9]{4}){3}(?![0-9])",
    "phone": r"(?<![0-9+])(?<!\+[0-9]{1,3}[\x20.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9])",
}
#: What is a whole number inside a match of a base pattern.
PARTS = {
    "card": r"(?<![0-9])[0-9]{16,19}+(?![0-9])",
    "phone": r"\+[0-9]{1,3}[\x20.-]?(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
}
#: Words that announce a kind, looked for in the 24 characters before a span, back to the last one of its pattern.
CUES = {
    "email": r"(?i)(?:mail|contact|write)",
    "ip": r"(?i)(?:\bip\b|host|server|address)",
    "card": r"(?i)(?:card|visa|credit|account)",
    "phone": r"(?i)(?:phone|tel|call|mobile|fax)",
}
#: A plain test that every match of the pattern passes, to spare the search.
GATES = {("base", "email"): "@", ("base", "phone"): "+", ("loose", "ip"): ":"}

HIT = "struct<hit:string,at:int,before:string,after:string>"
CANDIDATE = "struct<kind:int,start:int,end:int,pattern:int,valid:int,base:boolean>"


def _matches(body: str, pattern: str, gate: str | None) -> Column:
    hits = F.regexp_extract_all(body, F.lit(pattern), F.lit(0))
    return hits if gate is None else F.when(F.contains(F.col(body), F.lit(gate)), hits).otherwise(F.array().cast("array<string>"))


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running(lengths: Column) -> Column:
    """The sums of an array's elements before each, as struct (total, out); an
    array that grows is copied for each element, so this is for short ones."""
    zero = F.struct(F.lit(0).alias("total"), F.array().cast("array<int>").alias("out"))
    return F.aggregate(lengths, zero, lambda a, x: F.struct(
        (a["total"] + x).alias("total"), F.concat(a["out"], F.array(a["total"])).alias("out")))


def _sums_before(lengths: Column) -> Column:
    """The sums of an array's elements before each, in blocks of the square
    root of its length."""
    def blocks(x):
        step = F.ceil(F.sqrt(F.size(x))).cast("int")
        return F.transform(F.sequence(F.lit(1), F.size(x), step), lambda first: _running(F.slice(x, first, step)))

    def join(parts):
        before = _running(F.transform(parts, lambda p: p["total"]))["out"]
        return F.flatten(F.zip_with(parts, before, lambda p, b: F.transform(p["out"], lambda s: s + b)))

    return _let(lengths, lambda x: _let(blocks(x), join))


def _located(body: Column, hits: Column, pattern: str) -> Column:
    """The hits of a pattern as (hit, at, before, after): the code point at
    which each starts, up to 24 characters between it and the hit before, and
    the character behind it (empty at the end of the text)."""
    def locate(x):
        lead, tail = F.slice(x["gaps"], 1, F.size(x["hits"])), F.slice(x["gaps"], 2, F.size(x["hits"]))
        before = _sums_before(F.zip_with(lead, x["hits"], lambda g, h: F.length(g) + F.length(h)))
        hit = F.zip_with(x["hits"], before, lambda h, b: F.struct(h.alias("hit"), b.alias("b")))
        gap = F.zip_with(lead, tail, lambda g, t: F.struct(
            F.length(g).alias("n"), F.substring(g, -24, 24).alias("before"), F.substring(t, 1, 1).alias("after")))
        return F.zip_with(hit, gap, lambda h, g: F.struct(
            h["hit"].alias("hit"), (h["b"] + g["n"]).alias("at"), g["before"].alias("before"), g["after"].alias("after")))

    both = F.struct(F.split(body, pattern, -1).alias("gaps"), hits.alias("hits"))
    return F.when(F.size(hits) > 0, _let(both, locate)).otherwise(F.array().cast(f"array<{HIT}>"))


def luhn(digits: Column) -> Column:
    """Whether a string of digits has a valid check sum."""
    n = F.length(digits)

    def part(i):
        d = F.substring(digits, n - i, F.lit(1)).cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.transform(F.sequence(F.lit(0), n - 1), part), F.lit(0), lambda a, b: a + b) % 10 == 0


def _valid(kind: str, hit: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(hit, r"\."), lambda p: ~F.regexp_replace(p, "^0+", "").rlike("^(?:[0-9]{4,}|[3-9][0-9]{2}|2[6-9][0-9]|25[6-9])$"))
    digits = F.regexp_replace(hit, "[^0-9]", "")
    if kind == "card":
        return F.when(F.length(digits).between(16, 19), luhn(digits)).otherwise(False)
    return F.length(digits).between(8, 15)


#: Bits of a pattern, lowest first; the kind takes the two bits above them.
FEATURES = ("spaced_left", "spaced_right", "cue", "separated", "line_start", "d1", "d2", "d3", "round", "letters", "part", "checked")


def _pattern(kind: str, hit: Column, before: Column, after: Column, part: bool) -> Column:
    """Format and context bits of a hit, or of a part of one."""
    digits = F.regexp_replace(hit, "[^0-9]", "")
    count = F.length(digits)
    # digit counts in eight classes
    size = (F.when(count < 4, 0).when(count < 8, 1).when(count < 10, 2).when(count < 13, 3)
            .when(count < 16, 4).when(count < 17, 5).when(count < 20, 6).otherwise(7))
    bits = [
        before.rlike(r"(?:^|[\s(\[<\"',;:])$"), (after == "") | after.rlike(r"[\s)\]>\"',;:.!?]"),
        before.rlike(CUES[kind]), hit.rlike(r"[ ().-]"), (before == "") | before.endswith("\n"),
        size.bitwiseAND(1) == 1, size.bitwiseAND(2) == 2, size.bitwiseAND(4) == 4,
        digits.rlike(r"^(?:([0-9])\1*)$"), hit.rlike("[A-Za-z]"), F.lit(part), _valid(kind, hit) if part else F.lit(False),
    ]
    packed = F.lit(KINDS.index(kind) << len(FEATURES))
    for i, bit in enumerate(bits):
        packed = packed + F.when(bit, 1 << i).otherwise(0)
    return packed


def _candidate(kind: str, x: Column, valid: Column, base: bool, part: bool = False) -> Column:
    """A located hit as a candidate."""
    return F.struct(F.lit(KINDS.index(kind)).alias("kind"), x["at"].alias("start"), (x["at"] + F.length(x["hit"])).alias("end"),
                    _pattern(kind, x["hit"], x["before"], x["after"], part).alias("pattern"),
                    valid.cast("int").alias("valid"), F.lit(base).alias("base"))


def _describe(kind: str, base: bool):
    return lambda x: _candidate(kind, x, _valid(kind, x["hit"]) if base else F.lit(None), base)


def _parts(kind: str):
    """The candidates inside one located base match; what stands around the
    match stands around its outer parts."""
    def inside(y):
        hit = y["x"]["hit"]

        def part(p, i):
            return F.struct(p["hit"].alias("hit"), (p["at"] + y["x"]["at"]).alias("at"),
                            F.when(i == 0, F.concat(y["x"]["before"], p["before"])).otherwise(p["before"]).alias("before"),
                            F.when(p["after"] == "", y["x"]["after"]).otherwise(p["after"]).alias("after"))

        located = F.transform(_located(hit, F.regexp_extract_all(hit, F.lit(PARTS[kind]), F.lit(0)), PARTS[kind]), part)
        return F.transform(located, lambda p: _candidate(kind, p, y["valid"], False, True))

    return lambda x: _let(F.struct(x.alias("x"), _valid(kind, x["hit"]).alias("valid")), inside)


def candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without ``text`` in a struct ``_row``, with ``_fold`` (0 to 2,
    by text) and the array ``found`` of candidates (kind, start, end in code
    points, pattern, valid, base).  ``valid`` is 1 or 0 for base matches and
    their parts, null for looser forms; ``base`` marks base matches."""
    own = [c for c in docs.columns if c != text]
    d = docs.select(F.struct(*own).alias("_row"), F.coalesce(F.col(text), F.lit("")).alias("_body"))
    parts = [("base", k, p) for k, p in BASE.items()] + [("loose", k, p) for k, p in LOOSE.items()]
    d = d.select("*", *[_matches("_body", p, GATES.get((s, k))).alias(f"_{s}_{k}") for s, k, p in parts])
    d = d.select("*", *[_located(F.col("_body"), F.col(f"_{s}_{k}"), p).alias(f"_{s}_{k}_at") for s, k, p in parts])
    found = []
    for s, k, _ in parts:
        hits = F.col(f"_{s}_{k}_at")
        if (s, k) == ("base", "card"):
            # every number is a match of the base pattern: those under 12 characters are no candidates
            hits = F.filter(hits, lambda x: F.length(x["hit"]) >= 12)
        found.append(F.transform(hits, _describe(k, s == "base")))
        if s == "base" and k in PARTS:
            found.append(F.flatten(F.transform(hits, _parts(k))))
    return d.select("_row", F.pmod(F.crc32(F.col("_body").cast("binary")), F.lit(3)).cast("int").alias("_fold"),
                    F.concat(*found).cast(f"array<{CANDIDATE}>").alias("found"))


@dataclass
class Stump:
    """A regression tree of depth two over the bits of a pattern."""
    first: int
    second: tuple[int, int]
    leaves: tuple[float, float, float, float]

    def __call__(self, pattern: int) -> float:
        a = pattern >> self.first & 1
        return self.leaves[2 * a + (pattern >> self.second[a] & 1)]


def _leaf(rows, p) -> float:
    grad = sum(y - n * p[x] for x, n, y in rows)
    return grad / (sum(n * p[x] * (1 - p[x]) for x, n, _ in rows) + 1.0)


def _gain(rows, p) -> float:
    grad = sum(y - n * p[x] for x, n, y in rows)
    return grad * grad / (sum(n * p[x] * (1 - p[x]) for x, n, _ in rows) + 1.0)


def boost(counts: list[tuple[int, int, int]], rounds: int = 20, rate: float = 0.4):
    """Gradient boosting with logistic loss on (pattern, count, positives);
    returns the score of a pattern as a function."""
    bits = range(len(FEATURES) + 2)
    total, good = sum(n for _, n, _ in counts), sum(y for _, _, y in counts)
    prior = math.log((good + 1) / (total - good + 1))
    trees: list[Stump] = []
    margin = {x: prior for x, _, _ in counts}
    for _ in range(rounds if counts else 0):
        p = {x: 1 / (1 + math.exp(-m)) for x, m in margin.items()}

        def split(rows, p=p):
            return max(bits, key=lambda b: (_gain([r for r in rows if r[0] >> b & 1], p)
                                            + _gain([r for r in rows if not r[0] >> b & 1], p), -b))
        first = split(counts)
        side = [[r for r in counts if (r[0] >> first & 1) == a] for a in (0, 1)]
        second = tuple(split(s) for s in side)
        leaves = tuple(rate * _leaf([r for r in side[a] if (r[0] >> second[a] & 1) == b], p) for a in (0, 1) for b in (0, 1))
        trees.append(Stump(first, second, leaves))
        for x in margin:
            margin[x] += trees[-1](x)
    return lambda pattern: 1 / (1 + math.exp(-(prior + sum(t(pattern) for t in trees))))


def thresholds(counts: list[tuple[int, int, int]], score, precision: float = 0.95, weight: float = 4.0) -> dict[int, float]:
    """For each kind the lowest score at which candidates of that score or
    more are right with ``precision`` on held-out counts; above 1 where none
    is.  The precision of a kind is that of its own candidates and of
    ``weight`` more that are right as often as those of all kinds together (one
    case in doubt counted against), so a kind with few cases is judged by the
    others and one with many by its own."""
    rows = sorted(((score(x), x >> len(FEATURES), n, y) for x, n, y in counts), reverse=True)
    out = {}
    for kind in range(len(KINDS)):
        out[kind] = 2.0
        for limit in sorted({s for s, k, _, _ in rows if k == kind}, reverse=True):
            above = [(k, n, y) for s, k, n, y in rows if s >= limit]
            pooled = sum(y for _, _, y in above) / (sum(n for _, n, _ in above) + 1)
            total, good = sum(n for k, n, _ in above if k == kind), sum(y for k, _, y in above if k == kind)
            if (good + weight * pooled) / (total + weight) >= precision:
                out[kind] = limit
    return out


def find_pii(docs: DataFrame, text: str = "text", precision: float = 0.95) -> DataFrame:
    """``docs`` without ``text``, with ``spans``: an array of (kind, start,
    end, base) by kind and start, in code points, end exclusive; ``base`` says
    whether a base pattern found it.

    A null or empty text has no spans; very long ones are read whole; equal
    texts have equal spans; an empty table gives an empty result.  Ties of
    overlapping candidates go to the earlier kind, then the earlier start; a
    part goes before the match around it.  A column ``spans`` of ``docs`` is
    replaced."""
    found = stage_table(candidates(docs, text), "pii")
    # a row for each pattern that occurs and fold: at most 3 * 2**14, some tens in practice
    counted = found.select("_fold", F.explode("found").alias("c")).groupBy(F.col("c.pattern").alias("pattern"), "_fold").agg(
        F.count("c.valid").alias("n"), F.coalesce(F.sum("c.valid"), F.lit(0)).alias("good")).collect()
    fold = lambda held: [(r["pattern"], r["n"], r["good"]) for r in counted if r["n"] and (r["_fold"] == 2) == held]
    merged: dict[int, list[int]] = {}
    for x, n, y in fold(False):
        merged.setdefault(x, [0, 0])
        merged[x][0] += n
        merged[x][1] += y
    score = boost(sorted((x, n, y) for x, (n, y) in merged.items()))
    limit = thresholds(fold(True), score, precision)
    chosen = [x for x in sorted({r["pattern"] for r in counted}) if score(x) >= limit[x >> len(FEATURES)]]

    is_base = lambda c: c["base"] & (c["valid"] == 1)
    part = 1 << FEATURES.index("part")
    is_part = lambda c: c["pattern"].bitwiseAND(part) > 0
    # parts of base spans are covered by them
    open_ = lambda c: ~is_base(c) & ~(is_part(c) & (c["valid"] == 1))
    spans = found.select("_row", F.filter("found", is_base).alias("base"), F.filter("found", lambda c: F.coalesce(open_(c), F.lit(True)) & (
        F.array_contains(F.lit(chosen), c["pattern"]) if chosen else F.lit(False))).alias("more"))
    overlap = lambda x, y: (x["start"] < y["end"]) & (y["start"] < x["end"])
    free = spans.select("_row", "base", F.filter("more", lambda c: ~F.exists("base", lambda b: overlap(b, c))).alias("more"))
    order = lambda c: F.struct((c["kind"] * 2 + F.when(is_part(c), 0).otherwise(1)).alias("a"), c["start"].alias("b"))
    free = free.select("_row", "base", F.filter("more", lambda c: ~F.exists(
        "more", lambda o: overlap(o, c) & (order(o) < order(c)))).alias("more"))
    span = lambda from_base: lambda c: F.struct(c["kind"].alias("rank"), c["start"].alias("start"), c["end"].alias("end"),
                                              F.lit(from_base).alias("base"))
    both = F.array_sort(F.concat(F.transform("base", span(True)), F.transform("more", span(False))))
    names = F.array(*[F.lit(k) for k in KINDS])
    named = F.transform(both, lambda s: F.struct(F.get(names, s["rank"]).alias("kind"), s["start"].alias("start"),
                                                 s["end"].alias("end"), s["base"].alias("base")))
    own = [c for c in docs.columns if c not in (text, "spans")]
    return free.select(*[F.col("_row")[c].alias(c) for c in own], named.alias("spans"))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(text: Column, spans: Column) -> Column:
    """``text`` with each span replaced by its kind in brackets; of
    overlapping spans the earlier one names the place."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    zero = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    return F.aggregate(ordered, zero, lambda a, s: F.struct(
        F.when(s["start"] >= a["at"], F.concat(
            a["out"], F.substring(text, a["at"] + 1, s["start"] - a["at"]), F.lit("["), s["kind"], F.lit("]"))).otherwise(a["out"]).alias("out"),
        F.greatest(a["at"], s["end"]).alias("at")), lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))
