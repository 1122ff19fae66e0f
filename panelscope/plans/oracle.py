"""Independent DuckDB SQL for every value-checked query.

plans: lists of a group instead of joins back to it, FILTER clauses, ILIKE and
EXISTS, attributes straight from the base tables instead of the long form.
The tables ``lineitem orders customer supplier events`` are views over the
same parquet.

Doubles are rounded to 6 places on both sides (``r6``), counts are BIGINT,
periods and flags INTEGER.
"""

from __future__ import annotations

#: Added before rounding: sums that lie on a half differ in their last bit.
TIE = 1e-9

CTE = {}

CTE["facts"] = """
facts AS (
  SELECT l_suppkey AS entity_id, year(o_orderdate)::INTEGER AS period, lpad(o_custkey::VARCHAR, 19, '0') AS unit_code,
         l_quantity AS qty, l_returnflag AS flag
  FROM orders, lineitem WHERE o_orderkey = l_orderkey
)"""

CTE["panel"] = """
panel AS (
  SELECT entity_id, period, unit_code, sum(qty) AS measure
  FROM facts WHERE entity_id IS NOT NULL AND period IS NOT NULL AND unit_code IS NOT NULL GROUP BY ALL
)"""

# every entity-period as one row with the list of its units
CTE["portfolios"] = """
portfolios AS (
  SELECT entity_id, period, list({'unit': unit_code, 'm': measure} ORDER BY measure DESC, unit_code) AS units,
         sum(measure) AS total
  FROM panel WHERE measure > 0 GROUP BY ALL
)"""

CTE["weights"] = """
weights AS (
  SELECT entity_id, period, u.unit AS unit_code, u.m AS measure, total AS total_measure, u.m / total AS weight
  FROM (SELECT entity_id, period, total, unnest(units) AS u FROM portfolios)
)"""

CTE["ratings"] = """
ratings AS (
  SELECT entity_id, period,
         CASE WHEN len(flags) >= 60 THEN
           (2 + least(6, greatest(0, ((100 * len(list_filter(flags, lambda f: f = 'R'))) // len(flags) - 19) // 4)) / 2)::DOUBLE
         END AS rating
  FROM (SELECT entity_id, period, list(flag) AS flags FROM facts GROUP BY ALL)
)"""

CTE["rates"] = """
rates AS (
  SELECT year(o_orderdate)::INTEGER AS period, lpad(o_custkey::VARCHAR, 19, '0') AS unit_code,
         100::DOUBLE * count(*) FILTER (o_orderstatus <> 'P' AND o_orderpriority = '1-URGENT')
           / nullif(count(*) FILTER (o_orderstatus <> 'P'), 0) AS rate
  FROM orders GROUP BY 1, 2
)"""

# the rate of a year serves the year after
CTE["rate_joined"] = """
lagged AS (SELECT period + 1 AS period, unit_code, rate, 1 AS hit FROM rates),
rate_joined AS (
  SELECT * EXCLUDE (hit), coalesce(hit, 0) AS matched FROM weights LEFT JOIN lagged USING (unit_code, period)
)"""

CTE["rate_exposure"] = """
rate_exposure AS (
  SELECT entity_id, period, any_value(total_measure) AS total_measure,
         sum(rate * weight) / sum(weight) FILTER (rate IS NOT NULL) AS rate_exposure,
         coalesce(sum(weight) FILTER (rate IS NOT NULL), 0::DOUBLE) AS coverage_weight_share,
         (count(rate) = 0)::INTEGER AS out_of_scope
  FROM rate_joined GROUP BY entity_id, period
)"""

CTE["unit_codes"] = """
unit_codes AS (
  SELECT *, (code > 3)::INTEGER AS code_flag
  FROM (SELECT lpad(c_custkey::VARCHAR, 19, '0') AS unit_code, c_nationkey::VARCHAR AS state,
               translate(c_name, 'uo#', 'üö°') AS unit_name,
               CASE WHEN c_acctbal >= 0 THEN floor(c_acctbal / 1250) + 1 END::INTEGER AS code,
               nullif((SELECT count(*) FROM orders WHERE o_custkey = c_custkey), 0) AS population
        FROM customer)
  WHERE code IS NOT NULL OR population IS NOT NULL
)"""

CTE["static_exposure"] = """
static_exposure AS (
  SELECT entity_id, period, any_value(total_measure) AS total_measure,
         coalesce(sum(weight) FILTER (code_flag IS NOT NULL), 0::DOUBLE) AS coverage_weight_share,
         CASE WHEN count(code_flag) > 0 THEN coalesce(sum(weight) FILTER (code_flag = 1), 0) / sum(weight) FILTER (code_flag IS NOT NULL) END
           AS static_exposure,
         (count(code_flag) = 0)::INTEGER AS out_of_scope
  FROM weights LEFT JOIN unit_codes USING (unit_code) GROUP BY entity_id, period
)"""

CTE["unit_scores"] = """
unit_scores AS (
  SELECT lpad(o_custkey::VARCHAR, 19, '0') AS unit_code,
         coalesce(sum(score * people) / nullif(sum(people), 0), avg(score)) AS unit_score, 1 AS unit_flag,
         count(*)::INTEGER AS source_rows, if(max(people) > 0, 'pop_weighted', 'simple_mean') AS weight_method
  FROM (SELECT o_custkey, least(25, floor(o_totalprice / 20000))::DOUBLE AS score, greatest(0, c_acctbal) AS people
        FROM orders, customer
        WHERE c_custkey = o_custkey AND o_orderstatus = 'F' AND o_orderpriority ILIKE '%high%'
          AND c_nationkey BETWEEN 1 AND 56)
  GROUP BY o_custkey
)"""

CTE["score_exposure"] = """
score_exposure AS (
  SELECT entity_id, period, coalesce(sum(unit_score * weight), 0) AS score_exposure,
         coalesce(sum(weight) FILTER (unit_score IS NOT NULL), 0::DOUBLE) AS matched_weight_share,
         count(*) AS units_total, count(unit_score) AS units_matched
  FROM weights LEFT JOIN unit_scores USING (unit_code) GROUP BY entity_id, period
)"""

CTE["rating_base"] = """
rating_base AS (SELECT * FROM ratings LEFT JOIN rate_exposure USING (entity_id, period))"""

CTE["near"] = """
near AS (
  SELECT *, (rating > 3.99)::INTEGER AS above_threshold, if(rating > 3.99, '4.0-4.5', '3.5-3.9') AS threshold_band
  FROM rating_base WHERE rating BETWEEN 3.5 AND 4.5 AND out_of_scope = 0
)"""

CTE["concentration"] = """
concentration AS (
  SELECT entity_id, period, list_sum(list_transform(s, lambda x: x ** 2)) AS hhi,
         list_sum(list_transform(s, lambda x: x * ln(1 / x))) AS entropy,
         s[1] AS top1_share, list_sum(s[1:5]) AS top5_share, len(s)::BIGINT AS n_units
  FROM (SELECT entity_id, period, list_transform(units, lambda u: u.m / total) AS s FROM portfolios)
)"""

CTE["entity_size"] = """
entity_size AS (SELECT entity_id, period, total::DOUBLE AS total_size FROM portfolios)"""

CTE["model_frame"] = """
model_frame AS (
  SELECT entity_id, period, rating, rate_exposure, static_exposure, score_exposure, hhi, entropy, top1_share, top5_share,
         n_units::DOUBLE AS n_units, total_size
  FROM ratings
  LEFT JOIN concentration USING (entity_id, period) LEFT JOIN entity_size USING (entity_id, period)
  LEFT JOIN (SELECT entity_id, period, score_exposure FROM score_exposure) USING (entity_id, period)
  LEFT JOIN (SELECT entity_id, period, static_exposure FROM static_exposure) USING (entity_id, period)
  LEFT JOIN (SELECT entity_id, period, rate_exposure FROM rate_exposure) USING (entity_id, period)
  WHERE rating IS NOT NULL
)"""

# what each CTE reads, so a query names only what it needs
DEPS = {
    "facts": [], "panel": ["facts"], "portfolios": ["panel"], "weights": ["portfolios"], "ratings": ["facts"],
    "rates": [], "rate_joined": ["weights", "rates"], "rate_exposure": ["rate_joined"],
    "unit_codes": [], "static_exposure": ["weights", "unit_codes"],
    "unit_scores": [], "score_exposure": ["weights", "unit_scores"],
    "rating_base": ["ratings", "rate_exposure"], "near": ["rating_base"],
    "concentration": ["portfolios"], "entity_size": ["portfolios"],
    "model_frame": ["ratings", "rate_exposure", "static_exposure", "score_exposure", "concentration", "entity_size"],
}


def with_ctes(*names: str, extra: list[str] | None = None) -> str:
    """``WITH`` clause holding ``names`` and everything they depend on, in
    dependency order, followed by ``extra`` CTE texts."""
    order: list[str] = []

    def visit(n: str) -> None:
        for d in DEPS[n]:
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    parts = [CTE[n] for n in order] + list(extra or [])
    return "WITH " + ",".join(parts) + "\n"


def r6(sql: str, doubles: list[str]) -> str:
    """Round the named double columns of ``sql`` to 6 places."""
    if not doubles:
        return sql
    rep = ", ".join(f"ROUND({c} + {TIE!r}, 6) AS {c}" for c in doubles)
    return f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) AS q"
