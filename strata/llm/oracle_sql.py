"""DuckDB oracles of the training-data queries that SQL can express."""

from __future__ import annotations

_LEVELS = ["domain", "lang", "source"]
_WEIGHTS = {
    "domain": "CASE domain WHEN 'domain0' THEN 3 WHEN 'domain1' THEN 2 ELSE 1 END",
    "lang": "CASE lang WHEN 'en' THEN 4 WHEN 'de' THEN 2 ELSE 1 END",
    "source": "CASE source WHEN 'src0' THEN 2 ELSE 1 END",
}


def _level(i: int) -> str:
    """CTEs that share the budget of the level above among the nodes of level ``i``."""
    path, up, name = ", ".join(_LEVELS[:i + 1]), ", ".join(_LEVELS[:i]), _LEVELS[i]
    family = f"PARTITION BY {up}" if up else ""
    parent = f"JOIN quota{i - 1} USING ({up})" if up else "CROSS JOIN (SELECT budget AS quota FROM wanted)"
    return f"""
node{i} AS (
  SELECT n.*, CAST(quota AS HUGEINT) AS budget, {_WEIGHTS[name]} AS weight
  FROM (SELECT {path}, CAST(SUM(available) * 3 AS HUGEINT) AS capacity FROM leaf GROUP BY {path}) n {parent}),
sorted{i} AS (
  SELECT *, ROW_NUMBER() OVER w AS place,
    budget - COALESCE(SUM(capacity) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
    SUM(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
  FROM node{i} WINDOW w AS ({family} ORDER BY capacity / weight, {name})),
opened{i} AS (
  SELECT *, MIN(CASE WHEN rest * weight <= capacity * weights THEN place END) OVER ({family}) AS opens FROM sorted{i}),
quota{i} AS (
  SELECT {path}, CASE WHEN opens IS NULL OR place < opens THEN capacity
    ELSE LEAST(capacity, (weight * MAX(CASE WHEN place = opens THEN rest END) OVER ({family}))
                         // MAX(CASE WHEN place = opens THEN weights END) OVER ({family})) END AS quota
  FROM opened{i})"""


SOURCE_MIXING = f"""
WITH doc AS (
  SELECT doc_id, COALESCE('domain' || CAST(TRY_CAST(NULLIF(regexp_extract(source, '([0-9]{{1,9}})', 1), '') AS BIGINT) % 4
         AS VARCHAR), '') AS domain,
    COALESCE(lang, '') AS lang, COALESCE(source, '') AS source,
    CAST(len(regexp_extract_all(text, '[^ \\t-\\r]+')) AS BIGINT) AS n_tokens
  FROM documents),
own AS (SELECT * FROM doc WHERE n_tokens > 0),
leaf AS (SELECT domain, lang, source, SUM(n_tokens) AS available FROM own GROUP BY ALL),
wanted AS (SELECT SUM(available) * 600000 // 1000000 AS budget FROM leaf),
{",".join(_level(i) for i in range(3))},
plan AS (
  SELECT domain, lang, source, quota // available AS whole, quota - quota // available * available AS rest
  FROM quota2 JOIN leaf USING (domain, lang, source)),
drawn AS (
  SELECT own.*, whole, rest, md5('1:' || CAST(whole + 1 AS VARCHAR) || ':' || COALESCE(CAST(doc_id AS VARCHAR), '')) AS draw
  FROM own JOIN plan USING (domain, lang, source)),
placed AS (
  SELECT *, GREATEST(0, LEAST(n_tokens, rest - COALESCE(SUM(n_tokens) OVER (
    PARTITION BY domain, lang, source ORDER BY draw, n_tokens ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) AS last
  FROM drawn)
SELECT doc_id, domain, lang, source, n_tokens, CAST(whole + CASE WHEN last > 0 THEN 1 ELSE 0 END AS BIGINT) AS passes,
  CAST(whole * n_tokens + last AS BIGINT) AS taken
FROM placed WHERE whole * n_tokens + last > 0
"""
