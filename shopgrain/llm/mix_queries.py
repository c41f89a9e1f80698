"""The registered query of the mixing operator and its reference SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shopgrain.llm.common import read
from shopgrain.llm.mixing import FILL, MOST, SEED, SHARE, WEIGHTS, mix


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


#: Documents are looked at one after the other here; targets are found by ascending 2 x size / weight.
OP11_SQL = f"""
WITH RECURSIVE docs AS MATERIALIZED (SELECT doc_id, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
    md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '-') || ':' || coalesce(text, '')) AS key FROM documents),
sums AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source),
weighed AS (SELECT *, {float(MOST)}::DOUBLE * source_size AS most, CAST(CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
    WHEN 0 THEN {WEIGHTS[0]} WHEN 1 THEN {WEIGHTS[1]} ELSE {WEIGHTS[2]} END AS DOUBLE) AS weight FROM sums),
lined AS (SELECT *, ({SHARE}::DOUBLE * sum(source_size) OVER ()
    - coalesce(sum(most) OVER (ORDER BY most / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY most / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS unit
  FROM weighed),
level AS (SELECT coalesce(arg_min(unit, most / weight) FILTER (most > unit * weight), 'infinity'::DOUBLE) AS unit FROM lined),
targets AS (SELECT source, source_size, least(most, level.unit * weight) AS target FROM weighed, level),
plan AS (SELECT *, CASE WHEN source_size > 0 THEN (target - whole * source_size) / source_size ELSE 0 END AS chance
  FROM (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM targets)),
units AS (SELECT d.source, key, CAST(sum(size) AS BIGINT) AS size, any_value(chance) AS chance,
    any_value(round(target - whole * source_size, 6)) AS aim
  FROM docs d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source WHERE size > 0 AND chance > 0 GROUP BY d.source, key),
drawn AS (SELECT *, (('0x' || substr(key, 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE AS u FROM units),
ranked AS (SELECT *, (u / (1 - u)) / (chance / (1 - chance)) AS rank FROM drawn),
summed AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY rank, key) AS upto FROM ranked),
late AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY rank, key) AS nth FROM summed WHERE upto > aim
  QUALIFY nth <= {FILL}),
walk AS (
  SELECT source, 0::BIGINT AS nth, aim - (upto - size) AS rest, NULL::VARCHAR AS took FROM late WHERE nth = 1
  UNION ALL SELECT w.source, l.nth, CASE WHEN l.size <= w.rest THEN w.rest - l.size ELSE w.rest END,
    CASE WHEN l.size <= w.rest THEN l.key END
  FROM walk w JOIN late l ON w.source IS NOT DISTINCT FROM l.source AND l.nth = w.nth + 1),
rests AS (SELECT source, min(rest) AS rest FROM walk GROUP BY source),
extras AS (SELECT source, took AS key FROM walk WHERE took IS NOT NULL
  UNION ALL SELECT source, key FROM (SELECT l.*, r.rest FROM late l JOIN rests r ON l.source IS NOT DISTINCT FROM r.source
    WHERE l.key NOT IN (SELECT took FROM walk w WHERE took IS NOT NULL AND w.source IS NOT DISTINCT FROM l.source)
    QUALIFY row_number() OVER (PARTITION BY l.source ORDER BY l.size, nth) = 1) WHERE size < 2 * rest),
more AS (SELECT source, key FROM summed WHERE upto <= aim UNION ALL SELECT * FROM extras)
SELECT doc_id, size, p.source_size, target,
  CAST(size * (whole + CASE WHEN m.key IS NULL THEN 0 ELSE 1 END) AS BIGINT) AS taken
FROM docs d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source
LEFT JOIN more m ON d.source IS NOT DISTINCT FROM m.source AND d.key = m.key
"""

QUERIES = {"op11_mixing": op11_mixing}
SQL = {"op11_mixing": OP11_SQL}
