"""The registered query of the prefix trie and its reference SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shopgrain.llm.common import read
from shopgrain.llm.manifest_queries import crc32_sql
from shopgrain.llm.prefix_trie import lead_by_first, trie, turn_lists
from shopgrain.session import materialize


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = materialize(turn_lists(read(spark, sf_dir, "conversations")), "turn-lists")
    return trie(lead_by_first(lists, block=100, most=5))


_TURN = "{'key': md5(length(role) || ':' || role || text), 'n': length(text)}"

OP13_SQL = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
l AS (SELECT conv_id, {crc32_sql("conv_id")} % 6 AS h, list({_TURN} ORDER BY turn NULLS FIRST,
    md5(length(role) || ':' || role || text)) AS turns FROM t GROUP BY conv_id),
rebuilt AS (SELECT l.conv_id, list_concat(coalesce(b.turns, [])[1 : l.h], l.turns[l.h + 1 :]) AS turns
  FROM l LEFT JOIN l b ON b.conv_id = l.conv_id - l.conv_id % 100),
steps AS (SELECT conv_id, len(turns) AS size, turns, unnest(range(len(turns) + 1)) AS depth FROM rebuilt),
m AS MATERIALIZED (SELECT conv_id, size, depth, CASE depth WHEN 0 THEN 0 ELSE turns[depth].n END AS last_n,
    array_to_string(list_transform(turns[1 : depth], lambda x: x.key), ',') AS p,
    CASE WHEN depth > 0 THEN array_to_string(list_transform(turns[1 : depth - 1], lambda x: x.key), ',') END AS above
  FROM steps),
n AS MATERIALIZED (SELECT p, any_value(above) AS above, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    any_value(last_n) AS last_n,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (size = depth), '')) AS ends_sha256
  FROM m GROUP BY p),
kids AS (SELECT above AS p, count(*) AS n_children FROM n WHERE above IS NOT NULL GROUP BY above),
pairs AS (SELECT DISTINCT a.p, b.p AS below FROM m a JOIN m b ON a.conv_id = b.conv_id AND b.depth >= a.depth),
trees AS (SELECT pairs.p, count(*) FILTER (k.p IS NULL) AS n_leaves, CAST(sum((n.n_convs - 1) * n.last_n) AS BIGINT) AS saved_tokens
  FROM pairs JOIN n ON n.p = pairs.below LEFT JOIN kids k ON k.p = pairs.below GROUP BY pairs.p)
SELECT n.conv_id, n.depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children,
  n_leaves, saved_tokens, n.ends_sha256
FROM n JOIN trees USING (p) LEFT JOIN kids USING (p) LEFT JOIN n up ON up.p = n.above
"""

QUERIES = {"op13_prefix_trie": op13_prefix_trie}
SQL = {"op13_prefix_trie": OP13_SQL}
