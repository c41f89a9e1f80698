"""The registered queries of the operators, each over its whole table, and their reference SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopgrain.llm import manifest_queries, mix_queries, trie_queries
from shopgrain.llm.chat import format_chat, read_back, row_turns, under_loss
from shopgrain.llm.common import read
from shopgrain.llm.decontam import WINDOW, contamination
from shopgrain.llm.exact_dedup import exact_dedup
from shopgrain.llm.html_text import extract
from shopgrain.llm.packing import pack
from shopgrain.llm.secret_scan import scan
from shopgrain.llm.simhash import simhash_groups
from shopgrain.llm.suffix_dedup import remove_repeats
from shopgrain.llm.toxicity import THRESHOLD, fold, score, train
from shopgrain.llm.urls import DAMPING, LINK, LOWER, MARGIN, TOLERANCE, UPPER, URL, judge

Query = Callable[[SparkSession, str], DataFrame]


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packed.withColumnRenamed("id", "doc_id")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read(spark, sf_dir, "documents"), keep="max")


OP2_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g USING (t)
"""


PROBE = "</s>[INST] ok [/INST]"


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame(
        [(-1, 0, "user", PROBE), (-1, 1, "assistant", PROBE)], "conv_id long, turn long, role string, text string"
    )
    formatted = format_chat(row_turns(rows.unionByName(probe)))
    turns = read_back(F.col("formatted"))
    texts = under_loss(F.col("formatted"), F.col("loss"))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return (
        formatted.withColumn("turns", turns)
        .withColumn("under_loss", F.array_join(texts, ""))
        .select(
            "conv_id",
            F.size("turns").cast("long").alias("n_turns"),
            F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
            F.length("under_loss").cast("long").alias("loss_chars"),
            F.sha2("under_loss", 256).alias("loss_sha256"),
            F.length("formatted").cast("long").alias("formatted_chars"),
        )
    )


def _escaped(column: str) -> str:
    """The formatted length of a text in SQL: one more for each backslash and each control string."""
    marks = ("\\", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
    more = (f"(length({column}) - length(replace({column}, '{m}', ''))) // {len(m)}" for m in marks)
    return f"(length({column}) + {' + '.join(more)})"


OP3_SQL = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '{PROBE}'), (-1, 1, 'assistant', '{PROBE}'))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(8 + length(role) + {_escaped("text")}
    + CASE role WHEN 'user' THEN 15 WHEN 'system' THEN 17 ELSE 0 END) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination(docs, read(spark, sf_dir, "benchmark"))
    place = lambda h: F.concat_ws(":", h["item"], h["word"].cast("string"), h["words"].cast("string"))
    return found.select(
        "doc_id",
        F.col("__found.n_words").alias("n_words"),
        F.col("__found.n_hit").alias("n_hit"),
        F.size("__found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("__found.items", ","), 256).alias("items_sha256"),
        (F.col("__found.n_hit") > 0).alias("contaminated"),
        F.col("__found.longest").alias("longest_match"),
        F.array_join(F.transform("__found.hits", place), ",").alias("locations"),
    )


_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

OP4_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, {_WORDS} AS w FROM documents),
items AS (SELECT row_number() OVER () AS item, coalesce(CAST(item_id AS VARCHAR), '') AS id, {_WORDS} AS w
  FROM benchmark),
sized AS (SELECT *, least(len(w), {WINDOW}) AS size FROM items WHERE len(w) > 0),
tests AS (SELECT item, id, size, j, array_to_string(w[j + 1 : j + size], ' ') AS gram
  FROM (SELECT *, unnest(range(len(w) - size + 1)) AS j FROM sized)),
windows AS (SELECT row, size, i, array_to_string(w[i + 1 : i + size], ' ') AS gram
  FROM (SELECT *, unnest(range(len(w) - size + 1)) AS i
    FROM docs, (SELECT DISTINCT size FROM sized) WHERE len(w) >= size)),
found AS (SELECT row, item, id, size, i, j FROM windows JOIN tests USING (size, gram)),
runs AS (SELECT *, i - row_number() OVER (PARTITION BY row, item, i - j ORDER BY i) AS run FROM found),
longest AS (SELECT row, id, i, size, size + max(i) OVER (PARTITION BY row, item, i - j, run) - i AS n FROM runs),
hits AS (SELECT row, id, i, max(n) AS n FROM longest GROUP BY ALL),
told AS (SELECT row, max(n) AS longest,
    string_agg(concat_ws(':', id, CAST(i AS VARCHAR), CAST(n AS VARCHAR)), ',' ORDER BY id, i) AS locations
  FROM hits GROUP BY row),
named AS (SELECT row, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT row, id FROM found) GROUP BY row),
covered AS (SELECT row, count(DISTINCT word) AS n
  FROM (SELECT row, unnest(range(i, i + size)) AS word FROM found) GROUP BY row)
SELECT doc_id, len(w) AS n_words, coalesce(covered.n, 0) AS n_hit, coalesce(named.n, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, covered.n IS NOT NULL AS contaminated,
  CAST(coalesce(longest, 0) AS BIGINT) AS longest_match, coalesce(locations, '') AS locations
FROM docs LEFT JOIN told USING (row) LEFT JOIN named USING (row) LEFT JOIN covered USING (row)
"""


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(read(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, train(docs, read(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        F.coalesce(fold("doc_id") % 3 == 1, F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract(read(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    line = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    base = F.filter("spans", lambda s: s["kind"] != "dense")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        F.col("id").alias("doc_id"),
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(F.array_join(F.transform(base, line), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", line), ",").alias("spans"),
        count("dense").alias("n_dense"),
    )


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_groups(read(spark, sf_dir, "documents"), words=3, distance=3, seed=42)
    return groups.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


#: Host, path and verdict of the rules.
RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    judged = judge(read(spark, sf_dir, "pages"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


OP10_SQL = f"""
WITH RECURSIVE placed AS (SELECT page_id, html,
    translate(coalesce(regexp_extract(url, {_quoted(URL)}, 1), ''), '{UPPER}', '{LOWER}') AS host,
    coalesce(regexp_extract(url, {_quoted(URL)}, 2), '') AS path FROM pages),
rules(above, start, said) AS (VALUES {", ".join(map(str, RULES))}),
best AS (SELECT host, path, above || start AS rule, said
  FROM (SELECT DISTINCT host, path FROM placed) JOIN rules
  ON (host = above OR ends_with(host, '.' || above)) AND starts_with(path, start)
  QUALIFY row_number() OVER (PARTITION BY host, path ORDER BY length(rule) DESC, rule DESC) = 1),
ruled AS (SELECT page_id, host, path, rule, said FROM placed LEFT JOIN best USING (host, path)),
links AS (SELECT host AS src, dst, count(*) AS n
  FROM (SELECT host, translate(unnest(regexp_extract_all(html, {_quoted(LINK)}, 1)), '{UPPER}', '{LOWER}') AS dst
    FROM placed WHERE host <> '') WHERE host <> dst GROUP BY ALL),
ways AS (SELECT 'trust' AS kind, src, dst, n FROM links UNION ALL SELECT 'distrust', dst, src, n FROM links),
edges AS (SELECT kind, src, dst, n / sum(n) OVER (PARTITION BY kind, src) AS w FROM ways),
seeds AS (SELECT host, avg((said IS NOT DISTINCT FROM 'allow')::INT) AS good,
    avg((said IS NOT DISTINCT FROM 'block')::INT) AS bad FROM ruled WHERE host <> '' GROUP BY host),
score0 AS (SELECT kind, host, {1 - DAMPING} * share AS score
  FROM (SELECT 'trust' AS kind, host, good AS share FROM seeds UNION ALL SELECT 'distrust', host, bad FROM seeds)
  WHERE share > 0),
passed AS (SELECT kind, host, score, 0 AS round FROM score0
  UNION ALL SELECT e.kind, e.dst, sum({DAMPING} * p.score * e.w), p.round + 1
  FROM passed p JOIN edges e ON p.kind = e.kind AND p.host = e.src
  GROUP BY e.kind, e.dst, p.round HAVING sum(p.score) > {TOLERANCE} / 1e9),
judged AS (SELECT host, coalesce(sum(score) FILTER (kind = 'trust'), 0) AS trust,
    coalesce(sum(score) FILTER (kind = 'distrust'), 0) AS distrust FROM passed GROUP BY host)
SELECT page_id, host, path, rule,
  coalesce(said, CASE WHEN coalesce(distrust, 0) - coalesce(trust, 0) > {MARGIN} THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled LEFT JOIN judged USING (host)
"""


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_packing,
        op2_exact_dedup,
        op3_chat,
        op4_decontamination,
        op5_suffix_dedup,
        op6_toxicity,
        op7_html,
        op8_secrets,
        op9_simhash,
        op10_urls,
        pipeline,
    )
} | mix_queries.QUERIES | manifest_queries.QUERIES | trie_queries.QUERIES
SQL: dict[str, str] = {
    "op2_exact_dedup": OP2_SQL,
    "op3_chat": OP3_SQL,
    "op4_decontamination": OP4_SQL,
    "op10_urls": OP10_SQL,
} | mix_queries.SQL | manifest_queries.SQL | trie_queries.SQL
