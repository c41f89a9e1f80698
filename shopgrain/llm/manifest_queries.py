"""The registered query of the manifest and its reference SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopgrain.llm.common import read
from shopgrain.llm.manifest import FAN, fold, leaf_digest, proof_digest, prove_all
from shopgrain.llm.urls import LOWER, UPPER

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all documents, and whether they hold for the documents as they were tampered with.

    Repeated ids are ranked by digest, null ids come first and are never tampered with.
    """
    docs = read(spark, sf_dir, "documents").select(*FIELDS)
    whole = leaf_digest(*(F.col(c) for c in FIELDS))
    lower = leaf_digest(*(F.translate(c, UPPER, LOWER) if c == "text" else F.col(c) for c in FIELDS))
    hit = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    leaves = docs.select(
        "doc_id", "lang", whole.alias("digest"), F.when(hit, lower).otherwise(whole).alias("given")
    )
    proofs, root = prove_all(leaves, "lang", "doc_id")
    folded = fold(F.col("given"), F.col("path"))
    return proofs.select(
        "doc_id",
        F.col("digest").alias("leaf"),
        "subroot",
        F.lit(root).alias("root"),
        proof_digest(F.col("path")).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def crc32_sql(value: str) -> str:
    """The unsigned CRC-32 of a number's decimal text in SQL, bit by bit."""
    byte = "list_reduce([xor(crc, x)] || range(8), lambda c, i: xor(c >> 1, 3988292384 * (c & 1)))"
    digits = f"list_transform(string_split(CAST({value} AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))"
    return f"xor(list_reduce([4294967295::BIGINT] || {digits}, lambda crc, x: {byte}), 4294967295)"


def _value(column: str) -> str:
    text = f"CAST({column} AS VARCHAR)"
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE strlen({text}) || ':' || {text} END"


_LEVELS = 8  # 8 ** 8 documents of a language


def _tree(name: str, start: str) -> str:
    """One table a level, with the siblings before and after each node; a lone node stays as it is."""
    lines = []
    for k in range(_LEVELS + 1):
        if k:
            start = f"""SELECT tree, idx // {FAN} AS idx,
    CASE WHEN any_value(size) > 1 THEN sha256(string_agg(digest, '' ORDER BY idx)) ELSE any_value(digest) END AS digest
  FROM {name}{k - 1} GROUP BY tree, idx // {FAN}"""
        run = f"OVER (PARTITION BY tree, idx // {FAN} ORDER BY idx ROWS BETWEEN"
        lines.append(f"""{name}{k} AS MATERIALIZED (SELECT *, count(*) OVER (PARTITION BY tree) AS size,
  coalesce(string_agg(digest, '') {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS pre,
  coalesce(string_agg(digest, '') {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS post FROM ({start}))""")
    return ",\n".join(lines)


def _climb(name: str) -> str:
    """Proof and folded digest, one level after the other, from ``{name}_0``."""
    return ",\n".join(
        f"""{name}_{k + 1} AS (SELECT c.* REPLACE (proof || pre || post AS proof,
    CASE WHEN size > 1 THEN sha256(pre || folded || post) ELSE folded END AS folded)
  FROM {name}_{k} c JOIN {name}{k} n ON c.tree = n.tree AND c.idx // {FAN**k} = n.idx)"""
        for k in range(_LEVELS)
    )


OP12_SQL = f"""
WITH docs AS (SELECT *, CASE WHEN {crc32_sql("doc_id")} % 3 = 0
    THEN translate(text, '{UPPER}', '{LOWER}') ELSE text END AS given FROM documents),
hashed AS (SELECT doc_id, lang, sha256({" || ".join(_value(c) for c in FIELDS)}) AS leaf,
  sha256({" || ".join(_value("given" if c == "text" else c) for c in FIELDS)}) AS folded FROM docs),
leaves AS MATERIALIZED (SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
  row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM hashed),
{_tree("low", "SELECT tree, idx, leaf AS digest FROM leaves")},
{_tree("top", f"SELECT 0 AS tree, tree AS idx, digest FROM low{_LEVELS}")},
low_0 AS (SELECT *, '' AS proof FROM leaves),
{_climb("low")},
top_0 AS (SELECT doc_id, leaf, 0 AS tree, tree AS idx, proof, folded FROM low_{_LEVELS}),
{_climb("top")}
SELECT doc_id, leaf, low{_LEVELS}.digest AS subroot, top{_LEVELS}.digest AS root, sha256(proof) AS proof_sha256,
  folded AS folded_root, folded = top{_LEVELS}.digest AS verified
FROM top_{_LEVELS} c JOIN low{_LEVELS} ON c.idx = low{_LEVELS}.tree, top{_LEVELS}
"""

QUERIES = {"op12_manifest": op12_manifest}
SQL = {"op12_manifest": OP12_SQL}
