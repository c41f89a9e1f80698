"""Merkle manifest of a dataset: content-addressed records, and proofs by descent from the root."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopgrain.llm.places import numbered
from shopgrain.session import materialize

BITS = 3
FAN = 1 << BITS  # children of a node
LEVELS = 20  # 8 ** 20 leaves are more than a long can number

SEGMENT = "struct<before: string, after: string>"


def field(column: Column) -> Column:
    """A value as it enters a digest: ``-`` for null, else its UTF-8 byte count, a colon and the value."""
    value = column.cast("string")
    told = F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)
    return F.when(value.isNull(), "-").otherwise(told)


def leaf_digest(*columns: Column) -> Column:
    return F.sha2(F.concat(*(field(c) for c in columns)), 256)


def node_digest(children: Column) -> Column:
    return F.sha2(F.array_join(children, ""), 256)


@dataclass
class Manifest:
    """``records``: ``height``, ``digest``, ``children``; ``trees``: ``tree``, ``height``, ``digest`` of each root;
    ``leaves``: ``tree``, ``rank``, ``digest`` and the columns carried along."""

    records: DataFrame
    trees: DataFrame
    leaves: DataFrame
    height: int  # of the tallest tree


def build(leaves: DataFrame) -> Manifest:
    """Trees over ``leaves`` (``tree``, ``rank`` from 0, ``digest``; other columns are carried along).

    While a tree has several nodes, every 8 consecutive ones become the digest of their joined digests.
    Each level is one shuffle of digests; only the number of levels passes through the driver.
    Equal nodes, of repeated rows, share one record.
    """
    tall = reduce(lambda a, b: a + b, (F.when(F.col("n") > FAN**k, 1).otherwise(0) for k in range(LEVELS)))
    sizes = leaves.groupBy("tree").agg(F.count("*").alias("n")).select("tree", tall.alias("height"))
    placed = materialize(leaves.join(sizes, "tree"), "leaves")
    height = placed.agg(F.max("height")).first()[0] or 0
    level = placed.select("tree", "height", F.col("rank").alias("idx"), "digest")
    records, roots = [], [level.where("height = 0")]
    for k in range(1, height + 1):
        run = F.array_sort(F.collect_list(F.struct("idx", "digest")))
        children = (
            level.where(F.col("height") >= k)
            .groupBy("tree", "height", F.shiftright("idx", BITS).alias("up"))
            .agg(F.transform(run, lambda c: c["digest"]).alias("children"))
        )
        parents = materialize(
            children.select(
                "tree", "height", F.col("up").alias("idx"), node_digest(F.col("children")).alias("digest"), "children"
            ),
            "nodes",
        )
        records.append(parents.select(F.lit(k).alias("height"), "digest", "children"))
        level = parents.select("tree", "height", "idx", "digest")
        roots.append(level.where(F.col("height") == k))
    empty = placed.sparkSession.createDataFrame([], "height int, digest string, children array<string>")
    return Manifest(
        materialize(reduce(DataFrame.unionByName, records, empty).dropDuplicates(["height", "digest"]), "records"),
        materialize(reduce(DataFrame.unionByName, roots).drop("idx"), "roots"),
        placed,
        height,
    )


def _beside(children: Column, digit: Column) -> Column:
    """The unselected children before and after the selected one."""
    at = digit.cast("int")
    return F.struct(
        F.array_join(F.slice(children, F.lit(1), at), "").alias("before"),
        F.array_join(F.slice(children, at + 2, F.lit(FAN)), "").alias("after"),
    )


def prove(manifest: Manifest, starts: DataFrame, requests: DataFrame | None = None) -> DataFrame:
    """Leaves with ``path``: what stands beside them at each level, from the leaf's own run up.

    ``starts`` holds the roots to descend from: ``tree``, ``height``, ``digest``, ``above`` (segments that lie
    above the root, topmost first) and columns to hand down. ``requests`` (``tree``, ``rank``) picks leaves; all by default.
    Requests that share a prefix of rank digits descend together: a node is looked up once however
    many leaves lie below it, so the root is no hot key. At each level the digit selects a child and
    the others are collected; at the end the segments are reversed.
    """
    handed = [c for c in starts.columns if c not in ("tree", "height", "digest", "above")]
    frontier = None
    for k in range(manifest.height, 0, -1):
        fresh = starts.where(F.col("height") == k).select(
            "tree", F.lit(0).cast("long").alias("idx"), "digest", "above", *handed
        )
        frontier = fresh if frontier is None else frontier.unionByName(fresh)
        records = manifest.records.where(F.col("height") == k).select("digest", "children")
        found = frontier.join(records, "digest")
        if k == 1:
            frontier = found
            break
        digits = found.select("*", F.posexplode("children").alias("digit", "child"))
        frontier = digits.select(
            "tree",
            (F.shiftleft("idx", BITS) + F.col("digit")).alias("idx"),
            F.col("child").alias("digest"),
            F.concat("above", F.array(_beside(F.col("children"), F.col("digit")))).alias("above"),
            *handed,
        )
        if requests is not None:
            wanted = requests.select("tree", F.shiftright("rank", BITS * (k - 1)).alias("idx")).distinct()
            frontier = frontier.join(wanted, ["tree", "idx"], "left_semi")
    lone = starts.where("height = 0").select(
        "tree", F.lit(0).cast("long").alias("idx"), F.lit(None).cast("array<string>").alias("children"), "above", *handed
    )
    runs = lone if frontier is None else lone.unionByName(frontier.drop("digest"))
    leaves = manifest.leaves if requests is None else manifest.leaves.join(requests, ["tree", "rank"], "left_semi")
    met = leaves.withColumn("idx", F.shiftright("rank", BITS)).join(runs, ["tree", "idx"])
    own = F.array(_beside(F.col("children"), F.col("rank") % FAN))
    path = F.reverse(F.when(F.col("children").isNull(), F.col("above")).otherwise(F.concat("above", own)))
    return met.select(*leaves.columns, *handed, path.alias("path"))


def proof_digest(path: Column) -> Column:
    """The digest of all siblings, level by level from the leaf up."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["before"], node, s["after"]), 256))


def prove_all(leaves: DataFrame, group: str, order: str, requests: DataFrame | None = None) -> tuple[DataFrame, str | None]:
    """Proofs of ``leaves`` (``group``, ``order``, ``digest`` and other columns), and the root of all.

    A tree for each value of ``group`` over its leaves by ``order`` (nulls first, equal ones by digest), and one
    over their roots by ``group`` (null first, by bytes). Returns the leaves' columns with ``subroot`` and
    ``path``; the root is None for an empty table. ``requests`` picks groups and ranks to prove.
    """
    groups = numbered(leaves.select(group).distinct().withColumn("all", F.lit(0)), "all", [group], "tree")
    groups = materialize(groups.select(F.col(group).alias("__group"), "tree"), "groups")
    ranked = numbered(leaves, group, [order, "digest"], "rank")
    placed = ranked.join(groups, F.col(group).eqNullSafe(F.col("__group"))).drop("__group")
    low = build(placed)
    top = build(
        low.trees.select(
            F.lit(0).cast("long").alias("tree"), F.col("tree").alias("rank"), "digest", F.col("height").alias("tall")
        )
    )
    first = top.trees.first()
    none = F.array().cast(f"array<{SEGMENT}>")
    tops = prove(top, top.trees.withColumn("above", none))
    starts = tops.select(
        F.col("rank").alias("tree"),
        F.col("tall").alias("height"),
        "digest",
        F.reverse("path").alias("above"),
        F.col("digest").alias("subroot"),
    )
    if requests is not None:
        requests = requests.join(groups, F.col(group).eqNullSafe(F.col("__group"))).select("tree", "rank")
    found = prove(low, materialize(starts, "starts"), requests)
    return found.select(*leaves.columns, "rank", "subroot", "path"), first and first["digest"]

