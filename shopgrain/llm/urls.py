"""URL filtering by rules and by trust spread over host links, in DataFrame operations only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopgrain.session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LINK = r"""(?is)\shref\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s>]+)"""
DAMPING = 0.85
#: A host is blocked if its distrust exceeds its trust by the weight of a seed with half of its pages blocked.
MARGIN = 0.5 * (1 - DAMPING)
#: Scores miss less than this, far below the margin.
TOLERANCE = MARGIN / 1000
#: Rounds whose plans are run as one job.
ROUNDS_PER_JOB = 4


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z in lower case; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def by_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """For each distinct ``host`` and ``path``, the longest rule that fits: ``rule`` and ``rule_verdict``.

    ``rules``: ``host``, ``path`` (from its slash on), ``verdict``. A rule fits its host and all
    subdomains if the path starts with the rule's. Of equally long ones the greater text wins.
    """
    places = urls.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    suffix = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    known = rules.select(
        F.col("host").alias("suffix"),
        F.col("path").alias("start"),
        F.concat("host", "path").alias("rule"),
        F.col("verdict").alias("rule_verdict"),
    )
    fitting = (
        places.select("host", "path", F.explode(suffix).alias("suffix"))
        .join(known, "suffix")
        .where(F.startswith("path", "start"))
    )
    best = F.max(F.struct(F.length("rule").alias("n"), "rule", "rule_verdict")).alias("best")
    return (
        fitting.groupBy("host", "path").agg(best).select("host", "path", "best.rule", "best.rule_verdict")
    )


def host_links(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``src``, ``dst``, ``n``: links between different hosts; relative links stay on their host."""
    links = pages.where("host <> ''").select(
        F.col("host").alias("src"),
        F.explode(F.regexp_extract_all(html_col, F.lit(LINK), 1)).alias("dst"),
    )
    return (
        links.withColumn("dst", F.translate("dst", UPPER, LOWER))
        .where("src <> dst")
        .groupBy("src", "dst")
        .agg(F.count("*").alias("n"))
    )


def spread(
    seeds: DataFrame, links: DataFrame, tolerance: float = TOLERANCE, damping: float = DAMPING
) -> DataFrame:
    """``host``, ``trust``, ``distrust`` by personalised PageRank.

    ``seeds``: ``host``, ``good``, ``bad``. Trust runs along links, distrust against them: who
    links to a blocked host is doubted. Both are one table with a ``kind``, so a round is one join and
    one aggregation that combines before the shuffle. Mass on hosts without links is dropped.
    A round passes on what the one before brought. All later rounds together bring ``damping / (1 - damping)``
    of the last one's mass at most, and rounds go on until that is below ``tolerance``, so no score misses more.
    """
    both = links.select(F.lit("trust").alias("kind"), F.col("src").alias("at"), F.col("dst").alias("to"), "n").union(
        links.select(F.lit("distrust"), F.col("dst"), F.col("src"), "n")
    )
    total = both.groupBy("kind", "at").agg(F.sum("n").alias("total"))
    edges = materialize(
        both.join(total, ["kind", "at"]).select("kind", "at", "to", (F.col("n") / F.col("total")).alias("w")),
        "host-links",
    )
    start = materialize(
        seeds.select(
            "host",
            F.explode(
                F.array(
                    F.struct(F.lit("trust").alias("kind"), F.col("good").alias("seed")),
                    F.struct(F.lit("distrust").alias("kind"), F.col("bad").alias("seed")),
                )
            ).alias("s"),
        )
        .select("s.kind", F.col("host").alias("at"), ((1 - damping) * F.col("s.seed")).alias("score"))
        .where("score > 0"),
        "seeds",
    )
    score = arrived = start
    left = 0.0 if edges.isEmpty() else float("inf")
    while left > tolerance:
        came = []
        for _ in range(ROUNDS_PER_JOB):
            passed = (came[-1] if came else arrived).join(edges, ["kind", "at"]).select(
                "kind", F.col("to").alias("at"), (damping * F.col("score") * F.col("w")).alias("score")
            )
            came.append(passed.groupBy("kind", "at").agg(F.sum("score").alias("score")))
        # The rounds of a job as one table: what each brought, told by its number.
        numbered = [c.select("kind", "at", "score", F.lit(i).alias("round")) for i, c in enumerate(came)]
        block = materialize(reduce(DataFrame.unionAll, numbered), "trust-rounds")
        arrived = block.where(F.col("round") == ROUNDS_PER_JOB - 1).drop("round")
        brought = score.unionAll(block.drop("round")).groupBy("kind", "at")
        score = materialize(brought.agg(F.sum("score").alias("score")), "trust")
        left = (arrived.agg(F.sum("score")).first()[0] or 0.0) * damping / (1 - damping)
    part = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("score")).otherwise(0.0)).alias(kind)
    return score.groupBy(F.col("at").alias("host")).agg(part("trust"), part("distrust"))


def judge(
    pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """``id_col``, ``host``, ``path``, ``rule``, ``verdict``, ``trust``, ``distrust`` for each page.

    The longest fitting rule decides; else the host's trust and distrust do, which spread over
    links from seeds: hosts by the share of their pages that rules allow or block. A host without
    evidence is allowed. A null url, or one without ``://``, has an empty host and path, fits no
    rule and is allowed. Null html has no links. Repeated rows are judged each.
    """
    placed = pages.select(
        F.col(id_col).alias("__id"),
        host_of(F.col(url_col)).alias("host"),
        path_of(F.col(url_col)).alias("path"),
        F.col(html_col).alias("html"),
    )
    slim = materialize(placed.drop("html"), "urls")
    ruled = materialize(by_rules(slim, rules), "ruled")
    joined = slim.join(ruled, ["host", "path"], "left")
    share = lambda verdict: F.avg(F.when(F.col("rule_verdict") == verdict, 1.0).otherwise(0.0))
    seeds = joined.where("host <> ''").groupBy("host").agg(
        share("allow").alias("good"), share("block").alias("bad")
    )
    scores = materialize(spread(seeds, host_links(placed)), "host-scores")
    doubted = F.coalesce("distrust", F.lit(0.0)) - F.coalesce("trust", F.lit(0.0)) > MARGIN
    method = F.when(doubted, F.lit("block")).otherwise(F.lit("allow"))
    return joined.join(scores, "host", "left").select(
        F.col("__id").alias(id_col),
        "host",
        "path",
        "rule",
        F.coalesce("rule_verdict", method).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"),
        F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )
