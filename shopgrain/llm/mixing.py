"""Mixing sources to target weights by Pareto order sampling, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopgrain.llm.common import text_of
from shopgrain.llm.places import numbered
from shopgrain.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
SEED = 11
#: Documents from the one on that no longer fits among which the rest of a target is filled up.
FILL = 1000


def source_targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``source``, ``rows``, ``source_size``, ``weight``, ``target`` from rows with ``source``, ``size``.

    Sources by code point, null last, get the weights in turn. Together they get ``share`` of all
    sizes; a target stops at ``most`` times its source's size and what is over goes to the
    others by weight, until none is above. Only one number, the words a unit of weight gets, passes
    through the driver; a round caps at least one more source.
    """
    sums = sized.groupBy("source").agg(
        F.count("*").alias("rows"), F.sum("size").cast("long").alias("source_size")
    )
    placed = numbered(
        sums.withColumn("last", F.col("source").isNull()).withColumn("all", F.lit(0)), "all", ["last", "source"], "nth"
    )
    turn = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("nth") % len(weights) + 1).cast("int"))
    sources = materialize(
        placed.select("source", "rows", "source_size", turn.alias("weight"))
        .withColumn("most", F.col("source_size") * F.lit(float(most))),
        "sources",
    )
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    budget = min(share, most) * total
    unit, full = 0.0, None
    while True:
        capped = F.col("most") <= F.lit(unit) * F.col("weight")
        row = sources.agg(
            F.count(F.when(capped, 1)).alias("full"),
            F.sum(F.when(capped, F.col("most"))).alias("given"),
            F.sum(F.when(~capped, F.col("weight"))).alias("weight"),
        ).first()
        if row["full"] == full or not row["weight"]:
            break
        full = row["full"]
        unit = (budget - (row["given"] or 0.0)) / row["weight"]
    return sources.withColumn("target", F.least("most", F.lit(unit) * F.col("weight"))).drop("most")


def odds(p: Column) -> Column:
    return p / (1 - p)


def pareto_rank(key: Column, chance: Column) -> Column:
    """Random odds divided by inclusion odds, null without a chance; the random number comes from a hexadecimal key."""
    number = F.conv(F.substring(key, 1, 13), 16, 10).cast("long")
    random = (number.cast("double") + 0.5) / F.lit(2.0**52)
    return F.try_divide(odds(random), odds(chance))


def pareto_sample(rows: DataFrame, fill: int = FILL) -> tuple[DataFrame, DataFrame]:
    """Fixed-size samples with unequal chances, one of each stratum, as (bounds, extras).

    ``rows``: ``source``, ``key`` (hexadecimal, random), ``size``, ``chance`` (of being drawn, below 1).
    The sample of a stratum has the sum of chance times size: documents are taken by ascending
    Pareto rank as long as they fit. ``bounds`` (source, rank, key) is the first document
    that doesn't; all before it are in. Of that and the ``fill`` - 1 next, those that still fit go in one after
    the other, and at last the smallest one left if the sum comes nearer by it: ``extras`` (source, key).
    Rows of one source and key are one document, drawn or left together.

    Ranks are dealt into even ranges, whose sums tell where the bound lies; only the documents around
    it, no more than a few ranges of each stratum, are looked at one by one.
    """
    rank = pareto_rank(F.col("key"), F.col("chance"))
    rows = rows.where("size > 0 AND chance > 0").withColumn("rank", rank)
    # Summed as decimals, so the order of the rows makes no difference.
    expected = (F.col("chance") * F.col("size")).cast("decimal(38,9)")
    strata = rows.groupBy("source").agg(
        F.count("*").alias("n"),
        F.round(F.sum(expected).cast("double"), 6).alias("aim"),
        F.avg("chance").alias("mean"),
    )
    # A range holds a thousand documents or the root of their number, whichever is more. Written, as the
    # mean may differ in its last bit when it is computed again.
    strata = materialize(
        strata.select(
            F.col("source").alias("of"),
            F.ceil(F.col("n") / F.greatest(F.lit(1000.0), F.sqrt("n"))).alias("ranges"),
            odds(F.col("mean")).alias("typical"),
            "aim",
        ),
        "strata",
    )
    scaled = F.col("rank") * F.col("typical")
    dealt = rows.join(strata, rows["source"].eqNullSafe(strata["of"])).select(
        "source",
        "key",
        "size",
        "rank",
        "aim",
        F.least(F.floor(scaled / (1 + scaled) * F.col("ranges")), F.col("ranges") - 1).alias("range"),
    )
    ordered = Window.partitionBy("source").orderBy("range")
    so_far = ordered.rowsBetween(Window.unboundedPreceding, 0)
    ranges = (
        dealt.groupBy("source", "range")
        .agg(F.sum("size").alias("words"), F.count_distinct("key").alias("n"), F.first("aim").alias("aim"))
        .withColumn("words_to", F.sum("words").over(so_far))
        .withColumn("n_to", F.sum("n").over(so_far))
        .withColumn("over", F.col("words_to") > F.col("aim"))
    )
    # From the range that holds the bound on, until `fill` documents follow it.
    whole = Window.partitionBy("source")
    around = (
        ranges.withColumn("edge", F.min(F.when(F.col("over"), F.col("n_to"))).over(whole))
        .where(F.col("over") & (F.col("n_to") - F.col("n") < F.col("edge") + fill))
        .select(
            F.col("source").alias("of"),
            F.col("range").alias("within"),
            F.min(F.col("words_to") - F.col("words")).over(whole).alias("before"),
        )
    )
    near = (
        dealt.join(around, dealt["source"].eqNullSafe(around["of"]) & (F.col("range") == F.col("within")))
        .groupBy("source", "key")
        .agg(
            F.sum("size").alias("size"),
            F.first("rank").alias("rank"),
            F.first("aim").alias("aim"),
            F.first("before").alias("before"),
        )
    )
    lined = Window.partitionBy("source").orderBy("rank", "key")
    running = F.col("before") + F.sum("size").over(lined.rowsBetween(Window.unboundedPreceding, 0))
    late = (
        near.withColumn("to", running)
        .where("to > aim")
        .withColumn("nth", F.row_number().over(lined))
        .where(F.col("nth") <= fill)
    )
    first = F.col("nth") == 1
    groups = materialize(
        late.groupBy("source").agg(
            F.max(F.when(first, F.struct("rank", "key"))).alias("bound"),
            F.max(F.when(first, F.col("aim") - F.col("to") + F.col("size"))).alias("left"),
            F.array_sort(F.collect_list(F.struct("nth", "size", "key"))).alias("docs"),
        ),
        "pareto-bounds",
    )
    start = F.struct(F.col("left"), F.array().cast("array<string>").alias("took"))

    def step(state: Column, doc: Column) -> Column:
        fits = doc["size"] <= state["left"]
        return F.struct(
            F.when(fits, state["left"] - doc["size"]).otherwise(state["left"]).alias("left"),
            F.when(fits, F.concat(state["took"], F.array(doc["key"]))).otherwise(state["took"]).alias("took"),
        )

    filled = groups.withColumn("state", F.aggregate("docs", start, step)).withColumn(
        "least",
        F.array_min(
            F.transform(
                F.filter("docs", lambda d: ~F.array_contains(F.col("state.took"), d["key"])),
                lambda d: F.struct(d["size"].alias("size"), d["nth"].alias("nth"), d["key"].alias("key")),
            )
        ),
    )
    nearer = F.col("least.size") < 2 * F.col("state.left")
    extras = filled.select(
        "source",
        F.explode(
            F.when(nearer, F.concat("state.took", F.array("least.key"))).otherwise(F.col("state.took"))
        ).alias("key"),
    )
    return groups.select("source", "bound.rank", "bound.key"), extras


def _key(id_col: str, text_col: str, seed: int) -> Column:
    name = F.coalesce(F.col(id_col).cast("string"), F.lit("-"))
    return F.md5(F.concat(F.lit(f"{seed}:"), name, F.lit(":"), text_of(text_col)))


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    """Source, size and random key of each document; the key comes from seed, id and text."""
    return docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).cast("string").alias("source"),
        F.regexp_count(text_of(text_col), F.lit(WORD)).cast("long").alias("size"),
        _key(id_col, text_col, seed).alias("key"),
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    seed: int = SEED,
) -> DataFrame:
    """How many copies of each document a mix of ``share`` times all words takes.

    Returns one row per document: ``id_col``, ``source``, ``size`` (words), ``source_size``, ``target`` (words
    of its source, see ``source_targets``), ``copies``, ``taken`` (copies times size). Every document gets
    the whole copies its source's target holds; one more goes to a Pareto order sample with the
    remaining share as chance. Documents are never cut, so a source may miss its target by less than half of its
    smallest document among those looked at.

    Null text counts as empty, null source is a source of its own (the last), a null id is an id. Repeated
    rows (same id, source and text) get the same copies. A source without words has target 0 and takes nothing.
    The key fixes the order, so reruns agree whatever the partitions. An empty table gives no rows.
    """
    sized = materialize(_sized(docs, id_col, text_col, source_col, seed), "sized")
    targets = source_targets(sized, weights, share, most)
    whole = F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0))
    plan = materialize(
        targets.select(
            F.col("source").alias("of"), "source_size", "target", whole.alias("whole")
        ).withColumn(
            "chance",
            F.coalesce(
                F.try_divide(F.col("target") - F.col("whole") * F.col("source_size"), F.col("source_size")), F.lit(0.0)
            ),
        ),
        "mix-plan",
    )
    known = sized.join(plan, sized["source"].eqNullSafe(plan["of"]))
    bounds, extras = pareto_sample(known.select("source", "key", "size", "chance"))
    bounds = bounds.select(
        F.col("source").alias("b_source"), F.col("rank").alias("b_rank"), F.col("key").alias("b_key"), F.lit(True).alias("b")
    )
    extras = extras.select(F.col("source").alias("x_source"), F.col("key").alias("x_key"), F.lit(True).alias("x"))
    rank = pareto_rank(F.col("key"), F.col("chance"))
    before = (rank < F.col("b_rank")) | ((rank == F.col("b_rank")) & (F.col("key") < F.col("b_key")))
    # No bound: everything with a chance fits.
    drawn = (F.col("chance") > 0) & (F.col("b").isNull() | before | F.col("x").isNotNull())
    return (
        known.join(bounds, F.col("source").eqNullSafe(F.col("b_source")), "left")
        .join(extras, F.col("source").eqNullSafe(F.col("x_source")) & (F.col("key") == F.col("x_key")), "left")
        .withColumn("copies", F.col("whole") + F.when(drawn & (F.col("size") > 0), 1).otherwise(0))
        .select(
            F.col("id").alias(id_col),
            "source",
            "size",
            "source_size",
            "target",
            "copies",
            (F.col("copies") * F.col("size")).alias("taken"),
            "key",
        )
    )


def draw(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mixed corpus: the documents' own columns, each row as often as ``mix`` takes it."""
    names = {c: f"__d{i}" for i, c in enumerate(docs.columns)}
    cols = [names[c] for c in (id_col, text_col, source_col)]
    inner = docs.toDF(*names.values())
    copies = mix(inner, *cols, **options).groupBy(F.col("key").alias("__key"), F.col("source").alias("__source")).agg(
        F.first("copies").alias("__copies")
    )
    seed = options.get("seed", SEED)
    keyed = inner.withColumn("__own", _key(cols[0], cols[1], seed))
    found = keyed.join(
        copies, (F.col("__own") == F.col("__key")) & F.col(cols[2]).cast("string").eqNullSafe(F.col("__source"))
    )
    times = F.when(F.col("__copies") > 0, F.sequence(F.lit(1), F.col("__copies").cast("int")))
    return found.withColumn("__nth", F.explode(times)).select(*(F.col(n).alias(c) for c, n in names.items()))
