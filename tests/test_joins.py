from pyspark.sql import functions as F

from shopgrain.operators.joins import hot_keys, lookup_join
from shopgrain.sources.conform import as_text


def skewed(spark, n=3000):
    """A third of the rows has one key; some keys are null or unknown."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 100 == 1, None).otherwise(F.col("id") % 211)
    return spark.range(n).repartition(8).select("id", key.alias("k"))


def lookup(spark):
    return spark.range(200).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("name"))


def test_hot_keys_finds_the_hot_key(spark):
    found = hot_keys(skewed(spark, 100_000), "k", share=0.1, min_splits=0, sample=0.2)
    assert found == [7]
    assert hot_keys(skewed(spark), "k") == []


def test_hot_null_key_is_found(spark):
    df = skewed(spark, 50_000).withColumn("k", F.when(F.col("k") != 7, F.col("k")))
    assert None in hot_keys(df, "k", share=0.1, min_splits=0, sample=0.2)


def test_salted_join_equals_plain_join(spark, rows):
    left, right = skewed(spark), lookup(spark)
    for how in ("left", "inner"):
        plain = left.join(right, "k", how).select("k", "id", "name")
        for hot in ([7], [7, None], [None], list(range(50))):
            salted = lookup_join(left, right, "k", how, hot).select("k", "id", "name")
            assert rows(salted) == rows(plain)


def test_salt_spreads_the_hot_key(spark):
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        joined = lookup_join(skewed(spark), lookup(spark).hint("merge"), "k", "left", [7])
        sizes = joined.groupBy(F.spark_partition_id(), "k").count().where("k = 7").collect()
    finally:
        spark.conf.unset(coalesce)
    assert len(sizes) > 2 and max(r["count"] for r in sizes) < 600


def test_null_hot_key_stays_null_and_is_spread(spark):
    assert as_text([7, None]) == ["7", None]
    left = skewed(spark).withColumn("k", F.col("k").cast("string"))
    right = lookup(spark).withColumn("k", F.col("k").cast("string"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lookup_join(left, right, "k", "left", as_text([7, None]))
        parts = joined.where("k IS NULL").select(F.spark_partition_id().alias("p")).distinct().count()
        assert joined.count() == left.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert parts >= 1
