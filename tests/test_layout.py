from pyspark.sql import functions as F

from shopgrain.operators import layout
from shopgrain.operators.ranks import split_positions
from shopgrain.session import scratch_path


def test_compact_keeps_rows_and_reduces_files(spark):
    src, dst = scratch_path(spark, "src"), scratch_path(spark, "dst")
    spark.range(1000).repartition(20).write.parquet(src)
    out = layout.compact(spark, src, dst)
    assert layout.file_sizes(spark, src).count() == 20
    assert layout.file_sizes(spark, dst).count() == layout.files_for(spark, src) == 1
    assert out.agg(F.sum("id")).first()[0] == 499500


def test_zorder_lets_each_column_skip_files(spark):
    grid = spark.range(64 * 64).select(
        (F.col("id") % 64).alias("x"),
        F.floor(F.col("id") / 64).alias("y"),
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("z"),
    )
    out = layout.zorder(grid, scratch_path(spark, "z"), ["x", "y"], files=16)
    assert out.exceptAll(grid).count() == 0 and out.count() == 4096
    per_file = out.groupBy(F.col("_metadata.file_path")).agg(
        *[f(c).alias(f"{n}_{c}") for c in "xy" for n, f in (("lo", F.min), ("hi", F.max))]
    )
    for c in "xy":
        hit = per_file.where(f"lo_{c} <= 10 AND hi_{c} >= 10").count()
        assert hit <= per_file.count() / 2


def test_one_hot_value_still_spreads(spark):
    hot = spark.range(4000).select(F.lit(1).alias("x"), "id")
    out = layout.zorder(hot, scratch_path(spark, "h"), ["x"], files=8)
    sizes = [r["count"] for r in out.groupBy(F.col("_metadata.file_path")).count().collect()]
    assert len(sizes) >= 6 and max(sizes) < 1500


def test_morton_interleaves(spark):
    df = spark.createDataFrame([(0b11, 0b00), (0b00, 0b11), (0b10, 0b01)], "a int, b int")
    assert [r[0] for r in df.select(layout.morton([F.col("a"), F.col("b")], 2)).collect()] == [5, 10, 6]


def test_column_statistics(spark):
    df = spark.createDataFrame([(1, "x"), (None, "x"), (3, None)], "n int, s string")
    stats = {r.column_name: r for r in layout.column_statistics(df).collect()}
    assert (stats["n"].null_count, stats["n"].distinct_count, stats["n"].min_value) == (1, 2, "1")
    assert (stats["s"].row_count, stats["s"].distinct_count, stats["s"].max_value) == (3, 1, "x")


def test_estimated_profile_takes_one_scan(spark):
    path = scratch_path(spark, "profile")
    spark.range(20000).selectExpr("id", "id % 7 AS few", "cast(id % 3000 AS string) AS some").write.parquet(path)
    profile = layout.column_statistics(spark.read.parquet(path), exact=False)
    assert profile._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    stats = {r.column_name: r.distinct_count for r in profile.collect()}
    for column, exact in {"id": 20000, "few": 7, "some": 3000}.items():
        assert abs(stats[column] - exact) <= max(1, exact * layout.SKETCH_ERROR)


def test_all_cut_points_come_from_one_sample(spark):
    path = scratch_path(spark, "cuts")
    nothing = F.lit(None).cast("int")
    spark.range(20000).select("id", F.hex("id").alias("s"), nothing.alias("n")).write.parquet(path)
    df = spark.read.parquet(path)
    for place, parts in zip(split_positions(df, ["id", "s", "n"], 16), (16, 16, 1)):
        sizes = [r["count"] for r in df.groupBy(place.alias("p")).count().collect()]
        assert len(sizes) == parts and max(sizes) < 3 * 20000 / parts + 1


def test_zorder_runs_in_methods_the_jvm_compiles(spark, monkeypatch):
    from pyspark.sql import DataFrameWriter

    limit, limits = "spark.sql.codegen.hugeMethodLimit", []
    write = DataFrameWriter.parquet
    monkeypatch.setattr(
        DataFrameWriter, "parquet", lambda self, *a, **k: (limits.append(spark.conf.get(limit)), write(self, *a, **k))[1]
    )
    before = spark.conf.get(limit)
    grid = spark.range(3000).select("id", (F.col("id") % 64).cast("string").alias("s"), F.hex("id").alias("h"))
    out = layout.zorder(grid, scratch_path(spark, "m"), ["id", "s", "h"], files=4)
    assert limits == ["8000"] and spark.conf.get(limit) == before
    assert out.exceptAll(grid).count() == 0 and out.count() == 3000
