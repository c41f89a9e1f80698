"""What the physical plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

from shopgrain.catalog import REGISTRY
from shopgrain.operators import changes
from shopgrain.plans import gold
from shopgrain.session import materialize, scratch_path, shared_dir
from shopgrain.sources.conform import Retail


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


LAZY = sorted(
    n
    for n in REGISTRY
    if n.startswith(("silver", "dim", "fact", "gold_d", "gold_i", "metric", "agg", "merge", "scd", "join"))
)


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python(spark, sf_dir, name):
    text = plan(REGISTRY[name](spark, sf_dir))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "MapInPandas"):
        assert operator not in text


def test_scores_need_no_shuffle_and_no_single_task(spark, sf_dir):
    t = Retail(spark, sf_dir)
    base = materialize(gold.rfm_base(t.order_lines, t.as_of), "rfm_base")
    text = plan(gold.rfm_scores(base, rows_per_bucket=20))
    assert "Exchange" not in text and "Window" not in text


def test_latest_per_key_limits_before_the_shuffle(spark, sf_dir):
    text = plan(gold.current_stock(Retail(spark, sf_dir).silver_inventory))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_sales_read_only_what_they_need(spark, sf_dir):
    text = plan(gold.daily_sales(Retail(spark, sf_dir).order_profit))
    assert "l_tax" not in text and "c_acctbal" not in text and "s_name" not in text


def test_supplier_lookup_disappears_when_unused(spark, sf_dir):
    products = Retail(spark, sf_dir).silver_products
    assert "l_suppkey" in plan(products)
    assert "l_suppkey" not in plan(products.select("product_id", "cost_price"))


def test_high_water_mark_is_a_scalar_subquery(spark):
    path = scratch_path(spark, "hw")
    spark.range(100).select("id", F.timestamp_seconds("id").alias("at")).write.parquet(path)
    source = spark.read.parquet(path)
    text = plan(changes.new_rows(source, source.where("id < 50"), "at"))
    assert "Subquery" in text and "Join" not in text
    assert changes.new_rows(source, source.where("id < 50"), "at").count() == 50


def test_shared_dir_follows_the_session_setting(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_dir(spark) == configured.rstrip("/")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


class FakeContext:
    master = "spark://host:7077"

    def getCheckpointDir(self):
        return None


class FakeConf:
    def get(self, key, default=None):
        return default


class FakeSession:
    conf, sparkContext = FakeConf(), FakeContext()


def test_a_cluster_without_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(FakeSession())
