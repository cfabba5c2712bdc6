"""What the plans look like, and that skewed keys are split."""

import contextlib
import io
import re

import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F
from small import small_models

import __spark_entry__ as entry
from parcelwise.operators.split import stratified_split
from parcelwise.plans import marts
from parcelwise.schemas import RAW_TABLES
from parcelwise.session import scratch_dir
from parcelwise.sources import layers
from workload.registry import models_over


def plan_of(rows):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        rows.explain("formatted")
    return text.getvalue()


def final_plan(rows):
    """The plan as adapted while it ran."""
    return rows._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def settings(spark):
    """Set session options for one test."""
    before = {}

    def change(**options):
        for key, value in options.items():
            key = key.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture(scope="module")
def stored(spark):
    """Models over source tables stored as Parquet."""
    raw = models_over(spark, TESTDATA).raw
    folder = scratch_dir(spark, "stored-raw")
    names = [*RAW_TABLES, "ml_predictions"]
    return small_models(spark, **layers.store_models(spark, {name: raw[name] for name in names}, names, folder))


def test_filters_and_columns_reach_the_scan(stored):
    plan = plan_of(stored.mart_delivery_kpis)
    assert "EqualTo(order_status,delivered)" in plan
    assert "IsNotNull(order_delivered_customer_date)" in plan
    orders = next(line for line in plan.splitlines() if "ReadSchema" in line and "order_status" in line)
    assert "order_approved_at" not in orders and "order_id" not in orders
    customers = next(line for line in plan.splitlines() if "ReadSchema" in line and "customer_state" in line)
    assert "customer_city" not in customers and "customer_unique_id" not in customers


def test_review_text_is_not_read_for_the_sentiment_mart(stored):
    assert "review_comment_message" not in plan_of(stored.mart_sentiment_kpis)


def test_category_card_joins_customers_only_for_the_state(stored):
    from workload.relational import card6

    assert "customer_state" not in plan_of(card6(stored))
    assert "customer_state" in plan_of(card6(stored, "NATION_1"))


def test_item_totals_and_first_seller_share_one_shuffle(stored, settings):
    settings(spark__sql__adaptive__enabled="false", spark__sql__autoBroadcastJoinThreshold="10m")
    rows = marts.items_per_order(stored.stg_order_items, stored.dim_products, "product_id", "seller_id")
    assert plan_of(rows).count("hashpartitioning(order_id") == 1


# the rest run jobs while they are built
LAZY = [name for name in sorted(entry.queries()) if not name.startswith(("a", "l", "m9", "e12", "e15", "n6"))]


@pytest.mark.parametrize("name", LAZY)
def test_no_query_pairs_everything_with_everything(spark, name):
    plan = plan_of(entry.queries()[name](spark, TESTDATA))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


SPLITTING = {
    "spark__sql__adaptive__forceOptimizeSkewedJoin": "false",  # the plans must not need it
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20k",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.5",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "10k",
    "spark__sql__adaptive__coalescePartitions__enabled": "false",
    "spark__sql__shuffle__partitions": "16",
}


def hot(rows, columns, share=3):
    """One row in ``share`` gets the same value in the given columns."""
    spread = F.xxhash64(*rows.columns) % share == 0
    return rows.withColumns({column: F.when(spread, value).otherwise(F.col(column)) for column, value in columns.items()})


@pytest.fixture(scope="module")
def skewed(spark, stored):
    """A third of the rows share one customer, product, seller, postal prefix and reviewed order."""
    folder = scratch_dir(spark, "skewed")
    frames = {
        "orders": hot(stored.raw["orders"], {"customer_id": "1"}),
        "order_items": hot(stored.raw["order_items"], {"product_id": "1", "seller_id": "1"}),
        "order_reviews": hot(stored.raw["order_reviews"], {"order_id": "1"}),
        "customers": hot(stored.raw["customers"], {"customer_zip_code_prefix": "00001"}),
    }
    wide = {name: rows.repartition(8) for name, rows in frames.items()}  # several map outputs, as on a cluster
    tables = layers.store_models(spark, wide, list(wide), folder)
    return small_models(spark, **{**{name: stored.raw[name] for name in [*RAW_TABLES, "ml_predictions"]}, **tables})


@pytest.mark.parametrize("name", ["fact_orders", "fact_order_items", "fact_reviews", "mart_late_delivery_features"])
def test_a_hot_key_is_split_and_changes_no_row(skewed, settings, name):
    plainly = sorted(map(str, skewed[name].collect()))
    settings(**SPLITTING)
    rows = small_models(skewed.spark, **skewed.raw)[name]
    assert sorted(map(str, rows.collect())) == plainly
    assert "skew=true" in final_plan(rows)


def test_a_hot_postal_prefix_is_split(skewed, settings):
    settings(
        **{
            **SPLITTING,
            "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "1k",
            "spark__sql__adaptive__advisoryPartitionSizeInBytes": "1k",
        }
    )
    prefix = F.when(F.xxhash64("order_id") % 3 == 0, "00001").otherwise(F.lpad("order_id", 5, "0"))
    buyers = skewed.raw["orders"].select(
        F.col("order_id").alias("customer_id"), prefix.alias("zip_code_prefix"), F.col("order_status").alias("estado")
    )
    rows = marts.located(buyers, skewed.dim_geolocation, "customer_id", "customer")
    assert len(rows.collect()) == buyers.count()
    assert "skew=true" in final_plan(rows)


def test_the_delivery_mart_sums_per_customer_before_the_join(skewed, settings):
    settings(spark__sql__adaptive__enabled="false", spark__sql__autoBroadcastJoinThreshold="-1")
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        skewed.mart_delivery_kpis.explain()
    lines = text.getvalue().splitlines()
    shuffle = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning(customer_id" in line)
    assert "partial_count" in lines[shuffle + 1]


def test_the_split_shuffles_no_rows_by_class(spark, settings):
    settings(spark__sql__adaptive__enabled="false", spark__sql__autoBroadcastJoinThreshold="-1")
    rows = spark.range(40000).selectExpr("id as k", "if(id % 3 = 0, 'x', 'y') as label", "id * 2 as payload")
    labelled = stratified_split(rows, "label", "k")
    assert labelled.filter("split = 'test'").count() == 8000
    shuffles = [part for part in plan_of(labelled).split("\n\n") if ") Exchange" in part.splitlines()[0]]
    assert shuffles and not any("payload" in part for part in shuffles)


def test_stored_marts_look_hashed_keys_up_as_bytes(spark, settings):
    settings(spark__sql__adaptive__enabled="false", spark__sql__autoBroadcastJoinThreshold="-1")
    names = ("fact_orders", "fact_order_items", "fact_payments", "fact_reviews", "dim_customers", "dim_sellers", "dim_products", "dim_geolocation")
    stored = small_models(spark).store(scratch_dir(spark, "facts"), names)
    for mart in ("mart_delivery_kpis", "mart_sentiment_kpis", "mart_ml_results", "mart_late_delivery_features"):
        joins = re.findall(r"(?:Left|Right) keys \[\d+\]: \[(\w+_key#\d+)", plan_of(stored[mart]))
        plan = stored[mart]._jdf.queryExecution().optimizedPlan().toString()
        assert joins and all(f"AS {key}" in plan for key in joins), mart  # no digits of a stored column
    assert all(path.endswith(".zstd.parquet") for path in stored.fact_orders.inputFiles())


def test_items_are_shuffled_by_product_only_to_be_stored(spark, settings):
    settings(spark__sql__adaptive__enabled="false", spark__sql__autoBroadcastJoinThreshold="-1")
    names = ("fact_orders", "fact_order_items", "fact_payments", "dim_customers", "dim_sellers", "dim_products", "dim_geolocation")
    plain = small_models(spark)
    expected, columns = sorted(map(str, plain.mart_late_delivery_features.collect())), plain.fact_order_items.columns
    stored = plain.store(scratch_dir(spark, "facts"), names)
    assert stored.fact_order_items.columns == columns
    mart = stored.mart_late_delivery_features
    assert "hashpartitioning(product_key" not in plan_of(mart)
    assert sorted(map(str, mart.collect())) == expected
