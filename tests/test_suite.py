import pytest
from pyspark.sql import functions as F
from small import small_models

from parcelwise.operators import checks
from parcelwise.plans import suite


class Stored(dict):
    """Models by name, with replacements."""


def report(models, **replaced):
    names = {*suite.REQUIRED, *suite.UNIQUE, *suite.TUPLES, *suite.PARENTS.values(), "mart_sentiment_kpis"}
    frames = Stored({name: replaced.get(name, models[name]) for name in names})
    rows = suite.run_suite(frames).collect()
    return {(row.model, row.check_name): (row.violations, row.status) for row in rows}


@pytest.fixture(scope="module")
def models(spark):
    built = small_models(spark)
    # the small fixture has no duplicate keys; keep its frames in memory for the many runs below
    for name in {*suite.REQUIRED, *suite.UNIQUE, "mart_sentiment_kpis"}:
        built.__dict__[name] = built[name].cache()
    return built


def test_clean_data_passes_all_54(models):
    found = report(models)
    assert len(found) == 54
    assert {key: value for key, value in found.items() if value != (0, "pass")} == {}


FAULTS = [
    ("not_null", "dim_sellers", lambda m: m.dim_sellers.withColumn("seller_id", F.when(F.col("seller_id") != "s1", F.col("seller_id"))), "not_null_seller_id", 1),
    ("unique", "stg_orders", lambda m: m.stg_orders.unionAll(m.stg_orders.limit(2)), "unique_order_id", 2),
    ("accepted", "fact_reviews", lambda m: m.fact_reviews.withColumn("sentiment_label", F.lit("otimo")), "accepted_values_sentiment_label", 1),
    ("relationship", "fact_order_items", lambda m: m.fact_order_items.withColumn("seller_key", F.lit("gone")), "relationships_seller_key", 5),
    ("tuple", "stg_order_reviews", lambda m: m.stg_order_reviews.unionAll(m.stg_order_reviews.limit(1)), "unique_review_id_order_id", 1),
    ("days", "fact_orders", lambda m: m.fact_orders.withColumn("delivery_days", F.when(F.col("order_id") == "o1", -1).otherwise(1)), "delivery_days_not_negative", 1),
    ("coherent", "fact_orders", lambda m: m.fact_orders.withColumn("is_late", F.col("is_late").isNotNull()), "is_late_coherent", 2),
    ("shares", "mart_sentiment_kpis", lambda m: m.mart_sentiment_kpis.withColumn("pct_neutro", F.lit(9.0)), "shares_sum_to_one", 2),
]


@pytest.mark.parametrize("model, fault, check, violations", [fault[1:] for fault in FAULTS], ids=[fault[0] for fault in FAULTS])
def test_a_planted_fault_is_reported_by_its_check_alone(models, model, fault, check, violations):
    found = report(models, **{model: fault(models)})
    failing = {key: value[0] for key, value in found.items() if value[1] == "fail"}
    assert failing == {(model, check): violations}


def test_checks_return_the_violating_rows(frame):
    rows = frame("k string, v int", ("a", 1), ("a", 2), (None, 3), (None, 4), ("b", None))
    assert checks.not_null(rows, "v").count() == 1
    assert [tuple(r) for r in checks.unique(rows, "k").collect()] == [("a", 2)]
    assert checks.unique_combination(rows.select("k"), ("k",)).count() == 2
    assert [tuple(r) for r in checks.accepted_values(rows, "k", ("a",)).collect()] == [("b", 1)]
    parents = frame("id string", ("a",))
    assert [tuple(r) for r in checks.relationships(rows, "k", parents, "id").collect()] == [("b", 1)]
