"""The quality suite: every declared check over the models, reported one row per check."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwise.functions.keys import packed_key
from parcelwise.operators import checks
from parcelwise.operators.aggregates import count_where, repeated_keys
from parcelwise.schemas import LABELS, ORDER_STATUSES, SENTIMENTS

# Which checks are declared on which model.
REQUIRED = {
    "stg_customers": ("customer_id",),
    "stg_orders": ("order_id",),
    "stg_order_reviews": ("review_id", "sentiment_label"),
    "stg_products": ("product_id",),
    "stg_sellers": ("seller_id",),
    "stg_ml_predictions": ("order_id",),
    "dim_customers": ("customer_key", "customer_id"),
    "dim_sellers": ("seller_key", "seller_id"),
    "dim_products": ("product_key", "product_id"),
    "dim_geolocation": ("zip_code_prefix",),
    "dim_date": ("date_day",),
    "fact_orders": ("order_key", "order_id"),
    "fact_order_items": ("order_item_key",),
    "fact_payments": ("payment_key",),
    "fact_reviews": ("review_key",),
    "mart_ml_results": ("order_id",),
    "mart_late_delivery_features": ("order_id", "is_late"),
}
UNIQUE = {
    "stg_customers": ("customer_id",),
    "stg_orders": ("order_id",),
    "stg_products": ("product_id",),
    "stg_sellers": ("seller_id",),
    "dim_customers": ("customer_key", "customer_id"),
    "dim_sellers": ("seller_key", "seller_id"),
    "dim_products": ("product_key", "product_id"),
    "dim_geolocation": ("zip_code_prefix",),
    "dim_date": ("date_day",),
    "fact_orders": ("order_key", "order_id"),
    "fact_order_items": ("order_item_key",),
    "fact_payments": ("payment_key",),
    "fact_reviews": ("review_key",),
    "mart_late_delivery_features": ("order_id",),
}
ACCEPTED = {
    ("stg_orders", "order_status"): ORDER_STATUSES,
    ("stg_order_reviews", "sentiment_label"): SENTIMENTS,
    ("fact_orders", "order_status"): ORDER_STATUSES,
    ("fact_reviews", "sentiment_label"): SENTIMENTS,
    ("mart_ml_results", "true_label"): LABELS,
}
PARENTS = {
    ("fact_orders", "customer_key"): "dim_customers",
    ("fact_order_items", "product_key"): "dim_products",
    ("fact_order_items", "seller_key"): "dim_sellers",
    ("fact_reviews", "order_key"): "fact_orders",
}
TUPLES = {"stg_order_reviews": ("review_id", "order_id")}


def _report(totals: DataFrame) -> DataFrame:
    """A row of counts, named ``<model>.<check>``, as rows ``check_name, model, violations``."""
    quoted = [F.col(f"`{name}`") for name in totals.columns]
    name = F.split("check", r"\.")
    return totals.unpivot([], quoted, "check", "violations").select(
        name[1].alias("check_name"), name[0].alias("model"), "violations"
    )


def _value_checks(models: Mapping[str, DataFrame], model: str) -> DataFrame:
    """All not-null and accepted-values checks of one model, from one scan."""
    counts = [
        count_where(F.col(column).isNull()).alias(f"{model}.not_null_{column}") for column in REQUIRED.get(model, ())
    ]
    for (owner, column), values in ACCEPTED.items():
        if owner == model:
            stray = F.when(~F.col(column).isin(*values), F.col(column))
            counts.append(F.count_distinct(stray).alias(f"{model}.accepted_values_{column}"))
    return _report(models[model].agg(*counts))


def _value(column: str) -> Column:
    """The bytes by which a check groups a column's values; those of hashed keys are half as many as their digits."""
    text = F.col(column).cast("string")
    return packed_key(text) if column.endswith("_key") else text.cast("binary")


def _unique_checks(models: Mapping[str, DataFrame]) -> DataFrame:
    """All unique checks from one grouping of (check number, value); values are counted on the map side first."""
    names, keyed = [], []
    for model, columns in UNIQUE.items():
        pairs = []
        for column in columns:
            pairs.append(F.struct(F.lit(len(names)).alias("check"), _value(column).alias("value")))
            names.append(f"{model}.unique_{column}")
        keyed.append(models[model].select(F.explode(F.array(*pairs)).alias("pair")).select("pair.check", "pair.value"))
    repeated = repeated_keys(reduce(DataFrame.unionAll, keyed), "check", "value")
    return _report(repeated.agg(*[F.count_if(F.col("check") == number).alias(name) for number, name in enumerate(names)]))


def _relationship_checks(models: Mapping[str, DataFrame]) -> DataFrame:
    """All relationship checks from one grouping of (check number, key) over child and parent keys together."""
    names, keyed = [], []
    for (model, column), parent in PARENTS.items():
        for rows, child in ((models[model], True), (models[parent], False)):
            key = rows.filter(F.col(column).isNotNull()).select(packed_key(F.col(column)).alias("key"))
            keyed.append(key.withColumns({"check": F.lit(len(names)), "child": F.lit(child)}))
        names.append(f"{model}.relationships_{column}")
    orphans = (
        reduce(DataFrame.unionAll, keyed)
        .groupBy("check", "key")
        .agg(F.count_if("child").alias("children"), F.count_if(~F.col("child")).alias("parents"))
        .filter("parents = 0")
    )
    totals = [
        F.coalesce(F.sum(F.when(F.col("check") == number, F.col("children"))), F.lit(0)).alias(name)
        for number, name in enumerate(names)
    ]
    return _report(orphans.agg(*totals))


def _counted(name: str, violations: DataFrame) -> DataFrame:
    return _report(violations.agg(F.count("*").alias(name)))


def run_suite(models: Mapping[str, DataFrame]) -> DataFrame:
    """Columns ``check_name, model, violations, status`` for the declared checks and the share-sum check."""
    orders = models["fact_orders"]
    parts = [
        _unique_checks(models),
        _relationship_checks(models),
        _counted("fact_orders.delivery_days_not_negative", checks.negative_days(orders)),
        _counted("fact_orders.is_late_coherent", checks.late_but_in_time(orders)),
        _counted("mart_sentiment_kpis.shares_sum_to_one", checks.shares_off_one(models["mart_sentiment_kpis"])),
    ]
    for model, columns in TUPLES.items():
        name = f"{model}.unique_{'_'.join(columns)}"
        parts.append(_counted(name, checks.unique_combination(models[model], columns)))
    owners = dict.fromkeys([*REQUIRED, *[model for model, _ in ACCEPTED]])
    parts += [_value_checks(models, model) for model in owners]
    status = F.when(F.col("violations") == 0, "pass").otherwise("fail")
    return reduce(DataFrame.unionByName, parts).select("check_name", "model", "violations", status.alias("status"))
