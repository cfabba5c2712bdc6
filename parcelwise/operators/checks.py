"""Data-quality checks. Each returns the violations; an empty result is a pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelwise.operators.aggregates import repeated_keys


def not_null(rows: DataFrame, column: str) -> DataFrame:
    return rows.filter(F.col(column).isNull())


def unique(rows: DataFrame, column: str) -> DataFrame:
    """Values that repeat, NULL aside."""
    return repeated_keys(rows, column)


def unique_combination(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Tuples that repeat, NULL being a value like any other."""
    return rows.groupBy(*columns).agg(F.count("*").alias("occurrences")).filter("occurrences > 1")


def accepted_values(rows: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Distinct values outside the list, with their number of rows; NULL is accepted."""
    stray = rows.filter(~F.col(column).isin(*values))
    return stray.groupBy(column).agg(F.count("*").alias("occurrences"))


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child keys without a parent, with their number of rows; NULL keys are skipped.

    Child rows are counted per key before the join, so a key that many rows share crosses it once.
    """
    keys = child.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("key")).agg(F.count("*").alias("occurrences"))
    return keys.join(parent.select(F.col(parent_column).alias("key")), "key", "left_anti")


def negative_days(orders: DataFrame) -> DataFrame:
    return orders.filter("delivery_days < 0").select("order_id", "delivery_days")


def late_but_in_time(orders: DataFrame) -> DataFrame:
    columns = ("order_id", "order_delivered_customer_date", "order_estimated_delivery_date", "is_late")
    in_time = F.col("order_delivered_customer_date") <= F.col("order_estimated_delivery_date")
    return orders.filter(F.col("is_late") & in_time).select(*columns)


def shares_off_one(kpis: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    total = F.col("pct_positivo") + F.col("pct_neutro") + F.col("pct_negativo")
    return kpis.withColumn("share_sum", total).filter(F.abs(total - 1) > tolerance)
