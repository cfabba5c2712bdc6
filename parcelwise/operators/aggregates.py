"""Grouped summaries built so that no group has to fit in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwise.functions.cleaning import guarded_ratio


def count_where(predicate: Column) -> Column:
    """Rows for which the predicate holds; NULL does not hold."""
    return F.count_if(F.coalesce(predicate, F.lit(False)))


def share_where(predicate: Column, counted: Column) -> Column:
    """:func:`count_where` over the number of non-NULL ``counted`` values, NULL for none."""
    return guarded_ratio(count_where(predicate), F.count(counted))


def repeated_keys(rows: DataFrame, *columns: str) -> DataFrame:
    """Key combinations that occur more than once, with their number; keys holding a NULL are left out."""
    present = rows.select(*columns).dropna()
    return present.groupBy(*columns).agg(F.count("*").alias("occurrences")).filter("occurrences > 1")


def mean_and_mode(rows: DataFrame, key: str, means: Sequence[str], modes: Sequence[str]) -> DataFrame:
    """Per key the mean of some columns and the most frequent value of others, ties going to the smallest value.

    The built-in mode keeps every distinct value of a group in one buffer. Counting per (key, column, value) first
    lets both steps combine on the map side and spill, and one pass serves all columns.
    """
    tagged = F.array(*[F.struct(F.lit(name).alias("name"), F.col(name).alias("value")) for name in modes])
    first = F.col("pick.name") == modes[0]
    sums = [F.sum(F.when(first, F.col(name))).alias(f"{name}_sum") for name in means]
    counts = [F.count(F.when(first, F.col(name))).alias(f"{name}_count") for name in means]
    counted = (
        rows.select(key, *means, F.explode(tagged).alias("pick"))
        .groupBy(key, F.col("pick.name").alias("name"), F.col("pick.value").alias("value"))
        .agg(F.count("*").alias("times"), *sums, *counts)
    )
    rank = F.struct(-F.col("times"), F.col("value"))
    return counted.groupBy(key).agg(
        *[guarded_ratio(F.sum(f"{name}_sum"), F.sum(f"{name}_count")).alias(name) for name in means],
        *[
            F.min(F.when((F.col("name") == name) & F.col("value").isNotNull(), rank)).getField("value").alias(name)
            for name in modes
        ],
    )


def first_in_group(rows: DataFrame, group: str, order: str, *kept: str) -> DataFrame:
    """The ``kept`` columns of each group's first row by ``order``, NULL last.

    An aggregate rather than a window: the map side sends one candidate per group and task, however large the group.
    """
    head = F.min(F.struct(F.col(order).isNull().alias("_unordered"), order, *kept)).alias("head")
    return rows.groupBy(group).agg(head).select(group, *[F.col(f"head.{name}").alias(name) for name in kept])


def settled(groups: DataFrame, key: str) -> DataFrame:
    """Aggregated rows under a re-derived text key, for a lookup by rows that may share keys.

    A join would otherwise read the aggregate in place on its own shuffle. Shuffling the few finished rows once more
    shows AQE their true size, so it can broadcast them, and else lets it split a skewed partition of the other side.
    """
    return groups.withColumn(key, F.concat(F.col(key), F.lit("")))
