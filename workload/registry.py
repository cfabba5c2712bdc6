"""Decorator that collects queries and their comparison SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelwise.plans import late_delivery
from parcelwise.plans.build import StoredModels
from parcelwise.session import scratch_dir
from parcelwise.sources.benchmark_tables import BenchmarkTables
from workload import oracle_models  # noqa: F401  (adds the model definitions)
from workload.oracle_tables import with_tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def models_over(spark: SparkSession, folder: str) -> StoredModels:
    return StoredModels(spark, BenchmarkTables(spark, folder))


def stored_features(m: StoredModels) -> DataFrame:
    """The feature mart as a table, for jobs that pass over it more than once."""
    return m.store(scratch_dir(m.spark, "features"), ("mart_late_delivery_features",)).mart_late_delivery_features


def split_rows(m: StoredModels) -> DataFrame:
    return late_delivery.split(late_delivery.prepare(stored_features(m)))


def comparable(rows: DataFrame) -> DataFrame:
    """Decimals as double and integers as bigint, so both engines print the same values."""
    columns = []
    for field in rows.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            column = column.cast("bigint")
        columns.append(column.alias(field.name))
    return rows.select(*columns)


def rounded(rows: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, for sums whose order of addition differs between engines."""
    return rows.select(
        *[
            (F.round(f"`{f.name}`", digits) if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`")).alias(f.name)
            for f in rows.schema
        ]
    )


def query(name: str, oracle: str | None = None):
    """Register ``function(models)`` under ``name``; ``oracle`` may use every table and model name."""

    def register(function: Callable[[StoredModels], DataFrame]):
        QUERIES[name] = lambda spark, folder: comparable(function(models_over(spark, folder)))
        if oracle:
            ORACLES[name] = with_tables(oracle)
        return function

    return register
