"""Writing the layers: immutable dated landings, one-snapshot typed tables, models, predictions and metrics."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelwise.schemas import PREDICTIONS
from parcelwise.sources import snapshots
from parcelwise.sources.files import load_nulls


def write_csv(rows: DataFrame, path: str) -> str:
    """CSV that reads back unchanged: quotes doubled, outer white space kept, times with their fractions."""
    stamps = {f.name: F.col(f"`{f.name}`").cast("string") for f in rows.schema if isinstance(f.dataType, T.TimestampNTZType)}
    (
        rows.withColumns(stamps)
        .write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


def write_snapshot(rows: DataFrame, folder: str, table: str) -> str:
    """Replace a table's snapshot; loading twice equals loading once. Readers find the old one until the new one is whole.

    Returns the folder of the new snapshot's files.
    """
    return snapshots.publish(rows, folder, table)


def read_snapshot(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return snapshots.read(spark, folder, table)


def land(rows: DataFrame, folder: str, table: str, run_date: str) -> str:
    """Raw copy under ``<table>/dt=<run_date>``. A re-run replaces its own date and leaves the others alone."""
    path = f"{folder}/{table}"
    dated = rows.withColumn("dt", F.lit(run_date))
    dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dt").parquet(path)
    return path


def store_models(spark: SparkSession, models: Mapping[str, DataFrame], names: Iterable[str], folder: str) -> dict[str, DataFrame]:
    """Write models as tables and hand back frames that read them."""
    return {name: spark.read.parquet(write_snapshot(models[name], folder, name)) for name in names}


def register_views(models: Mapping[str, DataFrame], names: Iterable[str]) -> None:
    for name in names:
        models[name].createOrReplaceTempView(name)


def write_predictions(predictions: DataFrame, folder: str) -> str:
    """Predictions under one stable key, columns in table order."""
    return write_snapshot(predictions.select(*PREDICTIONS.columns), folder, PREDICTIONS.name)


def read_predictions(spark: SparkSession, folder: str) -> DataFrame:
    return load_nulls(read_snapshot(spark, folder, PREDICTIONS.name))


def stored_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """The stored predictions, or an empty table before the first scoring run."""
    try:
        return read_predictions(spark, folder)
    except snapshots.SnapshotMissing:
        return spark.createDataFrame([], PREDICTIONS.schema)


def write_metrics(metrics: DataFrame, path: str) -> str:
    """One JSON object per model with its metrics nested under it."""
    scores = F.struct(*[name for name in metrics.columns if name != "model"]).alias("metrics")
    metrics.select("model", scores).write.mode("overwrite").json(path)
    return path


def long_metrics(metrics: DataFrame) -> DataFrame:
    names = [name for name in metrics.columns if name != "model"]
    return metrics.unpivot("model", names, "metric", "value")
