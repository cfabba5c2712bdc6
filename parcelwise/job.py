"""The whole batch, from raw CSV files to refreshed prediction mart; run it with ``spark-submit parcelwise/job.py``."""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelwise.plans import late_delivery, suite
from parcelwise.plans.build import StoredModels, build, refresh_predictions
from parcelwise.plans.models import Models
from parcelwise.schemas import RAW_TABLES
from parcelwise.session import build_session
from parcelwise.sources import files, layers


#: Raw bytes that one shuffle partition gets at most, before AQE joins small ones.
PARTITION_BYTES = 128 << 20


def size_shuffles(spark: SparkSession, raw_dir: str) -> int:
    """Sets the initial number of shuffle partitions by the size of the raw files; AQE can join partitions, not cut them."""
    total = files.listed_files(spark, raw_dir).agg(F.sum("length")).first()[0] or 0
    now = int(spark.conf.get("spark.sql.shuffle.partitions"))
    partitions = max(now, -(-total // PARTITION_BYTES))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(partitions))
    return partitions


class EmptyTable(RuntimeError):
    """A table's files have landed without a single row."""


class ChecksFailed(RuntimeError):
    """A quality check found violations, so nothing was trained."""


def load(spark: SparkSession, raw_dir: str, folder: str, run_date: str, policy: str = "fail") -> dict[str, DataFrame]:
    """Land the raw rows under the run's date and replace the typed snapshot of every table.

    The typed rows are made from the landed copy, so each CSV file is parsed once. Files without a single row are an
    error. With the policy ``skip`` a table that has not landed is empty.
    """
    tables = {}
    landed = set(files.require_tables(spark, raw_dir, policy))
    paths = files.table_paths(spark, raw_dir)
    for name, spec in RAW_TABLES.items():
        if name not in landed:
            tables[name] = spark.createDataFrame([], spec.schema)
            continue
        text = files.read_text_csv(spark, paths[name], spec)
        if text.isEmpty():
            raise EmptyTable(f"{name}: no rows in {len(paths[name])} files")
        rows = spark.read.parquet(f"{layers.land(text, f'{folder}/bronze', name, run_date)}/dt={run_date}")
        path = layers.write_snapshot(files.load_nulls(files.typed(rows, spec)), f"{folder}/silver", name)
        tables[name] = spark.read.parquet(path)
    return tables


def check(models: Models, folder: str) -> None:
    """Store the suite's report and stop on any failed check."""
    path = layers.write_snapshot(suite.run_suite(models), folder, "check_report")
    failed = models.spark.read.parquet(path).filter("status = 'fail'").collect()  # at most one row per declared check
    if failed:
        raise ChecksFailed(", ".join(f"{row.model}.{row.check_name}: {row.violations}" for row in failed))


def run(
    spark: SparkSession, raw_dir: str, folder: str, run_date: str, predicted_at: datetime, policy: str = "fail"
) -> StoredModels:
    """Load, count rows, build, check, train, write predictions, refresh what depends on them."""
    size_shuffles(spark, raw_dir)
    tables = load(spark, raw_dir, folder, run_date, policy)
    layers.write_snapshot(files.row_audit(tables), f"{folder}/models", "row_audit")
    # the first run has no predictions yet; later ones start from the stored set
    predictions = layers.stored_predictions(spark, f"{folder}/silver")
    models = build(StoredModels(spark, {**tables, "ml_predictions": predictions}), f"{folder}/models")
    check(models, f"{folder}/models")
    prepared = late_delivery.prepare(models.mart_late_delivery_features)
    path = layers.write_snapshot(late_delivery.split(prepared), f"{folder}/models", "labelled_features")
    outcome = late_delivery.train_and_compare(spark.read.parquet(path), predicted_at)
    layers.write_predictions(outcome.predictions, f"{folder}/silver")
    layers.write_metrics(outcome.metrics, f"{folder}/metrics_comparison")
    scored = {**models.tables(), "mart_ml_results": refresh_predictions(models, f"{folder}/silver", f"{folder}/models")}
    return StoredModels(spark, {**tables, "ml_predictions": layers.read_predictions(spark, f"{folder}/silver")}, scored)


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--raw-dir", required=True)
    parser.add_argument("--folder", required=True, help="shared folder for all layers")
    parser.add_argument("--run-date", required=True, help="YYYY-MM-DD")
    parser.add_argument("--policy", choices=("fail", "skip"), default="fail", help="what to do if a table has not landed")
    options = parser.parse_args()
    run(build_session(), options.raw_dir, options.folder, options.run_date, datetime.now(timezone.utc), options.policy)


if __name__ == "__main__":
    main()
