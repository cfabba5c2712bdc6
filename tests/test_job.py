from datetime import datetime, timezone

import pytest
from conftest import TESTDATA

from parcelwise import job
from parcelwise.schemas import RAW_TABLES
from parcelwise.sources import files, layers
from workload.registry import models_over

NOW = datetime(2026, 1, 1, tzinfo=timezone.utc)


@pytest.fixture(scope="module")
def raw_dir(spark, tmp_path_factory):
    """The source tables as flat CSV files under their usual names."""
    folder = tmp_path_factory.mktemp("raw")
    raw = models_over(spark, TESTDATA).raw
    for name, spec in RAW_TABLES.items():
        raw[name].toPandas().to_csv(folder / spec.file_glob.replace("*", "shop_").replace("__", "_"), index=False)
    return folder


def test_from_raw_files_to_refreshed_predictions(spark, raw_dir, tmp_path):
    folder = str(tmp_path)
    first = job.run(spark, str(raw_dir), folder, "2026-01-01", NOW)
    report = layers.read_snapshot(spark, f"{folder}/models", "check_report")
    # the fixed calendar does not depend on the data, so every check of the 54 passes
    assert report.count() == 54 and report.filter("status <> 'pass'").count() == 0
    predictions = layers.read_snapshot(spark, f"{folder}/silver", "ml_predictions")
    labelled = layers.read_snapshot(spark, f"{folder}/models", "labelled_features")
    assert predictions.count() == labelled.filter("split = 'test'").count() > 0
    assert spark.read.json(f"{folder}/metrics_comparison").count() == 3
    scored = predictions.count()
    assert first.mart_ml_results.count() == first.stg_ml_predictions.count() == scored

    again = job.run(spark, str(raw_dir), folder, "2026-01-02", NOW)
    for name in RAW_TABLES:
        assert layers.read_snapshot(spark, f"{folder}/silver", name).count() == models_over(spark, TESTDATA).raw[name].distinct().count()
        assert {str(row.dt) for row in spark.read.parquet(f"{folder}/bronze/{name}").select("dt").distinct().collect()} == {
            "2026-01-01",
            "2026-01-02",
        }
    assert again.mart_ml_results.count() == again.stg_ml_predictions.count() == scored
    assert again.fact_orders.count() == layers.read_snapshot(spark, f"{folder}/silver", "orders").count()


def test_a_failed_check_stops_the_job(spark, raw_dir, tmp_path, monkeypatch):
    real = files.typed

    def spoilt(rows, spec):
        found = real(rows, spec)
        return found.unionAll(found.limit(1)) if spec.name == "orders" else found

    monkeypatch.setattr(files, "typed", spoilt)
    with pytest.raises(job.ChecksFailed, match="stg_orders.unique_order_id: 1"):
        job.run(spark, str(raw_dir), str(tmp_path), "2026-01-01", NOW)


def test_missing_file_stops_the_load(spark, raw_dir, tmp_path):
    lonely = tmp_path / "raw"
    lonely.mkdir()
    (lonely / "shop_orders_dataset.csv").write_bytes((raw_dir / "shop_orders_dataset.csv").read_bytes())
    assert files.require_tables(spark, str(lonely), "skip") == ["orders"]
    with pytest.raises(FileNotFoundError, match="customers"):
        job.load(spark, str(lonely), str(tmp_path / "out"), "2026-01-01")


def test_nested_rows_are_loaded_and_empty_files_are_an_error(spark, raw_dir, tmp_path):
    nested = tmp_path / "raw"
    for name, spec in RAW_TABLES.items():
        (nested / name).mkdir(parents=True)
        source = raw_dir / spec.file_glob.replace("*", "shop_").replace("__", "_")
        (nested / name / "part-0.csv").write_bytes(source.read_bytes())
    tables = job.load(spark, str(nested), str(tmp_path / "out"), "2026-01-01")
    assert {name: rows.count() for name, rows in tables.items()} == {
        name: models_over(spark, TESTDATA).raw[name].distinct().count() for name in RAW_TABLES
    }
    header = (nested / "orders" / "part-0.csv").read_text().splitlines()[0]
    (nested / "orders" / "part-0.csv").write_text(header + "\n")
    with pytest.raises(job.EmptyTable, match="orders"):
        job.load(spark, str(nested), str(tmp_path / "out"), "2026-01-02")


def test_skipped_tables_are_empty(spark, raw_dir, tmp_path):
    lonely = tmp_path / "raw"
    lonely.mkdir()
    (lonely / "orders.csv").write_bytes((raw_dir / "shop_orders_dataset.csv").read_bytes())
    tables = job.load(spark, str(lonely), str(tmp_path / "out"), "2026-01-01", "skip")
    assert set(tables) == set(RAW_TABLES) and tables["orders"].count() > 0 and tables["sellers"].isEmpty()


def test_shuffle_partitions_follow_the_size_of_the_input(spark, raw_dir, monkeypatch):
    setting = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    total = sum(path.stat().st_size for path in raw_dir.iterdir())
    try:
        assert job.size_shuffles(spark, str(raw_dir)) == int(spark.conf.get("spark.sql.shuffle.partitions"))
        monkeypatch.setattr(job, "PARTITION_BYTES", 10_000)
        assert job.size_shuffles(spark, str(raw_dir)) == -(-total // 10_000) == int(spark.conf.get(setting))
    finally:
        spark.conf.unset(setting)
