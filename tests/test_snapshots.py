"""Replacing a table under its readers."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from parcelwise.sources import layers, snapshots


def values(rows):
    return sorted(r[0] for r in rows.collect())


def test_the_last_one_published_is_read(spark, tmp_path):
    folder = str(tmp_path)
    with pytest.raises(snapshots.SnapshotMissing, match="no snapshot of t"):
        snapshots.read(spark, folder, "t")
    for n in (3, 2):
        path = snapshots.publish(spark.range(n), folder, "t")
        assert values(snapshots.read(spark, folder, "t")) == list(range(n))
        assert path == snapshots.current(spark, folder, "t")


def test_a_write_that_fails_half_way_leaves_the_old_snapshot(spark, tmp_path):
    folder = str(tmp_path)
    snapshots.publish(spark.range(5), folder, "t")
    good = F.when(F.col("id") < 900, F.col("id")).otherwise(F.raise_error(F.lit("task failed")).cast("long"))
    with pytest.raises(Exception, match="task failed"):
        snapshots.publish(spark.range(0, 1000, 1, 8).select(good.alias("id")), folder, "t")
    assert values(snapshots.read(spark, folder, "t")) == [0, 1, 2, 3, 4]
    assert len([n for n in os.listdir(tmp_path / "t") if n.startswith("_published")]) == 1
    snapshots.publish(spark.range(2), folder, "t")
    assert values(snapshots.read(spark, folder, "t")) == [0, 1]


def test_readers_see_a_whole_snapshot_at_any_time(spark, tmp_path):
    folder, seen, done = str(tmp_path), [], threading.Event()
    snapshots.publish(spark.range(10), folder, "t")

    def look():
        while not done.is_set():
            seen.append(snapshots.read(spark, folder, "t").count())

    reader = threading.Thread(target=look)
    reader.start()
    for n in (20, 30, 40):
        snapshots.publish(spark.range(n), folder, "t")
    done.set()
    reader.join()
    assert seen and set(seen) <= {10, 20, 30, 40} and seen == sorted(seen)


def test_old_snapshots_go_after_the_grace_number(spark, tmp_path):
    folder = str(tmp_path)
    frames = []
    for n in range(1, 6):
        snapshots.publish(spark.range(n), folder, "t")
        frames.append(snapshots.read(spark, folder, "t"))
    assert [values(f) for f in frames[2:]] == [[0, 1, 2], [0, 1, 2, 3], [0, 1, 2, 3, 4]]
    assert len([n for n in os.listdir(tmp_path / "t") if n.startswith("data-")]) == snapshots.KEPT
    with pytest.raises(Exception, match="does not exist|FILE_NOT_EXIST|PATH_NOT_FOUND"):
        spark.read.parquet(frames[0].inputFiles()[0]).count()


def test_folders_of_failed_writes_go_once_they_are_old(spark, tmp_path, monkeypatch):
    folder = str(tmp_path)
    orphan = tmp_path / "t" / f"data-{'0' * 32}"
    snapshots.publish(spark.range(1), folder, "t")
    orphan.mkdir()
    snapshots.publish(spark.range(1), folder, "t")
    assert orphan.exists()  # it may belong to a running write
    monkeypatch.setattr(snapshots, "ABANDONED_SECONDS", -1)
    snapshots.publish(spark.range(1), folder, "t")
    assert not orphan.exists()
    assert values(snapshots.read(spark, folder, "t")) == [0]


def test_writers_at_the_same_time(spark, tmp_path):
    folder, threads = str(tmp_path), []
    for n in (1, 2, 3, 4):
        threads.append(threading.Thread(target=snapshots.publish, args=(spark.range(n), folder, "t", 10)))
        threads[-1].start()
    for t in threads:
        t.join()
    assert len([n for n in os.listdir(tmp_path / "t") if n.startswith("_published")]) == 4
    assert snapshots.read(spark, folder, "t").count() in (1, 2, 3, 4)


def test_a_table_can_be_made_from_its_own_snapshot(spark, tmp_path):
    folder = str(tmp_path)
    layers.write_snapshot(spark.range(3), folder, "t")
    layers.write_snapshot(layers.read_snapshot(spark, folder, "t").selectExpr("id + 10 as id"), folder, "t")
    assert values(layers.read_snapshot(spark, folder, "t")) == [10, 11, 12]
