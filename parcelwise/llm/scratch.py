"""Intermediate tables in the cluster's shared folder, removed when the work that needs them is done."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parcelwise.session import remove_scratch, scratch_dir


class Scratch:
    """``with Scratch(spark) as scratch``: tables of :meth:`stored` go at the end, the one of :meth:`result` stays.

    A stored table cuts the lineage and survives lost executors; Spark's committer writes it once.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths = spark, []

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        for path in self.paths:
            remove_scratch(self.spark, path)
        self.paths = []

    def _written(self, rows: DataFrame, label: str, codec: str) -> str:
        path = scratch_dir(self.spark, label)
        rows.write.option("compression", codec).parquet(path)
        return path

    def stored(self, rows: DataFrame, label: str, codec: str = "zstd") -> DataFrame:
        self.paths.append(self._written(rows, label, codec))
        return self.spark.read.parquet(self.paths[-1])

    def result(self, rows: DataFrame, label: str) -> DataFrame:
        return self.spark.read.parquet(self._written(rows, label, "snappy"))
