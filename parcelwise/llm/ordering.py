"""Ranks over rows sorted by all tasks together: no window without a key, no group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwise.llm.scratch import Scratch


def placed(rows: DataFrame, order: list[Column], scratch: Scratch, label: str) -> DataFrame:
    """The rows stored in ascending order, with their `part` of the order and their place `at`, which ascends too."""
    by_range = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    stored = scratch.stored(by_range.withColumn("at", F.monotonically_increasing_id()), label)
    return stored.withColumn("part", F.shiftright("at", 33))


def numbered(rows: DataFrame, order: list[Column], scratch: Scratch, label: str) -> DataFrame:
    """The rows with their `rank` from 0 in a total order; the driver sees one count for each written task."""
    table = placed(rows, order, scratch, label)
    bases, total = [], 0
    for row in table.groupBy("part").agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect():
        bases.append((row.part, total))
        total += row.n
    base = rows.sparkSession.createDataFrame(bases, "part long, part_base long")
    own = F.col("at") - F.shiftleft("part", 33)
    return table.join(F.broadcast(base), "part").withColumn("rank", F.col("part_base") + own).drop("part", "at", "part_base")
