"""Exact stratified train/test split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

TRAIN, TEST = "train", "test"
_PREFIX_DIGITS = 4  # 16 ** 4 histogram buckets per class


def split_order(key: str, seed: int) -> Column:
    """Pseudo-random text order of the rows, fixed by the seed."""
    return F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")))


def test_sizes(counts: DataFrame, label: str, fraction: float) -> DataFrame:
    """Test rows per class: the rounded-up total shared by largest remainder, ties by class name."""
    everyone = Window.partitionBy()
    total = F.sum("n").over(everyone)
    wanted = F.ceil(total * fraction)
    exact = F.col("n") * wanted / total
    return (
        counts.withColumn("wanted", wanted)
        .withColumn("base", F.floor(exact))
        .withColumn("rest", exact - F.floor(exact))
        .withColumn("missing", F.col("wanted") - F.sum("base").over(everyone))
        .withColumn("place", F.row_number().over(Window.orderBy(F.desc(F.round("rest", 9)), label)))
        .select(label, (F.col("base") + (F.col("place") <= F.col("missing")).cast("int")).alias("take"))
    )


def stratified_split(rows: DataFrame, label: str, key: str, fraction: float = 0.2, seed: int = 42) -> DataFrame:
    """``rows`` plus ``split``, with the same class ratio on both sides.

    Ranking a whole class would need one task per class. Instead a histogram over a hash prefix finds the bucket
    in which the cut falls, and only that bucket (about one row in 65 536 of its class) is ranked. What is looked up
    holds one row per class, however many rows there are; broadcast, it leaves the rows where they lie, while a shuffle
    by class would put all rows of a class into one task.
    """
    order = split_order(key, seed)
    marked = rows.withColumn("_order", order).withColumn("_bucket", F.substring("_order", 1, _PREFIX_DIGITS))
    # both uses below then read one shuffle: the filter is what the join would add to only one of them
    histogram = marked.filter(F.col(label).isNotNull()).groupBy(label, "_bucket").agg(F.count("*").alias("n"))
    sizes = test_sizes(histogram.groupBy(label).agg(F.sum("n").alias("n")), label, fraction)
    upto = F.sum("n").over(Window.partitionBy(label).orderBy("_bucket"))
    cuts = (
        histogram.withColumn("upto", upto)
        .join(sizes, label)
        .filter((F.col("upto") >= F.col("take")) & (F.col("upto") - F.col("n") < F.col("take")))
        .select(label, F.col("_bucket").alias("_cut"), (F.col("take") - F.col("upto") + F.col("n")).alias("_left"))
    )
    # one row per class: the last test row in hash order
    place = F.row_number().over(Window.partitionBy(label).orderBy("_order", key))
    last = (
        marked.join(F.broadcast(cuts), label)
        .filter(F.col("_bucket") == F.col("_cut"))
        .select(label, "_order", key, "_left", place.alias("_place"))
        .filter(F.col("_place") == F.col("_left"))
        .select(label, F.struct("_order", key).alias("_last"))
    )
    in_test = F.coalesce(F.struct("_order", key) <= F.col("_last"), F.lit(False))
    return (
        marked.join(F.broadcast(last), label, "left")
        .withColumn("split", F.when(in_test, TEST).otherwise(TRAIN))
        .select(*rows.columns, "split")
    )
