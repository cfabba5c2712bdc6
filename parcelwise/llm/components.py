"""Connected components of a graph that is too large for one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelwise.session import scratch_dir


def stored(rows: DataFrame, label: str) -> DataFrame:
    """A table in the cluster's shared folder, which cuts the lineage and survives lost executors."""
    path = scratch_dir(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the edges (u, v); the root is the least node of the component.

    Stars are hung over to ever smaller centres, first by the larger and then by the smaller neighbours of each node,
    until only stars are left. Loops are ignored, repeated edges count once, no edge gives no row.
    """
    now = stored(_directed(edges).distinct(), "edges")
    while not _all_stars(now):
        # larger neighbours go to the least neighbour
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        hung = _directed(now.join(least, "u").select("v", F.col("m").alias("u")))  # in `now` every v is the larger node
        # smaller neighbours go to the least of them
        least = hung.groupBy("v").agg(F.min("u").alias("m"))
        small = hung.join(least, "v").select(F.col("u").alias("v"), F.col("m").alias("u"))
        now = stored(_directed(small.union(least.select("v", F.col("m").alias("u")))).distinct(), "edges")
    return now.select(F.col("v").alias("node"), F.col("u").alias("root")).union(now.select("u", "u").distinct())


def _directed(edges: DataFrame) -> DataFrame:
    """Edges from the smaller to the larger node."""
    return edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).where("u <> v")


def _all_stars(edges: DataFrame) -> bool:
    """Whether every larger node has one edge and is no smaller node."""
    ends = edges.select(F.col("v").alias("node"), F.lit(1).alias("larger"), F.lit(0).alias("smaller")).union(
        edges.select("u", F.lit(0), F.lit(1))
    )
    counts = ends.groupBy("node").agg(F.sum("larger").alias("larger"), F.max("smaller").alias("smaller"))
    return counts.where("larger > 1 or larger + smaller > 1").isEmpty()
