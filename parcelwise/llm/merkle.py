"""Merkle manifest of a documents table: nested-interval labels, proofs by interval difference.

Leaves of a source ascend by doc_id (nulls first, ties by digest) and have ranks from 0. A node of level k covers the
ranks [lo, hi) of up to FANOUT**k leaves, so its interval alone says which nodes are its ancestors and which its
siblings. Trees grow upwards, a level at a time and all sources at once: sixteen children meet in one group, whatever the
size of a source. On the way down the nodes of each level are joined with the one ancestor that contains them, by the
bucket lo / FANOUT**k; the parent's interval without the node's own is what its siblings cover. Subroots are the leaves
of one more tree, whose top is the root.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwise.llm.ordering import numbered
from parcelwise.llm.scratch import Scratch

#: Children of a node are 2**SHIFT.
SHIFT = 4
#: Up to so many sources are broadcast; beyond, a shuffle joins them.
BROADCAST_SOURCES = 100_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(fields: list[Column]) -> Column:
    """SHA-256 over `-` for a null, else the value's UTF-8 byte count, a colon and the value."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def leaves(docs: DataFrame, text_now: Column) -> DataFrame:
    """doc_id, source, leaf, and `current`: the leaf if its text were `text_now`. Other columns are ignored."""
    now = [F.col(f) for f in FIELDS[:-1]] + [text_now]
    return docs.select("doc_id", "source", digest([F.col(f) for f in FIELDS]).alias("leaf"), digest(now).alias("current"))


def _over(level: int) -> Column:
    """Whether the node's tree has more than one node at a level."""
    return F.col("n") > (1 << SHIFT * level)


def _grown(nodes: DataFrame, largest: int, scratch: Scratch, label: str) -> list[DataFrame]:
    """Level by level the parents (tree, n, bucket, lo, hi, digest, children) of nodes (tree, n, lo, hi, digest, item).

    A tree of one leaf gets a node of level 1 that is the leaf itself. `largest` is the most leaves of a tree.
    """
    levels = []
    while not levels or largest > 1 << SHIFT * len(levels):
        level = len(levels) + 1
        if levels:
            nodes = levels[-1].where(_over(level - 1)).select("tree", "n", "lo", "hi", "digest")
        children = F.sort_array(F.collect_list(F.struct([c for c in nodes.columns if c not in ("tree", "n")])))
        first, last = F.col("children")[0], F.element_at("children", -1)
        joined = F.sha2(F.array_join(F.col("children.digest"), ""), 256)
        parents = (
            nodes.groupBy("tree", "n", F.shiftright("lo", SHIFT * level).alias("bucket"))
            .agg(children.alias("children"))
            .withColumn("digest", F.when(F.col("n") == 1, first["digest"]).otherwise(joined))
            .withColumns({"lo": first["lo"], "hi": last["hi"]})
        )
        levels.append(scratch.stored(parents, f"{label}-{level}"))
    return levels


def _tops(levels: list[DataFrame]) -> DataFrame:
    """The one node of each tree that covers all its leaves."""
    return reduce(DataFrame.union, [x.where("lo = 0 and hi = n").select("tree", "n", "digest") for x in levels])


def _sides(child: Column) -> Column:
    """Digests on both sides of a child: the parent's interval without the child's own."""

    def text(where) -> Column:
        return F.array_join(F.transform(F.filter("children", where), lambda c: c["digest"]), "")

    before, after = text(lambda c: c["hi"] <= child["lo"]), text(lambda c: c["lo"] >= child["hi"])
    return F.struct(before.alias("before"), after.alias("after"))


def _attached(levels: list[DataFrame], tops: DataFrame, kept: list[str]) -> DataFrame:
    """Every leaf as (tree, child, steps, *kept): steps from the leaf upwards, followed by those of its tree's top.

    tops: tree, n, steps and the columns `kept`, one row a tree.
    """
    above = None
    for level in range(len(levels), 0, -1):
        width = SHIFT * level
        height_fits = _over(level - 1) if level > 1 else F.lit(True)
        entering = tops.where(height_fits & ~_over(level)).select(
            "tree", F.lit(0).cast("long").alias("own_lo"), F.col("n").alias("own_hi"), "steps", *kept
        )
        here = entering if above is None else above.union(entering)
        here = here.withColumn("bucket", F.shiftright("own_lo", width))
        contained = F.col("lo").__le__(F.col("own_lo")) & F.col("own_hi").__le__(F.col("hi"))
        joined = here.join(levels[level - 1].drop("digest"), ["tree", "bucket"]).where(contained)
        child = F.col("child")
        steps = F.when(F.col("n") == 1, F.col("steps")).otherwise(F.concat(F.array(_sides(child)), "steps"))
        joined = joined.withColumn("child", F.explode("children"))
        if level == 1:
            return joined.select("tree", "child", steps.alias("steps"), *kept)
        above = joined.select("tree", child["lo"].alias("own_lo"), child["hi"].alias("own_hi"), steps.alias("steps"), *kept)
    raise AssertionError("unreachable")


def manifest(docs: DataFrame, text_now: Column, scratch: Scratch) -> DataFrame:
    """doc_id, leaf, current, subroot, root and steps (before, after: siblings' digests) of every document.

    A null doc_id comes first, a null source is a source of its own, repeated rows are leaves of their own; an empty
    table gives no row.
    """
    order = [F.col("source"), F.col("doc_id"), F.col("leaf"), F.col("current")]
    ranked = numbered(leaves(docs, text_now), order, scratch, "leaves")
    sources = ranked.groupBy("source").agg(F.min("rank").alias("base"), F.count(F.lit(1)).alias("n"))
    trees = scratch.stored(numbered(sources, [F.col("source")], scratch, "sources").withColumnRenamed("rank", "tree"), "trees")
    size = trees.agg(F.count(F.lit(1)).alias("trees"), F.coalesce(F.max("n"), F.lit(0)).alias("largest")).head()
    small = F.broadcast(trees) if size.trees <= BROADCAST_SOURCES else trees
    named = ranked.join(small.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))

    lo = F.col("rank") - F.col("base")
    item = F.struct("doc_id", "current").alias("item")
    nodes = named.select("tree", "n", lo.alias("lo"), (lo + 1).alias("hi"), F.col("leaf").alias("digest"), item)
    levels = _grown(nodes, size.largest, scratch, "level")

    roots = _tops(levels)
    item = F.struct("tree", "n").alias("item")
    nodes = roots.select(
        F.lit(0).cast("long").alias("tree"),
        F.lit(size.trees).cast("long").alias("n"),
        F.col("tree").alias("lo"),
        (F.col("tree") + 1).alias("hi"),
        "digest",
        item,
    )
    upper = _grown(nodes, size.trees, scratch, "upper")
    no_steps = F.array().cast("array<struct<before:string,after:string>>")
    top = _tops(upper).select("tree", "n", no_steps.alias("steps"), F.col("digest").alias("root"))
    subroots = _attached(upper, top, ["root"]).select(
        "child.item.tree", "child.item.n", "steps", F.col("child.digest").alias("subroot"), "root"
    )
    found = _attached(levels, subroots, ["subroot", "root"])
    return found.select("child.item.doc_id", F.col("child.digest").alias("leaf"), "child.item.current", "subroot", "root", "steps")


def folded(start: Column, steps: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(steps, start, lambda own, s: F.sha2(F.concat(s["before"], own, s["after"]), 256))


def proof_text(steps: Column) -> Column:
    """All siblings' digests, level by level upwards, from left to right."""
    return F.array_join(F.transform(steps, lambda s: F.concat(s["before"], s["after"])), "")
