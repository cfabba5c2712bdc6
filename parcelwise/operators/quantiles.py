"""Exact quantiles without gathering the values.

A first pass counts the values and makes a mergeable sketch (KLL), whose rank error is known; it gives, for each wanted
rank, a narrow range of values that holds it. A second pass counts the values under and between the ranges and, within
them, each different value; the ranks follow exactly. If a range holds too many different values for that, or the sketch
was off, which the exact counts show, histograms narrow the range further.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

BUCKETS = 4096
#: Size of the sketch (some 100 KB) and the ranks on either side that are looked at, as a share of all: several
#: times the sketch's usual error, about 0.0007.
SKETCH_SIZE, SKETCH_MARGIN = 4096, 0.003
#: Ranges are narrowed until so few values are left in them that one task can rank them.
SORTABLE_ROWS = 100_000


class _Range:
    """Values in ``[low, high]``, of which there are ``inside``, with ``below`` values under them."""

    def __init__(self, low: float, high: float, below: int, inside: int) -> None:
        self.low, self.high, self.below, self.inside = low, high, below, inside

    def key(self) -> tuple:
        return self.low, self.high, self.below, self.inside


def _in_ranges(values: DataFrame, ranges: Sequence[_Range]) -> DataFrame:
    """Each finite value once for each range it lies in; the ranges' numbers come from a few quantiles."""
    given = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(r.low).alias("low"), F.lit(r.high).alias("high")) for k, r in enumerate(ranges)])
    return values.select("value", F.explode(given).alias("r")).where("value between r.low and r.high").select("value", "r.*")


def _values_at(values: DataFrame, held: dict[int, _Range]) -> dict[int, float]:
    """Finite values at zero-based ranks, each held by a range. Each round keeps, for every rank, the one equal-width
    bucket that holds it; all ranks share a pass."""
    held = dict(held)
    while wide := {r.key(): r for r in held.values() if r.low < r.high and r.inside > SORTABLE_ROWS}:
        ranges = list(wide.values())
        width = F.col("high") / BUCKETS - F.col("low") / BUCKETS
        # halves, so that a difference of two finite values stays finite
        bucket = F.least(F.floor((F.col("value") / 2 - F.col("low") / 2) / F.nullif(width / 2, F.lit(0.0))), F.lit(BUCKETS - 1))
        histogram = (
            _in_ranges(values, ranges)
            .groupBy("k", F.coalesce(bucket.cast("double"), F.col("value")).alias("bucket"))
            .agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
        )
        # at most BUCKETS rows a range, whatever the data
        running = F.sum("n").over(Window.partitionBy("k").orderBy("bucket")) - F.col("n")
        placed = histogram.withColumn("before", running)
        for k, r in enumerate(ranges):
            own = [rank for rank, x in held.items() if x.key() == r.key()]
            wanted = F.array(*[F.lit(rank - r.below) for rank in own])
            hit = placed.where(F.col("k") == k).where(F.exists(wanted, lambda x: (x >= F.col("before")) & (x < F.col("before") + F.col("n"))))
            for row in hit.collect():  # at most one row a rank
                found = _Range(row.low, row.high, r.below + row.before, row.n)
                if found.key() == r.key():
                    raise ArithmeticError(f"quantile: no progress between {r.low} and {r.high}")
                for rank in own:
                    if found.below <= rank < found.below + found.inside:
                        held[rank] = found
    found = {rank: r.low for rank, r in held.items() if r.low == r.high}
    rest = {rank: r for rank, r in held.items() if r.low < r.high}
    if rest:
        ranges = list({r.key(): r for r in rest.values()}.values())
        place = F.row_number().over(Window.partitionBy("k").orderBy("value")) - 1
        # at most SORTABLE_ROWS rows a range
        ranked = _in_ranges(values, ranges).select("k", "value", place.alias("place"))
        wanted = [(k, rank - r.below) for k, r in enumerate(ranges) for rank, x in rest.items() if x.key() == r.key()]
        picked = ranked.where(F.struct("k", "place").isin([F.struct(F.lit(k), F.lit(n)) for k, n in wanted]))
        at = {(row.k, row.place): row.value for row in picked.collect()}  # one row a rank
        for k, r in enumerate(ranges):
            found |= {rank: at[k, rank - r.below] for rank, x in rest.items() if x.key() == r.key()}
    return found


def _bounds(spark: SparkSession, sketch: bytes, ranks: Sequence[int], whole: _Range) -> list[tuple[float, float]]:
    """Disjoint ranges of values, ascending, that hold the ranks as far as the sketch can tell."""
    shares = [rank / whole.inside + side * SKETCH_MARGIN for rank in ranks for side in (-1, 1)]
    asked = F.array(*[F.lit(min(1.0, max(0.0, share))) for share in shares])
    found = spark.range(1).select(F.kll_sketch_get_quantile_double(F.lit(sketch), asked).alias("q")).first().q
    ends = [whole.low if s <= 0 else whole.high if s >= 1 else q for s, q in zip(shares, found)]
    out: list[tuple[float, float]] = []
    for low, high in sorted(zip(ends[::2], ends[1::2])):
        if out and low <= out[-1][1]:
            low, high = out[-1][0], max(out.pop()[1], high)
        out.append((low, high))
    return out


def _by_sketch(values: DataFrame, ranks: Sequence[int], whole: _Range, sketch: bytes) -> dict[int, float]:
    """Finite values at zero-based ranks, from one pass over ranges of a sketch."""
    ranges = _bounds(values.sparkSession, sketch, ranks, whole)
    few = 2 * SKETCH_MARGIN * len(ranks) * whole.inside <= SORTABLE_ROWS / 2  # half for the sketch's error
    place, inside = F.lit(0), F.lit(False)
    for low, high in ranges:
        place = place + (F.col("value") > high).cast("int")
        inside = inside | F.col("value").between(low, high)
    # the rows outside come down to one count for each gap; those inside are counted for each value if they are few
    value = F.when(inside, F.col("value")) if few else F.lit(None).cast("double")
    counts = values.groupBy(place.alias("place"), inside.alias("inside"), value.alias("value")).agg(F.count("*").alias("n"))
    steps, below = [], 0
    for row in sorted(counts.toArrow().to_pylist(), key=lambda r: (r["place"], r["inside"], r["value"] or 0.0)):
        if row["inside"]:
            low, high = ranges[row["place"]] if row["value"] is None else (row["value"], row["value"])
            steps.append(_Range(low, high, below, row["n"]))
        below += row["n"]
    held = {}
    for rank in ranks:  # a rank in a gap: the sketch was off
        held[rank] = next((r for r in steps if r.below <= rank < r.below + r.inside), whole)
    return _values_at(values, held)


def exact_quantiles(rows: DataFrame, column: str | Column, fractions: Sequence[float]) -> list[float | None]:
    """Quantiles with linear interpolation between neighbours; NULL and NaN are ignored.

    Infinite values take their ranks at either end. Between two different neighbours of which the lower is minus
    infinity the result is minus infinity, else plus infinity if the upper one is. No value at all gives ``None``.
    """
    source = F.col(column) if isinstance(column, str) else column
    values = rows.select(source.cast(T.DoubleType()).alias("value")).filter(F.col("value").isNotNull() & ~F.isnan("value"))
    finite = F.when(F.abs("value") < math.inf, F.col("value"))
    extent = values.agg(
        F.count("*").alias("n"),
        F.count_if(F.col("value") == -math.inf).alias("under"),
        F.count(finite).alias("inside"),
        F.min(finite).alias("low"),
        F.max(finite).alias("high"),
        F.kll_sketch_agg_double(finite, SKETCH_SIZE).alias("sketch"),
    ).first()
    if extent.n == 0:
        return [None] * len(fractions)
    targets = [fraction * (extent.n - 1) for fraction in fractions]
    ranks = {r for t in targets for r in (math.floor(t), math.ceil(t))}
    at = {r: -math.inf if r < extent.under else math.inf for r in ranks}
    inner = sorted(r - extent.under for r in ranks if extent.under <= r < extent.under + extent.inside)
    if inner:
        whole = _Range(extent.low, extent.high, 0, extent.inside)
        found = _by_sketch(values.where(finite.isNotNull()), inner, whole, bytes(extent.sketch))
        at |= {rank + extent.under: value for rank, value in found.items()}
    results = []
    for target in targets:
        lower, upper, part = at[math.floor(target)], at[math.ceil(target)], target - math.floor(target)
        if lower == upper or math.isinf(lower):
            results.append(lower)
        else:
            results.append(lower + (upper - lower) * part)
    return results


def exact_quantile(rows: DataFrame, column: str | Column, fraction: float) -> float | None:
    return exact_quantiles(rows, column, [fraction])[0]
