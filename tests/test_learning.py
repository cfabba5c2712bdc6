import math
from datetime import datetime, timezone

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelwise.operators import aggregates, classification, logistic, quantiles
from parcelwise.operators.split import stratified_split
from parcelwise.plans import late_delivery, marts
from parcelwise.schemas import FEATURES

NAMES = ("a", "b", "c")


@pytest.fixture(scope="module")
def sample(spark):
    rng = np.random.default_rng(7)
    matrix = rng.normal(size=(600, 3)) * [1.0, 20.0, 0.5] + [3.0, -5.0, 0.0]
    late = rng.random(600) < 1 / (1 + np.exp(-(-2.0 + 1.2 * (matrix[:, 0] - 3) - 0.05 * (matrix[:, 1] + 5))))
    rows = [(*map(float, values), bool(flag)) for values, flag in zip(matrix, late)]
    return matrix, late, spark.createDataFrame(rows, "a double, b double, c double, late boolean")


def objective(rows, stats, weights, bias, l2=0.01):
    """Weighted mean log loss plus the penalty, by Spark."""
    p = logistic.LinearModel(stats, tuple(weights), bias).score(rows)
    loss = -F.when(F.col("late"), F.log(p) * stats.late_weight).otherwise(F.log(1 - p) * stats.other_weight)
    return rows.agg(F.avg(loss)).first()[0] + l2 / 2 * sum(w * w for w in weights)


def test_gradient_equals_differences_of_the_objective(sample):
    _, _, rows = sample
    stats = logistic.fit_stats(rows, NAMES, "late")
    weights, bias, h = [0.3, -0.2, 0.1], -0.1, 1e-5
    slope = logistic.gradient(rows, stats, "late", tuple(weights), bias).first()
    for k in range(4):
        up, down = [*weights, bias], [*weights, bias]
        up[k], down[k] = up[k] + h, down[k] - h
        difference = (objective(rows, stats, up[:3], up[3]) - objective(rows, stats, down[:3], down[3])) / (2 * h)
        assert slope[k] == pytest.approx(difference, abs=1e-6)


def test_each_step_of_the_gradient_solver_goes_down_the_slope(sample):
    _, _, rows = sample
    before = logistic.fit_scratch(rows, NAMES, "late", solver="gradient", epochs=3)
    after = logistic.fit_scratch(rows, NAMES, "late", solver="gradient", epochs=4)
    slope = logistic.gradient(rows, before.stats, "late", before.weights, before.bias).first()
    moved = [a - b for a, b in zip((*after.weights, after.bias), (*before.weights, before.bias))]
    assert moved == pytest.approx([-0.5 * s for s in slope])
    assert objective(rows, after.stats, after.weights, after.bias) < objective(rows, before.stats, before.weights, before.bias)


def test_newton_ends_where_the_slope_is_flat(sample):
    _, _, rows = sample
    model = logistic.fit_scratch(rows, NAMES, "late")
    slope = logistic.gradient(rows, model.stats, "late", model.weights, model.bias).first()
    assert max(abs(value) for value in slope) < 1e-9
    least = objective(rows, model.stats, model.weights, model.bias)
    for k in range(3):
        near = list(model.weights)
        near[k] += 0.01
        assert objective(rows, model.stats, near, model.bias) > least


def test_a_fit_that_does_not_converge_fails(sample, monkeypatch):
    monkeypatch.setattr(logistic, "NEWTON_STEPS", 2)
    with pytest.raises(ArithmeticError, match="no convergence in 2 steps"):
        logistic.fit_scratch(sample[2], NAMES, "late")


def test_library_agrees_under_the_same_penalty(sample):
    _, _, rows = sample
    scratch = logistic.fit_scratch(rows, NAMES, "late")
    library = logistic.fit_library(rows, NAMES, "late", l2=0.01)
    assert library.weights == pytest.approx(scratch.weights, abs=1e-4) and library.bias == pytest.approx(scratch.bias, abs=1e-4)
    loose = logistic.fit_library(rows, NAMES, "late")
    assert np.linalg.norm(loose.weights) > np.linalg.norm(library.weights)


def test_unknown_solver(sample):
    with pytest.raises(ValueError, match="unknown solver"):
        logistic.fit_scratch(sample[2], NAMES, "late", solver="magic")


def test_constant_feature_and_single_class(frame):
    rows = frame("a double, late boolean", (1.0, False), (1.0, False), (1.0, False))
    stats = logistic.fit_stats(rows, ("a",), "late")
    assert (stats.spreads, stats.late_rows, stats.late_weight, stats.other_weight) == ((1.0,), 0, 1.5, 0.5)
    model = logistic.fit_scratch(rows, ("a",), "late")
    assert all(map(math.isfinite, (*model.weights, model.bias)))
    assert rows.filter(model.score(rows) >= 0.5).count() == 0


@pytest.mark.parametrize("fraction", [0.2, 0.33])
def test_split_is_exact_and_repeatable(spark, fraction):
    rows = spark.range(5000).select(
        F.col("id").cast("string").alias("k"), F.when(F.col("id") % 13 == 0, "late").otherwise("on_time").alias("label")
    )
    labelled = stratified_split(rows, "label", "k", fraction)
    counts = {(row.label, row.split): row["count"] for row in labelled.groupBy("label", "split").count().collect()}
    assert sum(counts.values()) == 5000
    test_rows = counts["late", "test"] + counts["on_time", "test"]
    assert test_rows == math.ceil(5000 * fraction)
    late = counts["late", "test"] + counts["late", "train"]
    assert counts["late", "test"] in (math.floor(late * test_rows / 5000), math.ceil(late * test_rows / 5000))
    again = stratified_split(rows.repartition(7), "label", "k", fraction)
    assert labelled.exceptAll(again).count() == 0
    other = stratified_split(rows, "label", "k", fraction, seed=1)
    assert labelled.exceptAll(other).count() > 0


def test_split_matches_ranking_whole_classes(spark, monkeypatch):
    from parcelwise.operators import split

    monkeypatch.setattr(split, "_PREFIX_DIGITS", 1)  # few buckets, so the cut falls inside a full one
    rows = spark.range(997).select(F.col("id").cast("string").alias("k"), F.lit("x").alias("label"))
    found = {row.k for row in stratified_split(rows, "label", "k").filter("split = 'test'").collect()}
    ordered = [row.k for row in rows.orderBy(split.split_order("k", 42)).collect()]
    assert found == set(ordered[: math.ceil(997 * 0.2)])


@pytest.mark.parametrize("limit", [100_000, 10])
@pytest.mark.parametrize("fraction", [0.0, 0.25, 0.5, 0.92, 1.0])
def test_quantile_equals_interpolation(spark, monkeypatch, limit, fraction):
    monkeypatch.setattr(quantiles, "SORTABLE_ROWS", limit)
    rng = np.random.default_rng(3)
    # a third of the rows share one value, and one far outlier spoils equal-width buckets
    values = np.concatenate([rng.exponential(5, 2000), np.full(1000, 2.5), [1e12]])
    rows = spark.createDataFrame([(float(v),) for v in values], "v double")
    assert quantiles.exact_quantile(rows, "v", fraction) == pytest.approx(float(np.quantile(values, fraction)), rel=1e-12)


@pytest.mark.parametrize("limit", [100_000, 10])
def test_quantiles_with_infinite_and_extreme_values(frame, monkeypatch, limit):
    monkeypatch.setattr(quantiles, "SORTABLE_ROWS", limit)
    inner = [-1.7e308, 1.7e308, 5e-324, 0.0, *map(float, range(60))]
    rows = frame("v double", *[(v,) for v in [*inner, math.inf, math.inf, -math.inf, math.nan, None]])
    ordered = sorted([*inner, math.inf, math.inf, -math.inf])
    ranks = [0, 1, 2, 30, len(ordered) - 3, len(ordered) - 2, len(ordered) - 1]
    fractions = [rank / (len(ordered) - 1) for rank in ranks]
    assert quantiles.exact_quantiles(rows, "v", fractions) == [pytest.approx(ordered[rank]) for rank in ranks]
    half = [(rank + 0.5) / (len(ordered) - 1) for rank in (0, len(ordered) - 3)]
    assert quantiles.exact_quantiles(rows, "v", half) == [-math.inf, math.inf]
    assert quantiles.exact_quantiles(frame("v double", (math.inf,)), "v", [0.5]) == [math.inf]


def test_an_item_without_a_number_is_not_the_first(frame):
    rows = frame("o string, n long, v string", ("a", None, "none"), ("a", 2, "two"), ("a", 1, "one"), ("b", None, "only"))
    found = aggregates.first_in_group(rows, "o", "n", "v").orderBy("o").collect()
    assert [tuple(r) for r in found] == [("a", "one"), ("b", "only")]
    items = frame("order_id string, order_item_id long, p string, s string, preco double, frete double", ("a", None, "p", "x", 1.0, 1.0), ("a", 1, "p", "y", 1.0, 1.0))
    measures = frame("p string, product_weight_g double, product_volume_cm3 double", ("p", 1.0, 2.0))
    assert marts.items_per_order(items, measures, "p", "s").first().s == "y"


def test_quantile_of_nothing(frame):
    assert quantiles.exact_quantile(frame("v double", (None,)), "v", 0.5) is None


def test_confusion_lists_every_label(frame):
    rows = frame("t string, p string", ("on_time", "on_time"), ("on_time", "on_time"))
    found = {row.true_label: (row.on_time, row.late) for row in classification.confusion_matrix(rows, "t", "p").collect()}
    assert found == {"on_time": (2, 0), "late": (0, 0)}


def test_macro_metrics_of_a_silent_class(frame):
    rows = frame("true_label string, predicted_label string, model string", *[("on_time", "on_time", "m")] * 3, ("late", "on_time", "m"))
    row = classification.macro_metrics(rows).first()
    assert (row.accuracy, row.precision_macro, row.recall_macro) == (0.75, 0.375, 0.5)
    assert row.f1_macro == pytest.approx((2 * 0.75 / 1.75) / 2)


def test_job_beats_the_baseline_and_finds_the_signal(spark):
    from conftest import TESTDATA
    from workload.registry import models_over, split_rows

    rows = split_rows(models_over(spark, TESTDATA))
    outcome = late_delivery.train_and_compare(rows, datetime(2026, 1, 1, tzinfo=timezone.utc))
    metrics = {row.model: row for row in outcome.metrics.collect()}
    assert outcome.baseline == "on_time"
    assert metrics["baseline_majority"].recall_macro == 0.5
    assert metrics["logreg_hardcode"].recall_macro > 0.6 and metrics["logreg_sklearn"].recall_macro > 0.6
    weights = dict(zip(FEATURES, outcome.scratch.weights))
    assert min(weights, key=weights.get) == "estimated_delivery_days"
    assert outcome.predictions.count() == rows.filter("split = 'test'").count()
    assert outcome.predictions.columns[-1] == "predicted_at"


def test_quantiles_take_two_passes(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    n = 200_000
    rows = spark.range(0, n, 1, 8).selectExpr("cast(pmod(xxhash64(id), 1000003) as double) v").mapInArrow(counted, "v double")
    found = quantiles.exact_quantiles(rows, "v", [0.92, 0.5, 0.501])
    assert seen.value == 2 * n
    values = [r.v for r in spark.range(n).selectExpr("cast(pmod(xxhash64(id), 1000003) as double) v").collect()]
    assert found == pytest.approx([float(np.quantile(values, f)) for f in (0.92, 0.5, 0.501)], rel=1e-12)


@pytest.mark.parametrize("wrong", [[(0.0, 1.0)], [(900.0, 950.0)], [(10.0, 20.0), (700.0, 701.0)]])
def test_a_sketch_that_is_off_does_no_harm(spark, monkeypatch, wrong):
    monkeypatch.setattr(quantiles, "_bounds", lambda *_: wrong)
    rows = spark.range(1000).selectExpr("cast(id as double) v")
    assert quantiles.exact_quantiles(rows, "v", [0.25, 0.5]) == [249.75, 499.5]
