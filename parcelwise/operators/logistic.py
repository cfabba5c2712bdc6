"""Class-weighted logistic regression fitted by Spark jobs.

The features stay distributed. Each pass over them returns one small row of sums, so only coefficients
reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwise.functions.scoring import linear, sigmoid, standardise


@dataclass(frozen=True)
class FitStats:
    """Feature means and population deviations, and balanced class weights, of the training rows."""

    features: tuple[str, ...]
    means: tuple[float, ...]
    spreads: tuple[float, ...]
    rows: int
    late_rows: int
    late_weight: float
    other_weight: float


@dataclass(frozen=True)
class LinearModel:
    stats: FitStats
    weights: tuple[float, ...]
    bias: float

    def score(self, rows: DataFrame) -> Column:
        return score(rows, self.stats, self.weights, self.bias)


def spread_or_one(column: Column) -> Column:
    spread = F.stddev_pop(column)
    return F.when(spread == 0, 1.0).otherwise(spread)


def class_weights(late: Column) -> list[Column]:
    """Aggregates ``rows, late_rows, late_weight, other_weight``; an empty class counts as one row."""
    rows, late_rows = F.count("*"), F.count_if(late)
    return [
        rows.alias("rows"),
        late_rows.alias("late_rows"),
        (rows / (2 * F.greatest(late_rows, F.lit(1)))).alias("late_weight"),
        (rows / (2 * F.greatest(rows - late_rows, F.lit(1)))).alias("other_weight"),
    ]


def stats_row(train: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """One row with everything :class:`FitStats` holds, in one pass."""
    values = [F.col(name).cast("double") for name in features]
    return train.agg(
        *[F.avg(value).alias(f"mean_{name}") for name, value in zip(features, values)],
        *[spread_or_one(value).alias(f"spread_{name}") for name, value in zip(features, values)],
        *class_weights(F.col(label)),
    )


def fit_stats(train: DataFrame, features: Sequence[str], label: str) -> FitStats:
    row = stats_row(train, features, label).first()
    return FitStats(
        tuple(features),
        tuple(row[f"mean_{name}"] for name in features),
        tuple(row[f"spread_{name}"] for name in features),
        row.rows,
        row.late_rows,
        row.late_weight,
        row.other_weight,
    )


def standardised(rows: DataFrame, stats: FitStats) -> list[Column]:
    return [
        standardise(F.col(name), mean, spread).alias(name)
        for name, mean, spread in zip(stats.features, stats.means, stats.spreads)
    ]


def score(rows: DataFrame, stats: FitStats, weights: Sequence[float], bias: float) -> Column:
    """Probability of the positive class as one expression over the raw feature columns."""
    total = F.lit(float(bias))
    for name, mean, spread, weight in zip(stats.features, stats.means, stats.spreads, weights):
        total = total + standardise(F.col(name), mean, spread) * F.lit(float(weight))
    return sigmoid(total)


def _training_rows(train: DataFrame, stats: FitStats, label: str) -> DataFrame:
    """Standardised features, ``_target`` and ``_weight``, spread over the cluster and kept for the passes to come."""
    target = F.col(label).cast("int").cast("double")
    weight = F.when(F.col(label), stats.late_weight).otherwise(stats.other_weight)
    rows = train.select(*standardised(train, stats), target.alias("_target"), weight.alias("_weight"))
    return rows.persist(StorageLevel.MEMORY_AND_DISK)


def gradient(train: DataFrame, stats: FitStats, label: str, weights: Sequence[float], bias: float, l2: float = 0.01) -> DataFrame:
    """One row: the full-batch gradient ``grad_<feature>`` and ``grad_bias`` (the bias carries no penalty)."""
    target = F.col(label).cast("int").cast("double")
    weight = F.when(F.col(label), stats.late_weight).otherwise(stats.other_weight)
    rows = train.select(*standardised(train, stats), target.alias("_target"), weight.alias("_weight"))
    probability = sigmoid(linear(dict(zip(stats.features, weights)), bias))
    error = rows.withColumn("_error", F.col("_weight") * (probability - F.col("_target")))
    return error.agg(
        *[
            (F.sum(F.col(name) * F.col("_error")) / stats.rows + F.lit(l2 * float(weight))).alias(f"grad_{name}")
            for name, weight in zip(stats.features, weights)
        ],
        (F.sum("_error") / stats.rows).alias("grad_bias"),
    )


def _pass_sums(rows: DataFrame, features: Sequence[str], beta: np.ndarray, curvature: bool) -> np.ndarray:
    """Sums of gradient terms, and of Hessian terms if asked, over all rows; the bias is the last coordinate.

    Tasks reduce their Arrow batches with numpy to one number per position; Spark adds those up by position.
    """
    names = list(features)
    size = len(names) + 1
    width = size + size * size if curvature else size

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(width)
        for batch in batches:
            matrix = np.column_stack(
                [batch.column(name).to_numpy(zero_copy_only=False) for name in names] + [np.ones(batch.num_rows)]
            )
            target = batch.column("_target").to_numpy(zero_copy_only=False)
            weight = batch.column("_weight").to_numpy(zero_copy_only=False)
            p = 1.0 / (1.0 + np.exp(-np.clip(matrix @ beta, -30, 30)))
            sums[:size] += matrix.T @ (weight * (p - target))
            if curvature:
                sums[size:] += (matrix.T @ (matrix * (weight * p * (1 - p))[:, None])).ravel()
        positions = pa.array(np.arange(width, dtype=np.int32))
        yield pa.RecordBatch.from_arrays([positions, pa.array(sums)], names=["position", "part"])

    parts = rows.mapInArrow(partial, "position int, part double")
    sums = np.zeros(width)
    for row in parts.groupBy("position").agg(F.sum("part").alias("total")).collect():
        sums[row.position] = row.total
    return sums


#: Newton takes about eight; a fit that needs more than this many fails.
NEWTON_STEPS = 50


def fit_scratch(
    train: DataFrame,
    features: Sequence[str],
    label: str,
    l2: float = 0.01,
    solver: str = "newton",
    lr: float = 0.5,
    epochs: int = 2000,
    tolerance: float = 1e-10,
) -> LinearModel:
    """Minimise the weighted mean log loss plus ``l2 / 2 * |w|^2``.

    ``gradient`` takes ``epochs`` plain steps, one pass each. ``newton`` reaches the same minimum of this strictly
    convex objective in about eight passes, and is what to use on large data.
    """
    stats = fit_stats(train, features, label)
    rows = _training_rows(train, stats, label)
    size = len(stats.features)
    penalty = np.append(np.full(size, l2), 0.0)
    beta = np.zeros(size + 1)
    try:
        if solver == "gradient":
            for _ in range(epochs):
                slope = _pass_sums(rows, stats.features, beta, False) / stats.rows + penalty * beta
                beta = beta - lr * slope
        elif solver == "newton":
            for _ in range(NEWTON_STEPS):
                sums = _pass_sums(rows, stats.features, beta, True) / stats.rows
                slope = sums[: size + 1] + penalty * beta
                if np.max(np.abs(slope)) < tolerance:
                    break
                hessian = sums[size + 1 :].reshape(size + 1, size + 1) + np.diag(penalty)
                beta = beta - np.linalg.lstsq(hessian, slope, rcond=None)[0]
            else:
                raise ArithmeticError(f"no convergence in {NEWTON_STEPS} steps, steepest slope {np.max(np.abs(slope)):.3g}")
        else:
            raise ValueError(f"unknown solver: {solver}")
    finally:
        rows.unpersist()
    return LinearModel(stats, tuple(map(float, beta[:-1])), float(beta[-1]))


def fit_library(train: DataFrame, features: Sequence[str], label: str, max_iter: int = 2000, l2: float | None = None) -> LinearModel:
    """Spark ML's logistic regression on the same standardised, class-weighted rows.

    The default penalty, one over the number of rows on the mean loss, is the customary unit penalty on the summed loss.
    """
    stats = fit_stats(train, features, label)
    rows = _training_rows(train, stats, label)
    try:
        assembled = VectorAssembler(inputCols=list(stats.features), outputCol="_features").transform(rows)
        model: LogisticRegressionModel = LogisticRegression(
            featuresCol="_features",
            labelCol="_target",
            weightCol="_weight",
            maxIter=max_iter,
            regParam=1.0 / stats.rows if l2 is None else l2,
            elasticNetParam=0.0,
            standardization=False,
            tol=1e-10,
        ).fit(assembled.select("_features", "_target", "_weight"))
    finally:
        rows.unpersist()
    return LinearModel(stats, tuple(float(w) for w in model.coefficients), float(model.intercept))
