"""Expressions of a linear classifier; scoring needs no Python on the executors."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelwise.schemas import LATE, ON_TIME


def sigmoid(z: Column) -> Column:
    return 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z))))


def standardise(value: Column, mean: float, spread: float) -> Column:
    return (value.cast("double") - F.lit(float(mean))) / F.lit(float(spread) or 1.0)


def linear(weights: Mapping[str, float], bias: float) -> Column:
    """``bias + sum(weight * column)`` over already standardised columns."""
    total = F.lit(float(bias))
    for name, weight in weights.items():
        total = total + F.col(name) * F.lit(float(weight))
    return total


def label_name(is_late: Column) -> Column:
    return F.when(is_late, LATE).when(~is_late, ON_TIME)


def threshold_label(probability: Column, threshold: float = 0.5) -> Column:
    return F.when(probability >= threshold, LATE).otherwise(ON_TIME)
