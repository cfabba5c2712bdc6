"""Confusion counts and macro metrics from label columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwise.functions.cleaning import guarded_ratio
from parcelwise.operators.aggregates import count_where
from parcelwise.schemas import LABELS


def confusion_matrix(rows: DataFrame, true: str, predicted: str, labels: Sequence[str] = LABELS) -> DataFrame:
    """One row per true label, one column per predicted label, absent pairs as 0."""
    counted = rows.groupBy(F.col(true).alias("true_label")).pivot(predicted, list(labels)).count()
    every = rows.sparkSession.createDataFrame([(label,) for label in labels], "true_label string")
    # every label is listed even when no row carries it
    return every.join(counted, "true_label", "left").fillna(0, subset=list(labels))


def majority_label(rows: DataFrame, label: str) -> str:
    """Most frequent label, ties to the smaller name."""
    counts = rows.groupBy(label).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), label).first()[label]


def stack_predictions(rows: DataFrame, true: str, models: Mapping[str, Column]) -> DataFrame:
    """One row per (input row, model): model, true_label, predicted_label. Reads the input once."""
    pairs = [F.struct(F.lit(name).alias("model"), value.alias("predicted_label")) for name, value in models.items()]
    return rows.select(F.col(true).alias("true_label"), F.explode(F.array(*pairs)).alias("pair")).select(
        "true_label", "pair.model", "pair.predicted_label"
    )


def macro_metrics(stacked: DataFrame, labels: Sequence[str] = LABELS) -> DataFrame:
    """Accuracy and macro-averaged precision, recall and F1 per model; a zero denominator gives 0."""
    true, predicted = F.col("true_label"), F.col("predicted_label")
    counts = [F.count("*").alias("n"), count_where(true == predicted).alias("right")]
    for i, label in enumerate(labels):
        counts.append(count_where((true == label) & (predicted == label)).alias(f"hit_{i}"))
        counts.append(count_where(predicted == label).alias(f"said_{i}"))
        counts.append(count_where(true == label).alias(f"was_{i}"))

    def ratio(part: str, whole: Column) -> Column:
        return F.coalesce(guarded_ratio(F.col(part), whole), F.lit(0.0))

    def mean(columns: list[Column]) -> Column:
        return reduce(add, columns) / len(columns)

    indices = range(len(labels))
    f1 = [
        F.coalesce(guarded_ratio(2 * F.col(f"hit_{i}"), F.col(f"said_{i}") + F.col(f"was_{i}")), F.lit(0.0)) for i in indices
    ]
    return stacked.groupBy("model").agg(*counts).select(
        "model",
        guarded_ratio(F.col("right"), F.col("n")).alias("accuracy"),
        mean([ratio(f"hit_{i}", F.col(f"said_{i}")) for i in indices]).alias("precision_macro"),
        mean([ratio(f"hit_{i}", F.col(f"was_{i}")) for i in indices]).alias("recall_macro"),
        mean(f1).alias("f1_macro"),
    )
