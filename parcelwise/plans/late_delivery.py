"""The late-delivery job: features in, predictions and metrics out."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwise.functions.scoring import label_name, threshold_label
from parcelwise.operators.classification import macro_metrics, majority_label, stack_predictions
from parcelwise.operators.logistic import LinearModel, fit_library, fit_scratch
from parcelwise.operators.quantiles import exact_quantile
from parcelwise.operators.split import TEST, TRAIN, stratified_split
from parcelwise.schemas import FEATURE_TABLE, FEATURES, MODEL_VERSION


def feature_scan(mart: DataFrame) -> DataFrame:
    """The required columns in order, whatever the case of their names; a missing one is an error."""
    present = {name.lower(): name for name in mart.columns}
    missing = [name for name in FEATURE_TABLE.columns if name not in present]
    if missing:
        raise ValueError(f"missing feature columns: {missing}")
    return mart.select(*[F.col(present[name]).alias(name) for name in FEATURE_TABLE.columns])


def complete_rows(features: DataFrame) -> DataFrame:
    """Rows without a missing feature or target, plus the text label."""
    kept = features.dropna(subset=["is_late", *FEATURES])
    return kept.withColumn("label", label_name(F.col("is_late")))


def prepare(mart: DataFrame) -> DataFrame:
    return complete_rows(feature_scan(mart))


def split(prepared: DataFrame, fraction: float = 0.2, seed: int = 42) -> DataFrame:
    return stratified_split(prepared, "label", "order_id", fraction, seed)


@dataclass(frozen=True)
class Outcome:
    baseline: str
    scratch: LinearModel
    library: LinearModel
    predictions: DataFrame
    metrics: DataFrame


def predictions_table(test: DataFrame, scratch: Column, library: Column, version: str, predicted_at: datetime) -> DataFrame:
    stamp = F.lit(predicted_at.astimezone(timezone.utc).isoformat()).cast("timestamp")
    return test.select(
        "order_id",
        F.col("label").alias("true_label"),
        threshold_label(scratch).alias("predicted_label_hardcode"),
        threshold_label(library).alias("predicted_label_sklearn"),
        F.lit(version).alias("model_version"),
        stamp.alias("predicted_at"),
    )


def compare(predictions: DataFrame, baseline: str) -> DataFrame:
    """Macro metrics of the majority baseline and both models."""
    models = {
        "baseline_majority": F.lit(baseline),
        "logreg_hardcode": F.col("predicted_label_hardcode"),
        "logreg_sklearn": F.col("predicted_label_sklearn"),
    }
    return macro_metrics(stack_predictions(predictions, "true_label", models))


def train_and_compare(
    labelled: DataFrame, predicted_at: datetime, version: str = MODEL_VERSION, solver: str = "newton"
) -> Outcome:
    """``labelled`` is the output of :func:`split`, ideally read back from a stored table since it is passed over repeatedly."""
    train, test = labelled.filter(F.col("split") == TRAIN), labelled.filter(F.col("split") == TEST)
    baseline = majority_label(train, "label")
    scratch = fit_scratch(train, tuple(FEATURES), "is_late", solver=solver)
    library = fit_library(train, tuple(FEATURES), "is_late")
    predictions = predictions_table(test, scratch.score(test), library.score(test), version, predicted_at)
    return Outcome(baseline, scratch, library, predictions, compare(predictions, baseline))


def risk_labels(features: DataFrame, noise: Column, fraction: float = 0.92) -> DataFrame:
    """Synthetic target: the riskiest rows, by a linear score with noise, are late."""
    # Coefficients of the score.
    risk = (
        0.0025 * F.col("distance_km")
        + 0.03 * F.col("total_freight").cast("double")
        - 0.08 * F.col("estimated_delivery_days")
        - 1.2 * F.col("same_state_flag")
        + noise
    )
    scored = features.withColumn("risk", risk)
    return scored.withColumn("is_late", F.col("risk") > F.lit(exact_quantile(scored, "risk", fraction)))
