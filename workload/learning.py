"""The late-delivery model (inventory 2.12)."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from parcelwise.functions import scoring
from parcelwise.operators import classification, logistic
from parcelwise.plans import late_delivery
from parcelwise.schemas import FEATURES, MODEL_VERSION
from parcelwise.session import scratch_dir
from parcelwise.sources.benchmark_tables import draw as hash_draw
from parcelwise.sources.layers import store_models
from workload.loads import ROUNDED_METRICS_SQL, metrics_of
from workload.oracle_models import FEATURES as FEATURE_NAMES
from workload.oracle_tables import draw
from workload.registry import query, rounded, split_rows, stored_features
from workload.relational import _MEANS, WEIGHTS_SQL

# weights to score with where the other engine must reproduce the result
WEIGHTS = tuple(round(0.05 * (i + 1) * (-1) ** i, 2) for i in range(len(FEATURES)))
BIAS = -0.25
NAMES = tuple(FEATURES)


def stored_split(m):
    """The split rows as a table: the fits below pass over them many times."""
    return store_models(m.spark, {"labelled": split_rows(m)}, ["labelled"], scratch_dir(m.spark, "labelled"))["labelled"]


def train_of(rows):
    return rows.filter("split = 'train'")


def test_of(rows):
    return rows.filter("split = 'test'")


_STATS = ", ".join(f"avg({n}) m_{n}, if(stddev_pop({n}) = 0, 1.0, stddev_pop({n})) s_{n}" for n in FEATURE_NAMES)
_CLASS = """count(*) nn, count(*) / (2.0::double * greatest(count(*) filter (where is_late), 1)) w_late,
 count(*) / (2.0::double * greatest(count(*) filter (where not is_late), 1)) w_other"""
STATS_SQL = f"(select {_STATS}, {_CLASS} from train_rows)"
Z_SQL = " + ".join([f"({BIAS}::double)"] + [f"({w}::double) * (({n} - m_{n}) / s_{n})" for n, w in zip(FEATURE_NAMES, WEIGHTS)])
P_SQL = f"(1 / (1 + exp(-greatest(-30.0, least(30.0, {Z_SQL})))))"


@query("l1_stratified_split", "select order_id, label, split from labelled")
def l1(m):
    return split_rows(m).select("order_id", "label", "split")


@query("l2_fit_stats", f"select {_MEANS}, {WEIGHTS_SQL} from train_rows")
def l2(m):
    return rounded(logistic.stats_row(train_of(split_rows(m)), NAMES, "is_late"), 4)


@query(
    "l3_logreg_gradient_step",
    "select "
    + ", ".join(
        f"round(sum(e * (({n} - m_{n}) / s_{n})) / any_value(nn) + {0.01 * w}::double, 6) grad_{n}" for n, w in zip(FEATURE_NAMES, WEIGHTS)
    )
    + f", round(sum(e) / any_value(nn), 6) grad_bias from (select *, if(is_late, w_late, w_other) * ({P_SQL} - if(is_late, 1, 0)) e from train_rows, {STATS_SQL})",
)
def l3(m):
    train = train_of(split_rows(m))
    stats = logistic.fit_stats(train, NAMES, "is_late")
    return rounded(logistic.gradient(train, stats, "is_late", WEIGHTS, BIAS))


def coefficients(m, model: logistic.LinearModel):
    pairs = list(zip((*NAMES, "bias"), (*model.weights, model.bias)))
    rows = m.spark.createDataFrame(pairs, "feature string, weight double")
    return rounded(rows, 5)


@query("l4_logreg_fit_scratch")
def l4(m):
    return coefficients(m, logistic.fit_scratch(train_of(stored_split(m)), NAMES, "is_late"))


EPOCHS = 5


def _descent_sql() -> str:
    """The first epochs of gradient descent from zero, one common table expression per epoch."""
    names = [*FEATURE_NAMES, "bias"]
    scaled = ", ".join(f"({n} - m_{n}) / s_{n} {n}" for n in FEATURE_NAMES)
    steps = [
        f"scaled as (select {scaled}, 1.0::double bias, if(is_late, 1, 0) y, if(is_late, w_late, w_other) cw from train_rows, {STATS_SQL})",
        "w0 as (select " + ", ".join(f"0.0::double w_{n}" for n in names) + ")",
    ]
    z = " + ".join(f"w_{n} * {n}" for n in names)
    for k in range(EPOCHS):
        moves = [f"any_value(w_{n}) - 0.5 * (avg(e * {n}) + {0.0 if n == 'bias' else 0.01} * any_value(w_{n})) w_{n}" for n in names]
        steps.append(
            f"w{k + 1} as (select {', '.join(moves)} from (select *, cw * (1 / (1 + exp(-greatest(-30.0, least(30.0, {z})))) - y) e from scaled, w{k}))"
        )
    rows = " union all ".join(f"select '{n}' feature, round(w_{n}, 5) weight from w{EPOCHS}" for n in names)
    return f"select * from (with {', '.join(steps)} {rows})"


@query("l4_logreg_fit_scratch_epochs", _descent_sql())
def l4_epochs(m):
    model = logistic.fit_scratch(train_of(stored_split(m)), NAMES, "is_late", solver="gradient", epochs=EPOCHS)
    return coefficients(m, model)


@query("l5_logreg_fit_library")
def l5(m):
    return coefficients(m, logistic.fit_library(train_of(stored_split(m)), NAMES, "is_late"))


def scored(m):
    rows = split_rows(m)
    stats = logistic.fit_stats(train_of(rows), NAMES, "is_late")
    return test_of(rows).select("order_id", logistic.score(rows, stats, WEIGHTS, BIAS).alias("probability"))


@query("l6_score_linear", f"select order_id, round({P_SQL}, 6) probability from test_rows, {STATS_SQL}")
def l6(m):
    return rounded(scored(m))


@query("l7_threshold_label", f"select order_id, if({P_SQL} >= 0.5, 'late', 'on_time') predicted from test_rows, {STATS_SQL}")
def l7(m):
    return scored(m).select("order_id", scoring.threshold_label(F.col("probability")).alias("predicted"))


@query(
    "l8_majority_baseline",
    "select order_id, label, (select label from train_rows group by label order by count(*) desc, label limit 1) predicted from test_rows",
)
def l8(m):
    rows = split_rows(m)
    majority = classification.majority_label(train_of(rows), "label")
    return test_of(rows).select("order_id", "label", F.lit(majority).alias("predicted"))


@query("l9_macro_metrics", ROUNDED_METRICS_SQL + " where model = 'logreg_sklearn'")
def l9(m):
    stacked = classification.stack_predictions(
        m.stg_ml_predictions, "true_label", {"logreg_sklearn": F.col("predicted_label_sklearn")}
    )
    return rounded(classification.macro_metrics(stacked))


@query("l10_compare_models", ROUNDED_METRICS_SQL)
def l10(m):
    return rounded(metrics_of(m))


@query("l10_compare_models_fitted")
def l10_fitted(m):
    return rounded(late_delivery.train_and_compare(stored_split(m), datetime(2026, 1, 1, tzinfo=timezone.utc)).metrics, 4)


@query(
    "l11_predictions_table",
    f"""select order_id, label true_label, if({P_SQL} >= 0.5, 'late', 'on_time') predicted_label_hardcode, if({P_SQL} * 0.9 >= 0.5, 'late', 'on_time') predicted_label_sklearn,
    '{MODEL_VERSION}' model_version from test_rows, {STATS_SQL}""",
)
def l11(m):
    rows = split_rows(m)
    stats = logistic.fit_stats(train_of(rows), NAMES, "is_late")
    probability = logistic.score(rows, stats, WEIGHTS, BIAS)
    table = late_delivery.predictions_table(
        test_of(rows), probability, probability * 0.9, MODEL_VERSION, datetime(2026, 1, 1, tzinfo=timezone.utc)
    )
    return table.drop("predicted_at")


RISK_SQL = f"""
select order_id, 0.0025 * distance_km + 0.03 * total_freight - 0.08 * estimated_delivery_days - 1.2 * same_state_flag + {draw('noise', 'order_id', 1000)} / 250.0 risk from prepared"""


@query(
    "l12_quantile_label",
    f"select order_id, round(risk, 6) risk, risk > (select quantile_cont(risk, 0.92) from ({RISK_SQL})) is_late from ({RISK_SQL})",
)
def l12(m):
    prepared = late_delivery.prepare(stored_features(m))
    noise = F.expr(hash_draw("noise", "order_id", 1000)) / 250.0
    return rounded(late_delivery.risk_labels(prepared, noise).select("order_id", "risk", "is_late"))
