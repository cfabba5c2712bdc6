"""Dashboard queries. ``estado`` is the one dashboard filter; leaving it out keeps every state."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwise.functions.cleaning import guarded_ratio
from parcelwise.operators.aggregates import count_where, first_in_group
from parcelwise.plans.marts import reviews_per_order, sum_up
from parcelwise.schemas import LATE, ON_TIME, SENTIMENTS


def in_state(rows: DataFrame, estado: str | None) -> DataFrame:
    return rows.filter(F.col("estado") == estado) if estado else rows


def state_contains(rows: DataFrame, fragment: str | None) -> DataFrame:
    """Case-insensitive substring filter."""
    return rows.filter(F.lower("estado").contains(fragment.lower())) if fragment else rows


def percent(part: Column, whole: Column) -> Column:
    return guarded_ratio(part, whole) * 100


def total_delivered(kpis: DataFrame, estado: str | None = None) -> DataFrame:
    return state_contains(kpis, estado).agg(F.sum("order_count").alias("total_pedidos"))


def late_rate(kpis: DataFrame, estado: str | None = None) -> DataFrame:
    return in_state(kpis, estado).agg(
        F.sum("order_count").alias("total_pedidos"),
        F.sum("late_count").alias("total_atrasados"),
        percent(F.sum("late_count"), F.sum("order_count")).alias("pct_atraso"),
    )


def avg_actual_days(kpis: DataFrame, estado: str | None = None) -> DataFrame:
    """Mean of the state means, each state weighing the same."""
    return in_state(kpis, estado).agg(F.avg("avg_delivery_days").alias("prazo_medio_real"))


def avg_estimated_days(kpis: DataFrame, estado: str | None = None) -> DataFrame:
    """Mean of the state means, each state weighing the same."""
    return in_state(kpis, estado).agg(F.avg("avg_estimated_delivery_days").alias("prazo_medio_estimado"))


def late_by_state(kpis: DataFrame, estado: str | None = None) -> DataFrame:
    return (
        in_state(kpis, estado)
        .orderBy(F.desc_nulls_first("pct_late"), "estado")
        .select(
            "estado",
            (F.col("pct_late") * 100).alias("taxa_atraso_percentual"),
            F.col("order_count").alias("volume_pedidos"),
        )
    )


def sentiment_by_category(
    reviews: DataFrame,
    items: DataFrame,
    products: DataFrame,
    orders: DataFrame,
    customers: DataFrame,
    estado: str | None = None,
    limit: int = 15,
    product_key: str = "product_key",
    customer_key: str = "customer_key",
) -> DataFrame:
    """Most reviewed categories with their sentiment shares. The customer joins exist only for the state filter."""
    rows = reviews_per_order(reviews)
    if estado:
        buyers = in_state(customers, estado).select(customer_key)
        rows = rows.join(orders.select("order_id", customer_key).join(buyers, customer_key), "order_id")
    rows = rows.join(first_in_group(items, "order_id", "order_item_id", product_key), "order_id")
    named = products.filter(F.col("category_name_english").isNotNull()).select(product_key, "category_name_english")
    per_category = sum_up(sum_up(rows, product_key).join(named, product_key), "category_name_english")
    return (
        per_category.orderBy(F.desc("review_count"), "category_name_english")
        .limit(limit)
        .select(
            F.col("category_name_english").alias("categoria"),
            F.col("review_count").alias("total_reviews"),
            *[percent(F.col(name), F.col("review_count")).alias(f"pct_{name}") for name in SENTIMENTS],
        )
    )


# Row labels of the comparison chart.
MODEL_TITLES = {
    "predicted_label_hardcode": "Regressao Logistica (Numpy Scratch)",
    "predicted_label_sklearn": "Regressao Logistica (Scikit-Learn)",
}
BASELINE_TITLE = "Baseline (Majority Class)"


def model_comparison(results: DataFrame, estado: str | None = None) -> DataFrame:
    """Scores of the late class per model, from one pass; the baseline answers on time for everything."""
    true = F.col("true_label")
    totals = [F.count("*").alias("n"), count_where(true == LATE).alias("was"), count_where(true == ON_TIME).alias("rest")]
    for column in MODEL_TITLES:
        said = F.col(column)
        totals.append(count_where(true == said).alias(f"{column}_right"))
        totals.append(count_where((true == LATE) & (said == LATE)).alias(f"{column}_hit"))
        totals.append(count_where(said == LATE).alias(f"{column}_said"))
    zero = F.lit(0).cast("bigint")
    lines = [
        (title, F.col(f"{column}_right"), F.col(f"{column}_hit"), F.col(f"{column}_said"), F.col("was"))
        for column, title in MODEL_TITLES.items()
    ]
    # a hit count of zero over one row gives the baseline its zeros
    lines.append((BASELINE_TITLE, F.col("rest"), zero, zero + 1, zero + 1))
    structs = [
        F.struct(F.lit(title).alias("modelo"), right.alias("right"), hit.alias("hit"), said.alias("said"), was.alias("was"))
        for title, right, hit, said, was in lines
    ]
    stacked = in_state(results, estado).agg(*totals).select("n", F.explode(F.array(*structs)).alias("m")).select("n", "m.*")
    precision, recall = F.col("precisao_atraso_pct") / 100, F.col("recall_atraso_pct") / 100
    return stacked.select(
        "modelo",
        percent(F.col("right"), F.col("n")).alias("acuracia_pct"),
        percent(F.col("hit"), F.col("was")).alias("recall_atraso_pct"),
        percent(F.col("hit"), F.col("said")).alias("precisao_atraso_pct"),
    ).withColumn(
        "f1_atraso_pct", F.coalesce(percent(2 * precision * recall, precision + recall), F.lit(0.0))
    )


def error_details(results: DataFrame, estado: str | None = None, limit: int = 20) -> DataFrame:
    """Latest wrong answers of the library model; all share one time stamp per run, so the order id decides."""
    return (
        in_state(results.filter(~F.col("sklearn_correct")), estado)
        .orderBy(F.desc("predicted_at"), "order_id")
        .limit(limit)
        .select(
            F.col("order_id").alias("id_pedido"),
            F.col("estado").alias("estado_cliente"),
            F.col("true_label").alias("status_real"),
            F.col("predicted_label_hardcode").alias("predicao_numpy"),
            F.col("predicted_label_sklearn").alias("predicao_sklearn"),
            F.col("predicted_at").alias("data_previsao"),
        )
    )


def slowest_states(kpis: DataFrame, limit: int = 10) -> DataFrame:
    return (
        kpis.orderBy(F.desc_nulls_last("avg_delivery_days"), "estado")
        .limit(limit)
        .select("estado", "avg_delivery_days", "avg_estimated_delivery_days", "order_count")
    )


def band(value: Column, edges: Sequence[float]) -> Column:
    """Number of edges at or below the value: 0 is under the first one."""
    above = reduce(lambda total, edge: total + F.when(value >= edge, 1).otherwise(0), edges, F.lit(0))
    return F.when(value.isNotNull(), above)


def late_by_distance(features: DataFrame, km: Sequence[float] = (500, 1500, 2500), freight: Sequence[float] = (50, 100, 200)) -> DataFrame:
    """Late share by distance band and freight band."""
    return (
        features.groupBy(
            band(F.col("distance_km"), km).alias("distance_band"), band(F.col("total_freight"), freight).alias("freight_band")
        )
        .agg(
            F.count("*").alias("order_count"),
            count_where(F.col("is_late")).alias("late_count"),
            guarded_ratio(count_where(F.col("is_late")), F.count("*")).alias("pct_late"),
        )
    )


def bad_reviews_and_delay(
    reviews: DataFrame, orders: DataFrame, customers: DataFrame, kpis: DataFrame, key: str = "customer_key"
) -> DataFrame:
    """Share of negative reviews next to the late share, per customer state."""
    per_customer = sum_up(reviews_per_order(reviews).join(orders.select("order_id", key), "order_id", "left"), key)
    per_state = sum_up(per_customer.join(customers.select(key, "estado"), key, "left"), "estado")
    shares = per_state.select(
        F.col("estado").alias("review_state"),
        "review_count",
        guarded_ratio(F.col("negativo"), F.col("review_count")).alias("pct_negativo"),
    )
    # both sides hold one row per state
    return kpis.join(shares, F.col("estado").eqNullSafe(F.col("review_state")), "left").select(
        "estado", "order_count", "pct_late", "review_count", "pct_negativo"
    )
