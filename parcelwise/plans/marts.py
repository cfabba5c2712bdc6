"""Marts for the dashboard and the model.

Every mart takes the name of its join key, so it runs on stored facts (hashed keys) as well as straight from the
staging views (natural ids) without re-deriving a fact only to join it away again. Rows are summed up per join key
before each lookup: a key shared by many rows then crosses the join once. Hashed keys are looked up as 16 bytes, not 32
hex digits, which shuffles can hardly compress.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwise.functions import text
from parcelwise.functions.cleaning import equality_flag, guarded_ratio
from parcelwise.functions.dates import weekday
from parcelwise.functions.geo import haversine_km
from parcelwise.functions.keys import packed
from parcelwise.operators.aggregates import count_where, first_in_group, settled
from parcelwise.schemas import FEATURES, SENTIMENTS


def delivered(orders: DataFrame) -> DataFrame:
    return orders.filter(
        (F.col("order_status") == "delivered")
        & F.col("order_delivered_customer_date").isNotNull()
        & F.col("order_estimated_delivery_date").isNotNull()
    )


def mart_delivery_kpis(orders: DataFrame, customers: DataFrame, key: str = "customer_key") -> DataFrame:
    """Delivered orders per customer state; orders without a known customer form the NULL state."""
    orders, customers = packed(orders, key), packed(customers, key)
    per_customer = (
        delivered(orders)
        .groupBy(key)
        .agg(
            F.count("*").alias("order_count"),
            count_where(F.col("is_late")).alias("late_count"),
            F.sum("delivery_days").alias("days"),
            F.count("delivery_days").alias("days_known"),
            F.sum("estimated_delivery_days").alias("promised"),
            F.count("estimated_delivery_days").alias("promised_known"),
        )
    )
    return (
        per_customer.join(customers.select(key, "estado"), key, "left")
        .groupBy("estado")
        .agg(
            F.sum("order_count").alias("order_count"),
            F.sum("late_count").alias("late_count"),
            guarded_ratio(F.sum("late_count"), F.sum("order_count")).alias("pct_late"),
            guarded_ratio(F.sum("days"), F.sum("days_known")).alias("avg_delivery_days"),
            guarded_ratio(F.sum("promised"), F.sum("promised_known")).alias("avg_estimated_delivery_days"),
        )
    )


def sentiment_counts() -> list[Column]:
    label = F.col("sentiment_label")
    return [F.count("*").alias("review_count")] + [count_where(label == name).alias(name) for name in SENTIMENTS]


def reviews_per_order(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("order_id").agg(
        *sentiment_counts(), F.sum("review_score").alias("score_sum"), F.count("review_score").alias("scored")
    )


def sum_up(rows: DataFrame, *keys: str) -> DataFrame:
    """Re-add the counts of :func:`reviews_per_order` at a coarser key."""
    names = ("review_count", *SENTIMENTS, "score_sum", "scored")
    return rows.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in names])


def mart_sentiment_kpis(reviews: DataFrame, items: DataFrame, products: DataFrame, key: str = "product_key") -> DataFrame:
    """Review scores per English category of the order's first item; unknown categories form the NULL row."""
    items, products = packed(items, key), packed(products, key)
    first_item = first_in_group(items, "order_id", "order_item_id", key)
    per_product = sum_up(reviews_per_order(reviews).join(first_item, "order_id", "left"), key)
    per_category = sum_up(
        per_product.join(products.select(key, "category_name_english"), key, "left"), "category_name_english"
    )
    return per_category.select(
        "category_name_english",
        "review_count",
        guarded_ratio(F.col("score_sum"), F.col("scored")).alias("avg_review_score"),
        *[guarded_ratio(F.col(name), F.col("review_count")).alias(f"pct_{name}") for name in SENTIMENTS],
    )


def mart_ml_results(predictions: DataFrame, orders: DataFrame, customers: DataFrame, key: str = "customer_key") -> DataFrame:
    orders, customers = packed(orders, key), packed(customers, key)
    true = F.col("true_label")
    located = predictions.join(orders.select("order_id", key), "order_id", "left")
    return located.join(customers.select(key, "estado"), key, "left").select(
        *predictions.columns,
        (true == F.col("predicted_label_hardcode")).alias("hardcode_correct"),
        (true == F.col("predicted_label_sklearn")).alias("sklearn_correct"),
        "estado",
    )


def mart_reviews_enriched(reviews: DataFrame, negation_first: bool = False) -> DataFrame:
    """Reviews with text features. The lower-cased text is one column, so it is computed once per row."""
    body = F.col("texto_completo")
    features = reviews.withColumn("_lowered", F.lower("texto_completo")).select(
        "review_id",
        "order_id",
        "review_score",
        "sentiment_label",
        "titulo",
        "mensagem",
        "texto_completo",
        "tem_comentario",
        text.char_count(body).alias("num_caracteres"),
        text.word_count(body).alias("num_palavras"),
        text.all_caps(body).alias("texto_em_caixa_alta"),
        text.has_exclamation(body).alias("tem_exclamacao"),
        text.keyword_sentiment(F.col("_lowered"), negation_first).alias("sentimento_texto"),
    )
    return features.withColumn(
        "coerencia_nota_texto", text.coherence(F.col("sentiment_label"), F.col("sentimento_texto"))
    )


#: What the features take from products. Items that bring these columns along need no lookup.
MEASURES = ("product_weight_g", "product_volume_cm3")


def items_per_order(items: DataFrame, products: DataFrame, product_key: str, seller_key: str) -> DataFrame:
    """Order totals and the first item's seller from a single shuffle on the order."""
    head = F.min(F.struct(F.col("order_item_id").isNull().alias("_unordered"), "order_item_id", seller_key))
    if not set(MEASURES) <= set(items.columns):
        items = items.join(products.select(product_key, *MEASURES), product_key, "left")
    return items.groupBy("order_id").agg(
        F.count("*").alias("item_count"),
        F.sum("preco").alias("total_price"),
        F.sum("frete").alias("total_freight"),
        F.avg("product_weight_g").alias("avg_product_weight_g"),
        F.avg("product_volume_cm3").alias("avg_product_volume_cm3"),
        head.getField(seller_key).alias(seller_key),
    )


def payments_per_order(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(
        F.max("payment_installments").alias("payment_installments_max"), F.sum("payment_value").alias("payment_value_total")
    )


def located(rows: DataFrame, geolocation: DataFrame, key: str, side: str) -> DataFrame:
    """``key`` with state and centroid, columns prefixed by ``side``."""
    centres = settled(geolocation.select("zip_code_prefix", "latitude", "longitude"), "zip_code_prefix")
    return rows.join(centres, "zip_code_prefix", "left").select(
        key,
        F.col("estado").alias(f"{side}_state"),
        F.col("latitude").alias(f"{side}_lat"),
        F.col("longitude").alias(f"{side}_lng"),
    )


def mart_late_delivery_features(
    orders: DataFrame,
    items: DataFrame,
    payments: DataFrame,
    customers: DataFrame,
    sellers: DataFrame,
    products: DataFrame,
    geolocation: DataFrame,
    customer_key: str = "customer_key",
    product_key: str = "product_key",
    seller_key: str = "seller_key",
) -> DataFrame:
    """One row per delivered order with items.

    The customer lookup comes first, while the orders are still a plain scan whose skewed partitions AQE can split.
    The sides joined on the order are aggregates, unique in it.
    """
    orders, customers = packed(orders, customer_key), packed(customers, customer_key)
    items, products = packed(items, product_key, seller_key), packed(products, product_key)
    sellers = packed(sellers, seller_key)
    bought = F.col("order_purchase_timestamp")
    rows = (
        delivered(orders)
        .select("order_id", customer_key, "is_late", "approval_delay_hours", "estimated_delivery_days", bought)
        .join(located(customers, geolocation, customer_key, "customer"), customer_key, "left")
        .join(items_per_order(items, products, product_key, seller_key), "order_id")
        .join(payments_per_order(payments), "order_id", "left")
        .join(located(sellers, geolocation, seller_key, "seller"), seller_key, "left")
    )
    distance = haversine_km(F.col("customer_lat"), F.col("customer_lng"), F.col("seller_lat"), F.col("seller_lng"))
    return rows.withColumns(
        {
            "purchase_dow": weekday(bought),
            "purchase_month": F.month(bought),
            "distance_km": distance,
            "same_state_flag": equality_flag(F.col("customer_state"), F.col("seller_state")),
        }
    ).select("order_id", "is_late", *FEATURES, "customer_state", "seller_state")
