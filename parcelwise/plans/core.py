"""Star schema: dimensions and facts with hashed keys.

Lookups join on the natural ids, which are shorter than their hashes, and hash afterwards. Joins carry no broadcast
hint: every side here grows with the business, so Spark decides from the sizes it measures.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelwise.functions.dates import days_between, hours_between, is_weekend, weekday
from parcelwise.functions.keys import key_if_found, surrogate_key
from parcelwise.operators.aggregates import mean_and_mode


def dim_customers(customers: DataFrame) -> DataFrame:
    return customers.select(
        surrogate_key("customer_id").alias("customer_key"),
        "customer_id",
        "customer_unique_id",
        F.col("customer_zip_code_prefix").alias("zip_code_prefix"),
        "cidade",
        "estado",
    )


def dim_sellers(sellers: DataFrame) -> DataFrame:
    return sellers.select(surrogate_key("seller_id").alias("seller_key"), "seller_id", "zip_code_prefix", "cidade", "estado")


def product_volume() -> Column:
    volume = F.col("product_length_cm") * F.col("product_height_cm") * F.col("product_width_cm")
    return volume.alias("product_volume_cm3")


def dim_products(products: DataFrame, translation: DataFrame) -> DataFrame:
    measures = [name for name in products.columns if name not in ("product_id", "product_category_name")]
    return products.join(translation, "product_category_name", "left").select(
        surrogate_key("product_id").alias("product_key"),
        "product_id",
        F.col("product_category_name").alias("category_name"),
        F.coalesce("product_category_name_english", "product_category_name").alias("category_name_english"),
        *measures,
        product_volume(),
    )


def dim_geolocation(geolocation: DataFrame) -> DataFrame:
    return mean_and_mode(geolocation, "zip_code_prefix", ("latitude", "longitude"), ("cidade", "estado"))


def calendar(bounds: DataFrame) -> DataFrame:
    """One row per day from ``first_day`` up to, not including, ``end_day`` of a one-row frame."""
    days = bounds.select(F.explode(F.sequence("first_day", F.date_sub("end_day", 1))).alias("date_day"))
    day = F.col("date_day")
    return days.select(
        day,
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.day(day).alias("day"),
        weekday(day).alias("day_of_week"),
        is_weekend(day).alias("is_weekend"),
    )


def dim_date(spark: SparkSession, first_day: date = date(2016, 1, 1), end_day: date = date(2019, 1, 1)) -> DataFrame:
    return calendar(spark.range(1).select(F.lit(first_day).alias("first_day"), F.lit(end_day).alias("end_day")))


def order_measures(orders: DataFrame) -> DataFrame:
    """Orders with delay measures, still on natural keys: a projection only, so filters on it reach the scan."""
    bought = F.col("order_purchase_timestamp")
    delivered, promised = F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date")
    return orders.withColumns(
        {
            "is_late": delivered > promised,  # NULL while either date is
            "delivery_days": days_between(bought, delivered),
            "estimated_delivery_days": days_between(bought, promised),
            "approval_delay_hours": hours_between(bought, F.col("order_approved_at")),
        }
    )


def fact_orders(orders: DataFrame, customers: DataFrame) -> DataFrame:
    known = customers.select("customer_id", F.col("customer_id").alias("found"))
    measured = order_measures(orders)
    rest = [name for name in measured.columns if name not in ("order_id", "customer_id")]
    return measured.join(known, "customer_id", "left").select(
        surrogate_key("order_id").alias("order_key"),
        "order_id",
        key_if_found(F.col("found"), "customer_id").alias("customer_key"),
        *rest,
    )


def fact_order_items(items: DataFrame, products: DataFrame, sellers: DataFrame, *measures: str) -> DataFrame:
    """``measures`` are columns of the products to be kept with their items."""
    known_products = products.select("product_id", F.col("product_id").alias("found_product"), *measures)
    known_sellers = sellers.select("seller_id", F.col("seller_id").alias("found_seller"))
    return (
        items.join(known_products, "product_id", "left")
        .join(known_sellers, "seller_id", "left")
        .select(
            surrogate_key("order_id", "order_item_id").alias("order_item_key"),
            "order_id",
            "order_item_id",
            key_if_found(F.col("found_product"), "product_id").alias("product_key"),
            key_if_found(F.col("found_seller"), "seller_id").alias("seller_key"),
            "shipping_limit_date",
            "preco",
            "frete",
            *measures,
        )
    )


def fact_payments(payments: DataFrame) -> DataFrame:
    return payments.select(surrogate_key("order_id", "payment_sequential").alias("payment_key"), *payments.columns)


def review_key() -> Column:
    return surrogate_key("review_id", "order_id")


def fact_reviews(reviews: DataFrame, orders: DataFrame) -> DataFrame:
    known = orders.select("order_id", F.col("order_id").alias("found"))
    return reviews.join(known, "order_id", "left").select(
        review_key().alias("review_key"),
        "review_id",
        "order_id",
        key_if_found(F.col("found"), "order_id").alias("order_key"),
        "review_score",
        "titulo",
        "mensagem",
        "sentiment_label",
        "review_creation_date",
        "review_answer_timestamp",
    )
