"""Cleaned one-to-one views over the source tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelwise.functions.cleaning import join_text, null_if_blank
from parcelwise.functions.text import score_sentiment
from parcelwise.schemas import PREDICTIONS, RAW_TABLES


def _place(rows: DataFrame, prefix: str) -> DataFrame:
    """City and state under their model names, in upper case."""
    return (
        rows.withColumnsRenamed({f"{prefix}_city": "cidade", f"{prefix}_state": "estado"})
        .withColumn("cidade", F.upper("cidade"))
        .withColumn("estado", F.upper("estado"))
    )


def customers(raw: DataFrame) -> DataFrame:
    return _place(raw, "customer").select("customer_id", "customer_unique_id", "customer_zip_code_prefix", "cidade", "estado")


def sellers(raw: DataFrame) -> DataFrame:
    renamed = _place(raw, "seller").withColumnRenamed("seller_zip_code_prefix", "zip_code_prefix")
    return renamed.select("seller_id", "zip_code_prefix", "cidade", "estado")


def geolocation(raw: DataFrame) -> DataFrame:
    names = {
        "geolocation_zip_code_prefix": "zip_code_prefix",
        "geolocation_lat": "latitude",
        "geolocation_lng": "longitude",
    }
    renamed = _place(raw, "geolocation").withColumnsRenamed(names)
    return renamed.select(*names.values(), "cidade", "estado")


def orders(raw: DataFrame) -> DataFrame:
    stamps = ("order_purchase_timestamp", "order_delivered_customer_date")
    typed = raw.withColumns({name: F.col(name).cast("timestamp_ntz") for name in stamps})
    return typed.select(*RAW_TABLES["orders"].columns)


def order_items(raw: DataFrame) -> DataFrame:
    return raw.select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "shipping_limit_date",
        F.col("price").cast("decimal(10,2)").alias("preco"),
        F.col("freight_value").cast("decimal(10,2)").alias("frete"),
    )


def order_payments(raw: DataFrame) -> DataFrame:
    return raw.select(*RAW_TABLES["order_payments"].columns)


def order_reviews(raw: DataFrame, strict_text: bool = False) -> DataFrame:
    """Review texts on one line, blanks as NULL. ``strict_text`` drops a text that lacks its title or its message."""
    title, message = F.col("titulo"), F.col("mensagem")
    cleaned = raw.withColumn("titulo", null_if_blank(F.col("review_comment_title"))).withColumn(
        "mensagem", null_if_blank(F.col("review_comment_message"))
    )
    return cleaned.select(
        "review_id",
        "order_id",
        "review_score",
        "review_creation_date",
        "review_answer_timestamp",
        score_sentiment(F.col("review_score")).alias("sentiment_label"),
        title,
        message,
        join_text(title, message, strict_text).alias("texto_completo"),
        title.isNotNull().alias("tem_titulo"),
        message.isNotNull().alias("tem_mensagem"),
        (title.isNotNull() | message.isNotNull()).alias("tem_comentario"),
    )


def products(raw: DataFrame) -> DataFrame:
    """Weight in whole grams, rounded (a bare cast would truncate)."""
    weight = F.round("product_weight_g").cast("int")
    return raw.withColumn("product_weight_g", weight).select(*RAW_TABLES["products"].columns)


def category_translation(raw: DataFrame) -> DataFrame:
    return raw.select(*RAW_TABLES["category_translation"].columns)


def ml_predictions(raw: DataFrame) -> DataFrame:
    return raw.select(*PREDICTIONS.columns)
