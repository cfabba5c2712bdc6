"""All named relations over one set of source tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from parcelwise.plans import core, marts, staging


class Models:
    """Lazy relations, each an attribute; ``raw`` maps a source table's name to its frame."""

    def __init__(self, spark: SparkSession, raw: Mapping[str, DataFrame]) -> None:
        self.spark = spark
        self.raw = raw

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self, name)

    @cached_property
    def stg_customers(self) -> DataFrame:
        return staging.customers(self.raw["customers"])

    @cached_property
    def stg_geolocation(self) -> DataFrame:
        return staging.geolocation(self.raw["geolocation"])

    @cached_property
    def stg_orders(self) -> DataFrame:
        return staging.orders(self.raw["orders"])

    @cached_property
    def stg_order_items(self) -> DataFrame:
        return staging.order_items(self.raw["order_items"])

    @cached_property
    def stg_order_payments(self) -> DataFrame:
        return staging.order_payments(self.raw["order_payments"])

    @cached_property
    def stg_order_reviews(self) -> DataFrame:
        return staging.order_reviews(self.raw["order_reviews"])

    @cached_property
    def stg_products(self) -> DataFrame:
        return staging.products(self.raw["products"])

    @cached_property
    def stg_sellers(self) -> DataFrame:
        return staging.sellers(self.raw["sellers"])

    @cached_property
    def stg_category_translation(self) -> DataFrame:
        return staging.category_translation(self.raw["category_translation"])

    @cached_property
    def stg_ml_predictions(self) -> DataFrame:
        return staging.ml_predictions(self.raw["ml_predictions"])

    @cached_property
    def dim_customers(self) -> DataFrame:
        return core.dim_customers(self.stg_customers)

    @cached_property
    def dim_sellers(self) -> DataFrame:
        return core.dim_sellers(self.stg_sellers)

    @cached_property
    def dim_products(self) -> DataFrame:
        return core.dim_products(self.stg_products, self.stg_category_translation)

    @cached_property
    def dim_geolocation(self) -> DataFrame:
        return core.dim_geolocation(self.stg_geolocation)

    @cached_property
    def dim_date(self) -> DataFrame:
        return core.dim_date(self.spark)

    @cached_property
    def order_measures(self) -> DataFrame:
        return core.order_measures(self.stg_orders)

    @cached_property
    def fact_orders(self) -> DataFrame:
        return core.fact_orders(self.stg_orders, self.stg_customers)

    @cached_property
    def fact_order_items(self) -> DataFrame:
        return core.fact_order_items(self.stg_order_items, self.stg_products, self.stg_sellers)

    @cached_property
    def fact_payments(self) -> DataFrame:
        return core.fact_payments(self.stg_order_payments)

    @cached_property
    def fact_reviews(self) -> DataFrame:
        return core.fact_reviews(self.stg_order_reviews, self.stg_orders)

    @cached_property
    def mart_delivery_kpis(self) -> DataFrame:
        return marts.mart_delivery_kpis(self.order_measures, self.stg_customers, "customer_id")

    @cached_property
    def mart_sentiment_kpis(self) -> DataFrame:
        return marts.mart_sentiment_kpis(self.stg_order_reviews, self.stg_order_items, self.dim_products, "product_id")

    @cached_property
    def mart_ml_results(self) -> DataFrame:
        return marts.mart_ml_results(self.stg_ml_predictions, self.stg_orders, self.stg_customers, "customer_id")

    @cached_property
    def mart_reviews_enriched(self) -> DataFrame:
        return marts.mart_reviews_enriched(self.stg_order_reviews)

    @cached_property
    def mart_late_delivery_features(self) -> DataFrame:
        return marts.mart_late_delivery_features(
            self.order_measures,
            self.stg_order_items,
            self.stg_order_payments,
            self.dim_customers,
            self.dim_sellers,
            self.dim_products,
            self.dim_geolocation,
            "customer_id",
            "product_id",
            "seller_id",
        )
