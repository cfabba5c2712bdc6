"""Full and partial builds of the stored models."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from parcelwise.plans import core, marts
from parcelwise.plans.models import Models
from parcelwise.plans.staging import ml_predictions
from parcelwise.sources.layers import read_predictions, register_views, write_snapshot

VIEWS = (
    "stg_customers",
    "stg_geolocation",
    "stg_orders",
    "stg_order_items",
    "stg_order_payments",
    "stg_order_reviews",
    "stg_products",
    "stg_sellers",
    "stg_category_translation",
    "stg_ml_predictions",
    "mart_reviews_enriched",
)
CORE = (
    "dim_customers",
    "dim_sellers",
    "dim_products",
    "dim_geolocation",
    "dim_date",
    "fact_orders",
    "fact_order_items",
    "fact_payments",
    "fact_reviews",
)
MARTS = ("mart_delivery_kpis", "mart_sentiment_kpis", "mart_late_delivery_features", "mart_ml_results")


class StoredModels(Models):
    """Models that are read back from ``folder`` once :meth:`store` has written them.

    Marts are planned over stored facts and their hashed keys where these exist, over the staging views otherwise.
    The table of items also keeps the measures of its products, which were looked up to write it: the feature mart reads
    them there instead of shuffling all items by product again. ``fact_order_items`` is without them.
    """

    def __init__(
        self, spark: SparkSession, raw: Mapping[str, DataFrame], stored: Mapping[str, DataFrame] | None = None
    ) -> None:
        super().__init__(spark, raw)
        self.stored = set(stored or ())
        self.measured: dict[str, DataFrame] = {}  # the stored items with their measures
        self.__dict__.update(stored or {})

    def _have(self, *names: str) -> bool:
        return self.stored.issuperset(names)

    @cached_property
    def mart_delivery_kpis(self) -> DataFrame:
        if self._have("fact_orders", "dim_customers"):
            return marts.mart_delivery_kpis(self.fact_orders, self.dim_customers)
        return super().mart_delivery_kpis

    @cached_property
    def mart_sentiment_kpis(self) -> DataFrame:
        if self._have("fact_reviews", "fact_order_items", "dim_products"):
            return marts.mart_sentiment_kpis(self.fact_reviews, self.fact_order_items, self.dim_products)
        return super().mart_sentiment_kpis

    @cached_property
    def mart_ml_results(self) -> DataFrame:
        if self._have("fact_orders", "dim_customers"):
            return marts.mart_ml_results(self.stg_ml_predictions, self.fact_orders, self.dim_customers)
        return super().mart_ml_results

    @cached_property
    def mart_late_delivery_features(self) -> DataFrame:
        facts = ("fact_orders", "fact_order_items", "fact_payments")
        dimensions = ("dim_customers", "dim_sellers", "dim_products", "dim_geolocation")
        if self._have(*facts, *dimensions):
            tables = {name: self[name] for name in (*facts, *dimensions)}
            return marts.mart_late_delivery_features(*(tables | self.measured).values())
        return super().mart_late_delivery_features

    def tables(self) -> dict[str, DataFrame]:
        """Frames that read the stored models."""
        return {name: self[name] for name in sorted(self.stored)}

    def _table(self, name: str) -> DataFrame:
        """What is written for a model."""
        if name != "fact_order_items" or name in self.stored:
            return self[name]
        products = self.stg_products.select("product_id", "product_weight_g", core.product_volume())
        return core.fact_order_items(self.stg_order_items, products, self.stg_sellers, *marts.MEASURES)

    def store(self, folder: str, names: Sequence[str], threads: int = 4) -> StoredModels:
        """Write the named models side by side; whatever is asked for next starts from the tables."""
        frames = [self._table(name) for name in names]
        with ThreadPoolExecutor(threads) as pool:
            paths = list(pool.map(write_snapshot, frames, [folder] * len(names), names))
        self.stored.update(names)
        for name in {*CORE, *MARTS} - self.stored:
            self.__dict__.pop(name, None)  # to be planned anew, over the tables
        for name, path in zip(names, paths):
            rows = self.spark.read.parquet(path)
            if name == "fact_order_items":
                self.measured = {name: rows}  # without the columns, if the items were stored before
                rows = rows.drop(*marts.MEASURES)
            self.__dict__[name] = rows
        return self


def build(models: StoredModels, folder: str) -> StoredModels:
    """Dimensions and facts as tables, then the marts over them; staging and enriched reviews as views."""
    models.store(folder, CORE).store(folder, MARTS)
    register_views(models, VIEWS)
    return models


def refresh_predictions(models: Models, folder: str, target: str) -> DataFrame:
    """After scoring: rebuild only the prediction view and mart, from stored facts and the new predictions."""
    view = ml_predictions(read_predictions(models.spark, folder))
    view.createOrReplaceTempView("stg_ml_predictions")
    mart = marts.mart_ml_results(view, models["fact_orders"], models["dim_customers"])
    return models.spark.read.parquet(write_snapshot(mart, target, "mart_ml_results"))
