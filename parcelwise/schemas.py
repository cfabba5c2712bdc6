"""The one registry of source tables: column order, types and file patterns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

TEXT = T.StringType()
STAMP = T.TimestampNTZType()
REAL = T.DoubleType()
WHOLE = T.LongType()


@dataclass(frozen=True)
class TableSpec:
    """A source table. Files map to columns by position, so ``columns`` is ordered."""

    name: str
    file_glob: str
    columns: dict[str, T.DataType]
    multiline: bool = False  # only free text needs it; it makes a CSV file unsplittable

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(name, kind) for name, kind in self.columns.items()])

    @property
    def text_schema(self) -> T.StructType:
        return T.StructType([T.StructField(name, TEXT) for name in self.columns])

    def of_type(self, kind: T.DataType) -> list[str]:
        return [name for name, declared in self.columns.items() if declared == kind]


def _spec(name: str, file_glob: str, multiline: bool = False, **columns: T.DataType) -> TableSpec:
    return TableSpec(name, file_glob, columns, multiline)


# Column names, order and types of the source data set.
RAW_TABLES: dict[str, TableSpec] = {
    spec.name: spec
    for spec in (
        _spec(
            "customers",
            "*customers_dataset.csv",
            customer_id=TEXT,
            customer_unique_id=TEXT,
            customer_zip_code_prefix=TEXT,
            customer_city=TEXT,
            customer_state=TEXT,
        ),
        _spec(
            "geolocation",
            "*geolocation_dataset.csv",
            geolocation_zip_code_prefix=TEXT,
            geolocation_lat=REAL,
            geolocation_lng=REAL,
            geolocation_city=TEXT,
            geolocation_state=TEXT,
        ),
        _spec(
            "orders",
            "*_orders_dataset.csv",
            order_id=TEXT,
            customer_id=TEXT,
            order_status=TEXT,
            order_purchase_timestamp=STAMP,
            order_approved_at=STAMP,
            order_delivered_carrier_date=STAMP,
            order_delivered_customer_date=STAMP,
            order_estimated_delivery_date=STAMP,
        ),
        _spec(
            "order_items",
            "*order_items_dataset.csv",
            order_id=TEXT,
            order_item_id=WHOLE,
            product_id=TEXT,
            seller_id=TEXT,
            shipping_limit_date=STAMP,
            price=REAL,
            freight_value=REAL,
        ),
        _spec(
            "order_payments",
            "*order_payments_dataset.csv",
            order_id=TEXT,
            payment_sequential=WHOLE,
            payment_type=TEXT,
            payment_installments=WHOLE,
            payment_value=REAL,
        ),
        _spec(
            "order_reviews",
            "*order_reviews_dataset.csv",
            multiline=True,
            review_id=TEXT,
            order_id=TEXT,
            review_score=WHOLE,
            review_comment_title=TEXT,
            review_comment_message=TEXT,
            review_creation_date=STAMP,
            review_answer_timestamp=STAMP,
        ),
        _spec(
            "products",
            "*products_dataset.csv",
            product_id=TEXT,
            product_category_name=TEXT,
            product_name_lenght=REAL,
            product_description_lenght=REAL,
            product_photos_qty=REAL,
            product_weight_g=REAL,
            product_length_cm=REAL,
            product_height_cm=REAL,
            product_width_cm=REAL,
        ),
        _spec(
            "sellers",
            "*sellers_dataset.csv",
            seller_id=TEXT,
            seller_zip_code_prefix=TEXT,
            seller_city=TEXT,
            seller_state=TEXT,
        ),
        _spec(
            "category_translation",
            "product_category_name_translation.csv",
            product_category_name=TEXT,
            product_category_name_english=TEXT,
        ),
    )
}

PREDICTIONS = _spec(
    "ml_predictions",
    "*predictions*.csv",
    order_id=TEXT,
    true_label=TEXT,
    predicted_label_hardcode=TEXT,
    predicted_label_sklearn=TEXT,
    model_version=TEXT,
    predicted_at=T.TimestampType(),
)

# Model inputs, labels and version.
FEATURES: dict[str, T.DataType] = {
    "total_price": REAL,
    "total_freight": REAL,
    "item_count": WHOLE,
    "avg_product_weight_g": REAL,
    "avg_product_volume_cm3": REAL,
    "payment_installments_max": WHOLE,
    "payment_value_total": REAL,
    "approval_delay_hours": WHOLE,
    "estimated_delivery_days": WHOLE,
    "purchase_dow": WHOLE,
    "purchase_month": WHOLE,
    "distance_km": REAL,
    "same_state_flag": WHOLE,
}
FEATURE_TABLE = TableSpec(
    "late_delivery_features",
    "late_delivery_features*.csv",
    {"order_id": TEXT, "is_late": T.BooleanType(), **FEATURES},
)
ON_TIME, LATE = "on_time", "late"
LABELS = (ON_TIME, LATE)
MODEL_VERSION = "late-delivery-logreg-v1"

# Enumerations the quality checks accept.
ORDER_STATUSES = (
    "delivered",
    "shipped",
    "canceled",
    "unavailable",
    "invoiced",
    "processing",
    "created",
    "approved",
)
SENTIMENTS = ("positivo", "neutro", "negativo")
