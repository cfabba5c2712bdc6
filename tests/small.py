"""A hand-made set of source tables with the awkward rows."""

from datetime import datetime as dt

from parcelwise.plans.build import StoredModels
from parcelwise.schemas import RAW_TABLES

ROWS = {
    "customers": [
        ("c1", "u1", "01037", "sao paulo", "sp"),
        ("c2", "u2", "99999", "rio", "rj"),
        ("c3", "u3", "01037", "sao paulo", None),
    ],
    "geolocation": [
        ("01037", -23.5, -46.5, "sao paulo", "sp"),
        ("01037", -23.7, -46.7, "são paulo", "sp"),
        ("20000", -22.9, -43.2, "rio", "rj"),
        ("20000", -22.9, -43.4, None, "rj"),
        ("20000", -22.9, -43.6, None, "rj"),
    ],
    "orders": [
        # same-day late, approved across an hour boundary
        ("o1", "c1", "delivered", dt(2017, 10, 1, 10, 59), dt(2017, 10, 1, 11, 1), None, dt(2017, 10, 10, 10), dt(2017, 10, 10)),
        # in time; unknown prefix; no payment
        ("o2", "c2", "delivered", dt(2017, 10, 1), None, None, dt(2017, 10, 5), dt(2017, 10, 10)),
        # delivered without a date
        ("o3", "c1", "delivered", dt(2017, 10, 1), None, None, None, dt(2017, 10, 10)),
        # without items
        ("o4", "c1", "delivered", dt(2017, 10, 1), None, None, dt(2017, 10, 3), dt(2017, 10, 10)),
        ("o5", "c1", "shipped", dt(2017, 10, 1), None, None, None, dt(2017, 10, 10)),
        # unknown customer
        ("o6", "cx", "delivered", dt(2017, 10, 1), None, None, dt(2017, 10, 12), dt(2017, 10, 10)),
    ],
    "order_items": [
        ("o1", 2, "p2", "s2", dt(2017, 10, 2), 10.0, 1.5),
        ("o1", 1, "p1", "s1", dt(2017, 10, 2), 20.0, 2.5),
        ("o2", 1, "p3", "sx", dt(2017, 10, 2), 5.0, 1.0),
        ("o3", 1, "px", "s1", dt(2017, 10, 2), 5.0, 1.0),
        ("o6", 1, "p1", "s2", dt(2017, 10, 2), 7.25, 1.0),
    ],
    "order_payments": [("o1", 1, "boleto", 1, 30.0), ("o1", 2, "voucher", 3, 4.0), ("o6", 1, "boleto", 2, 8.25)],
    "order_reviews": [
        ("r1", "o1", 5, "Bom", "péssimo", dt(2017, 11, 1), dt(2017, 11, 2)),
        ("r1", "o2", 1, None, None, dt(2017, 11, 1), dt(2017, 11, 2)),
        ("r2", "ox", 3, " ", "\n", dt(2017, 11, 1), dt(2017, 11, 2)),
        ("r3", "o3", None, "só título", None, dt(2017, 11, 1), dt(2017, 11, 2)),
    ],
    "products": [
        ("p1", "beleza", 1.0, 1.0, 1.0, 100.5, 10.0, 2.0, 3.0),
        ("p2", "outros", 1.0, 1.0, 1.0, None, 10.0, 2.0, None),
        ("p3", None, 1.0, 1.0, 1.0, 50.4, 1.0, 1.0, 1.0),
    ],
    "sellers": [("s1", "20000", "rio", "rj"), ("s2", "01037", "sao paulo", "sp")],
    "category_translation": [("beleza", "beauty")],
    "ml_predictions": [("o1", "late", "late", "on_time", "v1", dt(2026, 1, 1)), ("o2", "on_time", "late", "on_time", "v1", dt(2026, 1, 1))],
}


def raw_tables(spark):
    schemas = {name: spec.schema for name, spec in RAW_TABLES.items()}
    schemas["ml_predictions"] = (
        "order_id string, true_label string, predicted_label_hardcode string, predicted_label_sklearn string,"
        " model_version string, predicted_at timestamp_ntz"
    )
    return {name: spark.createDataFrame(rows, schemas[name]) for name, rows in ROWS.items()}


def small_models(spark, **replaced):
    return StoredModels(spark, {**raw_tables(spark), **replaced})
