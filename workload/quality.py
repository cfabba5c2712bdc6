"""Quality checks and the suite (inventory 2.13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelwise.operators import checks
from parcelwise.plans import suite
from parcelwise.plans.build import build
from parcelwise.schemas import ORDER_STATUSES
from parcelwise.session import scratch_dir
from workload.registry import query, rounded
from workload.relational import order_calendar


@query("m1_not_null", "select order_id, order_key, order_delivered_customer_date from fact_orders where order_delivered_customer_date is null")
def m1(m):
    return checks.not_null(m.fact_orders, "order_delivered_customer_date").select("order_id", "order_key", "order_delivered_customer_date")


@query("m2_unique", "select customer_id, count(*) occurrences from raw_orders group by 1 having count(*) > 1")
def m2(m):
    return checks.unique(m.stg_orders, "customer_id")


@query("m3_accepted_values", "select order_status, count(*) occurrences from raw_orders where order_status not in ('delivered', 'shipped') group by 1")
def m3(m):
    return checks.accepted_values(m.stg_orders, "order_status", ORDER_STATUSES[:2])


@query(
    "m4_relationships",
    "select customer_id as key, count(*) occurrences from raw_orders where customer_id not in (select customer_id from raw_customers) group by 1",
)
def m4(m):
    return checks.relationships(m.stg_orders, "customer_id", m.stg_customers, "customer_id")


@query("m5_unique_combination", "select seller_id, product_id, count(*) occurrences from raw_order_items group by all having count(*) > 1")
def m5(m):
    return checks.unique_combination(m.stg_order_items, ("seller_id", "product_id"))


# The given orders break none of the next three checks, so each is fed a spoilt copy.
@query("m6_nonnegative_days", "select order_id, delivery_days - 10 delivery_days from fact_orders where delivery_days < 10")
def m6(m):
    return checks.negative_days(m.fact_orders.withColumn("delivery_days", F.col("delivery_days") - 10))


@query(
    "m7_late_coherent",
    """select order_id, order_delivered_customer_date, order_estimated_delivery_date, true is_late from fact_orders
    where delivery_days > 15 and order_delivered_customer_date <= order_estimated_delivery_date""",
)
def m7(m):
    return checks.late_but_in_time(m.fact_orders.withColumn("is_late", F.col("delivery_days") > 15))


@query("m8_shares_sum_to_one", "select category_name_english, review_count from mart_sentiment_kpis where abs(pct_positivo + pct_neutro + pct_negativo - 1) > 0.000001 or category_name_english > 'd'")
def m8(m):
    spoilt = F.when(F.col("category_name_english") > "d", F.col("pct_positivo") + 0.001).otherwise(F.col("pct_positivo"))
    return checks.shares_off_one(m.mart_sentiment_kpis.withColumn("pct_positivo", spoilt)).select("category_name_english", "review_count")


def _suite_sql() -> str:
    spine = "(select unnest(generate_series(min(cast(order_purchase_timestamp as date)), max(cast(order_purchase_timestamp as date)), interval 1 day)) date_day from raw_orders)"

    def source(model: str) -> str:
        return spine if model == "dim_date" else model

    parts = []
    for model, columns in suite.REQUIRED.items():
        parts += [f"select 'not_null_{c}' check_name, '{model}' model, count(*) v from {source(model)} where {c} is null" for c in columns]
    for model, columns in suite.UNIQUE.items():
        parts += [
            f"select 'unique_{c}', '{model}', count(*) from (select {c} from {source(model)} where {c} is not null group by 1 having count(*) > 1)"
            for c in columns
        ]
    for (model, c), values in suite.ACCEPTED.items():
        listed = ", ".join(f"'{v}'" for v in values)
        parts.append(f"select 'accepted_values_{c}', '{model}', count(distinct {c}) from {model} where {c} not in ({listed})")
    for (model, c), parent in suite.PARENTS.items():
        parts.append(f"select 'relationships_{c}', '{model}', count(*) from {model} where {c} not in (select {c} from {parent})")
    parts.append("select 'unique_review_id_order_id', 'stg_order_reviews', count(*) from (select 1 from stg_order_reviews group by review_id, order_id having count(*) > 1)")
    parts.append("select 'delivery_days_not_negative', 'fact_orders', count(*) from fact_orders where delivery_days < 0")
    parts.append("select 'is_late_coherent', 'fact_orders', count(*) from fact_orders where is_late and order_delivered_customer_date <= order_estimated_delivery_date")
    parts.append("select 'shares_sum_to_one', 'mart_sentiment_kpis', count(*) from mart_sentiment_kpis where abs(pct_positivo + pct_neutro + pct_negativo - 1) > 0.000001")
    return f"select check_name, model, v violations, if(v = 0, 'pass', 'fail') status from ({' union all '.join(parts)})"


@query("m9_suite_report", _suite_sql())
def m9(m):
    build(m, scratch_dir(m.spark, "suite"))
    m.__dict__["dim_date"] = order_calendar(m)  # the days of these orders
    return suite.run_suite(m)
