"""Filters, joins, aggregates, ranking, sorting, set operations and scalar functions (inventory 2.3 to 2.9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelwise.functions import cleaning, dates, geo, keys, scoring, text
from parcelwise.operators import aggregates, checks, classification, logistic, quantiles
from parcelwise.plans import cards, core, late_delivery, marts, staging
from parcelwise.schemas import FEATURES, SENTIMENTS
from workload.oracle_models import FEATURES as FEATURE_NAMES
from workload.oracle_models import PRAISE, haversine, mentions
from workload.oracle_tables import key_of
from workload.registry import query, rounded, split_rows


# filters


@query("c1_delivered_filter", "select order_id, customer_key, is_late from delivered_orders")
def c1(m):
    return marts.delivered(m.fact_orders).select("order_id", "customer_key", "is_late")


@query("c2_in_list", "select order_id, dayofweek(order_purchase_timestamp) in (0, 6) weekend from raw_orders where order_status in ('shipped', 'canceled')")
def c2(m):
    rows = m.stg_orders.filter(F.col("order_status").isin("shipped", "canceled"))
    return rows.select("order_id", dates.is_weekend(F.col("order_purchase_timestamp")).alias("weekend"))


@query("c3_like_any", f"select review_id, order_id from stg_order_reviews where {mentions(PRAISE)}")
def c3(m):
    return m.stg_order_reviews.filter(text.contains_any(F.lower("texto_completo"), text.PRAISE)).select("review_id", "order_id")


@query("c4_is_not_null", "select product_id, category_name from dim_products where category_name is not null")
def c4(m):
    return m.dim_products.filter(F.col("category_name").isNotNull()).select("product_id", "category_name")


KPI_SQL = "select estado, order_count, late_count from mart_delivery_kpis"


@query("c5_optional_filter", KPI_SQL)
def c5(m):
    return cards.in_state(m.mart_delivery_kpis, None).select("estado", "order_count", "late_count")


@query("c5_optional_filter_state", KPI_SQL + " where estado = 'NATION_3'")
def c5_state(m):
    return cards.in_state(m.mart_delivery_kpis, "NATION_3").select("estado", "order_count", "late_count")


@query("c6_contains_ci", KPI_SQL + " where contains(lower(estado), 'tion_1')")
def c6(m):
    return cards.state_contains(m.mart_delivery_kpis, "Tion_1").select("estado", "order_count", "late_count")


@query("c7_false_filter", "select order_id from mart_ml_results where sklearn_correct = false")
def c7(m):
    return m.mart_ml_results.filter(~F.col("sklearn_correct")).select("order_id")


@query("c8_dropna", "select order_id, label from prepared")
def c8(m):
    return late_delivery.prepare(m.mart_late_delivery_features).select("order_id", "label")


@query("c9_date_guard", "select order_id, delivery_days - estimated_delivery_days delivery_days from fact_orders where delivery_days < estimated_delivery_days")
def c9(m):
    """The guard over days against the promise, which early deliveries make negative."""
    return checks.negative_days(m.fact_orders.withColumn("delivery_days", F.col("delivery_days") - F.col("estimated_delivery_days")))


# joins


@query("d1_left_translate", "select product_id, category_name, category_name_english from dim_products")
def d1(m):
    return m.dim_products.select("product_id", "category_name", "category_name_english")


@query("d2_left_item_product", "select order_id, order_item_id, product_key from fact_order_items")
def d2(m):
    return m.fact_order_items.select("order_id", "order_item_id", "product_key")


@query("d3_left_item_seller", "select order_id, order_item_id, seller_key from fact_order_items")
def d3(m):
    return m.fact_order_items.select("order_id", "order_item_id", "seller_key")


@query("d4_left_order_customer", "select order_id, customer_key from fact_orders")
def d4(m):
    return m.fact_orders.select("order_id", "customer_key")


@query("d5_left_review_order", "select review_id, order_id, order_key from fact_reviews")
def d5(m):
    return m.fact_reviews.select("review_id", "order_id", "order_key")


@query("d6_left_kpi_customer", "select order_id, estado, is_late from delivered_orders left join dim_customers using (customer_key)")
def d6(m):
    rows = marts.delivered(m.fact_orders).join(m.dim_customers.select("customer_key", "estado"), "customer_key", "left")
    return rows.select("order_id", "estado", "is_late")


@query("d7_left_chain_pred", "select order_id, true_label, estado from mart_ml_results")
def d7(m):
    rows = marts.mart_ml_results(m.stg_ml_predictions, m.fact_orders, m.dim_customers)
    return rows.select("order_id", "true_label", "estado")


@query("d8_left_chain_sent", "select review_key, sentiment_label, category_name_english from categorised_reviews")
def d8(m):
    first = aggregates.first_in_group(m.fact_order_items, "order_id", "order_item_id", "product_key")
    rows = m.fact_reviews.join(aggregates.settled(first, "order_id"), "order_id", "left")
    rows = rows.join(m.dim_products.select("product_key", "category_name_english"), "product_key", "left")
    return rows.select("review_key", "sentiment_label", "category_name_english")


ITEM_TOTALS = "order_id, item_count, cast(total_price as double) total_price, cast(total_freight as double) total_freight"


@query(
    "d9_left_item_prod_agg",
    f"select {ITEM_TOTALS}, round(avg_product_weight_g, 6) avg_product_weight_g, round(avg_product_volume_cm3, 6) avg_product_volume_cm3 from order_lines",
)
def d9(m):
    rows = marts.items_per_order(m.stg_order_items, m.dim_products, "product_id", "seller_id").drop("seller_id")
    return rounded(rows)


@query("d10_left_geo_customer", "select customer_id, state customer_state, round(latitude, 10) customer_lat, round(longitude, 10) customer_lng from placed join dim_customers on key = customer_key and party = 'customer'")
def d10(m):
    return rounded(marts.located(m.dim_customers, m.dim_geolocation, "customer_id", "customer"), 10)


@query("d11_left_geo_seller", "select seller_id, state seller_state, round(latitude, 10) seller_lat, round(longitude, 10) seller_lng from placed join dim_sellers on key = seller_key and party = 'seller'")
def d11(m):
    return rounded(marts.located(m.dim_sellers, m.dim_geolocation, "seller_id", "seller"), 10)


@query("d12_inner_order_items", "select order_id, item_count from fact_orders join order_lines using (order_id)")
def d12(m):
    counted = m.stg_order_items.groupBy("order_id").agg(F.count("*").alias("item_count"))
    return m.stg_orders.select("order_id").join(counted, "order_id")


@query(
    "d13_left_feature_star",
    "select order_id, payment_installments_max, payment_value_total, customer_state, seller_state, round(distance_km, 6) distance_km from mart_late_delivery_features",
)
def d13(m):
    names = ("order_id", "payment_installments_max", "payment_value_total", "customer_state", "seller_state", "distance_km")
    return rounded(m.mart_late_delivery_features.select(*names))


CARD6_SQL = """
select category_name_english categoria, count(*) total_reviews, round(100 * avg(cast(sentiment_label = 'positivo' as integer)), 6) pct_positivo,
       round(100 * avg(cast(sentiment_label = 'neutro' as integer)), 6) pct_neutro, round(100 * avg(cast(sentiment_label = 'negativo' as integer)), 6) pct_negativo
from categorised_reviews r left join fact_orders o on o.order_id = r.order_id left join dim_customers c on c.customer_key = o.customer_key
where category_name_english is not null {extra} group by 1 order by total_reviews desc, categoria limit {limit}"""


def card6(m, estado=None, limit=15):
    return rounded(
        cards.sentiment_by_category(
            m.stg_order_reviews, m.stg_order_items, m.dim_products, m.stg_orders, m.stg_customers, estado, limit, "product_id", "customer_id"
        )
    )


@query("d14_left_card6", CARD6_SQL.format(extra="and c.estado = 'NATION_7'", limit=15))
def d14(m):
    return card6(m, "NATION_7")


@query(
    "d15_anti_orphan",
    "select order_id as key, count(*) occurrences from raw_order_reviews where order_id not in (select order_id from raw_orders) group by 1",
)
def d15(m):
    return checks.relationships(m.stg_order_reviews, "order_id", m.stg_orders, "order_id")


# aggregates


@query("e1_count_star", "select order_id, count(*) item_count from raw_order_items group by 1")
def e1(m):
    return m.stg_order_items.groupBy("order_id").agg(F.count("*").alias("item_count"))


@query("e2_count_col", "select order_status, count(order_approved_at) approved, count(order_delivered_customer_date) delivered from raw_orders group by 1")
def e2(m):
    return m.stg_orders.groupBy("order_status").agg(
        F.count("order_approved_at").alias("approved"), F.count("order_delivered_customer_date").alias("delivered")
    )


@query("e3_sum", "select seller_id, cast(sum(preco) as double) total_price, cast(sum(frete) as double) total_freight from stg_order_items group by 1")
def e3(m):
    return m.stg_order_items.groupBy("seller_id").agg(F.sum("preco").alias("total_price"), F.sum("frete").alias("total_freight"))


@query("e4_avg", "select zip_code_prefix, round(avg(latitude), 10) latitude, round(avg(longitude), 10) longitude from stg_geolocation group by 1")
def e4(m):
    return rounded(m.stg_geolocation.groupBy("zip_code_prefix").agg(F.avg("latitude").alias("latitude"), F.avg("longitude").alias("longitude")), 10)


@query("e5_max", "select order_id, max(payment_installments) payment_installments_max from fact_payments group by order_id")
def e5(m):
    return marts.payments_per_order(m.stg_order_payments).select("order_id", "payment_installments_max")


@query("e6_mode", "select zip_code_prefix, cidade, estado from dim_geolocation")
def e6(m):
    return m.dim_geolocation.select("zip_code_prefix", "cidade", "estado")


@query("e7_conditional_count", "select order_status, count(*) filter (where is_late) late_count from order_measures group by 1")
def e7(m):
    return m.order_measures.groupBy("order_status").agg(aggregates.count_where(F.col("is_late")).alias("late_count"))


@query(
    "e8_conditional_share",
    "select order_id, " + ", ".join(f"round(avg(cast(sentiment_label = '{s}' as integer)), 6) pct_{s}" for s in SENTIMENTS) + " from stg_order_reviews group by 1",
)
def e8(m):
    shares = [aggregates.share_where(F.col("sentiment_label") == s, F.col("review_id")).alias(f"pct_{s}") for s in SENTIMENTS]
    return rounded(m.stg_order_reviews.groupBy("order_id").agg(*shares))


@query("e9_global_agg", "select round(avg(avg_delivery_days), 6) prazo_medio_real from mart_delivery_kpis")
def e9(m):
    return rounded(cards.avg_actual_days(m.mart_delivery_kpis))


@query("e10_reaggregate", "select sum(order_count) total_pedidos, sum(late_count) total_atrasados, round(100.0 * sum(late_count) / sum(order_count), 6) pct_atraso from mart_delivery_kpis")
def e10(m):
    return rounded(cards.late_rate(m.mart_delivery_kpis))


@query(
    "e11_confusion_matrix",
    """select true_label, count(*) filter (where predicted_label_sklearn = 'on_time') on_time, count(*) filter (where predicted_label_sklearn = 'late') late
    from raw_ml_predictions group by 1""",
)
def e11(m):
    return classification.confusion_matrix(m.stg_ml_predictions, "true_label", "predicted_label_sklearn")


@query(
    "e12_majority_class",
    "select label, count(*) n, count(*) = max(count(*)) over () majority from train_rows group by label",
)
def e12(m):
    train = split_rows(m).filter("split = 'train'")
    counts = train.groupBy("label").agg(F.count("*").alias("n"))
    return counts.withColumn("majority", F.col("label") == classification.majority_label(train, "label"))


_MEANS = ", ".join(f"round(avg({n}), 4) mean_{n}, round(if(stddev_pop({n}) = 0, 1.0, stddev_pop({n})), 4) spread_{n}" for n in FEATURE_NAMES)
WEIGHTS_SQL = """count(*) as rows, count(*) filter (where is_late) late_rows, round(count(*) / (2.0 * greatest(count(*) filter (where is_late), 1)), 4) late_weight,
  round(count(*) / (2.0 * greatest(count(*) filter (where not is_late), 1)), 4) other_weight"""


@query("e13_mean_std_pop", f"select {_MEANS} from prepared")
def e13(m):
    row = logistic.stats_row(late_delivery.prepare(m.mart_late_delivery_features), tuple(FEATURES), "is_late")
    return rounded(row.drop("rows", "late_rows", "late_weight", "other_weight"), 4)


@query("e14_class_weights", f"select {WEIGHTS_SQL} from prepared")
def e14(m):
    prepared = late_delivery.prepare(m.mart_late_delivery_features)
    return rounded(prepared.agg(*logistic.class_weights(F.col("is_late"))), 4)


@query("e15_quantile", "select round(quantile_cont(l_extendedprice, 0.92), 6) q92, round(quantile_cont(l_extendedprice, 0.5), 6) q50, count(*) n from lineitem")
def e15(m):
    rows = m.raw.read("lineitem")
    q92, q50 = quantiles.exact_quantiles(rows, "l_extendedprice", [0.92, 0.5])
    return rounded(rows.agg(F.lit(q92).alias("q92"), F.lit(q50).alias("q50"), F.count("*").alias("n")))


@query("e16_having_dup", "select review_id, count(*) occurrences from raw_order_reviews group by 1 having count(*) > 1")
def e16(m):
    return aggregates.repeated_keys(m.stg_order_reviews, "review_id")


# first rows, sorts, sets


FIRST_SQL = "select order_id, arg_min({0}, order_item_id) {0} from raw_order_items group by 1"


@query("f1_first_item_per_order", FIRST_SQL.format("product_id"))
def f1(m):
    return aggregates.first_in_group(m.stg_order_items, "order_id", "order_item_id", "product_id")


@query("f2_first_seller_per_order", FIRST_SQL.format("seller_id"))
def f2(m):
    return aggregates.first_in_group(m.stg_order_items, "order_id", "order_item_id", "seller_id")


LATE_BY_STATE_SQL = "select estado, round(100 * pct_late, 6) taxa_atraso_percentual, order_count volume_pedidos from mart_delivery_kpis"


@query("g1_sort_desc", LATE_BY_STATE_SQL + " order by pct_late desc nulls first, estado")
def g1(m):
    return rounded(cards.late_by_state(m.mart_delivery_kpis))


@query("g2_topk_15", CARD6_SQL.format(extra="", limit=15))
def g2(m):
    return card6(m)


ERRORS_SQL = """
select order_id id_pedido, estado estado_cliente, true_label status_real, predicted_label_hardcode predicao_numpy, predicted_label_sklearn predicao_sklearn,
       predicted_at data_previsao
from mart_ml_results where not sklearn_correct {extra} order by predicted_at desc, order_id limit 20"""


@query("g3_topk_20_recent", ERRORS_SQL.format(extra=""))
def g3(m):
    return cards.error_details(m.mart_ml_results)


SLOWEST_SQL = """
select estado, round(avg_delivery_days, 6) avg_delivery_days, round(avg_estimated_delivery_days, 6) avg_estimated_delivery_days, order_count
from mart_delivery_kpis order by avg_delivery_days desc nulls last, estado limit {0}"""


@query("g4_topk_slowest", SLOWEST_SQL.format(5))
def g4(m):
    return rounded(cards.slowest_states(m.mart_delivery_kpis, 5))


@query(
    "h1_union_all",
    """select 'customer' kind, estado, count(*) n from stg_customers group by all union all select 'seller', estado, count(*) from stg_sellers group by all""",
)
def h1(m):
    def count_by_state(rows, kind):
        return rows.groupBy("estado").agg(F.count("*").alias("n")).withColumn("kind", F.lit(kind))

    return count_by_state(m.stg_customers, "customer").unionByName(count_by_state(m.stg_sellers, "seller"))


@query("h2_distinct_rows", "select distinct customer_city, customer_state from raw_customers")
def h2(m):
    return m.raw["customers"].select("customer_city", "customer_state").distinct()


# scalar functions


@query("i1_upper_lower", "select doc_id, upper(text) = text same_upper, lower(text) = text same_lower, lower(source) low, upper(lang) up from documents")
def i1(m):
    body = F.col("text")
    return m.raw.read("documents").select(
        "doc_id",
        (F.upper(body) == body).alias("same_upper"),
        (F.lower(body) == body).alias("same_lower"),
        F.lower("source").alias("low"),
        F.upper("lang").alias("up"),
    )


@query(
    "i2_i3_trim_regexp_replace",
    r"select doc_id, length(trim(regexp_replace(text, '[\n\r]+', ' ', 'g'))) flat_length, md5(trim(regexp_replace(text, '[\n\r]+', ' ', 'g'))) flat_md5 from documents",
)
def i2(m):
    flat = F.trim(F.regexp_replace("text", "[\n\r]+", " "))
    return m.raw.read("documents").select("doc_id", F.length(flat).alias("flat_length"), F.md5(flat).alias("flat_md5"))


@query(
    "i4_i5_regexp_count_length",
    r"select doc_id, len(regexp_extract_all(text, '\s+')) spaces, len(regexp_extract_all(text, '!')) marks, length(text) characters from documents",
)
def i4(m):
    return m.raw.read("documents").select(
        "doc_id",
        F.regexp_count("text", F.lit(r"\s+")).alias("spaces"),
        F.regexp_count("text", F.lit("!")).alias("marks"),
        F.length("text").alias("characters"),
    )


@query("i6_i7_concat_ws_nullif", "select review_id, order_id, md5(nullif(trim(concat_ws('. ', titulo, mensagem)), '')) texto_md5 from flat_reviews")
def i6(m):
    joined = cleaning.join_text(F.col("titulo"), F.col("mensagem"))
    return m.stg_order_reviews.select("review_id", "order_id", F.md5(joined).alias("texto_md5"))


@query("i8_like", "select doc_id, lower(text) like '%the %' has_the, lower(text) like '%nota 10%' has_nota from documents")
def i8(m):
    low = F.lower("text")
    return m.raw.read("documents").select("doc_id", low.contains("the ").alias("has_the"), low.like("%nota 10%").alias("has_nota"))


@query(
    "i9_cast",
    "select l_orderkey, l_linenumber, l_partkey, cast(cast(l_extendedprice as decimal(10, 2)) as double) price, cast(l_quantity as varchar) quantity, cast(l_linenumber as double) line from lineitem",
)
def i9(m):
    return m.raw.read("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.col("l_extendedprice").cast("decimal(10,2)").alias("price"),
        F.col("l_quantity").cast("string").alias("quantity"),
        F.col("l_linenumber").cast("double").alias("line"),
    )


@query(
    "i10_i11_datediff",
    """select order_id, date_diff('day', order_purchase_timestamp, order_delivered_customer_date) as days, date_diff('hour', order_purchase_timestamp, order_approved_at) as hours
    from raw_orders""",
)
def i10(m):
    bought = F.col("order_purchase_timestamp")
    return m.stg_orders.select(
        "order_id",
        dates.days_between(bought, F.col("order_delivered_customer_date")).alias("days"),
        dates.hours_between(bought, F.col("order_approved_at")).alias("hours"),
    )


@query(
    "i12_i13_calendar_parts",
    "select order_id, dayofweek(order_purchase_timestamp) dow, year(order_purchase_timestamp) y, month(order_purchase_timestamp) mo, day(order_purchase_timestamp) d from raw_orders",
)
def i12(m):
    bought = F.col("order_purchase_timestamp")
    return m.stg_orders.select(
        "order_id", dates.weekday(bought).alias("dow"), F.year(bought).alias("y"), F.month(bought).alias("mo"), F.day(bought).alias("d")
    )


@query(
    "i14_haversine",
    f"select event_id, round({haversine('a', 'b')}, 6) km from (select event_id, -10 - value / 100 a_lat, -40 - value / 50 a_lng, -20 + value / 70 b_lat, -50 + value / 90 b_lng from events)",
)
def i14(m):
    v = F.col("value")
    km = geo.haversine_km(-10 - v / 100, -40 - v / 50, -20 + v / 70, -50 + v / 90)
    return m.raw.read("events").select("event_id", F.round(km, 6).alias("km"))


@query("i15_generate_surrogate_key", f"select order_id, payment_sequential, {key_of('order_id', 'payment_sequential')} payment_key from raw_order_payments")
def i15(m):
    return m.stg_order_payments.select(
        "order_id", "payment_sequential", keys.surrogate_key("order_id", "payment_sequential").alias("payment_key")
    )


SPINE_SQL = """
select cast(unnest(generate_series(min(cast(order_purchase_timestamp as date)), max(cast(order_purchase_timestamp as date)), interval 1 day)) as date) date_day from raw_orders"""


def order_calendar(m):
    """The days on which orders were placed, first to last."""
    day = F.col("order_purchase_timestamp").cast("date")
    return core.calendar(m.stg_orders.agg(F.min(day).alias("first_day"), F.date_add(F.max(day), 1).alias("end_day")))


@query("i16_date_spine", SPINE_SQL)
def i16(m):
    return order_calendar(m).select("date_day")


@query("i17_sigmoid", "select event_id, round(1 / (1 + exp(-greatest(-30.0, least(30.0, value / 10 - 5)))), 8) p from events")
def i17(m):
    return m.raw.read("events").select("event_id", F.round(scoring.sigmoid(F.col("value") / 10 - 5), 8).alias("p"))


@query("i18_standardise", "select event_id, round((value - (select avg(value) from events)) / (select stddev_pop(value) from events), 6) z from events")
def i18(m):
    rows = m.raw.read("events")
    stats = rows.agg(F.avg("value").alias("mean"), logistic.spread_or_one(F.col("value")).alias("spread")).first()
    return rows.select("event_id", F.round(scoring.standardise(F.col("value"), stats.mean, stats.spread), 6).alias("z"))
