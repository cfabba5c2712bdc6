"""Named models and text features (inventory 2.10 and 2.11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelwise.functions import text
from parcelwise.plans import marts
from parcelwise.session import scratch_dir
from workload.oracle_models import COMPLAINT, PRAISE, mentions
from workload.registry import ORACLES, QUERIES, comparable, models_over, query, rounded
from workload.relational import SPINE_SQL, order_calendar

MONEY = "* replace (cast({0} as double) as {0}, cast({1} as double) as {1})"


def _plain(key: str, name: str, columns: str = "*") -> None:
    query(f"{key}_{name}", f"select {columns} from {name}")(lambda m: m[name])


_plain("j1", "stg_customers")
_plain("j2", "stg_geolocation")
_plain("j3", "stg_orders")
_plain("j4", "stg_order_items", MONEY.format("preco", "frete"))
_plain("j5", "stg_order_payments")
_plain("j6", "stg_order_reviews")
_plain("j7", "stg_products")
_plain("j8", "stg_sellers")
_plain("j9", "stg_category_translation")
_plain("j10", "stg_ml_predictions")
_plain("j11", "dim_customers")
_plain("j12", "dim_sellers")
_plain("j13", "dim_products")
_plain("j16", "fact_orders")
_plain("j17", "fact_order_items", MONEY.format("preco", "frete"))
_plain("j18", "fact_payments")
_plain("j19", "fact_reviews")
_plain("j22", "mart_ml_results")
_plain("j23", "mart_reviews_enriched")


@query("j14_dim_geolocation", "select zip_code_prefix, round(latitude, 10) latitude, round(longitude, 10) longitude, cidade, estado from dim_geolocation")
def j14(m):
    return rounded(m.dim_geolocation, 10)


@query(
    "j15_dim_date",
    f"""select date_day, year(date_day) as year, month(date_day) as month, day(date_day) as day, dayofweek(date_day) day_of_week, dayofweek(date_day) in (0, 6) is_weekend,
    count(order_id) order_count from ({SPINE_SQL}) left join raw_orders on cast(order_purchase_timestamp as date) = date_day group by all""",
)
def j15(m):
    bought = F.col("order_purchase_timestamp").cast("date")
    daily = m.stg_orders.groupBy(bought.alias("date_day")).agg(F.count("*").alias("order_count"))
    return order_calendar(m).join(daily, "date_day", "left").fillna(0, subset=["order_count"])


@query(
    "j20_mart_delivery_kpis",
    """select estado, order_count, late_count, round(pct_late, 6) pct_late, round(avg_delivery_days, 6) avg_delivery_days,
    round(avg_estimated_delivery_days, 6) avg_estimated_delivery_days from mart_delivery_kpis""",
)
def j20(m):
    return rounded(m.mart_delivery_kpis)


@query(
    "j21_mart_sentiment_kpis",
    """select category_name_english, review_count, round(avg_review_score, 6) avg_review_score, round(pct_positivo, 6) pct_positivo,
    round(pct_neutro, 6) pct_neutro, round(pct_negativo, 6) pct_negativo from mart_sentiment_kpis""",
)
def j21(m):
    return rounded(m.mart_sentiment_kpis)


@query(
    "j24_mart_late_delivery_features",
    """select * replace (cast(total_price as double) as total_price, cast(total_freight as double) as total_freight, round(avg_product_weight_g, 6) as avg_product_weight_g,
    round(avg_product_volume_cm3, 6) as avg_product_volume_cm3, round(distance_km, 6) as distance_km) from mart_late_delivery_features""",
)
def j24(m):
    return rounded(m.mart_late_delivery_features)


def _feature(key: str, expression, oracle: str) -> None:
    name = key.split("_", 1)[1]

    def run(m):
        return m.stg_order_reviews.select("review_id", "order_id", expression().alias(name))

    query(key, f"select review_id, order_id, {oracle} {name} from stg_order_reviews")(run)


_feature("k1_char_count", lambda: text.char_count(F.col("texto_completo")), "ifnull(length(texto_completo), 0)")
_feature(
    "k2_word_count",
    lambda: text.word_count(F.col("texto_completo")),
    r"if(texto_completo is null, 0, len(regexp_extract_all(texto_completo, '\s+')) + 1)",
)
_feature("k3_all_caps", lambda: text.all_caps(F.col("texto_completo")), "ifnull(texto_completo = upper(texto_completo), false)")
_feature(
    "k4_has_exclamation", lambda: text.has_exclamation(F.col("texto_completo")), "ifnull(instr(texto_completo, '!') > 0, false)"
)


@query("k5_keyword_sentiment", "select review_id, order_id, sentimento_texto from review_features")
def k5(m):
    return m.mart_reviews_enriched.select("review_id", "order_id", "sentimento_texto")


@query(
    "k5_keyword_sentiment_negation_first",
    f"""select review_id, order_id, case when texto_completo is null then 'sem_comentario' when {mentions(COMPLAINT)} then 'negativo'
    when {mentions(PRAISE)} then 'positivo' else 'neutro' end sentimento_texto from stg_order_reviews""",
)
def k5_negation(m):
    rows = marts.mart_reviews_enriched(m.stg_order_reviews, negation_first=True)
    return rows.select("review_id", "order_id", "sentimento_texto")


@query("k6_coherence", "select review_id, order_id, coerencia_nota_texto from mart_reviews_enriched")
def k6(m):
    return m.mart_reviews_enriched.select("review_id", "order_id", "coerencia_nota_texto")


# the same marts over stored facts and their hashed keys
_STORED = {
    "j20_mart_delivery_kpis": ("fact_orders", "dim_customers"),
    "j21_mart_sentiment_kpis": ("fact_reviews", "fact_order_items", "dim_products"),
    "j24_mart_late_delivery_features": (
        "fact_orders",
        "fact_order_items",
        "fact_payments",
        "dim_customers",
        "dim_sellers",
        "dim_products",
        "dim_geolocation",
    ),
}


def _register_stored(name: str, tables: tuple[str, ...]) -> None:
    mart = name.partition("_")[2]
    QUERIES[f"{name}_stored"] = lambda spark, folder: comparable(
        rounded(models_over(spark, folder).store(scratch_dir(spark, "facts"), tables)[mart])
    )
    ORACLES[f"{name}_stored"] = ORACLES[name]


for _name, _tables in _STORED.items():
    _register_stored(_name, _tables)
