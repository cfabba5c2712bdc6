"""Loads, landings and cleaning (inventory 2.1 and 2.2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelwise.functions import cleaning, keys, scoring, text
from parcelwise.plans import late_delivery, staging
from parcelwise.plans.build import build, refresh_predictions
from parcelwise.plans.core import dim_products
from parcelwise.schemas import FEATURE_TABLE, FEATURES, PREDICTIONS, RAW_TABLES
from parcelwise.session import scratch_dir
from parcelwise.sources import files, layers
from parcelwise.sources.benchmark_tables import draw as hash_draw
from workload.oracle_models import FEATURES as FEATURE_NAMES
from workload.oracle_tables import draw, key_of
from workload.registry import query, rounded, split_rows

EDGE = r"[\s\p{Z}\x{0b}\x{1c}-\x{1f}\x{85}]+"


def stripped(column: str) -> str:
    return f"regexp_replace({column}, '^{EDGE}|{EDGE}$', '', 'g')"


def read_back(m, table: str):
    """A source table sent through CSV and the typed reader."""
    path = layers.write_csv(m.raw[table], scratch_dir(m.spark, f"csv-{table}"))
    return files.read_typed_csv(m.spark, path, table)


def _register_csv_scan(table: str) -> None:
    columns = [
        f"nullif({stripped(name)}, '') {name}" if name in RAW_TABLES[table].of_type(RAW_TABLES["orders"].columns["order_id"]) else name
        for name in RAW_TABLES[table].columns
    ]
    query(f"a1_csv_scan_typed_{table}", f"select distinct {', '.join(columns)} from raw_{table}")(lambda m: read_back(m, table))


for _table in RAW_TABLES:
    _register_csv_scan(_table)


@query(
    "a2_null_tokens",
    f"""select c_custkey, case when {draw('null', 'c_custkey', 6)} < 4 then null else c_name end token from customer""",
)
def a2(m):
    kind = F.get(F.array(*map(F.lit, cleaning.LOAD_NULL_WORDS)), F.col("kind").cast("int"))
    rows = m.raw.read("customer").select("c_custkey", "c_name", F.expr(hash_draw("null", "c_custkey", 6)).alias("kind"))
    marked = rows.select("c_custkey", F.when(F.col("kind") < 4, kind).otherwise(F.col("c_name")).alias("token"))
    return files.load_nulls(marked)


@query("a3_silver_write", "select * from raw_orders")
def a3(m):
    return m.spark.read.parquet(layers.write_snapshot(m.raw["orders"], scratch_dir(m.spark, "silver"), "orders"))


@query("a4_bronze_land", "select *, '2026-01-02' dt from raw_customers")
def a4(m):
    folder = scratch_dir(m.spark, "bronze")
    for day in ("2026-01-01", "2026-01-02", "2026-01-02"):
        path = layers.land(m.raw["customers"], folder, "customers", day)
    landed = m.spark.read.parquet(path).withColumn("dt", F.col("dt").cast("string"))
    return landed.filter("dt = '2026-01-02'")


@query("a5_snapshot_reload", "select count(*) row_count, count(distinct order_id) order_count from raw_orders")
def a5(m):
    folder = scratch_dir(m.spark, "reload")
    for _ in range(2):
        path = layers.write_snapshot(m.raw["orders"], folder, "orders")
    return m.spark.read.parquet(path).agg(
        F.count("*").alias("row_count"), F.count_distinct("order_id").alias("order_count")
    )


@query("a6_file_pattern", "select * from raw_sellers")
def a6(m):
    folder = scratch_dir(m.spark, "pattern")
    for table in ("sellers", "customers"):  # side by side, each in its own folder
        layers.write_csv(m.raw[table], f"{folder}/{table}")
    return files.read_text_csv(m.spark, files.table_paths(m.spark, folder)["sellers"], RAW_TABLES["sellers"])


@query("a7_positional_map", "select * from raw_sellers")
def a7(m):
    spec = RAW_TABLES["sellers"]
    anonymous = m.raw["sellers"].toDF(*[f"_c{i}" for i in range(len(spec.columns))])
    return files.by_position(anonymous, spec)


@query("a8_abort_on_error", "select count(*) row_count from raw_order_payments")
def a8(m):
    path = layers.write_csv(m.raw["order_payments"], scratch_dir(m.spark, "strict"))
    rows = files.read_text_csv(m.spark, path, RAW_TABLES["order_payments"])
    return rows.dropDuplicates().agg(F.count("*").alias("row_count"))


# The given payments hold no torn row, so those by voucher are written with a value too many.
@query(
    "a8_bad_rows",
    "select order_id as key, count(*) bad_rows from raw_order_payments where payment_type = 'voucher' group by 1",
)
def a8_bad(m):
    rows, spec = m.raw["order_payments"], RAW_TABLES["order_payments"]
    torn = F.col("payment_type") == "voucher"
    good = layers.write_csv(rows.filter(~torn), scratch_dir(m.spark, "payments"))
    spoilt = layers.write_csv(rows.filter(torn).withColumn("stray", F.lit("x")), scratch_dir(m.spark, "payments"))
    return files.bad_rows(m.spark, [good, spoilt], spec).groupBy("key").agg(F.count("*").alias("bad_rows"))


@query("a9_input_audit", "select 'order_reviews' table_name")
def a9(m):
    folder = scratch_dir(m.spark, "landing")
    for table in RAW_TABLES:
        if table != "order_reviews":
            layers.write_csv(m.raw[table], f"{folder}/{table}")
    return files.missing_tables(m.spark, folder)


@query(
    "a10_row_audit",
    " union all ".join(f"select '{t}' table_name, count(*) row_count from raw_{t}" for t in RAW_TABLES)
    + " union all select 'total', sum(n) from ("
    + " union all ".join(f"select count(*) n from raw_{t}" for t in RAW_TABLES)
    + ")",
)
def a10(m):
    return files.row_audit({table: m.raw[table] for table in RAW_TABLES})


_FEATURE_SQL = ", ".join(f"round(cast({name} as double), 6) {name}" for name in FEATURE_NAMES)


def feature_doubles(rows):
    return rows.select("order_id", "is_late", *[F.round(F.col(name).cast("double"), 6).alias(name) for name in FEATURES])


@query("a11_feature_scan", f"select order_id, is_late, {_FEATURE_SQL} from mart_late_delivery_features")
def a11(m):
    upper = m.mart_late_delivery_features.toDF(*[name.upper() for name in m.mart_late_delivery_features.columns])
    return feature_doubles(late_delivery.feature_scan(upper))


@query("a12_feature_csv_scan", f"select order_id, is_late, {_FEATURE_SQL} from mart_late_delivery_features")
def a12(m):
    mart = late_delivery.feature_scan(m.mart_late_delivery_features)
    typed = mart.select(*[F.col(name).cast(kind) for name, kind in FEATURE_TABLE.columns.items()])
    # wider, in another order and case: names decide
    wider = typed.select(F.lit("x").alias("extra"), *[F.col(name).alias(name.upper()) for name in reversed(typed.columns)])
    return feature_doubles(files.read_features_csv(m.spark, layers.write_csv(wider, scratch_dir(m.spark, "features"))))


@query("a13_predictions_write", "select order_id, true_label, predicted_label_hardcode, predicted_label_sklearn, model_version, predicted_at from raw_ml_predictions")
def a13(m):
    folder = scratch_dir(m.spark, "predictions")
    layers.write_predictions(m.raw["ml_predictions"], folder)
    return layers.read_predictions(m.spark, folder)


@query("a13_predictions_csv", "select order_id, true_label, predicted_label_hardcode, predicted_label_sklearn, model_version, predicted_at from raw_ml_predictions")
def a13_csv(m):
    rows = m.raw["ml_predictions"].select(*PREDICTIONS.columns)
    return files.read_predictions_csv(m.spark, layers.write_csv(rows, scratch_dir(m.spark, "predictions-csv")))


_METRIC_SQL = """
select model, avg(cast(t = p as integer)) accuracy,
       (ifnull(count(*) filter (where t = 'late' and p = 'late') / nullif(cast(count(*) filter (where p = 'late') as double), 0), 0)
        + ifnull(count(*) filter (where t <> 'late' and p <> 'late') / nullif(cast(count(*) filter (where p <> 'late') as double), 0), 0)) / 2 precision_macro,
       (ifnull(count(*) filter (where t = 'late' and p = 'late') / nullif(cast(count(*) filter (where t = 'late') as double), 0), 0)
        + ifnull(count(*) filter (where t <> 'late' and p <> 'late') / nullif(cast(count(*) filter (where t <> 'late') as double), 0), 0)) / 2 recall_macro,
       (2.0 * count(*) filter (where t = 'late' and p = 'late') / nullif(cast(count(*) filter (where p = 'late') + count(*) filter (where t = 'late') as double), 0)
        + 2.0 * count(*) filter (where t <> 'late' and p <> 'late') / nullif(cast(count(*) filter (where p <> 'late') + count(*) filter (where t <> 'late') as double), 0)) / 2 f1_macro
from ({stacked}) group by model"""
STACKED_SQL = """
  select 'baseline_majority' model, true_label t, (select label from train_rows group by label order by count(*) desc, label limit 1) p from raw_ml_predictions
  union all select 'logreg_hardcode', true_label, predicted_label_hardcode from raw_ml_predictions
  union all select 'logreg_sklearn', true_label, predicted_label_sklearn from raw_ml_predictions"""
METRICS_SQL = _METRIC_SQL.format(stacked=STACKED_SQL)
ROUNDED_METRICS_SQL = f"select model, {', '.join(f'round({n}, 6) {n}' for n in ('accuracy', 'precision_macro', 'recall_macro', 'f1_macro'))} from ({METRICS_SQL})"


def metrics_of(m):
    train = split_rows(m).filter("split = 'train'")
    return late_delivery.compare(m.raw["ml_predictions"], late_delivery.majority_label(train, "label"))


@query("a14_metrics_write", ROUNDED_METRICS_SQL)
def a14(m):
    path = layers.write_metrics(metrics_of(m), scratch_dir(m.spark, "metrics"))
    names = ("accuracy", "precision_macro", "recall_macro", "f1_macro")
    schema = "model string, metrics struct<" + ",".join(f"{name}:double" for name in names) + ">"
    return rounded(m.spark.read.schema(schema).json(path).select("model", "metrics.*"))


_BUILT = (
    "stg_orders",
    "stg_order_reviews",
    "mart_reviews_enriched",
    "dim_customers",
    "dim_geolocation",
    "fact_orders",
    "fact_order_items",
    "fact_reviews",
    "mart_delivery_kpis",
    "mart_sentiment_kpis",
    "mart_late_delivery_features",
    "mart_ml_results",
)


@query("a15_materialise", " union all ".join(f"select '{name}' table_name, count(*) row_count from {name}" for name in _BUILT))
def a15(m):
    build(m, scratch_dir(m.spark, "build"))
    return files.row_audit({name: m[name] for name in _BUILT}).filter("table_name <> 'total'")


@query("a16_prediction_refresh", "select * from mart_ml_results")
def a16(m):
    folder = scratch_dir(m.spark, "refresh")
    m.store(folder, ("dim_customers", "fact_orders"))
    layers.write_predictions(m.raw["ml_predictions"], folder)
    return refresh_predictions(m, folder, folder)


@query("b1_strip_strings", "select c_custkey, c_name from customer")
def b1(m):
    padded = F.concat(F.lit("  \t　"), F.col("c_name"), F.lit(" \n \u0085"))
    return m.raw.read("customer").select("c_custkey", cleaning.strip_text(padded).alias("c_name"))


@query(
    "b2_coerce_dates",
    "select event_id, if(event_type = 'error', null, date_trunc('second', ts)) ts from events",
)
def b2(m):
    written = F.when(F.col("event_type") == "error", "31 of never").otherwise(F.substring(F.col("ts").cast("string"), 1, 19))
    return m.raw.read("events").select("event_id", cleaning.to_stamp(written).alias("ts"))


@query("b3_coerce_float", "select event_id, if(event_type = 'click', null, value) value from events")
def b3(m):
    written = F.when(F.col("event_type") == "click", F.concat(F.col("value").cast("string"), F.lit("d"))).otherwise(
        F.concat(F.lit(" "), F.col("value").cast("string"), F.lit(" "))
    )
    return m.raw.read("events").select("event_id", cleaning.to_real(written).alias("value"))


@query("b4_coerce_int", "select l_orderkey, l_linenumber, cast(round_even(l_quantity / 2, 0) as bigint) half from lineitem")
def b4(m):
    half = (F.col("l_quantity") / 2).cast("string")
    return m.raw.read("lineitem").select("l_orderkey", "l_linenumber", cleaning.to_whole(half).alias("half"))


@query("b5_dedup_rows", "select distinct * from raw_geolocation_landed")
def b5(m):
    return m.raw.raw_geolocation().dropDuplicates()


@query("b6_rename", "select zip_code_prefix, latitude, longitude from stg_geolocation")
def b6(m):
    return m.stg_geolocation.select("zip_code_prefix", "latitude", "longitude")


@query("b7_upper_std", "select customer_id, upper(customer_city) cidade, upper(customer_state) estado from raw_customers")
def b7(m):
    return m.stg_customers.select("customer_id", "cidade", "estado")


@query(
    "b8_cast_money",
    "select order_id, order_item_id, cast(cast(price as decimal(10, 2)) as double) preco, cast(cast(freight_value as decimal(10, 2)) as double) frete from raw_order_items",
)
def b8(m):
    return m.stg_order_items.select("order_id", "order_item_id", "preco", "frete")


@query("b9_cast_ts", "select order_id, order_purchase_timestamp, order_delivered_customer_date from raw_orders")
def b9(m):
    stamps = ("order_purchase_timestamp", "order_delivered_customer_date")
    as_text = m.raw["orders"].withColumns({name: F.col(name).cast("string") for name in stamps})
    return staging.orders(as_text).select("order_id", *stamps)


@query("b10_cast_int_round", "select product_id, cast(round(product_weight_g) as bigint) product_weight_g from raw_products")
def b10(m):
    return m.stg_products.select("product_id", "product_weight_g")


@query("b11_null_if_blank", "select review_id, order_id, titulo, mensagem from flat_reviews")
def b11(m):
    return m.stg_order_reviews.select("review_id", "order_id", "titulo", "mensagem")


@query("b12_concat_text", "select review_id, order_id, texto_completo from stg_order_reviews")
def b12(m):
    return m.stg_order_reviews.select("review_id", "order_id", "texto_completo")


@query(
    "b12_concat_text_strict",
    "select review_id, order_id, if(titulo is null or mensagem is null, null, trim(concat(titulo, '. ', mensagem))) texto_completo from flat_reviews",
)
def b12_strict(m):
    return staging.order_reviews(m.raw["order_reviews"], strict_text=True).select("review_id", "order_id", "texto_completo")


@query("b13_presence_flags", "select review_id, order_id, tem_titulo, tem_mensagem, tem_comentario from stg_order_reviews")
def b13(m):
    return m.stg_order_reviews.select("review_id", "order_id", "tem_titulo", "tem_mensagem", "tem_comentario")


@query("b14_score_label", "select review_id, order_id, review_score, sentiment_label from stg_order_reviews")
def b14(m):
    return m.raw["order_reviews"].select(
        "review_id", "order_id", "review_score", text.score_sentiment(F.col("review_score")).alias("sentiment_label")
    )


@query("b15_coalesce_fallback", "select product_id, category_name, category_name_english from dim_products")
def b15(m):
    return dim_products(m.stg_products, m.stg_category_translation).select("product_id", "category_name", "category_name_english")


@query("b16_arithmetic", "select product_id, product_volume_cm3 from dim_products")
def b16(m):
    return m.dim_products.select("product_id", "product_volume_cm3")


@query("b17_surrogate_key_1", f"select order_id, {key_of('customer_id')} key from raw_orders")
def b17(m):
    return m.raw["orders"].select("order_id", keys.surrogate_key("customer_id").alias("key"))


@query("b18_surrogate_key_n", f"select order_id, {key_of('order_id', 'order_approved_at is null', 'customer_id')} key from raw_orders")
def b18(m):
    return m.raw["orders"].select(
        "order_id", keys.surrogate_key("order_id", F.col("order_approved_at").isNull(), "customer_id").alias("key")
    )


@query("b19_star_plus", "select *, num_caracteres = 0 sem_texto from review_features")
def b19(m):
    rows = m.mart_reviews_enriched.drop("coerencia_nota_texto")
    return rows.withColumn("sem_texto", F.col("num_caracteres") == 0)


@query("b20_bool_compare", "select order_id, hardcode_correct, sklearn_correct from mart_ml_results")
def b20(m):
    return m.mart_ml_results.select("order_id", "hardcode_correct", "sklearn_correct")


@query(
    "b21_int_flag",
    "select order_id, if(order_approved_at is not null and cast(order_approved_at as date) = cast(order_purchase_timestamp as date), 1, 0) same_day from raw_orders",
)
def b21(m):
    approved, bought = F.col("order_approved_at").cast("date"), F.col("order_purchase_timestamp").cast("date")
    return m.raw["orders"].select("order_id", cleaning.equality_flag(approved, bought).alias("same_day"))


@query(
    "b22_guarded_ratio",
    "select o_custkey, round(sum(o_totalprice) filter (where o_orderstatus = 'F') / nullif(cast(count(*) filter (where o_orderstatus = 'F') as double), 0), 4) ratio from orders group by 1",
)
def b22(m):
    finished = F.col("o_orderstatus") == "F"
    total = F.sum(F.when(finished, F.col("o_totalprice")))
    ratio = cleaning.guarded_ratio(total, F.count_if(finished))
    return m.raw.read("orders").groupBy("o_custkey").agg(F.round(ratio, 4).alias("ratio"))


@query("b23_label_map", "select order_id, case is_late when true then 'late' when false then 'on_time' end label from order_measures")
def b23(m):
    return m.order_measures.select("order_id", scoring.label_name(F.col("is_late")).alias("label"))


@query("b24_text_length", "select review_id, order_id, length(trim(review_comment_message)) tamanho_comentario from raw_order_reviews")
def b24(m):
    return m.raw["order_reviews"].select(
        "review_id", "order_id", F.length(F.trim("review_comment_message")).alias("tamanho_comentario")
    )
