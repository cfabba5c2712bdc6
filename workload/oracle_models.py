"""Models as SQL text, added to the table definitions of :mod:`workload.oracle_tables`."""

from __future__ import annotations

from workload.oracle_tables import TABLES, key_of

# Keyword lists.
PRAISE = ("recomendo", "ótimo", "adorei", "excelente", "nota 10", "antes do prazo")
COMPLAINT = ("não chegou", "não recebi", "péssimo", "não gostei", "gato por lebre", "não recomendo")


def mentions(words: tuple[str, ...]) -> str:
    return "(" + " or ".join(f"contains(lower(texto_completo), '{word}')" for word in words) + ")"


def hours(start: str, end: str) -> str:
    return f"date_diff('hour', {start}, {end})"


def haversine(a: str, b: str) -> str:
    chord = (
        f"pow(sin(radians({b}_lat - {a}_lat) / 2), 2) + cos(radians({a}_lat)) * cos(radians({b}_lat))"
        f" * pow(sin(radians({b}_lng - {a}_lng) / 2), 2)"
    )
    # least() skips NULLs
    return f"if(({chord}) is null, null, 2 * 6371.0::double * asin(sqrt(least(1.0, {chord}))))"


def flat(column: str) -> str:
    return rf"nullif(trim(regexp_replace({column}, '[\n\r]+', ' ', 'g')), '')"


TABLES["stg_customers"] = """
select customer_id, customer_unique_id, customer_zip_code_prefix, upper(customer_city) cidade, upper(customer_state) estado from raw_customers"""
TABLES["stg_sellers"] = """
select seller_id, seller_zip_code_prefix zip_code_prefix, upper(seller_city) cidade, upper(seller_state) estado from raw_sellers"""
TABLES["stg_geolocation"] = """
select geolocation_zip_code_prefix zip_code_prefix, geolocation_lat latitude, geolocation_lng longitude,
       upper(geolocation_city) cidade, upper(geolocation_state) estado from raw_geolocation"""
TABLES["stg_orders"] = "select * from raw_orders"
TABLES["stg_order_items"] = """
select * exclude (price, freight_value), cast(price as decimal(10, 2)) preco, cast(freight_value as decimal(10, 2)) frete from raw_order_items"""
TABLES["stg_order_payments"] = "select * from raw_order_payments"
TABLES["flat_reviews"] = f"""
select *, {flat('review_comment_title')} titulo, {flat('review_comment_message')} mensagem from raw_order_reviews"""
TABLES["stg_order_reviews"] = """
select review_id, order_id, review_score, review_creation_date, review_answer_timestamp,
       if(review_score >= 4, 'positivo', if(review_score <= 2, 'negativo', 'neutro')) sentiment_label, titulo, mensagem,
       nullif(trim(concat_ws('. ', titulo, mensagem)), '') texto_completo,
       titulo is not null tem_titulo, mensagem is not null tem_mensagem, coalesce(titulo, mensagem) is not null tem_comentario
from flat_reviews"""
TABLES["stg_products"] = """
select * replace (cast(round(product_weight_g) as integer) as product_weight_g) from raw_products"""
TABLES["stg_category_translation"] = "select * from raw_category_translation"
TABLES["stg_ml_predictions"] = "select * from raw_ml_predictions"
TABLES["dim_customers"] = f"""
select {key_of('customer_id')} customer_key, customer_id, customer_unique_id, customer_zip_code_prefix zip_code_prefix, cidade, estado from stg_customers"""
TABLES["dim_sellers"] = f"select {key_of('seller_id')} seller_key, * from stg_sellers"
TABLES["dim_products"] = f"""
select {key_of('product_id')} product_key, product_id, product_category_name category_name,
       ifnull(product_category_name_english, product_category_name) category_name_english, product_name_lenght, product_description_lenght,
       product_photos_qty, product_weight_g, product_length_cm, product_height_cm, product_width_cm,
       product_length_cm * product_height_cm * product_width_cm product_volume_cm3
from stg_products left join stg_category_translation using (product_category_name)"""
TABLES["geo_city"] = """
select zip_code_prefix, arg_min(cidade, (-n, cidade)) cidade from (select zip_code_prefix, cidade, count(*) n from stg_geolocation group by all) group by all"""
TABLES["geo_state"] = """
select zip_code_prefix, arg_min(estado, (-n, estado)) estado from (select zip_code_prefix, estado, count(*) n from stg_geolocation group by all) group by all"""
TABLES["geo_centre"] = "select zip_code_prefix, avg(latitude) latitude, avg(longitude) longitude from stg_geolocation group by all"
TABLES["dim_geolocation"] = "select * from geo_centre join geo_city using (zip_code_prefix) join geo_state using (zip_code_prefix)"
TABLES["order_measures"] = f"""
select *, order_delivered_customer_date > order_estimated_delivery_date is_late,
       date_diff('day', order_purchase_timestamp, order_delivered_customer_date) delivery_days,
       date_diff('day', order_purchase_timestamp, order_estimated_delivery_date) estimated_delivery_days,
       {hours('order_purchase_timestamp', 'order_approved_at')} approval_delay_hours
from stg_orders"""
TABLES["fact_orders"] = f"""
select {key_of('m.order_id')} order_key, m.order_id, customer_key, order_status, order_purchase_timestamp, order_approved_at, order_delivered_carrier_date,
       order_delivered_customer_date, order_estimated_delivery_date, is_late, delivery_days, estimated_delivery_days, approval_delay_hours
from order_measures m left join dim_customers c on c.customer_id = m.customer_id"""
TABLES["fact_order_items"] = f"""
select {key_of('order_id', 'order_item_id')} order_item_key, order_id, order_item_id, product_key, seller_key, shipping_limit_date, preco, frete
from stg_order_items left join dim_products using (product_id) left join dim_sellers using (seller_id)"""
TABLES["fact_payments"] = f"select {key_of('order_id', 'payment_sequential')} payment_key, * from stg_order_payments"
TABLES["fact_reviews"] = f"""
select {key_of('review_id', 'r.order_id')} review_key, review_id, r.order_id, order_key, review_score, titulo, mensagem, sentiment_label,
       review_creation_date, review_answer_timestamp
from stg_order_reviews r left join fact_orders o on o.order_id = r.order_id"""
TABLES["order_lines"] = """
select order_id, count(*) item_count, sum(preco) total_price, sum(frete) total_freight, avg(product_weight_g) avg_product_weight_g,
       avg(product_volume_cm3) avg_product_volume_cm3, min_by(coalesce(product_key, '-'), order_item_id) product_key,
       min_by(coalesce(seller_key, '-'), order_item_id) seller_key
from fact_order_items i left join dim_products p using (product_key) group by order_id"""
TABLES["placed"] = """
select party, key, state, latitude, longitude from (
  select 'customer' party, customer_key key, estado state, zip_code_prefix from dim_customers
  union all select 'seller', seller_key, estado, zip_code_prefix from dim_sellers) left join dim_geolocation using (zip_code_prefix)"""
TABLES["delivered_orders"] = """
select * from fact_orders where order_status = 'delivered' and order_delivered_customer_date is not null and order_estimated_delivery_date is not null"""
TABLES["mart_delivery_kpis"] = """
select estado, count(*) order_count, count(*) filter (where is_late) late_count, count(*) filter (where is_late) / cast(count(*) as double) pct_late,
       avg(delivery_days) avg_delivery_days, avg(estimated_delivery_days) avg_estimated_delivery_days
from delivered_orders left join dim_customers using (customer_key) group by estado"""
TABLES["categorised_reviews"] = """
select r.*, category_name_english from fact_reviews r left join order_lines l on l.order_id = r.order_id left join dim_products d on d.product_key = l.product_key"""
TABLES["mart_sentiment_kpis"] = """
select category_name_english, count(review_key) review_count, avg(review_score) avg_review_score,
       avg(cast(sentiment_label = 'positivo' as integer)) pct_positivo, avg(cast(sentiment_label = 'neutro' as integer)) pct_neutro,
       avg(cast(sentiment_label = 'negativo' as integer)) pct_negativo
from categorised_reviews group by category_name_english"""
TABLES["mart_ml_results"] = """
select p.*, true_label = predicted_label_hardcode hardcode_correct, true_label = predicted_label_sklearn sklearn_correct, estado
from stg_ml_predictions p left join fact_orders o on o.order_id = p.order_id left join dim_customers c on c.customer_key = o.customer_key"""
TABLES["review_features"] = rf"""
select review_id, order_id, review_score, sentiment_label, titulo, mensagem, texto_completo, tem_comentario,
       ifnull(length(texto_completo), 0) num_caracteres, if(texto_completo is null, 0, len(regexp_extract_all(texto_completo, '\s+')) + 1) num_palavras,
       ifnull(texto_completo = upper(texto_completo), false) texto_em_caixa_alta, ifnull(instr(texto_completo, '!') > 0, false) tem_exclamacao,
       case when texto_completo is null then 'sem_comentario' when {mentions(PRAISE)} then 'positivo'
            when {mentions(COMPLAINT)} then 'negativo' else 'neutro' end sentimento_texto
from stg_order_reviews"""
TABLES["mart_reviews_enriched"] = """
select *, if(sentimento_texto = 'sem_comentario', 'sem_texto',
             if(sentimento_texto <> sentiment_label and 'neutro' not in (sentimento_texto, sentiment_label), 'divergente', 'coerente')) coerencia_nota_texto
from review_features"""
TABLES["mart_late_delivery_features"] = f"""
select o.order_id, is_late, total_price, total_freight, item_count, avg_product_weight_g, avg_product_volume_cm3,
       (select max(payment_installments) from fact_payments f where f.order_id = o.order_id) payment_installments_max,
       (select sum(payment_value) from fact_payments f where f.order_id = o.order_id) payment_value_total,
       approval_delay_hours, estimated_delivery_days, dayofweek(order_purchase_timestamp) purchase_dow, month(order_purchase_timestamp) purchase_month,
       {haversine('c', 's')} distance_km, if(customer_state = seller_state, 1, 0) same_state_flag, customer_state, seller_state
from delivered_orders o join order_lines l on l.order_id = o.order_id
     left join (select key, state customer_state, latitude c_lat, longitude c_lng from placed where party = 'customer') c on c.key = customer_key
     left join (select key, state seller_state, latitude s_lat, longitude s_lng from placed where party = 'seller') s on s.key = seller_key"""
# Model inputs.
FEATURES = (
    "total_price",
    "total_freight",
    "item_count",
    "avg_product_weight_g",
    "avg_product_volume_cm3",
    "payment_installments_max",
    "payment_value_total",
    "approval_delay_hours",
    "estimated_delivery_days",
    "purchase_dow",
    "purchase_month",
    "distance_km",
    "same_state_flag",
)
TABLES["prepared"] = f"""
select order_id, is_late, {', '.join(f'cast({name} as double) {name}' for name in FEATURES)}, if(is_late, 'late', 'on_time') label
from mart_late_delivery_features where is_late is not null and {' and '.join(f'{name} is not null' for name in FEATURES)}"""
TABLES["class_sizes"] = """
select label, base + if(row_number() over (order by rest desc, label) <= wanted - sum(base) over (), 1, 0) take from (
  select label, wanted, cast(floor(n * wanted / total) as bigint) base, round(n * wanted / total - floor(n * wanted / total), 9) rest from (
    select label, count(*) n, sum(count(*)) over () total, ceil(sum(count(*)) over () * 0.2) wanted from prepared group by label))"""
TABLES["labelled"] = """
select p.*, if(row_number() over (partition by label order by md5(concat('42|', order_id)), order_id) <= take, 'test', 'train') split
from prepared p join class_sizes using (label)"""
TABLES["train_rows"] = "select * from labelled where split = 'train'"
TABLES["test_rows"] = "select * from labelled where split = 'test'"
