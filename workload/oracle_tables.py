"""Source tables and models as SQL text for an independent engine; the Spark side never reads this module."""

from __future__ import annotations

import re

from parcelwise.sources.benchmark_tables import PRIME, mixing_constants


def mix(tag: str, key: str) -> str:
    a, b = mixing_constants(tag)
    return f"((cast({key} as bigint) % {PRIME} * {a} + {b}) % {PRIME})"


def draw(tag: str, key: str, size: int | str) -> str:
    return f"({mix(tag, key)} % {size})"


def later(stamp: str, seconds: str) -> str:
    return f"({stamp} + to_seconds({seconds}))"


def midnight(stamp: str) -> str:
    return f"cast(cast({stamp} as date) as timestamp)"


def key_of(*parts: str) -> str:
    texts = [f"coalesce(cast({part} as varchar), '_dbt_utils_surrogate_key_null_')" for part in parts]
    return f"md5(concat_ws('-', {', '.join(texts)}))" if len(texts) > 1 else f"md5({texts[0]})"


_BOUGHT = later("o_orderdate", draw("ph", "o_orderkey", 86400))
_PAID = "o_orderkey * 10 + s"

TABLES: dict[str, str] = {}

TABLES["raw_places"] = "select n_nationkey, n_name, r_name from nation join region on r_regionkey = n_regionkey"
TABLES["raw_customers"] = f"""
select cast(c_custkey as varchar) customer_id, cast({draw('uniq', 'c_custkey', 1000000)} as varchar) customer_unique_id,
       lpad(cast({draw('czip', 'c_custkey', 1050)} as varchar), 5, '0') customer_zip_code_prefix,
       lower(r_name) customer_city, lower(n_name) customer_state
from customer join raw_places on n_nationkey = c_nationkey"""
TABLES["raw_sellers"] = f"""
select cast(s_suppkey as varchar) seller_id, lpad(cast({draw('szip', 's_suppkey', 1050)} as varchar), 5, '0') seller_zip_code_prefix,
       lower(r_name) seller_city, lower(n_name) seller_state
from supplier join raw_places on n_nationkey = s_nationkey"""
TABLES["raw_geolocation_landed"] = f"""
select lpad(cast(p as varchar), 5, '0') geolocation_zip_code_prefix,
       -5.0::double - cast(p % 25 as double) - cast({draw('lat', 'event_id', 5)} as double) / 100 geolocation_lat,
       -35.0::double - cast(p % 20 as double) - cast({draw('lng', 'event_id', 5)} as double) / 100 geolocation_lng,
       concat('city ', cast({draw('city', 'event_id', 3)} as varchar)) geolocation_city,
       concat('nation_', cast(p % 25 as varchar)) geolocation_state
from (select event_id, {draw('ezip', 'event_id', 1000)} p from events)"""
TABLES["raw_geolocation"] = "select distinct * from raw_geolocation_landed"
# Order statuses.
_OTHER_STATUSES = ("shipped", "canceled", "unavailable", "invoiced", "processing", "created", "approved")
_WHEEL = "[" + ", ".join(["'delivered'"] * 43 + [f"'{status}'" for status in _OTHER_STATUSES]) + "]"
TABLES["raw_timed"] = f"select *, {_BOUGHT} bought, {_WHEEL}[1 + {draw('st', 'o_orderkey', 50)}] order_status from orders"
TABLES["raw_orders"] = f"""
select cast(o_orderkey as varchar) order_id,
       if({draw('guest', 'o_orderkey', 100)} = 0, concat('guest-', cast(o_orderkey as varchar)), cast(o_custkey as varchar)) customer_id,
       order_status, bought order_purchase_timestamp,
       if({draw('noap', 'o_orderkey', 100)} > 0, {later('bought', draw('ap', 'o_orderkey', 172800))}, null) order_approved_at,
       if(order_status in ('delivered', 'shipped'), {later('bought', '86400 + ' + draw('ca', 'o_orderkey', 259200))}, null) order_delivered_carrier_date,
       if(order_status = 'delivered' and {draw('nodl', 'o_orderkey', 200)} > 0,
          {later('bought', '86400 * (1 + ' + draw('dl', 'o_orderkey', 30) + ') + ' + draw('dls', 'o_orderkey', 40000))}, null) order_delivered_customer_date,
       {midnight(later('bought', '86400 * (20 + ' + draw('es', 'o_orderkey', 25) + ')'))} order_estimated_delivery_date
from raw_timed"""
TABLES["raw_order_items"] = f"""
select cast(l_orderkey as varchar) order_id,
       (cast(l_linenumber as bigint) * 16777216 + {mix('goods', 'l_partkey * 1000003 + l_suppkey')} % 16777216) * 16777216
         + {mix('terms', "cast(floor(l_extendedprice * 100 + 0.5) as bigint) * 100003 + date_diff('day', date '1970-01-01', cast(l_shipdate as date))")} % 16777216 order_item_id,
       cast(l_partkey as varchar) product_id, if({draw('noseller', 'l_partkey', 50)} = 0, 'unknown', cast(l_suppkey as varchar)) seller_id,
       l_shipdate shipping_limit_date, l_extendedprice price, l_quantity * 1.25::double freight_value
from lineitem"""
TABLES["raw_order_payments"] = f"""
select cast(o_orderkey as varchar) order_id, s payment_sequential,
       case {draw('pty', _PAID, 4)} when 0 then 'boleto' when 1 then 'voucher' when 2 then 'debit_card' else 'credit_card' end payment_type,
       1 + {draw('ins', _PAID, 12)} payment_installments, cast(floor(o_totalprice / parts) as double) payment_value
from (select o_orderkey, o_totalprice, 1 + {draw('np', 'o_orderkey', 2)} parts, unnest(generate_series(1, 1 + {draw('np', 'o_orderkey', 2)})) s from orders)"""
TABLES["raw_products"] = f"""
select cast(p_partkey as varchar) product_id, if({draw('nocat', 'p_partkey', 50)} > 0, lower(p_type), null) product_category_name,
       cast(length(p_name) as double) product_name_lenght, cast({draw('desc', 'p_partkey', 2000)} as double) product_description_lenght,
       cast({draw('pho', 'p_partkey', 6)} as double) product_photos_qty,
       if({draw('now', 'p_partkey', 100)} > 0, cast(p_size * 100 + 0.25 as double), null) product_weight_g,
       cast(10 + {draw('len', 'p_partkey', 60)} as double) product_length_cm, cast(5 + {draw('hei', 'p_partkey', 40)} as double) product_height_cm,
       cast(8 + {draw('wid', 'p_partkey', 50)} as double) product_width_cm
from part"""
TABLES["raw_category_translation"] = """
select distinct lower(p_type) product_category_name, concat(lower(p_type), '_en') product_category_name_english from part where p_type <> 'PROMO'"""
TABLES["raw_order_reviews"] = f"""
select md5(cast(if({draw('rdup', 'doc_id', 25)} = 0, doc_id - 1, doc_id) as varchar)) review_id,
       cast({draw('ord', 'doc_id', "(select cast(floor(count(*) * 1.02) as bigint) from orders)")} as varchar) order_id,
       case when toxic = 1 then 1 when {draw('sc', 'doc_id', 10)} < 6 then 5 else 1 + {draw('sc2', 'doc_id', 5)} end review_score,
       if({draw('tt', 'doc_id', 100)} < 12, concat_ws(chr(10), ' ', source, lang), null) review_comment_title,
       if({draw('mm', 'doc_id', 100)} < 85, concat(case {draw('kw', 'doc_id', 9)} when 0 then 'Recomendo ' when 1 then 'Não recomendo ' when 2 then 'Péssimo '
          when 3 then 'Não chegou! ' when 4 then 'ADOREI ' when 5 then 'Nota 10 ' when 6 then 'gato por lebre ' else '' end, text), null) review_comment_message,
       {midnight(later("timestamp '2001-01-01 00:00:00'", draw('wr', 'doc_id', 77760000)))} review_creation_date,
       {later("timestamp '2001-01-01 00:00:00'", draw('wr', 'doc_id', 77760000) + ' + 172800')} review_answer_timestamp
from documents left join labels using (doc_id)"""
TABLES["raw_ml_predictions"] = f"""
select order_id, if(late, 'late', 'on_time') true_label,
       if(late <> ({draw('flip_a', 'order_id', 100)} < 38), 'late', 'on_time') predicted_label_hardcode,
       if(late <> ({draw('flip_b', 'order_id', 100)} < 39), 'late', 'on_time') predicted_label_sklearn,
       'v1' model_version, timestamp '2026-01-01 00:00:00' predicted_at
from (select order_id, order_delivered_customer_date > order_estimated_delivery_date late from raw_orders
      where order_status = 'delivered' and order_delivered_customer_date is not null)"""


def with_tables(statement: str) -> str:
    """``statement`` preceded by the table definitions it needs, in definition order."""
    needed: set[str] = set()
    frontier = [statement]
    while frontier:
        words = set(re.findall(r"[a-z_][a-z0-9_]*", frontier.pop()))
        fresh = (words & TABLES.keys()) - needed
        needed |= fresh
        frontier += [TABLES[name] for name in fresh]
    if not needed:
        return statement
    parts = ",\n".join(f"{name} as ({body.strip()})" for name, body in TABLES.items() if name in needed)
    return f"with {parts}\n{statement.strip()}"
