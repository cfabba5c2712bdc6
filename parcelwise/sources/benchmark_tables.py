"""Order-analytics source tables derived from the TPC-H-like Parquet tables.

Every table is a projection of whole input tables. Values that the inputs lack come from arithmetic on the row's key,
so another engine can derive the same ones.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from parcelwise.schemas import LATE, ON_TIME, ORDER_STATUSES

PRIME = 2**31 - 1
HALF = 2**24
STATUS_WHEEL = ("delivered",) * 43 + ORDER_STATUSES[1:]
OPENINGS = ("Recomendo ", "Não recomendo ", "Péssimo ", "Não chegou! ", "ADOREI ", "Nota 10 ", "gato por lebre ", "", "")

_SCHEMAS: dict[str, StructType] = {}  # the footer of each file is read once per application


def mixing_constants(tag: str) -> tuple[int, int]:
    """Multiplier and offset of a tag."""
    return tuple(1 + zlib.crc32(f"{tag}/{part}".encode()) % (PRIME - 1) for part in "ab")


def mix(tag: str, key: str) -> str:
    """Scattered number below ``PRIME`` from a non-negative whole key; plain arithmetic that any engine repeats.

    Kept this short because filters on derived columns inline it many times, and a generated method over
    8 000 bytes is not compiled by the JVM.
    """
    a, b = mixing_constants(tag)
    return f"((bigint({key}) % {PRIME}L * {a}L + {b}L) % {PRIME}L)"


def draw(tag: str, key: str, size: int | str) -> str:
    """Number below ``size`` that depends only on ``tag`` and ``key``."""
    return f"({mix(tag, key)} % {size})"


def later(stamp: str, seconds: str) -> str:
    return f"timestampadd(second, {seconds}, {stamp})"


def midnight(stamp: str) -> str:
    return f"cast(date({stamp}) as timestamp_ntz)"


def strings(values: tuple[str, ...]) -> str:
    return "array(" + ", ".join(f"'{value}'" for value in values) + ")"


class BenchmarkTables:
    """``tables[name]`` gives a lazily derived source table by its registry name."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")

    def read(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self, f"_{name}")()

    def _placed(self, name: str, nation: str) -> DataFrame:
        region = self.read("region").selectExpr("r_regionkey as n_regionkey", "r_name")
        places = self.read("nation").join(region, "n_regionkey")
        return self.read(name).withColumnRenamed(nation, "n_nationkey").join(places, "n_nationkey")

    def _customers(self) -> DataFrame:
        return self._placed("customer", "c_nationkey").selectExpr(
            "string(c_custkey) as customer_id",
            f"string({draw('uniq', 'c_custkey', 1000000)}) as customer_unique_id",
            f"lpad(string({draw('czip', 'c_custkey', 1050)}), 5, '0') as customer_zip_code_prefix",
            "lower(r_name) as customer_city",
            "lower(n_name) as customer_state",
        )

    def _sellers(self) -> DataFrame:
        return self._placed("supplier", "s_nationkey").selectExpr(
            "string(s_suppkey) as seller_id",
            f"lpad(string({draw('szip', 's_suppkey', 1050)}), 5, '0') as seller_zip_code_prefix",
            "lower(r_name) as seller_city",
            "lower(n_name) as seller_state",
        )

    def raw_geolocation(self) -> DataFrame:
        """With repeated rows, as landed; ``tables["geolocation"]`` has them removed."""
        return self.read("events").selectExpr("event_id", f"{draw('ezip', 'event_id', 1000)} as prefix").selectExpr(
            "lpad(string(prefix), 5, '0') as geolocation_zip_code_prefix",
            f"-5D - double(prefix % 25) - double({draw('lat', 'event_id', 5)}) / 100 as geolocation_lat",
            f"-35D - double(prefix % 20) - double({draw('lng', 'event_id', 5)}) / 100 as geolocation_lng",
            f"concat('city ', string({draw('city', 'event_id', 3)})) as geolocation_city",
            "concat('nation_', string(prefix % 25)) as geolocation_state",
        )

    def _geolocation(self) -> DataFrame:
        return self.raw_geolocation().dropDuplicates()

    def _orders(self) -> DataFrame:
        """About one order in a hundred names a customer that does not exist."""
        arrival = f"86400 * (1 + {draw('dl', 'o_orderkey', 30)}) + {draw('dls', 'o_orderkey', 40000)}"
        promise = f"86400 * (20 + {draw('es', 'o_orderkey', 25)})"
        staged = self.read("orders").selectExpr(
            "o_orderkey",
            "o_custkey",
            f"{later('o_orderdate', draw('ph', 'o_orderkey', 86400))} as bought",
            f"get({strings(STATUS_WHEEL)}, int({draw('st', 'o_orderkey', len(STATUS_WHEEL))})) as order_status",
        )
        return staged.selectExpr(
            "string(o_orderkey) as order_id",
            f"if({draw('guest', 'o_orderkey', 100)} = 0, concat('guest-', string(o_orderkey)), string(o_custkey)) as customer_id",
            "order_status",
            "bought as order_purchase_timestamp",
            f"if({draw('noap', 'o_orderkey', 100)} > 0, {later('bought', draw('ap', 'o_orderkey', 172800))}, null) as order_approved_at",
            f"if(order_status in ('delivered', 'shipped'), {later('bought', '86400 + ' + draw('ca', 'o_orderkey', 259200))}, null)"
            " as order_delivered_carrier_date",
            f"if(order_status = 'delivered' and {draw('nodl', 'o_orderkey', 200)} > 0, {later('bought', arrival)}, null)"
            " as order_delivered_customer_date",
            f"{midnight(later('bought', promise))} as order_estimated_delivery_date",
        )

    def _order_items(self) -> DataFrame:
        """About one item in fifty names a seller that does not exist.

        ``l_linenumber`` repeats within an order; 48 mixed bits below it make the number unique without a sort per order.
        """
        goods = f"{mix('goods', 'l_partkey * 1000003 + l_suppkey')} % {HALF}"
        terms = f"{mix('terms', 'floor(l_extendedprice * 100 + 0.5D) * 100003 + unix_date(date(l_shipdate))')} % {HALF}"
        return self.read("lineitem").selectExpr(
            "string(l_orderkey) as order_id",
            f"(bigint(l_linenumber) * {HALF} + {goods}) * {HALF} + {terms} as order_item_id",
            "string(l_partkey) as product_id",
            f"if({draw('noseller', 'l_partkey', 50)} = 0, 'unknown', string(l_suppkey)) as seller_id",
            "l_shipdate as shipping_limit_date",
            "l_extendedprice as price",
            "l_quantity * 1.25D as freight_value",
        )

    def _order_payments(self) -> DataFrame:
        paid = "o_orderkey * 10 + payment_sequential"
        parted = self.read("orders").selectExpr("o_orderkey", "o_totalprice", f"1 + {draw('np', 'o_orderkey', 2)} as parts")
        return parted.selectExpr("*", "explode(sequence(1L, parts)) as payment_sequential").selectExpr(
            "string(o_orderkey) as order_id",
            "payment_sequential",
            f"get({strings(('boleto', 'voucher', 'debit_card', 'credit_card'))}, int({draw('pty', paid, 4)})) as payment_type",
            f"1 + {draw('ins', paid, 12)} as payment_installments",
            "double(floor(o_totalprice / parts)) as payment_value",
        )

    def _order_reviews(self) -> DataFrame:
        """One review per document, with its whole text; a few point at orders that do not exist."""
        written = later("timestamp_ntz'2001-01-01 00:00:00'", draw("wr", "doc_id", 77760000))
        order_count = self.read("orders").selectExpr("bigint(floor(count(*) * 1.02D))").scalar()
        reviews = self.read("documents").join(self.read("labels"), "doc_id", "left")
        return reviews.withColumn("orders", order_count).selectExpr(
            f"md5(string(if({draw('rdup', 'doc_id', 25)} = 0, doc_id - 1, doc_id))) as review_id",
            f"string({draw('ord', 'doc_id', 'orders')}) as order_id",
            f"case when toxic = 1 then 1L when {draw('sc', 'doc_id', 10)} < 6 then 5L else 1 + {draw('sc2', 'doc_id', 5)} end as review_score",
            f"if({draw('tt', 'doc_id', 100)} < 12, concat_ws('\\n', ' ', source, lang), null) as review_comment_title",
            f"if({draw('mm', 'doc_id', 100)} < 85, concat(get({strings(OPENINGS)}, int({draw('kw', 'doc_id', 9)})), text), null)"
            " as review_comment_message",
            f"{midnight(written)} as review_creation_date",
            f"{later(written, '172800')} as review_answer_timestamp",
        )

    def _products(self) -> DataFrame:
        return self.read("part").selectExpr(
            "string(p_partkey) as product_id",
            f"if({draw('nocat', 'p_partkey', 50)} > 0, lower(p_type), null) as product_category_name",
            "double(length(p_name)) as product_name_lenght",
            f"double({draw('desc', 'p_partkey', 2000)}) as product_description_lenght",
            f"double({draw('pho', 'p_partkey', 6)}) as product_photos_qty",
            f"if({draw('now', 'p_partkey', 100)} > 0, p_size * 100 + 0.25D, null) as product_weight_g",
            f"double(10 + {draw('len', 'p_partkey', 60)}) as product_length_cm",
            f"double(5 + {draw('hei', 'p_partkey', 40)}) as product_height_cm",
            f"double(8 + {draw('wid', 'p_partkey', 50)}) as product_width_cm",
        )

    def _category_translation(self) -> DataFrame:
        """Without ``promo``, so that one category stays untranslated."""
        names = self.read("part").filter("p_type <> 'PROMO'").selectExpr("lower(p_type) as product_category_name").distinct()
        return names.selectExpr("product_category_name", "concat(product_category_name, '_en') as product_category_name_english")

    def _ml_predictions(self) -> DataFrame:
        """Fixed predictions for every delivered order, wrong for a hash-chosen share of them."""

        def name(flag: str) -> str:
            return f"if({flag}, '{LATE}', '{ON_TIME}')"

        delivered = self["orders"].filter("order_status = 'delivered' and order_delivered_customer_date is not null")
        judged = delivered.selectExpr("order_id", "order_delivered_customer_date > order_estimated_delivery_date as late")
        return judged.selectExpr(
            "order_id",
            f"{name('late')} as true_label",
            f"{name('late <> (' + draw('flip_a', 'order_id', 100) + ' < 38)')} as predicted_label_hardcode",
            f"{name('late <> (' + draw('flip_b', 'order_id', 100) + ' < 39)')} as predicted_label_sklearn",
            "'v1' as model_version",
            "timestamp_ntz'2026-01-01 00:00:00' as predicted_at",
        )
