from datetime import date

import pytest
from pyspark.sql import functions as F
from small import raw_tables, small_models

from parcelwise.functions.keys import surrogate_key
from parcelwise.plans import cards, core, marts
from parcelwise.plans.build import CORE, MARTS, VIEWS, build, refresh_predictions
from parcelwise.session import scratch_dir
from parcelwise.sources import layers


@pytest.fixture(scope="module")
def models(spark):
    return small_models(spark)


def by(rows, key):
    return {row[key]: row for row in rows.collect()}


def test_order_facts(models):
    orders = by(models.fact_orders, "order_id")
    assert len(models.fact_orders.columns) == 13
    assert orders["o1"].is_late is True and orders["o1"].delivery_days == 9 and orders["o1"].approval_delay_hours == 1
    assert orders["o2"].is_late is False and orders["o2"].approval_delay_hours is None
    assert orders["o3"].is_late is None and orders["o3"].delivery_days is None
    assert orders["o6"].customer_key is None and orders["o1"].customer_key is not None


def test_item_facts_keep_rows_without_a_parent(models):
    items = {(row.order_id, row.order_item_id): row for row in models.fact_order_items.collect()}
    assert len(items) == 5
    assert items["o3", 1].product_key is None and items["o3", 1].seller_key is not None
    assert items["o2", 1].seller_key is None
    assert str(items["o1", 1].preco) == "20.00"


def test_reviews_have_two_keys_for_one_id(models):
    rows = models.fact_reviews.filter("review_id = 'r1'").collect()
    assert len({row.review_key for row in rows}) == 2
    assert by(models.fact_reviews, "review_id")["r2"].order_key is None


def test_staged_reviews(models):
    reviews = {(row.review_id, row.order_id): row for row in models.mart_reviews_enriched.collect()}
    assert reviews["r2", "ox"].texto_completo is None and reviews["r2", "ox"].coerencia_nota_texto == "sem_texto"
    assert reviews["r3", "o3"].texto_completo == "só título" and reviews["r3", "o3"].sentiment_label == "neutro"
    assert reviews["r1", "o1"].texto_completo == "Bom. péssimo" and reviews["r1", "o1"].coerencia_nota_texto == "divergente"


def test_products(models):
    products = by(models.dim_products, "product_id")
    assert [products[p].category_name_english for p in ("p1", "p2", "p3")] == ["beauty", "outros", None]
    assert [products[p].product_weight_g for p in ("p1", "p2", "p3")] == [101, None, 50]
    assert [products[p].product_volume_cm3 for p in ("p1", "p2", "p3")] == [60.0, None, 1.0]


def test_geolocation_means_and_modes(models):
    places = by(models.dim_geolocation, "zip_code_prefix")
    assert places["01037"].latitude == pytest.approx(-23.6) and places["01037"].longitude == pytest.approx(-46.6)
    assert places["01037"].cidade == "SAO PAULO"  # a tie goes to the smaller name
    assert places["20000"].cidade == "RIO"  # NULL is no candidate, however frequent
    assert places["20000"].longitude == pytest.approx(-43.4)


def test_calendar(spark):
    days = core.dim_date(spark)
    assert days.count() == 1096
    first = days.orderBy("date_day").first()
    assert (first.date_day, first.day_of_week, first.is_weekend) == (date(2016, 1, 1), 5, False)
    assert days.agg(F.max("date_day")).first()[0] == date(2018, 12, 31)
    assert days.filter("date_day = '2017-01-01'").first().is_weekend


def test_delivery_kpis_keep_the_unknown_state(models):
    kpis = by(models.mart_delivery_kpis, "estado")
    assert (kpis["SP"].order_count, kpis["SP"].late_count, kpis["SP"].pct_late) == (2, 1, 0.5)
    assert kpis["SP"].avg_delivery_days == pytest.approx((9 + 2) / 2)
    assert (kpis[None].order_count, kpis[None].late_count) == (1, 1)


def test_sentiment_uses_the_first_item_and_keeps_the_unknown_category(models):
    kpis = by(models.mart_sentiment_kpis, "category_name_english")
    assert (kpis["beauty"].review_count, kpis["beauty"].pct_positivo) == (1, 1.0)
    unknown = kpis[None]
    assert unknown.review_count == 3
    assert unknown.avg_review_score == pytest.approx(2.0)  # of the two scores present
    assert unknown.pct_neutro == pytest.approx(2 / 3)


def test_features_grain_and_gaps(models):
    rows = by(models.mart_late_delivery_features, "order_id")
    assert set(rows) == {"o1", "o2", "o6"}
    o1, o2, o6 = rows["o1"], rows["o2"], rows["o6"]
    assert (o1.item_count, str(o1.total_price), o1.payment_installments_max, o1.payment_value_total) == (2, "30.00", 3, 34.0)
    assert (o1.avg_product_weight_g, o1.avg_product_volume_cm3) == (101.0, 60.0)
    assert (o1.customer_state, o1.seller_state, o1.same_state_flag) == ("SP", "RJ", 0)
    assert o1.distance_km == pytest.approx(334, rel=0.05)
    assert (o1.purchase_dow, o1.purchase_month, o1.approval_delay_hours) == (0, 10, 1)
    assert (o2.distance_km, o2.payment_value_total, o2.seller_state, o2.same_state_flag) == (None, None, None, 0)
    assert (o6.customer_state, o6.distance_km) == (None, None)


def test_marts_agree_on_stored_keys_and_natural_ids(spark):
    models = small_models(spark)
    stored = {
        "delivery": marts.mart_delivery_kpis(models.fact_orders, models.dim_customers),
        "sentiment": marts.mart_sentiment_kpis(models.fact_reviews, models.fact_order_items, models.dim_products),
        "results": marts.mart_ml_results(models.stg_ml_predictions, models.fact_orders, models.dim_customers),
        "features": marts.mart_late_delivery_features(
            models.fact_orders,
            models.fact_order_items,
            models.fact_payments,
            models.dim_customers,
            models.dim_sellers,
            models.dim_products,
            models.dim_geolocation,
        ),
    }
    natural = {
        "delivery": models.mart_delivery_kpis,
        "sentiment": models.mart_sentiment_kpis,
        "results": models.mart_ml_results,
        "features": models.mart_late_delivery_features,
    }
    for name, rows in stored.items():
        assert rows.columns == natural[name].columns
        assert sorted(map(str, rows.collect())) == sorted(map(str, natural[name].collect())), name


def test_full_build_then_refresh(spark):
    models = small_models(spark)
    folder = scratch_dir(spark, "build-test")
    build(models, folder)
    for name in (*CORE, *MARTS):
        assert layers.read_snapshot(spark, folder, name).columns == models[name].columns
    for name in VIEWS:
        assert spark.table(name).columns == models[name].columns
    renewed = raw_tables(spark)["ml_predictions"].withColumn("predicted_label_sklearn", F.lit("late"))
    layers.write_predictions(renewed, folder)
    mart = by(refresh_predictions(models, folder, scratch_dir(spark, "refresh-test")), "order_id")
    assert (mart["o1"].sklearn_correct, mart["o2"].sklearn_correct) == (True, False)
    assert spark.table("stg_ml_predictions").filter("predicted_label_sklearn = 'late'").count() == 2


def test_cards_filter_by_state(models):
    kpis = models.mart_delivery_kpis
    assert cards.total_delivered(kpis).first()[0] == 4
    assert cards.total_delivered(kpis, "s").first()[0] == 2
    assert cards.late_rate(kpis, "RJ").first().pct_atraso == 0.0
    assert [row.estado for row in cards.late_by_state(kpis).collect()] == [None, "SP", "RJ"]
    comparison = by(cards.model_comparison(models.mart_ml_results), "modelo")
    assert comparison["Baseline (Majority Class)"].asDict() == {
        "modelo": "Baseline (Majority Class)",
        "acuracia_pct": 50.0,
        "recall_atraso_pct": 0.0,
        "precisao_atraso_pct": 0.0,
        "f1_atraso_pct": 0.0,
    }
    library = comparison["Regressao Logistica (Scikit-Learn)"]
    assert (library.recall_atraso_pct, library.precisao_atraso_pct, library.f1_atraso_pct) == (0.0, None, 0.0)
    errors = cards.error_details(models.mart_ml_results).collect()
    assert [row.id_pedido for row in errors] == ["o1"]


def test_category_card_drops_unknown_categories(models):
    def card(estado):
        rows = cards.sentiment_by_category(
            models.fact_reviews, models.fact_order_items, models.dim_products, models.fact_orders, models.dim_customers, estado
        )
        return [tuple(row) for row in rows.collect()]

    assert card(None) == [("beauty", 1, 100.0, 0.0, 0.0)]
    assert card("SP") == [("beauty", 1, 100.0, 0.0, 0.0)]
    assert card("RJ") == []


def test_keys_match_across_models(models, frame):
    expected = frame("k string", ("c1",)).select(surrogate_key("k")).first()[0]
    assert by(models.dim_customers, "customer_id")["c1"].customer_key == expected


def test_marts_read_the_stored_facts(spark, tmp_path):
    plain, stored = small_models(spark), build(small_models(spark), str(tmp_path))
    planned = small_models(spark).store(str(tmp_path / "core"), CORE)
    for name, fact in (
        ("mart_delivery_kpis", "fact_orders"),
        ("mart_sentiment_kpis", "fact_reviews"),
        ("mart_ml_results", "fact_orders"),
        ("mart_late_delivery_features", "fact_order_items"),
    ):
        assert any(f"/core/{fact}/" in path for path in planned[name].inputFiles())
        assert sorted(map(str, stored[name].collect())) == sorted(map(str, plain[name].collect()))
