"""Dashboard queries (inventory 2.14)."""

from __future__ import annotations

from parcelwise.plans import cards
from workload.registry import query, rounded
from workload.relational import CARD6_SQL, ERRORS_SQL, LATE_BY_STATE_SQL, SLOWEST_SQL, card6

STATE = "NATION_5"
ONE_STATE = f"where estado = '{STATE}'"


def _both(key: str, oracle: str, function) -> None:
    """Register a card without and with the state filter; ``oracle`` has a ``{where}`` slot."""
    query(key, oracle.format(where=""))(lambda m: rounded(function(m, None)))
    query(f"{key}_state", oracle.format(where=ONE_STATE))(lambda m: rounded(function(m, STATE)))


query("n1_total_delivered", "select sum(order_count) total_pedidos from mart_delivery_kpis")(
    lambda m: cards.total_delivered(m.mart_delivery_kpis)
)
query("n1_total_delivered_contains", "select sum(order_count) total_pedidos from mart_delivery_kpis where contains(lower(estado), 'nation_1')")(
    lambda m: cards.total_delivered(m.mart_delivery_kpis, "Nation_1")
)
_both(
    "n2_late_rate",
    "select sum(order_count) total_pedidos, sum(late_count) total_atrasados, round(100.0 * sum(late_count) / nullif(sum(order_count), 0), 6) pct_atraso from mart_delivery_kpis {where}",
    lambda m, estado: cards.late_rate(m.mart_delivery_kpis, estado),
)
_both(
    "n3_avg_actual_days",
    "select round(avg(avg_delivery_days), 6) prazo_medio_real from mart_delivery_kpis {where}",
    lambda m, estado: cards.avg_actual_days(m.mart_delivery_kpis, estado),
)
_both(
    "n4_avg_estimated_days",
    "select round(avg(avg_estimated_delivery_days), 6) prazo_medio_estimado from mart_delivery_kpis {where}",
    lambda m, estado: cards.avg_estimated_days(m.mart_delivery_kpis, estado),
)
_both(
    "n5_late_by_state",
    LATE_BY_STATE_SQL + " {where} order by pct_late desc nulls first, estado",
    lambda m, estado: cards.late_by_state(m.mart_delivery_kpis, estado),
)
query("n6_sentiment_by_category", CARD6_SQL.format(extra="", limit=15))(lambda m: card6(m))
query("n6_sentiment_by_category_state", CARD6_SQL.format(extra=f"and c.estado = '{STATE}'", limit=15))(lambda m: card6(m, STATE))

_SCORES = """
select '{title}' modelo, 100.0 * count(*) filter (where true_label = {column}) / count(*) acc,
       count(*) filter (where true_label = 'late' and {column} = 'late') / nullif(cast(count(*) filter (where true_label = 'late') as double), 0) r,
       count(*) filter (where true_label = 'late' and {column} = 'late') / nullif(cast(count(*) filter (where {column} = 'late') as double), 0) p
from mart_ml_results {{where}}"""
_COMPARISON = f"""
select modelo, round(acc, 6) acuracia_pct, round(100 * r, 6) recall_atraso_pct, round(100 * p, 6) precisao_atraso_pct, round(100 * ifnull(2 * p * r / nullif(p + r, 0), 0), 6) f1_atraso_pct
from ({_SCORES.format(title='Regressao Logistica (Numpy Scratch)', column='predicted_label_hardcode')}
  union all {_SCORES.format(title='Regressao Logistica (Scikit-Learn)', column='predicted_label_sklearn')}
  union all select 'Baseline (Majority Class)', 100.0 * count(*) filter (where true_label = 'on_time') / count(*), 0, 0 from mart_ml_results {{where}})"""
_both("n7_model_comparison", _COMPARISON, lambda m, estado: cards.model_comparison(m.mart_ml_results, estado))
query("n8_error_details", ERRORS_SQL.format(extra=""))(lambda m: cards.error_details(m.mart_ml_results))
query("n8_error_details_state", ERRORS_SQL.format(extra=f"and estado = '{STATE}'"))(lambda m: cards.error_details(m.mart_ml_results, STATE))
query("n9_worst_delivery_states", SLOWEST_SQL.format(10))(lambda m: rounded(cards.slowest_states(m.mart_delivery_kpis)))


def _band(value: str, edges: tuple[int, ...]) -> str:
    return f"case when {value} is null then null " + " ".join(f"when {value} < {e} then {i}" for i, e in enumerate(edges)) + f" else {len(edges)} end"


query(
    "n10_delay_vs_distance",
    f"""select {_band('distance_km', (500, 1500, 2500))} distance_band, {_band('total_freight', (50, 100, 200))} freight_band, count(*) order_count,
    count(*) filter (where is_late) late_count, round(avg(cast(is_late as integer)), 6) pct_late from mart_late_delivery_features group by 1, 2""",
)(lambda m: rounded(cards.late_by_distance(m.mart_late_delivery_features)))
query(
    "n11_bad_reviews_vs_late",
    """select k.estado, order_count, round(pct_late, 6) pct_late, review_count, round(pct_negativo, 6) pct_negativo from mart_delivery_kpis k left join (
      select estado, count(*) review_count, avg(cast(sentiment_label = 'negativo' as integer)) pct_negativo
      from fact_reviews r left join fact_orders o on o.order_id = r.order_id left join dim_customers c on c.customer_key = o.customer_key group by 1) s
      on s.estado is not distinct from k.estado""",
)(
    lambda m: rounded(
        cards.bad_reviews_and_delay(m.stg_order_reviews, m.stg_orders, m.stg_customers, m.mart_delivery_kpis, "customer_id")
    )
)
