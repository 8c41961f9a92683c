"""DuckDB oracle SQL shared by the catalogue.

Written independently of the Spark code as plain window / join / group SQL
over the driver's views (``events``, ``customer``, ...).  Money is summed as
integer cents in both engines so results agree exactly.
"""

from __future__ import annotations

from ..functions.geo import haversine_sql
from ..sources.tables import TXN_SQL

TXN_COLS = ("transaction_id, ts, card_id, amount, merchant_category, k, merchant_name, home, geo, "
            "acctbal, segment, card_limit, avg_monthly_spend, lat, lon, is_online, device_id, is_fraud")

FEAT_CTE = f"""
feat0 AS (
  SELECT *, CAST(ROUND(amount * 100) AS BIGINT) AS cents, epoch_us(ts) AS t_us FROM txn
),
feat1 AS (
  SELECT *,
    COUNT(*) OVER (PARTITION BY card_id ORDER BY ts RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW) AS transactions_last_1hr,
    COUNT(*) OVER (PARTITION BY card_id ORDER BY ts RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND CURRENT ROW) AS transactions_last_24hr,
    COUNT(*) OVER (PARTITION BY card_id ORDER BY ts RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND CURRENT ROW) AS n30,
    CAST(SUM(cents) OVER (PARTITION BY card_id ORDER BY ts RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND CURRENT ROW) AS BIGINT) AS c30,
    LAG(t_us) OVER wo AS prev_t_us, LAG(lat) OVER wo AS prev_lat, LAG(lon) OVER wo AS prev_lon,
    COUNT(*) OVER wp AS prior_n,
    CAST(SUM(cents) OVER wp AS BIGINT) AS s1,
    SUM(CAST(cents AS HUGEINT) * cents) OVER wp AS s2,
    ROW_NUMBER() OVER (PARTITION BY card_id, merchant_name ORDER BY ts, transaction_id) = 1 AS is_new_merchant,
    ROW_NUMBER() OVER (PARTITION BY card_id, device_id ORDER BY ts, transaction_id) = 1 AS is_new_device,
    ROW_NUMBER() OVER (PARTITION BY card_id, geo ORDER BY ts, transaction_id) = 1 AS is_new_geo
  FROM feat0
  WINDOW wo AS (PARTITION BY card_id ORDER BY ts, transaction_id),
         wp AS (PARTITION BY card_id ORDER BY ts, transaction_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
feat2 AS (
  SELECT *,
    c30 / (100e0 * n30) AS avg_transaction_amount_30d,
    (t_us - prev_t_us) / 60000000e0 AS minutes_since_last_txn,
    {haversine_sql('prev_lat', 'prev_lon', 'lat', 'lon')} AS distance_from_last_txn_km,
    prior_n AS prior_txn_count,
    CASE WHEN prior_n > 0 THEN s1 / (100e0 * prior_n) END AS prior_avg_amount,
    CASE WHEN prior_n >= 2 THEN sqrt(CAST(prior_n * s2 - CAST(s1 AS HUGEINT) * s1 AS DOUBLE)
                                     / CAST(prior_n * (prior_n - 1) AS DOUBLE)) / 100e0 END AS prior_std_amount,
    CASE WHEN prior_n > 0 THEN cents * prior_n > 3 * s1 END AS over_3x_avg
  FROM feat1
),
feat AS (
  SELECT *, (amount - prior_avg_amount) / NULLIF(prior_std_amount, 0) AS amount_zscore FROM feat2
)"""

FEATURE_COLS = ("transactions_last_1hr, transactions_last_24hr, n30 AS transactions_last_30d, avg_transaction_amount_30d, "
                "minutes_since_last_txn, distance_from_last_txn_km, prior_txn_count, prior_avg_amount, "
                "prior_std_amount, amount_zscore, over_3x_avg, is_new_merchant, is_new_device, is_new_geo")


def with_txn(body: str, *ctes: str) -> str:
    """``WITH txn AS (...), <ctes> <body>``."""
    parts = [f"txn AS ({TXN_SQL})"] + [c.strip() for c in ctes]
    return "WITH " + ",\n".join(parts) + "\n" + body


def with_feat(body: str, *ctes: str) -> str:
    return with_txn(body, FEAT_CTE, *ctes)


# rule predicates over ``feat`` (the catalogue's thresholds)
RULE_SQL = {
    "amount_3x": "COALESCE(over_3x_avg, false)",
    "impossible_travel": "COALESCE(distance_from_last_txn_km > 500 AND minutes_since_last_txn <= 30, false)",
    "odd_hour": "(hour(ts) >= 1 AND hour(ts) < 5 AND amount > 100)",
    "zscore": "COALESCE(amount_zscore > 3, false)",
    "near_limit": "COALESCE(card_limit > 0 AND amount >= 0.001e0 * card_limit, false)",
    "new_device_high_value": "(is_new_device AND amount > 100)",
    "unusual_geo": "(is_new_geo AND geo <> home)",
    "high_value_category": "(merchant_category = 'error' AND amount > 100)",
    "spend_spike": ("(COALESCE(amount > 0.01e0 * avg_monthly_spend, false) AND is_new_merchant AND NOT COALESCE(list_contains("
                    "CASE segment WHEN 'AUTOMOBILE' THEN ['purchase', 'click'] WHEN 'BUILDING' THEN ['view', 'signup'] "
                    "WHEN 'FURNITURE' THEN ['purchase', 'view'] WHEN 'HOUSEHOLD' THEN ['click', 'error'] "
                    "WHEN 'MACHINERY' THEN ['signup', 'error'] END, merchant_category), false))"),
}

PREFERRED_VALUES = ("(VALUES ('AUTOMOBILE', 'purchase'), ('AUTOMOBILE', 'click'), ('BUILDING', 'view'), "
                    "('BUILDING', 'signup'), ('FURNITURE', 'purchase'), ('FURNITURE', 'view'), "
                    "('HOUSEHOLD', 'click'), ('HOUSEHOLD', 'error'), ('MACHINERY', 'signup'), "
                    "('MACHINERY', 'error')) AS p(segment, merchant_category)")
