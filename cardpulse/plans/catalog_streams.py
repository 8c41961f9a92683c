"""Catalogue entries for streams, sinks and the wire format.

Streaming entries run their job to completion (``availableNow``) over the
replay of the driver tables and return a batch DataFrame over the sink.
Event times are instants (the producer stamps +05:30), exposed as epoch
microseconds so both engines compare them without time-zone ambiguity.
"""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import functions as F

from .. import dimensions as dims
from ..functions.geo import haversine_sql
from ..schemas import TRANSACTION_SCHEMA
from ..session import shared_path
from ..sources import kafka
from ..sources import decode as dec
from ..sources.model import JSON_OPTIONS, model_records
from ..sources.replay import LATE_BEFORE_US, LATE_EVERY
from ..streaming import jobs, rollups, sinks
from .catalog import register
from .oracle_sql import with_feat, with_txn

CITY_LIST = ("['Bangalore', 'Mumbai', 'Delhi', 'Hyderabad', 'Chennai', 'Pune', 'Kolkata', 'Ahmedabad', "
             "'Jaipur', 'Lucknow', 'Chandigarh', 'Kochi']")

MODEL_CTE = f"""
model AS (
  SELECT printf('txn_%012x', transaction_id) AS transaction_id,
         printf('card_%05d', card_id) AS card_id,
         epoch_us(ts) - 19800000000 AS event_us, amount, merchant_name,
         CASE merchant_category WHEN 'purchase' THEN 'online_retail' WHEN 'view' THEN 'entertainment'
              WHEN 'click' THEN 'dining' WHEN 'signup' THEN 'utilities' WHEN 'error' THEN 'electronics' END
           AS merchant_category,
         lat AS location_lat, lon AS location_lon, {CITY_LIST}[geo % 12 + 1] AS city, is_online, is_fraud,
         CAST(round((acctbal + 1000) * 20) AS INTEGER) AS monthly_income,
         CAST(round(CAST(round((acctbal + 1000) * 20) AS INTEGER) * 0.3e0) AS INTEGER) AS avg_monthly_spend,
         k % 4 AS active_emis,
         CAST(round((k % 4) * CAST(round((acctbal + 1000) * 20) AS INTEGER) * 0.05e0) AS INTEGER) AS total_emi_amount,
         CASE WHEN card_id % 7 = 0 THEN CAST(card_id % 60 + 1 AS INTEGER) ELSE 0 END AS months_since_last_default,
         CAST(round(greatest(acctbal, 0) * 100) AS INTEGER) AS card_limit,
         round(CAST(5 + k % 81 AS DOUBLE), 1) AS credit_utilization_pct,
         segment, home
  FROM txn
)"""

WIRE_COLS = ("transaction_id", "card_id", "event_us", "amount", "merchant_name", "merchant_category",
             "location_lat", "location_lon", "city", "is_online", "is_fraud", "monthly_income",
             "avg_monthly_spend")
WIRE_SQL = ", ".join(WIRE_COLS)


def wire(df):
    """Projection of decoded messages compared against the oracle."""
    return df.select(*[F.unix_micros("timestamp").alias("event_us") if c == "event_us" else c for c in WIRE_COLS])


def with_model(body, *ctes):
    return with_txn(body, MODEL_CTE, *ctes)


# ---------------------------------------------------------------------------
# wire format and batch sinks
# ---------------------------------------------------------------------------

@register("kafka_records_roundtrip", "S10 S3 X2 X3 X9 X10", with_model(f"SELECT {WIRE_SQL} FROM model"))
def q_kafka_roundtrip(spark, sf):
    """Encode as broker records (key, JSON value bytes), decode again."""
    recs = kafka.to_records(model_records(spark, sf))
    return wire(dec.decode(recs))


@register("csv_sink_roundtrip", "S11", with_model(f"SELECT {WIRE_SQL} FROM model"))
def q_csv_roundtrip(spark, sf):
    path = shared_path(spark, "sinks", "csv")
    sinks.write_csv(model_records(spark, sf), path)
    schema = TRANSACTION_SCHEMA.fields
    back = sinks.read_csv(spark, path, "transaction_id string, timestamp string, " + ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in schema[2:]))
    back = back.withColumn("timestamp", F.to_timestamp("timestamp", JSON_OPTIONS["timestampFormat"]))
    return wire(back)


@register("json_sink_roundtrip", "S12 X2", with_model(f"SELECT {WIRE_SQL} FROM model"))
def q_json_roundtrip(spark, sf):
    path = shared_path(spark, "sinks", "json")
    sinks.write_json(model_records(spark, sf), path)
    back = spark.read.schema(TRANSACTION_SCHEMA).options(**JSON_OPTIONS).json(path)
    return wire(back)


@register("partitioned_sink", "S8", with_model(
    "SELECT transaction_id, card_id, amount, CAST(make_timestamp(event_us) + INTERVAL 330 MINUTE AS DATE) "
    "AS event_date FROM model"))
def q_partitioned_sink(spark, sf):
    """Enriched rows written partitioned by (IST) event date, read back."""
    path = shared_path(spark, "sinks", "partitioned")
    m = model_records(spark, sf).select(
        "transaction_id", "card_id", "amount", F.to_date(F.substring("timestamp", 1, 10)).alias("event_date"))
    sinks.write_partitioned(m, path, "event_date")
    return spark.read.parquet(path).select("transaction_id", "card_id", "amount", "event_date")


@register("row_limit", "S15 O2", with_model(
    f"SELECT {WIRE_SQL} FROM model ORDER BY transaction_id LIMIT 100"))
def q_row_limit(spark, sf):
    """Stop after N rows (deterministic: first N by transaction id)."""
    return wire(dec.decode(kafka.to_records(model_records(spark, sf)))).orderBy("transaction_id").limit(100)


@register("subscriber_fraud_view", "F3", with_model(
    "SELECT transaction_id, card_id, event_us, amount, location_lat, location_lon, city, merchant_category, "
    "is_online FROM model"))
def q_fraud_view(spark, sf):
    d = dec.decode(kafka.to_records(model_records(spark, sf)))
    return d.select("transaction_id", "card_id", F.unix_micros("timestamp").alias("event_us"), "amount",
                    "location_lat", "location_lon", "city", "merchant_category", "is_online")


@register("subscriber_loan_view", "F3", with_model(
    "SELECT transaction_id, card_id, monthly_income, active_emis, total_emi_amount, "
    "total_emi_amount / NULLIF(CAST(monthly_income AS DOUBLE), 0) AS emi_burden, "
    "credit_utilization_pct FROM model"))
def q_loan_view(spark, sf):
    d = dec.decode(kafka.to_records(model_records(spark, sf)))
    return d.select("transaction_id", "card_id", "monthly_income", "active_emis", "total_emi_amount",
                    (F.col("total_emi_amount") / F.nullif(F.col("monthly_income").cast("double"), F.lit(0.0)))
                    .alias("emi_burden"), "credit_utilization_pct")


@register("subscriber_risk_view", "F3", with_model(
    "SELECT transaction_id, card_id, NULLIF(months_since_last_default, 0) AS months_since_last_default, amount, "
    "avg_monthly_spend, amount / NULLIF(CAST(avg_monthly_spend AS DOUBLE), 0) AS spend_ratio FROM model"))
def q_risk_view(spark, sf):
    d = dec.decode(kafka.to_records(model_records(spark, sf)))
    spend = F.nullif(F.col("avg_monthly_spend").cast("double"), F.lit(0.0))
    return d.select("transaction_id", "card_id",
                    F.nullif(F.col("months_since_last_default"), F.lit(0)).alias("months_since_last_default"),
                    "amount", "avg_monthly_spend", (F.col("amount") / spend).alias("spend_ratio"))


# ---------------------------------------------------------------------------
# streaming jobs
# ---------------------------------------------------------------------------

@register("stream_decoded", "T1 T2 S2 S3 S5 S6", with_model(f"SELECT {WIRE_SQL} FROM model"))
def q_stream_decoded(spark, sf):
    return wire(jobs.stream_decoded(spark, sf))


@register("stream_quarantine", "S14", """
SELECT 'page_' || CAST(page_id AS VARCHAR) AS key, 'missing transaction_id,timestamp,card_id,amount' AS reason,
       html AS raw, CAST(length(html) AS INTEGER) AS raw_chars FROM pages""")
def q_stream_quarantine(spark, sf):
    return jobs.stream_quarantine(spark, sf).select("key", "reason", "raw", "raw_chars")


_END = "(SELECT MAX(event_us) FROM model) - 1800000000"


@register("stream_tumbling_features", "T3 A4", with_model(f"""
SELECT card_id, window_start_us, window_start_us + 3600000000 AS window_end_us, txns,
       cents / (100e0 * txns) AS avg_amount
FROM (SELECT card_id, event_us - event_us % 3600000000 AS window_start_us, COUNT(*) AS txns,
             SUM(CAST(round(amount * 100) AS BIGINT)) AS cents
      FROM model GROUP BY 1, 2) w
WHERE window_start_us + 3600000000 <= {_END}"""))
def q_stream_tumbling(spark, sf):
    return jobs.stream_tumbling_features(spark, sf)


@register("stream_daily_features", "T3 (day)", with_model(f"""
SELECT card_id, window_start_us, window_start_us + 86400000000 AS window_end_us, txns,
       cents / (100e0 * txns) AS avg_amount
FROM (SELECT card_id, event_us - event_us % 86400000000 AS window_start_us, COUNT(*) AS txns,
             SUM(CAST(round(amount * 100) AS BIGINT)) AS cents
      FROM model GROUP BY 1, 2) w
WHERE window_start_us + 86400000000 <= {_END}"""))
def q_stream_daily(spark, sf):
    return jobs.stream_tumbling_features(spark, sf, every="1 day")


@register("stream_fan_out", "S13 F3", with_model("""
SELECT s.subscriber, event_us // 86400000000 AS event_day, COUNT(*) AS messages, COUNT(DISTINCT transaction_id) AS transactions
FROM model, (VALUES ('fraud'), ('loan'), ('risk')) AS s(subscriber) GROUP BY 1, 2"""))
def q_stream_fan_out(spark, sf):
    """Three subscribers read the same messages, each with its own checkpoint and fields."""
    return jobs.stream_fan_out(spark, sf)


@register("stream_sliding_velocity", "T4 D2", with_model(f"""
SELECT card_id, window_start_us, COUNT(*) AS txns
FROM (SELECT card_id, event_us, event_us - event_us % 60000000 - 60000000 * g AS window_start_us
      FROM model, range(0, 10) r(g)) x
WHERE event_us < window_start_us + 600000000 AND window_start_us + 600000000 <= {_END}
GROUP BY card_id, window_start_us HAVING COUNT(*) >= 2"""))
def q_stream_sliding(spark, sf):
    return jobs.stream_sliding_velocity(spark, sf, min_txns=2)


@register("stream_distinct_merchants", "A12 T4", with_model(f"""
SELECT card_id, window_start_us, COUNT(*) AS txns, COUNT(DISTINCT merchant_name) AS distinct_merchants
FROM (SELECT card_id, merchant_name, event_us - event_us % 600000000 - 600000000 * g AS window_start_us
      FROM model, range(0, 6) r(g)) x
WHERE window_start_us + 3600000000 <= {_END}
GROUP BY card_id, window_start_us HAVING COUNT(DISTINCT merchant_name) >= 2"""))
def q_stream_distinct_merchants(spark, sf):
    """Sketches of so few merchants are exact."""
    return jobs.stream_distinct_merchants(spark, sf)


@register("stream_card_state", "T5", with_feat("""
SELECT printf('txn_%012x', transaction_id) AS transaction_id, printf('card_%05d', card_id) AS card_id,
       minutes_since_last_txn, distance_from_last_txn_km, is_new_merchant,
       transactions_last_1hr, transactions_last_24hr FROM feat"""))
def q_stream_card_state(spark, sf):
    return jobs.stream_card_state(spark, sf).select(
        "transaction_id", "card_id", "minutes_since_last_txn", "distance_from_last_txn_km", "is_new_merchant",
        "transactions_last_1hr", "transactions_last_24hr")


@register("stream_card_state_minutes", "T5 (minute-indexed transformWithState)", with_feat("""
SELECT printf('txn_%012x', transaction_id) AS transaction_id, printf('card_%05d', card_id) AS card_id,
       minutes_since_last_txn, distance_from_last_txn_km, is_new_merchant,
       transactions_last_1hr, transactions_last_24hr FROM feat"""))
def q_stream_card_state_minutes(spark, sf):
    return jobs.stream_card_state(spark, sf, minute_state=True).select(
        "transaction_id", "card_id", "minutes_since_last_txn", "distance_from_last_txn_km", "is_new_merchant",
        "transactions_last_1hr", "transactions_last_24hr")


@register("stream_dedup", "T6", with_model("SELECT transaction_id, card_id, event_us, amount FROM model"))
def q_stream_dedup(spark, sf):
    return jobs.stream_dedup(spark, sf).select(
        "transaction_id", "card_id", F.unix_micros("timestamp").alias("event_us"), "amount")


@register("stream_restart", "T7", with_model("SELECT transaction_id, card_id, event_us, amount FROM model"))
def q_stream_restart(spark, sf):
    return jobs.stream_restart(spark, sf).select(
        "transaction_id", "card_id", F.unix_micros("timestamp").alias("event_us"), "amount")


@register("late_reconciliation", "T8", with_model(f"""
SELECT card_id, window_start_us, txns, streamed, txns - streamed AS missing
FROM (SELECT card_id, window_start_us, COUNT(*) AS txns,
             CAST(CASE WHEN window_start_us + 3600000000 <= {_END} THEN SUM(CASE WHEN late THEN 0 ELSE 1 END) ELSE 0 END AS BIGINT) AS streamed
      FROM (SELECT card_id, event_us - event_us % 3600000000 AS window_start_us,
                   event_us < {LATE_BEFORE_US} AND CAST('0x' || substr(transaction_id, 5) AS BIGINT) % {LATE_EVERY} = 0 AS late
            FROM model) m
      GROUP BY 1, 2) w
WHERE txns <> streamed"""))
def q_late_reconciliation(spark, sf):
    return jobs.late_reconciliation(spark, sf)


@register("stream_progress", "T9", with_model("""
SELECT event_us // 86400000000 AS event_day, COUNT(*) AS input_rows, CAST(SUM(CAST(is_fraud AS INTEGER)) AS BIGINT) AS fraud_rows,
       100e0 * CAST(SUM(CAST(is_fraud AS INTEGER)) AS BIGINT) / COUNT(*) AS fraud_pct, COUNT(*) / 86400e0 AS rows_per_second
FROM model GROUP BY 1"""))
def q_stream_progress(spark, sf):
    return jobs.stream_progress(spark, sf)


@register("stream_throughput", "T9 (listener)", with_model("""
SELECT (SELECT COUNT(*) FROM model) + (SELECT COUNT(*) FROM pages) AS input_rows, true AS all_batches, true AS all_rates"""))
def q_stream_throughput(spark, sf):
    """Rates differ from run to run: what must hold of them."""
    t = jobs.stream_throughput(spark, sf)
    return t.agg(F.sum("input_rows").alias("input_rows"),
                 (F.max("batch_id") + 1 == F.count(F.lit(1))).alias("all_batches"),
                 F.bool_and((F.col("input_rows") == 0) | (F.col("processed_rows_per_second") > 0)).alias("all_rates"))


@register("stream_dashboard_rate", "A6 (incremental)", with_model("""
SELECT CAST(make_timestamp(event_us) AS DATE) AS day, COUNT(*) AS txns, CAST(SUM(CAST(is_fraud AS INTEGER)) AS BIGINT) AS fraud_txns,
       CAST(SUM(CAST(is_fraud AS INTEGER)) AS BIGINT) / COUNT(*) AS fraud_rate FROM model GROUP BY 1"""))
def q_stream_dashboard_rate(spark, sf):
    return rollups.fraud_rate_by_day(spark, jobs.stream_rollups(spark, sf))


@register("stream_dashboard_last_hour", "A10 (incremental)", with_model("""
SELECT merchant_category, COUNT(*) AS txns, CAST(SUM(CAST(is_fraud AS INTEGER)) AS BIGINT) AS fraud_txns,
       CAST(SUM(CASE WHEN is_fraud THEN CAST(round(amount * 100) AS BIGINT) ELSE 0 END) AS BIGINT) / 100e0 AS fraud_amount
FROM model WHERE event_us // 60000000 > (SELECT MAX(event_us) // 60000000 FROM model) - 60 GROUP BY 1"""))
def q_stream_dashboard_last_hour(spark, sf):
    return rollups.categories_last_hour(spark, jobs.stream_rollups(spark, sf))


@register("stream_dashboard_heatmap", "A9 (incremental)", with_model("""
SELECT floor(location_lat) AS cell_lat, floor(location_lon) AS cell_lon, COUNT(*) AS txns,
       CAST(SUM(CAST(is_fraud AS INTEGER)) AS BIGINT) AS fraud_txns,
       CAST(SUM(CAST(round(amount * 100) AS BIGINT)) AS BIGINT) / 100e0 AS amount_total FROM model GROUP BY 1, 2"""))
def q_stream_dashboard_heatmap(spark, sf):
    return rollups.heatmap(spark, jobs.stream_rollups(spark, sf))


@register("stream_dashboard_card_hours", "A4 (incremental)", with_model("""
SELECT card_id, event_us - event_us % 3600000000 AS window_start_us, COUNT(*) AS txns,
       CAST(SUM(CAST(round(amount * 100) AS BIGINT)) AS BIGINT) / (100e0 * COUNT(*)) AS avg_amount FROM model GROUP BY 1, 2"""))
def q_stream_dashboard_card_hours(spark, sf):
    """All hours, the open ones too; the windowed stream writes closed ones only."""
    return rollups.card_hours(spark, jobs.stream_rollups(spark, sf))


@register("stream_enriched_table", "S8 T6", with_model("""
SELECT transaction_id, card_id, event_us, amount, CAST(make_timestamp(event_us) AS DATE) AS event_date FROM model"""))
def q_stream_enriched_table(spark, sf):
    t = jobs.stream_enriched_table(spark, sf, date(2024, 1, 20))
    return t.select("transaction_id", "card_id", F.unix_micros("timestamp").alias("event_us"), "amount", "event_date")


_REPLAY_FROM = datetime(2024, 1, 10, 6, 30, tzinfo=timezone.utc)


@register("replay_from_offset", "S2 (start positions)", with_model(f"""
SELECT * FROM (SELECT CAST(n % 3 AS INTEGER) AS partition, row_number() OVER (PARTITION BY n % 3 ORDER BY event_us, transaction_id) - 1 AS "offset", transaction_id, event_us
               FROM (SELECT *, CAST('0x' || substr(transaction_id, 5) AS BIGINT) AS n FROM model) k) o
WHERE event_us >= {int(_REPLAY_FROM.timestamp()) * 1_000_000}"""))
def q_replay_from_offset(spark, sf):
    """Messages of an instant and after, by their (partition, offset)."""
    t = jobs.replay_from_offset(spark, sf, _REPLAY_FROM)
    return t.select("partition", "offset", F.col("key").cast("string").alias("transaction_id"), F.unix_micros("timestamp").alias("event_us"))


@register("stream_static_enrich", "T10 J2", with_model(
    "SELECT transaction_id, card_id, amount, segment, home FROM model"))
def q_stream_static_enrich(spark, sf):
    return jobs.stream_static_enrich(spark, sf)


@register("stream_hourly_join", "J1 (stream-stream) T3", with_model(f"""
SELECT m.transaction_id, m.card_id, w.window_start_us, m.amount, w.txns_in_hour, w.cents / 100e0 AS spend_in_hour
FROM (SELECT *, event_us - event_us % 3600000000 AS ws FROM model) m
JOIN (SELECT card_id, event_us - event_us % 3600000000 AS window_start_us, COUNT(*) AS txns_in_hour,
             SUM(CAST(round(amount * 100) AS BIGINT)) AS cents
      FROM model GROUP BY 1, 2) w ON m.card_id = w.card_id AND m.ws = w.window_start_us
WHERE w.window_start_us + 3600000000 <= {_END}"""))
def q_stream_hourly_join(spark, sf):
    return jobs.stream_hourly_join(spark, sf)


@register("stream_three_outputs", "S9 S8", with_model("SELECT transaction_id, card_id, event_us, amount FROM model"))
def q_stream_three_outputs(spark, sf):
    return jobs.stream_three_outputs(spark, sf).select(
        "transaction_id", "card_id", F.unix_micros("timestamp").alias("event_us"), "amount")


_STREAM_RULES = {"over_average": "COALESCE(over_3x_avg, false)", "zscore": "COALESCE(amount_zscore > 3, false)",
                 "new_device": "(is_new_device AND amount > 100)",
                 "spend_spike": "(is_new_merchant AND amount > 0.01e0 * avg_monthly_spend)",
                 "near_limit": "(card_limit > 0 AND amount >= 0.001e0 * card_limit)"}

#: Flagged rows whose ten minutes end before the last watermark.
_STREAM_ALERTS = f"""
SELECT printf('txn_%012x', transaction_id) AS transaction_id, printf('card_%05d', card_id) AS card_id,
       t_us - 19800000000 AS event_us, amount, prior_txn_count, prior_avg_amount, amount_zscore,
       (before_c + today_c) / (100e0 * (before_n + today_n)) AS avg_amount_30d,
       concat_ws(',', {", ".join(f"CASE WHEN {v} THEN '{k}' END" for k, v in _STREAM_RULES.items())}) AS rules
FROM (SELECT *, CAST(SUM(cents) OVER today AS BIGINT) AS today_c, COUNT(*) OVER today AS today_n,
             COALESCE(CAST(SUM(cents) OVER earlier AS BIGINT), 0) AS before_c, COUNT(*) OVER earlier AS before_n
      FROM (SELECT *, (t_us - 19800000000) // 86400000000 AS day FROM feat) d
      WINDOW today AS (PARTITION BY card_id, day ORDER BY ts, transaction_id ROWS UNBOUNDED PRECEDING),
             earlier AS (PARTITION BY card_id ORDER BY day RANGE BETWEEN 29 PRECEDING AND 1 PRECEDING)) w
WHERE ({" OR ".join(_STREAM_RULES.values())})
  AND (t_us - 19800000000) // 600000000 * 600000000 + 600000000 <= (SELECT MAX(t_us) FROM feat) - 19800000000 - 1800000000"""

_STREAM_THRESHOLDS = {"spend_multiple": 0.01, "limit_ratio": 0.001}  # as in the batch catalogue


def _alert_columns(df):
    return df.select("transaction_id", "card_id", F.col("t_us").alias("event_us"), "amount", "prior_txn_count",
                     "prior_avg_amount", "amount_zscore", "avg_amount_30d", "rules")


@register("stream_alerts", "T5 D1 D5 D8 D10 D11 (stream)", with_feat(_STREAM_ALERTS))
def q_stream_alerts(spark, sf):
    """Detectors on keyed state with event-time timers; equal to the batch definitions."""
    return _alert_columns(jobs.stream_alerts(spark, sf, **_STREAM_THRESHOLDS))


@register("stream_fraud_alerts", "S9", with_feat(_STREAM_ALERTS))
def q_stream_fraud_alerts(spark, sf):
    return _alert_columns(jobs.stream_fraud_alerts(spark, sf, **_STREAM_THRESHOLDS))


@register("stream_test_then_big", "J9 J10 D7 (stream-stream)", with_model("""
SELECT b.transaction_id, b.card_id, b.event_us, b.amount, s.transaction_id AS small_id, s.event_us AS small_us, s.amount AS small_amount
FROM model b JOIN model s ON b.card_id = s.card_id AND b.transaction_id <> s.transaction_id
     AND s.event_us BETWEEN b.event_us - 86400000000 AND b.event_us
WHERE b.amount >= 100 AND s.amount BETWEEN 5 AND 20"""))
def q_stream_test_then_big(spark, sf):
    # published: 50-200, then 20,000, within the hour; the driver's amounts and rates are far smaller
    return jobs.stream_test_then_big(spark, sf, small_lo=5.0, small_hi=20.0, big=100.0, within="24 hours")


@register("stream_processing_stats", "S9", with_model("""
SELECT COUNT(*) AS total_rows, CAST(SUM(CAST(is_fraud AS INTEGER)) AS BIGINT) AS fraud_rows,
       MIN(event_us) AS first_event_us, MAX(event_us) AS last_event_us FROM model"""))
def q_stream_processing_stats(spark, sf):
    """The per-batch statistics table, totalled over its batches."""
    s = jobs.stream_three_outputs(spark, sf, table="processing_stats")
    return s.agg(F.sum("rows").alias("total_rows"), F.sum("fraud_rows").alias("fraud_rows"),
                 F.min(F.unix_micros("min_event_time")).alias("first_event_us"),
                 F.max(F.unix_micros("max_event_time")).alias("last_event_us"))


@register("stream_impossible_travel_any", "J9 (stream-stream)", with_model(f"""
SELECT * FROM (SELECT t.transaction_id, t.card_id, t.event_us, e.transaction_id AS earlier_id,
                      {haversine_sql('e.location_lat', 'e.location_lon', 't.location_lat', 't.location_lon')} AS km
               FROM model t JOIN model e ON t.card_id = e.card_id AND e.event_us < t.event_us AND e.event_us >= t.event_us - 1800000000) p
WHERE km > 500"""))
def q_stream_impossible_travel_any(spark, sf):
    return jobs.stream_far_pairs(spark, sf)


# ---------------------------------------------------------------------------
# amount expectations and bands
# ---------------------------------------------------------------------------

_CAT_RANGES = "(VALUES " + ", ".join(
    f"('{c[0]}', {c[2]}, {c[3]})" for c in dims.MERCHANT_CATEGORIES
) + ") AS r(merchant_category, amount_min, amount_max)"


@register("amount_expectation", "X5 X6 F6 J3", with_model(f"""
SELECT transaction_id, merchant_category, amount, expected_amount, amount_cap, amount > amount_cap AS above_cap,
       CASE WHEN ratio IS NULL THEN NULL WHEN ratio < 0.15e0 THEN 'lt_0.15' WHEN ratio < 0.4e0 THEN '0.15_0.4'
            WHEN ratio < 0.8e0 THEN '0.4_0.8' WHEN ratio <= 2.0e0 THEN '0.8_2.0' ELSE 'gt_2.0' END AS spend_band,
       CASE WHEN amount < 50 THEN 'test_1_50' WHEN amount < 500 THEN 'small_50_500'
            WHEN amount <= 2000 THEN 'mid_500_2000' ELSE 'large' END AS amount_band,
       amount / NULLIF(CAST(card_limit AS DOUBLE), 0e0) AS limit_ratio
FROM (SELECT m.*, sqrt(CAST(r.amount_min * r.amount_max AS DOUBLE)) * f AS expected_amount,
             r.amount_max * f AS amount_cap, amount / NULLIF(CAST(avg_monthly_spend AS DOUBLE), 0e0) AS ratio
      FROM (SELECT *, CASE WHEN monthly_income / 150000e0 > 2.0e0 THEN 2.0e0
                           WHEN monthly_income / 150000e0 < 0.15e0 THEN 0.15e0
                           ELSE monthly_income / 150000e0 END AS f FROM model) m
      JOIN {_CAT_RANGES} ON m.merchant_category = r.merchant_category) x"""))
def q_amount_expectation(spark, sf):
    from ..functions import scalars as sc
    m = model_records(spark, sf)
    ranges = F.broadcast(dims.merchant_category_df(spark).select(
        F.col("category").alias("merchant_category"), "amount_min", "amount_max"))
    j = m.join(ranges, "merchant_category")
    return j.select(
        "transaction_id", "merchant_category", "amount",
        sc.expected_amount("amount_min", "amount_max", "monthly_income").alias("expected_amount"),
        sc.amount_cap("amount_max", "monthly_income").alias("amount_cap"),
        (F.col("amount") > sc.amount_cap("amount_max", "monthly_income")).alias("above_cap"),
        sc.spend_ratio_band("amount", "avg_monthly_spend").alias("spend_band"),
        sc.absolute_amount_band("amount").alias("amount_band"),
        sc.limit_ratio("amount", "card_limit").alias("limit_ratio"))


@register("enriched_table_sink", "S8 (enriched table, date-partitioned; partition pruning)", with_feat("""
SELECT transaction_id, card_id, CAST(ts AS DATE) AS event_date, transactions_last_24hr,
       distance_from_last_txn_km, amount_zscore
FROM feat WHERE CAST(ts AS DATE) >= DATE '2024-01-15'"""))
def q_enriched_table_sink(spark, sf):
    """Per-card features written as the enriched-transactions table,
    partitioned by event date; the read-back filters a date range, which
    Spark answers from the matching partition folders only."""
    from ..operators.features import card_features
    from ..sources.tables import transactions
    path = shared_path(spark, "sinks", "enriched")
    f = card_features(transactions(spark, sf)).withColumn("event_date", F.to_date("ts"))
    sinks.write_partitioned(f, path, "event_date")
    back = spark.read.parquet(path).filter(F.col("event_date") >= F.lit("2024-01-15").cast("date"))
    return back.select("transaction_id", "card_id", "event_date", "transactions_last_24hr",
                       "distance_from_last_txn_km", "amount_zscore")
