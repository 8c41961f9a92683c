"""Catalogue entries over injected fraud labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import dimensions as dims
from ..functions.scalars import complexity_band
from ..operators import dashboards as dash
from ..operators import rules
from ..operators.inject import inject_fraud, inject_sql, profile_of
from ..sources.model import model_records
from ..sources.tables import monthly_income, transactions
from .catalog import RULES, _quality, register
from .catalog_streams import CITY_LIST
from .oracle_sql import FEAT_CTE, RULE_SQL, with_txn

INJ_SRC_TEMPLATE = """
inj_src AS (
  SELECT printf('txn_%012x', transaction_id) AS transaction_id, transaction_id AS source_id, ts AS source_ts,
         card_id AS card_num, amount, merchant_name,
         CASE merchant_category WHEN 'purchase' THEN 'online_retail' WHEN 'view' THEN 'entertainment'
              WHEN 'click' THEN 'dining' WHEN 'signup' THEN 'utilities' WHEN 'error' THEN 'electronics' END
           AS merchant_category,
         is_online,
         ['mobile', 'desktop', 'pos_terminal', 'tablet'][k % 4 + 1] AS device_type,
         ['app', 'mobile_wallet', 'web', 'in_store'][CAST(floor(k / 4) AS INTEGER) % 4 + 1] AS channel,
         {CITY_LIST}[geo % 12 + 1] AS city,
         LAG({CITY_LIST}[geo % 12 + 1]) OVER (PARTITION BY card_id ORDER BY ts, transaction_id) AS prev_city,
         lat AS location_lat, lon AS location_lon,
         CAST(round((acctbal + 1000) * 20) AS INTEGER) AS monthly_income,
         CAST(round(CAST(round((acctbal + 1000) * 20) AS INTEGER) * 0.3e0) AS INTEGER) AS avg_monthly_spend,
         CAST(round(greatest(acctbal, 0) * 100) AS INTEGER) AS card_limit
  FROM {src}
)"""


def inj_cte(src: str = "txn") -> str:
    return (INJ_SRC_TEMPLATE.replace("{CITY_LIST}", CITY_LIST).replace("{src}", src)
            + f",\ninj AS ({inject_sql('inj_src')})")


INJ_CTE = inj_cte()

INJ_COLS = ("transaction_id", "is_fraud", "fraud_type", "complexity", "fraud_confidence", "amount",
            "merchant_category", "merchant_name", "city", "location_lat", "location_lon", "is_online",
            "channel", "device_type")


def injected(spark, sf):
    return inject_fraud(model_records(spark, sf, keep_source=True))


@register("inject_fraud", "D17 J5 J6 J8 X6 X7", with_txn(f"SELECT {', '.join(INJ_COLS)} FROM inj", INJ_CTE))
def q_inject_fraud(spark, sf):
    return injected(spark, sf).select(*INJ_COLS)


@register("fraud_by_type", "A7", with_txn("""
SELECT fraud_type, COUNT(*) AS txns, SUM(CAST(round(amount * 100) AS BIGINT)) / 100e0 AS amount_total
FROM inj WHERE is_fraud GROUP BY fraud_type""", INJ_CTE))
def q_fraud_by_type(spark, sf):
    return dash.fraud_by_type(injected(spark, sf))


_TYPE_VALUES = "(VALUES " + ", ".join(f"('{n}', {w!r}e0)" for n, w in dims.FRAUD_TYPES) + ") AS c(fraud_type, configured_share)"


@register("taxonomy_drift", "A15", with_txn(f"""
SELECT fraud_type, configured_share, observed, observed / NULLIF(n, 0) AS observed_share,
       configured_share * n AS expected,
       pow(observed - configured_share * n, 2) / NULLIF(configured_share * n, 0) AS chi2_term
FROM (SELECT c.fraud_type, c.configured_share, COALESCE(o.observed, 0) AS observed,
             SUM(COALESCE(o.observed, 0)) OVER () AS n
      FROM {_TYPE_VALUES} LEFT JOIN (SELECT fraud_type, COUNT(*) AS observed FROM inj WHERE is_fraud
                                     GROUP BY fraud_type) o ON c.fraud_type = o.fraud_type) x""", INJ_CTE))
def q_taxonomy_drift(spark, sf):
    return dash.taxonomy_drift(spark, injected(spark, sf))


def _values(rows) -> str:
    return "(VALUES " + ", ".join(f"('{n}', {float(w)!r}e0)" for n, w in rows) + ") AS c(value, configured_share)"


_DRIFT = {
    "fraud_type": [(n, w) for n, w in dims.FRAUD_TYPES],
    "complexity": [(c[0], c[1]) for c in dims.COMPLEXITY],
    "city": [(c[0], c[3]) for c in dims.CITIES],
    "profile": [(p[0], p[1]) for p in dims.PROFILES],
}
_DRIFT_FROM = {
    "fraud_type": "SELECT fraud_type AS value FROM inj WHERE is_fraud",
    "complexity": "SELECT complexity AS value FROM inj WHERE is_fraud",
    "city": "SELECT city AS value FROM inj_src",
    "profile": ("SELECT CASE WHEN monthly_income >= 150000 THEN 'high_income' WHEN monthly_income >= 40000 THEN 'mid_income' "
                "WHEN monthly_income >= 15000 THEN 'low_income' ELSE 'student' END AS value FROM inj_src"),
}


@register("taxonomy_drift_all", "A15 (four dimensions)", with_txn("\nUNION ALL\n".join(f"""
SELECT '{d}' AS dimension, value, configured_share, observed, observed / NULLIF(n, 0) AS observed_share
FROM (SELECT c.value, c.configured_share, COALESCE(o.observed, 0) AS observed, SUM(COALESCE(o.observed, 0)) OVER () AS n
      FROM {_values(rows)} LEFT JOIN (SELECT value, COUNT(*) AS observed FROM ({_DRIFT_FROM[d]}) v GROUP BY 1) o
           ON c.value = o.value) x""" for d, rows in _DRIFT.items()), INJ_CTE))
def q_taxonomy_drift_all(spark, sf):
    """Observed against configured shares: fraud type and complexity of injected frauds, city and profile of all messages."""
    frauds = injected(spark, sf).filter("is_fraud")
    messages = model_records(spark, sf)
    observed = {"fraud_type": frauds.select(F.col("fraud_type").alias("value")),
                "complexity": frauds.select(F.col("complexity").alias("value")),
                "city": messages.select(F.col("city").alias("value")),
                "profile": messages.select(profile_of(F.col("monthly_income")).alias("value"))}
    found = None
    for name, values in observed.items():
        one = dash.share_drift(spark, values, _DRIFT[name]).select(F.lit(name).alias("dimension"), "*")
        found = one if found is None else found.unionByName(one)
    return found


@register("complexity_mix", "X7 A15", with_txn("""
SELECT complexity, CASE WHEN fraud_confidence >= 0.7e0 THEN 'easy' WHEN fraud_confidence >= 0.4e0 THEN 'medium'
                        ELSE 'hard' END AS band, COUNT(*) AS txns
FROM inj WHERE is_fraud GROUP BY 1, 2""", INJ_CTE))
def q_complexity_mix(spark, sf):
    inj = injected(spark, sf).filter(F.col("is_fraud"))
    return inj.groupBy("complexity", complexity_band("fraud_confidence").alias("band")).agg(
        F.count(F.lit(1)).alias("txns"))


def injected_txn(spark, sf):
    """Adapter-shaped transactions carrying the injected amounts, places,
    merchants and labels, so the detectors can be scored per fraud type.

    The wire fields the injection reads are derived from the same row (no
    join back by id); the event type is kept aside and restored.
    """
    from ..functions.scalars import city_of
    from ..operators.enrich import with_device_channel
    from ..sources.model import model_category
    t = with_device_channel(transactions(spark, sf)).withColumnRenamed("merchant_category", "event_type")
    inp = t.select("*", model_category("event_type").alias("merchant_category"),
                   city_of(F.col("geo") % 12).alias("city"),
                   F.col("lat").alias("location_lat"), F.col("lon").alias("location_lon"),
                   monthly_income("acctbal").alias("monthly_income"))
    inj = inject_fraud(inp, id_col="transaction_id", ts_col="ts")
    cols = transactions(spark, sf).columns
    rename = {"merchant_category": "event_type", "lat": "location_lat", "lon": "location_lon"}
    return inj.select(*[F.col(rename.get(c, c)).alias(c) for c in cols], "fraud_type", "complexity")


_INJ_TXN_SQL = f"""
txn AS (
  SELECT t.transaction_id, t.ts, t.card_id, i.amount, t.merchant_category, t.k, i.merchant_name, t.home, t.geo,
         t.acctbal, t.segment, t.card_limit, t.avg_monthly_spend, i.location_lat AS lat, i.location_lon AS lon, i.is_online, t.device_id,
         i.is_fraud, i.fraud_type, i.complexity
  FROM txn_base t JOIN inj i ON t.transaction_id = i.source_id
)"""


def _with_injected_feat(body: str) -> str:
    from ..sources.tables import TXN_SQL
    return ("WITH txn_base AS (" + TXN_SQL + "),\n" + inj_cte("txn_base").strip() + ",\n"
            + _INJ_TXN_SQL.strip() + ",\n" + FEAT_CTE.strip() + "\n" + body)


_BY_TYPE_UNION = "\nUNION ALL\n".join(
    f"SELECT fraud_type, complexity, '{k}' AS rule, {v} AS flag FROM feat WHERE is_fraud"
    for k, v in RULE_SQL.items())


@register("detector_recall_by_type", "D16 (by type and band)", _with_injected_feat(f"""
SELECT fraud_type, complexity, rule, COUNT(*) AS frauds,
       CAST(SUM(CAST(flag AS INTEGER)) AS BIGINT) AS detected,
       SUM(CAST(flag AS INTEGER)) / COUNT(*) AS recall
FROM ({_BY_TYPE_UNION}) u GROUP BY fraud_type, complexity, rule"""))
def q_detector_recall_by_type(spark, sf):
    f = rules.all_flags(injected_txn(spark, sf), RULES).filter(F.col("is_fraud"))
    names = list(RULES)
    st = f.select("fraud_type", "complexity", F.explode(F.array(*[
        F.struct(F.lit(n).alias("rule"), F.col(f"flag_{n}").alias("flag")) for n in names])).alias("r"))
    return (st.groupBy("fraud_type", "complexity", F.col("r.rule").alias("rule"))
            .agg(F.count(F.lit(1)).alias("frauds"), F.sum(F.col("r.flag").cast("bigint")).alias("detected"))
            .withColumn("recall", F.col("detected") / F.col("frauds")))


@register("injected_detector_quality", "D16 (injected labels)", _with_injected_feat(f"""
SELECT rule, flagged, true_positive, labelled_fraud,
       true_positive / NULLIF(flagged, 0) AS precision, true_positive / NULLIF(labelled_fraud, 0) AS recall
FROM (SELECT rule, CAST(SUM(CAST(flag AS INTEGER)) AS BIGINT) AS flagged,
             CAST(SUM(CAST(flag AND is_fraud AS INTEGER)) AS BIGINT) AS true_positive,
             CAST(SUM(CAST(is_fraud AS INTEGER)) AS BIGINT) AS labelled_fraud
      FROM ({chr(10).join(('UNION ALL ' if i else '') + f"SELECT '{k}' AS rule, {v} AS flag, is_fraud FROM feat" for i, (k, v) in enumerate(RULE_SQL.items()))}) u
      GROUP BY rule) q"""))
def q_injected_quality(spark, sf):
    return _quality(rules.all_flags(injected_txn(spark, sf), RULES))
