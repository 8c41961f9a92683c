"""Dashboard and monitoring aggregates (grouped aggregations only).

Every operator here is a ``groupBy`` whose partial aggregation runs before
the shuffle, so hot keys cost one combined row per task; dimension tables
joined here are fixed-size (≤ 24 rows) and broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import dimensions as dims
from ..functions.scalars import epoch_micros, local_hour
from .features import cents


def fraud_rate_over_time(txn: DataFrame, every: str = "1 day") -> DataFrame:            # A6
    return (txn.groupBy(F.window("ts", every).alias("w"))
            .agg(F.count(F.lit(1)).alias("txns"),
                 F.sum(F.col("is_fraud").cast("bigint")).alias("fraud_txns"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "txns", "fraud_txns", (F.col("fraud_txns") / F.col("txns")).alias("fraud_rate")))


def fraud_by_type(labelled: DataFrame) -> DataFrame:                                     # A7
    return (labelled.filter(F.col("is_fraud"))
            .groupBy("fraud_type")
            .agg(F.count(F.lit(1)).alias("txns"), (F.sum(cents()) / 100.0).alias("amount_total")))


def amount_distribution(txn: DataFrame, bin_width: float = 10.0) -> DataFrame:          # A8
    b = F.floor(F.col("amount") / bin_width).cast("bigint")
    return (txn.groupBy(b.alias("bin"))
            .agg(F.count(F.lit(1)).alias("txns"),
                 F.sum(F.col("is_fraud").cast("bigint")).alias("fraud_txns"),
                 F.min("amount").alias("min_amount"), F.max("amount").alias("max_amount"))
            .withColumn("bin_lo", F.col("bin") * F.lit(bin_width)))


def amount_quantiles(txn: DataFrame, probs=(0.5, 0.9, 0.99), accuracy: int = 10000) -> DataFrame:  # A8
    """Approximate quantiles per category (bounded-memory sketch)."""
    return txn.groupBy("merchant_category").agg(
        *[F.percentile_approx("amount", p, accuracy).alias(f"p{int(round(p * 100))}") for p in probs])


def geo_heatmap(txn: DataFrame, cell_deg: float = 1.0) -> DataFrame:                   # A9
    return (txn.groupBy((F.floor(F.col("lat") / cell_deg) * cell_deg).alias("cell_lat"),
                        (F.floor(F.col("lon") / cell_deg) * cell_deg).alias("cell_lon"))
            .agg(F.count(F.lit(1)).alias("txns"),
                 F.sum(F.col("is_fraud").cast("bigint")).alias("fraud_txns"),
                 (F.sum(cents()) / 100.0).alias("amount_total")))


def fraud_by_category_last_hour(txn: DataFrame) -> DataFrame:                           # A10
    """Totals by category over the last hour of data (relative to max ts)."""
    latest = txn.select(F.max("ts")).scalar()
    recent = txn.filter(F.col("ts") >= latest - F.expr("INTERVAL 1 HOUR"))
    return (recent.groupBy("merchant_category")
            .agg(F.count(F.lit(1)).alias("txns"),
                 F.sum(F.col("is_fraud").cast("bigint")).alias("fraud_txns"),
                 (F.sum(F.when(F.col("is_fraud"), cents()).otherwise(0)) / 100.0).alias("fraud_amount")))


def processing_stats(txn: DataFrame) -> DataFrame:                                      # A11
    """Totals, fraud share and event-time throughput (zero-guarded as max(x, 1))."""
    # whole elapsed seconds, from microseconds (not second boundaries crossed)
    t = F.floor((F.max(epoch_micros("ts")) - F.min(epoch_micros("ts"))) / 1_000_000).cast("bigint")
    return txn.agg(
        F.count(F.lit(1)).alias("total_txns"),
        F.sum(F.col("is_fraud").cast("bigint")).alias("fraud_txns"),
        (F.sum(F.col("is_fraud").cast("bigint")) * 100.0 / F.greatest(F.count(F.lit(1)), F.lit(1))).alias("fraud_pct"),
        t.alias("duration_sec"),
        (F.count(F.lit(1)) / F.greatest(t, F.lit(1))).alias("txns_per_sec"))


def cards_per_device(txn: DataFrame, min_cards: int = 1) -> DataFrame:                  # A13
    """Distinct cards per device (device stands in for shipping address)."""
    pairs = txn.groupBy("device_id", "card_id").agg(F.count(F.lit(1)).alias("n"))
    return (pairs.groupBy("device_id")
            .agg(F.count(F.lit(1)).alias("cards"), F.sum("n").alias("txns"))
            .filter(F.col("cards") >= min_cards))


def balance_segment(col: str = "c_acctbal"):
    """Income band of a customer from its balance (``dims.BALANCE_BANDS``)."""
    c = F.col(col)
    expr = None
    for name, lo, hi in dims.BALANCE_BANDS:
        cond = (c < hi) if hi is not None else F.lit(True)
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return expr


def profile_segments(spark: SparkSession, customers: DataFrame) -> DataFrame:          # A14
    """Customers per income band vs the configured profile weights."""
    seg = customers.groupBy(balance_segment().alias("profile")).agg(F.count(F.lit(1)).alias("cards"))
    total = Window.partitionBy()  # over ≤ 4 aggregated rows
    prof = F.broadcast(dims.profile_df(spark).select("profile", F.col("weight").alias("configured_share")))
    return (seg.withColumn("observed_share", F.col("cards") / F.sum("cards").over(total))
            .join(prof, "profile", "left"))


def taxonomy_drift(spark: SparkSession, labelled: DataFrame) -> DataFrame:              # A15
    """Observed vs configured share of each fraud type, with a chi-square term."""
    fraud = labelled.filter(F.col("is_fraud"))
    obs = fraud.groupBy("fraud_type").agg(F.count(F.lit(1)).alias("observed"))
    total = Window.partitionBy()  # ≤ 5 aggregated rows
    cfg = F.broadcast(dims.fraud_type_df(spark).withColumnRenamed("weight", "configured_share"))
    j = cfg.join(obs, "fraud_type", "left").withColumn("observed", F.coalesce("observed", F.lit(0)))
    n = F.sum("observed").over(total)
    expected = F.col("configured_share") * n
    # ANSI mode raises on x / 0: a table without fraud gives NULL shares instead
    return j.select("fraud_type", "configured_share", "observed",
                    (F.col("observed") / F.nullif(n, F.lit(0))).alias("observed_share"),
                    expected.alias("expected"),
                    (F.pow(F.col("observed") - expected, 2) / F.nullif(expected, F.lit(0.0))).alias("chi2_term"))


def share_drift(spark: SparkSession, values: DataFrame, configured) -> DataFrame:      # A15
    """Observed share of each configured ``(value, share)``; ``values`` has one column, ``value``."""
    cfg = spark.createDataFrame([(n, float(w)) for n, w in configured], "value string, configured_share double")
    obs = values.groupBy("value").agg(F.count(F.lit(1)).alias("n_seen"))
    j = F.broadcast(cfg).join(obs, "value", "left").withColumn("observed", F.coalesce("n_seen", F.lit(0)))
    total = F.sum("observed").over(Window.partitionBy())       # as many rows as configured values
    return j.select("value", "configured_share", "observed", (F.col("observed") / F.nullif(total, F.lit(0))).alias("observed_share"))


def hourly_volume_vs_expected(spark: SparkSession, txn: DataFrame) -> DataFrame:        # A16
    """Per local hour: observed share of volume vs the traffic curve's share."""
    by_hour = txn.groupBy(local_hour("ts").alias("hour")).agg(F.count(F.lit(1)).alias("txns"))
    curve = F.broadcast(dims.hourly_rate_df(spark))
    total_mult = sum(dims.HOURLY_MULTIPLIERS)
    total = Window.partitionBy()  # ≤ 24 aggregated rows
    return (curve.join(by_hour, "hour", "left").withColumn("txns", F.coalesce("txns", F.lit(0)))
            .withColumn("observed_share", F.col("txns") / F.sum("txns").over(total))
            .withColumn("expected_share", F.col("multiplier") / F.lit(total_mult))
            .withColumn("ratio", F.col("observed_share") / F.col("expected_share")))


def burst_windows(spark: SparkSession, txn: DataFrame, every: str = "10 minutes",
                  min_ratio: float = 3.0) -> DataFrame:                                  # A17
    """Windows (10 minutes) whose volume is ``min_ratio`` × the curve's expectation.

    Expected per window = daily volume ÷ 13.74 × multiplier[hour] ÷ windows an
    hour, where daily volume is the observed mean per distinct day.
    """
    per_hour = 60.0 / int(every.split()[0]) if every.split()[1].startswith("minute") else 1.0
    counts = (txn.groupBy(F.window("ts", every).alias("w")).agg(F.count(F.lit(1)).alias("txns"))
              .select(F.col("w.start").alias("window_start"), "txns"))
    # scalar subquery (one aggregated value), evaluated by Spark, not the driver
    daily = txn.select(F.count(F.lit(1)) / F.count_distinct(F.to_date("ts"))).scalar()
    curve = F.broadcast(dims.hourly_rate_df(spark))
    total_mult = sum(dims.HOURLY_MULTIPLIERS)
    return (counts.join(curve, F.hour("window_start") == curve.hour)
            .withColumn("expected", daily / F.lit(total_mult) * F.col("multiplier") / F.lit(per_hour))
            .withColumn("ratio", F.col("txns") / F.col("expected"))
            .filter(F.col("ratio") >= min_ratio)
            .select("window_start", "hour", "txns", "expected", "ratio"))


def burst_episodes(spark: SparkSession, txn: DataFrame, every_minutes: int = 10, min_ratio: float = 3.0) -> DataFrame:  # A17
    """Runs of adjacent hot windows: start, end, duration, volume and the highest ratio.

    A run goes on across hour and day borders and ends at the first window
    that is not hot.  The windows with a total order see one aggregated row
    per hot ``every_minutes`` of time, never transactions.
    """
    hot = burst_windows(spark, txn, f"{every_minutes} minutes", min_ratio).withColumn("start_us", epoch_micros("window_start"))
    step = F.lit(every_minutes * 60_000_000)
    order = Window.orderBy("start_us")          # at most 1,440 / every_minutes rows a day
    starts = F.coalesce((F.col("start_us") - F.lag("start_us").over(order) != step).cast("int"), F.lit(1))
    runs = hot.withColumn("begins", starts).withColumn("episode", F.sum("begins").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return (runs.groupBy("episode")
            .agg(F.min("start_us").alias("start_us"), (F.max("start_us") + step).alias("end_us"),
                 (F.count(F.lit(1)) * every_minutes).alias("duration_minutes"), F.sum("txns").alias("txns"),
                 F.sum("expected").alias("expected"), F.max("ratio").alias("peak_ratio"))
            .drop("episode"))


def card_habits(txn: DataFrame) -> DataFrame:                                           # A19
    """Share of each card's transactions at home, in preferred categories, online."""
    from .rules import preferred_expr
    pref = F.coalesce(F.array_contains(preferred_expr(), F.col("merchant_category")), F.lit(False))
    return txn.groupBy("card_id").agg(
        F.count(F.lit(1)).alias("txns"),
        F.avg((F.col("geo") == F.col("home")).cast("double")).alias("home_share"),
        F.avg(pref.cast("double")).alias("preferred_share"),
        F.avg(F.col("is_online").cast("double")).alias("online_share"))


def spend_trend(txn: DataFrame, min_weeks: int = 3) -> DataFrame:                       # A18
    """Least-squares slope of weekly spend per card (week index from 2024-01-01)."""
    week = F.floor(F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")) / 7).cast("int")
    weekly = txn.groupBy("card_id", week.alias("week")).agg((F.sum(cents()) / 100.0).alias("spend"))
    return (weekly.groupBy("card_id")
            .agg(F.count(F.lit(1)).alias("weeks"),
                 F.regr_slope("spend", F.col("week").cast("double")).alias("weekly_slope"),
                 F.avg("spend").alias("avg_weekly_spend"))
            .filter(F.col("weeks") >= min_weeks))


def top_risky_cards(alerts: DataFrame, n: int = 20) -> DataFrame:                      # O3
    return (alerts.groupBy("card_id").agg(F.count(F.lit(1)).alias("alerts"),
                                          F.max("ts").alias("last_alert_ts"))
            .orderBy(F.col("alerts").desc(), F.col("card_id")).limit(n))


def live_alerts(alerts: DataFrame, n: int = 50) -> DataFrame:                          # O1
    return alerts.orderBy(F.col("ts").desc(), F.col("transaction_id"), F.col("rule")).limit(n)
