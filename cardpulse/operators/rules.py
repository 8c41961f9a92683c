"""Rule-based and statistical detectors over the per-card features.

Each ``flag_*`` returns a boolean Column over a ``card_features`` frame;
each ``rule_*`` returns the alert rows for one detector.  Every threshold is
a parameter; defaults are the published ones (amount > 3x the card's
average; more than 5 in 10 minutes; 500 km within 30 minutes; 01:00-05:00
local with amount > 500; z > 3).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..dimensions import SEGMENT_PREFERRED
from ..functions.scalars import epoch_micros, local_hour
from .dashboards import spend_trend
from .features import card_features
from .timeline import HOUR_US, MINUTE_US, sequence_features

ALERT_COLUMNS = ("transaction_id", "card_id", "ts", "amount")


def flag_amount_3x(f: DataFrame) -> Column:                          # D1
    return F.coalesce(F.col("over_3x_avg"), F.lit(False))


def flag_impossible_travel(f: DataFrame, km: float = 500.0, minutes: float = 30.0) -> Column:  # D3
    return F.coalesce((F.col("distance_from_last_txn_km") > km)
                      & (F.col("minutes_since_last_txn") <= minutes), F.lit(False))


def flag_odd_hour(f: DataFrame, amount: float = 500.0, start: int = 1, end: int = 5) -> Column:  # D4
    h = local_hour("ts")
    return (h >= start) & (h < end) & (F.col("amount") > amount)


def flag_zscore(f: DataFrame, z: float = 3.0) -> Column:             # D5
    return F.coalesce(F.col("amount_zscore") > z, F.lit(False))


def flag_near_limit(f: DataFrame, ratio: float = 0.6, limit_col: str = "card_limit") -> Column:  # D10
    lim = F.col(limit_col)
    return F.coalesce((lim > 0) & (F.col("amount") >= F.lit(ratio) * lim), F.lit(False))


def flag_new_device_high_value(f: DataFrame, amount: float = 100.0) -> Column:  # D11
    return F.col("is_new_device") & (F.col("amount") > amount)


def flag_unusual_geo(f: DataFrame) -> Column:                        # D12
    return F.col("is_new_geo") & (F.col("geo") != F.col("home"))


def flag_high_value_category(f: DataFrame, category: str = "error", amount: float = 100.0) -> Column:  # D13
    return (F.col("merchant_category") == category) & (F.col("amount") > amount)


def preferred_expr(segment_col: str = "segment") -> Column:
    """The card's preferred categories from its segment (fixed 5-row map)."""
    m = F.create_map(*[x for seg, cats in SEGMENT_PREFERRED for x in (F.lit(seg), F.array(*map(F.lit, cats)))])
    return m[F.col(segment_col)]


def flag_unusual_category(f: DataFrame) -> Column:                   # J6 as a predicate
    return ~F.coalesce(F.array_contains(preferred_expr(), F.col("merchant_category")), F.lit(False))


def flag_spend_spike(f: DataFrame, multiple: float = 3.0) -> Column:  # D8
    """Far over the card-holder's usual monthly spend, at a merchant and in a category new to the card."""
    big = F.coalesce(F.col("amount") > F.lit(multiple) * F.col("avg_monthly_spend"), F.lit(False))
    return big & F.col("is_new_merchant") & flag_unusual_category(f)


def alerts(f: DataFrame, flag: Column, rule: str, *evidence: str) -> DataFrame:
    return f.filter(flag).select(*ALERT_COLUMNS, F.lit(rule).alias("rule"), *evidence)


# ---------------------------------------------------------------------------
# detectors that need their own frame widths
# ---------------------------------------------------------------------------

def velocity_counts(txn: DataFrame, window_minutes: int = 10) -> DataFrame:
    """Trailing count over ``[t - window, t]`` per card (bucket = window)."""
    w = window_minutes * MINUTE_US
    f = sequence_features(txn, frames={"w": w}, sums={"n": F.lit(1).cast("bigint")}, bucket_us=w)
    return f.withColumnRenamed("n_w", "txns_in_window")


def rule_velocity(txn: DataFrame, max_count: int = 5, window_minutes: int = 10) -> DataFrame:  # D2
    """More than ``max_count`` transactions of a card within ``window_minutes``."""
    v = velocity_counts(txn, window_minutes)
    return v.filter(F.col("txns_in_window") > max_count).select(*ALERT_COLUMNS, "txns_in_window")


def rule_test_then_big(txn: DataFrame, small_lo: float = 50.0, small_hi: float = 200.0,
                       big: float = 20000.0, within_minutes: int = 60) -> DataFrame:  # D7 / J10
    """A large amount preceded on the same card by a small 'test' amount
    within ``within_minutes`` (inclusive).  Exists-test via a trailing count
    of small rows, so no pairs are materialised."""
    w = within_minutes * MINUTE_US
    bucket = w if w % HOUR_US else HOUR_US
    is_small = ((F.col("amount") >= small_lo) & (F.col("amount") <= small_hi)).cast("bigint")
    f = sequence_features(txn, frames={"w": w}, sums={"small": is_small}, bucket_us=bucket)
    return (f.filter((F.col("amount") >= big) & (F.col("small_w") > 0))
            .select(*ALERT_COLUMNS, F.col("small_w").alias("small_before")))


def card_testing_counts(txn: DataFrame, small_max: float = 50.0, within_minutes: int = 60) -> DataFrame:  # A12 / D9 support
    """Per small payment: small payments and distinct merchants of its card in
    ``[t - within, t]``, peers at ``t`` included.

    A payment repeats its merchant while the merchant's previous small payment
    is inside the frame, that is from its own time until the previous one
    leaves; distinct merchants = payments - repeats.  Both are sums of +1 / -1
    steps on the card's time line, so a running sum answers them: per
    (card, frame-wide bucket) inside, plus the sum of all earlier buckets from
    a small per-bucket aggregate.  No pairs are built and a hot card is split
    by its buckets.
    """
    w = within_minutes * MINUTE_US
    small = (txn.filter(F.col("amount") <= small_max)
             .select(*ALERT_COLUMNS, "merchant_name", epoch_micros("ts").alias("t_us")))
    own = Window.partitionBy("card_id", "merchant_name").orderBy("t_us", "transaction_id")
    small = small.withColumn("before", F.lag("t_us").over(own))
    again = F.col("t_us") - F.col("before") <= w
    gone = F.col("t_us") + F.lit(w + 1)          # first instant at which t is out of the frame
    steps = F.array(
        F.struct(F.col("t_us").alias("at"), F.lit(1).alias("n"), F.when(again, 1).otherwise(0).alias("r"), F.lit(True).alias("asks")),
        F.struct(gone.alias("at"), F.lit(-1).alias("n"), F.lit(0).alias("r"), F.lit(False).alias("asks")),
        F.when(again, F.struct((F.col("before") + F.lit(w + 1)).alias("at"), F.lit(0).alias("n"), F.lit(-1).alias("r"),
                               F.lit(False).alias("asks"))))
    line = (small.select(*ALERT_COLUMNS, F.explode(steps).alias("s")).filter("s is not null")
            .select(*ALERT_COLUMNS, "s.*").withColumn("bucket", F.floor(F.col("at") / F.lit(w))))
    earlier = Window.partitionBy("card_id").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = (line.groupBy("card_id", "bucket").agg(F.sum("n").alias("n"), F.sum("r").alias("r"))
            .select("card_id", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n0"),
                    F.coalesce(F.sum("r").over(earlier), F.lit(0)).alias("r0")))
    upto = Window.partitionBy("card_id", "bucket").orderBy("at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    run = line.withColumn("n1", F.sum("n").over(upto)).withColumn("r1", F.sum("r").over(upto)).filter("asks")
    found = run.join(base, ["card_id", "bucket"])
    count = F.col("n0") + F.col("n1")
    return found.select(*ALERT_COLUMNS, count.alias("small_txns"),
                        (count - F.col("r0") - F.col("r1")).alias("distinct_merchants"))


def rule_card_testing(txn: DataFrame, min_txns: int = 5, small_max: float = 50.0,
                      within_minutes: int = 60) -> DataFrame:  # D9
    """Small payments that are at least the ``min_txns``-th, at as many merchants, within the trailing frame."""
    c = card_testing_counts(txn, small_max, within_minutes)
    return c.filter((F.col("small_txns") >= min_txns) & (F.col("distinct_merchants") >= min_txns))


def rule_spend_trend(txn: DataFrame, min_rise: float = 0.25, min_weeks: int = 3) -> DataFrame:  # D14
    """Cards whose weekly spend rises by more than ``min_rise`` of its average per week."""
    t = spend_trend(txn, min_weeks)
    return t.filter(F.col("weekly_slope") > F.lit(min_rise) * F.col("avg_weekly_spend"))


def rule_set(odd_hour_amount: float = 500.0, limit_ratio: float = 0.6, spend_multiple: float = 3.0) -> dict:
    """Row-predicate detectors at the published thresholds; lower ones
    suit tables whose amounts are small."""
    return {
        "amount_3x": flag_amount_3x,
        "impossible_travel": flag_impossible_travel,
        "odd_hour": lambda f: flag_odd_hour(f, amount=odd_hour_amount),
        "zscore": flag_zscore,
        "near_limit": lambda f: flag_near_limit(f, ratio=limit_ratio),
        "new_device_high_value": flag_new_device_high_value,
        "unusual_geo": flag_unusual_geo,
        "high_value_category": flag_high_value_category,
        "spend_spike": lambda f: flag_spend_spike(f, multiple=spend_multiple),
    }


RULES = rule_set()


def all_flags(txn: DataFrame, rules: dict = RULES, **features) -> DataFrame:
    """Feature rows plus one boolean per rule and their sum (D15); ``features``: options of ``card_features``."""
    f = card_features(txn, **features)
    flags = {f"flag_{k}": fn(f) for k, fn in rules.items()}
    f = f.withColumns(flags)
    score = sum((F.col(c).cast("int") for c in flags), F.lit(0))
    return f.withColumn("signal_count", score)
