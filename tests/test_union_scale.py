"""alerts_union_all at size: J9 reads its payments a few times only, and no frame is built that no rule reads."""

import random
import re
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from cardpulse.functions.geo import haversine_km
from cardpulse.operators import enrich
from cardpulse.plans.catalog import FLAGS_ONLY, RULES, alert_rows
from cardpulse.operators import rules
from cardpulse.sources.tables import transactions
from .conftest import SF001
from .helpers import same_rows

PLACES = ((19.07, 72.87), (28.61, 77.21), (-33.9, 151.2), (51.5, -0.1), (0.2, 179.9), (0.2, -179.9), (89.5, 10.0))


def _payments(spark):
    """Cards with few and with many places in a bucket, near and far, beyond 10,000 km, over the date line, with nulls and repeats."""
    rnd = random.Random(5)
    start = datetime(2024, 1, 1, tzinfo=timezone.utc)
    rows = []
    for card, n, towns, hours in ((1, 60, 2, 12), (2, 300, 2, 1), (3, 120, 4, 3), (4, 80, 1, 1), (5, 60, 7, 2), (6, 25, 7, 1), (7, 40, 2, 1)):
        for _ in range(n):
            lat, lon = PLACES[6 - rnd.randrange(2)] if card == 7 else PLACES[rnd.randrange(towns)]
            at = start + timedelta(microseconds=rnd.randrange(hours * 3_600_000_000))
            rows.append((len(rows), card, at, lat + rnd.uniform(-.3, .3), lon + rnd.uniform(-.3, .3), 1.0))
    rows += rows[40:140:3]
    rows += [(9001, 1, start, None, 72.0, 1.0), (9002, 2, start, 19.0, None, 1.0), (9003, 2, None, 19.0, 72.0, 1.0),
             (9004, None, start, 19.0, 72.0, 1.0), (9005, None, start, 51.0, 0.0, 1.0), (None, 2, start + timedelta(minutes=20), 51.0, 0.0, None)]
    return spark.createDataFrame(rows, "transaction_id bigint, card_id bigint, ts timestamp, lat double, lon double, amount double")


def test_any_earlier_far_place_equals_all_pairs(spark):
    txn = _payments(spark)
    b = txn.selectExpr("card_id", "ts AS b_ts", "lat AS b_lat", "lon AS b_lon")
    want = (txn.join(b, "card_id").filter("b_ts BETWEEN ts - INTERVAL 30 MINUTES AND ts")
            .withColumn("d", haversine_km("b_lat", "b_lon", "lat", "lon", digits=None)).filter("d > 500")
            .groupBy("card_id", "transaction_id", "ts").agg(F.round(F.max("d"), 2).alias("max_km_within_window"), F.max("amount").alias("amount")))
    ok, n, m = same_rows(enrich.impossible_travel_any(txn), want)
    assert ok and n == m > 300


def _scans(df):
    """Scans that run, that is outside exchanges that are read again."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = df.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    return len(re.findall(r"(?:FileScan parquet|Scan ExistingRDD).*card_id|FileScan parquet.*event_id|FileScan parquet.*user_id", plan)), plan


def test_few_scans_of_the_payments(spark):
    n, _ = _scans(enrich.impossible_travel_any(transactions(spark, SF001)))
    assert n <= 5


def test_a_card_that_stays_near_meets_no_place(spark):
    """Its payments leave before the hulls: they are in no wide bucket."""
    near = _payments(spark).filter("card_id = 4")
    t = near.withColumn("b", F.expr("unix_micros(ts) div 1800000000"))
    assert enrich._wide_buckets(t, 500.0).count() == 0
    assert enrich.far_candidates(near).count() == 0


def test_alerts_build_no_frame_that_no_rule_reads(spark):
    t = transactions(spark, SF001)
    lean, full = alert_rows(rules.all_flags(t, RULES, **FLAGS_ONLY)), alert_rows(rules.all_flags(t, RULES))
    ok, n, _ = same_rows(lean, full)
    assert ok and n > 0
    from __spark_entry__ import queries
    plan = queries()["alerts_union"](spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
    assert "explode([0,1,2,3])" not in plan
    assert "explode([0,1,2,3])" in full._jdf.queryExecution().optimizedPlan().toString()
