"""The skew-safe engine must equal the plain per-card window definitions,
including on a derived table where one card holds a third of all rows."""

import random
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from cardpulse.operators.timeline import (DAY_US, HOUR_US, MINUTE_US, last_n_rows, plain_sequence_features,
                                          sequence_features)
from cardpulse.sources.tables import transactions

from .conftest import SF01
from .helpers import same_rows


def _kw():
    cents = F.round(F.col("amount") * 100).cast("bigint")
    return dict(frames={"1hr": HOUR_US, "24hr": DAY_US, "30d": 30 * DAY_US},
                sums={"n": F.lit(1).cast("bigint"), "cents": cents},
                prior={"cents": cents},
                previous=["lat", "lon"],
                first_use={"new_merchant": "merchant_name", "new_device": "device_id"})


def test_engine_equals_plain_windows(spark):
    txn = transactions(spark, SF01)
    ok, a, b = same_rows(sequence_features(txn, **_kw()), plain_sequence_features(txn, **_kw()))
    assert ok and a == b == 10000


def _hot(spark):
    """A third of the rows re-assigned to card 0, with duplicated instants
    (peers) — derived from the driver table, not synthesised."""
    txn = transactions(spark, SF01)
    return txn.withColumn("card_id", F.when(F.col("transaction_id") % 3 == 0, F.lit(0)).otherwise(F.col("card_id"))) \
              .withColumn("ts", F.when(F.col("transaction_id") % 7 == 0,
                                       F.date_trunc("minute", "ts")).otherwise(F.col("ts")))


def test_engine_equals_plain_on_hot_card(spark):
    hot = _hot(spark)
    ok, a, b = same_rows(sequence_features(hot, **_kw()), plain_sequence_features(hot, **_kw()))
    assert ok and a == b


def test_short_bucket_frames(spark):
    hot = _hot(spark)
    kw = dict(frames={"10m": 10 * MINUTE_US, "20m": 20 * MINUTE_US}, sums={"n": F.lit(1).cast("bigint")})
    ok, _, _ = same_rows(sequence_features(hot, bucket_us=10 * MINUTE_US, **kw), plain_sequence_features(hot, **kw))
    assert ok


def test_last_n_rows_equals_window(spark):
    from pyspark.sql import Window
    hot = _hot(spark)
    cents = F.round(F.col("amount") * 100).cast("bigint")
    got = last_n_rows(hot, cents, n=10).select("transaction_id", F.col("history"))
    w = Window.partitionBy("card_id").orderBy("ts", "transaction_id").rowsBetween(-10, -1)
    ref = hot.select("transaction_id", F.collect_list(cents).over(w).alias("history")) \
             .select("transaction_id", F.when(F.size("history") > 0, F.col("history")).alias("history"))
    a = {r[0]: r[1] for r in got.collect()}
    b = {r[0]: r[1] for r in ref.collect()}
    assert a == b


def test_one_big_shuffle(spark):
    """All sequence features come from one exchange of the fact rows keyed
    by (card, bucket); the other exchanges carry per-bucket aggregates."""
    txn = transactions(spark, SF01)
    plan = sequence_features(txn, **_kw())._jdf.queryExecution().executedPlan().toString().splitlines()
    fact = [i for i, ln in enumerate(plan)
            if "Exchange hashpartitioning(card_id" in ln and "_bkt" in ln and "Union" in plan[i + 1]]
    assert len(fact) == 1
    # no exchange of the fact side by card alone (that would put a hot card in one task)
    by_card_only = [ln for i, ln in enumerate(plan) if "Exchange hashpartitioning(card_id" in ln
                    and "_bkt" not in ln and "Union" in plan[i + 1]]
    assert not by_card_only


def test_impossible_travel_any_equals_brute_force_on_hot_card(spark):
    from cardpulse.functions.geo import haversine_km
    from cardpulse.operators.enrich import impossible_travel_any
    hot = _hot(spark)
    got = {r.transaction_id: r.max_km_within_window for r in impossible_travel_any(hot).collect()}
    a, b = hot.alias("a"), hot.alias("b")
    pairs = a.join(b, (F.col("a.card_id") == F.col("b.card_id"))
                   & (F.col("b.ts") >= F.col("a.ts") - F.expr("INTERVAL 30 MINUTES"))
                   & (F.col("b.ts") <= F.col("a.ts")))
    d = haversine_km("b.lat", "b.lon", "a.lat", "a.lon", digits=None)
    ref = (pairs.select(F.col("a.transaction_id").alias("id"), d.alias("d")).filter(F.col("d") > 500)
           .groupBy("id").agg(F.round(F.max("d"), 2).alias("m")))
    want = {r.id: r.m for r in ref.collect()}
    assert got == want and len(got) > 0


def _two_cities(spark, n):
    """One card, ``n`` payments in 20 minutes that jump between two cities; no two at the same place."""
    rnd = random.Random(11)
    start = datetime(2024, 1, 1, tzinfo=timezone.utc)
    rows = []
    for i in range(n):
        lat, lon = ((19.07, 72.87), (28.61, 77.21))[rnd.random() < 0.5]
        rows.append((i, 7, start + timedelta(microseconds=rnd.randrange(20 * 60 * 1_000_000)), lat + rnd.uniform(-.2, .2), lon + rnd.gauss(0, .1), 1.0))
    return spark.createDataFrame(rows, "transaction_id bigint, card_id bigint, ts timestamp, lat double, lon double, amount double")


def test_jittering_card_meets_extreme_points_only(spark):
    from cardpulse.functions.geo import haversine_km
    from cardpulse.operators.enrich import far_candidates, impossible_travel_any
    pairs = {}
    for n in (2000, 8000, 24000):
        txn = _two_cities(spark, n)
        pairs[n] = far_candidates(txn).count()
        if n == 2000:
            b = txn.selectExpr("card_id", "ts AS b_ts", "lat AS b_lat", "lon AS b_lon")
            want = (txn.join(b, "card_id").filter("b_ts BETWEEN ts - INTERVAL 30 MINUTES AND ts")
                    .withColumn("d", haversine_km("b_lat", "b_lon", "lat", "lon", digits=None)).filter("d > 500")
                    .groupBy("transaction_id").agg(F.round(F.max("d"), 2).alias("m")))
            assert {r.transaction_id: r.max_km_within_window for r in impossible_travel_any(txn).collect()} == {r.transaction_id: r.m for r in want.collect()}
    assert pairs[24000] < 5 * pairs[8000]           # all pairs: 9 times
    assert pairs[24000] < 24000 * 24000 / 4 / 20    # all far pairs inside the window: a quarter of n * n


def test_hull_keeps_the_farthest_point():
    import numpy as np
    from cardpulse.functions.geo import spherical_hull
    rnd = random.Random(3)
    def unit(la, lo):
        la, lo = np.radians(la), np.radians(lo)
        return np.array([np.cos(la) * np.cos(lo), np.cos(la) * np.sin(lo), np.sin(la)])
    for c_lat, c_lon in ((0.5, 0.5), (60.5, 179.5), (-89.5, 10.5)):
        points = [{"p_lat": c_lat + rnd.uniform(-.5, .5), "p_lon": c_lon + rnd.uniform(-.5, .5)} for _ in range(300)]
        points += points[:20]
        hull = spherical_hull(points, c_lat, c_lon)
        assert len(hull) < 60
        own = np.array([unit(**{"la": p["p_lat"], "lo": p["p_lon"]}) for p in points])
        kept = np.array([unit(p["p_lat"], p["p_lon"]) for p in hull])
        for _ in range(200):
            q = unit(rnd.uniform(-90, 90), rnd.uniform(-180, 180))
            if np.arccos(np.clip(own @ q, -1, 1)).max() * 6371 <= 10_000:
                assert abs((own @ q).min() - (kept @ q).min()) < 1e-12
    assert spherical_hull([{"p_lat": float("nan"), "p_lon": 1.0}] * 9, 0.5, 0.5)
