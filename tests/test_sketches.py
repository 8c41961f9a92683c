"""Mergeable sketches against exact counts; burst episodes across borders."""

import random
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import functions as F

from cardpulse import dimensions as dims
from cardpulse.operators import dashboards, sketches
from cardpulse.session import shared_path
from cardpulse.streaming import jobs

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def amounts(spark, days=6, per_day=4000):
    rnd = random.Random(5)
    rows = [(START + timedelta(days=d, seconds=rnd.randrange(86400)), "hot" if rnd.random() < .7 else "rare", round(rnd.lognormvariate(3, 1.5), 2)) for d in range(days) for _ in range(per_day)]
    rows += [(START, "hot", None), (START, "hot", float("nan")), (START, None, 5.0)] + [(START + timedelta(days=1), "ties", 7.0)] * 3000
    return spark.createDataFrame(rows, "ts timestamp, kind string, amount double")


def test_merged_quantiles_of_any_range(spark):
    txn = amounts(spark)
    path = shared_path(spark, "test", "sketches")
    sketches.write_amount_sketches(sketches.amount_sketches(txn, "kind"), path)
    table = spark.read.parquet(path)
    day = F.to_date("ts")
    for first, last in ((1, 1), (2, 4), (1, 6)):
        low, high = date(2024, 1, first), date(2024, 1, last)
        own = txn.filter(day.between(low, high))
        got = sketches.merged_quantiles(table.filter(F.col("day").between(low, high)), "kind")
        errors = sketches.rank_errors(got, own, "kind").collect()
        usable = own.filter("amount is not null and not isnan(amount)")
        assert {r.kind: r.txns for r in got.collect()} == {r.kind: r["count"] for r in usable.groupBy("kind").count().collect()}
        assert len(errors) == usable.filter("kind is not null").select("kind").distinct().count()
        assert all(max(r.e50, r.e90, r.e99) <= 0.02 for r in errors)
        ties = [r for r in got.collect() if r.kind == "ties"]
        assert all((r.p50, r.p90, r.p99) == (7.0, 7.0, 7.0) for r in ties)


def test_a_day_written_again_replaces_itself_only(spark):
    txn = amounts(spark, 3, 300)
    path = shared_path(spark, "test", "sketches")
    sketches.write_amount_sketches(sketches.amount_sketches(txn, "kind"), path)
    before = sorted(map(tuple, spark.read.parquet(path).groupBy("day").agg(F.sum("txns")).collect()))
    sketches.write_amount_sketches(sketches.amount_sketches(txn.filter(F.to_date("ts") == "2024-01-02"), "kind"), path)
    assert sorted(map(tuple, spark.read.parquet(path).groupBy("day").agg(F.sum("txns")).collect())) == before
    assert sketches.merged_quantiles(spark.read.parquet(path).limit(0), "kind").count() == 0


def test_distinct_by_panes_stays_within_its_error(spark):
    rnd = random.Random(9)
    rows = [(START + timedelta(seconds=rnd.randrange(4 * 3600)), "hot" if rnd.random() < .4 else f"c{rnd.randrange(40)}", f"m{int(rnd.paretovariate(.4)) % 20000}") for _ in range(60_000)]
    df = spark.createDataFrame(rows, "timestamp timestamp, card_id string, merchant_name string")
    got = {(r.card_id, r.window.start): (r.txns, r.distinct_values) for r in sketches.pane_distinct(df, "card_id", "merchant_name").collect()}
    want = {(r.card_id, r.w.start): (r.n, r.d) for r in df.groupBy("card_id", F.window("timestamp", "1 hour", "10 minutes").alias("w")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("merchant_name").alias("d")).collect()}
    assert got.keys() == want.keys() and max(d for _, d in want.values()) > 600  # beyond the sparse, exact sketches
    for key, (n, d) in want.items():
        assert got[key][0] == n and abs(got[key][1] - d) <= max(1, 0.06 * d)


def test_streamed_panes_equal_batch_and_leave_state(spark):
    path = shared_path(spark, "test", "slices")
    schema = "timestamp timestamp, card_id string, merchant_name string"
    rnd = random.Random(2)
    for i in range(5):
        rows = [(START + timedelta(hours=2 * i, seconds=rnd.randrange(7200)), f"c{rnd.randrange(3)}", f"m{rnd.randrange(30)}") for _ in range(200)]
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/slice={i:03d}")
    # a last row closes all windows before it
    spark.createDataFrame([(START + timedelta(days=2), "end", "m")], schema).coalesce(1).write.parquet(f"{path}/slice=999")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/*/*.parquet").withWatermark("timestamp", "5 hours")
    out = shared_path(spark, "test", "out")
    q = jobs.run(sketches.pane_distinct(stream, "card_id", "merchant_name"), out)
    exact = spark.read.schema(schema).parquet(f"{path}/*/*.parquet").filter("card_id <> 'end'").groupBy("card_id", F.window("timestamp", "1 hour", "10 minutes").alias("window")).agg(
        F.count(F.lit(1)).alias("txns"), F.count_distinct("merchant_name").alias("distinct_values"))
    as_set = lambda df: {(r.card_id, r.window.start, r.txns, r.distinct_values) for r in df.collect()}
    assert as_set(spark.read.parquet(out)) == as_set(exact)
    assert sum(s["numRowsTotal"] for s in q.lastProgress["stateOperators"]) <= 7  # the last row's pane


def test_burst_across_hours_and_midnight_is_one_episode(spark):
    curve = dims.HOURLY_MULTIPLIERS
    rows = []
    for d in range(4):
        for h in range(24):
            for m in range(60):
                for _ in range(max(1, round(10 * curve[h]))):
                    rows.append((START + timedelta(days=d, hours=h, minutes=m),))
    noon, night = START + timedelta(days=1, hours=11, minutes=50), START + timedelta(days=2, hours=23, minutes=50)
    for begin in (noon, night):  # 30 minutes at about nine times the rate
        for m in range(30):
            at = begin + timedelta(minutes=m)
            rows += [(at,)] * round(80 * curve[at.hour] + 8)
    txn = spark.createDataFrame(rows, "ts timestamp")
    got = dashboards.burst_episodes(spark, txn, min_ratio=5.0).orderBy("start_us").collect()
    us = lambda t: int(t.timestamp()) * 1_000_000
    assert [(r.start_us, r.end_us, r.duration_minutes) for r in got] == [(us(t), us(t + timedelta(minutes=30)), 30) for t in (noon, night)]
    assert all(r.peak_ratio > 5 and r.txns > r.expected for r in got)
