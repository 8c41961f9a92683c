"""Detectors and interval joins on the stream: event-time order, state that ends, equality with plain code."""

import random
import time
from datetime import datetime, timedelta, timezone
from math import sqrt

import pytest
from pyspark.sql import functions as F

from cardpulse.session import shared_path
from cardpulse.streaming import detect, jobs

SCHEMA = "transaction_id string, card_id string, timestamp timestamp, amount double, device_id string, merchant_name string, avg_monthly_spend int, card_limit int"
START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def stream(spark, slices):
    path = shared_path(spark, "test", "slices")
    for i, rows in enumerate(slices):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{path}/slice={i:03d}")
        time.sleep(0.05)  # the source takes files by their time
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{path}/*/*.parquet").withWatermark("timestamp", "30 minutes")


def play(spark, df):
    out = shared_path(spark, "test", "out")
    with jobs.with_rocksdb(spark):
        q = jobs.run(df, out)
    return spark.read.parquet(out), q, out + "-ckpt"


def row(i, card, at, amount, device="d0", merchant="m0"):
    return (f"t{i:06d}", card, START + at, amount, device, merchant, 1000, 500)


def plain(rows, end):
    """Flags by walking each card's rows in order; rows of buckets that end after ``end`` are not out yet."""
    out, seen = {}, {}
    for r in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        past = seen.setdefault(r[1], [])
        cents = [round(x[3] * 100) for x in past]
        n, s, q = len(cents), sum(cents), sum(c * c for c in cents)
        dev = sqrt(float(n * q - s * s) / float(n * (n - 1))) / 100.0 if n >= 2 else 0.0
        z = (r[3] - s / (100.0 * n)) / dev if dev else None
        days = [x for x in [*past, r] if (r[2].date() - x[2].date()).days < 30]
        flags = (n > 0 and round(r[3] * 100) * n > 3 * s, z is not None and z > 3, r[4] not in {x[4] for x in past} and r[3] > 100,
                 r[5] not in {x[5] for x in past} and r[3] > 3.0 * r[6], r[7] > 0 and r[3] >= 0.6 * r[7])
        past.append(r)
        if (int((r[2] - START).total_seconds()) // 600 + 1) * 600 <= (end - START).total_seconds():
            out[r[0]] = (n, None if z is None else round(z, 9), round(sum(round(x[3] * 100) for x in days) / (100.0 * len(days)), 9), *flags)
    return out


@pytest.fixture(scope="module")
def shuffled():
    """Two cards over 75 days, rows up to 25 minutes out of order; card B is idle after day 2; one hot card."""
    rnd = random.Random(1)
    rows = [row(i, "A", timedelta(hours=6 * i, minutes=rnd.randrange(60)), rnd.choice([5.0, 12.5, 40.0, 99.99, 400.0]), rnd.choice(["d0", "d1", None]), rnd.choice(["m0", "m1", "m2"])) for i in range(300)]
    rows += [row(1000 + i, "B", timedelta(hours=i), 10.0 + i) for i in range(48)]
    rows += [row(2000 + i, "H", timedelta(seconds=20 * i), float(rnd.randrange(1, 400)), f"d{i % 40}", f"m{i % 90}") for i in range(1500)]
    rows.append(row(5000, "H", timedelta(hours=3), 4000.0, "d0", None))
    by_arrival = sorted(rows, key=lambda r: r[2] + timedelta(minutes=rnd.randrange(25)))
    n = 8
    return rows, [by_arrival[i * len(rows) // n:(i + 1) * len(rows) // n] for i in range(n)]


def test_flags_do_not_depend_on_arrival(spark, shuffled):
    rows, slices = shuffled
    got, _, checkpoint = play(spark, detect.card_scores(stream(spark, slices)))
    got = {r["transaction_id"]: (r["prior_txn_count"], None if r["amount_zscore"] is None else round(r["amount_zscore"], 9), round(r["avg_amount_30d"], 9),
                                 *(r[x] for x in detect.RULES)) for r in got.collect()}
    want = plain(rows, max(r[2] for r in rows) - timedelta(minutes=30))
    assert len(got) > 1800 and got == want

    def state(name):
        return spark.read.format("statestore").option("stateVarName", name).load(checkpoint)

    # the idle cards' rings are gone, A's holds 30 days; nobody's closed rows still wait
    rings = {r["card"]: len(r["day"]) for r in state("ring").select(F.col("key.card_id").alias("card"), F.col("value.day").alias("day")).collect()}
    assert set(rings) == {"A"} and rings["A"] <= detect.RING_DAYS + 1
    assert {r[0] for r in state("prior").select("key.card_id").collect()} == {"A", "B", "H"}
    assert state("waiting").count() <= 2


def test_alerts_name_their_rules(spark, shuffled):
    rows, slices = shuffled
    got, _, _ = play(spark, detect.card_alerts(stream(spark, slices), limit_ratio=5.0, z=100.0))
    found = {r["transaction_id"]: r["rules"] for r in got.collect()}
    assert found["t005000"] == "over_average,spend_spike,near_limit"
    assert "zscore" not in " ".join(found.values())


def test_cards_share_states_in_groups(spark, shuffled):
    rows, slices = shuffled
    got, _, checkpoint = play(spark, detect.card_alerts(stream(spark, slices), groups=2))
    want = {i: ",".join(name for name, flag in zip(detect.RULES, f[3:]) if flag) for i, f in plain(rows, max(r[2] for r in rows) - timedelta(minutes=30)).items()}
    assert {r["transaction_id"]: r["rules"] for r in got.collect()} == {i: names for i, names in want.items() if names}

    def keys(name):
        return {r[0] for r in spark.read.format("statestore").option("stateVarName", name).load(checkpoint).select("key.card_group").collect()}

    assert keys("prior") <= {0, 1} and keys("ring") <= keys("names") <= keys("prior")


def removed(q):
    return sum(op.numRowsRemoved for p in q.recentProgress for op in p.stateOperators)


def test_interval_join_drops_state(spark):
    from tests.conftest import SF001
    queries = []
    run = jobs.run
    jobs.run = lambda *a, **k: queries.append(run(*a, **k)) or queries[-1]
    try:
        n = jobs.stream_test_then_big(spark, SF001, 5.0, 20.0, 100.0, "24 hours").count()
        jobs.stream_far_pairs(spark, SF001)
    finally:
        jobs.run = run
    assert n > 0 and all(removed(q) > 0 for q in queries)
