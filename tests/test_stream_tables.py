"""Tables that the stream keeps: rollups, enriched table, progress; replay by position; the stored forest."""

from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from cardpulse.operators import anomaly
from cardpulse.session import shared_path
from cardpulse.sources import log
from cardpulse.sources.tables import transactions
from cardpulse.streaming import jobs, rollups, sinks

from .conftest import SF001
from .helpers import same_rows

START = datetime(2024, 1, 1, 22, 30, tzinfo=timezone.utc)


def messages(spark, n=400, step=timedelta(minutes=1)):
    rows = [(START + i * step, f"card_{i % 7:05d}", float(i % 90) + .25, i % 11 == 0, ("a", "b", None)[i % 3], i % 5 + .5, i % 4 - 1.5, f"txn_{i:012x}") for i in range(n)]
    return spark.createDataFrame(rows, "timestamp timestamp, card_id string, amount double, is_fraud boolean, merchant_category string, "
                                       "location_lat double, location_lon double, transaction_id string")


def test_rollups_equal_batch_and_take_a_batch_once(spark):
    m, base = messages(spark), shared_path(spark, "test", "rollups")
    write = rollups.write_rollups(base)
    first, second = m.filter("transaction_id < 'txn_0000000000a0'"), m.filter("transaction_id >= 'txn_0000000000a0'")
    for batch, number in ((first, 0), (first, 0), (second, 1), (second, 1)):
        write(batch, number)
    fraud = F.sum(F.col("is_fraud").cast("bigint"))
    want = m.groupBy(F.to_date("timestamp").alias("day")).agg(F.count(F.lit(1)).alias("txns"), fraud.alias("fraud_txns"))
    assert same_rows(rollups.fraud_rate_by_day(spark, base).drop("fraud_rate"), want)[0]
    want = m.groupBy(F.floor("location_lat").cast("double").alias("cell_lat"), F.floor("location_lon").cast("double").alias("cell_lon")).agg(
        F.count(F.lit(1)).alias("txns"), fraud.alias("fraud_txns"), F.sum("amount").alias("amount_total"))
    assert same_rows(rollups.heatmap(spark, base), want)[0]
    recent = rollups.categories_last_hour(spark, base)
    assert {r.merchant_category: r.txns for r in recent.collect()} == {"a": 20, "b": 20, None: 20}
    scan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in scan
    assert rollups.card_hours(spark, base).agg(F.sum("txns")).first()[0] == 400


def test_last_hour_reaches_over_midnight(spark):
    m, base = messages(spark, 100), shared_path(spark, "test", "rollups")        # 22:30 to 00:09
    rollups.write_rollups(base)(m, 0)
    assert rollups.categories_last_hour(spark, base).agg(F.sum("txns")).first()[0] == 60


def test_enriched_table_batches_and_compaction(spark):
    m, base = messages(spark, 4000), shared_path(spark, "test", "enriched")      # three days and more
    write = sinks.enriched_table(base)
    parts = [m.filter(F.conv(F.substring("transaction_id", 5, 12), 16, 10).cast("bigint") % 5 == i) for i in range(5)]
    for i in (0, 1, 1, 2, 3):
        write(parts[i], i)
    ids = lambda df: sorted(r[0] for r in df.select("transaction_id").collect())
    have = ids(parts[0].union(parts[1]).union(parts[2]).union(parts[3]))
    assert ids(sinks.read_enriched(spark, base, compacted=False)) == have
    for _ in range(2):
        sinks.compact_enriched(spark, base, date(2024, 1, 3))
        assert ids(sinks.read_enriched(spark, base)) == have
    write(parts[4], 4)                                                           # rows of compacted days, late
    assert ids(sinks.read_enriched(spark, base)) == ids(m)
    sinks.compact_enriched(spark, base, date(2024, 1, 3))
    assert ids(sinks.read_enriched(spark, base)) == ids(m)
    done = spark.read.parquet(f"{base}/compacted")
    files = done.select("event_date", F.input_file_name().alias("f")).distinct().groupBy("event_date").agg(F.count(F.lit(1)).alias("files")).collect()
    assert len(files) == 2 and sum(r.files for r in files) <= 8 + 2              # shuffle partitions and days


def test_replay_from_any_position(spark):
    rows = [(f"k{i:04d}".encode(), b"x" * (i % 50), START + timedelta(seconds=i // 3)) for i in range(900)]       # three messages an instant
    rows += [(b"k0005", None, START), (b"k0007", b"same", START), (b"k0007", b"same", START)]
    env = spark.createDataFrame(rows, "key binary, value binary, timestamp timestamp")
    path = shared_path(spark, "test", "log")
    log.write_log(env, path, F.pmod(F.xxhash64("key"), F.lit(3)), slice_bytes=4096)
    whole = log.read_log(spark, path).collect()
    assert sorted((r.key, r.value, r.timestamp) for r in whole if r.value is not None) == sorted((k, v, t.replace(tzinfo=None)) for k, v, t in rows if v is not None)
    ends = {}
    for p in range(3):
        own = sorted((r for r in whole if r.partition == p), key=lambda r: r.offset)
        assert [r.offset for r in own] == list(range(len(own)))
        assert [r.timestamp for r in own] == sorted(r.timestamp for r in own)
        ends[p] = len(own)
    n_slices = log.index(spark, path).select("slice").distinct().count()
    assert n_slices > 5
    for second in (-5, 0, 100, 500):
        at = START + timedelta(seconds=second)
        want = {p: sum(r.partition == p and r.timestamp < at.replace(tzinfo=None) for r in whole) for p in range(3)}
        assert log.positions_at(spark, path, at) == want
    start, end = {0: 100, 1: ends[1] - 3, 2: ends[2]}, {0: 130}
    out = shared_path(spark, "test", "replayed")
    q = jobs.run(log.read_from(spark, path, start, end), out)
    got = sorted((r.partition, r.offset) for r in spark.read.parquet(out).collect())
    assert got == [(0, i) for i in range(100, 130)] + [(1, i) for i in range(ends[1] - 3, ends[1])]
    assert sum(p["numInputRows"] for p in q.recentProgress) < len(rows)          # slices outside are not read
    empty = shared_path(spark, "test", "replayed")
    jobs.run(log.read_from(spark, path, ends), empty)
    assert spark.read.schema(log.LOG_SCHEMA).parquet(empty).count() == 0


def test_progress_table_has_every_batch(spark):
    t = jobs.stream_throughput(spark, SF001)
    rows = sorted(t.collect(), key=lambda r: r.batch_id)
    assert [r.batch_id for r in rows] == list(range(len(rows))) and len(rows) >= 2
    assert all(r.batch_ms >= 0 and (r.processed_rows_per_second > 0 or r.input_rows == 0) for r in rows)


def test_stored_forest_scores_batch_and_stream_alike(spark):
    txn = transactions(spark, SF001)
    feats = anomaly.feature_frame(txn)
    path, saved = shared_path(spark, "test", "forest"), shared_path(spark, "test", "features")
    feats.write.parquet(saved)
    feats = spark.read.parquet(saved)
    old, new = (anomaly.train(txn, n_trees=n, psi=64, features=feats) for n in (5, 20))
    for forest, version in ((old, 1), (old, 1), (new, 2)):
        anomaly.store_forest(forest, path, version, psi=64, threshold=0.5)
    assert {r.version: r.trees for r in anomaly.forest_versions(spark, path).collect()} == {1: 5, 2: 20}
    direct = anomaly.score(txn, new.toPandas(), 64, 0.5, features=feats)
    newest = anomaly.score_stored(feats, path)
    assert same_rows(direct, newest)[0]
    assert not same_rows(direct, anomaly.score_stored(feats, path, 1))[0]
    out = shared_path(spark, "test", "scores")
    jobs.run(anomaly.score_stored(spark.readStream.schema(feats.schema).parquet(saved), path), out)
    assert same_rows(direct, spark.read.parquet(out))[0]
    alerts = anomaly.forest_alerts(txn, path)
    assert alerts.columns == ["transaction_id", "card_id", "ts", "amount", "rule"]
    assert alerts.count() == direct.filter("is_outlier").count() > 0
    with pytest.raises(ValueError):
        anomaly.score_stored(feats, path, 9)
