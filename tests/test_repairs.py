"""Cases of past faults: late rows, lost rows, caps, shared folders."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from cardpulse import session
from cardpulse.functions.scalars import unit_hash
from cardpulse.operators import rules
from cardpulse.operators.anomaly import member_draw
from cardpulse.session import shared_path, ship_package
from cardpulse.sources import replay
from cardpulse.sources.model import envelopes
from cardpulse.streaming import jobs
from cardpulse.streaming.state import card_state_features, card_state_features_tws

from .conftest import SF001


@pytest.mark.parametrize("n", [1e8, 1e10, 1e12])
def test_forest_sample_share_holds_for_large_tables(spark, n):
    """Ids spread over [0, n): the share of rows that a tree draws stays at 2 psi / n (scaled up to be countable)."""
    psi, rows = 256, 400_000
    share = 2 * psi / n
    ids = spark.range(rows).select((F.col("id") * int(n / rows)).alias("id"))
    u = ids.select(member_draw("id", F.lit(3), 7).alias("a"), member_draw("id", F.lit(4), 7).alias("b"))
    scaled = 1e4 * share * n / rows / n * rows   # the same share, times 1e4
    got = u.agg(F.avg((F.col("a") < scaled).cast("double")), F.avg((F.col("a") < 1e-3).cast("double")), F.corr("a", "b"), F.countDistinct("a")).first()
    assert got[0] == pytest.approx(scaled, abs=4 * (scaled / rows) ** 0.5 + 1e-9)
    assert got[1] == pytest.approx(1e-3, rel=0.25) and abs(got[2]) < 0.01 and got[3] == rows


def test_unit_hash_known_values_and_large_ids(spark):
    import hashlib
    ids = [0, 1, 1_000_003, 2_000_006, 10**12, 10**17]
    got = [r[0] for r in spark.createDataFrame([(i,) for i in ids], "id long").select(unit_hash("id", 3)).collect()]
    assert got == [int(hashlib.md5(f"{i}|3".encode()).hexdigest()[:13], 16) / 2**52 for i in ids] and len(set(got)) == len(ids)


def test_card_testing_needs_no_grid(spark):
    """Five small payments at five merchants within 59 minutes that no 10-minute grid window holds."""
    start = dt.datetime(2024, 1, 5, 12, 5)
    rows = [(i, 1, start + dt.timedelta(minutes=m), 10.0, f"m{i}") for i, m in enumerate((0, 15, 30, 45, 59))]
    rows += [(10 + i, 2, start + dt.timedelta(minutes=m), 10.0, "same") for i, m in enumerate((0, 15, 30, 45, 59))]
    rows += [(20 + i, 3, start + dt.timedelta(minutes=m), 10.0, f"m{i % 5}") for i, m in enumerate((0, 15, 30, 45, 61))]
    txn = spark.createDataFrame(rows, "transaction_id long, card_id long, ts timestamp_ntz, amount double, merchant_name string")
    got = rules.rule_card_testing(txn).collect()
    assert [(r.transaction_id, r.small_txns, r.distinct_merchants) for r in got] == [(4, 5, 5)]
    counts = {r.transaction_id: (r.small_txns, r.distinct_merchants) for r in rules.card_testing_counts(txn).collect()}
    assert counts[14] == (5, 1) and counts[24] == (4, 4)


def test_published_thresholds_are_the_defaults(spark):
    f = spark.createDataFrame([(dt.datetime(2024, 1, 5, 2), 300.0)], "ts timestamp_ntz, amount double")
    assert not f.select(rules.RULES["odd_hour"](f)).first()[0]
    assert f.select(rules.rule_set(odd_hour_amount=100.0)["odd_hour"](f)).first()[0]


@pytest.mark.parametrize("features", [card_state_features, card_state_features_tws])
def test_state_is_not_rewound_and_null_merchants_are_known(spark, features):
    """After a late row the next row still sees the card's latest event; a NULL merchant is new once."""
    ship_package(spark)
    if features is card_state_features_tws:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    template = envelopes(spark, SF001, with_junk=False).limit(1).collect()[0]
    message = template.value.decode()
    import json
    body = json.loads(message)

    def row(tid, hhmm, merchant):
        own = dict(body, transaction_id=tid, timestamp=f"2024-03-01T{hhmm}:00.000000+05:30", merchant_name=merchant)
        if merchant is None:
            del own["merchant_name"]
        return (tid.encode(), json.dumps(own).encode(), dt.datetime(2024, 3, 1))

    d = shared_path(spark, "rewind")
    batches = [[row("a", "10:00", "x")], [row("b", "09:45", None)], [row("c", "10:01", None)], [row("d", "10:02", "x")]]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, replay.REPLAY_SCHEMA).coalesce(1).write.parquet(f"{d}/slice={i:05d}-copy=0")
    out = shared_path(spark, "rewind-out")
    jobs.run(features(jobs.decoded_stream(spark, d)), out)
    got = {r.transaction_id: r for r in spark.read.parquet(out).collect()}
    assert got["c"].minutes_since_last_txn == pytest.approx(1.0) and got["d"].minutes_since_last_txn == pytest.approx(1.0)
    assert got["a"].is_new_merchant and got["b"].is_new_merchant and not got["c"].is_new_merchant and not got["d"].is_new_merchant


def test_hourly_join_state_is_dropped_as_hours_close(spark):
    src = replay.replay_dir_for(spark, SF001)
    ev = jobs.decoded_stream(spark, src).select("transaction_id", "card_id", "timestamp")
    agg = jobs.decoded_stream(spark, src).groupBy(F.window("timestamp", "1 hour").alias("w"), "card_id").agg(F.count(F.lit(1)).alias("n"))
    agg = agg.select(F.col("card_id").alias("a_card"), F.col("w.start").alias("ws"), F.window_time("w").alias("wt"), "n")
    j = ev.join(agg, (ev.card_id == agg.a_card) & (F.date_trunc("hour", ev.timestamp) == agg.ws) & (ev.timestamp <= agg.wt)
                & (ev.timestamp > agg.wt - F.expr("INTERVAL 1 HOUR")))
    q = jobs.run(j.select("transaction_id", "n"), shared_path(spark, "hourly"))
    removed = [op.get("numRowsRemoved", 0) for p in q.recentProgress for op in p["stateOperators"] if op["operatorName"] == "symmetricHashJoin"]
    assert sum(removed) > 0


def test_checkpoint_dir_is_needed_on_a_cluster(spark):
    assert session._is_local("local[4]") and not session._is_local("local-cluster[2,1,1024]") and not session._is_local("spark://h:7077")

    class Context:
        master = "spark://h:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Session())


def test_local_publish_prints_every_message(spark, capsys):
    from cardpulse import cli
    cli.main(["publish", "--sf-dir", SF001, "--mode", "local"])
    n = spark.read.parquet(f"{SF001}/events.parquet").count()
    assert sum('"transaction_id"' in line for line in capsys.readouterr().out.splitlines()) == n > 20
