"""Stream semantics: stream = batch for keyed state, watermark behaviour,
dedup under redelivery, restart from checkpoint, fan-out."""
from pyspark.sql import functions as F

from cardpulse.session import shared_path
from cardpulse.sources import replay
from cardpulse.sources.model import envelopes
from cardpulse.streaming import jobs

from .conftest import SF001


def test_card_state_equals_batch(spark):
    from cardpulse.operators.features import card_features
    from cardpulse.sources.tables import transactions
    st = jobs.stream_card_state(spark, SF001)
    b = card_features(transactions(spark, SF001), windows=["1hr", "24hr"], averages=[], baseline=False,
                      first_use=["is_new_merchant"])
    b = b.select(F.format_string("txn_%012x", "transaction_id").alias("transaction_id"),
                 "minutes_since_last_txn", "distance_from_last_txn_km", "is_new_merchant",
                 "transactions_last_1hr", "transactions_last_24hr")
    s = {r.transaction_id: tuple(r)[1:] for r in st.select(*b.columns).collect()}
    t = {r.transaction_id: tuple(r)[1:] for r in b.collect()}
    assert s == t


def test_watermark_passthrough_and_late_drop(spark):
    """T1 alone keeps a row hours late; a windowed aggregate drops it."""
    src = replay.replay_dir_for(spark, SF001, with_junk=False)
    late_dir = shared_path(spark, "late")
    env = envelopes(spark, SF001, with_junk=False)
    replay.write_slices(env, late_dir, slices=3)
    first = env.orderBy("timestamp").limit(1).withColumn("timestamp", F.col("timestamp"))
    # append a copy of the earliest message (new key) after the last slice: hours late
    late = first.withColumn("key", F.encode(F.lit("late"), "UTF-8")).withColumn(
        "value", F.encode(F.regexp_replace(F.col("value").cast("string"), '"transaction_id":"[^"]*"',
                                           '"transaction_id":"late_1"'), "UTF-8"))
    late.coalesce(1).write.parquet(f"{late_dir}/slice=99999-copy=0")
    out1, out2 = shared_path(spark, "late-pass"), shared_path(spark, "late-agg")
    jobs.run(jobs.decoded_stream(spark, late_dir), out1)
    passed = spark.read.parquet(out1)
    assert passed.filter(F.col("transaction_id") == "late_1").count() == 1
    agg = (jobs.decoded_stream(spark, late_dir).groupBy(F.window("timestamp", "1 hour"))
           .agg(F.count(F.lit(1)).alias("n")))
    jobs.run(agg, out2)
    total = spark.read.parquet(out2).agg(F.sum("n")).first()[0]
    assert total < passed.count()   # the late row (and the still-open tail) are not in the aggregate
    assert src


def test_dedup_and_restart(spark):
    n = envelopes(spark, SF001, with_junk=False).count()
    d = jobs.stream_dedup(spark, SF001)
    assert d.count() == n and d.select("transaction_id").distinct().count() == n
    r = jobs.stream_restart(spark, SF001)
    assert r.count() == n and r.select("transaction_id").distinct().count() == n


def test_fan_out_subscribers(spark):
    """Two independent subscribers on one source, each with its checkpoint,
    each sees every row and projects its own fields (S13 / F3)."""
    src = replay.replay_dir_for(spark, SF001)
    a, b = shared_path(spark, "sub-fraud"), shared_path(spark, "sub-risk")
    jobs.run(jobs.decoded_stream(spark, src).select("transaction_id", "amount", "location_lat"), a)
    jobs.run(jobs.decoded_stream(spark, src).select("transaction_id", "months_since_last_default"), b)
    ra, rb = spark.read.parquet(a), spark.read.parquet(b)
    assert ra.count() == rb.count() > 0
    assert ra.columns == ["transaction_id", "amount", "location_lat"]


def test_quarantine_counts_pages(spark):
    from cardpulse.sources.tables import read_table
    q = jobs.stream_quarantine(spark, SF001)
    assert q.count() == read_table(spark, SF001, "pages").count()


def test_foreach_batch_outputs_idempotent(spark):
    raw = jobs.stream_three_outputs(spark, SF001)
    assert raw.count() == raw.select("transaction_id").distinct().count()


def test_console_sink_runs(spark, capsys):
    """The console sink prints appended rows; run once to completion."""
    src = replay.replay_dir_for(spark, SF001)
    q = (jobs.decoded_stream(spark, src).select("transaction_id", "amount").writeStream.format("console")
         .option("checkpointLocation", shared_path(spark, "console")).option("numRows", 2)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert q.exception() is None and len(q.recentProgress) > 0


def test_card_state_late_row_uses_current_state(spark):
    """A row arriving after later events of its card is scored against the
    state as it is (its 'previous' is the card's latest event); the state is
    not rewound (SURVEY §7.3 point 6: the batch job is the reference)."""
    from cardpulse.session import ship_package
    from cardpulse.streaming.state import card_state_features
    ship_package(spark)
    env = envelopes(spark, SF001, with_junk=False)
    d = shared_path(spark, "late-state")
    replay.write_slices(env, d, slices=2)
    first = env.orderBy("timestamp").limit(1)
    late = first.withColumn("value", F.encode(F.regexp_replace(
        F.col("value").cast("string"), '"transaction_id":"[^"]*"', '"transaction_id":"late_2"'), "UTF-8"))
    late.coalesce(1).write.parquet(f"{d}/slice=99999-copy=0")
    out = shared_path(spark, "late-state-out")
    jobs.run(card_state_features(jobs.decoded_stream(spark, d)), out)
    res = spark.read.parquet(out)
    row = res.filter(F.col("transaction_id") == "late_2").first()
    card_last = res.filter((F.col("card_id") == row.card_id) & (F.col("transaction_id") != "late_2")) \
                   .agg(F.max("t_us")).first()[0]
    assert row.minutes_since_last_txn is not None
    assert abs(row.t_us - round(row.minutes_since_last_txn * 60_000_000) - card_last) <= 1
    assert row.minutes_since_last_txn < 0          # previous is later than the late row
