"""Structured Streaming jobs over the replay source.

Every job: replay (or Kafka) → decode → watermark on the event time →
operator → sink with its own checkpoint folder under the shared checkpoint
dir.  ``run`` drives a job to completion with ``availableNow`` (all data
present at start, in rate-limited micro-batches), which is how the batch
catalogue and the tests execute streams; production uses a processing-time
trigger (default 5 s) on the same plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geo import haversine_km
from ..operators.sketches import pane_distinct
from ..session import ship_package, shared_path
from ..sources import decode as dec
from ..sources import log, replay
from ..sources.model import envelopes
from . import rollups
from .detect import card_alerts
from .progress import ProgressTable
from .sinks import alert_table, compact_enriched, enriched_table, read_enriched, three_outputs
from .state import card_state_features, card_state_features_tws

WATERMARK = "30 minutes"
TRIGGER_SECONDS = 5


def decoded_stream(spark: SparkSession, replay_dir: str, watermark: str | None = WATERMARK) -> DataFrame:
    """Replay → decoded transactions (T1: watermark on ``timestamp``)."""
    d = dec.decode(replay.read_stream(spark, replay_dir))
    return d.withWatermark("timestamp", watermark) if watermark else d


def start(writer, spark: SparkSession):
    """``writer.start()`` with a state-partition count that suits the session.

    A stateful query fixes its number of state partitions from
    ``spark.sql.shuffle.partitions`` when it first starts (and keeps it in
    the checkpoint).  On a local master a default of 200 would mean 200 state
    stores per micro-batch on a handful of cores, so the query is started
    with at most twice the core count; cluster sessions keep their setting.
    """
    sc = spark.sparkContext
    key = "spark.sql.shuffle.partitions"
    current = spark.conf.get(key)
    target = 2 * sc.defaultParallelism
    if not sc.master.startswith("local") or int(current) <= target:
        return writer.start()
    spark.conf.set(key, str(target))
    try:
        return writer.start()   # the running query keeps the value it started with
    finally:
        spark.conf.set(key, current)


def run(df: DataFrame, out: str, *, mode: str = "append", fmt: str = "parquet", name: str | None = None,
        checkpoint: str | None = None, available_now: bool = True, foreach_batch=None):
    """Start a query, wait for it to drain, return the finished query."""
    w = df.writeStream.option("checkpointLocation", checkpoint or out + "-ckpt").outputMode(mode)
    if name:
        w = w.queryName(name)
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    else:
        w = w.format(fmt).option("path", out)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=f"{TRIGGER_SECONDS} seconds")
    q = start(w, df.sparkSession)
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return q


def _out(spark, name):
    return shared_path(spark, "streams", name)


# ---------------------------------------------------------------------------
# registered jobs: each returns a batch DataFrame over the job's output
# ---------------------------------------------------------------------------

def stream_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:                      # T1 T2 S2 S3 S5 S6
    src = replay.replay_dir_for(spark, sf_dir)
    out = _out(spark, "decoded")
    run(decoded_stream(spark, src), out)
    return spark.read.parquet(out)


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:                   # S14
    src = replay.replay_dir_for(spark, sf_dir)
    out = _out(spark, "quarantine")
    run(dec.quarantine(replay.read_stream(spark, src)), out)
    return spark.read.parquet(out)


def stream_tumbling_features(spark: SparkSession, sf_dir: str, every: str = "1 hour", late: bool = False) -> DataFrame:  # T3
    """Per card and tumbling hour: count and mean amount; a window is written
    once the watermark (max event time − 30 min) passes its end."""
    src = replay.replay_dir_for(spark, sf_dir, late=late)
    out = _out(spark, "tumbling")
    d = decoded_stream(spark, src)
    agg = (d.groupBy(F.window("timestamp", every).alias("w"), "card_id")
           .agg(F.count(F.lit(1)).alias("txns"), F.sum(F.round(F.col("amount") * 100).cast("bigint")).alias("c"))
           .select("card_id", F.unix_micros(F.col("w.start")).alias("window_start_us"),
                   F.unix_micros(F.col("w.end")).alias("window_end_us"), "txns",
                   (F.col("c") / (F.lit(100.0) * F.col("txns"))).alias("avg_amount")))
    run(agg, out)
    return spark.read.parquet(out)


def stream_sliding_velocity(spark: SparkSession, sf_dir: str, min_txns: int = 2,
                            length: str = "10 minutes", slide: str = "1 minute") -> DataFrame:  # T4
    """Cards with at least ``min_txns`` in any sliding window (published: > 5)."""
    src = replay.replay_dir_for(spark, sf_dir)
    out = _out(spark, "sliding")
    d = decoded_stream(spark, src)
    agg = (d.groupBy(F.window("timestamp", length, slide).alias("w"), "card_id")
           .agg(F.count(F.lit(1)).alias("txns"))
           .filter(F.col("txns") >= min_txns)
           .select("card_id", F.unix_micros(F.col("w.start")).alias("window_start_us"), "txns"))
    run(agg, out)
    return spark.read.parquet(out)


def stream_distinct_merchants(spark: SparkSession, sf_dir: str, min_merchants: int = 2) -> DataFrame:  # A12
    """Cards with ``min_merchants`` or more different merchants in an hour (every 10 minutes), from minute sketches."""
    src = replay.replay_dir_for(spark, sf_dir)
    out = _out(spark, "distinct")
    found = (pane_distinct(decoded_stream(spark, src), "card_id", "merchant_name")
             .filter(F.col("distinct_values") >= min_merchants)
             .select("card_id", F.unix_micros(F.col("window.start")).alias("window_start_us"), "txns",
                     F.col("distinct_values").alias("distinct_merchants")))
    run(found, out)
    return spark.read.parquet(out)


def stream_card_state(spark: SparkSession, sf_dir: str, minute_state: bool = False) -> DataFrame:  # T5
    """Per-card features on the stream.  ``minute_state`` selects the
    ``transformWithState`` processor whose state is indexed by minute
    (bounded work per batch for hot cards) instead of the pandas-state
    handler that rewrites a card's 24 h of times each batch (fewer state
    calls, faster when per-card traffic is modest)."""
    ship_package(spark)
    src = replay.replay_dir_for(spark, sf_dir)
    out = _out(spark, "card_state_min" if minute_state else "card_state")
    key = "spark.sql.streaming.stateStore.providerClass"
    rocks = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    previous = spark.conf.get(key, None)
    if minute_state or not previous:
        # transformWithState needs the RocksDB store; the keyed pandas state
        # uses it too unless the session chose another provider
        spark.conf.set(key, rocks)
    try:
        feats = card_state_features_tws if minute_state else card_state_features
        run(feats(decoded_stream(spark, src)), out)
    finally:
        if minute_state and previous and previous != rocks:
            spark.conf.set(key, previous)
    return spark.read.parquet(out)


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:                        # T6
    """Every slice delivered twice; duplicates removed within the watermark."""
    src = replay.replay_dir_for(spark, sf_dir, copies=2, with_junk=False)
    out = _out(spark, "dedup")
    d = decoded_stream(spark, src).dropDuplicatesWithinWatermark(["transaction_id"])
    run(d, out)
    return spark.read.parquet(out)


def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:                     # T7
    """Stop after the first micro-batch, restart from the checkpoint, finish:
    the output holds every transaction exactly once."""
    import time
    src = replay.replay_dir_for(spark, sf_dir, with_junk=False)
    out = _out(spark, "restart")
    ckpt = out + "-ckpt"
    q = start(decoded_stream(spark, src).writeStream.format("parquet").option("path", out)
              .option("checkpointLocation", ckpt).outputMode("append")
              .trigger(processingTime="1 second"), spark)
    deadline = time.time() + 120
    while time.time() < deadline and not any(p.get("numInputRows", 0) > 0 for p in q.recentProgress):
        time.sleep(0.2)
    q.stop()
    run(decoded_stream(spark, src), out, checkpoint=ckpt)
    return spark.read.parquet(out)


def late_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:                # T8
    """Batch side output: hourly (card, window) counts over all decoded rows
    where they differ from the streamed aggregate: windows still open at the
    end, and windows whose late rows came after they were emitted.  The replay
    delivers some rows weeks behind the watermark."""
    streamed = stream_tumbling_features(spark, sf_dir, late=True)
    src = replay.replay_dir_for(spark, sf_dir, late=True)
    d = dec.decode(replay.read_batch(spark, src))
    batch = (d.groupBy(F.window("timestamp", "1 hour").alias("w"), "card_id")
             .agg(F.count(F.lit(1)).alias("txns"))
             .select("card_id", F.unix_micros(F.col("w.start")).alias("window_start_us"), "txns"))
    emitted = streamed.select("card_id", "window_start_us", F.col("txns").alias("emitted"))
    both = batch.join(emitted, ["card_id", "window_start_us"], "left").withColumn("streamed", F.coalesce("emitted", F.lit(0)))
    return both.filter("txns <> streamed").select("card_id", "window_start_us", "txns", "streamed",
                                                  (F.col("txns") - F.col("streamed")).alias("missing"))


def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:                    # T9
    """Rows, fraud share and event rate per event day, added up from a table
    that every micro-batch writes one row per day to.  Nothing depends on the
    limited history of the query's progress reports."""
    src = replay.replay_dir_for(spark, sf_dir)
    base = _out(spark, "progress")
    day = F.floor(F.unix_micros("timestamp") / F.lit(86_400_000_000)).cast("bigint")

    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.groupBy(day.alias("event_day"))
         .agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col("is_fraud").cast("bigint")).alias("frauds"))
         .write.mode("overwrite").parquet(f"{base}/batch_id={batch_id}"))

    run(decoded_stream(spark, src), base + "/_unused", foreach_batch=write, checkpoint=base + "-ckpt")
    per_day = (spark.read.option("basePath", base).parquet(f"{base}/batch_id=*").groupBy("event_day")
               .agg(F.sum("rows").alias("input_rows"), F.sum("frauds").alias("fraud_rows")))
    return per_day.select("event_day", "input_rows", "fraud_rows",
                          (F.lit(100.0) * F.col("fraud_rows") / F.col("input_rows")).alias("fraud_pct"),
                          (F.col("input_rows") / F.lit(86_400.0)).alias("rows_per_second"))


def stream_throughput(spark: SparkSession, sf_dir: str) -> DataFrame:                  # T9
    """Rows and processing rate of every micro-batch, as a listener reports them while the stream runs."""
    src = replay.replay_dir_for(spark, sf_dir)
    out = _out(spark, "throughput")
    table = ProgressTable(spark, out + "-progress", out.rsplit("/", 1)[1])
    spark.streams.addListener(table)
    try:
        run(decoded_stream(spark, src), out, name=table.name)
        if not table.finished.wait(120):
            raise RuntimeError("the progress reports of the query did not arrive")
    finally:
        spark.streams.removeListener(table)
    return spark.read.option("basePath", table.path).parquet(f"{table.path}/batch_id=*")


_ROLLUPS: dict[tuple[str, str], str] = {}


def stream_rollups(spark: SparkSession, sf_dir: str) -> str:                           # A4 A6 A9 A10
    """Folder of the dashboard tables that the stream keeps, filled once per session and input."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _ROLLUPS:
        base = _out(spark, "rollups")
        run(decoded_stream(spark, replay.replay_dir_for(spark, sf_dir)), base + "/_unused",
            foreach_batch=rollups.write_rollups(base), checkpoint=base + "-ckpt")
        _ROLLUPS[key] = base
    return _ROLLUPS[key]


def stream_enriched_table(spark: SparkSession, sf_dir: str, compact_before) -> DataFrame:  # S8
    """The stream written by event date and batch, with the days before ``compact_before`` compacted."""
    base = _out(spark, "enriched-table")
    run(decoded_stream(spark, replay.replay_dir_for(spark, sf_dir)), base + "/_unused",
        foreach_batch=enriched_table(base), checkpoint=base + "-ckpt")
    compact_enriched(spark, base, compact_before)
    return read_enriched(spark, base)


def replay_from_offset(spark: SparkSession, sf_dir: str, when, partitions: int = 3) -> DataFrame:  # S2
    """The messages from the instant ``when`` on, replayed by position from a numbered log."""
    out = _out(spark, "from-offset")
    number = F.conv(F.substring(F.col("key").cast("string"), 5, 12), 16, 10).cast("bigint")
    envelopes(spark, sf_dir, with_junk=False).write.parquet(out + "-messages")           # encoded once, read several times
    env = spark.read.parquet(out + "-messages")
    total = env.select(F.sum(F.length("value"))).first()[0] or 0
    files = max(1, spark.sparkContext.defaultParallelism)
    log.write_log(env, out + "-log", number % partitions, slice_bytes=max(1 << 20, min(replay.trigger_bytes(spark), total // 8)), files_per_slice=files)
    start = log.positions_at(spark, out + "-log", when)
    run(log.read_from(spark, out + "-log", start, files_per_trigger=files), out)
    return spark.read.schema(log.LOG_SCHEMA).parquet(out)


COUNT_ROWS = 500_000  # rows of one task that counts different ids

SUBSCRIBERS = {
    "fraud": ("transaction_id", "timestamp", "card_id", "amount", "location_lat", "location_lon"),
    "loan": ("transaction_id", "timestamp", "card_id", "monthly_income", "active_emis", "credit_utilization_pct"),
    "risk": ("transaction_id", "timestamp", "card_id", "months_since_last_default", "avg_monthly_spend"),
}


def stream_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:                     # S13
    """Independent subscribers on one source, running side by side, each with
    its own checkpoint and fields; messages per subscriber and event day."""
    src = replay.replay_dir_for(spark, sf_dir)
    outs, running = {}, []
    for name, fields in SUBSCRIBERS.items():
        outs[name] = _out(spark, f"subscriber-{name}")
        w = (decoded_stream(spark, src).select(*fields).writeStream.format("parquet").option("path", outs[name])
             .option("checkpointLocation", outs[name] + "-ckpt").outputMode("append").trigger(availableNow=True))
        running.append(start(w, spark))
    for q in running:
        q.awaitTermination()
        if q.exception():
            raise q.exception()
    found = None
    for name, path in outs.items():
        own = spark.read.parquet(path).select(F.lit(name).alias("subscriber"), "transaction_id", "timestamp")
        found = own if found is None else found.unionByName(own)
    return messages_by_day(found)


def messages_by_day(found: DataFrame) -> DataFrame:
    """Messages and different transactions by subscriber and event day.

    Ids hardly repeat, so a distinct count's hash map holds about every row of
    its task: the rows are dealt by id to tasks of ``COUNT_ROWS``, and the
    fixed number keeps them from being merged again.
    """
    spark = found.sparkSession
    day = F.floor(F.unix_micros("timestamp") / F.lit(86_400_000_000)).cast("bigint")
    tasks = max(spark.sparkContext.defaultParallelism, -(-found.count() // COUNT_ROWS))       # counted from the footers
    per_id = (found.select("subscriber", day.alias("event_day"), "transaction_id").repartition(tasks, "transaction_id")
              .groupBy("subscriber", "event_day", "transaction_id").agg(F.count(F.lit(1)).alias("n")))
    return per_id.groupBy("subscriber", "event_day").agg(
        F.sum("n").alias("messages"), F.count("transaction_id").alias("transactions"))


def stream_static_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:               # T10
    """Stream-static join: decoded stream ⋈ customer (Catalyst broadcasts
    the static side only when it is small) — segment and nation per row."""
    from ..sources.tables import read_table
    src = replay.replay_dir_for(spark, sf_dir)
    out = _out(spark, "enrich")
    cust = read_table(spark, sf_dir, "customer").select(
        F.format_string("card_%05d", F.col("c_custkey")).alias("card_id"),
        F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("home"))
    j = decoded_stream(spark, src).join(cust, "card_id").select(
        "transaction_id", "card_id", "amount", "segment", "home")
    run(j, out)
    return spark.read.parquet(out)


def stream_hourly_join(spark: SparkSession, sf_dir: str) -> DataFrame:                 # J1 (stream form)
    """Stream-stream join: each transaction joined to its card's tumbling
    hourly aggregate on (card, hour window).  Both sides carry the 30-minute
    watermark; a row is emitted once its hour has closed."""
    src = replay.replay_dir_for(spark, sf_dir)
    out = _out(spark, "hourly_join")
    ev = decoded_stream(spark, src).select("transaction_id", "card_id", "timestamp", "amount")
    agg = (decoded_stream(spark, src).groupBy(F.window("timestamp", "1 hour").alias("w"), "card_id")
           .agg(F.count(F.lit(1)).alias("txns_in_hour"),
                F.sum(F.round(F.col("amount") * 100).cast("bigint")).alias("cents_in_hour"))
           .select(F.col("card_id").alias("a_card"), F.col("w.start").alias("ws"),
                   F.window_time("w").alias("wt"), "txns_in_hour", "cents_in_hour"))
    # ``wt`` (the window's last instant) carries the watermark, so the range
    # below lets Spark drop rows of closed hours from both sides' state
    j = ev.join(agg, (ev.card_id == agg.a_card) & (F.date_trunc("hour", ev.timestamp) == agg.ws)
                & (ev.timestamp <= agg.wt) & (ev.timestamp > agg.wt - F.expr("INTERVAL 1 HOUR")))
    run(j.select("transaction_id", "card_id", F.unix_micros("ws").alias("window_start_us"), "amount",
                 "txns_in_hour", (F.col("cents_in_hour") / 100.0).alias("spend_in_hour")), out)
    return spark.read.parquet(out)


def with_rocksdb(spark: SparkSession):
    """Session setting that ``transformWithState`` needs, for the time of a ``with`` block."""
    from contextlib import contextmanager

    @contextmanager
    def held():
        key = "spark.sql.streaming.stateStore.providerClass"
        previous = spark.conf.get(key, None)
        spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        try:
            yield
        finally:
            spark.conf.set(key, previous) if previous else spark.conf.unset(key)

    return held()


def stream_alerts(spark: SparkSession, sf_dir: str, **thresholds: float) -> DataFrame:   # T5 D1 D5 D8 D10 D11
    """Alerts of the per-card detectors, from rows whose ten minutes the watermark has passed."""
    out = _out(spark, "alerts")
    src = replay.replay_dir_for(spark, sf_dir)
    with with_rocksdb(spark):
        run(card_alerts(decoded_stream(spark, src), **thresholds), out)
    return spark.read.parquet(out)


def stream_test_then_big(spark: SparkSession, sf_dir: str, small_lo: float = 50.0, small_hi: float = 200.0,
                         big: float = 20000.0, within: str = "1 hour") -> DataFrame:     # J9 J10 (stream-stream)
    """Each large payment with every small one of its card in the hour before.

    A stream-stream join on the card with a time range: both sides carry the
    watermark, so Spark drops a small payment from state once no later large
    one can reach it, and a large one once no earlier small one can still come.
    """
    src = replay.replay_dir_for(spark, sf_dir)
    out = _out(spark, "test_then_big")
    small = (decoded_stream(spark, src).where(F.col("amount").between(small_lo, small_hi))
             .select(F.col("card_id").alias("small_card"), F.col("transaction_id").alias("small_id"),
                     F.col("timestamp").alias("small_at"), F.col("amount").alias("small_amount")))
    large = decoded_stream(spark, src).where(F.col("amount") >= big).select("transaction_id", "card_id", "timestamp", "amount")
    joined = large.join(small, (F.col("card_id") == F.col("small_card")) & (F.col("transaction_id") != F.col("small_id"))
                        & (F.col("small_at") <= F.col("timestamp")) & (F.col("small_at") >= F.col("timestamp") - F.expr(f"INTERVAL {within}")))
    run(joined.select("transaction_id", "card_id", F.unix_micros("timestamp").alias("event_us"), "amount",
                      "small_id", F.unix_micros("small_at").alias("small_us"), "small_amount"), out)
    return spark.read.parquet(out)


def stream_far_pairs(spark: SparkSession, sf_dir: str, km: float = 500.0, within: str = "30 minutes") -> DataFrame:  # J9 (stream-stream)
    """Each payment with every earlier one of its card inside ``within`` that is more than ``km`` away; state as in ``stream_test_then_big``."""
    src = replay.replay_dir_for(spark, sf_dir)
    out = _out(spark, "far_pairs")
    own = decoded_stream(spark, src).select("transaction_id", "card_id", "timestamp", "location_lat", "location_lon")
    before = decoded_stream(spark, src).select(F.col("card_id").alias("b_card"), F.col("transaction_id").alias("earlier_id"), F.col("timestamp").alias("earlier_at"),
                                               F.col("location_lat").alias("b_lat"), F.col("location_lon").alias("b_lon"))
    pairs = own.join(before, (F.col("card_id") == F.col("b_card")) & (F.col("earlier_at") < F.col("timestamp"))
                     & (F.col("earlier_at") >= F.col("timestamp") - F.expr(f"INTERVAL {within}")))
    far = pairs.withColumn("km", haversine_km("b_lat", "b_lon", "location_lat", "location_lon")).where(F.col("km") > km)
    run(far.select("transaction_id", "card_id", F.unix_micros("timestamp").alias("event_us"), "earlier_id", "km"), out)
    return spark.read.parquet(out)


def stream_fraud_alerts(spark: SparkSession, sf_dir: str, **thresholds: float) -> DataFrame:   # S9
    """``fraud_alerts`` as the detectors feed it: one folder a batch, rewritten if the batch is repeated."""
    out = _out(spark, "fraud")
    src = replay.replay_dir_for(spark, sf_dir)
    with with_rocksdb(spark):
        run(card_alerts(decoded_stream(spark, src), **thresholds), out + "/_unused", foreach_batch=alert_table(out), checkpoint=out + "-ckpt")
    return spark.read.option("basePath", f"{out}/fraud_alerts").parquet(f"{out}/fraud_alerts/batch_id=*")


def stream_three_outputs(spark: SparkSession, sf_dir: str, table: str = "raw_transactions",
                         alert_amount: float = 150.0) -> DataFrame:                   # S8 S9
    src = replay.replay_dir_for(spark, sf_dir)
    base = _out(spark, "three")
    run(decoded_stream(spark, src), base + "/_unused", foreach_batch=three_outputs(base, F.col("amount") > alert_amount),
        checkpoint=base + "-ckpt")
    return spark.read.option("basePath", f"{base}/{table}").parquet(f"{base}/{table}/batch_id=*")
