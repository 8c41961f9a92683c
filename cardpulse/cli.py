"""Command-line entry points.

``stream``   the streaming job: Kafka (or a replay folder) → JSON decode with a
             quarantine side output → 30-minute watermark → per-card keyed
             features and rule flags → console / Parquet sink, micro-batch
             every 5 s (or ``--available-now`` to drain and stop).
``batch``    features and flags written once as the enriched table (by event
             date); alerts, stats and dashboard tables read from it.
``publish``  write wire-format transaction messages derived from a driver
             data folder (optionally with injected, labelled fraud) to the
             console, CSV, JSON lines or a Kafka topic; ``--count N`` stops
             after N messages (first N by event time).

    python -m cardpulse.cli stream --source replay --replay-dir DIR --sink parquet --out OUT --available-now
    python -m cardpulse.cli publish --sf-dir /root/testdata/sf0.01 --mode csv --out OUT --count 100
"""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from .session import build_session, shared_path, ship_package
from .sources import decode as dec
from .sources import kafka, replay
from .streaming import jobs
from .streaming.state import card_state_features


def _stream(args) -> None:
    spark = build_session(args.app_name, master=args.master)
    ship_package(spark)
    if args.source == "kafka":
        raw = kafka.read_stream(spark, args.servers, args.topic, starting=args.starting_offsets,
                                group_id=args.group_id, max_offsets_per_trigger=args.max_offsets)
    else:
        raw = replay.read_stream(spark, args.replay_dir)
    base = args.checkpoint or shared_path(spark, "app")
    decoded = dec.decode(raw).withWatermark("timestamp", args.watermark)
    feats = card_state_features(decoded)
    alerts = feats.withColumn(
        "impossible_travel", F.coalesce((F.col("distance_from_last_txn_km") > 500)
                                        & (F.col("minutes_since_last_txn") <= 30), F.lit(False)))
    queries = []
    bad = dec.quarantine(raw)
    for name, df in (("features", alerts), ("quarantine", bad)):
        w = df.writeStream.option("checkpointLocation", f"{base}/{name}-ckpt").outputMode("append")
        w = w.format("console").option("truncate", "false") if args.sink == "console" else \
            w.format("parquet").option("path", f"{args.out}/{name}")
        w = w.trigger(availableNow=True) if args.available_now else \
            w.trigger(processingTime=f"{args.trigger_seconds} seconds")
        queries.append(jobs.start(w, spark))
    for q in queries:
        q.awaitTermination()


def _batch(args) -> None:
    """Batch job: per-card features and rule flags computed once and written
    as the enriched-transactions table (partitioned by event date); alerts,
    processing stats and dashboard tables are then read from that table, so
    each downstream output starts from a written table, not from the
    feature shuffle."""
    from .operators import dashboards as dash
    from .operators import rules
    from .plans.catalog import alert_rows
    from .sources.tables import transactions
    spark = build_session(args.app_name, master=args.master)
    out = args.out.rstrip("/")
    flags = rules.rule_set(odd_hour_amount=args.odd_hour_amount, limit_ratio=args.limit_ratio, spend_multiple=args.spend_multiple)
    enriched = rules.all_flags(transactions(spark, args.sf_dir), flags).withColumn("event_date", F.to_date("ts"))
    enriched.write.mode("overwrite").partitionBy("event_date").parquet(f"{out}/enriched_transactions")
    table = spark.read.parquet(f"{out}/enriched_transactions")
    alert_rows(table).write.mode("overwrite").parquet(f"{out}/fraud_alerts")
    dash.processing_stats(table).write.mode("overwrite").parquet(f"{out}/processing_stats")
    dash.fraud_rate_over_time(table).write.mode("overwrite").parquet(f"{out}/fraud_rate_over_time")
    dash.geo_heatmap(table).write.mode("overwrite").parquet(f"{out}/geo_heatmap")
    dash.top_risky_cards(alert_rows(table)).write.mode("overwrite").parquet(f"{out}/top_risky_cards")


def _publish(args) -> None:
    spark = build_session(args.app_name, master=args.master)
    from .operators.inject import inject_fraud
    from .sources.model import model_records
    from .streaming import sinks
    recs = model_records(spark, args.sf_dir, keep_source=args.inject)
    if args.inject:
        recs = inject_fraud(recs).drop("source_id", "source_ts", "complexity")
    if args.count:
        recs = recs.orderBy("timestamp", "transaction_id").limit(args.count)
    if args.mode == "local":
        # partition by partition, so printing all messages holds one partition at a time
        for row in recs.select(F.to_json(F.struct(*recs.columns)).alias("message")).toLocalIterator():
            print(row["message"])
    elif args.mode == "csv":
        sinks.write_csv(recs, args.out)
    elif args.mode == "json":
        sinks.write_json(recs, args.out)
    else:
        kafka.write_batch(recs, args.servers, args.topic)


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="cardpulse")
    p.add_argument("--app-name", default="cardpulse")
    p.add_argument("--master", default=None, help="only for local runs; spark-submit sets it otherwise")
    sub = p.add_subparsers(dest="cmd", required=True)

    s = sub.add_parser("stream")
    s.add_argument("--source", choices=["kafka", "replay"], default="kafka")
    s.add_argument("--servers", default="")
    s.add_argument("--topic", default="transactions")
    s.add_argument("--group-id", default=None)
    s.add_argument("--starting-offsets", default="latest")
    s.add_argument("--max-offsets", type=int, default=None)
    s.add_argument("--replay-dir")
    s.add_argument("--sink", choices=["console", "parquet"], default="console")
    s.add_argument("--out")
    s.add_argument("--checkpoint", default=None, help="default: a folder under spark.checkpoint.dir")
    s.add_argument("--watermark", default=jobs.WATERMARK)
    s.add_argument("--trigger-seconds", type=int, default=jobs.TRIGGER_SECONDS)
    s.add_argument("--available-now", action="store_true")
    s.set_defaults(fn=_stream)

    b = sub.add_parser("batch")
    b.add_argument("--sf-dir", required=True)
    b.add_argument("--out", required=True)
    b.add_argument("--odd-hour-amount", type=float, default=500.0)
    b.add_argument("--limit-ratio", type=float, default=0.6)
    b.add_argument("--spend-multiple", type=float, default=3.0)
    b.set_defaults(fn=_batch)

    g = sub.add_parser("publish")
    g.add_argument("--sf-dir", required=True)
    g.add_argument("--mode", choices=["local", "csv", "json", "kafka"], default="local")
    g.add_argument("--count", type=int, default=0, help="0 = all")
    g.add_argument("--out")
    g.add_argument("--servers", default="")
    g.add_argument("--topic", default="transactions")
    g.add_argument("--inject", action="store_true", help="rewrite ~4%% of messages into labelled fraud")
    g.set_defaults(fn=_publish)

    args = p.parse_args(argv)
    args.fn(args)


if __name__ == "__main__":
    main()
