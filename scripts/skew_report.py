"""Measure how a hot card is spread over tasks: plain per-card windows vs the
bucketed sequence engine, on the driver's transactions with a third of the
rows re-assigned to one card.  Reads task metrics from a Spark event log in
a fresh scratch folder and prints a Markdown table (→ SKEW.md).

usage: python scripts/skew_report.py [sf_dir] > SKEW.md
"""
import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    logdir = tempfile.mkdtemp(prefix="skew-eventlog-")
    spark = (SparkSession.builder.master("local[8]").appName("skew-report")
             .config("spark.ui.enabled", "false").config("spark.driver.memory", "12g")
             .config("spark.sql.shuffle.partitions", "64")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", logdir)
             .config("spark.eventLog.compress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from cardpulse.operators.timeline import DAY_US, HOUR_US, plain_sequence_features, sequence_features
    from cardpulse.session import ensure_checkpoint_dir
    from cardpulse.sources.tables import transactions
    ensure_checkpoint_dir(spark)

    txn = transactions(spark, sf)
    hot = txn.withColumn("card_id", F.when(F.col("transaction_id") % 3 == 0, F.lit(0)).otherwise(F.col("card_id")))
    cents = F.round(F.col("amount") * 100).cast("bigint")
    kw = dict(frames={"1hr": HOUR_US, "24hr": DAY_US, "30d": 30 * DAY_US},
              sums={"n": F.lit(1).cast("bigint"), "cents": cents}, prior={"cents": cents},
              previous=["lat", "lon"], first_use={"m": "merchant_name"})
    total = hot.count()
    hot_rows = hot.filter(F.col("card_id") == 0).count()
    walls = {}
    for name, fn in (("plain per-card windows", plain_sequence_features), ("bucketed engine", sequence_features)):
        spark.sparkContext.setJobGroup(name, name)
        t0 = time.time()
        fn(hot, **kw).write.format("noop").mode("overwrite").save()
        walls[name] = time.time() - t0

    # interval self-join (any transaction > 500 km away within 30 min)
    from cardpulse.functions.geo import haversine_km
    from cardpulse.operators.enrich import impossible_travel_any
    a, b = hot.alias("a"), hot.alias("b")
    naive = (a.join(b, (F.col("a.card_id") == F.col("b.card_id"))
                    & (F.col("b.ts") >= F.col("a.ts") - F.expr("INTERVAL 30 MINUTES")) & (F.col("b.ts") <= F.col("a.ts")))
             .filter(haversine_km("b.lat", "b.lon", "a.lat", "a.lon", digits=None) > 500)
             .groupBy(F.col("a.transaction_id")).count())
    joins = {}
    for name, df in (("self-join on card + time range", naive), ("bucketed, grid-pruned (J9)", impossible_travel_any(hot))):
        spark.sparkContext.setJobGroup(name, name)
        t0 = time.time()
        df.write.format("noop").mode("overwrite").save()
        joins[name] = time.time() - t0
    spark.stop()

    stage_group, tasks = {}, {}
    for fn in sorted(glob.glob(f"{logdir}/*/events_*")) or glob.glob(f"{logdir}/*"):
        for line in open(fn):
            e = json.loads(line)
            if e["Event"] == "SparkListenerJobStart":
                g = e.get("Properties", {}).get("spark.jobGroup.id")
                for s in e["Stage Infos"]:
                    stage_group[s["Stage ID"]] = g
            elif e["Event"] == "SparkListenerTaskEnd" and e.get("Task Metrics"):
                sr = e["Task Metrics"].get("Shuffle Read Metrics", {})
                recs = sr.get("Total Records Read", 0)
                if recs:
                    tasks.setdefault(e["Stage ID"], []).append(recs)
    print("# SKEW — how one hot card is spread over tasks\n")
    print(f"Input: `transactions` at `{sf}` ({total:,} rows) with every third transaction re-assigned "
          f"to card 0 ({hot_rows:,} rows, {hot_rows / total:.0%}). Same features (1 h / 24 h / 30 d "
          "trailing sums, prior-row sums, previous row, first use) computed both ways on local[8] with "
          "64 shuffle partitions (coalescing off); task metrics come from the Spark event log.\n")
    print("| method | hash-shuffle stages | rows in the fact exchange | largest task (records) | largest / mean task "
          "| largest task / hot-card rows | wall s |")
    print("|---|---|---|---|---|---|---|")
    for name in walls:
        # hash-partitioned exchanges have exactly 64 reducers (coalescing off);
        # the 8-task round-robin rebalance of the one-split input is left out
        stages = [s for s, g in stage_group.items() if g == name and len(tasks.get(s, [])) == 64]
        main = max(stages, key=lambda s: sum(tasks[s]))          # the exchange of the fact rows
        biggest, mean = max(tasks[main]), sum(tasks[main]) / len(tasks[main])
        print(f"| {name} | {len(stages)} | {sum(tasks[main]):,} | {biggest:,} | {biggest / mean:.1f}× "
              f"| {biggest / hot_rows:.2f} | {walls[name]:.1f} |")
    print("\n## Interval self-join (J9)\n")
    print("| method | hash-shuffle stages | largest task (records) | largest / mean task | wall s |")
    print("|---|---|---|---|---|")
    for name in joins:
        stages = [s for s, g in stage_group.items() if g == name and len(tasks.get(s, [])) == 64]
        allt = [x for s in stages for x in tasks[s]]
        if not allt:
            continue
        main = max(stages, key=lambda s: max(tasks[s]))
        biggest, mean = max(tasks[main]), sum(tasks[main]) / len(tasks[main])
        print(f"| {name} | {len(stages)} | {biggest:,} | {biggest / mean:.1f}× | {joins[name]:.1f} |")
    print("\nWith plain windows every row of the hot card is read by one task, however many executors "
          "there are. The engine exchanges more rows (primaries, one tail copy per frame, first-use "
          "markers), but spreads the hot card over its card-hour buckets, so the largest task stays "
          "near the mean; at 1000× the data the plain form's largest task grows 1000×, the engine's "
          "only with the traffic of one card-hour.  For the interval self-join, AQE's skew-join split "
          "keeps the naive plan's tasks from being very unequal, but every split still pairs its rows "
          "with all of the hot card's rows in range; the bucketed join pairs a row only with the "
          "distinct places of far grid cells in its own and the previous 30-minute bucket.")


if __name__ == "__main__":
    main()
