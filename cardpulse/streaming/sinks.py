"""Batch and streaming sinks.

``foreachBatch`` writers are idempotent: each output goes to
``<table>/batch_id=<n>`` with overwrite, so a micro-batch replayed after a
failure replaces its own earlier attempt instead of duplicating it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import TRANSACTION_SCHEMA


def console(df: DataFrame, checkpoint: str, trigger_seconds: int | None = 5, truncate: bool = False):  # S4
    w = (df.writeStream.format("console").option("truncate", str(truncate).lower())
         .option("checkpointLocation", checkpoint).outputMode("append"))
    if trigger_seconds:
        w = w.trigger(processingTime=f"{trigger_seconds} seconds")
    return w.start()


def write_csv(df: DataFrame, path: str) -> None:                                        # S11
    """CSV with header; NULL as empty; booleans lower-case; fields quoted
    only when needed (a name containing a comma stays one field)."""
    out = df.select([F.col(c).cast("string").alias(c) if t == "boolean" else F.col(c)
                     for c, t in df.dtypes])
    out.write.mode("overwrite").option("header", True).option("nullValue", "").option("emptyValue", "").csv(path)


def read_csv(spark, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("nullValue", "").csv(path)


def write_json(df: DataFrame, path: str) -> None:                                       # S12
    df.write.mode("overwrite").json(path)


def _clustered(df: DataFrame, by: str, cluster: tuple[str, ...]) -> DataFrame:
    """Ranges of (``by``, ``cluster``), sorted: a table of N ranges and D values of ``by`` has at most N + D files, each with a
    narrow range of the first cluster column; a hot value is split by the columns behind it."""
    return df.repartitionByRange(by, *cluster).sortWithinPartitions(by, *cluster)


def write_partitioned(df: DataFrame, path: str, by: str = "event_date", cluster: tuple[str, ...] = ("card_id", "transaction_id")) -> None:  # S8
    """Parquet partitioned by event date (readers prune on the date) and clustered by card inside a date."""
    _clustered(df, by, cluster).write.mode("overwrite").partitionBy(by).parquet(path)


def enriched_table(base: str, cluster: tuple[str, ...] = ("card_id", "timestamp")):      # S8 T6
    """``foreachBatch`` function: rows by event date and batch; a repeated batch replaces its own files."""
    def _write(batch: DataFrame, batch_id: int) -> None:
        (_clustered(batch.withColumn("event_date", F.to_date("timestamp")), "event_date", cluster).withColumn("batch_id", F.lit(batch_id))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_date", "batch_id").parquet(f"{base}/batches"))
    return _write


def compact_enriched(spark: SparkSession, base: str, before, cluster: tuple[str, ...] = ("card_id", "timestamp")) -> None:
    """Rewrite the days before the date ``before`` as few clustered files each.

    A compacted day remembers the last batch it holds, so rows that come late
    are read from their batch until the day is compacted again.  Running it
    twice, or again after a failure, changes nothing.
    """
    rows = spark.read.parquet(f"{base}/batches").filter(F.col("event_date") < F.lit(before))
    upto = rows.groupBy("event_date").agg(F.max("batch_id").alias("upto_batch"))         # one row per day
    (_clustered(rows.join(upto, "event_date"), "event_date", cluster)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_date").parquet(f"{base}/compacted"))


def read_enriched(spark: SparkSession, base: str, compacted: bool = True) -> DataFrame:
    """All rows once: compacted days, and the batches that came after a day was compacted."""
    rows = spark.read.parquet(f"{base}/batches")
    if not compacted:
        return rows
    done = spark.read.parquet(f"{base}/compacted")
    upto = done.groupBy("event_date").agg(F.max("upto_batch").alias("upto_batch"))       # one row per day
    newer = rows.join(upto, "event_date", "left").filter(F.col("batch_id") > F.coalesce("upto_batch", F.lit(-1))).drop("upto_batch")
    return done.drop("upto_batch").unionByName(newer)


def alert_table(base: str):                                                              # S9
    """foreachBatch function writing the alerts of a batch to their own folder."""
    def _write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/fraud_alerts/batch_id={batch_id}")
    return _write


def three_outputs(base: str, alert_predicate):                                          # S9
    """foreachBatch function writing raw rows, alerts and per-batch stats."""
    def _write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            batch.write.mode("overwrite").parquet(f"{base}/raw_transactions/batch_id={batch_id}")
            batch.filter(alert_predicate).write.mode("overwrite").parquet(
                f"{base}/fraud_alerts/batch_id={batch_id}")
            (batch.agg(F.count(F.lit(1)).alias("rows"),
                       F.sum(F.col("is_fraud").cast("bigint")).alias("fraud_rows"),
                       F.min("timestamp").alias("min_event_time"), F.max("timestamp").alias("max_event_time"))
             .withColumn("batch_id", F.lit(batch_id))
             .write.mode("overwrite").parquet(f"{base}/processing_stats/batch_id={batch_id}"))
        finally:
            batch.unpersist()
    return _write


MODEL_FIELDS = [f.name for f in TRANSACTION_SCHEMA.fields]
