"""Dashboard tables kept up to date by the stream.

A micro-batch writes partial aggregates, partitioned by event day and batch,
and replaces its own partitions when it is repeated.  Every value is a sum, so
a dashboard adds up the partials of the days that it shows and never reads
transactions; "last hour" reads the partitions of one day (two past midnight).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MINUTE_US, HOUR_US = 60_000_000, 3_600_000_000


def _step(us: int) -> Column:
    return F.floor(F.unix_micros("timestamp") / F.lit(us)).cast("bigint")


def _sums() -> list[Column]:
    cents = F.round(F.col("amount") * 100).cast("bigint")
    return [F.count(F.lit(1)).alias("txns"), F.sum(F.col("is_fraud").cast("bigint")).alias("fraud_txns"),
            F.sum(cents).alias("cents"), F.sum(F.when(F.col("is_fraud"), cents).otherwise(0)).alias("fraud_cents")]


def rollup_keys() -> dict[str, dict[str, Column]]:
    """Table -> its keys beside the event day."""
    return {
        "by_minute": {"minute": _step(MINUTE_US), "merchant_category": F.col("merchant_category")},
        "by_cell": {"cell_lat": F.floor("location_lat").cast("double"), "cell_lon": F.floor("location_lon").cast("double")},
        "by_card_hour": {"hour": _step(HOUR_US), "card_id": F.col("card_id")},
    }


def write_rollups(base: str):
    """``foreachBatch`` function: the partials of one batch, and the batch's latest event time."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.select("timestamp", "card_id", "amount", "is_fraud", "merchant_category", "location_lat", "location_lon").persist()
        try:
            for name, keys in rollup_keys().items():
                sums = batch.groupBy(F.to_date("timestamp").alias("day"), *[c.alias(k) for k, c in keys.items()]).agg(*_sums()).withColumn("batch_id", F.lit(batch_id))
                # a batch has few days: a table that grows with the cards is written by card, the small ones as a file a day
                (sums.repartition("day", *[k for k in keys if k == "card_id"])
                 .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch_id").parquet(f"{base}/{name}"))
            (batch.agg(F.max(F.unix_micros("timestamp")).alias("latest_us"))
             .write.mode("overwrite").parquet(f"{base}/latest/batch_id={batch_id}"))
        finally:
            batch.unpersist()
    return write


def partials(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base}/{name}")


def fraud_rate_by_day(spark: SparkSession, base: str) -> DataFrame:                     # A6
    t = partials(spark, base, "by_minute").groupBy("day").agg(F.sum("txns").alias("txns"), F.sum("fraud_txns").alias("fraud_txns"))
    return t.select("day", "txns", "fraud_txns", (F.col("fraud_txns") / F.col("txns")).alias("fraud_rate"))


def categories_last_hour(spark: SparkSession, base: str) -> DataFrame:                  # A10
    """Totals by category over the 60 minutes up to and with the latest event's minute."""
    latest = spark.read.parquet(f"{base}/latest").select(F.max("latest_us")).scalar()
    minute = F.floor(latest / F.lit(MINUTE_US)).cast("bigint")
    first_day = F.to_date(F.timestamp_micros((minute - 59) * F.lit(MINUTE_US)))
    recent = partials(spark, base, "by_minute").filter((F.col("day") >= first_day) & (F.col("minute") > minute - 60))
    return recent.groupBy("merchant_category").agg(
        F.sum("txns").alias("txns"), F.sum("fraud_txns").alias("fraud_txns"), (F.sum("fraud_cents") / 100.0).alias("fraud_amount"))


def heatmap(spark: SparkSession, base: str) -> DataFrame:                               # A9
    return (partials(spark, base, "by_cell").groupBy("cell_lat", "cell_lon")
            .agg(F.sum("txns").alias("txns"), F.sum("fraud_txns").alias("fraud_txns"), (F.sum("cents") / 100.0).alias("amount_total")))


def card_hours(spark: SparkSession, base: str) -> DataFrame:                            # A4
    return (partials(spark, base, "by_card_hour").groupBy("card_id", (F.col("hour") * HOUR_US).alias("window_start_us"))
            .agg(F.sum("txns").alias("txns"), (F.sum("cents") / (F.lit(100.0) * F.sum("txns"))).alias("avg_amount")))
