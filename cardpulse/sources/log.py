"""A message log with (partition, offset) positions, replayed from any of them.

Rows are numbered once: range-partitioned by time into ranges of about
``TASK_BYTES``, counted per task and log partition, and numbered by the counts
before them, so that no window holds more than one range of rows.  Slices are cut by bytes; their number grows with
the input.  A small index (one row per slice and partition) says which slices
a replay has to read.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LOG_SCHEMA = "key binary, value binary, timestamp timestamp, partition int, offset bigint"
SLICE_BYTES = 128 << 20
TASK_BYTES = 32 << 20  # of messages that one task sorts or deals
_ORDER = ("timestamp", "key", "value")


def write_log(env: DataFrame, path: str, partition: Column, slice_bytes: int = SLICE_BYTES, files_per_slice: int = 1) -> str:
    """Number and store ``env`` (key, value, timestamp) under ``path``: ``log/slice=…`` in time order, and ``index``.

    ``partition`` gives each message its log partition (not null).  Offsets
    count from 0 in the order of time, key and value; equal messages are
    interchangeable.  Messages without a time come first.
    """
    spark = env.sparkSession
    size = F.coalesce(F.length("value"), F.lit(0)) + F.coalesce(F.length("key"), F.lit(0)) + F.lit(16)
    total = env.select(F.sum(size)).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, -(-total // TASK_BYTES))        # fixed: messages shrink tenfold in a shuffle, by which partitions would be merged
    (env.select("key", "value", "timestamp", partition.cast("int").alias("partition"))
     .repartitionByRange(tasks, *_ORDER).withColumn("task", F.spark_partition_id()).withColumn("bytes", size.cast("bigint"))
     .write.mode("overwrite").parquet(f"{path}/staged"))
    staged = spark.read.parquet(f"{path}/staged")

    # rows per (task, partition) and bytes per task: small tables
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    counts = staged.groupBy("task", "partition").agg(F.count(F.lit(1)).alias("n"))
    first_offset = counts.select("task", "partition", F.coalesce(F.sum("n").over(before.partitionBy("partition").orderBy("task")), F.lit(0)).alias("rows_before"))
    first_byte = (staged.groupBy("task").agg(F.sum("bytes").alias("n"))
                  .select("task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("bytes_before")))
    inside = Window.partitionBy("task").orderBy(*_ORDER).rowsBetween(Window.unboundedPreceding, 0)
    own = Window.partitionBy("task", "partition").orderBy(*_ORDER)
    numbered = (staged.repartition(tasks, "task").withColumn("upto", F.sum("bytes").over(inside)).withColumn("nth", F.row_number().over(own))
                .join(first_offset, ["task", "partition"]).join(first_byte, "task"))
    slice_no = F.floor((F.col("bytes_before") + F.col("upto") - F.col("bytes")) / F.lit(slice_bytes)).cast("int")
    (numbered.select("key", "value", "timestamp", "partition", (F.col("rows_before") + F.col("nth") - 1).cast("bigint").alias("offset"), slice_no.alias("slice"))
     .write.mode("overwrite").partitionBy("slice").parquet(f"{path}/numbered"))
    rows = spark.read.parquet(f"{path}/numbered")
    (rows.groupBy("slice", "partition")
     .agg(F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"), F.count(F.lit(1)).alias("messages"),
          F.min("timestamp").alias("first_time"), F.max("timestamp").alias("last_time"))
     .coalesce(1).write.mode("overwrite").parquet(f"{path}/index"))
    # the file source reads in the order of modification times: one write per slice, oldest first
    for i in [r["slice"] for r in index(spark, path).select("slice").distinct().orderBy("slice").toLocalIterator()]:
        rows.filter(F.col("slice") == i).drop("slice").repartition(files_per_slice).write.mode("overwrite").parquet(f"{path}/log/slice={i:06d}")
    return path


def index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/index")


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).parquet(f"{path}/log/*")


def positions_at(spark: SparkSession, path: str, when: datetime) -> dict[int, int]:
    """Per partition the first offset whose message and all later ones are not before ``when``; its end offset if there is none.

    Offsets follow time, so this is the number of messages before ``when``:
    taken from the index, and from the rows of the one slice that ``when`` cuts.
    """
    idx = index(spark, path)
    at = F.lit(when)
    whole = (idx.filter(F.coalesce(F.col("last_time") < at, F.lit(True))).groupBy("partition").agg(F.sum("messages").alias("n")))
    cut = idx.filter((F.col("last_time") >= at) & (F.col("first_time") < at)).select("slice").distinct()
    folders = [f"{path}/log/slice={r['slice']:06d}" for r in cut.collect()]            # slices that hold both sides of one instant
    found = idx.select("partition").distinct().join(whole, "partition", "left").select("partition", F.coalesce("n", F.lit(0)).alias("n"))
    if folders:
        part = (spark.read.schema(LOG_SCHEMA).parquet(*folders).groupBy("partition")
                .agg(F.min(F.when(F.col("timestamp") >= at, F.col("offset"))).alias("first")))
        found = found.join(part, "partition", "left").select("partition", F.coalesce("first", "n").alias("n"))
    return {r["partition"]: r["n"] for r in found.collect()}                           # one row per partition


def _ranges(start: dict[int, int] | None, end: dict[int, int] | None, low: str, high: str) -> Column:
    """Rows whose offsets [``low``, ``high``] meet [start, end) of their partition; partitions not named are read whole."""
    out = F.lit(True)
    for partition, offset in (start or {}).items():
        out = out & ((F.col("partition") != partition) | (F.col(high) >= offset))
    for partition, offset in (end or {}).items():
        out = out & ((F.col("partition") != partition) | (F.col(low) < offset))
    return out


def read_from(spark: SparkSession, path: str, start: dict[int, int] | None = None, end: dict[int, int] | None = None,
              files_per_trigger: int = 1) -> DataFrame:
    """The log as a stream from the ``start`` offsets (inclusive) up to the ``end`` offsets (exclusive), by partition.

    Only slices that the index names are listed and read.
    """
    wanted = index(spark, path).filter(_ranges(start, end, "first_offset", "last_offset")).select("slice").distinct()
    names = [f"{r['slice']:06d}" for r in wanted.collect()] or ["none"]                # one short name per slice
    return (spark.readStream.schema(LOG_SCHEMA).option("maxFilesPerTrigger", files_per_trigger)
            .parquet(f"{path}/log/slice={{{','.join(sorted(names))}}}")
            .filter(_ranges(start, end, "offset", "offset")))
