"""Offline replay: a broker-shaped file stream cut into event-time slices.

A Kafka consumer can rewind to any offset; offline, the same effect comes
from writing the messages into time-ordered slices under the shared
checkpoint folder and reading them with the streaming file source, one
slice per micro-batch (files are picked up in modification-time order).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import ENVELOPE_SCHEMA
from ..session import shared_path
from .log import SLICE_BYTES, TASK_BYTES

#: A trigger's share of values for one core: more cores take more of the stream
#: at once, so that the fixed cost of a micro-batch is spread over more rows.
CORE_BYTES = 64 << 20

REPLAY_SCHEMA = "key binary, value binary, timestamp timestamp"

#: The late fixture: every ``LATE_EVERY``-th transaction before this instant
#: (2024-01-10 UTC) is delivered after all others.
LATE_BEFORE_US, LATE_EVERY = 1_704_844_800_000_000, 50


def trigger_bytes(spark: SparkSession) -> int:
    """Values of one trigger."""
    return max(SLICE_BYTES, CORE_BYTES * spark.sparkContext.defaultParallelism)


def is_late() -> Column:
    number = F.conv(F.substring(F.col("key").cast("string"), 5, 12), 16, 10).cast("bigint")
    is_transaction = F.col("key").cast("string").startswith("txn_")
    return is_transaction & (F.unix_micros("timestamp") < LATE_BEFORE_US) & (number % LATE_EVERY == 0)


def write_slices(env: DataFrame, out_dir: str, slices: int = 6, copies: int = 1,
                 files_per_slice: int = 1, late: Column | None = None, slice_bytes: int = SLICE_BYTES) -> str:
    """Write ``env`` as ``slices`` equal event-time ranges, or as many as hold
    ``slice_bytes`` of values each if that is more, so that a trigger's input does not grow with the table;
    each ``copies`` times (copies > 1 models at-least-once redelivery).  Rows for which
    ``late`` holds are held back and delivered as one more slice at the end.

    The input is materialised once next to the replay folder as it comes,
    dealt once into one folder per slice by tasks of ``TASK_BYTES``, and each
    folder is then written out by one small job, which keeps the slice order
    in file modification time for the streaming file source.  Every step reads
    a message once, however many slices there are.
    """
    spark = env.sparkSession
    staging, dealt = out_dir.rstrip("/") + "-staging", out_dir.rstrip("/") + "-dealt"
    env.write.mode("overwrite").parquet(staging)
    everything = spark.read.parquet(staging)
    held_back = F.lit(False) if late is None else F.coalesce(late, F.lit(False))
    size = F.length("value")
    lo_hi = everything.agg(F.unix_micros(F.min(F.when(~held_back, F.col("timestamp")))).alias("lo"),
                           F.unix_micros(F.max(F.when(~held_back, F.col("timestamp")))).alias("hi"),
                           F.sum(F.when(~held_back, size)).alias("bytes"), F.sum(size).alias("all_bytes")).first()
    slices = max(slices, -(-(lo_hi["bytes"] or 0) // slice_bytes))
    lo, hi = lo_hi["lo"], lo_hi["hi"] + 1
    width = -(-(hi - lo) // slices)
    number = F.when(held_back, F.lit(slices)).otherwise(F.floor((F.unix_micros("timestamp") - F.lit(lo)) / F.lit(width)).cast("int"))
    tasks = max(spark.sparkContext.defaultParallelism, -(-(lo_hi["all_bytes"] or 0) // TASK_BYTES))
    share = F.pmod(F.xxhash64("key", "value"), F.lit(max(1, 2 * tasks // slices)))      # a slice is dealt by several tasks
    (everything.filter(F.col("timestamp").isNotNull()).withColumn("slice", number)
     .repartition(tasks, "slice", share).write.mode("overwrite").partitionBy("slice").parquet(dealt))
    rows = spark.read.schema(f"{REPLAY_SCHEMA}, slice int").parquet(dealt)
    for i in range(slices):
        part = rows.filter(F.col("slice") == i).drop("slice")
        # exactly ``files_per_slice`` files per slice (round-robin), so a
        # trigger of that many files reads one whole slice
        part = part.repartition(files_per_slice) if files_per_slice > 1 else part.coalesce(1)
        for c in range(copies):
            part.write.mode("overwrite").parquet(f"{out_dir}/slice={i:05d}-copy={c}")
    if late is not None:
        rows.filter(F.col("slice") == slices).drop("slice").coalesce(files_per_slice).write.mode("overwrite").parquet(f"{out_dir}/slice={slices:05d}-late")
    _FILES_PER_SLICE[out_dir] = files_per_slice
    return out_dir


_FILES_PER_SLICE: dict[str, int] = {}


def read_stream(spark: SparkSession, replay_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The replay as a streaming DataFrame with the broker envelope columns,
    one slice per micro-batch."""
    files = max_files_per_trigger or _FILES_PER_SLICE.get(replay_dir, 1)
    return (spark.readStream.schema(REPLAY_SCHEMA)
            .option("maxFilesPerTrigger", files)
            .parquet(f"{replay_dir}/*/*.parquet"))


def read_batch(spark: SparkSession, replay_dir: str) -> DataFrame:
    return spark.read.schema(REPLAY_SCHEMA).parquet(f"{replay_dir}/*/*.parquet")


_CACHE: dict[tuple, str] = {}


def replay_dir_for(spark: SparkSession, sf_dir: str, slices: int = 6, copies: int = 1,
                   with_junk: bool = True, late: bool = False) -> str:
    """Replay files for a driver data folder, written once per session."""
    from .model import envelopes
    key = (spark.sparkContext.applicationId, sf_dir, slices, copies, with_junk, late)
    if key not in _CACHE:
        out = shared_path(spark, "replay", f"s{slices}c{copies}")
        files = max(1, spark.sparkContext.defaultParallelism)
        write_slices(envelopes(spark, sf_dir, with_junk), out, slices, copies, files_per_slice=files,
                     late=is_late() if late else None, slice_bytes=trigger_bytes(spark))
        _CACHE[key] = out
    return _CACHE[key]


__all__ = ["write_slices", "read_stream", "read_batch", "replay_dir_for", "ENVELOPE_SCHEMA"]
