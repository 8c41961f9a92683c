"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardpulse.session import shared_path, ship_package

#: Rows that a Python function gets at once; texts of a larger Arrow batch are not held together as Python objects.
BATCH_ROWS = 2048


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    This cuts lineage with files every executor can read, so a lost executor
    costs only its running tasks.
    """
    spark = df.sparkSession
    path = shared_path(spark, "llm", name)
    df.write.mode("errorifexists").options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` over slices of at most ``BATCH_ROWS`` rows, with this package shipped to the Python workers."""
    ship_package(df.sparkSession)

    def run(batches):
        yield from fn(b.slice(at, BATCH_ROWS) for b in batches for at in range(0, max(1, b.num_rows), BATCH_ROWS))
        # the worker process serves later stages too
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
            trim(0)

    return df.mapInArrow(run, schema)


def held_out(doc_id: Column | str) -> Column:
    """The fold kept away from training: crc32(doc_id as text) mod 4 = 2.

    A null id has no fold and counts as held out.
    """
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))
