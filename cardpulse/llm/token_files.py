"""Token files: ORC stripes of token ids with indexes on document ids.

Documents are range-partitioned and sorted by doc_id before encoding (only
text travels, never ids), so the files are in ascending doc_id order and every
stripe covers a narrow id range.  ORC's integer run-length encoding holds the
ids; row indexes (min / max per row group) and Bloom filters on ``doc_id`` let
a point or range read skip stripes and row groups by metadata, and stripes are
read in parallel.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardpulse.llm import tokens
from cardpulse.llm.common import arrow_map, staged
from cardpulse.session import shared_path

END_ID = 0
FILE_SCHEMA = "doc_id long, block int, at long, ids array<int>"
ORC_OPTIONS = {
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.create.index": "true",
    "orc.row.index.stride": "1000",
    "orc.stripe.size": str(16 << 20),
    "orc.compress": "ZSTD",
}


def write_token_files(docs: DataFrame, path: str, vocabulary: str = tokens.VOCABULARY, end_id: int = END_ID) -> None:
    """Encode every whole text, append ``end_id`` and write ORC files in ascending doc_id order.

    A null or empty text is the end id alone.  Rows with a null doc_id come
    first; repeated doc_ids follow each other, ordered by text.  Columns other
    than doc_id and text are ignored; an empty table writes an empty set of
    files.  ``block`` numbers the files, ``at`` the rows in a file.
    """
    tie = F.xxhash64("text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie, "text")
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        block, at = TaskContext.get().partitionId(), 0
        for b in batches:
            for i, texts in tokens.in_slices(b.column(1)):
                raw = [ids + end for ids in tokens.encoder(vocabulary).ids(texts)]
                bounds = np.cumsum([0, *(len(r) // 4 for r in raw)]).astype(np.int32)
                values = np.frombuffer(b"".join(raw), "<i4")
                ids = pa.ListArray.from_arrays(pa.array(bounds), pa.array(values))
                n = len(texts)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, n), pa.array([block] * n, pa.int32()), pa.array(range(at, at + n), pa.int64()), ids],
                                                 ["doc_id", "block", "at", "ids"])
                at += n

    arrow_map(rows, run, FILE_SCHEMA).write.options(**ORC_OPTIONS).orc(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, block, at, ids); filters on doc_id reach the ORC metadata."""
    return spark.read.schema(FILE_SCHEMA).orc(path)


def token_index(files: DataFrame) -> DataFrame:
    """Per document of ``files``: (doc_id, start, n_tokens, ids_crc32).

    ``start`` counts the ids of all documents before it: one row per file is
    summed over the files, then each file's rows are summed within it.
    """

    def run(batches):
        for b in batches:
            ids = b.column(3)
            bounds = ids.offsets.to_numpy()
            raw = ids.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False)
            crc = [zlib.crc32(raw[s:e].tobytes()) for s, e in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(np.diff(bounds).astype(np.int64)), pa.array(crc, pa.int64())],
                                             ["doc_id", "block", "at", "n_tokens", "ids_crc32"])

    rows = staged(arrow_map(files, run, "doc_id long, block int, at long, n_tokens long, ids_crc32 long"), "token-index")
    totals = rows.groupBy("block").agg(F.sum("n_tokens").alias("held"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("block", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    local = F.coalesce(F.sum("n_tokens").over(within), F.lit(0))
    return rows.withColumn("local", local).join(totals, "block").select("doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")


def encoded_index(docs: DataFrame, vocabulary: str = tokens.VOCABULARY, end_id: int = END_ID) -> DataFrame:
    """Write ``docs`` as token files in the shared folder and index them from what is read back."""
    spark = docs.sparkSession
    path = shared_path(spark, "llm", "tokens")
    write_token_files(docs, path, vocabulary, end_id)
    return token_index(read_token_files(spark, path))
