"""Kafka source and sink as option builders over Spark's Kafka connector.

The connector jar is not part of this PySpark build, so the functions that
call ``load``/``start`` need ``spark-sql-kafka`` on the classpath at run
time; the option dictionaries are pure and tested on their own.  Message
key is the transaction id, so one card's messages spread over all topic
partitions (per-card order is restored by event time downstream).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import TRANSACTION_SCHEMA
from .model import JSON_OPTIONS


def source_options(servers: str, topic: str, *, starting: str = "latest", fail_on_data_loss: bool = False,
                   group_id: str | None = None, max_offsets_per_trigger: int | None = None,
                   min_partitions: int | None = None, ending: str | None = None) -> dict[str, str]:
    """Options for ``readStream``/``read`` ``.format("kafka")``.

    ``starting``/``ending`` accept ``earliest``/``latest`` or a JSON offset
    map, which is how a consumer rewinds to any position (replay)."""
    if not servers:
        raise ValueError("bootstrap servers must be set")
    opts = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting,
            "failOnDataLoss": str(fail_on_data_loss).lower()}
    if group_id:
        opts["kafka.group.id"] = group_id
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        opts["minPartitions"] = str(min_partitions)
    if ending:
        opts["endingOffsets"] = ending
    return opts


def read_stream(spark: SparkSession, servers: str, topic: str, **kw) -> DataFrame:      # S1
    return spark.readStream.format("kafka").options(**source_options(servers, topic, **kw)).load()


def read_batch(spark: SparkSession, servers: str, topic: str, starting: str = "earliest",
               ending: str = "latest", **kw) -> DataFrame:                             # S2 (rewind)
    return (spark.read.format("kafka")
            .options(**source_options(servers, topic, starting=starting, ending=ending, **kw)).load())


def to_records(df: DataFrame, key: str = "transaction_id") -> DataFrame:              # S10 / X2 / X10
    """``(key, value)`` with the key and a JSON value, both UTF-8 bytes."""
    fields = [f.name for f in TRANSACTION_SCHEMA.fields if f.name in df.columns]
    return df.select(F.encode(F.col(key).cast("string"), "UTF-8").alias("key"),
                     F.encode(F.to_json(F.struct(*fields), JSON_OPTIONS), "UTF-8").alias("value"))


def sink_options(servers: str, topic: str, checkpoint: str | None = None) -> dict[str, str]:
    opts = {"kafka.bootstrap.servers": servers, "topic": topic, "kafka.acks": "all"}
    if checkpoint:
        opts["checkpointLocation"] = checkpoint
    return opts


def write_batch(df: DataFrame, servers: str, topic: str) -> None:
    to_records(df).write.format("kafka").options(**sink_options(servers, topic)).save()


def write_stream(df: DataFrame, servers: str, topic: str, checkpoint: str):
    return (to_records(df).writeStream.format("kafka")
            .options(**sink_options(servers, topic, checkpoint)).outputMode("append").start())
