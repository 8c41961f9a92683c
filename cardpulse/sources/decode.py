"""JSON decode of broker rows with a quarantine side output.

``from_json`` never drops a row: undecodable input becomes an all-NULL
struct and the schema's non-null flags are erased.  ``decode`` therefore
keeps the raw value next to the parsed struct and splits on whether the
required fields (id, time, card, amount) came through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import REQUIRED_FIELDS, TRANSACTION_SCHEMA
from .model import JSON_OPTIONS


def parsed(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Adds ``data`` (the parsed struct) and ``raw`` (the value as text).

    The struct comes out of an ``explode`` of one element: a filter on a plain
    column would be pushed below it with a ``from_json`` for every mention of
    ``data``, and each message parsed once per required field.
    """
    raw = F.col(value_col).cast("string")
    return df.withColumn("raw", raw).withColumn("data", F.explode(F.array(F.from_json(raw, TRANSACTION_SCHEMA, JSON_OPTIONS))))


def is_valid() -> Column:
    ok = F.col("data").isNotNull()
    for f in REQUIRED_FIELDS:
        ok = ok & F.col(f"data.{f}").isNotNull()
    return ok


def decode(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Valid messages flattened to the 28 transaction columns (``data.*``)."""
    return parsed(df, value_col).filter(is_valid()).select("data.*")


def quarantine(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Messages that failed to decode, with the reason and the whole raw text,
    so that they can be sent again after a repair."""
    p = parsed(df, value_col)
    missing = F.concat_ws(",", *[F.when(F.col(f"data.{f}").isNull(), F.lit(f)) for f in REQUIRED_FIELDS])
    reason = (F.when(F.col("raw").isNull(), "null value")
              .when(F.col("data").isNull(), "not a JSON object")
              .otherwise(F.concat(F.lit("missing "), missing)))
    return (p.filter(~is_valid())
            .select(F.col("key").cast("string").alias("key"), reason.alias("reason"), "raw",
                    F.length("raw").alias("raw_chars"), F.col("timestamp").alias("received")))


def split(df: DataFrame, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    return decode(df, value_col), quarantine(df, value_col)
