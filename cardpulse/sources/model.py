"""Wire-format transaction messages derived from the driver tables.

``model_records`` maps each adapter transaction onto the 28-field message
schema (``schemas.TRANSACTION_SCHEMA``); ``envelopes`` turns those into
broker-style rows ``(key, value, timestamp)`` with a JSON value, and mixes in
every raw web page from ``pages`` as an undecodable message, so decoders and
quarantine run on data that grows with the tables.

Field mapping (our design; the driver has no card-holder finance data):

card_id            ``card_%05d`` of user_id
card_holder        customer name
card_type          credit when balance >= 3000 else debit
card_limit         round(max(balance, 0) * 100)
card_age_months    user_id % 120 + 1
timestamp          ts as wall clock in IST (+05:30), microseconds
merchant_category  event type mapped to a model category
city               one of the 12 cities (geo % 12); country IN, currency INR
device_id          ``dev_`` + 8 hex digits of the adapter device id
device/channel     from k (see ``operators.enrich.with_device_channel``)
monthly_income     round((balance + 1000) * 20)
active_emis        k % 4; total_emi_amount = emis * income * 5 %
credit_util_pct    5 + k % 81 (one decimal)
months_since_def   user_id % 60 + 1 for every 7th card, else 0 (never)
avg_monthly_spend  round(income * 0.3)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import dimensions as dims
from ..functions.scalars import card_label, city_of
from ..schemas import TRANSACTION_SCHEMA
from .tables import monthly_income, read_table, row_tasks, transactions

JSON_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XXX"}


def model_category(col: str = "merchant_category"):
    m = F.create_map(*[x for ev, cat in dims.EVENT_CATEGORY for x in (F.lit(ev), F.lit(cat))])
    return m[F.col(col)]


def model_records(spark: SparkSession, sf_dir: str, keep_source: bool = False) -> DataFrame:
    """One 28-field message per adapter transaction; ``timestamp`` is an
    ISO-8601 string with the +05:30 offset, as the producer writes it."""
    from ..operators.enrich import with_device_channel
    t = with_device_channel(transactions(spark, sf_dir))
    names = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("card_id"), F.col("c_name").alias("card_holder"))
    t = t.join(names, "card_id")
    tasks = row_tasks(spark, sf_dir, "events")
    if tasks > spark.sparkContext.defaultParallelism:
        # messages are some twenty times as wide as the rows, and the scan or
        # the join may have left far larger partitions
        t = t.repartition(tasks)
    income = monthly_income("acctbal")
    emis = (F.col("k") % 4).cast("int")
    rec = t.select(
        F.concat(F.lit("txn_"), F.lpad(F.lower(F.hex(F.col("transaction_id"))), 12, "0")).alias("transaction_id"),
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+05:30")).alias("timestamp"),
        card_label("card_id").alias("card_id"),
        "card_holder",
        F.when(F.col("acctbal") >= 3000, "credit").otherwise("debit").alias("card_type"),
        "card_limit",
        (F.col("card_id") % 120 + 1).cast("int").alias("card_age_months"),
        "amount",
        F.lit("INR").alias("currency"),
        "merchant_name",
        model_category().alias("merchant_category"),
        "is_online",
        F.col("lat").alias("location_lat"),
        F.col("lon").alias("location_lon"),
        city_of(F.col("geo") % 12).alias("city"),
        F.lit("IN").alias("country"),
        F.concat(F.lit("dev_"), F.lpad(F.lower(F.hex(F.col("device_id"))), 8, "0")).alias("device_id"),
        "device_type", "channel",
        income.alias("monthly_income"),
        emis.alias("active_emis"),
        F.round(emis * income * 0.05).cast("int").alias("total_emi_amount"),
        F.round(F.lit(5.0) + (F.col("k") % 81), 1).alias("credit_utilization_pct"),
        F.when(F.col("card_id") % 7 == 0, F.col("card_id") % 60 + 1).otherwise(0).cast("int")
         .alias("months_since_last_default"),
        "avg_monthly_spend",
        "is_fraud",
        F.lit(None).cast("string").alias("fraud_type"),
        F.lit(0.0).alias("fraud_confidence"),
        *([F.col("transaction_id").alias("source_id"), F.col("ts").alias("source_ts")] if keep_source else []),
    )
    return rec


def to_envelope(records: DataFrame, key: str = "transaction_id") -> DataFrame:
    """(key, value, timestamp) rows: key and JSON value as UTF-8 bytes."""
    fields = [f.name for f in TRANSACTION_SCHEMA.fields]
    return records.select(
        F.encode(F.col(key), "UTF-8").alias("key"),
        F.encode(F.to_json(F.struct(*fields), JSON_OPTIONS), "UTF-8").alias("value"),
        F.to_timestamp("timestamp", JSON_OPTIONS["timestampFormat"]).alias("timestamp"))


def junk_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every raw page as an undecodable message (key ``page_<id>``); stamped
    at the first transaction instant so replay puts them in the first slice."""
    first = transactions(spark, sf_dir).select(F.min("ts")).scalar()
    pages = read_table(spark, sf_dir, "pages")
    return pages.select(
        F.encode(F.concat(F.lit("page_"), F.col("page_id").cast("string")), "UTF-8").alias("key"),
        F.encode(F.col("html"), "UTF-8").alias("value"),
        F.to_timestamp(F.concat(F.date_format(first, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+05:30")),
                       JSON_OPTIONS["timestampFormat"]).alias("timestamp"))


def envelopes(spark: SparkSession, sf_dir: str, with_junk: bool = True) -> DataFrame:
    env = to_envelope(model_records(spark, sf_dir))
    return env.unionByName(junk_envelopes(spark, sf_dir)) if with_junk else env
