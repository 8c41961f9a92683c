"""Explicit schemas: the 28-field transaction message and the stream envelope."""

from pyspark.sql.types import (
    BinaryType, BooleanType, DoubleType, IntegerType, LongType, StringType,
    StructField, StructType, TimestampType,
)

# The wire message: one flat JSON object per transaction.  The three id/time
# fields and amount are declared non-null, but from_json erases that, so the
# decoder checks them itself (see sources.decode).
TRANSACTION_SCHEMA = StructType([
    StructField("transaction_id", StringType(), False),
    StructField("timestamp", TimestampType(), False),
    StructField("card_id", StringType(), False),
    StructField("card_holder", StringType(), True),
    StructField("card_type", StringType(), True),
    StructField("card_limit", IntegerType(), True),
    StructField("card_age_months", IntegerType(), True),
    StructField("amount", DoubleType(), False),
    StructField("currency", StringType(), True),
    StructField("merchant_name", StringType(), True),
    StructField("merchant_category", StringType(), True),
    StructField("is_online", BooleanType(), True),
    StructField("location_lat", DoubleType(), True),
    StructField("location_lon", DoubleType(), True),
    StructField("city", StringType(), True),
    StructField("country", StringType(), True),
    StructField("device_id", StringType(), True),
    StructField("device_type", StringType(), True),
    StructField("channel", StringType(), True),
    StructField("monthly_income", IntegerType(), True),
    StructField("active_emis", IntegerType(), True),
    StructField("total_emi_amount", IntegerType(), True),
    StructField("credit_utilization_pct", DoubleType(), True),
    StructField("months_since_last_default", IntegerType(), True),
    StructField("avg_monthly_spend", IntegerType(), True),
    StructField("is_fraud", BooleanType(), True),
    StructField("fraud_type", StringType(), True),
    StructField("fraud_confidence", DoubleType(), True),
])

REQUIRED_FIELDS = ("transaction_id", "timestamp", "card_id", "amount")

# Rows as a message broker hands them over (key/value bytes plus metadata).
ENVELOPE_SCHEMA = StructType([
    StructField("key", BinaryType(), True),
    StructField("value", BinaryType(), True),
    StructField("topic", StringType(), True),
    StructField("partition", IntegerType(), True),
    StructField("offset", LongType(), True),
    StructField("timestamp", TimestampType(), True),
])
