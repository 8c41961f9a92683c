"""Decoder edge rows (JSON → 28 columns) and the quarantine side output."""
from pyspark.sql import functions as F

from cardpulse.session import shared_path
from cardpulse.sources import decode as dec

GOOD = ('{"transaction_id":"txn_1","timestamp":"2024-01-01T05:30:45.123456+05:30","card_id":"card_00001",'
        '"amount":10.5,"card_limit":1000,"is_online":true,"extra":"ignored"}')
ROWS = [
    ("good", GOOD),
    ("no_fraction", '{"transaction_id":"t2","timestamp":"2024-01-01T05:30:45+05:30","card_id":"c","amount":1}'),
    ("zulu", '{"transaction_id":"t3","timestamp":"2024-01-01T00:00:45.5Z","card_id":"c","amount":2.0}'),
    ("int_as_float", '{"transaction_id":"t4","timestamp":"2024-01-01T00:00:00Z","card_id":"c","amount":3,'
                     '"card_limit":5.0}'),
    ("string_double", '{"transaction_id":"t5","timestamp":"2024-01-01T00:00:00Z","card_id":"c","amount":4,'
                      '"location_lat":"x"}'),
    ("missing_amount", '{"transaction_id":"t6","timestamp":"2024-01-01T00:00:00Z","card_id":"c"}'),
    ("bad", "{bad"),
    ("empty", ""),
    ("null", None),
    ("array", "[1, 2]"),
]


def _env(spark):
    return spark.createDataFrame(ROWS, "key string, value string").select(
        F.encode("key", "UTF-8").alias("key"), F.encode("value", "UTF-8").alias("value"),
        F.current_timestamp().alias("timestamp"))


def test_valid_rows(spark):
    got = {r.transaction_id: r for r in dec.decode(_env(spark)).collect()}
    assert set(got) == {"txn_1", "t2", "t3", "t4", "t5"}
    assert got["t4"].amount == 3.0 and got["t4"].card_limit is None      # 5.0 is not an int: field NULL
    assert got["t5"].location_lat is None                                # "x" is not a double
    assert got["txn_1"].card_limit == 1000 and got["txn_1"].is_online is True
    ts = spark.createDataFrame([(r.transaction_id, r.timestamp) for r in got.values()], "id string, t timestamp")
    micros = {r[0]: r[1] for r in ts.select("id", F.unix_micros("t")).collect()}
    assert micros["txn_1"] == 1704067245123456                            # +05:30 offset honoured
    assert micros["t3"] == 1704067245500000


def test_quarantine(spark):
    q = {r.key: r.reason for r in dec.quarantine(_env(spark)).collect()}
    assert set(q) == {"missing_amount", "bad", "empty", "null", "array"}
    assert q["missing_amount"] == "missing amount"
    assert q["null"] == "null value"


def test_split_is_a_partition_of_input(spark):
    good, bad = dec.split(_env(spark))
    assert good.count() + bad.count() == len(ROWS)


def test_a_message_is_parsed_once(spark):
    """Each required field's filter used to bring a parse of its own."""
    path = shared_path(spark, "test", "decode-once")
    _env(spark).write.parquet(path)
    env = spark.read.parquet(path)
    for df in (dec.decode(env), dec.decode(env).select("card_id", "amount").filter("amount >= 2"), dec.quarantine(env)):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1
