from pyspark.sql import functions as F

from cardpulse.functions.geo import haversine_km, register_sql_functions
from cardpulse.functions.scalars import clamp, complexity_band, unit_hash, card_label, epoch_micros


def test_haversine_known_values(spark):
    df = spark.createDataFrame([(12.9716, 77.5946, 19.0760, 72.8777), (0.0, 0.0, 0.0, 180.0),
                                (None, 1.0, 2.0, 3.0), (10.0, 70.0, 10.0, 70.0)],
                               "a double, b double, c double, d double")
    got = [r[0] for r in df.select(haversine_km("a", "b", "c", "d")).collect()]
    assert got[0] == 845.32          # Bangalore - Mumbai
    assert got[1] == 20015.09        # antipodal on the equator: clamp keeps asin defined
    assert got[2] is None            # NULL in, NULL out (no least(1, NULL) trap)
    assert got[3] == 0.0


def test_haversine_sql_function(spark):
    register_sql_functions(spark)
    v = spark.sql("SELECT haversine_km(12.9716D, 77.5946D, 19.0760D, 72.8777D)").first()[0]
    assert v == 845.32


def test_clamp_keeps_null(spark):
    df = spark.createDataFrame([(None,), (5.0,), (-1.0,), (0.5,)], "x double")
    assert [r[0] for r in df.select(clamp("x", 0.0, 1.0)).collect()] == [None, 1.0, 0.0, 0.5]


def test_complexity_band_edges(spark):
    df = spark.createDataFrame([(0.15,), (0.4,), (0.69,), (0.7,), (0.95,), (None,)], "c double")
    got = [r[0] for r in df.select(complexity_band("c")).collect()]
    assert got == ["hard", "medium", "medium", "easy", "easy", None]


def test_unit_hash_range_and_independence(spark):
    df = spark.range(0, 20000).select(unit_hash("id", 1).alias("a"), unit_hash("id", 2).alias("b"))
    s = df.agg(F.min("a"), F.max("a"), F.avg("a"), F.corr("a", "b")).first()
    assert 0.0 <= s[0] and s[1] < 1.0 and abs(s[2] - 0.5) < 0.02
    assert abs(s[3]) < 0.05


def test_card_label_and_micros(spark):
    df = spark.sql("SELECT 42L AS c, TIMESTAMP_NTZ'2024-01-01 00:00:01.5' AS t")
    r = df.select(card_label("c"), epoch_micros("t")).first()
    assert r[0] == "card_00042"
    assert r[1] == 1704067201500000


def test_epoch_micros_ignores_session_time_zone(spark):
    """Wall-clock differences stay exact across a DST change of the session zone."""
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        df = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-10 01:30:00.000001' AS a, TIMESTAMP_NTZ'2024-03-10 03:30:00' AS b")
        r = df.select(epoch_micros("a").alias("a"), epoch_micros("b").alias("b")).first()
        assert r.b - r.a == 2 * 3_600_000_000 - 1
        assert r.b == 1710041400000000
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
