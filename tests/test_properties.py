"""Properties of the feature and distance operators (SURVEY §5 'property')."""
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cardpulse.functions.geo import haversine_km
from cardpulse.operators.features import card_features
from cardpulse.sources.tables import transactions

from .conftest import SF01

coord = st.tuples(st.floats(-89.9, 89.9, allow_nan=False), st.floats(-179.9, 179.9, allow_nan=False))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(coord, coord), min_size=20, max_size=60))
def test_distance_symmetric_and_bounded(spark, pairs):
    rows = [(a[0], a[1], b[0], b[1]) for a, b in pairs]
    df = spark.createDataFrame(rows, "la1 double, lo1 double, la2 double, lo2 double")
    got = df.select(haversine_km("la1", "lo1", "la2", "lo2", digits=None).alias("ab"),
                    haversine_km("la2", "lo2", "la1", "lo1", digits=None).alias("ba")).collect()
    for r in got:
        assert abs(r.ab - r.ba) < 1e-6
        assert 0.0 <= r.ab <= 20015.09


def test_trailing_counts_are_ordered(spark):
    f = card_features(transactions(spark, SF01), averages=[], baseline=False, previous=False, first_use=[])
    bad = f.filter((F.col("transactions_last_1hr") < 1)
                   | (F.col("transactions_last_1hr") > F.col("transactions_last_24hr"))
                   | (F.col("transactions_last_24hr") > F.col("transactions_last_30d"))).count()
    assert bad == 0


def test_first_use_flags_count_distinct_pairs(spark):
    t = transactions(spark, SF01)
    f = card_features(t, windows=[], averages=[], baseline=False, previous=False)
    assert f.filter("is_new_merchant").count() == t.select("card_id", "merchant_name").distinct().count()
    assert f.filter("is_new_device").count() == t.select("card_id", "device_id").distinct().count()


@settings(max_examples=4, deadline=None)
@given(grid_min=st.sampled_from([30, 60, 1440]), cards=st.sampled_from([1, 3, 50]),
       bucket_min=st.sampled_from([10, 60]))
def test_engine_exact_on_grid_snapped_times(spark, grid_min, cards, bucket_min):
    """Timestamps of the driver table snapped to a coarse grid: many rows sit
    exactly on bucket edges and exactly one frame width apart (RANGE frames
    include t − w) — the engine must still equal the plain windows."""
    from cardpulse.operators.timeline import MINUTE_US, plain_sequence_features, sequence_features
    from .conftest import SF001
    from .helpers import same_rows
    t = transactions(spark, SF001)
    snapped = (t.withColumn("ts", F.expr(f"timestampadd(MINUTE, -(hour(ts) * 60 + minute(ts)) % {grid_min}, "
                                         "date_trunc('minute', ts))"))
                .withColumn("card_id", F.col("card_id") % cards))
    kw = dict(frames={"a": 60 * MINUTE_US, "b": 1440 * MINUTE_US},
              sums={"n": F.lit(1).cast("bigint"), "c": F.round(F.col("amount") * 100).cast("bigint")},
              prior={"c": F.round(F.col("amount") * 100).cast("bigint")}, previous=["lat"],
              first_use={"nm": "merchant_name"})
    ok, a, b = same_rows(sequence_features(snapped, bucket_us=bucket_min * MINUTE_US, **kw),
                         plain_sequence_features(snapped, **kw))
    assert ok and a == b
