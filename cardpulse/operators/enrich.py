"""Joins: enrichment with dimensions, anti/semi checks, interval self-join.

Broadcast policy: only the fixed dimension tables in ``dimensions`` (≤ 24
rows, size independent of the data) and TPC-H ``nation``/``region`` (25 and
5 rows by definition) get an explicit ``broadcast``.  Joins against data
that grows (customer, the transactions themselves) are left to Catalyst,
which broadcasts only below ``spark.sql.autoBroadcastJoinThreshold`` and
otherwise shuffles; AQE splits skewed partitions of sort-merge joins.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import dimensions as dims
from ..functions.geo import EARTH_RADIUS_KM, haversine_km, spherical_hull
from ..functions.scalars import epoch_micros
from ..session import ship_package
from ..sources.tables import read_table
from .timeline import MINUTE_US

DEVICE_TYPES = ["mobile", "desktop", "pos_terminal", "tablet"]
CHANNELS = ["app", "mobile_wallet", "web", "in_store"]


def profile_enrich(spark: SparkSession, sf_dir: str, txn: DataFrame) -> DataFrame:     # J2
    """Each transaction with its card holder's name, nation and region."""
    cust = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("card_id"), F.col("c_name").alias("card_holder"))
    nation = F.broadcast(read_table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("home"), "n_name", "n_regionkey"))
    region = F.broadcast(read_table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("n_regionkey"), "r_name"))
    return (txn.join(cust, "card_id").join(nation, "home").join(region, "n_regionkey")
            .select("transaction_id", "card_id", "card_holder", "segment", "acctbal",
                    F.col("n_name").alias("home_nation"), F.col("r_name").alias("home_region")))


def category_range_check(spark: SparkSession, txn: DataFrame) -> DataFrame:            # J3
    """Map the event type to a model category, attach its amount range and
    online probability, and test whether the amount lies inside."""
    ec = F.broadcast(dims.event_category_df(spark))
    mc = F.broadcast(dims.merchant_category_df(spark).withColumnRenamed("category", "model_category")
                     .drop("merchants"))
    j = txn.join(ec, "merchant_category").join(mc, "model_category")
    return j.select("transaction_id", "card_id", "merchant_category", "model_category", "amount",
                    "amount_min", "amount_max", "online_probability",
                    F.col("amount").between(F.col("amount_min"), F.col("amount_max")).alias("amount_in_range"))


def city_lookup(spark: SparkSession, txn: DataFrame) -> DataFrame:                     # J4
    """geo → one of the 12 reference cities (geo % 12), its centre, and the
    transaction's distance from that centre."""
    city = F.broadcast(dims.city_df(spark))
    j = txn.withColumn("city_id", (F.col("geo") % 12).cast("int")).join(city, "city_id")
    return j.select("transaction_id", "card_id", "geo", "city", "city_lat", "city_lon",
                    haversine_km("city_lat", "city_lon", "lat", "lon").alias("km_from_city_centre"))


def far_pairs(spark: SparkSession, km: float = 500.0) -> DataFrame:                   # J5
    """All ordered city pairs more than ``km`` apart (self excluded).

    The 12-row city table is fanned out with ``explode`` and re-joined on the
    city id, an equi-join on a fixed-size table (144 candidate rows).
    """
    c = dims.city_df(spark)
    fan = c.select(F.col("city_id").alias("from_id"), F.col("city").alias("from_city"),
                   F.col("city_lat").alias("from_lat"), F.col("city_lon").alias("from_lon"),
                   F.explode(F.sequence(F.lit(0), F.lit(len(dims.CITIES) - 1))).alias("to_id"))
    to = F.broadcast(c.select(F.col("city_id").alias("to_id"), F.col("city").alias("to_city"),
                              F.col("city_lat").alias("to_lat"), F.col("city_lon").alias("to_lon")))
    pairs = fan.join(to, "to_id").filter(F.col("from_id") != F.col("to_id"))
    d = haversine_km("from_lat", "from_lon", "to_lat", "to_lon", digits=None)
    return (pairs.withColumn("distance_km", F.round(d, 2)).filter(d > km)
            .select("from_id", "from_city", "to_id", "to_city", "distance_km"))


def far_city_candidates(spark: SparkSession, txn: DataFrame, km: float = 500.0) -> DataFrame:  # J5 over data
    """For each city seen in the data: its far cities and how many
    transactions could be moved there (the geographic-anomaly candidates)."""
    seen = (txn.groupBy((F.col("geo") % 12).cast("int").alias("from_id"))
            .agg(F.count(F.lit(1)).alias("txns")))
    return seen.join(F.broadcast(far_pairs(spark, km)), "from_id").select(
        "from_city", "to_city", "distance_km", "txns")


def unusual_category(spark: SparkSession, txn: DataFrame) -> DataFrame:                # J6
    """Transactions whose category is not among the card's preferred ones
    (anti join with the exploded segment → preferred table, 10 rows)."""
    pref = F.broadcast(dims.segment_preferred_df(spark)
                       .select("segment", F.explode("preferred").alias("merchant_category")))
    return (txn.join(pref, ["segment", "merchant_category"], "left_anti")
            .select("transaction_id", "card_id", "segment", "merchant_category"))


def with_device_channel(txn: DataFrame) -> DataFrame:
    """Adapter stand-ins: device type from k % 4, channel from (k / 4) % 4."""
    dt = F.element_at(F.array(*map(F.lit, DEVICE_TYPES)), (F.col("k") % 4 + 1).cast("int"))
    ch = F.element_at(F.array(*map(F.lit, CHANNELS)), (F.floor(F.col("k") / 4) % 4 + 1).cast("int"))
    return txn.withColumns({"device_type": dt, "channel": ch})


def channel_validity(spark: SparkSession, txn: DataFrame) -> DataFrame:                # J7
    """Flag each transaction: is its (device_type, channel) pair allowed
    (semi join on the 6-row allow-list) and is online ⇔ not a terminal."""
    t = with_device_channel(txn)
    allowed = F.broadcast(dims.device_channel_df(spark).withColumn("pair_allowed", F.lit(True)))
    j = t.join(allowed, ["device_type", "channel"], "left")
    return j.select("transaction_id", "card_id", "device_type", "channel", "is_online",
                    F.coalesce("pair_allowed", F.lit(False)).alias("pair_allowed"),
                    (F.col("is_online") == (F.col("device_type") != "pos_terminal")).alias("online_consistent"))


def invalid_channels(spark: SparkSession, txn: DataFrame) -> DataFrame:                # J7 anti
    t = with_device_channel(txn)
    allowed = F.broadcast(dims.device_channel_df(spark))
    return (t.join(allowed, ["device_type", "channel"], "left_anti")
            .select("transaction_id", "card_id", "device_type", "channel"))


#: Time steps of the extreme-point tables; each divides the one before.
HULL_STEPS_US = (5 * MINUTE_US, MINUTE_US // 2, 2_000_000)
#: A quarter of a great circle, less a margin: discs up to here are convex.
CONVEX_KM = 10_000.0
SMALL_GROUP = 8


def _extreme_points(points: DataFrame) -> DataFrame:
    """``points`` (centre, ``pts``: array of (p_lat, p_lon)) without the points inside a hull.

    Groups of at most ``SMALL_GROUP`` points pass as they are; Python gets a null for them.
    """
    ship_package(points.sparkSession)

    # nondeterministic only by name: filters on ``pts`` would repeat the call
    @F.pandas_udf("array<struct<p_lat: double, p_lon: double>>")
    def hulls(pts: pd.Series, c_lat: pd.Series, c_lon: pd.Series) -> pd.Series:
        return pd.Series([None if p is None else spherical_hull(list(p), la, lo) for p, la, lo in zip(pts, c_lat, c_lon)], dtype=object)

    many = F.when(F.size("pts") > SMALL_GROUP, F.col("pts"))
    return points.withColumn("pts", F.coalesce(hulls.asNondeterministic()(many, "c_lat", "c_lon"), F.col("pts")))


def _nodes_inside(t: str, w: int):
    """(step index, node) of the largest steps that lie whole in ``[t - w, t]``, and do not overlap."""
    t = F.col(t)
    first = [F.ceil((t - F.lit(w)) / F.lit(u)).cast("bigint") for u in HULL_STEPS_US]
    end = [F.floor((t + 1) / F.lit(u)).cast("bigint") for u in HULL_STEPS_US]

    def span(step, lo, hi):
        return F.when(lo < hi, F.transform(F.sequence(lo, hi - 1), lambda k: F.struct(F.lit(step).alias("step"), k.alias("node")))).otherwise(F.array())

    parts = [span(0, first[0], end[0])]
    for i in range(1, len(HULL_STEPS_US)):
        ratio = HULL_STEPS_US[i - 1] // HULL_STEPS_US[i]
        parts += [span(i, first[i], first[i - 1] * ratio), span(i, end[i - 1] * ratio, end[i])]
    return F.concat(*parts)


def _wide_buckets(t: DataFrame, km: float) -> DataFrame:
    """(card_id, b) of the payments and places that a far pair can have: a card's buckets next to each other,
    where the box around both is wide enough.

    Along the box's sides any two of its places are ``radius * (height + width)`` apart at most,
    which no great circle exceeds.
    """
    side = {"s": F.min("lat"), "n": F.max("lat"), "w": F.min("lon"), "e": F.max("lon")}
    box = (t.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull())
           .select("card_id", F.explode(F.array(F.col("b"), F.col("b") + 1)).alias("b"), "lat", "lon")
           .groupBy("card_id", "b").agg(*[c.alias(k) for k, c in side.items()]))
    along = F.lit(EARTH_RADIUS_KM) * (F.radians(F.col("n") - F.col("s")) + F.radians(F.col("e") - F.col("w")))
    return (box.filter(along > km * (1 - 1e-6))
            .select("card_id", F.explode(F.array(F.col("b"), F.col("b") - 1)).alias("b")).distinct())


def far_candidates(txn: DataFrame, km: float = 500.0, minutes: int = 30, cell_deg: float = 1.0) -> DataFrame:
    """Pairs (payment, place) that J9 takes an exact distance of; one of them is the farthest place of each far cell."""
    w = minutes * MINUTE_US
    if w < 2 * HULL_STEPS_US[0]:
        raise ValueError("minutes must be at least twice the longest step")
    leaf = HULL_STEPS_US[-1]
    t = txn.select("transaction_id", "card_id", "ts", "amount", "lat", "lon",
                   epoch_micros("ts").alias("t_us")).withColumn("b", F.expr(f"t_us div {w}"))
    t = t.join(_wide_buckets(t, km), ["card_id", "b"], "left_semi")
    cell = lambda c: (F.floor(F.col(c) / cell_deg) + 0.5) * cell_deg  # noqa: E731  (cell centre)
    at = ["card_id", "c_lat", "c_lon"]
    used = [F.min("first_us").alias("first_us"), F.max("last_us").alias("last_us")]
    places = (t.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull())
              .groupBy("card_id", F.col("b").alias("pb"), F.floor(F.col("t_us") / leaf).cast("bigint").alias("node"),
                        F.col("lat").alias("p_lat"), F.col("lon").alias("p_lon"))
              .agg(F.min("t_us").alias("first_us"), F.max("t_us").alias("last_us"))
              .withColumn("c_lat", cell("p_lat")).withColumn("c_lon", cell("p_lon")))
    cells = places.groupBy("card_id", "pb", "c_lat", "c_lon").agg(
        *used, F.count(F.lit(1)).alias("n"), F.max(haversine_km("c_lat", "c_lon", "p_lat", "p_lon", digits=None)).alias("radius"))

    # each cell is offered to its own bucket (used at or before t) and to the
    # next one (last use within w before t)
    offers = cells.withColumn("b", F.explode(F.array(F.col("pb"), F.col("pb") + 1)))
    in_window = (F.col("first_us") <= F.col("t_us")) & (F.col("last_us") >= F.col("t_us") - F.lit(w))
    reach = haversine_km("c_lat", "c_lon", "lat", "lon", digits=None) + F.col("radius")
    # few places, or beyond a quarter of a great circle, where the farthest place may lie
    # inside a hull: every place of the bucket
    bucket = F.when((F.col("reach") > CONVEX_KM) | (F.col("n") <= SMALL_GROUP), F.col("pb"))
    far = (t.join(offers, ["card_id", "b"]).filter(in_window).withColumn("reach", reach).filter(F.col("reach") > km)
           .select("transaction_id", "ts", "amount", "lat", "lon", "t_us", *at, bucket.alias("bucket")).distinct())

    # what a payment looks up in a far cell of many places. The two steps that [t - w, t] cuts: every
    # place, by its times; the whole steps: extreme points. All in one table, by kind of step
    cut_step, bucket_step = len(HULL_STEPS_US), len(HULL_STEPS_US) + 1
    step = lambda i, node: F.struct(F.lit(i).alias("step"), node.cast("bigint").alias("node"))
    ends = F.array_distinct(F.array(*[F.floor((F.col("t_us") - F.lit(back)) / leaf).cast("bigint") for back in (w, 0)]))
    steps = F.when(F.col("bucket").isNull(), F.concat(_nodes_inside("t_us", w), F.transform(ends, lambda k: step(cut_step, k))))
    asked = far.select("*", F.inline(F.coalesce(steps, F.array(step(bucket_step, F.col("bucket")))))).drop("bucket")

    point = F.struct("p_lat", "p_lon")
    each = places.select(*at, "first_us", "last_us", F.array(point).alias("pts"),
                         F.inline(F.array(step(cut_step, F.col("node")), step(bucket_step, F.col("pb")))))
    dense = cells.filter(F.col("n") > SMALL_GROUP).select(*at, "pb")
    leaves = _extreme_points(places.join(dense, [*at, "pb"], "left_semi").groupBy(*at, "node").agg(F.collect_set(point).alias("pts"), *used))
    # every step from the extreme points of the shortest ones
    longer = F.array(*[step(i, F.floor(F.col("node") / (u // leaf))) for i, u in enumerate(HULL_STEPS_US)])
    hull = _extreme_points(leaves.select(*at, "first_us", "last_us", "pts", F.inline(longer)).groupBy(*at, "step", "node")
                           .agg(F.array_distinct(F.flatten(F.collect_list("pts"))).alias("pts"), *used))
    return (asked.join(each.unionByName(hull), [*at, "step", "node"]).filter(in_window)
            .select("transaction_id", "card_id", "ts", "amount", "lat", "lon", F.inline("pts")))


def impossible_travel_any(txn: DataFrame, km: float = 500.0, minutes: int = 30,
                          cell_deg: float = 1.0) -> DataFrame:                          # J9
    """Transactions with ANY earlier-or-simultaneous transaction of the same
    card more than ``km`` away within ``minutes`` (not only the neighbour),
    with the largest such distance and the transaction's amount.

    The interval self-join is rewritten as equi-joins.  Only payments of a card
    whose places in two buckets next to each other span ``km`` take part
    (a semi-join by (card, bucket)).  They meet the grid
    cells (``cell_deg``) used in their own and the previous ``minutes`` bucket;
    a cell can hold a far place only if ``d(t, centre) + radius > km``
    (triangle inequality).  Inside such a cell a payment meets extreme points
    only: for each of a few time steps (five minutes, 30 s, 2 s) the hull of
    the cell's places.  Discs up to a quarter of a great circle are convex, so
    the farthest place of a step is a vertex.  The interval is a few dozen whole
    steps and two cut ones of 2 s, whose places are all compared.  Thus a card
    that jitters in two cities costs each payment a few hundred pairs, not one
    for every place.  Cells that reach beyond 10,000 km are compared place by place.
    """
    d = haversine_km("p_lat", "p_lon", "lat", "lon", digits=None)
    return (far_candidates(txn, km, minutes, cell_deg).withColumn("d", d).filter(F.col("d") > km)
            .groupBy("card_id", "transaction_id", "ts")
            .agg(F.round(F.max("d"), 2).alias("max_km_within_window"), F.max("amount").alias("amount")))


def categories_not_preferred(spark: SparkSession, txn: DataFrame) -> DataFrame:        # U2
    """Per card: categories used that are not preferred (EXCEPT)."""
    used = txn.select("card_id", "segment", "merchant_category").distinct()
    pref = (used.select("card_id", "segment").distinct()
            .join(F.broadcast(dims.segment_preferred_df(spark)), "segment")
            .select("card_id", "segment", F.explode("preferred").alias("merchant_category")))
    return used.subtract(pref)


def known_merchants(txn: DataFrame) -> DataFrame:                                      # U3
    """Distinct (card, merchant) with first use and use count — the card's
    known-merchant set as rows (no per-card collection)."""
    return txn.groupBy("card_id", "merchant_name").agg(
        F.min("ts").alias("first_used"), F.count(F.lit(1)).alias("uses"))
