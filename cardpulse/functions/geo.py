"""Great-circle distance as a native column expression (no Python UDF)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def haversine_km(lat1, lon1, lat2, lon2, digits: int | None = 2) -> Column:
    """Distance in km; NULL when any input is NULL.

    ``h`` is clamped with CASE (not ``least``, which ignores NULLs) so float
    error above 1 cannot make ``asin`` return NaN.  ``digits=None`` keeps
    full precision; the default rounds to 2 decimals (half-up).
    """
    la1, lo1, la2, lo2 = map(_c, (lat1, lon1, lat2, lon2))
    h = (F.pow(F.sin(F.radians(la2 - la1) / 2), 2)
         + F.cos(F.radians(la1)) * F.cos(F.radians(la2)) * F.pow(F.sin(F.radians(lo2 - lo1) / 2), 2))
    hc = F.when(h > 1, F.lit(1.0)).otherwise(h)
    d = F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(hc))
    return F.round(d, digits) if digits is not None else d


def spherical_hull(points: list, c_lat: float, c_lon: float) -> list:
    """The (p_lat, p_lon) dicts that are no inner points of the spherical hull of ``points`` around a centre.

    The gnomonic projection maps great circles to lines, so a plane hull will
    do; points on an edge stay.  Points a quarter of a great circle or
    more from the centre have no projection: then all points are returned.
    """
    lat, lon = np.radians([p["p_lat"] for p in points]), np.radians([p["p_lon"] for p in points])
    la, lo = np.radians(c_lat), np.radians(c_lon)
    front = np.sin(la) * np.sin(lat) + np.cos(la) * np.cos(lat) * np.cos(lon - lo)
    if not (front > 0.1).all():          # also where a coordinate is NaN
        return points
    x = np.cos(lat) * np.sin(lon - lo) / front
    y = (np.cos(la) * np.sin(lat) - np.sin(la) * np.cos(lat) * np.cos(lon - lo)) / front
    order = np.lexsort((y, x))
    kept: set[int] = set()
    for run in (order, order[::-1]):
        chain: list[int] = []
        for i in run.tolist():
            if chain and x[i] == x[chain[-1]] and y[i] == y[chain[-1]]:
                continue             # the same place again
            while len(chain) > 1 and ((x[chain[-1]] - x[chain[-2]]) * (y[i] - y[chain[-2]])
                                      - (y[chain[-1]] - y[chain[-2]]) * (x[i] - x[chain[-2]])) < 0:
                chain.pop()
            chain.append(i)
        kept.update(chain)
    return [points[i] for i in sorted(kept)]


# SQL form, registered for SQL users as a temporary SQL function.
HAVERSINE_SQL_BODY = (
    "round(2 * 6371 * asin(sqrt(CASE WHEN h > 1 THEN CAST(1 AS DOUBLE) ELSE h END)), 2)"
)


def register_sql_functions(spark: SparkSession) -> None:
    """``haversine_km(lat1, lon1, lat2, lon2)`` for ``spark.sql`` text."""
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION haversine_km(
            lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE)
        RETURNS DOUBLE
        RETURN round(2 * 6371 * asin(sqrt(
            CASE WHEN pow(sin(radians(lat2 - lat1) / 2), 2)
                      + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians(lon2 - lon1) / 2), 2) > 1
                 THEN CAST(1 AS DOUBLE)
                 ELSE pow(sin(radians(lat2 - lat1) / 2), 2)
                      + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians(lon2 - lon1) / 2), 2)
            END)), 2)
    """)


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str, digits: int | None = 2) -> str:
    """The same formula as SQL text (used by oracle queries)."""
    h = (f"(pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) "
         f"* pow(sin(radians({lon2} - {lon1}) / 2), 2))")
    d = f"(2 * 6371 * asin(sqrt(CASE WHEN {h} > 1 THEN CAST(1 AS DOUBLE) ELSE {h} END)))"
    return f"round({d}, {digits})" if digits is not None else d
