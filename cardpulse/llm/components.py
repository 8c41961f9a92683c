"""Connected components by alternating star contraction.

Each round hooks every vertex's larger neighbours to its smallest neighbour
(large star) and its smaller neighbours to the smallest of them (small star).
Work is grouped aggregation plus equi-joins on the vertex; the edge list is
written to the shared folder between rounds, and only a checksum reaches the
driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardpulse.llm.common import staged


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def _star(edges: DataFrame, smallest: DataFrame, keep) -> DataFrame:
    return edges.join(smallest, "u").where(keep).select("v", "m")


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v long, u != v, any direction) -> (node, root).

    ``root`` is the smallest vertex of the component.  Vertices without an
    edge do not appear.
    """
    e = staged(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc-edges")
    seen = _digest(e)
    while seen[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _star(both, low, F.col("v") > F.col("u")).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = staged(large, "cc-large")
        # here u > v always: v ranges over the smaller neighbours of u
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        hooked = _star(large, low, F.lit(True)).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        own = low.select("u", F.col("m").alias("v"))
        e = staged(hooked.unionByName(own).distinct(), "cc-edges")
        now = _digest(e)
        if now == seen:
            break
        seen = now
    roots = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
