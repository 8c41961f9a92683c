"""Mergeable sketches: amount quantiles by day (A8) and distinct merchants by pane.

A sketch of one day or pane is built once by a partial aggregate and merged
over any range afterwards, so a dashboard over months reads one small row per
(day, group) instead of the transactions.  Both kinds have a fixed size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: KLL size: a rank is off by about 0.8 % at most (99 % of the time); below so many values it is exact.
KLL_K = 400
#: HLL size 2^12: about 1.6 % relative error; small counts are exact.
HLL_LG_K = 12


def amount_sketches(txn: DataFrame, *keys: str, k: int = KLL_K) -> DataFrame:           # A8
    """(day, *keys, txns, sketch): one KLL sketch of ``amount`` per day and key; null amounts don't count."""
    return (txn.filter(F.col("amount").isNotNull() & ~F.isnan("amount"))
            .groupBy(F.to_date("ts").alias("day"), *keys)
            .agg(F.count(F.lit(1)).alias("txns"), F.kll_sketch_agg_double("amount", k).alias("sketch")))


def write_amount_sketches(sketches: DataFrame, path: str) -> None:
    """Replace the days present in ``sketches`` and leave the table's others; a repeated run changes nothing."""
    (sketches.repartition("day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("day").parquet(path))


def merged_quantiles(sketches: DataFrame, *keys: str | Column, probs=(0.5, 0.9, 0.99)) -> DataFrame:
    """(*keys, txns, p50, p90, ...) over all days in ``sketches``; filter on ``day`` first for a range."""
    merged = sketches.groupBy(*keys).agg(F.sum("txns").alias("txns"), F.kll_merge_agg_double("sketch").alias("merged"))
    return merged.select("*", *[F.kll_sketch_get_quantile_double("merged", F.lit(p)).alias(f"p{int(round(p * 100))}") for p in probs]).drop("merged")


def rank_errors(quantiles: DataFrame, txn: DataFrame, *keys: str, probs=(0.5, 0.9, 0.99)) -> DataFrame:
    """How far the rank of each estimate lies from its probability, by an exact count: (*keys, txns, e50, e90, ...).

    The values equal to an estimate take up a range of ranks; the error is 0 inside it.
    """
    names = [f"p{int(round(p * 100))}" for p in probs]
    joined = txn.filter(F.col("amount").isNotNull() & ~F.isnan("amount")).join(quantiles.select(*keys, *names), list(keys))
    counts = joined.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("txns"),
        *[F.sum((F.col("amount") < F.col(n)).cast("bigint")).alias(f"under_{n}") for n in names],
        *[F.sum((F.col("amount") <= F.col(n)).cast("bigint")).alias(f"upto_{n}") for n in names])
    return counts.select(*keys, "txns", *[
        F.greatest(F.lit(0.0), F.col(f"under_{n}") / F.col("txns") - F.lit(p), F.lit(p) - F.col(f"upto_{n}") / F.col("txns")).alias("e" + n[1:])
        for n, p in zip(names, probs)])


def pane_distinct(stream: DataFrame, key: str, value: str, time: str = "timestamp", pane: str = "1 minute",
                  length: str = "1 hour", slide: str = "10 minutes", lg_k: int = HLL_LG_K) -> DataFrame:  # A12
    """(key, window, txns, distinct_values) by sliding window; batch or stream (append mode, watermark on ``time``).

    Rows are first folded into one HLL sketch per (key, pane), which is all the
    state that a pane keeps; closed panes are then merged over the windows
    that hold them.  ``slide`` must be a multiple of ``pane``.
    """
    panes = (stream.groupBy(F.window(time, pane).alias("pane"), key)
             .agg(F.count(F.lit(1)).alias("n"), F.hll_sketch_agg(value, lg_k).alias("sketch")))
    return (panes.groupBy(F.window(F.window_time("pane"), length, slide).alias("w"), key)
            .agg(F.sum("n").alias("txns"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_values"))
            .select(key, F.col("w").alias("window"), "txns", "distinct_values"))
