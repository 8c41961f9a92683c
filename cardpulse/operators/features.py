"""Per-card behavioural features (one shuffle, see ``timeline``).

Column names follow the transaction model's feature list:
``transactions_last_1hr``, ``transactions_last_24hr``,
``avg_transaction_amount_30d``, ``minutes_since_last_txn``,
``distance_from_last_txn_km``, ``is_new_merchant``; plus the prior-only
baseline (``prior_txn_count``, ``prior_avg_amount``, ``prior_std_amount``,
``amount_zscore``, ``over_3x_avg``) and first use of device / geo.

Semantics fixed here:
* trailing counts include the current row and both frame ends ``[t-w, t]``;
  rows with the same timestamp are peers and count for each other;
* baselines use strictly earlier rows in ``(ts, transaction_id)`` order;
  the average is NULL with no earlier row, the deviation with fewer than two;
* money is summed as integer cents and divided once, so results do not
  depend on summation order.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import haversine_km
from .timeline import DAY_US, HOUR_US, MINUTE_US, sequence_features

WINDOWS = {"1hr": HOUR_US, "24hr": DAY_US, "30d": 30 * DAY_US}
FIRST_USE = {"is_new_merchant": "merchant_name", "is_new_device": "device_id", "is_new_geo": "geo"}


def cents(col: str = "amount") -> Column:
    return F.round(F.col(col) * 100).cast("bigint")


def card_features(
    txn: DataFrame,
    *,
    windows: Iterable[str] = ("1hr", "24hr", "30d"),
    averages: Iterable[str] = ("30d",),
    baseline: bool = True,
    previous: bool = True,
    first_use: Iterable[str] = ("is_new_merchant", "is_new_device", "is_new_geo"),
    extra_sums: dict[str, Column] | None = None,
    extra_windows: dict[str, int] | None = None,
    card: str = "card_id",
    bucket_us: int = HOUR_US,
) -> DataFrame:
    """All requested per-card features on every transaction row."""
    windows = list(windows)
    averages = list(averages)
    frames = {w: WINDOWS[w] for w in dict.fromkeys(windows + averages)}
    frames.update(extra_windows or {})
    sums = {"n": F.lit(1).cast("bigint")}
    if averages:
        sums["cents"] = cents()
    sums.update(extra_sums or {})
    prior = {}
    if baseline:
        c2 = cents().cast("decimal(38,0)")
        prior = {"cents": cents(), "cents2": c2 * c2}
    fu = {flag: FIRST_USE[flag] for flag in first_use}
    feats = sequence_features(
        txn, card=card, frames=frames, sums=sums, prior=prior,
        previous=["lat", "lon"] if previous else [], first_use=fu, bucket_us=bucket_us)

    out = {}
    for w in windows:
        out[f"transactions_last_{w}"] = F.col(f"n_{w}")
    for w in averages:
        out[f"avg_transaction_amount_{w}"] = F.col(f"cents_{w}") / (F.lit(100.0) * F.col(f"n_{w}"))
    for name in (extra_sums or {}):
        for w in frames:
            out[f"{name}_{w}"] = F.col(f"{name}_{w}")
    if previous:
        out["minutes_since_last_txn"] = (F.col("_t_us") - F.col("prev_t_us")) / F.lit(float(MINUTE_US))
        out["distance_from_last_txn_km"] = haversine_km("prev_lat", "prev_lon", "lat", "lon")
    if baseline:
        n = F.col("prior_n")
        s1 = F.col("prior_cents")
        s2 = F.col("prior_cents2")
        mu = F.when(n > 0, s1 / (F.lit(100.0) * n))
        var_num = (n.cast("decimal(38,0)") * s2 - s1.cast("decimal(38,0)") * s1.cast("decimal(38,0)")).cast("double")
        sd = F.when(n >= 2, F.sqrt(var_num / (n * (n - 1)).cast("double")) / F.lit(100.0))
        out["prior_txn_count"] = n
        out["prior_avg_amount"] = mu
        out["prior_std_amount"] = sd
        out["amount_zscore"] = (F.col("amount") - mu) / F.nullif(sd, F.lit(0.0))
        out["over_3x_avg"] = F.when(n > 0, cents() * n > F.lit(3) * s1)
    for flag in fu:
        out[flag] = F.col(flag)
    return feats.withColumns(out).select(*txn.columns, *out.keys())
