"""Scalar column expressions; all JVM-side built-ins, no Python UDFs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..dimensions import CITIES

IST = "Asia/Kolkata"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clamp(x, lo, hi) -> Column:
    """``max(lo, min(x, hi))`` that stays NULL for NULL input.

    ``greatest``/``least`` skip NULL arguments, so the plain composition would
    turn a NULL into ``lo``; CASE keeps the NULL.
    """
    x = _c(x)
    lo = lo if isinstance(lo, Column) else F.lit(lo)
    hi = hi if isinstance(hi, Column) else F.lit(hi)
    return (F.when(x.isNull(), F.lit(None))
            .when(x > hi, hi).when(x < lo, lo).otherwise(x))


def epoch_micros(ts, local_instant: bool = False) -> Column:
    """Microseconds since 1970 for a timestamp column.

    ``TIMESTAMP_NTZ`` (wall clock, the driver tables) is converted from its
    calendar fields (day number + time of day), so the result does not
    depend on the session time zone or its daylight-saving changes; an
    instant (``TIMESTAMP``) uses ``unix_micros``.
    """
    ts = _c(ts)
    if local_instant:
        return F.unix_micros(ts)
    day = F.unix_date(F.to_date(ts)).cast("bigint")
    secs = F.extract(F.lit("SECOND"), ts)  # decimal(8,6): seconds with the fraction
    return (day * F.lit(86_400_000_000) + F.hour(ts).cast("bigint") * F.lit(3_600_000_000)
            + F.minute(ts).cast("bigint") * F.lit(60_000_000) + (secs * 1_000_000).cast("bigint"))


def local_hour(ts, already_local: bool = True) -> Column:
    """Hour of day in the card holder's zone (IST).

    Adapter timestamps are wall-clock local already; instants from the wire
    are converted with ``from_utc_timestamp``.
    """
    ts = _c(ts)
    return F.hour(ts) if already_local else F.hour(F.from_utc_timestamp(ts, IST))


def expected_amount(lo, hi, income) -> Column:
    """Geometric centre of the category range, scaled by an income factor
    clamped to [0.15, 2.0] (income normalised by 150,000)."""
    factor = clamp(_c(income) / F.lit(150000.0), 0.15, 2.0)
    return F.sqrt(_c(lo) * _c(hi)) * factor


def amount_cap(hi, income) -> Column:
    return _c(hi) * clamp(_c(income) / F.lit(150000.0), 0.15, 2.0)


def spend_ratio_band(amount, avg_monthly_spend) -> Column:
    """amount ÷ monthly spend, banded at 0.15 / 0.4 / 0.8 / 2.0."""
    r = _c(amount) / F.nullif(_c(avg_monthly_spend).cast("double"), F.lit(0.0))
    return (F.when(r.isNull(), F.lit(None))
            .when(r < 0.15, "lt_0.15").when(r < 0.4, "0.15_0.4")
            .when(r < 0.8, "0.4_0.8").when(r <= 2.0, "0.8_2.0").otherwise("gt_2.0"))


def limit_ratio(amount, card_limit) -> Column:
    return _c(amount) / F.nullif(_c(card_limit).cast("double"), F.lit(0.0))


def absolute_amount_band(amount) -> Column:
    """Absolute bands used by card-testing amounts: 1-50, 50-500, 100-2000."""
    a = _c(amount)
    return (F.when(a.isNull(), F.lit(None)).when(a < 50, "test_1_50")
            .when(a < 500, "small_50_500").when(a <= 2000, "mid_500_2000").otherwise("large"))


def complexity_band(confidence) -> Column:
    """Confidence → easy / medium / hard.  The published ranges share their
    edges (0.40, 0.70); the upper band wins at an edge."""
    c = _c(confidence)
    return (F.when(c.isNull(), F.lit(None)).when(c >= 0.70, "easy")
            .when(c >= 0.40, "medium").otherwise("hard"))


def card_label(card_id) -> Column:
    """Zero-padded card id: ``card_00042``."""
    return F.format_string("card_%05d", _c(card_id).cast("bigint"))


def city_of(city_id) -> Column:
    """City name for a 0-based city index (fixed 12-entry list)."""
    return F.element_at(F.array(*[F.lit(c[0]) for c in CITIES]), _c(city_id).cast("int") + 1)


def unit_hash(col, salt: int) -> Column:
    """Deterministic pseudo-uniform in [0, 1) from an id: the first 13 hex
    digits (52 bits, exact in a double) of ``md5(id|salt)``.  Draws with
    different salts are independent whatever the id range, and any SQL engine
    reproduces the value.  NULL for a NULL id."""
    digest = F.md5(F.concat(_c(col).cast("string"), F.lit(f"|{salt}")).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint").cast("double") / F.lit(float(1 << 52))


def unit_hash_sql(col: str, salt: int) -> str:
    return f"(CAST(CAST('0x' || substr(md5(CAST({col} AS VARCHAR) || '|{salt}'), 1, 13) AS BIGINT) AS DOUBLE) / {float(1 << 52)})"
