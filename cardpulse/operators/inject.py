"""Labelled fraud injection (D17) as a deterministic column rewrite.

The transaction model picks about 4 % of transactions, draws a fraud type
and a difficulty level from fixed weights, and rewrites the row in the
pattern's way (card-not-present, account takeover, geographic jump,
velocity test amounts, friendly fraud).  Here every random draw is a
pseudo-uniform of the transaction id (``unit_hash``), so the result is a
pure function of the input: reproducible, partition-independent, and
expressible in SQL.  The geographic rewrite moves the row to a city more
than 500 km from the card's previous transaction city (as-of lookup from
the skew-safe sequence engine), falling back to the row's own city.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import dimensions as dims
from ..functions.scalars import unit_hash, unit_hash_sql
from .timeline import sequence_features

CATEGORIES = [c[0] for c in dims.MERCHANT_CATEGORIES]
MERCHANTS = {c[0]: c[1] for c in dims.MERCHANT_CATEGORIES}
CITY_POS = {c[0]: (c[1], c[2]) for c in dims.CITIES}
PREFERRED = {p[0]: p[9] for p in dims.PROFILES}
UNUSUAL = {p: [c for c in CATEGORIES if c not in pref] for p, pref in PREFERRED.items()}
COMPLEXITY_RANGE = {c[0]: (c[2], c[3]) for c in dims.COMPLEXITY}

# salts of the independent draws
S_PICK, S_TYPE, S_LEVEL, S_CONF, S_DEVICE, S_CAT, S_MERCH, S_AMT, S_CITY, S_LAT, S_LON = range(1, 12)


def _km(a, b):
    (la1, lo1), (la2, lo2) = a, b
    h = (math.sin(math.radians(la2 - la1) / 2) ** 2
         + math.cos(math.radians(la1)) * math.cos(math.radians(la2)) * math.sin(math.radians(lo2 - lo1) / 2) ** 2)
    return 2 * 6371 * math.asin(math.sqrt(min(h, 1.0)))


FAR = {c: [d for d in CITY_POS if d != c and _km(CITY_POS[c], CITY_POS[d]) > 500] or
          [d for d in CITY_POS if d != c] for c in CITY_POS}


def _weighted(u: Column, rows) -> Column:
    """Name whose cumulative-weight interval contains ``u``."""
    cum = dims.cumulative(rows)
    expr = F.lit(cum[-1][0])
    for name, _, hi in reversed(cum[:-1]):
        expr = F.when(u < F.lit(hi), F.lit(name)).otherwise(expr)
    return expr


def _weighted_sql(u: str, rows) -> str:
    cum = dims.cumulative(rows)
    whens = " ".join(f"WHEN {u} < {hi!r}e0 THEN '{name}'" for name, _, hi in cum[:-1])
    return f"CASE {whens} ELSE '{cum[-1][0]}' END"


def _pick(arr: Column, u: Column) -> Column:
    return F.element_at(arr, (F.floor(u * F.size(arr)) + 1).cast("int"))


def _map_of_arrays(d) -> Column:
    return F.create_map(*[x for k, v in d.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])


def profile_of(income: Column) -> Column:
    return (F.when(income >= 150000, "high_income").when(income >= 40000, "mid_income")
            .when(income >= 15000, "low_income").otherwise("student"))


def inject_fraud(df: DataFrame, *, rate: float = dims.FRAUD_RATE, id_col: str = "source_id",
                 ts_col: str = "source_ts") -> DataFrame:
    """Rewrite ~``rate`` of the wire-format rows into labelled fraud.

    Input: ``model_records(..., keep_source=True)`` or any frame with the
    fields read below.  Output: the input columns (rewritten where the
    pattern says so) plus the labels ``is_fraud``, ``fraud_type``,
    ``fraud_confidence`` and ``complexity``.
    """
    seq = sequence_features(df, card="card_id", ts=ts_col, tid=id_col, previous=["city"])
    u = {s: unit_hash(id_col, s) for s in range(1, 12)}
    is_f = u[S_PICK] < F.lit(rate)
    ftype = _weighted(u[S_TYPE], dims.FRAUD_TYPES)
    level = _weighted(u[S_LEVEL], [(c[0], c[1]) for c in dims.COMPLEXITY])
    lo = F.create_map(*[x for k, (a, _) in COMPLEXITY_RANGE.items() for x in (F.lit(k), F.lit(a))])
    hi = F.create_map(*[x for k, (_, b) in COMPLEXITY_RANGE.items() for x in (F.lit(k), F.lit(b))])
    d = seq.withColumns({"_f": is_f, "_type": ftype, "_level": level})
    conf = F.round(lo[F.col("_level")] + (hi[F.col("_level")] - lo[F.col("_level")]) * u[S_CONF], 2)

    t, lvl = F.col("_type"), F.col("_level")
    spend, limit, f8 = F.col("avg_monthly_spend"), F.col("card_limit"), u[S_AMT]
    unusual = _pick(_map_of_arrays(UNUSUAL)[profile_of(F.col("monthly_income"))], u[S_CAT])
    anycat = _pick(F.array(*map(F.lit, CATEGORIES)), u[S_CAT])
    new_cat = (F.when(t.isin("card_not_present", "account_takeover"), unusual)
               .when(t == "velocity_abuse", anycat).otherwise(F.col("merchant_category")))

    def by_level(easy, medium, hard):
        return F.when(lvl == "easy", easy).when(lvl == "medium", medium).otherwise(hard)

    amount = (F.when(t == "card_not_present", F.round(spend * by_level(
                    F.lit(0.8) + F.lit(1.2) * f8, F.lit(0.4) + F.lit(0.4) * f8, F.lit(0.15) + F.lit(0.25) * f8), 2))
              .when(t == "account_takeover", F.round(by_level(
                    limit * (F.lit(0.6) + F.lit(0.3) * f8), spend * (F.lit(3.0) + F.lit(5.0) * f8),
                    spend * (F.lit(1.5) + F.lit(1.5) * f8)), 2))
              .when(t == "velocity_abuse", F.round(by_level(
                    F.lit(1.0) + F.lit(49.0) * f8, F.lit(50.0) + F.lit(450.0) * f8, F.lit(100.0) + F.lit(1900.0) * f8), 2))
              .when((t == "friendly_fraud") & (lvl == "easy"),
                    F.round(spend * (F.lit(0.3) + F.lit(0.3) * f8), 2))
              .otherwise(F.col("amount")))
    from_city = F.coalesce(F.col("prev_city"), F.col("city"))
    far_city = _pick(_map_of_arrays(FAR)[from_city], u[S_CITY])
    lat_map = F.create_map(*[x for k, (a, _) in CITY_POS.items() for x in (F.lit(k), F.lit(a))])
    lon_map = F.create_map(*[x for k, (_, b) in CITY_POS.items() for x in (F.lit(k), F.lit(b))])
    geo = t == "geographic_anomaly"
    cnp = t == "card_not_present"

    d = d.withColumn("_cat", new_cat).withColumn("_city", F.when(geo, far_city).otherwise(F.col("city")))
    rewritten = {
        "merchant_category": F.col("_cat"),
        "merchant_name": F.when(t.isin("card_not_present", "account_takeover", "velocity_abuse"),
                                _pick(_map_of_arrays(MERCHANTS)[F.col("_cat")], u[S_MERCH]))
                          .otherwise(F.col("merchant_name")),
        "amount": amount,
        "is_online": F.when(cnp, F.lit(True)).otherwise(F.col("is_online")),
        "channel": F.when(cnp, F.lit("web")).otherwise(F.col("channel")),
        "device_type": F.when(cnp, F.when(u[S_DEVICE] < 0.5, "desktop").otherwise("mobile"))
                        .otherwise(F.col("device_type")),
        "city": F.col("_city"),
        "location_lat": F.when(geo, F.round(lat_map[F.col("_city")] + F.lit(0.1) * u[S_LAT] - F.lit(0.05), 4))
                         .otherwise(F.col("location_lat")),
        "location_lon": F.when(geo, F.round(lon_map[F.col("_city")] + F.lit(0.1) * u[S_LON] - F.lit(0.05), 4))
                         .otherwise(F.col("location_lon")),
    }
    out = {}
    for c in df.columns:
        if c in rewritten:
            out[c] = F.when(F.col("_f"), rewritten[c]).otherwise(F.col(c))
    out["is_fraud"] = F.col("_f")
    out["fraud_type"] = F.when(F.col("_f"), t)
    out["fraud_confidence"] = F.when(F.col("_f"), conf).otherwise(F.lit(0.0))
    out["complexity"] = F.when(F.col("_f"), lvl)
    labels = [c for c in ("is_fraud", "fraud_type", "fraud_confidence", "complexity") if c not in df.columns]
    return d.withColumns(out).select(*df.columns, *labels)


# ---------------------------------------------------------------------------
# the same rewrite as DuckDB SQL (oracle); input CTE must expose the model
# columns plus source_id / source_ts / prev_city
# ---------------------------------------------------------------------------

def _sql_list(v) -> str:
    return "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in v) + "]"


def _sql_map_case(key: str, d: dict, as_list: bool = True) -> str:
    whens = " ".join(f"WHEN '{k}' THEN {_sql_list(v) if as_list else repr(v) + 'e0'}" for k, v in d.items())
    return f"(CASE {key} {whens} END)"


def _sql_pick(arr: str, u: str) -> str:
    return f"({arr})[CAST(floor({u} * len({arr})) AS INTEGER) + 1]"


def inject_sql(src: str, rate: float = dims.FRAUD_RATE) -> str:
    """SELECT over CTE ``src`` producing the injected rows (oracle form)."""
    u = {s: unit_hash_sql("source_id", s) for s in range(1, 12)}
    ftype = _weighted_sql(u[S_TYPE], dims.FRAUD_TYPES)
    level = _weighted_sql(u[S_LEVEL], [(c[0], c[1]) for c in dims.COMPLEXITY])
    lo = " ".join(f"WHEN '{k}' THEN {a!r}e0" for k, (a, _) in COMPLEXITY_RANGE.items())
    hi = " ".join(f"WHEN '{k}' THEN {b!r}e0" for k, (_, b) in COMPLEXITY_RANGE.items())
    prof = ("CASE WHEN monthly_income >= 150000 THEN 'high_income' WHEN monthly_income >= 40000 THEN 'mid_income' "
            "WHEN monthly_income >= 15000 THEN 'low_income' ELSE 'student' END")
    unusual = _sql_pick(_sql_map_case(prof, UNUSUAL), u[S_CAT])
    anycat = _sql_pick(_sql_list(CATEGORIES), u[S_CAT])
    f8 = u[S_AMT]
    lat_case = " ".join(f"WHEN '{k}' THEN {a!r}e0" for k, (a, _) in CITY_POS.items())
    lon_case = " ".join(f"WHEN '{k}' THEN {b!r}e0" for k, (_, b) in CITY_POS.items())

    def by_level(e, m, h):
        return f"(CASE _level WHEN 'easy' THEN {e} WHEN 'medium' THEN {m} ELSE {h} END)"

    amount = (f"CASE WHEN _type = 'card_not_present' THEN round(avg_monthly_spend * "
              f"{by_level(f'(0.8e0 + 1.2e0 * {f8})', f'(0.4e0 + 0.4e0 * {f8})', f'(0.15e0 + 0.25e0 * {f8})')}, 2) "
              f"WHEN _type = 'account_takeover' THEN round("
              f"{by_level(f'card_limit * (0.6e0 + 0.3e0 * {f8})', f'avg_monthly_spend * (3.0e0 + 5.0e0 * {f8})', f'avg_monthly_spend * (1.5e0 + 1.5e0 * {f8})')}, 2) "
              f"WHEN _type = 'velocity_abuse' THEN round("
              f"{by_level(f'(1.0e0 + 49.0e0 * {f8})', f'(50.0e0 + 450.0e0 * {f8})', f'(100.0e0 + 1900.0e0 * {f8})')}, 2) "
              f"WHEN _type = 'friendly_fraud' AND _level = 'easy' THEN round(avg_monthly_spend * (0.3e0 + 0.3e0 * {f8}), 2) "
              f"ELSE amount END")
    far = _sql_pick(_sql_map_case("COALESCE(prev_city, city)", FAR), u[S_CITY])
    staged = f"""
SELECT *, CASE WHEN _type IN ('card_not_present', 'account_takeover') THEN {unusual}
               WHEN _type = 'velocity_abuse' THEN {anycat} ELSE merchant_category END AS _cat,
          CASE WHEN _type = 'geographic_anomaly' THEN {far} ELSE city END AS _city
FROM (SELECT *, {u[S_PICK]} < {rate!r}e0 AS _f, {ftype} AS _type, {level} AS _level FROM {src}) s0"""
    merch = _sql_pick(_sql_map_case("_cat", MERCHANTS), u[S_MERCH])
    return f"""
SELECT transaction_id, source_id,
  CASE WHEN _f THEN _cat ELSE merchant_category END AS merchant_category,
  CASE WHEN _f AND _type IN ('card_not_present', 'account_takeover', 'velocity_abuse') THEN {merch}
       ELSE merchant_name END AS merchant_name,
  CASE WHEN _f THEN {amount} ELSE amount END AS amount,
  CASE WHEN _f AND _type = 'card_not_present' THEN true ELSE is_online END AS is_online,
  CASE WHEN _f AND _type = 'card_not_present' THEN 'web' ELSE channel END AS channel,
  CASE WHEN _f AND _type = 'card_not_present' THEN (CASE WHEN {u[S_DEVICE]} < 0.5e0 THEN 'desktop' ELSE 'mobile' END)
       ELSE device_type END AS device_type,
  CASE WHEN _f THEN _city ELSE city END AS city,
  CASE WHEN _f AND _type = 'geographic_anomaly'
       THEN round((CASE _city {lat_case} END) + 0.1e0 * {u[S_LAT]} - 0.05e0, 4) ELSE location_lat END AS location_lat,
  CASE WHEN _f AND _type = 'geographic_anomaly'
       THEN round((CASE _city {lon_case} END) + 0.1e0 * {u[S_LON]} - 0.05e0, 4) ELSE location_lon END AS location_lon,
  _f AS is_fraud,
  CASE WHEN _f THEN _type END AS fraud_type,
  CASE WHEN _f THEN round((CASE _level {lo} END) + ((CASE _level {hi} END) - (CASE _level {lo} END)) * {u[S_CONF]}, 2)
       ELSE 0e0 END AS fraud_confidence,
  CASE WHEN _f THEN _level END AS complexity
FROM ({staged}) s1"""
