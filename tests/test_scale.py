"""Work that must not grow faster than the input: replay slices, message encoding, keyed state, numbered log."""

import pickle
import random
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from cardpulse.session import shared_path
from cardpulse.sources import log, model, replay, tables
from cardpulse.streaming import detect, jobs, rollups, state

from .conftest import SF001


def test_slices_are_dealt_once(spark):
    env = model.envelopes(spark, SF001, with_junk=False)
    out = shared_path(spark, "test", "dealt")
    replay.write_slices(env, out, slices=4, files_per_slice=2, late=replay.is_late(), slice_bytes=50_000)
    dealt = spark.read.parquet(out + "-dealt")
    assert sorted(map(tuple, dealt.select("key", "value", "timestamp").collect())) == sorted(map(tuple, env.collect()))
    n = dealt.agg(F.max("slice")).first()[0]
    assert n > 4                                                                 # by bytes; the last is the late one
    for i in (0, 3, n - 1):
        own = dealt.filter(F.col("slice") == i).drop("slice")
        got = spark.read.parquet(f"{out}/slice={i:05d}-copy=0")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, own.collect()))
    late = spark.read.parquet(f"{out}/slice={n:05d}-late")
    assert late.count() == env.filter(replay.is_late()).count() > 0


def test_a_trigger_grows_with_the_cores(spark):
    assert replay.trigger_bytes(spark) == max(replay.SLICE_BYTES, spark.sparkContext.defaultParallelism * replay.CORE_BYTES)


def test_messages_are_encoded_by_bounded_tasks(spark, monkeypatch):
    monkeypatch.setattr(tables, "ROWS_PER_TASK", 50)
    n = tables.read_table(spark, SF001, "events").count()
    rec = model.model_records(spark, SF001)
    assert rec.rdd.getNumPartitions() == -(-n // 50)
    assert max(r[0] for r in rec.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).select("n").collect()) <= 100


def test_log_ranges_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(log, "TASK_BYTES", 20_000)
    env = spark.createDataFrame([(f"k{i:05d}".encode(), b"x" * 100, i) for i in range(3000)], "key binary, value binary, t long").select("key", "value", F.timestamp_seconds("t").alias("timestamp"))
    path = shared_path(spark, "test", "log")
    log.write_log(env, path, F.lit(0), slice_bytes=100_000)
    staged = spark.read.parquet(f"{path}/staged").groupBy("task").agg(F.sum("bytes").alias("n")).collect()
    assert len(staged) >= 15 and max(r.n for r in staged) < 60_000
    assert [r.offset for r in log.read_log(spark, path).orderBy("timestamp").collect()] == list(range(3000))


def test_card_hours_of_a_day_are_written_by_several_tasks(spark):
    base = shared_path(spark, "test", "rollups")
    rows = spark.range(4000).select(F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id")).alias("timestamp"), F.format_string("card_%05d", F.col("id") % 500).alias("card_id"), F.lit(1.0).alias("amount"),
                                    F.lit(False).alias("is_fraud"), F.lit("a").alias("merchant_category"), F.lit(1.0).alias("location_lat"), F.lit(1.0).alias("location_lon"))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")                        # as in a micro-batch
    try:
        rollups.write_rollups(base)(rows, 0)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    files = rollups.partials(spark, base, "by_card_hour").select(F.input_file_name().alias("f")).distinct().count()
    assert files > 1 and rollups.card_hours(spark, base).agg(F.sum("txns")).first()[0] == 4000


class Value:
    def __init__(self, calls, name):
        self.calls, self.name, self.value = calls, name, None

    def get(self):
        self.calls[self.name] += 1
        return self.value

    def exists(self):
        self.calls[self.name] += 1
        return self.value is not None

    def update(self, value):
        self.calls[self.name] += 1
        self.value = value

    def clear(self):
        self.calls[self.name] += 1
        self.value = None


class Map:
    def __init__(self, calls, name):
        self.calls, self.name, self.values = calls, name, {}

    def getValue(self, k):
        self.calls[self.name] += 1
        return self.values.get(k)

    def containsKey(self, k):
        self.calls[self.name] += 1
        return k in self.values

    def updateValue(self, k, v):
        self.calls[self.name] += 1
        self.values[k] = v

    def removeKey(self, k):
        self.calls[self.name] += 1
        self.values.pop(k, None)

    def keys(self):
        self.calls[self.name] += 1
        return iter(list(self.values))

    def iterator(self):
        self.calls[self.name] += 1
        return iter(list(self.values.items()))


class Handle:
    """State in memory; counts the accesses."""

    def __init__(self):
        self.calls, self.timers = Counter(), set()

    def getValueState(self, name, schema):
        return Value(self.calls, name)

    def getMapState(self, name, key_schema, value_schema):
        return Map(self.calls, name)

    def registerTimer(self, at):
        self.calls["timer"] += 1
        self.timers.add(at)

    def deleteTimer(self, at):
        self.calls["timer"] += 1
        self.timers.discard(at)


class Now:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def test_alert_state_accesses_do_not_grow_with_rows():
    def accesses(n, step_us):
        h, p = Handle(), detect.CardAlertProcessor(dict(detect.DEFAULTS))
        p.init(h)
        pdf = pd.DataFrame({"transaction_id": [f"t{i:05d}" for i in range(n)], "t_us": [i * step_us for i in range(n)], "amount": [float(i % 9 + 1) for i in range(n)],
                            "device_id": [f"d{i % 50}" for i in range(n)], "merchant_name": [f"m{i % 70}" for i in range(n)], "avg_monthly_spend": 1.0, "card_limit": 10.0})
        p.handleInputRows(("c",), iter([pdf[: n // 2], pdf[n // 2:]]), None)
        end = (n - 1) * step_us // 1000
        out = pd.concat(p.handleExpiredTimer(("c",), Now(end), None))
        closed = end // detect.BUCKET_MS * detect.BUCKET_MS * 1000
        assert out["transaction_id"].tolist() == [f"t{i:05d}" for i in range(n) if i * step_us < closed]
        assert out["prior_txn_count"].tolist() == list(range(len(out)))
        rest = pd.concat(p.handleExpiredTimer(("c",), Now(10 * end), None))
        assert len(out) + len(rest) == n
        return sum(h.calls.values())
    hour = 3_600_000_000
    assert max(accesses(400, hour // 2), accesses(40, hour // 2)) <= 40
    accesses(6000, 2_000_000)                                                   # a hot card: split by bucket


def test_alert_state_accesses_do_not_grow_with_cards():
    rnd = random.Random(5)
    minute = 60_000_000

    def rows(n_cards):
        return [(f"c{k}", f"t{k:03d}_{i:02d}", i * 40 * minute * 24 + rnd.randrange(30) * minute, float(rnd.choice([5, 12.5, 90, 400])),
                 rnd.choice([None, f"d{k}", f"d{k}x"]), rnd.choice([None, "m0", "m1", "d0"]), rnd.choice([None, 1.0]), 10.0) for k in range(n_cards) for i in range(50)]

    def played(batches, key):
        """Each batch, then the timer behind its last row; then all that waits, and the end of the ring."""
        h, p = Handle(), detect.CardAlertProcessor(dict(detect.DEFAULTS))
        p.init(h)
        out = []
        ends = [max(r[2] for r in b) // 1000 - 900_000 for b in batches]
        for b, end in zip([*batches, None, None], [*ends, ends[-1] + 3_600_000, ends[-1] + 40 * detect.DAY_MS]):
            if b:
                list(p.handleInputRows(key, iter([pd.DataFrame(b, columns=detect.INPUT)]), None))
            assert len(h.timers) == 1
            at = min(h.timers)
            if at <= end:
                out += [r for f in p.handleExpiredTimer(key, Now(end), None) for r in f.astype(object).itertuples(index=False)]
                h.timers.discard(at)                                             # as Spark does once it is handled
        assert p.ring.value is None and not p.waiting.values and not h.timers
        return {r.transaction_id: tuple(None if v is pd.NA else v for v in r) for r in out}, sum(h.calls.values())

    all_rows = rows(40)
    rnd.shuffle(all_rows)
    order = sorted(all_rows, key=lambda r: r[2] + rnd.randrange(14) * minute)     # late by less than the delay
    batches = [order[i:i + 400] for i in range(0, len(order), 400)]
    got, calls = played(batches, (7,))
    want, single = {}, 0
    for card in sorted({r[0] for r in order}):
        own, n = played([b for b in ([r for r in b if r[0] == card] for b in batches) if b], (card,))
        want |= own
        single = max(single, n)
    assert len(got) == 2000 and got == want and any(r[-4] for r in got.values())
    assert calls <= 20 * (len(batches) + 2) and single <= 20 * (len(batches) + 2)


def frame(rows):
    return pd.DataFrame(rows, columns=["card_id", "transaction_id", "t_us", "location_lat", "location_lon", "merchant_name"])


def brute(rows, batches):
    """Each row against the rows of its card before it, batch after batch."""
    out, past = {}, {}
    for batch in batches:
        for card, i, t, la, lo, m in sorted(batch, key=lambda r: (r[0], r[2], r[1])):
            own = past.setdefault(card, [])
            peers = [r for r in batch if r[0] == card and r[2] == t and r[1] > i]
            at = [r[2] for r in own] + [t] + [r[2] for r in peers]
            prev = own[-1] if own else None
            out[i] = (prev and prev[2], prev and prev[3], m not in {r[5] for r in own}, sum(t - state.HOUR_US <= x for x in at), sum(t - state.DAY_US <= x for x in at))
            own.append((card, i, t, la, lo, m))
    return out


def cards(n=1500, n_cards=12):
    rnd = np.random.default_rng(3)
    t = np.sort(rnd.integers(0, 4 * state.DAY_US, n) // 30_000_000 * 30_000_000)   # with equal times
    rows = [(f"card_{rnd.integers(n_cards):05d}", f"t{i:05d}", int(t[i]), float(i % 5), float(i % 3), [None, "a", "b", "c"][rnd.integers(4)]) for i in range(n)]
    cut = [0, *[next(i for i in range(k, n) if t[i] != t[i - 1]) for k in (300, 301, 900)], n]   # equal times in one batch
    return rows, [rows[a:b] for a, b in zip(cut, cut[1:])]


def found(frames):
    plain = lambda v: None if v is pd.NA else v
    return {r.transaction_id: (plain(r.prev_t_us), plain(r.prev_lat), r.is_new_merchant, r.transactions_last_1hr, r.transactions_last_24hr) for f in frames for r in f.itertuples()}


def test_card_state_takes_a_group_of_cards_in_one_call():
    rows, batches = cards()

    class State:
        value = None
        exists = property(lambda self: self.value is not None)
        get = property(lambda self: self.value)

        def update(self, value):
            self.value = value

    s = State()
    got = found(f for b in batches for f in state._card_state((0,), iter([frame(b)]), s))
    assert got == brute(rows, batches)
    assert len(pickle.loads(s.value[0])[0]) == 12


def test_minute_state_takes_a_group_of_cards_in_one_call():
    rows, batches = cards()
    h, p = Handle(), state.CardFeatureProcessor()
    p.init(h)
    got = found(f for b in batches for f in p.handleInputRows((0,), iter([frame(b)]), None))
    assert got == brute(rows, batches)
    minutes = len({r[2] // state.MINUTE_US for r in rows})
    assert h.calls["minute_count"] + h.calls["minute_times"] < 5 * minutes and h.calls["cards"] == 2 * len(batches)
    assert len(p.minute_count.values) == len(p.minute_times.values) < minutes     # older ones are gone


def test_different_ids_are_counted_by_bounded_tasks(spark, monkeypatch):
    monkeypatch.setattr(jobs, "COUNT_ROWS", 100)
    rows = [("fraud" if i % 2 else "loan", None if i % 50 == 0 else f"txn_{i % 700}", 1_704_067_200 + 40 * i) for i in range(3000)]
    found = (spark.createDataFrame(rows, "subscriber string, transaction_id string, t long")
             .select("subscriber", "transaction_id", F.timestamp_seconds("t").alias("timestamp")))
    got = jobs.messages_by_day(found)
    groups = {}
    for name, number, t in rows:
        groups.setdefault((name, t // 86_400), []).append(number)
    assert sorted(map(tuple, got.collect())) == sorted((*k, len(v), len({x for x in v if x is not None})) for k, v in groups.items())
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert ", 30), REPARTITION_BY_NUM" in plan                                   # 3,000 rows, and not merged again
