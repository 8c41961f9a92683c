"""Detectors on the stream: per-card baselines in keyed state, in event-time order.

``card_alerts`` flags each transaction by what the card did before it: amount
over a multiple of the prior average (D1), z-score of the amount (D5), a new
device with a high amount (D11), spend far over the card-holder's monthly
spend at a new merchant (D8), and an amount near the card's limit (D10).

Rows wait in state, keyed by ten-minute bucket of their event time, until the
watermark passes the bucket's end; an event-time timer then takes them in
``(time, id)`` order.  Flags therefore don't depend on how rows were cut into
micro-batches, nor on the order of rows that are late by less than the
watermark's delay, and they equal the batch definitions.

A state belongs to a group of cards (a hash of the card; a group may also be one
card): every access to it is a message between two processes, and a call has a
fixed cost, so a micro-batch pays both per group, not per card.  A group's state
is read and written once per timer.  A hot card's micro-batch is never held
whole: its chunks go to their buckets one by one, and a timer takes one bucket
after the other.  Few rows wait whole under their first bucket.

State of a group
  ``waiting``   bucket -> rows of it, or of it and later ones, that are not scored yet
  ``prior``     card -> count, sum and sum of squares of the amounts, in cents
  ``ring``      day -> card -> count and cents, the last 30 days
  ``names``     card -> the devices and merchants that the card has used, by their number in the group
  ``timer``     the one registered instant

A day leaves the ring 30 days later, so a card without rows for 30 days has none;
the fixed few numbers of ``prior`` and the names it has used stay, since D1, D5,
D8 and D11 are defined over the whole past.
"""

from __future__ import annotations

import pickle
from math import sqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .state import GROUPS

BUCKET_MS = 600_000
DAY_MS = 86_400_000
RING_DAYS = 30
FEW_ROWS = 5_000   # so many rows of a micro-batch are not split by bucket
OUT_ROWS = 10_000  # rows of an output frame

#: Registered thresholds; the defaults are the published ones.
DEFAULTS = {"multiple": 3, "z": 3.0, "device_amount": 100.0, "spend_multiple": 3.0, "limit_ratio": 0.6}

INPUT = ("card_id", "transaction_id", "t_us", "amount", "device_id", "merchant_name", "avg_monthly_spend", "card_limit")
OUTPUT = ("transaction_id string, card_id string, t_us long, amount double, prior_txn_count long, prior_avg_amount double, amount_zscore double, "
          "avg_amount_30d double, over_average boolean, zscore boolean, new_device boolean, spend_spike boolean, near_limit boolean")


def _plain(values: np.ndarray) -> list:
    return [None if v is None or v != v else v for v in values.tolist()]


def _packed(value) -> bytes:
    return pickle.dumps(value, protocol=5)


class _Past:
    """What a group's cards did before, out of the values of ``prior``, ``names`` and ``ring``."""

    def __init__(self, prior, names, ring) -> None:
        self.prior = pickle.loads(prior[0]) if prior else {}
        self.numbers, self.used = pickle.loads(names[0]) if names else ({}, {})
        self.packed = {int(d): v for d, v in zip(*ring)} if ring else {}
        self.days = {d: pickle.loads(v) for d, v in self.packed.items()}
        self.earlier = {}  # card -> a day, and the count and cents of the days before it
        self.renamed = False

    def is_new(self, card, names: tuple) -> list[bool]:
        """Whether the card uses each of ``names`` (device, merchant) for the first time; from now on it has."""
        used = self.used.get(card)
        if used is None:
            used = self.used[card] = (set(), set())
        new = []
        for own, name in zip(used, names):
            number = self.numbers.setdefault(name, len(self.numbers))
            new.append(number not in own)
            own.add(number)
        self.renamed = self.renamed or True in new
        return new

    def recent(self, card, day: int, cents: int) -> tuple[int, int]:
        """Count and cents of the card's last 30 days up to this row, which is added; a card's rows come in the order of time."""
        earlier = self.earlier.get(card)
        if earlier is None or earlier[0] != day:
            own = [x[card] for d, x in self.days.items() if day - RING_DAYS < d < day and card in x]
            earlier = self.earlier[card] = (day, sum(v[0] for v in own), sum(v[1] for v in own))
        today = self.days.setdefault(day, {})
        n, c = today.get(card, (0, 0))
        today[card] = (n + 1, c + cents)
        self.packed.pop(day, None)
        return earlier[1] + n + 1, earlier[2] + c + cents


class CardAlertProcessor:
    """See the module text.  ``thresholds`` are those of ``DEFAULTS``."""

    def __init__(self, thresholds: dict) -> None:
        self.thresholds = thresholds

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "bucket long", "rows array<binary>")
        self.prior = handle.getValueState("prior", "cards binary")
        self.ring = handle.getValueState("ring", "day array<long>, cards array<binary>")
        self.names = handle.getValueState("names", "cards binary")
        self.timer = handle.getValueState("timer", "at long")

    def _wake(self, at: int | None, old: int | None = None) -> None:
        """One timer a group, at ``at`` (the latest wish wins; None: no timer)."""
        if old is not None:
            self.handle.deleteTimer(old)
        if at is None:
            self.timer.clear()
        else:
            self.handle.registerTimer(at)
            self.timer.update((at,))

    def _wait(self, b: int, rows: list[tuple]) -> None:
        old = self.waiting.getValue((b,))
        self.waiting.updateValue((b,), ([*(old[0] if old else ()), _packed(rows)],))

    def _sort_in(self, rows: list[tuple], split: bool) -> int:
        """Rows go to their buckets, or whole to their first one; the first bucket."""
        bucket = np.array([r[2] for r in rows], dtype=np.int64) // (BUCKET_MS * 1000)
        first = int(bucket.min())
        if split:
            order = np.argsort(bucket, kind="stable")
            found, start = np.unique(bucket[order], return_index=True)
            for b, own in zip(found.tolist(), np.split(order, start[1:])):
                self._wait(b, [rows[i] for i in own.tolist()])
        else:
            self._wait(first, rows)
        return first

    def handleInputRows(self, key, rows, timerValues):
        first, new = [], []
        for pdf in rows:  # one chunk at a time, and what came before it if that is little
            columns = [_plain(pdf[c].to_numpy(dtype=object)) if c in pdf else [key[0]] * len(pdf) for c in INPUT]
            new += zip(*columns)
            if len(new) > FEW_ROWS:
                first.append(self._sort_in(new, split=True))
                new = []
        if new:
            first.append(self._sort_in(new, split=False))
        if first:
            at, old = (min(first) + 1) * BUCKET_MS, self.timer.get()
            # an older wish is an older bucket or the ring's end, which comes after any bucket that waits
            if old is None or at < old[0]:
                self._wake(at, old[0] if old else None)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now = timerValues.getCurrentWatermarkInMs()
        closed = now // BUCKET_MS  # the buckets before it have ended
        open_ = sorted(int(b[0]) for b in self.waiting.keys())
        due = [b for b in open_ if b < closed]
        left, later = [], open_[len(due):]
        ring = self.ring.get()
        if due:
            past, out = _Past(self.prior.get(), self.names.get(), ring), []
            for b, following in zip(due, [*due[1:], closed]):
                for part in self.waiting.getValue((b,))[0]:
                    left += pickle.loads(part)
                self.waiting.removeKey((b,))
                end = following * BUCKET_MS * 1000  # no entry behind this one has rows before it
                ready = sorted((r for r in left if r[2] < end), key=lambda r: (r[2], r[1]))
                left = [r for r in left if r[2] >= end]
                for r in ready:
                    out.append(self._score(r, past))
                    if len(out) == OUT_ROWS:
                        yield self._frame(out)
                        out = []
            if out:
                yield self._frame(out)
            self.prior.update((_packed(past.prior),))
            if past.renamed:
                self.names.update((_packed((past.numbers, past.used)),))
            if left:  # rows of buckets that are still open
                b = min(r[2] for r in left) // (BUCKET_MS * 1000)
                self._wait(b, left)
                later = sorted({b, *later})
            held = {d: past.packed.get(d) or _packed(x) for d, x in past.days.items()}
        else:
            held = {int(d): v for d, v in zip(*ring)} if ring else {}
        kept = {d: held[d] for d in sorted(held) if (d + RING_DAYS) * DAY_MS > now}
        if not kept:
            self.ring.clear()
        elif due or len(kept) < len(held):
            self.ring.update(([*kept], [*kept.values()]))
        self._wake((later[0] + 1) * BUCKET_MS if later else (max(kept) + RING_DAYS) * DAY_MS if kept else None)

    def _score(self, row: tuple, past: _Past) -> tuple:
        """One row's flags; the row is added to ``past``."""
        limits = self.thresholds
        card, id_, t, amount, device, merchant, spend, top = row
        n, cents, squares = past.prior.get(card, (0, 0, 0))
        c = int(np.floor(abs(amount) * 100 + 0.5)) * (1 if amount >= 0 else -1)
        new = past.is_new(card, (device, merchant))
        average = cents / (100.0 * n) if n else None
        deviation = sqrt(float(n * squares - cents * cents) / float(n * (n - 1))) / 100.0 if n >= 2 else 0.0
        z = (amount - average) / deviation if deviation else None
        recent = past.recent(card, t // (DAY_MS * 1000), c)
        past.prior[card] = (n + 1, cents + c, squares + c * c)
        return (id_, card, t, amount, n, average, z, recent[1] / (100.0 * recent[0]),
                n > 0 and c * n > limits["multiple"] * cents, z is not None and z > limits["z"], new[0] and amount > limits["device_amount"],
                new[1] and spend is not None and amount > limits["spend_multiple"] * spend,
                top is not None and top > 0 and amount >= limits["limit_ratio"] * top)

    @staticmethod
    def _frame(out: list[tuple]) -> pd.DataFrame:
        names = [f.split()[0] for f in OUTPUT.split(", ")]
        frame = pd.DataFrame(out, columns=names)
        for name in ("prior_avg_amount", "amount_zscore"):  # None is NULL, not NaN
            frame[name] = pd.array(frame[name], dtype="Float64")
        return frame

    def close(self) -> None:
        pass


def card_scores(decoded: DataFrame, groups: int | None = None, **thresholds: float) -> DataFrame:
    """Every transaction of the stream ``decoded`` (watermark on ``timestamp``) with its baselines and flags, once its bucket has closed.

    The cards share ``groups`` states; without it every card has its own.
    """
    import sys

    from pyspark import cloudpickle
    from pyspark.sql.streaming import StatefulProcessor

    # the state runner starts outside the executors' py-files, so the processor is shipped by value
    cloudpickle.register_pickle_by_value(sys.modules[__name__])

    class _Processor(CardAlertProcessor, StatefulProcessor):
        pass

    src = decoded.select("card_id", "transaction_id", F.unix_micros("timestamp").alias("t_us"), F.col("amount").cast("double").alias("amount"), "device_id", "merchant_name",
                         F.col("avg_monthly_spend").cast("double").alias("avg_monthly_spend"), F.col("card_limit").cast("double").alias("card_limit"), "timestamp")
    if groups:
        src = src.withColumn("card_group", F.pmod(F.xxhash64("card_id"), F.lit(groups)))
    return src.groupBy("card_group" if groups else "card_id").transformWithStateInPandas(
        statefulProcessor=_Processor({**DEFAULTS, **thresholds}), outputStructType=OUTPUT, outputMode="Append", timeMode="EventTime")


RULES = ("over_average", "zscore", "new_device", "spend_spike", "near_limit")


def card_alerts(decoded: DataFrame, groups: int | None = GROUPS, **thresholds: float) -> DataFrame:
    """The flagged rows of ``card_scores`` with the names of their rules."""
    named = F.array_compact(F.array(*[F.when(F.col(r), F.lit(r)) for r in RULES]))
    return card_scores(decoded, groups, **thresholds).withColumn("rules", F.array_join(named, ",")).where(F.col("rules") != "").drop(*RULES)
