"""Keyed streaming state for per-card features (T5).

Window functions over non-time orderings are rejected on streams, and a
``foreachBatch`` window only sees one micro-batch, so the per-card features
are carried across batches in keyed state with
``applyInPandasWithState``.  The key is a group of cards (a hash of the card),
so that the fixed cost of a call and of a state access is shared by its cards.
Per group and batch the handler works on numpy arrays (one lexsort, shifted
copies, ``searchsorted`` for the trailing counts, ``unique`` for the first use
of a merchant).  A group's rows in one micro-batch are bounded by the
trigger's rate limit (``maxFilesPerTrigger`` / ``maxOffsetsPerTrigger``).

State per card, stored by group: last transaction (time, id, lat, lon), the
event times of the trailing 24 hours (enough for the 1 h and 24 h counts) and
the merchants seen.  Rows of a card inside a batch are ordered by
``(t_us, transaction_id)``; equal times are peers for the trailing counts.
With event-time ordered input this equals the batch definitions; a late
row is scored against the state as it is (the batch job is the reference).
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

HOUR_US = 3_600_000_000
DAY_US = 24 * HOUR_US
NO_MERCHANT = "\0"  # how the merchant set remembers a NULL merchant


def _known_as(merchant) -> str:
    return NO_MERCHANT if merchant is None or merchant != merchant else merchant

#: Groups of cards, one state each; the second for the form whose state is split by minute.
GROUPS, MINUTE_GROUPS = 1024, 64
STATE_SCHEMA = "cards binary"
OUTPUT_SCHEMA = ("transaction_id string, card_id string, t_us long, location_lat double, location_lon double, "
                 "prev_t_us double, prev_lat double, prev_lon double, is_new_merchant boolean, "
                 "transactions_last_1hr long, transactions_last_24hr long")


class _Batch:
    """One group's rows of a micro-batch in (card, time, id) order.

    ``cards`` numbers the group's cards, those of the state first; ``code`` is
    each row's number.
    """

    def __init__(self, parts: list[pd.DataFrame], known: list[str]) -> None:
        pdf = parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True)
        self.cards = list(known)
        number = {c: i for i, c in enumerate(self.cards)}
        card0 = pdf["card_id"].to_numpy(dtype=object)
        code = np.empty(len(pdf), dtype=np.int64)
        for i, c in enumerate(card0):
            if c not in number:
                number[c] = len(self.cards)
                self.cards.append(c)
            code[i] = number[c]
        t0 = pdf["t_us"].to_numpy(dtype=np.int64)
        ids0 = pdf["transaction_id"].to_numpy(dtype=object)
        order = np.lexsort((ids0, t0, code))                # by (card, t_us, transaction_id)
        self.code, self.t, self.ids, self.card = code[order], t0[order], ids0[order], card0[order]
        self.lat = pdf["location_lat"].to_numpy(dtype=float)[order]
        self.lon = pdf["location_lon"].to_numpy(dtype=float)[order]
        self.merchant = [_known_as(m) for m in pdf["merchant_name"].to_numpy(dtype=object)[order]]
        turn = np.flatnonzero(self.code[1:] != self.code[:-1]) + 1
        self.first = np.concatenate([[0], turn])            # each card's first and last row
        self.final = np.concatenate([turn, [len(code)]]) - 1

    def previous(self, last: list) -> list[np.ndarray]:
        """Time, lat and lon of each row's predecessor, and the cards' ``last`` transaction moved on in place."""
        last.extend([None] * (len(self.cards) - len(last)))
        out = []
        for k, values in ((0, self.t), (2, self.lat), (3, self.lon)):
            prev = np.empty(len(values), dtype=float)       # micros < 2**53: exact as double
            prev[1:] = values[:-1]
            prev[self.first] = [np.nan if last[c] is None else last[c][k] for c in self.code[self.first].tolist()]
            out.append(prev)
        for i in self.final.tolist():
            c, own = int(self.code[i]), (int(self.t[i]), str(self.ids[i]), float(self.lat[i]), float(self.lon[i]))
            if last[c] is None or last[c][:2] <= own[:2]:   # late rows don't rewind the state
                last[c] = own
        return out

    def first_use(self, names: list[str], seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether a row's merchant is new to its card; ``seen`` (2 rows: card, number in ``names``) with the new pairs."""
        number = {m: i for i, m in enumerate(names)}
        mine = np.empty(len(self.merchant), dtype=np.int64)
        for i, m in enumerate(self.merchant):
            if m not in number:
                number[m] = len(names)
                names.append(m)
            mine[i] = number[m]
        pairs, at = np.unique(self.code * len(names) + mine, return_index=True)
        fresh = ~np.isin(pairs, seen[0] * len(names) + seen[1])
        new = np.zeros(len(mine), dtype=bool)
        new[at[fresh]] = True
        return new, np.concatenate([seen, np.divmod(pairs[fresh], len(names))], axis=1)

    def output(self, prev: list[np.ndarray], new_m: np.ndarray, n1: np.ndarray, n24: np.ndarray) -> pd.DataFrame:
        # nullable columns so "no previous row" arrives in Spark as NULL, not NaN
        prev_t, prev_lat, prev_lon = (pd.array(a, dtype="Float64") for a in prev)
        return pd.DataFrame({
            "transaction_id": self.ids, "card_id": self.card, "t_us": self.t,
            "location_lat": self.lat, "location_lon": self.lon, "prev_t_us": prev_t, "prev_lat": prev_lat,
            "prev_lon": prev_lon, "is_new_merchant": new_m,
            "transactions_last_1hr": n1.astype(np.int64), "transactions_last_24hr": n24.astype(np.int64),
        })


class _Ranked:
    """Pairs (card number, value) in order, to count a card's values below a bound."""

    def __init__(self, code: np.ndarray, value: np.ndarray) -> None:
        self.values = np.unique(value)
        self.width = len(self.values) + 1
        self.pairs = np.sort(code * self.width + np.searchsorted(self.values, value))

    def below(self, code: np.ndarray, bound: np.ndarray, inclusive: bool = False) -> np.ndarray:
        """Pairs of all cards before ``code`` and of ``code`` with a value under (inclusive: up to) ``bound``."""
        rank = np.searchsorted(self.values, bound, side="right" if inclusive else "left")
        return np.searchsorted(self.pairs, code * self.width + rank, side="left")


_NO_CARDS = ([], [], np.empty((2, 0), dtype=np.int64), [], np.empty((2, 0), dtype=np.int64))


def _card_state(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    cards, last, recent, names, seen = pickle.loads(state.get[0]) if state.exists else _NO_CARDS
    last, names = list(last), list(names)
    b = _Batch(list(pdfs), cards)
    prev = b.previous(last)
    new_m, seen = b.first_use(names, seen)
    recent = np.concatenate([recent, [b.code, b.t]], axis=1)  # card, time
    times = _Ranked(*recent)
    upto = times.below(b.code, b.t, inclusive=True)           # rows with time <= t (peers included)
    n1 = upto - times.below(b.code, b.t - HOUR_US)
    n24 = upto - times.below(b.code, b.t - DAY_US)
    newest = np.full(len(b.cards), np.iinfo(np.int64).min)
    np.maximum.at(newest, recent[0], recent[1])
    recent = recent[:, recent[1] >= newest[recent[0]] - DAY_US]
    state.update((pickle.dumps((b.cards, last, recent, names, seen), protocol=5),))
    yield b.output(prev, new_m, n1, n24)


def _by_group(decoded: DataFrame, groups: int) -> DataFrame:
    return decoded.select(F.pmod(F.xxhash64("card_id"), F.lit(groups)).alias("card_group"), "transaction_id", "card_id",
                          F.unix_micros("timestamp").alias("t_us"), "location_lat", "location_lon", "merchant_name")


def card_state_features(decoded: DataFrame) -> DataFrame:
    """Streaming per-card features over decoded messages (``timestamp`` is
    the event time).  Distance and gap are computed after the state step
    with the same native expressions the batch path uses."""
    from ..functions.geo import haversine_km
    st = _by_group(decoded, GROUPS).groupBy("card_group").applyInPandasWithState(
        _card_state, OUTPUT_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout)
    return st.select(
        "transaction_id", "card_id", "t_us",
        ((F.col("t_us") - F.col("prev_t_us").cast("bigint")) / F.lit(60_000_000.0)).alias("minutes_since_last_txn"),
        haversine_km("prev_lat", "prev_lon", "location_lat", "location_lon").alias("distance_from_last_txn_km"),
        "is_new_merchant", "transactions_last_1hr", "transactions_last_24hr")


# ---------------------------------------------------------------------------
# transformWithState form: state split per minute, updated incrementally
# ---------------------------------------------------------------------------

MINUTE_US = 60_000_000


def _packed(*rows) -> tuple[bytes]:
    return (np.array(rows, dtype=np.int64).tobytes(),)


def _unpacked(value) -> np.ndarray:
    return np.frombuffer(value[0], dtype=np.int64).reshape(2, -1)


class CardFeatureProcessor:
    """Per-card streaming features with state that does not grow per batch.

    State (per group of cards; cards by their number in the group):

    * ``cards``           the cards, their previous transaction (time, id,
                          lat, lon), newest time and merchants seen
    * ``minute_count``    minute → (card, number of transactions in that minute)
    * ``minute_times``    minute → (card, exact event time in that minute)

    For a batch, the trailing counts over ``[t − w, t]`` are prefix sums of
    the minute counts plus exact counts inside the boundary minutes only, so
    a batch reads the minute index and the boundary minutes' times, never the
    whole 24 h of times of a hot card that few minutes of a batch concern; it
    writes only the minutes it touched and deletes minutes that are older
    than 24 h for all their cards.  Equal to the batch definitions for
    event-time ordered input.
    """

    #: With more boundary minutes than this they are read in one go.
    FEW_MINUTES = 64

    def init(self, handle) -> None:
        self.cards = handle.getValueState("cards", "cards binary")
        self.minute_count = handle.getMapState("minute_count", "m long", "counts binary")
        self.minute_times = handle.getMapState("minute_times", "m long", "times binary")

    def handleInputRows(self, key, rows, timerValues):
        past = self.cards.get()
        cards, last, newest, names, seen = pickle.loads(past[0]) if past else ([], [], np.empty(0, dtype=np.int64), [], _NO_CARDS[4])
        b = _Batch(list(rows), cards)
        prev = b.previous(last)
        new_m, seen = b.first_use(names, seen)
        horizon = (newest - DAY_US) // MINUTE_US - 1              # older minutes of a card are gone

        # trailing counts from minute prefix sums + exact boundary minutes
        stored = {int(r[0]): _unpacked(v) for r, v in self.minute_count.iterator()}
        old = [np.stack([v[0], np.full(v.shape[1], m), v[1]]) for m, v in stored.items()]
        bm = b.t // MINUTE_US
        held = np.concatenate([*old, np.empty((3, 0), dtype=np.int64)], axis=1)
        held = held[:, held[1] >= horizon[held[0]]]               # card, minute, count
        counted = np.concatenate([held, [b.code, bm, np.ones_like(bm)]], axis=1)
        counted = counted[:, np.lexsort((counted[1], counted[0]))]
        minutes = _Ranked(counted[0], counted[1])
        cum = np.concatenate([[0], np.cumsum(counted[2])])

        bounds = (b.t, b.t - HOUR_US, b.t - DAY_US)
        wanted = {m for q in bounds for m in np.unique(q // MINUTE_US).tolist() if m in stored}
        times = self._times(wanted)
        exact = np.concatenate([*[v[:, v[1] // MINUTE_US >= horizon[v[0]]] for v in times.values()], [b.code, b.t]], axis=1)
        exact = _Ranked(*exact)

        def count_before(q: np.ndarray, inclusive: bool) -> np.ndarray:
            qm = q // MINUTE_US
            return cum[minutes.below(b.code, qm)] + exact.below(b.code, q, inclusive) - exact.below(b.code, qm * MINUTE_US)

        upto = count_before(bounds[0], inclusive=True)
        n1 = upto - count_before(bounds[1], inclusive=False)
        n24 = upto - count_before(bounds[2], inclusive=False)

        # state update: touched minutes, expiry, cards
        by_minute = np.argsort(bm, kind="stable")
        touched, start = np.unique(bm[by_minute], return_index=True)
        for m, own in zip(touched.tolist(), np.split(by_minute, start[1:])):
            add, n = np.unique(b.code[own], return_counts=True)
            new_count, new_times = np.array([add, n]), np.array([b.code[own], b.t[own]])
            if m in stored:
                old_count = stored[m]
                new_times = np.concatenate([times[m], new_times], axis=1)
                both, at = np.unique(np.concatenate([old_count[0], add]), return_inverse=True)
                new_count = np.array([both, np.bincount(at, np.concatenate([old_count[1], n])).astype(np.int64)])
            self.minute_count.updateValue((m,), _packed(*new_count))
            self.minute_times.updateValue((m,), _packed(*new_times))
        newest = np.concatenate([newest, np.full(len(b.cards) - len(newest), np.iinfo(np.int64).min // 2)])
        np.maximum.at(newest, b.code, b.t)
        horizon, now = (newest - DAY_US) // MINUTE_US - 1, set(touched.tolist())
        for m, v in stored.items():
            if m not in now and (m < horizon[v[0]]).all():
                self.minute_count.removeKey((m,))
                self.minute_times.removeKey((m,))
        self.cards.update((pickle.dumps((b.cards, last, newest, names, seen), protocol=5),))
        yield b.output(prev, new_m, n1, n24)

    def _times(self, wanted: set[int]) -> dict[int, np.ndarray]:
        if len(wanted) > self.FEW_MINUTES:
            return {int(r[0]): _unpacked(v) for r, v in self.minute_times.iterator() if int(r[0]) in wanted}
        return {m: _unpacked(self.minute_times.getValue((m,))) for m in wanted}

    def close(self) -> None:
        pass


def card_state_features_tws(decoded: DataFrame) -> DataFrame:
    """``card_state_features`` on ``transformWithStateInPandas`` with the
    minute-indexed state of :class:`CardFeatureProcessor`."""
    import sys

    from pyspark import cloudpickle
    from pyspark.sql.streaming import StatefulProcessor

    from ..functions.geo import haversine_km

    # the processor runs in Python processes that may not import this
    # package (the state runner starts outside the executors' py-files), so
    # its code is shipped by value
    cloudpickle.register_pickle_by_value(sys.modules[__name__])

    class _Processor(CardFeatureProcessor, StatefulProcessor):
        pass

    st = _by_group(decoded, MINUTE_GROUPS).groupBy("card_group").transformWithStateInPandas(
        statefulProcessor=_Processor(), outputStructType=OUTPUT_SCHEMA, outputMode="Append", timeMode="None")
    return st.select(
        "transaction_id", "card_id", "t_us",
        ((F.col("t_us") - F.col("prev_t_us").cast("bigint")) / F.lit(60_000_000.0)).alias("minutes_since_last_txn"),
        haversine_km("prev_lat", "prev_lon", "location_lat", "location_lon").alias("distance_from_last_txn_km"),
        "is_new_merchant", "transactions_last_1hr", "transactions_last_24hr")
