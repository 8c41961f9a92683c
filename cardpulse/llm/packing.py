"""Packing documents into fixed-length sequences by length patterns.

Only piece lengths matter for packing, and there are at most ``capacity`` of
them, so the plan is made from the length histogram:

1. enumerate *few-document patterns*: one to three lengths that fill a
   sequence (exactly, or as closely as the present lengths allow);
2. fit non-negative repeat counts of the patterns to the histogram by least
   squares, round them, and take them, the fullest patterns first, while the
   histogram has the pieces;
3. pack the residual counts by best fit: longest length first, the rest of the
   sequence filled by the closest one, two or three lengths left.

The plan lists, per length, which ranks go to which sequences.  A piece's rank
among equal lengths comes from counters kept while encoding (per task and
length) plus a prefix over the per-task counts, so no length, however common,
is sorted or gathered anywhere.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardpulse.llm import tokens
from cardpulse.llm.common import arrow_map, staged

CAPACITY = 1024
END_ID = 2
#: Patterns per length that take part in the fit, and its gradient steps.
PATTERNS_PER_LENGTH = 6
FIT_STEPS = 400


def pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = tokens.VOCABULARY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, part, nth[, ids]) of every whole text.

    A document is its ids and ``end_id``; only one longer than ``capacity`` is
    cut, its first piece holding what full pieces leave over.  ``nth`` numbers
    the pieces of a length within task ``part``.
    """
    end = np.array([end_id], "<u4").tobytes()
    fields = {"doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64(), "part": pa.int32(), "nth": pa.int64()}
    if with_ids:
        fields["ids"] = pa.binary()

    def run(batches):
        part, seen = TaskContext.get().partitionId(), Counter()
        for b in batches:
            names = b.column(0).to_pylist()
            for i, texts in tokens.in_slices(b.column(1)):
                out = {f: [] for f in fields}
                for name, raw in zip(names[i:], tokens.encoder(vocabulary).ids(texts)):
                    raw += end
                    n = len(raw) // 4
                    first = n % capacity or min(n, capacity)
                    for k, at in enumerate([0, *range(first, n, capacity)]):
                        size = first if k == 0 else capacity
                        ids = raw[4 * at:4 * (at + size)]
                        for f, v in zip(fields, (name, k, at, size, zlib.crc32(ids), part, seen[size], ids)):
                            out[f].append(v)
                        seen[size] += 1
                yield pa.RecordBatch.from_arrays([pa.array(out[f], t) for f, t in fields.items()], list(fields))

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long" + ", ids binary" * with_ids
    return arrow_map(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, schema)


def _closest(left: np.ndarray, room: int) -> list[int]:
    """One to three available lengths with the largest sum of at most ``room``; fewer and longer ones first.

    The sums that one, two and three lengths reach are sets of bits; a sum that
    needs a length more often than it is left is passed over.
    """
    have = np.flatnonzero(left[:room + 1])[::-1].tolist()
    fits = (1 << (room + 1)) - 1
    one = sum(1 << n for n in have)
    two = three = 0
    for n in have:
        two |= one << n
    two &= fits
    for n in have:
        three |= two << n
    three &= fits

    def pair(total: int, *but: int) -> list[int]:
        for n in have:
            m = total - n
            if 0 < m <= n and one >> m & 1 and left[n] >= 1 + (m == n) + but.count(n) and left[m] >= 1 + (m == n) + but.count(m):
                return [n, m]
        return []

    sums = (one | two | three) & ~1
    while sums:
        total = sums.bit_length() - 1
        if one >> total & 1:
            return [total]
        if two >> total & 1 and (found := pair(total)):
            return found
        if three >> total & 1:
            for n in have:
                if n < total and two >> (total - n) & 1 and (found := pair(total - n, n)):
                    return [n, *found]
        sums ^= 1 << total
    return []


def patterns(histogram: np.ndarray, capacity: int, each: int = PATTERNS_PER_LENGTH) -> list[tuple[int, ...]]:
    """Few-document patterns over the lengths present: for each length its closest partners, then its fullest triples."""
    have = np.flatnonzero(histogram)
    found = {(int(n),) for n in have}
    for a in have[::-1]:
        k = int(np.searchsorted(have, capacity - a, side="right"))
        found |= {tuple(sorted((int(a), int(b)), reverse=True)) for b in have[max(0, k - 2):k]}
        smaller = have[:k]
        if len(smaller):
            seconds = smaller[np.unique(np.linspace(0, len(smaller) - 1, each).astype(int))]
            for b in seconds:
                m = int(np.searchsorted(have, capacity - a - b, side="right"))
                if m:
                    found.add(tuple(sorted((int(a), int(b), int(have[m - 1])), reverse=True)))
    return sorted(p for p in found if sum(p) <= capacity)


def fit(found: list[tuple[int, ...]], histogram: np.ndarray, waste: float = 1.0, steps: int = FIT_STEPS) -> np.ndarray:
    """Non-negative least squares: repeat counts whose lengths add up to the histogram (accelerated projected gradient).

    Lengths weigh by their size, so tokens are fitted rather than pieces, and
    a pattern's waste is charged to it, ``waste`` times.
    """
    capacity = len(histogram) - 1
    rows = np.flatnonzero(histogram)
    place = {int(n): i for i, n in enumerate(rows)}
    a = np.zeros((len(rows) + 1, len(found)))
    for j, p in enumerate(found):
        for n in p:
            a[place[n], j] += n
        a[-1, j] = waste * (capacity - sum(p))
    target = np.append(histogram[rows] * rows, 0.0).astype(float)
    scale = max(1.0, target.max())
    target /= scale
    step = 1.0 / max(np.linalg.norm(a, 2) ** 2, 1e-12)
    x = y = np.zeros(len(found))
    t = 1.0
    for _ in range(steps):
        nxt = np.maximum(0.0, y - step * (a.T @ (a @ y - target)))
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = nxt + (t - 1) / t_next * (nxt - x)
        x, t = nxt, t_next
    return x * scale


#: How a fit charges waste, and from which share on its filled patterns are taken; the plan with the fewest sequences counts.
CHOICES = ((1.0, 1.0), (1.0, 0.98), (1.0, 0.0), (0.1, 0.0))


def plan(histogram: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, repeats): every piece of the histogram exactly once."""
    capacity = len(histogram) - 1
    rest = histogram.astype(np.int64).copy()
    rest[capacity] = 0
    found = [p for p in patterns(rest, capacity) if len(p) > 1] if rest.any() else []
    repeats = {waste: fit(found, rest, waste) if found else np.zeros(0) for waste, _ in CHOICES}
    plans = [_plan(histogram, found, repeats[waste], least) for waste, least in CHOICES]
    return min(plans, key=lambda p: sum(times for _, times in p))


def _plan(histogram: np.ndarray, found: list[tuple[int, ...]], repeats: np.ndarray, least: float) -> list[tuple[tuple[int, ...], int]]:
    """The plan that takes fitted patterns filled by at least ``least`` of the capacity, and packs what is left."""
    capacity = len(histogram) - 1
    left = histogram.astype(np.int64).copy()
    out = []

    def take(p: tuple[int, ...], times: int) -> int:
        own = Counter(p)
        times = min([times, *(int(left[n]) // m for n, m in own.items())])
        if times > 0:
            for n, m in own.items():
                left[n] -= m * times
            out.append((p, times))
        return times

    if left[capacity]:
        take((capacity,), int(left[capacity]))
    # the fullest first where two want the same pieces
    for j in sorted(range(len(found)), key=lambda j: (-sum(found[j]), -repeats[j])):
        if sum(found[j]) >= least * capacity:
            take(found[j], int(repeats[j] + 0.5))
    while left.any():
        p = [int(np.flatnonzero(left)[-1])]
        room = capacity - p[0]
        left[p[0]] -= 1
        while room and (more := _closest(left, room)):
            for n in more:
                left[n] -= 1
            p += more
            room -= sum(more)
        for n in p:
            left[n] += 1
        own = Counter(p)
        # the same filling again while it stays possible
        take(tuple(p), min(int(left[n]) // m for n, m in own.items()))
    return out


def slots(planned: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, offset, pieces a sequence) per length of each pattern."""
    out, used, base = [], Counter(), 0
    for p, times in planned:
        offset = 0
        for n, m in sorted(Counter(p).items(), reverse=True):
            out.append((n, used[n], used[n] + m * times, base, offset, m))
            used[n] += m * times
            offset += n * m
        base += times
    return out


def place(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to ``cut`` (rows of ``pieces``, written and read back)."""
    spark = cut.sparkSession
    counts = cut.groupBy("part", "length").agg(F.count("*").alias("n"))
    counts = staged(counts, "packing-counts")
    histogram = np.zeros(capacity + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``capacity`` rows
        histogram[r["length"]] = r["n"]
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    ranked = cut.join(first, ["part", "length"]).withColumn("rank", F.col("first") + F.col("nth"))
    listed = slots(plan(histogram))
    table = spark.createDataFrame(listed, "length long, low long, high long, base long, shift long, each long")
    # a plan has a few rows per length and pattern, whatever the number of pieces
    here = ranked.join(F.broadcast(table), (ranked["length"] == table["length"]) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))).drop(table["length"])
    step = F.col("rank") - F.col("low")
    sequence = F.col("base") + F.floor(step / F.col("each"))
    offset = F.col("shift") + step % F.col("each") * F.col("length")
    return here.withColumn("sequence_id", sequence.cast("long")).withColumn("offset", offset.cast("long")).select(*[c for c in cut.columns if c not in ("part", "nth")], "sequence_id", "offset")


def packed(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = tokens.VOCABULARY, end_id: int = END_ID) -> DataFrame:
    """Where every piece goes: (doc_id, piece, start, length, ids_crc32, sequence_id, offset).

    A null or empty text is the end id alone; null and repeated doc_ids keep
    their rows; columns other than doc_id and text are ignored; an empty table
    gives no rows.
    """
    return place(staged(pieces(docs, capacity, vocabulary, end_id), "packing-pieces"), capacity)


def sequences(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = tokens.VOCABULARY, end_id: int = END_ID) -> DataFrame:
    """The packed sequences: (sequence_id, ids) with ids as little-endian unsigned 32-bit integers; a group holds at most ``capacity`` ids."""
    placed = place(staged(pieces(docs, capacity, vocabulary, end_id, with_ids=True), "packing-ids"), capacity)
    parts = F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda x: F.hex(x["ids"]))
    return placed.groupBy("sequence_id").agg(F.unhex(F.concat_ws("", parts)).alias("ids"))
