"""Quality classifier: a factorisation machine over a text's features.

A text becomes a sparse vector of

* hashed words: the presence of each distinct lower-cased word, in ``BUCKETS``
  dimensions, together of length one;
* structure statistics: shares of upper case, digits, punctuation, symbols and
  white space, word and line lengths, repetition, separators;
* metadata: the logarithm of its length in characters, words and lines.

``score = w0 + <w, x> + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)``
gives all pairwise interactions through rank-``RANK`` factors in time linear
in the non-zero features.  It is fitted with AdaGrad on a bounded sample of
labelled rows; label, language, source and id are never features.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardpulse.llm.common import arrow_map, held_out, staged

BUCKETS = 1 << 15
RANK = 8
#: At most about so many labelled rows are used for fitting; all words of each, thus at most ``BUCKETS`` integers a row.
TRAIN_ROWS = 6_000
#: Passes over the sample, more of them for a small one: at least MIN_UPDATES steps.
EPOCHS, MIN_UPDATES = 6, 600
BATCH = 64

_UPPER, _LOWER, _DIGIT, _SPACE, _MARK = range(5)
_KIND = np.full(256, 5, np.uint8)
_KIND[[*range(65, 91)]] = _UPPER
_KIND[[*range(97, 123)]] = _LOWER
_KIND[[*range(48, 58)]] = _DIGIT
_KIND[[32, *range(9, 14)]] = _SPACE
_KIND[[x for x in range(33, 127) if not chr(x).isalnum()]] = _MARK
N_STATS = 18


def statistics(text: str) -> np.ndarray:
    """Structure statistics and length metadata of a text; zeros for an empty one."""
    s = np.zeros(N_STATS)
    if not text:
        return s
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    of_byte = np.bincount(raw, minlength=256)
    kinds = np.bincount(_KIND, of_byte, 6)
    own = text.split()
    n, words = len(raw), max(1, len(own))
    letters = max(1.0, kinds[_UPPER] + kinds[_LOWER])
    lines = text.count("\n") + 1
    distinct = len(set(own))
    s[0] = kinds[_UPPER] / letters
    s[1:5] = kinds[[_DIGIT, _SPACE, _MARK, 5]] / n
    s[5] = of_byte[[33, 63]].sum() / words
    s[6] = of_byte[[35, 36, 37, 38, 42, 64, 94, 126]].sum() / words
    s[7] = of_byte[[124, 60, 62, 92, 95, 61, 123, 125]].sum() / words
    s[8] = of_byte[[44, 46]].sum() / words
    s[9] = min(4.0, n / words / 8)
    s[10] = distinct / words
    s[11] = sum(a == b for a, b in zip(own, own[1:])) / words
    s[12] = np.log1p(words / lines) / 4
    s[13] = min(4.0, max(map(len, own), default=0) / 20)
    s[14] = sum(len(w) < 3 for w in own) / words
    s[15] = np.log1p(n) / 10
    s[16] = np.log1p(words) / 8
    s[17] = np.log1p(lines) / 5
    return s


def hashed_words(text: str) -> np.ndarray:
    """Buckets of the distinct lower-cased words."""
    codes = [zlib.crc32(w.encode("utf-8", "replace")) for w in set(text.lower().split())]
    return np.unique(np.array(codes, np.int64) % BUCKETS)


@dataclass
class Machine:
    """Weights over ``N_STATS`` statistics followed by ``BUCKETS`` words."""

    bias: float
    linear: np.ndarray
    factors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    #: The mean score of each class is not 0.5 after fitting on balanced rows; this shift restores the label share.
    shift: float = 0.0

    def vector(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        text = text or ""
        stats = np.clip((statistics(text) - self.mean) / self.scale, -4, 4) / np.sqrt(N_STATS)
        words = hashed_words(text)
        return np.concatenate([np.arange(N_STATS), words + N_STATS]), np.concatenate([stats, np.full(len(words), 1 / np.sqrt(max(1, len(words))))])

    def raw(self, at: np.ndarray, x: np.ndarray) -> float:
        v = self.factors[at] * x[:, None]
        return self.bias + self.linear[at] @ x + 0.5 * float((v.sum(0) ** 2 - (v ** 2).sum(0)).sum())

    def score(self, text: str | None) -> float:
        z = self.raw(*self.vector(text)) + self.shift
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def fit(stats: np.ndarray, words: list[np.ndarray], y: np.ndarray, seed: int = 3, rate: float = 0.1, decay: float = 1e-5) -> Machine:
    """AdaGrad on the logistic loss, classes weighted alike; the label share comes back as a shift."""
    rng = np.random.default_rng(seed)
    size = N_STATS + BUCKETS
    mean, scale = stats.mean(0), np.maximum(stats.std(0), 1e-3)
    m = Machine(0.0, np.zeros(size), rng.normal(0, 0.05, (size, RANK)), mean, scale)
    dense = np.clip((stats - mean) / scale, -4, 4) / np.sqrt(N_STATS)
    size_of = np.array([N_STATS + len(w) for w in words])
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share))
    g_bias, g_linear, g_factors = 1e-8, np.full(size, 1e-8), np.full((size, RANK), 1e-8)
    for _ in range(max(EPOCHS, -(-MIN_UPDATES * BATCH // len(y)))):
        order = rng.permutation(len(y))
        for begin in range(0, len(y), BATCH):
            rows = order[begin:begin + BATCH]
            # only a batch at a time is held as (feature, value) pairs
            at = np.concatenate([a for i in rows for a in (np.arange(N_STATS), words[i].astype(np.int64) + N_STATS)])
            x = np.concatenate([a for i in rows for a in (dense[i], np.full(len(words[i]), 1 / np.sqrt(max(1, len(words[i])))))])
            first = np.concatenate([[0], np.cumsum(size_of[rows])[:-1]])
            row = np.repeat(np.arange(len(rows)), size_of[rows])
            vx = m.factors[at] * x[:, None]
            total = np.add.reduceat(vx, first)
            z = m.bias + np.add.reduceat(m.linear[at] * x, first) + 0.5 * (total ** 2 - np.add.reduceat(vx ** 2, first)).sum(1)
            error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[rows]) * weight[rows] / len(rows)
            used, place = np.unique(at, return_inverse=True)
            d = error[row] * x
            d_linear = np.bincount(place, d, len(used)) + decay * m.linear[used]
            d_factors = np.stack([np.bincount(place, d * (total[row, f] - vx[:, f]), len(used)) for f in range(RANK)], 1) + decay * m.factors[used]
            d_bias = error.sum()
            g_bias += d_bias ** 2
            g_linear[used] += d_linear ** 2
            g_factors[used] += d_factors ** 2
            m.bias -= rate * d_bias / np.sqrt(g_bias)
            m.linear[used] -= rate * d_linear / np.sqrt(g_linear[used])
            m.factors[used] -= rate / 4 * d_factors / np.sqrt(g_factors[used])
    m.shift = float(np.log(share / (1 - share)))
    return m


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Machine | float:
    """Fit on at most about ``rows`` labelled rows outside the held-out fold, chosen by a hash of the id.

    With fewer than two classes there is nothing to fit; the share of label 1
    (0.5 without rows) is returned and becomes every text's score.
    """
    usable = labels.where(F.col("quality").isin(0, 1) & ~held_out("doc_id"))
    n = usable.count()
    cut = int(min(1.0, rows / max(1, n)) * (1 << 30))
    chosen = usable.where(F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(1 << 30)) < cut).groupBy("doc_id").agg(F.max("quality").cast("int").alias("y"))
    # bounded by ``rows``, so the texts need no shuffle
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")

    def run(batches):
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            stats = [statistics(t) for t in texts]
            words = [hashed_words(t).astype(np.int32) for t in texts]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(stats, pa.list_(pa.float64())), pa.array(words, pa.list_(pa.int32()))], ["y", "stats", "words"])

    found = staged(arrow_map(sample.select("y", "text"), run, "y int, stats array<double>, words array<int>"), "quality-train").toPandas()
    y = found["y"].to_numpy(float)
    if len(set(y)) < 2:
        return float(y.mean()) if len(y) else 0.5
    return fit(np.stack(found["stats"]), [np.asarray(w, np.int32) for w in found["words"]], y)


def score(docs: DataFrame, machine: Machine | float, threshold: float = 0.7) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs``; ``predicted`` is 1 from ``threshold`` on.

    A null text scores as an empty one: no words and zero statistics.  Very long
    texts are fitted and scored with all their words.  Null
    doc_ids count as held out; repeated rows keep their rows; other columns are
    ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches):
        m = shared.value
        for b in batches:
            s = [m if isinstance(m, float) else m.score(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64())], ["doc_id", "score"])

    found = arrow_map(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, "doc_id long, score double")
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
