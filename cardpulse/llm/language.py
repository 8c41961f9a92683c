"""Language identification with string kernels.

Two texts are compared by the *blended spectrum presence kernel*: the number
of character n-grams (1 to ``GRAMS`` bytes) that both have, divided by the
geometric mean of their own numbers.  N-grams are hashed to ``BUCKETS`` bits,
so the kernel is an inner product of presence vectors.  A long text is cut
into windows of at most ``WINDOW`` bytes and stands for their mean, so that
its presence bits never fill up; the kernel of two texts is then the mean over
all pairs of their windows.  A bounded sample of
training texts gives *landmarks*; the Nyström map ``K(x, L) K(L, L)^-1/2``
turns a text into a vector, and one ridge regression per language (one versus
rest) is fitted on those vectors.  A batch of texts is scored by two matrix
products: presence times landmarks, then kernel values times weights.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardpulse.llm.common import arrow_map, held_out, staged

GRAMS = 4
BUCKETS = 1 << 13
#: Bounds per language: landmarks, and rows for the regression.
LANDMARKS, TRAIN_ROWS = 48, 400
RIDGE = 1e-3
BATCH = 128
#: Bytes of a window, at most; a text's windows are of about equal length.
WINDOW = 2048
UNKNOWN = "und"

_LETTER = re.compile(r"[^\W\d_]")
_NOT_WORD = bytes(32 if x < 128 and not chr(x).isalpha() else x for x in range(256))


def spectrum(text: str | None, out: np.ndarray | None = None) -> np.ndarray:
    """Mean over the windows of a lower-cased text of their hashed n-gram presence, each of length one.

    ASCII non-letters count as blanks; a window shares its last ``GRAMS - 1``
    bytes with the next one, so no n-gram is lost at a border.
    """
    if out is None:
        out = np.zeros(BUCKETS, np.float32)
    raw = b" ".join((text or "").lower().encode("utf-8", "replace").translate(_NOT_WORD).split())
    if not raw:
        return out
    raw = np.frombuffer(b" " + raw + b" ", np.uint8)
    windows = -(-len(raw) // WINDOW)
    seen = np.empty(BUCKETS, bool)
    for i in range(windows):
        part = raw[len(raw) * i // windows:len(raw) * (i + 1) // windows + GRAMS - 1].astype(np.uint64)
        seen[:] = False
        code = np.zeros(len(part), np.uint64)
        for n in range(1, min(GRAMS, len(part)) + 1):
            code = code[:len(part) - n + 1] * np.uint64(257) + part[n - 1:] + np.uint64(1)
            seen[((code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(51)).astype(np.int64)] = True
        out[seen] += np.float32(1 / (windows * np.sqrt(np.count_nonzero(seen))))
    return out


def has_letter(text: str | None) -> bool:
    return bool(text and _LETTER.search(text))


@dataclass
class Kernel:
    languages: list[str]
    landmarks: np.ndarray  # spectra of the landmark texts
    weights: np.ndarray  # landmarks x languages: K(L, L)^-1/2 times the ridge weights
    bias: np.ndarray

    def values(self, texts: list[str | None]) -> np.ndarray:
        x = np.zeros((len(texts), BUCKETS), np.float32)
        for i, t in enumerate(texts):
            spectrum(t, x[i])
        return x @ self.landmarks.T

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """(language, score) per text; ``und`` with score 0 for one without letters."""
        if not self.languages:
            return [(UNKNOWN, 0.0)] * len(texts)
        votes = self.values(texts).astype(float) @ self.weights + self.bias
        best = votes.argmax(1)
        # regression targets are -1 and 1
        sure = np.clip((votes.max(1) + 1) / 2, 0.0, 1.0)
        return [(self.languages[b], float(s)) if has_letter(t) else (UNKNOWN, 0.0) for t, b, s in zip(texts, best, sure)]


def fit(texts: list[str], languages: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Kernel:
    """Landmarks are the first ``landmarks`` texts of each language; all texts enter the regression."""
    names = sorted(set(languages))
    own = np.array(languages)
    if not names:
        return Kernel([], np.zeros((0, BUCKETS), np.float32), np.zeros((0, 0)), np.zeros(0))
    x = np.stack([spectrum(t) for t in texts])
    chosen = np.concatenate([np.flatnonzero(own == name)[:landmarks] for name in names])
    marks = x[chosen]
    among, between = (marks @ marks.T).astype(float), (x @ marks.T).astype(float)
    value, vector = np.linalg.eigh(among)
    root = vector @ np.diag(1 / np.sqrt(np.maximum(value, 1e-6))) @ vector.T
    z = between @ root
    y = np.where(own[:, None] == np.array(names)[None], 1.0, -1.0)
    # languages weigh alike
    weight = (1 / np.array([(own == name).sum() for name in own]))[:, None]
    mean = (z * weight).sum(0) / weight.sum()
    zc = z - mean
    solved = np.linalg.solve(zc.T @ (zc * weight) + ridge * np.eye(len(marks)), zc.T @ ((y - (y * weight).sum(0) / weight.sum()) * weight))
    bias = (y * weight).sum(0) / weight.sum() - mean @ solved
    return Kernel(names, marks, root @ solved, bias)


def train(docs: DataFrame, rows: int = TRAIN_ROWS, landmarks: int = LANDMARKS) -> Kernel:
    """Fit on at most about ``rows`` texts per language, chosen by a hash of id and text.

    Only rows outside the held-out fold with a language and a letter in the
    text are used.  The number of languages is taken to be small.
    """
    usable = docs.where(F.col("lang").isNotNull() & ~held_out("doc_id") & F.col("text").isNotNull())
    usable = usable.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"), F.pmod(F.xxhash64(F.lit(9), "doc_id", "text"), F.lit(1 << 30)).alias("draw"))
    counts = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}
    if not counts:
        return fit([], [])
    limits = docs.sparkSession.createDataFrame([(k, int(min(1.0, rows / n) * (1 << 30))) for k, n in counts.items()], "lang string, upto long")
    # one row per language
    sample = staged(usable.join(F.broadcast(limits), "lang").where("draw < upto").select("lang", "text", "draw"), "language-train")
    found = [r for r in sample.orderBy("draw", "lang", "text").toPandas().itertuples() if has_letter(r.text)]
    return fit([r.text for r in found], [r.lang for r in found], landmarks)


def predict(docs: DataFrame, kernel: Kernel) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) per row of ``docs``.

    Texts of any length are read whole, window by window: a long text's votes
    are the mean of its windows'.
    Null, empty or letterless texts are ``und`` with score 0.  Null doc_ids
    count as held out; repeated rows keep their rows; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(kernel)

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, BATCH):
                part = b.slice(at, BATCH)
                found = shared.value.predict(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([n for n, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())], ["doc_id", "lang_pred", "score"])

    found = arrow_map(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, "doc_id long, lang_pred string, score double")
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")
