"""Toxicity by class-conditional Kneser-Ney language models.

Two models, one of toxic and one of ordinary text, spell words letter by letter
in the context of the ``ORDER - 1`` letters before, with marks for a word's
begin and end.  They are counted over every training text that does not
calibrate.  A text is scored by the difference of their length-normalised
log-likelihoods, over the whole text and over its windows, and a logistic
calibration turns that into a probability.

* ``P_c(x | h) = (count_c(hx) - D)+ / count_c(h) + back_c(h) P_c(x | h')`` with
  ``h'`` the context without its first letter.  Counts are occurrences for the
  longest grams and for those at a word's begin, and continuation counts (how
  many different letters come before) for all shorter ones.
* Up to ``SHARED`` letters both classes use the same counts, of both together.
  So a rare expression speaks through its stem and its other parts, and what is
  rare in all parts says nothing for or against a class.
* No gram is left out, however rare.  Occurrences of words are summed first, so
  the grams are counted over distinct words, not over texts.

The model is a written table that grows with the training texts.  Its most
frequent entries, at most ``HEAD_ENTRIES``, are sent to the tasks.  If there are
others, they are joined to the distinct grams of ``BLOCK`` texts each; both ways
give the same scores.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from cardpulse.llm.common import arrow_map, held_out, staged
from cardpulse.llm.tokens import in_slices
from cardpulse.session import ship_package

ORDER, SHARED = 5, 2
DISCOUNT = 0.75
#: What the empty context spreads evenly.
UNIFORM = 1 / 65536
#: Most entries that are sent to every task.
HEAD_ENTRIES = 500_000
#: Rows whose grams are looked up together, where the model is larger than that.
BLOCK = 64
#: At most about so many labelled rows are kept from counting and scored for the logistic fit.
CALIBRATION_ROWS = 20_000
WINDOWS = (2, 8)
N_FEATURES = 6
#: Distinct words a counting task holds before it hands them on; distinct words spelled together.
FLUSH_WORDS, SPELL_WORDS = 200_000, 20_000
BEGIN, END = "\x02", "\x03"
#: An entry's columns: what it gets as a gram, and what it leaves to shorter contexts as a context; ordinary and toxic.
VALUES = ("direct_o", "direct_t", "back_o", "back_t")

_WORD = re.compile(r"[^\W\d_]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def _name(code: np.ndarray, length: int) -> np.ndarray:
    """64-bit names of grams from their polynomial codes (the finaliser of a well-known mixer)."""
    x = code + np.uint64(length)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))).view(np.int64)


EMPTY = int(_name(np.zeros(1, np.uint64), 0)[0])


@dataclass
class Spelled:
    """Distinct words as one row of letters."""

    start: np.ndarray  # where each word's begin mark is
    depth: np.ndarray  # letters since that mark
    names: list[np.ndarray]  # names[n][i]: the gram of n letters that ends at i, where depth allows it

    def grams(self, n: int) -> np.ndarray:
        """Places that end a gram of ``n`` letters; the begin mark itself is given."""
        return np.flatnonzero(self.depth >= max(1, n - 1))


def spelled(units: list[str]) -> Spelled:
    text = "".join([f"{BEGIN}{w}{END}" for w in units])
    letters = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
    at = np.arange(len(letters))
    start = np.flatnonzero(letters == ord(BEGIN) + 1)
    depth = at - np.repeat(start, np.diff(np.append(start, len(letters))))
    code = np.zeros(len(letters), np.uint64)
    names = [np.full(len(letters), EMPTY)]
    for n in range(1, ORDER + 1):
        code = np.concatenate([code[:1] * 0, code[:-1]]) * _BASE + letters  # wraps around
        names.append(_name(code, n))
    return Spelled(start, depth, names)


@dataclass
class Entries:
    """Model entries by their names, which are hashes, in a table four times their number."""

    name: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    value: np.ndarray = field(default_factory=lambda: np.zeros((0, len(VALUES))))

    @cached_property
    def _slots(self) -> np.ndarray:
        slots = np.full(1 << max(2, (4 * len(self.name)).bit_length()), -1, np.int32)
        left = np.arange(len(self.name), dtype=np.int32)
        slot = self.name & (len(slots) - 1)
        while len(left):
            free = slots[slot] < 0
            slots[slot[free]] = left[free]
            lost = slots[slot] != left
            left, slot = left[lost], (slot[lost] + 1) & (len(slots) - 1)
        return slots

    def __getstate__(self) -> dict:
        return {"name": self.name, "value": self.value}

    def places(self, wanted: np.ndarray) -> np.ndarray:
        """Places of ``wanted``; the number of entries for what is not there."""
        if not len(self.name):
            return np.zeros(len(wanted), np.int32)
        slots = self._slots
        slot = wanted & (len(slots) - 1)
        at = slots[slot]
        open_ = np.flatnonzero((at >= 0) & (self.name[at] != wanted))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & (len(slots) - 1)
            at[open_] = found = slots[slot[open_]]
            open_ = open_[(found >= 0) & (self.name[found] != wanted[open_])]
        at[at < 0] = len(self.name)
        return at


@dataclass
class Model:
    head: Entries
    rest: DataFrame | None = None  # (name, *VALUES) of all other entries; None if there are none

    def wanted(self, units: list[str]) -> np.ndarray:
        """Names of the grams of ``units`` that are not in the head."""
        s = spelled(units)
        every = np.unique(np.concatenate([s.names[n][s.grams(n)] for n in range(1, ORDER + 1)] + [s.names[1][s.start], [EMPTY]]))
        return every[self.head.places(every) == len(self.head.name)]

    def word_llr(self, units: list[str], more: Entries) -> np.ndarray:
        """Log-likelihood difference of each word; ``more`` holds what of ``wanted`` the model has."""
        if not units:
            return np.zeros(0)
        s = spelled(units)
        nothing = np.array([[0.0, 0.0, 1.0, 1.0]])
        value = np.concatenate([self.head.value, more.value, nothing])

        def look(names):
            at = self.head.places(names)
            missing = np.flatnonzero(at == len(self.head.name))
            at[missing] += more.places(names[missing])
            return at

        p = np.full((len(s.depth), 2), UNIFORM)
        shorter = np.full(len(s.depth), look(np.array([EMPTY]))[0])
        for n in range(1, ORDER + 1):
            at = s.grams(n)
            here = np.full(len(s.depth), len(value) - 1, np.int32)
            known = np.flatnonzero(s.depth >= n - 1)
            here[known] = look(s.names[n][known])
            p[at] = value[here[at], :2] + value[shorter[at - 1], 2:] * p[at]
            shorter = here
        llr = np.where(s.depth > 0, np.log(p[:, 1]) - np.log(p[:, 0]), 0.0)
        return np.add.reduceat(llr, s.start)

    def text_llr(self, texts: list[list[str]], more: Entries) -> list[np.ndarray]:
        """``word_llr`` of every word of ``texts``."""
        ids: dict[str, int] = {}
        number = ids.setdefault
        coded = [np.fromiter((number(w, len(ids)) for w in own), np.int64, len(own)) for own in texts]
        units = list(ids)
        each = [self.word_llr(units[lo:lo + SPELL_WORDS], more) for lo in range(0, len(units), SPELL_WORDS)]
        llr = np.concatenate(each) if each else np.zeros(0)
        return [llr[c] for c in coded]

    def token_llr(self, own: list[str]) -> np.ndarray:
        return self.text_llr([own], Entries())[0]

    def sendable(self) -> Model:
        return replace(self, rest=None)


def features(llr: np.ndarray) -> np.ndarray:
    """Length-normalised log-likelihood differences: the text's, its best windows', and their spread."""
    f = np.zeros(N_FEATURES)
    if not len(llr):
        return f
    llr = np.clip(llr, -8.0, 8.0)
    n, total = len(llr), np.concatenate([[0.0], np.cumsum(llr)])
    f[0] = total[-1] / n
    f[1] = np.clip(total[-1] / np.sqrt(n), -20, 20)
    for i, width in enumerate(WINDOWS):
        width = min(width, n)
        f[2 + i] = (total[width:] - total[:-width]).max() / width
    top = llr > 2.0
    f[4] = np.log1p(top.sum())
    f[5] = np.sqrt(top.mean())
    return f


@dataclass
class Scorer:
    model: Model | None
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def score(self, f: np.ndarray) -> float:
        x = (f - self.mean) / self.scale
        return float(1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -30, 30))))

    def sendable(self) -> Scorer:
        """The calibration alone."""
        return replace(self, model=None)


def labelled(docs: DataFrame, labels: DataFrame, name: str) -> DataFrame:
    """(doc_id, y, text) of rows outside the held-out fold whose label ``name`` is 0 or 1."""
    # a merge at every size: texts of training rows are shuffled once, whatever the size of the labels
    own = labels.where(F.col(name).isin(0, 1) & ~held_out("doc_id")).groupBy("doc_id").agg(F.max(name).cast("int").alias("y"))
    rows = docs.where(~held_out("doc_id")).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.join(own.hint("merge"), "doc_id").select("doc_id", "y", "text")


def _word_counts(train: DataFrame) -> DataFrame:
    """(word, ordinary, toxic) over the rows (y, text) of ``train``."""
    def run(batches):
        counts = Counter(), Counter()

        def flush():
            own = list(counts[0].keys() | counts[1].keys())
            columns = [pa.array([c[w] for w in own], pa.int64()) for c in counts]
            counts[0].clear(), counts[1].clear()
            return pa.RecordBatch.from_arrays([pa.array(own, pa.string()), *columns], ["word", "ordinary", "toxic"])

        for b in batches:
            for y, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                counts[y].update(words(text))
                if len(counts[0]) + len(counts[1]) > FLUSH_WORDS:
                    yield flush()
        yield flush()

    part = arrow_map(train.select("y", "text"), run, "word string, ordinary long, toxic long")
    return part.groupBy("word").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic"))


GRAM_SCHEMA = "name long, context long, tail long, length int, initial boolean, ordinary long, toxic long"


def _gram_counts(counted: DataFrame) -> DataFrame:
    """Occurrences of every gram of up to ``ORDER`` letters, with the names of its context and of its tail."""
    def run(batches):
        for b in batches:
            own = b.column(0).to_pylist()
            weight = [b.column(i).to_numpy(zero_copy_only=False) for i in (1, 2)]
            s = spelled(own)
            unit = np.repeat(np.arange(len(own)), np.diff(np.append(s.start, len(s.depth))))
            for n in range(1, ORDER + 1):
                at = s.grams(n)
                name, first, inverse = np.unique(s.names[n][at], return_index=True, return_inverse=True)
                sums = [np.bincount(inverse, w[unit[at]], len(name)).astype(np.int64) for w in weight]
                first = at[first]
                columns = [name, s.names[n - 1][first - 1], s.names[n - 1][first], np.full(len(name), n, np.int32), s.depth[first] == n - 1, *sums]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [f.split()[0] for f in GRAM_SCHEMA.split(", ")])

    part = arrow_map(counted.select("word", "ordinary", "toxic"), run, GRAM_SCHEMA)
    return part.groupBy("name", "context", "tail", "length", "initial").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic"))


def entries(train: DataFrame) -> DataFrame:
    """(name, seen, *VALUES) of every gram and context in the rows (y, text) of ``train``, as a written table."""
    grams = staged(_gram_counts(staged(_word_counts(train), "toxicity-words")), "toxicity-grams")
    before = grams.where("length > 1").groupBy(F.col("tail").alias("name")).agg(
        F.sum((F.col("ordinary") > 0).cast("long")).alias("kinds_o"), F.sum((F.col("toxic") > 0).cast("long")).alias("kinds_t"), F.count("*").alias("kinds"))
    both = F.col("ordinary") + F.col("toxic")
    whole = F.col("initial") | (F.col("length") == ORDER)

    def adjusted(own, kinds):
        shared = F.when(whole, both).otherwise(F.col("kinds"))
        return F.when(F.col("length") <= SHARED, shared).when(whole, F.col(own)).otherwise(F.col(kinds)).cast("double")

    counts = grams.join(before, "name", "left").select("name", "context", both.alias("seen"), adjusted("ordinary", "kinds_o").alias("o"), adjusted("toxic", "kinds_t").alias("t"))
    cut = lambda c: F.greatest(F.col(c) - DISCOUNT, F.lit(0.0))
    context = counts.groupBy("context").agg(F.sum("seen").alias("all"), *[F.sum(c).alias(f"sum_{c}") for c in "ot"], *[F.sum(cut(c)).alias(f"cut_{c}") for c in "ot"])
    gram = counts.join(context, "context").select("name", "seen", *[F.when(F.col(f"sum_{c}") > 0, cut(c) / F.col(f"sum_{c}")).otherwise(0.0).alias(f"direct_{c}") for c in "ot"])
    left = context.select(F.col("context").alias("name"), "all", *[F.when(F.col(f"sum_{c}") > 0, 1 - F.col(f"cut_{c}") / F.col(f"sum_{c}")).otherwise(1.0).alias(f"back_{c}") for c in "ot"])
    found = gram.join(left, "name", "full").select("name", F.greatest("seen", "all").alias("seen"), *[F.coalesce(f"direct_{c}", F.lit(0.0)).alias(f"direct_{c}") for c in "ot"],
                                                   *[F.coalesce(f"back_{c}", F.lit(1.0)).alias(f"back_{c}") for c in "ot"])
    return staged(found, "toxicity-model")


def train_model(train: DataFrame, head_entries: int | None = None) -> Model:
    """Count the models over all rows of ``train`` (y, text); entries beyond the ``head_entries`` most frequent stay in ``rest``."""
    limit = HEAD_ENTRIES if head_entries is None else head_entries
    found = entries(train)
    # eighths of powers of two: at most some hundred steps
    step = F.floor(F.log2(F.col("seen").cast("double")) * 8).cast("int")
    least, held = None, 0
    for row in found.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():
        if (held := held + row["count"]) > limit:
            least = row["step"]
            break
    head = found if least is None else found.where(step > least)
    rows = head.select("name", *VALUES).orderBy("name").toPandas()  # bounded by ``limit``
    sent = Entries(rows["name"].to_numpy(np.int64), rows[list(VALUES)].to_numpy(float))
    return Model(sent, None if least is None else found.where(step <= least).select("name", *VALUES))


def _per_row(texts: pa.Array, score) -> Iterator[tuple[int, list[np.ndarray]]]:
    """``score`` over slices of few bytes: (first row, differences per row)."""
    for at, part in in_slices(texts):
        yield at, score([words(x) for x in part.to_pylist()])


def with_llr(docs: DataFrame, model: Model, fn, schema, name: str) -> DataFrame:
    """``fn(rows, differences)`` over slices of ``docs`` (with ``text``), given every word's log-likelihood difference.

    ``rows`` is a table with the one column ``row``, a struct of all columns.
    Where the head is the whole model this is one pass; else the rows are
    written with a block number first, so that both readings agree on it.
    """
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model.sendable())  # bounded: HEAD_ENTRIES
    text = F.col("text").cast("string")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), text.alias("text"))
    if model.rest is None:
        def whole(batches):
            for b in batches:
                for at, llr in _per_row(b.column(1), lambda texts: shared.value.text_llr(texts, Entries())):
                    yield from fn(pa.table([b.column(0).slice(at, len(llr))], ["row"]), llr).to_batches()

        return arrow_map(rows, whole, schema)

    rows = staged(rows.withColumn("block", F.shiftright(F.monotonically_increasing_id(), BLOCK.bit_length() - 1)), name, compression="zstd")

    def wanted(batches):
        for b in batches:
            block = b.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(block)) + 1), len(block)]
            for lo, hi in zip(cuts, cuts[1:]):
                if hi > lo:
                    units = list({w for x in b.column(1).slice(lo, hi - lo).to_pylist() for w in words(x)})
                    keys = [shared.value.wanted(units[i:i + SPELL_WORDS]) for i in range(0, len(units), SPELL_WORDS)]
                    keys = np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), block[lo])), pa.array(keys)], ["block", "name"])

    def scored(own: pa.Table, hits: pa.Table) -> pa.Table:
        hits = hits.sort_by("name")
        more = Entries(hits["name"].to_numpy(), np.stack([hits[v].to_numpy() for v in VALUES], 1)) if len(hits) else Entries()
        parts = [fn(own.slice(at, len(llr)).select(["row"]), llr)
                 for at, llr in _per_row(own["text"].combine_chunks(), lambda texts: shared.value.text_llr(texts, more))]
        return pa.concat_tables(parts)

    asked = arrow_map(rows.select("block", "text"), wanted, "block long, name long")
    hits = asked.join(model.rest, "name").select("block", "name", *VALUES)
    return rows.groupBy("block").cogroup(hits.groupBy("block")).applyInArrow(scored, schema)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Newton steps for a ridge logistic fit; the last weight is the intercept."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    penalty = np.diag([ridge * len(x) / 100] * (x.shape[1] - 1) + [1e-6])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(docs: DataFrame, labels: DataFrame) -> Scorer:
    """Count the models on all labelled rows but a hash sample of at most about ``CALIBRATION_ROWS`` or a third, which calibrates.

    Without both classes in that sample every score is the share of toxic labels.
    """
    rows = staged(labelled(docs, labels, "toxic"), "toxicity-train", compression="zstd")
    share = min(1 / 3, CALIBRATION_ROWS / max(1, rows.count()))
    chosen = F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(1 << 20)) < int(share * (1 << 20))
    model = train_model(rows.where(~chosen).select("y", "text"))
    counted = rows.groupBy("y", chosen.alias("chosen")).count().collect()
    base = sum(r["count"] for r in counted if r["y"] == 1) / max(1, sum(r["count"] for r in counted))
    if sum(r["chosen"] for r in counted) < 2:
        return Scorer(model, np.zeros(N_FEATURES), np.ones(N_FEATURES), np.append(np.zeros(N_FEATURES), np.log((base + 1e-3) / (1 - base + 1e-3))))
    names = [f"f{i}" for i in range(N_FEATURES)]

    def run(rows, llr):
        f = np.array([features(x) for x in llr]).reshape(-1, N_FEATURES)
        return pa.table([pa.compute.struct_field(rows["row"], "y"), *(pa.array(f[:, i]) for i in range(N_FEATURES))], ["y", *names])

    found = with_llr(rows.where(chosen).select("y", "text"), model, run, "y int, " + ", ".join(f"{n} double" for n in names), "toxicity-calibration")
    sample = found.orderBy("y", *names).toPandas().to_numpy(float)
    x, y = sample[:, 1:], sample[:, 0]
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    return Scorer(model, mean, scale, logistic((x - mean) / scale, y))


def score(docs: DataFrame, scorer: Scorer, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs``; ``predicted`` is 1 from ``threshold`` on.

    A null or empty text, or one without letters, has no likelihood in either
    model and gets the calibration's value at no evidence.  Null doc_ids count
    as held out; repeated rows keep their rows; other columns are ignored.
    Very long texts are scored whole, in slices of few bytes with others.
    """
    send = scorer.sendable()

    def run(rows, llr):
        return pa.table([pa.compute.struct_field(rows["row"], "doc_id"), pa.array([send.score(features(x)) for x in llr], pa.float64())], ["doc_id", "score"])

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = with_llr(own, scorer.model, run, "doc_id long, score double", "toxicity-rows")
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, scorer: Scorer, threshold: float = 0.3) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more; its columns as they are, whatever their names."""
    send = scorer.sendable()

    def run(rows, llr):
        return rows.filter(pa.array([send.score(features(x)) < threshold for x in llr], pa.bool_()))

    schema = StructType([StructField("row", docs.schema)])
    kept = with_llr(docs, scorer.model, run, schema, "toxicity-rows")
    return kept.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
