"""Exact top-k inner-product search with multi-resolution segment statistics.

Every vector is cut into 1, 2, 4, ... segments and keeps the mean and the
standard deviation of each.  For a segment of length n

    |q - x|^2 >= n ((mean_q - mean_x)^2 + (dev_q - dev_x)^2)

and, as |q - x|^2 = |q|^2 + |x|^2 - 2 <q, x>, a lower bound of the distance is
an upper bound of the score: <q, x> <= sum n (mean_q mean_x + dev_q dev_x).
For a block of queries the bounds are taken coarse to fine; a candidate whose
bound lies under a query's k-th best score so far is discarded, and only
survivors get their exact integer score.  Finer levels can only sharpen the
bound, so the result is exact.

Queries go out in blocks of ``QUERY_BLOCK``, a fixed bound; each block is one
pass over all vectors in which a task keeps k candidates per query.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardpulse.llm.common import arrow_map, staged

SCALE = 256
K = 5
QUERY_BLOCK = 4096
#: Queries bounded together, so that a candidate is dropped when none of them needs it.
QUERY_STRIP = 32
CANDIDATE_STRIP = 2048
#: Inner products of integers under this are exact in double precision.
EXACT = float(1 << 53)
#: No candidate yet.
NONE = np.iinfo(np.int64).min


def quantised(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(vec_id, v array<double>): floor(256 x), a whole number, of every usable row.

    A null id, a null vector, or one with a null or non-finite component takes
    no part.  Doubles from 2^53 on are whole numbers themselves; a product
    beyond the largest double becomes that double.
    """
    largest = F.lit(sys.float_info.max)

    def scaled(e):
        y = F.greatest(-largest, F.least(largest, e.cast("double") * SCALE))
        return F.when(F.abs(y) < EXACT, F.floor(y).cast("double")).otherwise(y)

    x = F.transform(F.col(vector_column), scaled)
    fine = F.forall(F.col(vector_column), lambda e: F.coalesce(F.abs(e.cast("double")) < float("inf"), F.lit(False)))
    return vectors.where(F.col(id_column).isNotNull() & F.coalesce(fine, F.lit(False))).select(F.col(id_column).cast("long").alias("vec_id"), x.alias("v"))


def levels(dim: int) -> list[np.ndarray]:
    """Segment bounds from one segment to about four components each."""
    out, n = [], 1
    while n == 1 or dim // n >= 4:
        out.append(np.unique(np.linspace(0, dim, n + 1).astype(int)))
        n *= 2
    return out


def summary(x: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Root-length-weighted means and deviations per segment, side by side: the inner product of two summaries bounds the score."""
    width = np.diff(bounds)
    mean = np.add.reduceat(x, bounds[:-1], axis=1) / width
    square = np.add.reduceat(x * x, bounds[:-1], axis=1) / width
    dev = np.sqrt(np.maximum(square - mean * mean, 0.0))
    return np.concatenate([mean, dev], 1) * np.sqrt(np.concatenate([width, width]))


class Search:
    """Running k best candidates of a block of queries of one dimension."""

    def __init__(self, ids: np.ndarray, q: np.ndarray, k: int):
        # queries of like size share a strip, so that few of them leave double precision
        order = np.argsort(np.abs(q).max(axis=1, initial=0), kind="stable")
        self.ids, self.q, self.k = ids[order], q[order].astype(float), k
        self.levels = levels(q.shape[1]) if q.shape[1] else []
        with np.errstate(over="ignore", invalid="ignore"):  # bounds of queries beyond EXACT are not used
            self.stats = [summary(self.q, b) for b in self.levels]
        self.scores = np.full((len(q), k), NONE)
        self.found = np.full((len(q), k), np.iinfo(np.int64).max)
        self.exact = 0

    def offer(self, ids: np.ndarray, x: np.ndarray) -> None:
        x = x.astype(float)
        if not x.shape[1]:
            for i in range(len(self.q)):
                self._keep(i, ids[ids != self.ids[i]], np.zeros(int((ids != self.ids[i]).sum()), np.int64))
            return
        size = np.abs(x).max(axis=1)
        plain = np.flatnonzero(size < EXACT)
        stats = [summary(x[plain], b) for b in self.levels]
        for at in range(0, len(self.q), QUERY_STRIP):
            strip = slice(at, at + QUERY_STRIP)
            most = max(np.abs(self.q[strip]).max(), 1.0) * x.shape[1]
            small = np.maximum(size, 1.0) < EXACT / most
            if small.all():
                self._bounded(strip, ids, x, stats)
                continue
            if small.any():
                own = small[plain]
                self._bounded(strip, ids[small], x[small], [t[own] for t in stats])
            for j in np.flatnonzero(~small):
                self._long(strip, ids[j], x[j])

    def _bounded(self, strip: slice, ids: np.ndarray, x: np.ndarray, stats: list[np.ndarray]) -> None:
        """Candidates whose products with the strip's queries are exact in double precision."""
        # the bounds are rounded; scores are integers
        slack = 0.5 + 1e-9 * float(np.abs(stats[0]).max(initial=0) * np.abs(self.stats[0][strip]).max(initial=0))
        worst = self.scores[strip, -1][:, None]
        alive = np.arange(len(x))
        for mine, theirs in zip(self.stats, stats):
            need = mine[strip] @ theirs[alive].T + slack >= worst
            alive, need = alive[need.any(0)], need[:, need.any(0)]
            if not len(alive):
                return
        need &= ids[alive][None] != self.ids[strip][:, None]
        score = (self.q[strip] @ x[alive].T).astype(np.int64)
        self.exact += int(need.sum())
        better = need & (score >= worst)
        for i in np.flatnonzero(better.any(1)):
            self._keep(strip.start + i, ids[alive][better[i]], score[i][better[i]])

    def _long(self, strip: slice, vec_id: int, x: np.ndarray) -> None:
        """One candidate in integers of any size; a score that no long holds ends at a long's limit."""
        whole = [int(c) for c in x]
        for i in range(strip.start, min(strip.stop, len(self.q))):
            if vec_id == self.ids[i]:
                continue
            self.exact += 1
            score = sum(a * int(b) for a, b in zip(whole, self.q[i]))
            score = min(max(score, NONE + 1), np.iinfo(np.int64).max)
            if score >= self.scores[i, -1]:
                self._keep(i, np.array([vec_id]), np.array([score], np.int64))

    def _keep(self, i: int, ids: np.ndarray, scores: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores[i], scores]), np.concatenate([self.found[i], ids])
        best = np.lexsort((ids, ~scores))[:self.k]
        self.scores[i], self.found[i] = scores[best], ids[best]

    def rows(self):
        i, j = np.nonzero(self.scores != NONE)
        return self.ids[i], self.found[i, j], self.scores[i, j]


def _block_hits(vectors: DataFrame, queries: dict[int, tuple[np.ndarray, np.ndarray]], k: int) -> DataFrame:
    """The k best of each task for a block of queries, {dimension: (ids, vectors)}."""
    shared = vectors.sparkSession.sparkContext.broadcast(queries)  # at most QUERY_BLOCK vectors

    def run(batches):
        search = {dim: Search(ids, q, k) for dim, (ids, q) in shared.value.items()}
        for b in batches:
            ids, lists = b.column(0).to_numpy(), b.column(1)
            bounds = lists.offsets.to_numpy()
            values = lists.values.to_numpy(zero_copy_only=False)
            dims = np.diff(bounds)
            for dim in set(dims.tolist()) & search.keys():
                rows = np.flatnonzero(dims == dim)
                for at in range(0, len(rows), CANDIDATE_STRIP):
                    own = rows[at:at + CANDIDATE_STRIP]
                    search[dim].offer(ids[own], values[bounds[own][:, None] + np.arange(dim)[None]])
        for s in search.values():
            q, v, score = s.rows()
            yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(v), pa.array(score)], ["query_id", "vec_id", "score"])

    return arrow_map(vectors, run, "query_id long, vec_id long, score long")


def top_k(vectors: DataFrame, every: int = 50, k: int = K, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best rows for each row whose vec_id is divisible by ``every``.

    Candidates are all usable rows with another vec_id and as many components;
    ties go to the smaller vec_id.  Rows that share a vec_id are one item: as
    a query it is asked once, with the first of its vectors, and as candidates
    each row counts.  Scores beyond double precision are taken in integers of
    any size; one that no long holds ends at a long's limit.  An empty vector scores 0 against empty ones.  An empty
    table gives no rows.
    """
    spark = vectors.sparkSession
    usable = staged(quantised(vectors), "topk-vectors")
    asked = staged(usable.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v")), "topk-queries")
    blocks = max(1, -(-asked.count() // query_block))
    cuts = asked.approxQuantile("vec_id", [i / blocks for i in range(1, blocks)], 0.01 / blocks) if blocks > 1 else []
    bounds = [None, *sorted(set(int(c) for c in cuts)), None]
    hits = []
    for low, high in zip(bounds, bounds[1:]):
        own = asked.where((F.col("vec_id") > low) if low is not None else F.lit(True)).where((F.col("vec_id") <= high) if high is not None else F.lit(True))
        rows = own.toPandas()  # about ``query_block`` rows
        if not len(rows):
            continue
        dims = rows["v"].map(len)
        queries = {int(d): (rows["vec_id"][dims == d].to_numpy(np.int64), np.array(rows["v"][dims == d].tolist(), float).reshape(int((dims == d).sum()), int(d))) for d in set(dims)}
        hits.append(staged(_block_hits(usable, queries, k), "topk-hits"))
    if not hits:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    found = hits[0]
    for h in hits[1:]:
        found = found.unionByName(h)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
