"""Ranked lexical search with Block-Max MaxScore over shards of an inverted index.

The index is a written table.  A shard holds the postings of documents that one
task read, in ascending doc_id, at most about ``SHARD_TERMS`` term occurrences.
A term's list is cut into blocks of ``BLOCK`` postings; a block is a row of its
own with its first and last document, its highest impact, and its postings as
variable-byte document gaps and impacts.  The impact is the integer part of the
score that does not depend on the item, so a term's contribution is
``times * w * impact`` and a bound of impacts is a bound of scores.

Per shard and item, documents are taken in ascending windows.  With the current
20th best score as threshold, the lists of least global bound whose bounds
together can't lift a document over the threshold are non-essential.
Candidates come from essential lists only.  A candidate whose score so far plus
the bounds of what is left does not pass the threshold goes; then, for each
non-essential list from the greatest bound on, the maximum of the block that
would hold the candidate rejects it before that block is decompressed.  A later
document needs a higher score than the threshold, since equal scores rank by
doc_id.  The heaps of all shards are merged by one ranking.

Items go out in blocks of about ``ITEM_TERMS`` (item, term) pairs, a fixed bound;
a block is one job over the lists of its terms.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardpulse.llm.common import arrow_map, staged
from cardpulse.session import shared_path, ship_package

TOP = 20
BLOCK = 128
SHARD_TERMS = 2_000_000
#: Documents whose candidates are gathered together; the threshold rises after each window.
WINDOW = 512
ITEM_TERMS = 200_000

_TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
_FOLD = {c: c + 32 for c in range(65, 91)}
INDEX_SCHEMA = "shard long, term string, block int, first long, last long, n int, top long, postings binary"


def terms(text: str | None) -> list[str]:
    """Maximal runs of digits, letters and non-ASCII code points, A-Z lower-cased."""
    return _TERM.findall(text.translate(_FOLD)) if text else []


def _texts(rows: DataFrame, key: str) -> DataFrame:
    return rows.select(F.col(key).cast("long").alias(key), F.col("text").cast("string").alias("text"))


def corpus_size(docs: DataFrame) -> tuple[int, int]:
    """Documents with at least one term, and all terms."""
    def run(batches):
        for b in batches:
            n = [len(terms(x)) for x in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([sum(x > 0 for x in n)], pa.int64()), pa.array([sum(n)], pa.int64())], ["docs", "terms"])

    found = arrow_map(docs.select(F.col("text").cast("string").alias("text")), run, "docs long, terms long")
    row = found.agg(F.sum("docs"), F.sum("terms")).first()
    return row[0] or 0, row[1] or 0


def varbytes(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Seven bits a byte, low first, the last byte of a value without the top bit; and the length of each value."""
    size = np.ones(len(values), np.int64)
    for k in range(1, 9):
        size += values >= 1 << (7 * k)
    start = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint8)
    for k in range(int(size.max(initial=0))):
        has = size > k
        out[start[has] + k] = (values[has] >> (7 * k) & 127) | np.where(size[has] > k + 1, 128, 0)
    return out, size


def plain(data: bytes) -> np.ndarray:
    """The values of ``varbytes``."""
    raw = np.frombuffer(data, np.uint8).astype(np.int64)
    ends = np.flatnonzero(raw < 128)
    start = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    shift = 7 * (np.arange(len(raw)) - np.repeat(start, ends - start + 1))
    return np.add.reduceat((raw & 127) << shift, start) if len(ends) else raw


def impacts(tf: np.ndarray, n: np.ndarray, docs: int, all_terms: int) -> np.ndarray:
    """Integer impact of a term that occurs ``tf`` times in a document of ``n`` terms."""
    m = 100 - 25 + (25 * n.astype(np.int64) * docs) // max(all_terms, 1)
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def _shard_rows(shard: int, ids: list[int | None], own: list[list[str]], docs: int, all_terms: int) -> list[pa.RecordBatch]:
    """Index rows of a shard; document gaps count ranks in ascending doc_id, nulls last, whose ids are under the empty term."""
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))
    vocabulary: dict[str, int] = {}
    number = vocabulary.setdefault
    coded = [np.fromiter((number(t, len(vocabulary)) for t in own[i]), np.int64, len(own[i])) for i in order]
    n = np.array([len(c) for c in coded], np.int64)
    key, tf = np.unique(np.concatenate([c * len(order) + at for at, c in enumerate(coded)] or [np.zeros(0, np.int64)]), return_counts=True)
    term, doc = key // len(order), key % len(order)
    impact = impacts(tf, n[doc], docs, all_terms)
    begins = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]])) if len(term) else np.zeros(0, np.int64)
    in_list = np.arange(len(term)) - np.repeat(begins, np.diff(np.append(begins, len(term))))
    starts = np.flatnonzero(in_list % BLOCK == 0)
    ends = np.append(starts[1:], len(term))
    gap = np.where(in_list % BLOCK == 0, doc, doc - np.concatenate([[0], doc[:-1]]) if len(doc) else doc)
    data, size = varbytes(np.stack([gap, impact], 1).ravel())
    offset = np.append((np.cumsum(size) - size)[2 * starts], len(data)).astype(np.int32)
    names = pa.array(list(vocabulary), pa.string()).take(pa.array(term[starts]))
    postings = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offset.tobytes()), pa.py_buffer(data.tobytes())])
    columns = [pa.array(np.full(len(starts), shard)), names, pa.array((in_list[starts] // BLOCK).astype(np.int32)), pa.array(doc[starts]), pa.array(doc[ends - 1]),
               pa.array((ends - starts).astype(np.int32)), pa.array(np.maximum.reduceat(impact, starts) if len(starts) else impact), postings]
    fields = [f.split()[1 - 1] for f in INDEX_SCHEMA.split(", ")]
    listed = [ids[i] for i in order]
    listed = np.array([np.iinfo(np.int64).min if x is None else x for x in listed], np.int64)
    empty = [[shard], [""], [0], [0], [len(order) - 1], [len(order)], [0], [listed.tobytes()]]
    types = [c.type for c in columns]
    return [pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(empty, types)], fields), pa.RecordBatch.from_arrays(columns, fields)]


def build(docs: DataFrame, name: str = "lexical-index") -> tuple[DataFrame, int, int]:
    """The index of all ``docs`` as a written table, the number of documents with a term, and of all terms.

    Null or empty texts and texts without terms have no postings.
    """
    n_docs, n_terms = corpus_size(docs)

    def run(batches: Iterator[pa.RecordBatch]):
        part, shard = TaskContext.get().partitionId(), 0
        ids, own, held = [], [], 0
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found = terms(text)
                if not found:
                    continue
                if held and held + len(found) > SHARD_TERMS:
                    yield from _shard_rows(part << 32 | shard, ids, own, n_docs, n_terms)
                    ids, own, held, shard = [], [], 0, shard + 1
                ids.append(doc_id)
                own.append(found)
                held += len(found)
        if ids:
            yield from _shard_rows(part << 32 | shard, ids, own, n_docs, n_terms)

    return staged(arrow_map(_texts(docs, "doc_id"), run, INDEX_SCHEMA), name, compression="zstd"), n_docs, n_terms


@dataclass
class PostingList:
    """One term's blocks in a shard, decompressed on demand."""

    first: np.ndarray
    last: np.ndarray
    top: np.ndarray
    data: list[bytes]
    ready: dict[int, tuple[np.ndarray, np.ndarray]]

    def block(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        if i not in self.ready:
            values = plain(self.data[i])
            self.ready[i] = np.cumsum(values[::2]), values[1::2]
        return self.ready[i]

    def within(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents from ``lo`` to under ``hi`` and their impacts."""
        a, b = np.searchsorted(self.last, lo), np.searchsorted(self.first, hi)
        if a >= b:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        parts = [self.block(i) for i in range(a, b)]
        doc, impact = (np.concatenate(x) if len(parts) > 1 else x[0] for x in zip(*parts))
        x, y = np.searchsorted(doc, (lo, hi))
        return doc[x:y], impact[x:y]


def search(lists: list[tuple[int, PostingList]], n_docs: int, top: int = TOP, counts: dict | None = None) -> list[tuple[int, int]]:
    """The ``top`` (score, document) of a shard by Block-Max MaxScore; ``lists`` are (times * w, postings)."""
    lists = sorted(((f, p) for f, p in lists if f > 0), key=lambda x: x[0] * int(x[1].top.max()))
    factor = [f for f, _ in lists]
    bound = [f * int(p.top.max()) for f, p in lists]
    below = np.concatenate([[0], np.cumsum(bound, dtype=np.int64)])  # below[i]: all lists before i together
    heap: list[tuple[int, int]] = []
    threshold, essential = 0, 0
    for lo in range(0, n_docs, WINDOW):
        hi = min(lo + WINDOW, n_docs)
        while essential < len(lists) and below[essential + 1] <= threshold:
            essential += 1
        if essential == len(lists):
            break
        score = np.zeros(hi - lo, np.int64)
        for f, p in zip(factor[essential:], [p for _, p in lists[essential:]]):
            doc, impact = p.within(lo, hi)
            score[doc - lo] += f * impact
        doc = np.flatnonzero(score)
        doc = doc[score[doc] + below[essential] > threshold]
        for i in range(essential - 1, -1, -1):
            if not len(doc):
                break
            p = lists[i][1]
            at = np.searchsorted(p.last, doc + lo)
            here = (at < len(p.last)) & (p.first[np.minimum(at, len(p.last) - 1)] <= doc + lo)
            most = np.where(here, factor[i] * p.top[np.minimum(at, len(p.last) - 1)], 0)
            alive = score[doc] + most + below[i] > threshold
            doc, at, here = doc[alive], at[alive], here[alive]
            if counts is not None:
                counts["rejected"] = counts.get("rejected", 0) + int((~alive).sum())
            for b in np.unique(at[here]):
                docs, impact = p.block(b)
                mine = doc[here & (at == b)]
                place = np.minimum(np.searchsorted(docs, mine + lo), len(docs) - 1)
                hit = docs[place] == mine + lo
                score[mine[hit]] += factor[i] * impact[place[hit]]
            doc = doc[score[doc] + below[i] > threshold]
        for d in doc.tolist():
            entry = (int(score[d]), -(d + lo))
            if len(heap) < top:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
        if len(heap) == top:
            threshold = heap[0][0]
    if counts is not None:
        counts["blocks"] = counts.get("blocks", 0) + sum(len(p.data) for _, p in lists)
        counts["opened"] = counts.get("opened", 0) + sum(len(p.ready) for _, p in lists)
    return [(s, -d) for s, d in heap if s > 0]


def _asked(items: DataFrame) -> DataFrame:
    """(item_id, term, times); rows that share an item_id add their terms, equal rows count once."""
    def run(batches):
        for b in batches:
            out = [(i, t, c) for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for t, c in Counter(terms(text)).items()]
            columns = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.int64()))], ["item_id", "term", "times"])

    found = arrow_map(_texts(items, "item_id").distinct(), run, "item_id long, term string, times long")
    return found.groupBy("item_id", "term").agg(F.sum("times").alias("times"))


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of every item with a score above 0.

    Equal scores rank by doc_id, nulls last.  Repeated rows of ``docs`` are
    documents of their own.  A null item_id is an item; items without a known
    term have no rows.  Other columns are ignored.
    """
    spark = docs.sparkSession
    index, n_docs, _ = build(docs)
    asked = staged(_asked(items), "lexical-asked")
    known = index.join(asked.select("term").distinct(), "term", "left_semi")
    df = known.groupBy("term").agg(F.sum("n").alias("df"))
    w = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1)))
    asked = asked.join(df, "term").select("item_id", "term", (F.col("times") * w).alias("factor")).where("factor > 0")
    blocks = max(1, ceil(asked.count() / ITEM_TERMS))
    asked = staged(asked.withColumn("item_block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)).cast("int")), "lexical-weights")
    out = shared_path(spark, "llm", "lexical-heaps")
    for i in range(blocks):
        _heaps(index, asked.where(F.col("item_block") == i), top).write.mode("append").parquet(out)
    heaps = spark.read.schema("item_id long, doc_id long, score long").parquet(out)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return heaps.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


def _heaps(index: DataFrame, asked: DataFrame, top: int) -> DataFrame:
    """(item_id, doc_id, score): the heap of every shard and item of one block of items."""
    spark = index.sparkSession
    ship_package(spark)
    items: dict[int | None, list[tuple[str, int]]] = {}
    for row in asked.select("item_id", "term", "factor").toLocalIterator():  # bounded: ITEM_TERMS
        items.setdefault(row["item_id"], []).append((row["term"], row["factor"]))
    shared = spark.sparkContext.broadcast(items)
    lists = index.join(F.broadcast(asked.select("term").distinct()), "term", "left_semi").unionByName(index.where("term = ''"))

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("term", "ascending"), ("block", "ascending")]).combine_chunks()
        names = rows["term"].to_pylist()
        first, last, best = (rows[c].to_numpy() for c in ("first", "last", "top"))
        data = rows["postings"].to_pylist()
        ids = np.frombuffer(data[0], np.int64)
        cuts = [0, *(i for i in range(1, len(names)) if names[i] != names[i - 1]), len(names)]
        at = {names[a]: (a, b) for a, b in zip(cuts, cuts[1:])}
        opened: dict[str, dict] = {name: {} for name in at}  # a block is decompressed once for all items
        out = []
        for item_id, own in shared.value.items():
            mine = [(f, PostingList(first[a:b], last[a:b], best[a:b], data[a:b], opened[t])) for t, f in own if t in at for a, b in [at[t]]]
            out.extend((item_id, int(ids[d]), s) for s, d in search(mine, len(ids), top))
        columns = list(zip(*out)) if out else [(), (), ()]
        null = np.iinfo(np.int64).min
        columns[1] = [None if d == null else d for d in columns[1]]
        return pa.table([pa.array(c, pa.int64()) for c in columns], ["item_id", "doc_id", "score"])

    return lists.groupBy("shard").applyInArrow(run, "item_id long, doc_id long, score long")
