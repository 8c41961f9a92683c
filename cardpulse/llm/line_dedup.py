"""Line dedup: lines that many documents share stay in one of them only.

Lines are exploded with their position, normalised and hashed; distinct
documents are counted per hash, lines over the threshold are dropped and the
rest is joined again by position.

A line's key is the line without white space at both ends, A-Z lower-cased.
A key of at least ``MIN_LENGTH`` code points that at least ``MIN_DOCS``
documents hold loses all its lines, but for those of the largest doc_id that
holds it.

Only (row, position, hash) is shuffled to find what goes; the texts meet their
dropped positions in one join.  Counting is a two-step distinct count, partial
on both steps, so a line that a third of all documents hold is counted in many
tasks.  A key is named by two 64-bit hashes with different seeds.

Defined cases: a null or empty text is one empty line.  A null doc_id counts as
one document, smaller than all others.  Rows that share a doc_id count as one
document and keep its lines alike; equal rows stay as often as they are.  Other
columns are ignored by ``line_dedup`` and kept by ``deduplicated``.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardpulse.llm.common import staged

MIN_LENGTH, MIN_DOCS = 20, 3
SPACE = " \t\n\x0b\x0c\r"


def lines(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n", -1)


def _row_name(docs: DataFrame) -> Column:
    """Rows of equal id and text have equal lines and share a name."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return F.struct(F.col("doc_id").cast("long").alias("id"), F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2"))


def shared_lines(docs: DataFrame, min_length: int = MIN_LENGTH, min_docs: int = MIN_DOCS) -> DataFrame:
    """(row, dropped): 0-based positions of the lines that leave a row; rows that keep all are absent."""
    folded = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), ascii_uppercase, ascii_lowercase)
    every = docs.select(_row_name(docs).alias("row"), F.posexplode(F.split(folded, "\n", -1)).alias("pos", "line"))
    every = every.select("row", "pos", F.btrim("line", F.lit(SPACE)).alias("key")).where(F.char_length("key") >= min_length)
    every = every.select("row", "pos", F.xxhash64("key").alias("k1"), F.xxhash64(F.lit(1), "key").alias("k2"))
    every = staged(every.select("row.id", "row.h1", "row.h2", "pos", "k1", "k2"), "lines")
    # a null id is counted as a document of its own, under all others
    holders = every.groupBy("k1", "k2").agg(
        (F.count_distinct("id") + F.max(F.col("id").isNull().cast("int"))).alias("n_docs"), F.max("id").alias("keeper"))
    # written, so that the join shuffles both sides anew and can split a line that very many rows hold
    gone = staged(holders.where(F.col("n_docs") >= min_docs).select("k1", "k2", "keeper"), "lines-shared")
    lost = every.join(gone, ["k1", "k2"]).where(F.col("id").isNull() | (F.col("id") < F.col("keeper")))
    return lost.groupBy("id", "h1", "h2").agg(F.collect_set("pos").alias("dropped"))


def _with_dropped(docs: DataFrame, min_length: int, min_docs: int) -> DataFrame:
    """(doc, dropped) per row of ``docs``, whose columns are the struct ``doc``."""
    lost = shared_lines(docs, min_length, min_docs)
    lost = lost.select(F.struct("id", "h1", "h2").alias("lost_row"), F.col("dropped").alias("lost"))
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), _row_name(docs).alias("row"))
    # the struct compares null ids as equal
    found = named.join(lost, F.col("row").eqNullSafe(F.col("lost_row")), "left")
    return found.select("doc", F.coalesce("lost", F.array().cast("array<int>")).alias("dropped"))


def _kept(text: Column, dropped: Column) -> Column:
    own = lines(text)
    left = F.array_except(F.sequence(F.lit(0), F.size(own) - 1), dropped)
    return F.when(F.size(dropped) == 0, F.coalesce(text.cast("string"), F.lit(""))).otherwise(
        F.array_join(F.transform(left, lambda i: F.get(own, i)), "\n"))


def deduplicated(docs: DataFrame, min_length: int = MIN_LENGTH, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with its columns as they are and shared lines removed from ``text``; a null text without lines to lose stays null."""
    found = _with_dropped(docs, min_length, min_docs)
    text = F.col("doc.text")
    new = F.when(F.size("dropped") == 0, text).otherwise(_kept(text, F.col("dropped")))
    return found.select(*[new.alias("text") if c == "text" else F.col(f"doc.`{c}`").alias(c) for c in docs.columns])


def line_dedup(docs: DataFrame, min_length: int = MIN_LENGTH, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) per row of ``docs``."""
    found = _with_dropped(docs.select("doc_id", "text"), min_length, min_docs)
    text = F.col("doc.text")
    return found.select(
        F.col("doc.doc_id").alias("doc_id"), F.size(lines(text)).cast("long").alias("n_lines"), F.size("dropped").cast("long").alias("n_dropped"),
        F.sha2(F.encode(_kept(text, F.col("dropped")), "UTF-8"), 256).alias("kept_sha256"))
