"""I-Match document fingerprints over randomised lexicons (native).

A text's terms are its distinct lower-cased letter and digit runs.  The
lexicon keeps terms inside a band of inverse document frequency; as a text
has D distinct terms on average, at most ``D / LOW`` terms can reach the lower
document frequency ``LOW * N``, whatever N.  ``SUBSETS`` random parts of the
lexicon are drawn at several rates.  For each part the text's terms in it are
sorted and hashed: the fingerprint is the list of these hashes.  A small edit
changes the terms of the dense parts but leaves some of the sparse parts
alone, so the likeness of two fingerprints is the share of equal hashes among
the parts in which either text has a term.

Only built-in expressions are used.  A text is exploded to its terms next to a
hash join with the lexicon, inside one partitioning by document; the edit
needs the beginning of the next document, which is sent to it (a quarter of
the text at most), not the whole neighbour.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardpulse.llm.common import staged

#: Document-frequency band of the lexicon, as shares of all documents.
LOW, HIGH = 0.001, 0.1
#: Rates 2^-r of the lexicon parts.
RATES = (3,) * 4 + (4,) * 6 + (5,) * 8 + (6,) * 8 + (7,) * 8 + (8,) * 8 + (10,) * 6
SUBSETS = len(RATES)
#: The lexicon is sent to every task up to so many terms; a larger one is joined by shuffle.
LEXICON_BROADCAST = 2_000_000
SEED = 17

_TERM_BREAK = r"[^\p{L}\p{N}]+"
_KEY = ["id", "tie"]


def _terms(text: Column) -> Column:
    return F.array_remove(F.array_distinct(F.split(F.lower(text), _TERM_BREAK)), "")


def _base(docs: DataFrame) -> DataFrame:
    """(no_id, id, tie, text): null texts are empty; (id, tie) names a document, equal rows share it."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    return own.select(F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.xxhash64("text", F.col("doc_id").isNull()).alias("tie"), "text")


def lexicon(docs: DataFrame, low: float = LOW, high: float = HIGH) -> DataFrame:
    """(term, parts): hashed terms whose document frequency lies in the band; bit k of ``parts`` is set if part k has the term.

    The empty term, in no part, marks every text.
    """
    base = _base(docs)
    found = base.select(F.explode(_terms(F.col("text"))).alias("t")).select(F.xxhash64("t").alias("term"))
    counts = found.groupBy("term").agg(F.count("*").alias("n"))
    n = docs.count()
    parts = F.lit(0).cast("long")
    for k, rate in enumerate(RATES):
        inside = F.pmod(F.xxhash64(F.lit(SEED + k), F.col("term")), F.lit(1 << rate)) == 0
        parts = parts.bitwiseOR(F.when(inside, F.lit(1 << k)).otherwise(F.lit(0)))
    band = counts.where((F.col("n") >= max(2.0, low * n)) & (F.col("n") <= max(2.0, high * n)))
    # written before the parts are drawn: else their filter would move below the count, to every word
    band = staged(band.select("term"), "imatch-band")
    mark = docs.sparkSession.range(1).select(F.xxhash64(F.lit("")).alias("term"), F.lit(0).cast("long").alias("parts"))
    return staged(band.select("term", parts.alias("parts")).where("parts <> 0").unionByName(mark), "imatch-lexicon")


def _chain(base: DataFrame) -> DataFrame:
    """(id, tie, no_id, n, copies, next_id, next_tie) by ascending doc_id, the last followed by the first.

    Ranges of ids are chained inside themselves; the first document of each
    range, one row per range, links them.
    """
    keys = base.groupBy("no_id", *_KEY).agg(F.max(F.length("text")).alias("n"), F.count("*").alias("copies"))
    rank = (~F.col("no_id")).cast("int").alias("rank")
    ranged = keys.select(rank, *keys.columns).repartitionByRange("rank", *_KEY)
    ranged = staged(ranged.withColumn("range", F.spark_partition_id()), "imatch-order")
    entry = F.struct("rank", *_KEY)
    firsts = ranged.groupBy("range").agg(F.min(entry).alias("first"))
    ordered = Window.orderBy("range")
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    firsts = firsts.select("range", F.coalesce(F.lead("first").over(ordered), F.first("first").over(whole)).alias("after"))
    within = Window.partitionBy("range").orderBy("rank", *_KEY)
    chained = ranged.withColumn("next", F.lead(entry).over(within)).join(firsts, "range")
    following = F.coalesce("next", "after")
    return chained.select(*keys.columns, following["id"].alias("next_id"), following["tie"].alias("next_tie"))


def _in_part(k: int):
    return lambda term: term["parts"].bitwiseAND(F.lit(1 << k)) != 0


def _signature(terms: Column) -> Column:
    """One hash per lexicon part of the sorted terms in it; 0 for a part without a term."""
    nothing = F.lit(None).cast("int")
    kind = "array<struct<term:bigint,parts:bigint>>"
    own = []
    for k in range(SUBSETS):
        inside = F.filter(terms, _in_part(k))
        hashed = F.hash(F.lit(k), inside)
        own.append(F.coalesce(F.nullif(hashed, F.hash(F.lit(k), F.array().cast(kind))), nothing))
    return F.transform(F.array(*own), lambda x: F.coalesce(x, F.lit(0)))


def likeness(a: Column, b: Column, a_text: Column, b_text: Column) -> Column:
    """Share of equal hashes among the parts either has; without any, whether the texts' own hashes are equal."""
    both = F.arrays_zip(a.alias("a"), b.alias("b"))
    same = F.size(F.filter(both, lambda x: (x["a"] == x["b"]) & (x["a"] != 0)))
    any_ = F.size(F.filter(both, lambda x: (x["a"] != 0) | (x["b"] != 0)))
    return F.when(any_ > 0, same / any_).otherwise((a_text == b_text).cast("double"))


def _hex(signature: Column, text_hash: Column) -> Column:
    """Eight digits per part; a text without a lexicon term is named by its own hash."""
    digits = F.transform(signature, lambda x: F.lpad(F.lower(F.hex(x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0"))
    own = F.when(F.exists(signature, lambda x: x != 0), F.lit("")).otherwise(F.lpad(F.lower(F.hex(text_hash)), 16, "0"))
    return F.concat(F.concat_ws("", digits), own)


def fingerprints(docs: DataFrame, low: float = LOW, high: float = HIGH) -> DataFrame:
    """Per row of ``docs``: (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    The edited text has its last floor(n_chars / 4) code points replaced by
    the first as many of the next document's text, by ascending doc_id, the
    last followed by the first.  A null text is empty; null doc_ids come
    first; texts under one doc_id follow each other by hash; rows equal in id
    and text count as one document and repeat its result.  A lone document is
    its own next.  Other columns are ignored; an empty table gives no rows.
    """
    base = _base(docs)
    words = lexicon(docs, low, high)
    if words.count() <= LEXICON_BROADCAST:
        words = F.broadcast(words)
    chain = staged(_chain(base), "imatch-chain")
    texts = base.select(*_KEY, "text").dropDuplicates(_KEY)
    link = chain.select(F.col("next_id").alias("id"), F.col("next_tie").alias("tie"), F.col("id").alias("to_id"), F.col("tie").alias("to_tie"), F.floor(F.col("n") / 4).cast("int").alias("k"))
    sent = texts.join(link, _KEY).select(F.col("to_id").alias("id"), F.col("to_tie").alias("tie"), "k", F.expr("substring(text, 1, k)").alias("piece"))
    edited = F.concat(F.expr("substring(text, 1, length(text) - k)"), F.col("piece"))
    pairs = texts.join(sent, _KEY).select(*_KEY, "text", edited.alias("edited"))
    both = pairs.select(*_KEY, F.sha2("edited", 256).alias("sha"), F.xxhash64("text").alias("text_hash"), F.xxhash64("edited").alias("edited_hash"),
                        F.explode(F.array(F.struct(F.lit(0).alias("which"), F.col("text").alias("t")), F.struct(F.lit(1).alias("which"), F.col("edited").alias("t")))).alias("x"))
    carried = [*_KEY, "sha", "text_hash", "edited_hash"]
    exploded = both.select(*carried, F.col("x.which").alias("which"), F.explode(F.array_append(_terms(F.col("x.t")), F.lit(""))).alias("t"))
    inside = exploded.select(*carried, "which", F.xxhash64("t").alias("term")).join(words, "term")

    def of(which: int) -> Column:
        return F.array_sort(F.collect_list(F.when((F.col("which") == which) & (F.col("parts") != 0), F.struct("term", "parts"))))

    grouped = inside.groupBy(*_KEY).agg(*[F.first(c).alias(c) for c in carried[2:]], of(0).alias("own"), of(1).alias("changed"))
    prints = staged(grouped.select(*carried, _signature(F.col("own")).alias("own"), _signature(F.col("changed")).alias("changed")), "imatch-prints")
    after = prints.select(F.col("id").alias("next_id"), F.col("tie").alias("next_tie"), F.col("own").alias("next_own"), F.col("text_hash").alias("next_hash"))
    found = chain.join(prints, _KEY).join(after, ["next_id", "next_tie"])
    return found.select(
        F.when(~F.col("no_id"), F.col("id")).alias("doc_id"), F.col("n").cast("long").alias("n_chars"), F.col("sha").alias("edited_sha256"),
        _hex(F.col("own"), F.col("text_hash")).alias("fingerprint"), _hex(F.col("changed"), F.col("edited_hash")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed"), F.col("text_hash"), F.col("edited_hash")).alias("near_edited"),
        likeness(F.col("own"), F.col("next_own"), F.col("text_hash"), F.col("next_hash")).alias("near_next"), "copies",
    ).withColumn("copy", F.explode(F.expr("sequence(1L, copies)"))).drop("copies", "copy")
