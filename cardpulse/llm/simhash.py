"""SimHash near-duplicate detection with pivot distance tables.

Every text gets a 64-bit SimHash over word shingles.  Distinct fingerprints
are compared through *pivot distance tables*: the Hamming distances from a
fingerprint to fixed reference fingerprints.

* ``PIVOT_BITS``-wide block references: 32 references, each setting one pair
  of bits.  With the distance to the zero reference, ``d(x, 0) - d(x, r_b)``
  is a coordinate in {-2, 0, 2} that a differing bit moves only in its own
  block.  The 32 coordinates form four groups of eight; a pair within two
  bits leaves at least two groups untouched, so equality on one of the six
  group pairs is a lossless candidate key.
* ``REFERENCES``: dense references.  By the triangle inequality a pair within
  ``max_bits`` differs by at most ``max_bits`` in each coordinate, so a larger
  maximum coordinate difference discards it before verification.
* Survivors are verified on the fingerprints themselves.

A candidate bucket holding more than ``bucket_limit`` fingerprints is not
joined.  Its fingerprints get the 120 keys of the single-bit references
(sixteen blocks of four bits, fourteen of them equal): such a bucket has at
most 2^8 distinct fingerprints whatever the data.  No pair is lost.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardpulse.llm.common import arrow_map, staged
from cardpulse.llm.components import connected_components

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
BUCKET_LIMIT = 256

_BLOCK = 1 << 16  # shingles whose bits are counted at once


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


#: Dense references: XXH64 of their number, a fixed and reproducible choice.
REFERENCES = [_signed(xxhash.xxh64_intdigest(f"reference {i}", SEED)) for i in range(8)]


def simhash(text: str | None, words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """Unsigned 64-bit SimHash; 0 for a null text or one without words."""
    w = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not w:
        return 0
    n = max(1, len(w) - words + 1)
    h = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, n, _BLOCK):
        stop = min(n, at + _BLOCK)
        if len(w) < words:
            codes = [h(b" ".join(w), seed)]
        else:
            codes = [h(b" ".join(s), seed) for s in zip(*(w[at + i:stop + i] for i in range(words)))]
        bits = np.array(codes, np.uint64).view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(bits, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS, keys: dict[str, Column] | None = None) -> DataFrame:
    """(doc_id, *keys, fp) per row of ``docs``; fp is the SimHash as a signed long, ``keys`` are further longs."""
    keys = keys or {}
    names = ["doc_id", *keys]

    def run(batches):
        for b in batches:
            fps = np.fromiter((simhash(t.as_py(), words) for t in b.column(0)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(fps.view(np.int64))], [*names, "fp"])

    own = docs.select(F.col("text").cast("string").alias("text"), F.col("doc_id").cast("long").alias("doc_id"), *[c.alias(k) for k, c in keys.items()])
    return arrow_map(own, run, "".join(f"{k} long, " for k in names) + "fp long")


def _distance(fp: Column, reference: int) -> Column:
    return F.bit_count(fp.bitwiseXOR(F.lit(reference)))


def pivot_table(fps: DataFrame) -> DataFrame:
    """fps (fp) -> (fp, g0..g3, coords): block coordinates packed by group, dense coordinates one byte each."""
    fp = F.col("fp")
    base = _distance(fp, 0)
    groups = []
    for g in range(4):
        packed = F.lit(0).cast("long")
        for b in range(8):
            # 0, 1 or 2 bits of the block are set
            near = ((base - _distance(fp, _signed(3 << (16 * g + 2 * b))) + 2) / 2).cast("long")
            packed = packed + near * F.lit(1 << (2 * b))
        groups.append(packed.alias(f"g{g}"))
    coords = reduce(lambda a, x: a + x, (F.shiftleft(_distance(fp, r).cast("long"), 7 * i) for i, r in enumerate(REFERENCES)))
    return fps.select("fp", *groups, coords.alias("coords"))


def _close(max_bits: int) -> Column:
    """Maximum coordinate difference first, then the exact distance."""
    gap = [F.abs(F.shiftright(F.col("x.coords"), 7 * i).bitwiseAND(F.lit(127)) - F.shiftright(F.col("y.coords"), 7 * i).bitwiseAND(F.lit(127)))
           for i in range(len(REFERENCES))]
    return (F.greatest(*gap) <= max_bits) & (F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp"))) <= max_bits)


def _bucket_pairs(keyed: DataFrame, max_bits: int) -> DataFrame:
    x, y = keyed.alias("x"), keyed.alias("y")
    same = (F.col("x.key") == F.col("y.key")) & (F.col("x.part") == F.col("y.part"))
    return x.join(y, same & (F.col("x.fp") < F.col("y.fp")) & _close(max_bits)).select(F.col("x.fp").alias("u"), F.col("y.fp").alias("v"))


def near_pairs(fps: DataFrame, max_bits: int = MAX_BITS, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """All pairs (u < v) of distinct fingerprints at most ``max_bits`` (0 to 2) bits apart."""
    if not 0 <= max_bits <= 2:
        raise ValueError("the group keys are lossless for at most two differing bits")
    pivots = pivot_table(fps)
    parts = [F.struct(F.lit(i).cast("int").alias("part"), (F.shiftleft(F.col(f"g{a}"), 16) + F.col(f"g{b}")).alias("key"))
             for i, (a, b) in enumerate(combinations(range(4), 2))]
    keyed = staged(pivots.select("fp", "coords", F.explode(F.array(*parts)).alias("k")).select("fp", "coords", "k.part", "k.key"), "simhash-keys")
    full = keyed.groupBy("part", "key").agg(F.count("*").alias("n"))
    shared = full.where(F.col("n").between(2, bucket_limit)).select("part", "key")
    pairs = _bucket_pairs(keyed.join(shared, ["part", "key"], "left_semi"), max_bits)
    crowded = keyed.join(full.where(F.col("n") > bucket_limit).select("part", "key"), ["part", "key"], "left_semi").select("fp", "coords").distinct()
    blocks = []
    for i, (a, b) in enumerate(combinations(range(16), 2)):
        mask = ((1 << 64) - 1) ^ (15 << (4 * a)) ^ (15 << (4 * b))
        blocks.append(F.struct(F.lit(i).cast("int").alias("part"), F.col("fp").bitwiseAND(F.lit(_signed(mask))).alias("key")))
    fine = crowded.select("fp", "coords", F.explode(F.array(*blocks)).alias("k")).select("fp", "coords", "k.part", "k.key")
    return pairs.unionByName(_bucket_pairs(fine, max_bits)).distinct()


def _components(classes: DataFrame, max_bits: int, bucket_limit: int) -> DataFrame:
    """``classes`` (fp, ...) with the ``root`` of each distinct fingerprint's component."""
    roots = connected_components(near_pairs(classes.select("fp"), max_bits, bucket_limit))
    return classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def without_near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """One row of ``docs`` per component, its columns as they are: the smallest doc_id, null ids last.

    Rows that share a doc_id, or have none, are told apart by hashes of the
    whole row; only rows equal in every column are exchangeable.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    keys = {"h1": F.xxhash64(*columns), "h2": F.xxhash64(F.lit(1), *columns)}
    rows = staged(fingerprints(docs, words, keys), "simhash-rows")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h1", "h2")).alias("first")
    classes = staged(rows.groupBy("fp").agg(first), "simhash-classes")
    kept = _components(classes, max_bits, bucket_limit).groupBy("root").agg(F.min("first").alias("first"))
    kept = kept.select(F.col("first.h1").alias("h1"), F.col("first.h2").alias("h2"), F.col("first.doc_id").alias("kept_id"))
    named = docs.select(F.struct(*columns).alias("row"), F.col("doc_id").cast("long").alias("own_id"), *[c.alias(k) for k, c in keys.items()])
    same = (named["h1"] == kept["h1"]) & (named["h2"] == kept["h2"]) & named["own_id"].eqNullSafe(kept["kept_id"])
    left = named.join(kept, same, "left_semi").dropDuplicates(["own_id", "h1", "h2"])
    return left.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """One row per row of ``docs``: (doc_id, fingerprint, component_id).

    ``fingerprint`` is 16 lower-case hex digits; ``component_id`` the smallest
    doc_id reachable over links of at most ``max_bits`` bits, its own included.
    Null, empty or blank texts have fingerprint zero and are linked like any
    other; a null doc_id keeps its row and never names a component (a
    component of only null ids gets null).  Repeated rows stay repeated.
    Other columns of ``docs`` are not read.
    """
    rows = staged(fingerprints(docs, words), "simhash-docs")
    classes = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-classes")
    rooted = _components(classes, max_bits, bucket_limit)
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    class_names = rooted.join(named, "root").select("fp", "component_id")
    return rows.join(class_names, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
