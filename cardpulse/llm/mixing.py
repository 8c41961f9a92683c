"""Mixing sources to target weights by Pareto order sampling (native).

A source's target in words says how many copies its documents get on average:
``ratio = target / size``.  Every document gets ``floor(ratio)`` certain whole
copies; the rest, ``p = ratio - floor(ratio)``, is an inclusion probability.
Documents are ranked by random odds over inclusion odds,
``(u / (1 - u)) / (p / (1 - p))``, and the smallest are selected until their
words reach the source's share, so the sample has a fixed size in words.
Documents without words are included if ``u < p``.

A document that would overshoot is set aside, and the selection goes on behind
it until no later document fits what is left.  Rows equal in rank and size are
counted: as many as fit are taken, and only their numbers are dealt to rows, in
runs of a few thousand, so repeated rows of any number cost no more than others.

The ranking never sorts a whole source.  A source is cut into buckets of about
``BUCKET_ROWS`` documents along the ranking.  Sums of the documents that fit
tell which buckets are taken whole and in which one the words run out; only
that bucket is ordered, and the next round starts behind it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardpulse.llm.common import staged

WORD = r"[^\x20\x09-\x0D]+"
SEED = 7
BUCKET_ROWS = 4096
MAX_COPIES = 3.0


def word_count(text: Column | str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _with_draw(docs: DataFrame, seed: int) -> DataFrame:
    """(row, source, size, u, tie): the whole row as a struct, its words, and a uniform draw fixed by id and text."""
    text = F.col("text").cast("string")
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id"), text), 11).cast("double") + 0.5) / float(1 << 53)
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("source").cast("string").alias("source"),
                       word_count(text).alias("size"), u.alias("u"), tie.alias("tie"))


def targets(sources: DataFrame, cycle: int = 3, max_copies: float = MAX_COPIES) -> DataFrame:
    """sources (source, source_size) -> with ``target``.

    Weights 1..cycle repeat over the sources by code point, null last, and
    share the total; a target stops at ``max_copies`` times its size and the
    excess is shared again by weight.  The fixed point is a water level: with
    sources ordered by cap / weight, the first one whose share stays under its
    cap sets the level for itself and all after it.  One row per source: the
    windows see as many rows as there are sources.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    s = sources.withColumn("weight", ((F.row_number().over(by_name) - 1) % cycle + 1).cast("double"))
    s = s.withColumn("cap", F.col("source_size") * F.lit(max_copies)).withColumn("fill", F.col("cap") / F.col("weight"))
    ordered = Window.orderBy("fill", F.col("source").asc_nulls_last())
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = s.withColumn("level", (F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                     / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    open_level = F.min(F.when(F.col("level") < F.col("fill"), F.struct("fill", F.col("source").isNull(), "source", "level"))).over(whole)["level"]
    s = s.withColumn("open", open_level)
    return s.select("source", "source_size", "rows", F.least("cap", F.coalesce(F.col("open") * F.col("weight"), F.col("cap"))).alias("target"))


TAKEN = "array<struct<rank:double,u:double,tie:bigint,size:bigint,k:bigint>>"


def pareto_rank(u: Column, p: Column) -> Column:
    """Random odds over inclusion odds: the least ranks are a Pareto order sample with inclusion probabilities near ``p``."""
    return (u / (1 - u)) / (p / (1 - p))


def _greedy(arr: Column, left: Column) -> Column:
    """(left, taken): how many of the ``n`` equal documents of each entry, in order, still fit what is left."""
    start = F.struct(left.alias("left"), F.array().cast(TAKEN).alias("taken"))

    def step(acc, d):
        k = F.least(d["n"], F.floor(acc["left"] / d["size"]))
        entry = F.struct(d["rank"].alias("rank"), d["u"].alias("u"), d["tie"].alias("tie"), d["size"].alias("size"), k.alias("k"))
        return F.struct((acc["left"] - k * d["size"]).alias("left"), F.when(k > 0, F.concat(acc["taken"], F.array(entry))).otherwise(acc["taken"]).alias("taken"))

    return F.aggregate(arr, start, step)


def _selected(rows: DataFrame, plan: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Which documents with words fill each source's ``need`` in order of ``u``.

    (name, segments, cuts): buckets ``lo`` to ``hi`` of a segment are taken but
    for documents of more than ``most`` words; of the buckets in ``cuts`` the
    second table (name, bucket, taken) has how many of which equal documents.
    Each round passes at least one bucket of every source that is not filled;
    ``rows`` (name, bucket, size, rank, u, tie) are only summed, in one bucket a
    source by equal documents.
    """
    segment = "array<struct<lo:bigint,hi:bigint,most:double>>"
    state = plan.where("p > 0").select("name", F.col("need").alias("left"), F.lit(0).cast("long").alias("next"), F.col("buckets").cast("long").alias("buckets"),
                                       F.array().cast(segment).alias("segments"), F.array().cast("array<bigint>").alias("cuts"), F.lit(False).alias("done"))
    state, places, turn = staged(state, "mix-state-0"), None, 0
    running = Window.partitionBy("name").orderBy("bucket")
    while state.where("not done").limit(1).count():
        turn += 1
        live = state.where("not done").select(F.col("name").alias("live_name"), "left", "next")
        behind = rows.join(live, rows["name"].eqNullSafe(live["live_name"])).where("bucket >= next")
        sums = behind.where("size <= left").groupBy("name", "bucket").agg(F.sum("size").alias("words"), F.first("left").alias("left"))
        sums = sums.withColumn("upto", F.sum("words").over(running))
        cut = sums.where("upto > left").groupBy("name").agg(F.min(F.struct("bucket", (F.col("left") - F.col("upto") + F.col("words")).alias("room"))).alias("cut"))
        cut = staged(cut.select(F.col("name").alias("cut_name"), F.col("cut.bucket").alias("cut_bucket"), F.col("cut.room").alias("room")), f"mix-cut-{turn}")
        inside = rows.join(cut, rows["name"].eqNullSafe(cut["cut_name"]) & (rows["bucket"] == cut["cut_bucket"]))
        inside = inside.groupBy("name", "bucket", "rank", "u", "tie", "size").agg(F.count("*").alias("n"), F.first("room").alias("room"))
        inside = inside.groupBy("name", "bucket").agg(F.first("room").alias("room"), F.sort_array(F.collect_list(F.struct("rank", "u", "tie", "size", "n"))).alias("ds"))
        found = inside.select(F.col("name").alias("cut_name"), F.col("bucket").alias("cut_bucket"), _greedy(F.col("ds"), F.col("room")).alias("found"))
        found = staged(found.select("cut_name", "cut_bucket", F.col("found.left").alias("now"), F.col("found.taken").alias("taken")), f"mix-taken-{turn}")
        place = found.select(F.col("cut_name").alias("name"), F.col("cut_bucket").alias("bucket"), "taken")
        places = place if places is None else places.unionByName(place)
        s = state.join(found.drop("taken"), state["name"].eqNullSafe(found["cut_name"]), "left")
        whole = F.struct(F.col("next").alias("lo"), F.coalesce(F.col("cut_bucket") - 1, F.col("buckets")).alias("hi"), F.col("left").alias("most"))
        after = F.col("cut_bucket") + 1
        s = s.select(
            "name", F.coalesce("now", "left").alias("left"), F.coalesce(after, "next").alias("next"), "buckets",
            F.when(F.col("done"), F.col("segments")).otherwise(F.concat("segments", F.array(whole))).alias("segments"),
            F.when(F.col("cut_bucket").isNull(), F.col("cuts")).otherwise(F.concat("cuts", F.array("cut_bucket"))).alias("cuts"),
            (F.col("done") | F.col("cut_bucket").isNull() | (after >= F.col("buckets")) | (F.col("now") < 1)).alias("done"))
        state = staged(s, f"mix-state-{turn}")
    if places is None:
        places = rows.sparkSession.createDataFrame([], f"name string, bucket long, taken {TAKEN}")
    return state.select("name", "segments", "cuts"), places


def mix(docs: DataFrame, seed: int = SEED, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(row, size, source_size, target, copies) per row of ``docs`` (doc_id, text, source, ...).

    ``row`` is the input row, ``copies`` how often the mix takes it (0 to 3).
    A null text has no words; null sources form one source, last in order;
    repeated rows are ranked one by one; an empty table gives no rows.  The
    draw depends on id, text and seed only, so reruns agree.
    """
    drawn = _with_draw(docs, seed)
    narrow = staged(drawn.select("source", "size", "u", "tie"), "mix-sizes")
    sources = narrow.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    plan = targets(sources).withColumn("whole", F.floor(ratio).cast("int")).withColumn("p", ratio - F.floor(ratio))
    plan = plan.withColumn("need", F.col("p") * F.col("source_size")).withColumn("buckets", F.ceil(F.col("rows") / bucket_rows))
    plan = staged(plan.withColumnRenamed("source", "name"), "mix-plan")

    def planned(rows: DataFrame, plan: DataFrame) -> DataFrame:
        bucket = F.least(F.floor(F.col("u") * F.col("buckets")), F.col("buckets") - 1).cast("long")
        # the rank rises with ``u``, so buckets of ``u`` follow it
        return rows.join(plan, rows["source"].eqNullSafe(plan["name"])).withColumn("bucket", bucket).withColumn("rank", pareto_rank(F.col("u"), F.col("p")))

    ranked = planned(narrow, plan.where("p > 0").select("name", "buckets", "p")).where("size > 0").select("name", "bucket", "size", "rank", "u", "tie")
    chosen, places = _selected(ranked, plan)
    chosen = chosen.withColumnRenamed("name", "chosen_name")
    plan = staged(plan.join(chosen, plan["name"].eqNullSafe(chosen["chosen_name"]), "left").drop("chosen_name"), "mix-cuts")

    full = planned(drawn, plan)
    at_cut = F.coalesce(F.array_contains("cuts", F.col("bucket")), F.lit(False)) & (F.col("size") > 0)
    inside = F.exists("segments", lambda s: F.col("bucket").between(s["lo"], s["hi"]) & (F.col("size") <= s["most"]))
    picked = F.when(F.col("size") > 0, F.coalesce(inside, F.lit(False))).otherwise(F.col("u") < F.col("p"))
    result = ["row", "size", "source_size", "target", "copies"]
    apart = full.where(~at_cut).withColumn("copies", F.col("whole") + picked.cast("int")).select(*result)

    # equal documents are numbered in runs of consecutive rows: within a run by a window, before it by the runs' counts
    equal = ["name", "bucket", "u", "tie", "size"]
    cut = staged(full.where(at_cut).withColumn("run", F.shiftright(F.monotonically_increasing_id(), 12)).select(*equal, "run", "whole", "row", "source_size", "target"), "mix-at-cut")
    counts = cut.groupBy(*equal, "run").agg(F.count("*").alias("n"))
    counts = counts.withColumn("first", F.sum("n").over(Window.partitionBy(*equal).orderBy("run")) - F.col("n"))
    taken = places.select("name", "bucket", F.explode("taken").alias("d")).select("name", "bucket", "d.u", "d.tie", "d.size", "d.k")
    counts = counts.join(taken, [counts[c].eqNullSafe(taken[c]) for c in equal]).select(*[counts[c].alias(f"c_{c}") for c in equal], F.col("run").alias("c_run"), (F.col("k") - F.col("first")).alias("room")).where("room > 0")
    own = cut.withColumn("at", F.row_number().over(Window.partitionBy(*equal, "run").orderBy("run")))
    own = own.join(counts, [own[c].eqNullSafe(F.col(f"c_{c}")) for c in (*equal, "run")], "left")
    own = own.withColumn("copies", F.col("whole") + F.coalesce((F.col("at") <= F.col("room")).cast("int"), F.lit(0))).select(*result)
    return apart.unionByName(own)


def mixed_sizes(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """(doc_id, size, source_size, target, taken) per row of ``docs``; ``taken`` counts words with repeats."""
    m = mix(docs.select("doc_id", "text", "source"), seed)
    return m.select(F.col("row.doc_id").cast("long").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mixed(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, with its columns."""
    m = mix(docs, seed)
    repeated = m.where("copies > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    return repeated.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
