import random
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cardpulse.llm import mixing

SCHEMA = "doc_id long, text string, source string, size long, row string"


def brute_targets(size):
    names = sorted((s for s in size if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in size)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, fixed = sum(size.values()), {}
    while True:
        left, w = total - sum(fixed.values()), sum(weight[s] for s in names if s not in fixed)
        share = {s: left * weight[s] / w for s in names if s not in fixed}
        over = [s for s in share if share[s] > 3 * size[s]]
        if not over:
            return {**fixed, **share}
        fixed.update({s: 3.0 * size[s] for s in over})


def make_rows(seed, n):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        words = int(rnd.paretovariate(1.1) * 20) % 3000
        text = rnd.choice([None, "", " \t"]) if i % 40 == 0 else rnd.choice([" ", "\n", "\x0b "]).join(f"é{rnd.randrange(99)}" for _ in range(words))
        rows.append((i, text, "big" if rnd.random() < .4 else rnd.choice([None, "a", "B", "tiny", "日", "z"]), 1, "x"))
    rows += [rows[7], rows[7], (None, "null id here", "a", 1, "x"), (None, "null id here", "a", 1, "x"), (n, " ".join("w" * 1 for _ in range(4000)), "a", 1, "x")]
    return rows


@pytest.mark.parametrize("bucket_rows", [16, 4096])
def test_targets_and_taken_words(spark, bucket_rows):
    rows = make_rows(3, 900)
    df = spark.createDataFrame(rows, SCHEMA)
    got = mixing.mix(df, bucket_rows=bucket_rows).collect()
    assert len(got) == len(rows)
    size = {}
    for r in rows:
        size[r[2]] = size.get(r[2], 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    want = brute_targets(size)
    taken = dict.fromkeys(size, 0)
    for r in got:
        s = r.row.source
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", r.row.text or "")) and r.source_size == size[s]
        assert abs(r.target - want[s]) <= 1e-6 * max(1, want[s])
        assert 0 <= r.copies <= 3
        taken[s] += r.size * r.copies
    for s in size:
        assert abs(taken[s] - want[s]) <= 0.02 * want[s] + 60, (s, taken[s], want[s])
    again = mixing.mix(df.repartition(5), bucket_rows=bucket_rows).collect()
    key = lambda rs: sorted((repr(r.row), r.copies) for r in rs)
    assert key(got) == key(again)


def test_mixed_rows_keep_columns(spark):
    df = spark.createDataFrame(make_rows(5, 300), SCHEMA)
    copies = {}
    for r in mixing.mix(df).collect():
        copies[repr(r.row)] = copies.get(repr(r.row), 0) + r.copies
    out = mixing.mixed(df)
    assert out.columns == df.columns
    got = {}
    for r in out.collect():
        got[repr(r)] = got.get(repr(r), 0) + 1
    assert got == {k: v for k, v in copies.items() if v}


def test_empty_and_all_blank(spark):
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).count() == 0
    blank = spark.createDataFrame([(1, None, None, 0, ""), (2, "", "a", 0, "")], SCHEMA)
    assert {(r.size, r.target, r.copies) for r in mixing.mix(blank).collect()} == {(0, 0.0, 0)}


def test_cap_binds(spark):
    """A small source gets three copies of everything and the rest is shared again."""
    rows = [(i, "w " * 100, "huge", 0, "") for i in range(300)] + [(1000 + i, "v " * 10, "small", 0, "") for i in range(5)]
    got = mixing.mixed_sizes(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.target for r in got if r.doc_id >= 1000} == {150.0}
    assert all(r.taken == 3 * r.size for r in got if r.doc_id >= 1000)


@pytest.mark.parametrize("bucket_rows", [16, 4096])
def test_no_document_that_fits_is_left(spark, bucket_rows):
    """Whatever falls on the cut, later documents fill the words that it leaves."""
    rows = [(i, "w " * 30, "long", 0, "") for i in range(200)] + [(999, "w " * 25_000, "long", 0, "")]
    rows += [(1000 + i, "v " * (i % 97 + 3), f"s{i % 3}", 0, "") for i in range(900)]
    for seed in range(4):
        by_source = {}
        for r in mixing.mix(spark.createDataFrame(rows, SCHEMA), seed, bucket_rows).collect():
            by_source.setdefault(r.row.source, []).append(r)
        assert sum(map(len, by_source.values())) == len(rows)
        for source, got in by_source.items():
            whole = int(got[0].target // got[0].source_size)
            left = got[0].target - sum(r.size * r.copies for r in got)
            assert all(r.copies in (whole, whole + 1) for r in got)
            assert left >= -1e-6 and all(r.size > left - 1e-6 for r in got if r.copies == whole), (source, left)


def test_many_equal_rows(spark):
    """A third of a million equal rows in one source: as many as fit, dealt among them."""
    n = 300_000
    same = spark.range(n).selectExpr("cast(null as long) doc_id", "'three little words' text", "'hot' source", "0L size", "cast(id % 3 as string) row")
    other = spark.range(60_000).selectExpr("id doc_id", "concat('w ', id, ' x y z') text", "'s' source", "0L size", "'' row")
    got = mixing.mixed_sizes(same.unionByName(other)).groupBy("source_size", "target").agg({"taken": "sum"}).collect()
    assert sum(r[2] for r in got) > 0 and all(abs(r[2] - r[1]) <= 5 for r in got), got


def test_pareto_ranks_include_with_unequal_probabilities(spark):
    """The share of draws in which a document is among the least ranks is near its own p."""
    p = [0.1, 0.2, 0.4, 0.6, 0.7, 0.3, 0.5, 0.2]
    draws = 4000
    df = spark.range(draws * len(p)).selectExpr("id div 8 draw", "id % 8 i", "xxhash64(id) h")
    u = (F.shiftrightunsigned("h", 11).cast("double") + 0.5) / float(1 << 53)
    df = df.withColumn("rank", mixing.pareto_rank(u, F.get(F.array(*map(F.lit, p)), F.col("i").cast("int"))))
    df = df.withColumn("at", F.row_number().over(Window.partitionBy("draw").orderBy("rank"))).where("at <= 3")
    share = {r.i: r["count"] / draws for r in df.groupBy("i").count().collect()}
    assert all(abs(share[i] - x) < 0.03 for i, x in enumerate(p)), share
