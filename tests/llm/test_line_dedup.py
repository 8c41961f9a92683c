import hashlib
import random
from collections import defaultdict

from cardpulse.llm import line_dedup

SCHEMA = "doc_id long, text string, key string, dropped int"
SPACE = " \t\n\x0b\x0c\r"
FOLD = {c: c + 32 for c in range(65, 91)}


def brute(rows):
    key = lambda line: line.strip(SPACE).translate(FOLD)
    holders = defaultdict(set)
    for doc_id, text, *_ in rows:
        for line in (text or "").split("\n"):
            holders[key(line)].add(doc_id)
    order = lambda d: (d is not None, d or 0)
    out = []
    for doc_id, text, *_ in rows:
        own = (text or "").split("\n")
        left = [x for x in own if len(key(x)) < 20 or len(holders[key(x)]) < 3 or doc_id == max(holders[key(x)], key=order)]
        out.append((doc_id, len(own), len(own) - len(left), hashlib.sha256("\n".join(left).encode()).hexdigest()))
    return sorted(out, key=repr)


def result(spark, rows):
    return sorted((tuple(r) for r in line_dedup.line_dedup(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr)


def test_against_brute_force(spark):
    rnd = random.Random(3)
    pool = [f"this line number {i} is shared" for i in range(12)] + ["short", "", "ünïcode line of twenty characters ", "exactly twenty chars", "only nineteen chars"]
    rows = []
    for i in range(150):
        own = []
        for _ in range(rnd.randrange(0, 12)):
            line = rnd.choice(pool) if rnd.random() < .6 else f"own line {rnd.random()} of {i}"
            own.append(rnd.choice(["", " ", "\t"]) + (line.upper() if rnd.random() < .3 else line) + rnd.choice(["", "\r", "\x0b "]))
        rows.append((i if rnd.random() < .95 else None, "\n".join(own), "k", i))
    rows += [(7, None, None, None), (8, "", None, None), (None, None, None, None), rows[3], rows[3], (9, "\n\n", "", 1)]
    assert result(spark, rows) == brute(rows)


def test_non_breaking_space_and_other_case_stay_apart(spark):
    rows = [(i, x, None, None) for i, x in enumerate(["É" * 20, "é" * 20, "É" * 20, " " + "É" * 20, "É" * 20])]
    assert result(spark, rows) == brute(rows)


def test_hot_line_long_text_and_empty_table(spark):
    hot = "A line that every document of this table holds"
    rows = [(i, f"{hot}\nown {i} ................", None, None) for i in range(3000)]
    rows.append((5000, "\n".join([f"long text line number {i % 70000}" for i in range(140_000)] + [hot] * 3), None, None))
    got = result(spark, rows)
    assert got == brute(rows) and sum(r[2] for r in got) == 3000
    assert result(spark, []) == []


def test_deduplicated_keeps_columns(spark):
    rows = [(i, "the same line of enough length\r\nown", f"k{i}", i) for i in range(4)] + [(9, None, "n", 0)]
    got = line_dedup.deduplicated(spark.createDataFrame(rows, SCHEMA))
    assert got.columns == ["doc_id", "text", "key", "dropped"]
    assert sorted(map(tuple, got.collect())) == [(0, "own", "k0", 0), (1, "own", "k1", 1), (2, "own", "k2", 2), (3, "the same line of enough length\r\nown", "k3", 3), (9, None, "n", 0)]
