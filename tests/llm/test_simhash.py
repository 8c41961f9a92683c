import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from cardpulse.llm import simhash

ROWS = "doc_id long, text string, source string, fp long, root string"


def brute_fp(text):
    w = "".join(c.lower() if c.isascii() else c for c in text or "").encode()
    words, cur = [], b""
    for c in w:
        if c == 0x20 or 9 <= c <= 13:
            if cur:
                words.append(cur)
            cur = b""
        else:
            cur += bytes([c])
    if cur:
        words.append(cur)
    if not words:
        return 0
    s = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def brute_components(fps, bits):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(fps))]


def test_query_matches_brute_force_on_edge_rows(spark):
    rnd = random.Random(5)
    base = [rnd.choice(["Alpha", "beta", "gamma", "ÉTÉ", "delta", "x"]) + str(rnd.randrange(30)) for _ in range(80)]
    texts = [None, "", " \t\n", "one", "One two", "a b c", "A B\x0bC", " ".join(base), " ".join(base).upper(), " ".join(base[:-1] + ["z"]),
             " ".join(base * 1500), "a b c", "nbsp stays one word", "\x1c odd separator"]
    texts += [" ".join(base[:k] + ["edit"] + base[k + 1:]) for k in range(0, 80, 9)]
    rows = [(i * 3 + 1, t, None if i % 4 == 0 else "s", -i, "clash") for i, t in enumerate(texts)] + [(None, "a b c", "s", 1, "r"), (22, texts[7], "s", 0, "r")]
    got = sorted(simhash.near_duplicates(spark.createDataFrame(rows, ROWS)).collect(), key=repr)
    fps = [brute_fp(r[1]) for r in rows]
    comp = brute_components(fps, 2)
    least = {c: min((r[0] for r, d in zip(rows, comp) if d == c and r[0] is not None), default=None) for c in set(comp)}
    want = sorted(((r[0], f"{f:016x}", least[c]) for r, f, c in zip(rows, fps, comp)), key=repr)
    assert [tuple(r) for r in got] == sorted(want, key=lambda t: repr(simhash_row(t)))


def simhash_row(t):
    from pyspark.sql import Row
    return Row(doc_id=t[0], fingerprint=t[1], component_id=t[2])


@pytest.mark.parametrize("limit", [4, 256])
def test_near_pairs_lose_no_link(spark, limit):
    """A ball of near fingerprints around one centre (crowded buckets) plus scattered ones."""
    rnd = random.Random(limit)
    centre = rnd.getrandbits(64)
    fps = {centre}
    while len(fps) < 160:
        x = centre
        for _ in range(rnd.randrange(1, 5)):
            x ^= 1 << rnd.randrange(64)
        fps.add(x)
    fps |= {rnd.getrandbits(64) for _ in range(100)}
    fps = sorted(simhash._signed(x) for x in fps)
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    got = {(r.u, r.v) for r in simhash.near_pairs(df, 2, limit).collect()}
    a = np.array(fps, np.int64).view(np.uint64)
    near = np.bitwise_count(a[:, None] ^ a[None, :]) <= 2
    want = {(fps[i], fps[j]) for i in range(len(fps)) for j in range(i + 1, len(fps)) if near[i, j]}
    assert got == want and len(want) > 100


def test_empty_table(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], ROWS)).count() == 0


def test_components_of_a_long_chain_and_a_hub(spark):
    from cardpulse.llm.components import connected_components
    chain = [(i, i + 1) for i in range(100, 160)]
    hub = [(1, i) for i in range(2, 60)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(chain + hub, "u long, v long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 1 for i in range(1, 60)}}


def test_pivot_coordinates_are_hamming_distances(spark):
    df = simhash.pivot_table(spark.createDataFrame([(5,), (-1,), (0,)], "fp long"))
    for r in df.select("fp", "coords").collect():
        for i, ref in enumerate(simhash.REFERENCES):
            assert r.coords >> (7 * i) & 127 == bin((r.fp ^ ref) & (2 ** 64 - 1)).count("1")
    assert df.where(F.col("fp") == -1).first().g0 == sum(2 << (2 * b) for b in range(8))


def test_one_row_of_each_component_stays(spark):
    """Rows, not ids: rows that share an id or have none stay if their texts differ."""
    schema = "doc_id long, text string, h1 string, row int"
    texts = ["one two three four five six", "quite another text with other words", "a third text that is like none"]
    rows = [(1, texts[0], "a", 1), (1, texts[1], "a", 1), (None, texts[1], "b", 2), (None, texts[2], None, 3), (None, texts[2], None, 3), (5, texts[2], "c", 4), (0, None, None, 0), (9, "", None, 0), (2, texts[0], "a", 1), (1, texts[0], "a", 1)]
    got = simhash.without_near_duplicates(spark.createDataFrame(rows, schema))
    assert got.columns == ["doc_id", "text", "h1", "row"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([(1, texts[0], "a", 1), (1, texts[1], "a", 1), (5, texts[2], "c", 4), (0, None, None, 0)], key=repr)
    assert simhash.without_near_duplicates(spark.createDataFrame([], schema)).count() == 0
