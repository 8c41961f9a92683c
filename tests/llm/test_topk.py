import math
import random

import duckdb
import numpy as np
import pytest

from cardpulse.llm import topk
from cardpulse.llm.queries import QUERIES, SQL
from tests.conftest import SF01

SCHEMA = "vec_id long, embedding array<float>, label int, score string"


def brute(rows, every=50, k=5):
    usable = {}
    for i, v, *_ in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            usable.setdefault(i, []).append([math.floor(256 * float(np.float32(x))) for x in v])
    out = []
    for q in usable:
        if q % every == 0:
            own = min(usable[q])
            c = [(-sum(a * b for a, b in zip(own, v)), i) for i, vs in usable.items() if i != q for v in vs if len(v) == len(own)]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(c)[:k])]
    return sorted(out)


def make_rows(n, dim, seed):
    rnd = random.Random(seed)
    centres = [[rnd.gauss(0, .2) for _ in range(dim)] for _ in range(5)]
    rows = [(i, [x + rnd.gauss(0, .05) for x in rnd.choice(centres)], 0, "clash") for i in range(n)]
    rows += [(n + i, rows[100][1], 1, None) for i in range(12)]  # ties
    rows += [(n + 20, None, 0, ""), (n + 21, [None] * dim, 0, ""), (n + 22, [float("nan")] * dim, 0, ""), (n + 23, [float("inf")] + [0.0] * (dim - 1), 0, ""),
             (None, rows[3][1], 0, ""), (50, rows[50][1], 0, "same id"), (5000, [1.0, 2.0], 0, ""), (5001, [0.5, 0.5], 0, ""), (6000, [], 0, ""), (6001, [], 0, "")]
    return rows


@pytest.mark.parametrize("block", [4096, 4])
def test_equals_brute_force(spark, block):
    rows = make_rows(600, 24, 1)
    got = sorted(tuple(r) for r in topk.top_k(spark.createDataFrame(rows, SCHEMA), query_block=block).collect())
    assert got == brute(rows)


def test_pruning_discards_candidates():
    rng = np.random.default_rng(0)
    centres = rng.normal(0, 60, (20, 64))
    x = np.floor(centres[np.repeat(np.arange(20), 200)] + rng.normal(0, 6, (4000, 64)))
    s = topk.Search(np.arange(40), x[::100], 5)
    for at in range(0, 4000, 500):
        s.offer(np.arange(at, at + 500) + 100, x[at:at + 500])
    assert s.exact < 0.6 * 40 * 4000


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF01}/embeddings.parquet'")
    want = sorted(con.execute(f"SELECT query_id, rank, vec_id, score FROM ({SQL['op1_segment_topk']})").fetchall())
    got = sorted(tuple(r) for r in QUERIES["op1_segment_topk"](spark, SF01).select("query_id", "rank", "vec_id", "score").collect())
    assert got == want and len(got) == 50


def test_empty(spark):
    assert topk.top_k(spark.createDataFrame([], SCHEMA)).count() == 0


def test_large_components_are_exact(spark):
    rows = [(0, [1e6, 2.0]), (1, [3e6, 1.0]), (2, [3e6, 1.25]), (3, [-4e6, 1.0]), (50, [1e6, 3.0])]
    q = [(i, [int(256 * x) for x in v]) for i, v in rows]
    want = sorted((a, r + 1, b, s) for a, v in q if a % 50 == 0
                  for r, (s, b) in enumerate(sorted(((sum(x * y for x, y in zip(v, w)), b) for b, w in q if b != a), key=lambda t: (-t[0], t[1]))[:5]))
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted(tuple(r) for r in got) == want


def test_every_finite_component_takes_part(spark):
    rows = [(0, [1e20, 2.0, 0.0]), (1, [0.0, 1.0, 1.0]), (2, [-1e300, 1.25, 0.5]), (3, [3.0, 1e17, -1.0]), (4, [1e20, -2e20, 7.0]), (50, [0.5, 3.0, 1e300]), (51, [float("inf"), 1.0, 1.0]), (100, [0.25, 0.5, 1.0])]
    whole = [(i, [int(256 * x) for x in v]) for i, v in rows if math.isfinite(v[0])]
    clip = lambda s: max(-(2**63) + 1, min(2**63 - 1, s))
    want = sorted((a, r + 1, b, s) for a, v in whole if a % 50 == 0
                  for r, (s, b) in enumerate(sorted(((clip(sum(x * y for x, y in zip(v, w))), b) for b, w in whole if b != a), key=lambda t: (-t[0], t[1]))[:5]))
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted(tuple(r) for r in got) == want
