import hashlib
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from cardpulse.llm import fingerprints as fp
from cardpulse.session import ensure_checkpoint_dir

SCHEMA = "doc_id long, text string, source string, n_chars long, term string"


def make_rows():
    rnd = random.Random(8)
    vocabulary = [f"wort{i}" for i in range(400)]
    rows = [(i * 5 % 307, " ".join(rnd.choice(vocabulary) for _ in range(rnd.randrange(1, 120))) + ", Éß日!", "s", -1, "clash") for i in range(200)]
    return rows + [(400, None, None, None, None), (401, "", "s", 0, ""), (402, "ab", "s", 2, ""), (403, "%% --", "s", 2, ""), (None, "no id wort1 wort2 wort3 wort4", "s", 1, ""),
                   (rows[3][0], "another text under this id wort7", "s", 1, ""), (404, rows[9][1], "s", 0, "copy"), (500, " ".join(vocabulary * 300), "s", 0, ""), rows[4], rows[4]]


def test_contract_on_edge_rows(spark):
    rows = make_rows()
    got = fp.fingerprints(spark.createDataFrame(rows, SCHEMA), low=0.01, high=0.9).collect()
    assert len(got) == len(rows)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    distinct = {(r[0], r[1] or "") for r in rows}
    plain = sorted((d, t) for d, t in distinct if d is not None and sum(x[0] == d for x in distinct) == 1)
    texts = {}
    for d, t in distinct:
        texts.setdefault(d, []).append(t)
    order = [None, *sorted(d for d in texts if d is not None)]
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append(r)
    for d, t in plain:
        after = order[(order.index(d) + 1) % len(order)]
        if len(texts[after]) > 1:
            continue
        k = len(t) // 4
        edited = t[:len(t) - k] + texts[after][0][:k]
        for r in by_id[d]:
            assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest(), d
    copies = [r.fingerprint for r in got if r.doc_id in (rows[9][0], 404)]
    assert len(copies) == 2 and len(set(copies)) == 1
    assert len(by_id[rows[4][0]]) == 3 and len(set(by_id[rows[4][0]])) == 1
    assert sum(r.near_edited > r.near_next for r in got) > 0.9 * len(got)


def test_signatures_equal_a_plain_computation(spark):
    rows = make_rows()[:60]
    df = spark.createDataFrame(rows, SCHEMA)
    lexicon = {r.term: r.parts for r in fp.lexicon(df, 0.02, 0.5).collect()}
    terms = [set(t for t in re.split(r"[^\w]+|_+", (r[1] or "").lower()) if t) for r in rows]
    df_count = Counter(t for own in terms for t in own)
    hashed = {r.t: r.h for r in spark.createDataFrame([(t,) for t in [*df_count, ""]], "t string").select("t", F.xxhash64("t").alias("h")).collect()}
    low, high = max(2.0, 0.02 * len(rows)), max(2.0, 0.5 * len(rows))
    in_band = {hashed[t] for t, n in df_count.items() if low <= n <= high}
    assert set(lexicon) - {hashed[""]} <= in_band and lexicon[hashed[""]] == 0
    got = {r.doc_id: r for r in fp.fingerprints(df, 0.02, 0.5).collect()}
    parts_of = {}
    for r, own in zip(rows, terms):
        ids = sorted(hashed[t] for t in own if hashed[t] in lexicon)
        parts_of[r[0]] = tuple(tuple(i for i in ids if lexicon[i] >> k & 1) for k in range(fp.SUBSETS))
        digits = got[r[0]].fingerprint[:8 * fp.SUBSETS]
        for k, inside in enumerate(parts_of[r[0]]):
            assert (digits[8 * k:8 * k + 8] == "0" * 8) == (not inside)
    order = sorted(parts_of)
    for d, after in zip(order, order[1:] + order[:1]):
        a, b = parts_of[d], parts_of[after]
        either = sum(bool(x or y) for x, y in zip(a, b))
        if either:
            assert abs(got[d].near_next - sum(x == y != () for x, y in zip(a, b)) / either) < 1e-9


def test_lone_and_empty(spark):
    ensure_checkpoint_dir(spark)
    alone = fp.fingerprints(spark.createDataFrame([(1, "abcdefgh", "s", 1, "")], SCHEMA)).collect()
    assert [r.edited_sha256 for r in alone] == [hashlib.sha256(b"abcdefab").hexdigest()] and alone[0].near_next == 1.0
    assert fp.fingerprints(spark.createDataFrame([], SCHEMA)).count() == 0


def test_main_path_is_native(spark):
    plan = fp.fingerprints(spark.createDataFrame(make_rows(), SCHEMA))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
