import heapq
import math
import random
from collections import Counter

import numpy as np

from cardpulse.llm import lexical

DOCS = "doc_id long, text string, term string, shard int"
ITEMS = "item_id long, text string, term string"


def brute(docs, items, top=20):
    own = [(d, Counter(lexical.terms(t))) for d, t in docs]
    own = [(d, c) for d, c in own if c]
    n_docs, n_terms = len(own), sum(sum(c.values()) for _, c in own)
    df = Counter(t for _, c in own for t in c)
    asked = {}
    for i, text in set(items):
        asked.setdefault(i, Counter()).update(lexical.terms(text))
    out = []
    for i, q in asked.items():
        scores = []
        for d, c in own:
            m = 100 - 25 + (25 * sum(c.values()) * n_docs) // n_terms
            s = sum(k * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 12 * m)) for t, k in q.items() if t in c)
            if s > 0:
                scores.append((-s, d is None, d if d is not None else 0))
        out += [(i, r + 1, None if null else d, -s) for r, (s, null, d) in enumerate(heapq.nsmallest(top, scores))]
    return sorted(out, key=repr)


def result(spark, docs, items):
    d = spark.createDataFrame([(*r, "x", 1) for r in docs], DOCS)
    i = spark.createDataFrame([(*r, "y") for r in items], ITEMS)
    return sorted((tuple(r) for r in lexical.ranked(d, i).collect()), key=repr)


def corpus(rnd, n):
    vocabulary = [f"w{i}" for i in range(400)]
    weights = [1 / (i + 1) for i in range(400)]
    return [(i * 3 % n if n % 3 else i, " ".join(rnd.choices(vocabulary, weights, k=rnd.randrange(0, 60)))) for i in range(n)], vocabulary


def test_terms():
    assert lexical.terms("Ab_c-9É x ÀB\x7f") == ["ab", "c", "9É x", "Àb"]
    assert lexical.terms(None) == lexical.terms("") == []


def test_varbytes_round_trip():
    v = np.array([0, 1, 127, 128, 16383, 16384, 999_999, 2**21, 2**40], np.int64)
    data, size = lexical.varbytes(v)
    assert (lexical.plain(data.tobytes()) == v).all() and size.sum() == len(data)
    assert len(lexical.plain(b"")) == 0


def test_against_brute_force(spark, monkeypatch):
    rnd = random.Random(2)
    docs, vocabulary = corpus(rnd, 1000)
    docs += [(5, docs[5][1]), (None, "w3 w4 w5 W6"), (None, "w300"), (2000, None), (2001, ""), (2002, "--- !!"), (2003, "w1 " * 60_000 + "w399")]
    items = [(i, " ".join(rnd.choices(vocabulary, k=rnd.randrange(1, 30)))) for i in range(40)]
    items += [(50, None), (51, "unknownterm"), (None, "w3 W3 w6"), items[0], (0, "w7 w8")]
    monkeypatch.setattr(lexical, "SHARD_TERMS", 3000)
    monkeypatch.setattr(lexical, "ITEM_TERMS", 100)
    assert result(spark, docs, items) == brute(docs, items)


def test_ties_and_empty_tables(spark):
    docs = [(100 - i, "same words here") for i in range(100)] + [(200 + i, "other text") for i in range(60)]
    items = [(1, "same here"), (2, "same same")]
    got = result(spark, docs, items)
    assert got == brute(docs, items) and [r[2] for r in got if r[0] == 1 and r[1] <= 3] == [1, 2, 3]
    assert result(spark, docs, []) == result(spark, [], items) == []


def test_blocks_are_rejected_without_decompression():
    rnd = random.Random(4)
    n = 20_000
    tf = {t: Counter(rnd.choices(range(n), k=k)) for t, k in (("common", 15_000), ("middle", 4_000), ("rare", 60))}
    lists = []
    for t, f in (("common", 100), ("middle", 1500), ("rare", 6000)):
        doc = np.array(sorted(tf[t]), np.int64)
        impact = lexical.impacts(np.array([tf[t][d] for d in doc.tolist()]), np.full(len(doc), 50), n, 50 * n)
        starts = range(0, len(doc), lexical.BLOCK)
        parts = [(doc[a:a + lexical.BLOCK], impact[a:a + lexical.BLOCK]) for a in starts]
        data = [lexical.varbytes(np.stack([np.diff(d, prepend=0), i], 1).ravel())[0].tobytes() for d, i in parts]
        lists.append((f, lexical.PostingList(*(np.array(x) for x in ([d[0] for d, _ in parts], [d[-1] for d, _ in parts], [i.max() for _, i in parts])), data, {})))
    counts = {}
    got = sorted(lexical.search(lists, n, 20, counts), key=lambda x: (-x[0], x[1]))
    total = np.zeros(n, np.int64)
    for f, p in lists:
        d, i = p.within(0, n)
        total[d] += f * i
    want = sorted(((int(s), d) for d, s in enumerate(total) if s), key=lambda x: (-x[0], x[1]))[:20]
    assert got == want and counts["rejected"] > 0 and counts["opened"] < counts["blocks"]
