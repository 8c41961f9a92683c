import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from cardpulse.llm import packing, token_files, tokens
from cardpulse.session import shared_path

SCHEMA = "doc_id long, text string, source string, start long, ids string"


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def encode(plain, text):
    return np.array(plain.encode(text or "", add_special_tokens=False).ids, "<u4")


def make_rows():
    rnd = random.Random(2)
    words = ["Alpha", "beta,", "été", "x", "日本", "12", "3.5", "it's", "<|endoftext|>", "q!!"]
    texts = [None, "", " ", "\n", "one", "tab\tbed  two", " lead", "trail ", "a\n\nb\n c", " nbsp "]
    texts += [" ".join(rnd.choice(words) for _ in range(rnd.choice([3, 40, 700, 1500]))) for _ in range(60)]
    texts += [" ".join(rnd.choice(words) + str(i % 977) for i in range(60_000))]
    rows = [(i * 7 % 997, t, None if i % 3 else "s", -1, "clash") for i, t in enumerate(texts)]
    return rows + [rows[15], rows[15], (rows[15][0], "another text", "s", 0, "c"), (None, "no id", None, None, None)]


def test_encoder_equals_the_library(plain, monkeypatch):
    rnd = random.Random(1)
    parts = ["a", "B1", " ", "  ", "\n", "\n ", "é", "'s", "!!", "<|endoftext|>", "日", "\t", "　", "7", " ", " word", " word", "\nLine", " "]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randrange(14))) for _ in range(6000)]
    monkeypatch.setattr(tokens, "CACHE_CHUNKS", 50)  # generations change often
    e = tokens.Encoder(public_tokenizers.path(tokens.VOCABULARY))
    for i in range(0, len(texts), 37):
        for t, got in zip(texts[i:i + 37], e.ids(texts[i:i + 37])):
            assert got == encode(plain, t).tobytes(), repr(t)


def test_token_files_round_trip(spark, plain):
    rows = make_rows()
    df = spark.createDataFrame(rows, SCHEMA)
    path = shared_path(spark, "test", "orc")
    token_files.write_token_files(df, path)
    files = token_files.read_token_files(spark, path)
    back = sorted((repr(r.doc_id), list(r.ids)) for r in files.collect())
    assert back == sorted((repr(r[0]), [*encode(plain, r[1]).tolist(), 0]) for r in rows)
    order = [r.doc_id if r.doc_id is not None else -1 for r in sorted(files.collect(), key=lambda r: (r.block, r.at))]
    assert order == sorted(order)
    got = sorted(token_files.token_index(files).collect(), key=lambda r: r.start)
    assert [-1 if r.doc_id is None else r.doc_id for r in got] == order
    at, want = 0, defaultdict(list)
    for r in rows:
        want[r[0]].append([*encode(plain, r[1]).tolist(), 0])
    for r in got:
        assert r.start == at
        at += r.n_tokens
        ids = next(x for x in want[r.doc_id] if zlib.crc32(np.array(x, "<u4").tobytes()) == r.ids_crc32 and len(x) == r.n_tokens)
        want[r.doc_id].remove(ids)
    assert not any(want.values())


def test_files_carry_bloom_filters_and_prune(spark):
    df = spark.createDataFrame(make_rows(), SCHEMA)
    path = shared_path(spark, "test", "orc")
    token_files.write_token_files(df, path)
    plan = token_files.read_token_files(spark, path).where("doc_id = 42")._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,42)]" in plan


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert token_files.encoded_index(empty).count() == 0
    assert packing.packed(empty).count() == 0


def test_packing_is_gapless_and_whole(spark, plain):
    rows = make_rows()
    df = spark.createDataFrame(rows, SCHEMA)
    got = packing.packed(df).collect()
    bins, docs = defaultdict(list), defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
        docs[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 1024
    want = defaultdict(list)
    for r in rows:
        ids = np.append(encode(plain, r[1]), 2).astype("<u4")
        first = len(ids) % 1024 or min(len(ids), 1024)
        for k, at in enumerate([0, *range(first, len(ids), 1024)]):
            n = first if k == 0 else 1024
            want[r[0]].append((k, at, n, zlib.crc32(ids[at:at + n].tobytes())))
    assert {k: sorted(v) for k, v in docs.items()} == {k: sorted(v) for k, v in want.items()}
    total = sum(r.length for r in got)
    assert len(bins) <= -(-total // 1024) * 1.05 + 2


def test_sequences_hold_the_ids(spark, plain):
    rows = make_rows()[:40]
    got = packing.sequences(spark.createDataFrame(rows, SCHEMA)).collect()
    ids = np.concatenate([np.frombuffer(bytes(r.ids), "<u4") for r in got])
    want = np.concatenate([np.append(encode(plain, r[1]), 2) for r in rows])
    assert np.array_equal(np.sort(ids), np.sort(want)) and all(len(r.ids) <= 4096 for r in got)


@pytest.mark.parametrize("lengths", [[700] * 100 + [300] * 90 + [24] * 50, [1] * 5000, [513] * 7, [1024] * 3, list(range(1, 1024)), [341, 341, 342] * 9])
def test_plan_covers_the_histogram(lengths):
    h = np.bincount(lengths, minlength=1025)
    seen = np.zeros(1025, int)
    planned = packing.plan(h)
    for p, times in planned:
        assert sum(p) <= 1024 and times > 0
        for n in p:
            seen[n] += times
    assert (seen == h).all()
    bound = max(-(-sum(lengths) // 1024), sum(n > 512 for n in lengths))
    assert sum(t for _, t in planned) <= bound * 1.02 + 1


def fewest(lengths, capacity):
    """The fewest sequences, by trying every filling of the next one."""
    best = {(): 0}

    def go(left):
        if left not in best:
            first, rest = left[0], left[1:]
            found = {()}
            for n in rest:
                found |= {tuple(sorted((*f, n), reverse=True)) for f in found if first + sum(f) + n <= capacity}
            options = []
            for f in found:
                own = list(rest)
                try:
                    for n in f:
                        own.remove(n)
                except ValueError:
                    continue
                options.append(1 + go(tuple(own)))
            best[left] = min(options)
        return best[left]

    return go(tuple(sorted(lengths, reverse=True)))


def test_plan_against_the_optimum():
    rnd = random.Random(9)
    extra = 0
    for _ in range(40):
        lengths = [rnd.randrange(1, 33) for _ in range(rnd.randrange(1, 11))]
        planned = packing.plan(np.bincount(lengths, minlength=33))
        extra += sum(t for _, t in planned) - fewest(lengths, 32)
        assert sorted(n for p, t in planned for n in p * t) == sorted(lengths)
    assert 0 <= extra <= 2


def test_fitted_patterns_without_exact_sums():
    h = np.zeros(1025, int)
    h[[300, 350, 410]] = 1000
    assert sum(t for _, t in packing.plan(h)) <= 1130


def test_memory_of_chunks_is_arrays():
    m = tokens._Memory()
    assert m.add(pa.array(["ab", "c"]), np.array([5, 6, 7], "<u4"), np.array([2, 1])).tolist() == [0, 1]
    assert m.add(pa.array(["", "d"]), np.array([9], "<u4"), np.array([0, 1])).tolist() == [2, 3]
    assert m.find(pa.array(["d", "x", "ab", ""])).tolist() == [3, -1, 0, 2]
    ids, size = m.ids(np.array([3, 0, 2, 1, 0]))
    assert ids.tolist() == [9, 5, 6, 7, 5, 6] and size.tolist() == [1, 2, 0, 1, 2]


def test_memory_is_bounded_in_bytes(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_BYTES", 400)
    e = tokens.Encoder(public_tokenizers.path(tokens.VOCABULARY))
    texts = [f"w{i} common\nnext{i}. " + "long" * i for i in range(60)] + [None, "", " ", "<|x"]
    want = e._encode([t or "" for t in texts])
    assert [x for i in range(0, len(texts), 5) for x in e.ids(texts[i : i + 5])] == want
    assert 0 < len(e._known) + len(e._old) < 100                                # of some 180
    assert e.ids(pa.array(texts, pa.large_string())) == want
