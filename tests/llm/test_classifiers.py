"""Held-out accuracy and edge rows of the three trained operators."""

import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from cardpulse.llm import language, quality, toxicity
from cardpulse.llm.queries import QUERIES
from tests.conftest import SF01

DOCS = "doc_id long, text string, lang string, source string, score double, features string"
EDGE = [(900001, None, None, None, 1.0, "x"), (900002, "", "en", "s", None, None), (900003, " \n\t ", "xx", None, 0.0, ""), (900004, "12 34 !!", None, "s", 0.0, ""),
        (None, "no id here", "en", None, 0.0, ""), (900005, "word " * 200_000, "en", "s", 0.0, ""), (900005, "word " * 200_000, "en", "s", 0.0, "")]
SF1 = "/root/testdata/sf0.1"


def make_docs(spark, n=500):
    rnd = random.Random(4)
    base = [f"{a}{b}" for a in ("ta", "lo", "mi", "ra") for b in ("ne", "so", "ku", "vi", "po")]
    rows, labels = [], []
    for i in range(n):
        toxic, good = rnd.random() < .3, rnd.random() < .6
        own = [rnd.choice(base) for _ in range(rnd.randrange(20, 90))]
        if toxic:
            for _ in range(4):
                own[rnd.randrange(len(own))] = "grub" + rnd.choice(["el", "os", "in", "um", "at"])
        text = " ".join(own) if good else " | ".join(w.upper() for w in own)
        rows.append((i, text, "xx", "s", 0.0, "clash"))
        labels.append((i, int(good), int(toxic)))
    labels += [(5, None, None), (None, 1, 1), (7, labels[7][1], labels[7][2])]
    return spark.createDataFrame(rows + EDGE, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), labels


def accuracy(got, labels, index, only_held_out=True):
    label = {r[0]: r[index] for r in labels if r[index] is not None}
    pairs = [(r.predicted, label[r.doc_id]) for r in got if r.doc_id in label and (r.held_out or not only_held_out)]
    return np.mean([a == b for a, b in pairs]), len(pairs)


def check_edges(got, n):
    assert len(got) == n + len(EDGE)
    assert all(0.0 <= r.score <= 1.0 for r in got)
    assert sum(r.doc_id == 900005 for r in got) == 2 and sum(r.doc_id is None and r.held_out for r in got) == 1


@pytest.mark.parametrize("module, index", [(quality, 1), (toxicity, 2)])
def test_held_out_accuracy_and_edges(spark, module, index):
    docs, labels, listed = make_docs(spark)
    got = module.score(docs, module.train(docs, labels)).collect()
    check_edges(got, 500)
    right, n = accuracy(got, listed, index)
    assert n > 80 and right > 0.9


@pytest.mark.parametrize("module", [quality, toxicity])
def test_labels_of_the_held_out_fold_are_not_read(spark, module):
    docs, labels, _ = make_docs(spark, 200)
    flipped = labels.selectExpr("doc_id", "case when crc32(cast(cast(doc_id as string) as binary)) % 4 = 2 then 1 - quality else quality end quality",
                                "case when crc32(cast(cast(doc_id as string) as binary)) % 4 = 2 then 1 - toxic else toxic end toxic")
    scores = [sorted((r.doc_id or 0, round(r.score, 9)) for r in module.score(docs, module.train(docs, x)).collect()) for x in (labels, flipped)]
    assert scores[0] == scores[1]


@pytest.mark.parametrize("module", [quality, toxicity])
def test_no_labels_and_empty_tables(spark, module):
    docs, labels, _ = make_docs(spark, 30)
    check_edges(module.score(docs, module.train(docs, labels.limit(0))).collect(), 30)
    none = module.train(docs.limit(0), labels.limit(0))
    assert module.score(docs.limit(0), none).count() == 0


def test_factorisation_machine_equals_all_pairs():
    rng = np.random.default_rng(1)
    size = quality.N_STATS + quality.BUCKETS
    m = quality.Machine(0.3, rng.normal(size=size), rng.normal(size=(size, quality.RANK)), np.zeros(quality.N_STATS), np.ones(quality.N_STATS))
    at, x = m.vector("Some words, SOME repeated words | 12\nmore words")
    pairs = sum(m.factors[at[i]] @ m.factors[at[j]] * x[i] * x[j] for i in range(len(at)) for j in range(i))
    assert np.isclose(m.raw(at, x), 0.3 + m.linear[at] @ x + pairs)


def plain_kneser_ney(rows):
    """The models by dictionaries over all rows, word by word."""
    raw = [defaultdict(int), defaultdict(int)]
    for y, text in rows:
        for w in toxicity.words(text):
            s = f"^{w}$"
            for i in range(1, len(s)):
                for n in range(1, min(toxicity.ORDER, i + 1) + 1):
                    raw[y][s[i - n + 1:i + 1]] += 1
    grams = set(raw[0]) | set(raw[1])
    left = defaultdict(set)
    for g in grams:
        if len(g) > 1:
            left[g[1:]].add(g)
    count = [{}, {}]
    for g in grams:
        whole = g[0] == "^" or len(g) == toxicity.ORDER
        for y in (0, 1):
            if len(g) <= toxicity.SHARED:
                count[y][g] = raw[0][g] + raw[1][g] if whole else len(left[g])
            else:
                count[y][g] = raw[y][g] if whole else sum(raw[y][x] > 0 for x in left[g])
    after = defaultdict(list)
    for g in grams:
        after[g[:-1]].append(g)

    def p(y, g):
        lower = p(y, g[1:]) if len(g) > 1 else toxicity.UNIFORM
        total = sum(count[y][x] for x in after[g[:-1]])
        if not total:
            return lower
        kept = sum(max(count[y][x] - toxicity.DISCOUNT, 0) for x in after[g[:-1]])
        return max(count[y].get(g, 0) - toxicity.DISCOUNT, 0) / total + (1 - kept / total) * lower

    def llr(w):
        s = f"^{w}$"
        ends = [s[max(0, i - toxicity.ORDER + 1):i + 1] for i in range(1, len(s))]
        return sum(math.log(p(1, g)) - math.log(p(0, g)) for g in ends)

    return llr


def test_kneser_ney_against_brute_force(spark):
    rnd = random.Random(8)
    parts = ["ba", "no", "re", "Ti", "éo", "ßu", "x"]
    rows = [(y, " ".join("".join(rnd.choices(parts, k=rnd.randrange(1, 5))) + ("grub" if y and rnd.random() < .2 else "") for _ in range(25))) for y in [0, 0, 1] * 25]
    model = toxicity.train_model(spark.createDataFrame(rows, "y int, text string"))
    llr = plain_kneser_ney(rows)
    units = list({w for _, text in rows for w in toxicity.words(text)})[:150] + ["unseen", "grubba", "b", "日本", "x" * 300]
    assert np.allclose(model.token_llr(units), [llr(w) for w in units], rtol=0, atol=1e-9)
    assert model.rest is None and model.token_llr(["nogrub"])[0] > 2 > model.token_llr(["nobare"])[0]


def test_joined_entries_score_as_sent_ones(spark):
    """A rare gram keeps its own counts, however few entries are sent."""
    docs, labels, listed = make_docs(spark, 200)
    docs = docs.withColumnRenamed("features", "block").withColumnRenamed("score", "row")
    rows = toxicity.labelled(docs, labels, "toxic").select("y", "text").cache()
    fixed = np.zeros(toxicity.N_FEATURES), np.ones(toxicity.N_FEATURES), np.append(np.ones(toxicity.N_FEATURES) / 4, 0.0)
    scorers = [toxicity.Scorer(toxicity.train_model(rows, most), *fixed) for most in (0, 100, 10**6)]
    assert [s.model.rest is None for s in scorers] == [False, False, True] and 0 < len(scorers[1].model.head.name) <= 100
    scores = [{(r.doc_id, round(r.score, 9)) for r in toxicity.score(docs, s).collect()} for s in scorers]
    assert len(scores[0]) > 200 and scores[1] == scores[0] and scores[2] == scores[0]
    kept = [toxicity.without_toxic(docs, s, 0.6) for s in scorers[1:]]
    assert kept[0].schema == docs.schema and sorted(r.doc_id or 0 for r in kept[0].collect()) == sorted(r.doc_id or 0 for r in kept[1].collect())


def test_every_labelled_row_beyond_the_calibration_sample_is_counted(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "CALIBRATION_ROWS", 20)
    fold = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 3]
    rows = [(i, "plain words here" + (" zzyx" if i in fold else "")) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i in fold)) for i in range(400)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels).model
    assert model.head.places(toxicity.spelled(["zzyx"]).names[5][-1:])[0] < len(model.head.name) and model.token_llr(["zzyx"])[0] > 3


def test_toxic_rows_go_and_columns_stay(spark):
    docs, labels, listed = make_docs(spark)
    kept = toxicity.without_toxic(docs, toxicity.train(docs, labels))
    assert kept.schema == docs.schema
    ids = {r.doc_id for r in kept.collect()}
    clean = [r[0] for r in listed if r[2] == 0]
    toxic = [r[0] for r in listed if r[2] == 1 and r[0] is not None]
    assert np.mean([i in ids for i in clean]) > 0.95 and np.mean([i in ids for i in toxic]) < 0.1


def test_queries_on_the_given_tables(spark):
    docs = spark.read.parquet(f"{SF1}/documents.parquet")
    labels = [tuple(r) for r in spark.read.parquet(f"{SF1}/labels.parquet").collect()]
    for name, index, least in (("op2_fm_quality", 1, 0.98), ("op6_kneser_ney_toxicity", 2, 0.92)):
        got = QUERIES[name](spark, SF1).collect()
        assert len(got) == docs.count()
        right, n = accuracy(got, labels, index)
        assert n > 900 and right > least, (name, right)


def test_language_on_the_given_tables(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    got = QUERIES["op10_string_kernel_language"](spark, SF01).collect()
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in got if r.held_out]) > 0.97


def test_language_edges(spark):
    rnd = random.Random(2)
    rows = [(i, " ".join(rnd.choice(["der", "und", "schein", "über"] if i % 2 else ["the", "and", "shine", "over"]) for _ in range(30)), "de" if i % 2 else "en", "s", 0.0, "") for i in range(80)]
    docs = spark.createDataFrame(rows + EDGE, DOCS)
    got = language.predict(docs, language.train(docs)).collect()
    check_edges(got, 80)
    assert {r.lang_pred for r in got if r.doc_id in (900001, 900002, 900003, 900004)} == {"und"}
    assert np.mean([r.lang_pred == ("de" if r.doc_id % 2 else "en") for r in got if r.doc_id is not None and r.doc_id < 80]) > 0.95
    untrained = language.predict(docs, language.train(docs.limit(0))).collect()
    assert {r.lang_pred for r in untrained} == {"und"}
    assert language.predict(docs.limit(0), language.train(docs)).count() == 0


def grams(text):
    raw = b" " + text.encode() + b" "
    return {raw[i:i + n] for n in range(1, language.GRAMS + 1) for i in range(len(raw) - n + 1)}


def test_presence_kernel_counts_shared_ngrams():
    a, b = "the shining", "then shine"
    x, y = language.spectrum(a), language.spectrum(b)
    # hashing may merge a few n-grams
    root = math.sqrt(len(grams(a)) * len(grams(b)))
    assert abs(x @ y * root - len(grams(a) & grams(b))) <= 1.1 and abs(x @ x - 1) < 1e-5
    long = language.spectrum("ab cd " * 400_000)
    assert 0.99 < long @ language.spectrum("ab cd " * 30) < 1.01


def test_ridge_on_landmarks_equals_plain_algebra():
    rnd = random.Random(8)
    own = {"de": ["der", "und", "schein", "wald"], "en": ["the", "and", "shine", "wood"], "fr": ["le", "et", "brille", "bois"]}
    rows = [(" ".join(rnd.choice(words + ["xyz"]) for _ in range(rnd.randrange(6, 30))), lang) for lang, words in own.items() for _ in range(12 + len(lang) * len(words[0]))]
    texts, langs = zip(*rows)
    kernel = language.fit(list(texts), list(langs), landmarks=5)
    # the kernel matrices by sets of hashed n-grams, the ridge by stacked least squares
    bucket = {g: ((sum((c + 1) * 257 ** (len(g) - 1 - i) for i, c in enumerate(g)) * 0x9E3779B97F4A7C15) % 2**64) >> 51 for t in texts for g in grams(t)}
    sets = [{bucket[g] for g in grams(t)} for t in texts]
    k = lambda a, b: len(a & b) / math.sqrt(len(a) * len(b))
    marks = [i for name in sorted(own) for i in [j for j, lang in enumerate(langs) if lang == name][:5]]
    among = np.array([[k(sets[i], sets[j]) for j in marks] for i in marks])
    between = np.array([[k(s, sets[j]) for j in marks] for s in sets])
    value, vector = np.linalg.eigh(among)
    z = between @ vector @ np.diag(value ** -0.5) @ vector.T
    root = np.sqrt([1 / langs.count(lang) for lang in langs])[:, None]
    left = np.vstack([np.hstack([z, np.ones((len(z), 1))]) * root, np.hstack([math.sqrt(language.RIDGE) * np.eye(len(marks)), np.zeros((len(marks), 1))])])
    for at, name in enumerate(sorted(own)):
        y = np.array([[1.0 if lang == name else -1.0] for lang in langs])
        solved = np.linalg.lstsq(left, np.vstack([y * root, np.zeros((len(marks), 1))]), rcond=None)[0]
        want = (z @ solved[:-1] + solved[-1])[:, 0]
        got = kernel.values(list(texts)) @ kernel.weights[:, at] + kernel.bias[at]
        assert np.allclose(got, want, atol=2e-3)


def test_language_of_very_long_texts(spark):
    rnd = random.Random(6)
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    kernel = language.train(docs)
    rows = docs.select("doc_id", "lang", "text").collect()
    for lang in sorted({r.lang for r in rows}):
        own = [w for r in rows if r.lang == lang and zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for w in r.text.split()]
        words = rnd.choices(own, k=1_000_000 // 5)
        mixed = [w if rnd.random() > 1 / 3 else "".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=rnd.randrange(4, 10))) for w in words]
        long, noisy = " ".join(words), " ".join(mixed)
        assert len(noisy) > 1_000_000
        assert [n for n, _ in kernel.predict([long, noisy, long[:200_000], noisy[:200_000]])] == [lang] * 4, lang


def test_quality_fits_on_all_words_of_long_texts(spark):
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(4000)]
    rows, labels = [], []
    for i in range(120):
        own = words[:]
        rnd.shuffle(own)
        # one of 4,001 words tells the classes apart
        rows.append((i, " ".join(own + ["goodword" if i % 2 else "badword"]), "xx", "s", 0.0, ""))
        labels.append((i, i % 2, 0))
    docs = spark.createDataFrame(rows, DOCS)
    machine = quality.train(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    good, bad = (quality.N_STATS + quality.hashed_words(w)[0] for w in ("goodword", "badword"))
    assert machine.linear[good] > 0 > machine.linear[bad]
