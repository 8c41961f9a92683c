import random

import pytest

import corpus_pipeline
from cardpulse.llm import packing, pii
from cardpulse.session import shared_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def tables(spark):
    from cardpulse.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    rnd = random.Random(6)
    base = [f"{a}{b}" for a in ("ta", "lo", "mi", "ra") for b in ("ne", "so", "ku", "vi", "po")]
    rows, labels = [], []
    for i in range(400):
        own = [rnd.choice(base) + rnd.choice(base) for _ in range(rnd.randrange(20, 200))]
        toxic = rnd.random() < .3
        if toxic:
            for _ in range(6):
                own[rnd.randrange(len(own))] = "grub" + rnd.choice(["el", "os", "in"])
        if i % 7 == 0:
            own.insert(3, f"user{i}@mail.example.org")
        rows.append((i, " ".join(own), "xx", f"s{i % 3}" if i % 11 else None, None))
        labels.append((i, 1, int(toxic)))
    clean = [r for r, y in zip(rows, labels) if not y[2]]
    rows += [(1000 + i, r[1], "xx", "s0", 5) for i, r in enumerate(clean[:30])] + [clean[0], clean[0], (None, "lone row without id", None, None, None), (2000, None, None, "s1", 0), (2001, "", None, "s1", 0)]
    sf = shared_path(spark, "test", "sf")
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    return sf, rows, labels


def test_stages_take_effect(spark, tables):
    sf, rows, labels = tables
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["toxicity", "simhash_near_dedup", "pii", "mixing", "packing"]

    clean = steps["toxicity"](spark, docs, sf).cache()
    assert clean.columns == docs.columns
    ids = {r.doc_id for r in clean.collect()}
    assert sum(y == 0 and i not in ids for i, _, y in labels) <= 5 and sum(y == 1 and i in ids for i, _, y in labels) <= 10

    single = steps["simhash_near_dedup"](spark, clean, sf).cache()
    assert single.columns == docs.columns
    left = [r.doc_id for r in single.collect()]
    assert len(left) == len(set(left)) and not any(i is not None and 1000 <= i < 1030 for i in left)
    assert len({r.text or "" for r in single.collect()}) == len(left)

    masked = steps["pii"](spark, single, sf).cache()
    assert masked.columns == docs.columns and masked.count() == single.count()
    assert all(not pii.find(r.text, pii.automaton()) for r in masked.collect())

    mixed = steps["mixing"](spark, masked, sf).cache()
    assert mixed.columns == docs.columns
    copies = {}
    for r in mixed.collect():
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
    assert max(copies.values()) <= 3
    words = lambda df: sum(len((r.text or "").split()) for r in df.collect())
    assert abs(words(mixed) - words(masked)) < 0.05 * words(masked)

    packed = steps["packing"](spark, mixed, sf).collect()
    assert {r.doc_id for r in packed} == set(copies)
    assert len({(r.sequence_id, r.offset) for r in packed}) == len(packed) and all(r.offset + r.length <= packing.CAPACITY for r in packed)


def test_run_equals_the_stages_in_turn(spark, tables):
    sf = tables[0]
    got = corpus_pipeline.run(spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
    key = ("doc_id", "piece", "start", "length", "ids_crc32")
    rows = lambda df: sorted(map(repr, df.select(*key).collect()))
    assert rows(got) == rows(docs)


def test_empty_tables(spark, tables):
    sf = shared_path(spark, "test", "empty")
    spark.read.parquet(f"{tables[0]}/documents.parquet").limit(0).write.parquet(f"{sf}/documents.parquet")
    spark.read.parquet(f"{tables[0]}/labels.parquet").limit(0).write.parquet(f"{sf}/labels.parquet")
    assert corpus_pipeline.run(spark, sf).count() == 0
