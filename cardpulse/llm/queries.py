"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cardpulse.llm import conversations, fingerprints, language, lexical, line_dedup, mixing, packing, pii, quality, simhash, token_files, topk, toxicity
from cardpulse.llm.common import table
from cardpulse.session import ensure_checkpoint_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_checkpoint_dir(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return fn


@query
def op9_simhash_near_dedup(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op4_pii_anchor_expansion(spark, sf_dir):
    return pii.scan(table(spark, sf_dir, "documents"))


@query
def op8_pareto_mixing(spark, sf_dir):
    return mixing.mixed_sizes(table(spark, sf_dir, "documents"))


@query
def op5_orc_token_ids(spark, sf_dir):
    return token_files.encoded_index(table(spark, sf_dir, "documents"))


@query
def op7_pattern_packing(spark, sf_dir):
    return packing.packed(table(spark, sf_dir, "documents"))


@query
def op6_kneser_ney_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


@query
def op2_fm_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


@query
def op10_string_kernel_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return language.predict(docs, language.train(docs))


@query
def op1_segment_topk(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"))


SQL["op1_segment_topk"] = """
WITH usable AS (
    SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), pairs AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
    FROM usable q JOIN usable c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 50 = 0
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM pairs
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query
def op3_imatch_fingerprints(spark, sf_dir):
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


@query
def op11_line_dedup(spark, sf_dir):
    return line_dedup.line_dedup(table(spark, sf_dir, "documents"))


SQL["op11_line_dedup"] = r"""
WITH line AS (
    SELECT doc_id, generate_subscripts(own, 1) AS pos, unnest(own) AS line
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS own FROM documents)
), keyed AS (
    SELECT doc_id, pos, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM line
), shared AS (
    SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
    SELECT k.doc_id, k.pos, k.line, s.key IS NOT NULL AND k.doc_id <> s.keeper AS gone FROM keyed k LEFT JOIN shared s ON k.key = s.key
)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query
def op13_block_max_maxscore(spark, sf_dir):
    return lexical.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL["op13_block_max_maxscore"] = r"""
WITH doc_term AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x{00}-\x{2F}\x{3A}-\x{40}\x{5B}-\x{60}\x{7B}-\x{7F}]+')) AS term
    FROM documents
), posting AS (
    SELECT doc_id, term, count(*) AS tf FROM doc_term GROUP BY ALL
), doc AS (
    SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM posting GROUP BY doc_id
), total AS (
    SELECT count(*) AS all_docs, CAST(sum(n) AS BIGINT) AS all_terms FROM doc
), weight AS (
    SELECT term, CAST(floor(1000 * ln((2 * all_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w
    FROM (SELECT term, count(*) AS df FROM posting GROUP BY term), total
), asked AS (
    SELECT item_id, term, count(*) AS times
    FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                    '[^\x{00}-\x{2F}\x{3A}-\x{40}\x{5B}-\x{60}\x{7B}-\x{7F}]+')) AS term FROM benchmark)
    GROUP BY ALL
), scored AS (
    SELECT a.item_id, p.doc_id, CAST(sum(a.times * w.w * ((1000000000 * p.tf) // (1000 * p.tf + 12 * (75 + (25 * d.n * t.all_docs) // t.all_terms)))) AS BIGINT) AS score
    FROM asked a JOIN weight w ON a.term = w.term JOIN posting p ON p.term = a.term JOIN doc d ON d.doc_id = p.doc_id, total t
    GROUP BY ALL
), ranked AS (
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
    FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""


@query
def op12_conversation_repair(spark, sf_dir):
    return conversations.damaged_and_repaired(table(spark, sf_dir, "conversations"))
