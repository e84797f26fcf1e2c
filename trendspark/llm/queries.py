"""Registered queries of the training-data operators, one per operator, each
over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trendspark.llm.common import table
from trendspark.llm import conversations
from trendspark.llm import decontaminate as templates
from trendspark.llm import hard_negatives
from trendspark.llm import sentencepiece
from trendspark.llm import substring_dedup
from trendspark.llm.line_dedup import line_dedup
from trendspark.llm.lm_score import lm_scores
from trendspark.llm.near_dedup import near_duplicates
from trendspark.llm.quality import quality
from trendspark.llm.token_counts import token_counts
from trendspark.llm.token_file import token_digest
from trendspark.llm.topk import top_k
from trendspark.llm.toxicity import toxicity


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_tokens, n_byte_tokens, round_trip)"""
    return sentencepiece.digest(table(spark, sf_dir, "documents"), file="piece_bpe_32k.model")


def op3_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digest(table(spark, sf_dir, "documents"), file="byte_bpe_50k.json", end_id=2)


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, lines_removed, text) after line dedup."""
    return line_dedup(table(spark, sf_dir, "documents")).select("doc_id", "lines_removed", "text")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), file="word_bpe_49k.json")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, contaminated, items)"""
    found = templates.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "contaminated", "items")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.structure_digest(table(spark, sf_dir, "conversations"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"), label=hard_negatives.shifted_label())


def op13_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeats_digest(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_token_id_output": op3_token_id_output,
    "op4_minhash_near_dedup": op4_minhash_near_dedup,
    "op5_quality": op5_quality,
    "op6_line_dedup": op6_line_dedup,
    "op7_toxicity": op7_toxicity,
    "op8_exact_top_k": op8_exact_top_k,
    "op9_token_counts": op9_token_counts,
    "op10_decontamination": op10_decontamination,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_suffix_array_dedup": op13_suffix_array_dedup,
}

ORACLE: dict[str, str] = {
    "op4_minhash_near_dedup": r"""
        WITH RECURSIVE w AS (
          SELECT doc_id, [x FOR x IN string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                          'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') IF x <> ''] AS w FROM documents
        ), s AS (
          SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]
                                              WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS sh FROM w
        ), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
        ), shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY ALL
        ), link AS (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)
        ), sym AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link
        ), reach AS (SELECT DISTINCT a, a AS b FROM sym UNION SELECT r.a, y.b FROM reach r JOIN sym y ON y.a = r.b
        ), comp AS (SELECT a, min(b) AS c FROM reach GROUP BY a)
        SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(comp.c, w.doc_id) AS component_id,
               w.doc_id = coalesce(comp.c, w.doc_id) AS kept
        FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN comp ON comp.a = w.doc_id""",
    "op8_exact_top_k": """
        WITH v AS (
          SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
          FROM embeddings
          WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
            AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        ), pairs AS (
          SELECT q.vec_id AS query_id, c.vec_id,
                 CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
          FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
        ), ranked AS (
          SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
          FROM pairs
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20""",
    "op10_decontamination": templates.oracle(),
    "op11_conversation_repair": conversations.oracle(),
    "op12_hard_negatives": hard_negatives.ORACLE,
    "op13_suffix_array_dedup": substring_dedup.oracle(),
}
