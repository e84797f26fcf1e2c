"""Corpus pipeline: documents to token ids, each stage on all that the one before kept.

toxicity -> line dedup -> near-dedup -> decontamination -> SentencePiece.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``docs``, whatever other columns it has and however
they are named.  Rows with null ids or texts, empty texts and repeated rows go
through every stage; an empty table gives an empty result.  ``run`` writes each stage's result
to the shared folder and reads it back, so a lost executor costs its stage
only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendspark.llm.common import table
from trendspark.llm.decontaminate import decontaminate
from trendspark.llm.line_dedup import line_dedup
from trendspark.llm.near_dedup import near_duplicates
from trendspark.llm.scratch import fits, written
from trendspark.llm.sentencepiece import digest
from trendspark.llm.toxicity import THRESHOLD, toxicity_scores

#: The threshold of the stage (op4's 0.85 is that query's own); a pair at 0.8 shares none of the bands with (1 - 0.8^5)^36 = 6e-7.
NEAR = {"num": 80, "den": 100, "count": 36, "rows": 5}


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold; null and empty texts are scored as texts without a letter."""
    scored = toxicity_scores(docs, table(spark, sf_dir, "labels"), keep=tuple(c for c in docs.columns if c != "doc_id"), out_col="__toxic")
    return scored.where(F.col("__toxic") < THRESHOLD).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that stand elsewhere; those that nothing is
    left of go, since each of their lines is kept in another document."""
    out = line_dedup(docs, removed_col="__gone")
    emptied = (F.col("__gone") > 0) & ~F.col("text").rlike(r"\S")
    return (out.where(~F.coalesce(emptied, F.lit(False)))
            .withColumn("n_chars", F.when(F.col("__gone") > 0, F.length("text").cast(docs.schema["n_chars"].dataType))
                        .otherwise(F.col("n_chars"))).select(*docs.columns))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: word shingles shared by 0.8 or more."""
    gone = written(near_duplicates(docs, **NEAR).where(~F.col("kept")).select("doc_id").distinct(), "near-copies")
    return docs.join(F.broadcast(gone) if fits(gone, 16) else gone, "doc_id", "left_anti").select(*docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item; those without an id, which can't be told apart, stay."""
    found = decontaminate(docs, table(spark, sf_dir, "benchmark"), items_col="__items", flag_col="__leaked")
    return found.where(~F.col("__leaked")).select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_tokens, n_byte_tokens, round_trip) of every document."""
    return digest(docs)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", lines),
    ("near_dedup", near),
    ("decontamination", benchmark),
    ("sentencepiece", encoded),
]

#: The stages' model, signatures and segmentation are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = written(docs, f"pipeline-{name}")
    return docs
