"""A corpus pipeline: language, near duplicates, benchmark passages, tokens.

Each stage takes what the one before it kept, and all but the last return the columns of ``documents``.  Rows without
text or without a letter go in the first stage; an empty table stays empty through all stages; extra columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from omenflow.llm import decontamination, jaccard, language_id, tokenizer
from omenflow.llm.common import stored, table

#: A document whose pooled probability for its best language is below this is rejected.
LEAST_SCORE = 0.5
#: A row's key while a stage runs: ids may be null or repeat.
ROW = "_row"


def row_key() -> Column:
    """A hash of id and text, never null; rows that are equal in both are the same document."""
    return F.xxhash64("doc_id", "text")


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages; a missing language is filled in."""
    judged = language_id.identify(docs, keep=docs.columns)
    kept = judged.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of linked documents the one with the smallest id; rows that link with nothing all stay.

    Null ids come last.  Rows that share an id are told apart by their texts; with equal texts they count as one document.
    """
    keyed = docs.withColumn(ROW, row_key())
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", ROW)
    found = stored(jaccard.link_components(keyed.withColumn("_key", key), "_key"))
    leaders = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col(f"doc_id.{ROW}")).distinct()
    # Leaders are most of the rows, so that they are merged, as large inputs need it anyhow.
    return keyed.join(leaders.hint("merge"), ROW, "left_semi").dropDuplicates([ROW]).select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item of five words or more: shorter ones, such as a common word, are in clean documents too."""
    keyed = docs.withColumn(ROW, row_key())
    leaks = decontamination.contaminated(keyed, table(spark, sf_dir, "benchmark"), ROW, short=False).select(F.col("doc_id").alias(ROW)).distinct()
    return keyed.join(leaks, ROW, "left_anti").select(*docs.columns)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of each document that is left."""
    return tokenizer.digests(docs)


STAGES = [
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("tokens", token_stage),
]

#: A network, a search and a tokenizer: SQL expresses none of them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
