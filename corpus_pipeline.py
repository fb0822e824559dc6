"""The corpus pipeline: language ID, line dedup, near dedup, decontamination, token ids.

Each stage works on all rows that the one before it kept and calls one of the
training-data operators; all but the last return the columns of ``documents``.

Defined cases: a null or empty text, and one without a letter, has no language
and goes in the first stage.  Rows without a doc_id and repeated rows are rows
of their own; of repeated texts near dedup keeps one row, the one of the
smallest doc_id, a null one only where all are null.  A text that line dedup
empties stays as an empty one.  An empty table, or one in which no language can
be learned, gives no rows.  Further columns go along to the last stage but one,
whatever their names and types.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adledger.llm import bpe, decontaminate, langid, linededup, simhash
from adledger.llm.common import bounded_batches
from adledger.session import stage_table

# Below this calibrated score the language of a document counts as not known.
MIN_LANG_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known go on; texts without a letter, and texts in no one language, go."""
    bounded_batches(spark)
    out = langid.predict(docs, langid.fit(docs))
    kept = out.filter((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= MIN_LANG_SCORE))
    return kept.select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten documents or more share are cut out of all texts."""
    return linededup.dedup_lines(docs).select("row.*").withColumn("n_chars", F.length("text").cast("long"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates just one row stays, that of the smallest doc_id (a null one only if all are)."""
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; documents that are half benchmark or more go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.decontaminate(docs, benchmark).withColumn("n_chars", F.length("text").cast("long"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every kept text, with the columns of ``documents`` that identify it."""
    out = bpe.encode(docs)
    return out.select("row.doc_id", "row.lang", "row.source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("decontamination", decontamination), ("token_ids", token_ids)]
# Fingerprints, the classifier and the token ids have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    bounded_batches(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
