"""The registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from adledger.llm import (bitsliced, bpe, conversations, decontaminate, langid, licenses, linededup, pitman_yor, pseudonyms, simhash,
                          tokencounts, training_order, vectorcodes)

from adledger.llm.common import bounded_batches


def _read(spark, sf_dir, table):
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_bit_sliced_top_k(spark, sf_dir):
    return bitsliced.digest(_read(spark, sf_dir, "embeddings"))


def op2_pitman_yor(spark, sf_dir):
    return pitman_yor.digest(_read(spark, sf_dir, "documents"))


def op3_language_id(spark, sf_dir):
    return langid.digest(_read(spark, sf_dir, "documents"))


def op4_license_scan(spark, sf_dir):
    return licenses.digest(_read(spark, sf_dir, "documents"))


def op5_decontaminate(spark, sf_dir):
    return decontaminate.digest(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op6_simhash_dedup(spark, sf_dir):
    return simhash.digest(_read(spark, sf_dir, "documents"))


def op7_training_order(spark, sf_dir):
    return training_order.digest(_read(spark, sf_dir, "documents"))


def op8_line_dedup(spark, sf_dir):
    return linededup.digest(_read(spark, sf_dir, "documents"))


def op9_pseudonyms(spark, sf_dir):
    return pseudonyms.digest(_read(spark, sf_dir, "documents"))


def op10_byte_bpe(spark, sf_dir):
    return bpe.digest(_read(spark, sf_dir, "documents"))


def op11_conversation_repair(spark, sf_dir):
    return conversations.digest(_read(spark, sf_dir, "conversations"))


def op12_token_counts(spark, sf_dir):
    return tokencounts.digest(_read(spark, sf_dir, "documents"))


def op13_vector_codes(spark, sf_dir):
    return vectorcodes.digest(_read(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_bit_sliced_top_k, op2_pitman_yor, op3_language_id, op4_license_scan, op5_decontaminate, op6_simhash_dedup,
    op7_training_order, op8_line_dedup, op9_pseudonyms, op10_byte_bpe, op11_conversation_repair, op12_token_counts,
    op13_vector_codes)}
