"""Corpus pipeline: quality rules, SimHash near-duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir); its result is written as Parquet to the shared checkpoint
folder and read again as the next stage's ``docs``.  All but the last return the columns of
``documents``.  A null text counts as empty, and so fails the quality rules."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roaslens.llm import packing, quality, simhash, suffix
from roaslens.llm.common import cut, read_table
from roaslens.llm.queries import BPE, MATCH, MAX_BITS, PACK_END, POLICY, SEQUENCE, SHINGLE

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the policy passes; the base rules are part of every policy."""
    return quality.ledger(docs).filter(quality.passes(POLICY)).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id (null ids last) of each near-duplicate component."""
    return simhash.keep_one(docs, SHINGLE, MAX_BITS).select(*COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of passages of ``MATCH`` bytes or more that occur elsewhere.

    A character that a cut splits goes as a whole, ``n_chars`` is that of the new text, and documents
    of which nothing but white space is left go."""

    out = suffix.remove_repeats(docs, MATCH, as_text=True)
    text = F.when(F.col("n_removed") == 0, F.coalesce("text", F.lit(""))).otherwise(F.col("kept").cast("string"))
    out = out.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long"))
    return out.filter(F.trim(F.translate("text", "\t\n\x0b\x0c\r", "     ")) != "").select(*COLUMNS)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per token piece, with its sequence and offset."""
    parts = packing.pieces(docs.select("doc_id", "text"), public_tokenizers.path(BPE), PACK_END, SEQUENCE, digests=True)
    return packing.pack(parts, SEQUENCE, ("doc_id", "piece", "ids_crc32"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("best_fit_packing", best_fit_packing),
]

#: SimHash, byte-level passages and tokenizers are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
