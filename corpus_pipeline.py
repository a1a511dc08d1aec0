"""Documents to packed sequences: five stages, each on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from briefloom.llm import language, mixing, near_dedup, packing, substring_dedup
from briefloom.llm.tables import load, stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Jaccard similarity of word shingles, in percent, from which the stage links documents;
#: the operator's default of 85 is the contract of op3_minhash_near_dedup alone.
NEAR_PERCENT = 80


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a language: null texts and texts without a letter."""
    return language.keep_known(docs.select(*COLUMNS))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each near-duplicate group."""
    return near_dedup.keep_one(docs.select(*COLUMNS), NEAR_PERCENT)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes strings of 100 bytes that occur earlier out of the texts."""
    return substring_dedup.remove_repeats(docs.select(*COLUMNS))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixes sources to their target weights; a document comes as often as the mix takes it."""
    return mixing.ordered_mix(docs.select(*COLUMNS))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the tokenized documents into sequences of 2048 tokens."""
    return packing.pack_documents(docs.select(*COLUMNS))


STAGES = [("language_id", known_language), ("near_dedup", one_of_near_copies), ("substring_dedup", without_repeats), ("mixing", mixed), ("packing", packed)]

#: Learned languages, byte-pair ids and linear programs are not SQL; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
