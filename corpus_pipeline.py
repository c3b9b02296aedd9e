"""Corpus pipeline: from raw documents to packed training sequences.

Each stage works on what its predecessor kept and returns the columns of documents;
the last returns the pieces of the packed sequences. A runner writes every stage's
result and reads it back as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cairn.llm import exact_dedup, language_id, mixing, packing, simhash
from cairn.llm.common import store
from cairn.llm.queries import CAPACITY, DISTANCE, MIX_WEIGHTS, SHINGLE, label_classifier, table, tokenizer_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language stay; those without letters go, and those most of
    whose text no learned language explains."""
    return language_id.accepted(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id stays."""
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return simhash.keep_first(docs, shingle=SHINGLE, distance=DISTANCE)


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their fitted rates say. Every document that is likeliest good
    has a rate of at least 1, so it stays; the others are raised or thinned out to their
    shares, to one in a thousand of the mix where that can be reached."""
    classifier = label_classifier(docs, table(spark, sf_dir, "labels"))
    return mixing.mixed(docs, mixing.mix(docs, classifier, MIX_WEIGHTS, keep="good", tolerance=1e-3))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of sequences of at most ``CAPACITY`` tokens."""
    return packing.pack(docs, tokenizer_path(), capacity=CAPACITY)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("mixing", mix_to_targets),
    ("packing", pack_sequences),
]

#: No SQL states these rows: language models, fitted rates and a tokenizer make them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored under the checkpoint folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
