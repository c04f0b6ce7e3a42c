"""The corpus pipeline: quality rules, near-dedup, substring dedup, mixing, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and all but
the last return the columns of ``documents``.  ``run`` applies them in order, each on what
its predecessor wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelyard.llm import mixing, near_copies, packing, quality_rules, substring_dedup
from panelyard.llm._shared import store, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.kept(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, the one with the smallest doc_id.

    Two texts are linked if the SimHash fingerprints of their five-word shingles differ in three bits at
    most, or if their MinHash signatures put their Jaccard similarity at about 0.8 or above.
    """
    return near_copies.kept(docs)


def substring(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of fifty words and more that an earlier document has."""
    return substring_dedup.cut_texts(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.taken(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequences and places."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("substring", substring), ("mix", mix), ("pack", pack)]

#: Repeats by hashed windows, knapsack fits and token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
