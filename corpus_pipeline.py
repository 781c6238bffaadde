"""The corpus pipeline: language, toxicity, near duplicates, packing.

``STAGES`` lists the stages in order.  Each takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next one's docs.  All but the last keep the columns of
documents.  ``run`` applies them to the documents of a folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ticketlake.llm import language, ngram_join, packing, toxicity
from ticketlake.llm.common import kept, ship
from ticketlake.llm.queries import table, vocabulary


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told."""
    ship(spark)
    return language.keep_identified(docs)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the machine, learned from the labels of what is left, does not call toxic."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    ship(spark)
    return ngram_join.keep_one(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in the sequences."""
    ship(spark)
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("language", identify_language),
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("packing", pack),
]

#: SQL cannot express the stages; tests hold them against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = kept(docs, f"pipeline-{name}")
    return docs
