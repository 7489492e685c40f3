"""The corpus pipeline: language, near-duplicates, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last return documents' columns.

- language: a document goes if its language is undetermined (null text, or no letter in it);
- near_duplicates: of each component of near-equal fingerprints the document with the least doc_id stays;
- decontaminate: a document goes if a benchmark window (10 words, or a whole shorter item) stands in it;
- pack: what is left is cut into sequences of at most 1024 ids; a row for each piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from relink.llm import inverted, langid, packing, simhash
from relink.llm.common import table, written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_known(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return inverted.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate), ("pack", pack)]

#: No SQL: cross-parsing, simhash components and tokenizer ids can't be stated in it. tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
