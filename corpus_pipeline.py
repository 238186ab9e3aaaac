"""Corpus pipeline: raw documents to packed training sequences.

Stages, each one of the corpus operators: the quality classifier rejects
documents, near duplicates keep one document of each class, the mix takes and
repeats documents to the sources' target weights, and packing cuts and places
the token sequences. Every stage's result is written as Parquet and reread as
the next one's input. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roadframe.llm.common import read_table, stored
from roadframe.llm.dedup import keep_one
from roadframe.llm.mixing import mix_documents
from roadframe.llm.packing import pack
from roadframe.llm.quality import keep_good


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it is fitted on the table ``labels``."""
    return keep_good(docs, read_table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, once or twice each, by target weights."""
    return mix_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all token pieces; a repeated document is packed each time."""
    return pack(docs)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("mix", mix), ("packing", packing)]

#: a learned score, signatures and token ids have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the whole table ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
