"""From raw documents to packed training sequences.

Each stage works on all that its predecessor kept and is written before the next one reads it, so a lost executor costs
no more than tasks of one stage. The first four return the columns of documents; the last returns the packed pieces.

Defined cases, besides those that the operators' modules state: a document with a null text has no toxic word and goes in the second stage, as it has too
few words; one without an id is no copy of another and stays as such; of rows that repeat an id and a text one stays, of different texts under one id
that with the least digest; a null source is a host of its own; further columns, whatever their names, are kept up to the last stage; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from codetide.llm.common import documents, materialise, read_table
from codetide.llm.decontamination import without_leaks
from codetide.llm.neardup import keep_one
from codetide.llm.packing import pack_documents
from codetide.llm.quality import kept_documents
from codetide.llm.toxicity import learn, without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic go. Labels are those of documents that are not held out."""
    return without_toxic(docs, learn(docs, read_table(spark, sf_dir, "labels")))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules, or that shared lines deplete, go."""
    return kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of equal and near texts the document with the least id stays."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return without_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents left with their places in sequences."""
    return pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: SQL can express neither the learned scores nor the signatures; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs


PIPELINE_QUERIES = {"pipeline": run}
