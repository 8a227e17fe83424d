"""The corpus pipeline: five stages from raw documents to a training mix.

Every stage takes the documents that its predecessor kept and gives them on with
the columns of the table; its output is written as Parquet in the shared folder
and read again, which cuts the lineage. The last stage adds ``copy``, the number
of the repetition.

Defined cases are those of the operators: a null or empty text is not rejected
by the first stage (its weight is 0 and lies above the dividing point or not like
any other), such texts are copies of each other for the second, and take no words
of the mix. Empty tables pass through every stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gleaner.llm import contamination, importance, mixing, passages, simhash
from gleaner.scratch import Scratch
from gleaner.session import table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling keeps."""
    return importance.Sampler(docs, table(spark, sf_dir, "labels"), limit=20_000, seed=11).kept(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group."""
    return simhash.one_per_group(docs, threshold=0.8, shingle=5)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that a document before them has."""
    return passages.remove_spans(docs, min_line=25, min_run=42, threshold=0.8, shingle=5)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return contamination.without_items(docs, table(spark, sf_dir, "benchmark"), threshold=0.8, shingle=5)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the target weights of their sources ask for."""
    return mixing.mixed_documents(docs, epochs=3, cycle=(1, 2, 3))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("substrings", substrings), ("decontaminate", decontaminate), ("mixture", mixture)]

#: SQL cannot express the hashed models, SimHash and MinHash of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to the documents of a folder."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        after = scratch.write(stage(spark, docs, sf_dir), name)
        scratch.drop(docs)
        docs = after
    return docs
