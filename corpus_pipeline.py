"""From raw documents to packed training sequences.

Stages: quality classifier, n-gram Jaccard join, benchmark decontamination, secret scan, best-fit packing. Every stage takes
(spark, docs, sf_dir), works on all rows that its predecessor kept and is written as Parquet before the next one reads it. All
but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import quality as quality_model
from tidemark.llm import secrets as secret_scan
from tidemark.llm.decontamination import without_contaminated
from tidemark.llm.jaccard_join import one_of_each
from tidemark.llm.packing import pack
from tidemark.llm.workspace import Workspace, fold, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It learns from the same labels as op6."""
    model = quality_model.train(docs, table(spark, sf_dir, "labels"), fold("doc_id", 3) != 1)
    return quality_model.accepted(docs, model)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest doc_id stays; repeated rows of it become one."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; secrets in its text are masked and n_chars is counted anew."""
    return secret_scan.redact(docs, secret_scan.train(secret_scan.example_findings(spark)))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a document with its bin."""
    return pack(docs.select("doc_id", "text", "source")).drop("cluster")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_copies", near_copies),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("packing", packing),
]

#: A trained classifier, a graph's components and a packing search are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = work.stage(stage(spark, docs, sf_dir), f"{k}-{name}")
        if k:
            work.drop(f"{k - 1}-{STAGES[k - 1][0]}")
    return docs
