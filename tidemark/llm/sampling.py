"""Bounded, reproducible training sets: the rows with the smallest hashes of their keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def labelled(labels: DataFrame, target: str, learn: Column, rows: int, least: float = 0.0) -> DataFrame:
    """(doc_id, y) of at most so many labelled documents with y >= least.

    Repeated labels of one document are averaged, null ones and null keys left out.
    """
    known = labels.where(F.col(target).isNotNull() & F.col("doc_id").isNotNull() & learn).groupBy("doc_id").agg(F.avg(target).alias("y")).where(F.col("y") >= least)
    return known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def unlabelled(documents: DataFrame, rows: int) -> DataFrame:
    """(doc_id) of at most so many documents."""
    return documents.where("doc_id is not null").select("doc_id").orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id").limit(rows)


def texts_of(documents: DataFrame, chosen: DataFrame) -> DataFrame:
    """The chosen rows with their texts. chosen is bounded by the parameter of the functions above, hence the broadcast."""
    return documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
