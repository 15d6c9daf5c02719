"""Rolling change files: where one file ends and the next begins, and how files are named."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .sequence import CHUNK


def file_name(task: Column, number: Column, at: Column, extension: str) -> Column:
    """task-<16 digits>-<yyyyMMddHHmmss>.ext"""
    return F.concat(task, F.lit("-"), F.lpad(number.cast("string"), 16, "0"), F.lit("-"), F.date_format(at, "yyyyMMddHHmmss"), F.lit("." + extension))


def parse_file_name(name: Column) -> Column:
    """struct<task, number, at, extension>, null for other names."""
    pattern = r"^(.+)-(\d{16})-(\d{14})\.(bin|json|sql)$"
    part = lambda k: F.regexp_extract(name, pattern, k)
    return F.when(name.rlike(pattern), F.struct(part(1).alias("task"), part(2).cast("long").alias("number"), part(3).alias("at"), part(4).alias("extension")))


def next_number(names: DataFrame, name: str, task: str) -> DataFrame:
    """One row: the number after the largest of the task's files, 1 if there are none."""
    own = names.select(parse_file_name(F.col(name)).alias("p")).where(F.col("p.task") == task)
    return own.agg((F.coalesce(F.max("p.number"), F.lit(0)) + 1).cast("long").alias("next_number"))


class _Chunk:
    """Where files end within consecutive transactions of one task, given where the open file stands at the first."""

    def __init__(self, size: np.ndarray, clock: np.ndarray, limit: int, interval: int) -> None:
        self.clock, self.limit, self.interval, self.n = clock, limit, interval, len(size)
        self.upto = np.cumsum(size, dtype=np.int64)

    def first_end(self, records: int, published: int) -> int:
        """The transaction that ends a file which holds so many records already, n if none does."""
        return min(int(np.searchsorted(self.upto, self.limit - records)), int(np.searchsorted(self.clock, published + self.interval)))

    def next_end(self, start: int) -> int:
        """The same for a file that begins with a transaction, when the one before it has ended a file."""
        return min(int(np.searchsorted(self.upto, self.limit + self.upto[start - 1])), int(np.searchsorted(self.clock, self.clock[start - 1] + self.interval)))

    def ends(self, records: int, published: int) -> list[int]:
        out, at = [], self.first_end(records, published)
        while at < self.n:
            out.append(at)
            at = self.next_end(at + 1) if at + 1 < self.n else self.n
        return out

    def summary(self) -> list[tuple[int, int, int, int, int]]:
        """For each transaction that can be the first to end a file (records up to it, clock, files ended from there on, records
        of the file open at the end, when the last file ended). Chains of files that meet go on as one, so each is followed once."""
        after: dict[int, tuple[int, int, int]] = {}
        candidates = range(min(self.first_end(0, int(self.clock[0])) + 1, self.n))
        for k in candidates:
            path, at = [], k
            while at < self.n and at not in after:
                path.append(at)
                at = self.next_end(at + 1) if at + 1 < self.n else self.n
            for x in reversed(path):
                if at >= self.n:
                    after[x] = (1, int(self.upto[-1] - self.upto[x]), int(self.clock[x]))
                else:
                    files, left, when = after[at]
                    after[x] = (files + 1, left, when)
                at = x
        return [(int(self.upto[k]), int(self.clock[k]), *after[k]) for k in candidates]


def roll(transactions: DataFrame, size: str, order: str, limit: int, by: list[str], at: str | None = None, interval_seconds: float | None = None, chunk: int = CHUNK) -> DataFrame:
    """transactions with the number of their file, from 1. A file ends with the transaction at which it holds limit records or
    more, or at which interval_seconds have passed since the last file ended (the first: since its first transaction); the next
    one starts empty. The clock is the largest time so far, transactions without a time take it as it is.

    Which file a transaction falls into depends on all before it, but a chunk of them asks only for the records and age of the
    file open at its start, and few of its transactions can be the first to end that file: one row for each of these is carried
    across chunks, and chunks are numbered in parallel.
    """
    spark_schema, never = transactions.schema, 1 << 62
    interval = never if interval_seconds is None else max(1, round(interval_seconds * 1e6))
    times = F.lit(0).cast("long") if at is None else F.coalesce(F.unix_micros(F.col(at).cast("timestamp")), F.lit(-never))
    rows = transactions.withColumns({"_size": F.coalesce(F.col(size).cast("long"), F.lit(0).cast("long")), "_time": times, "_chunk": F.floor(F.col(order) / chunk)})
    own = Window.partitionBy(*by, "_chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*by).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    tops = rows.groupBy(*by, "_chunk").agg(F.max("_time").alias("_top")).withColumn("_clock0", F.max("_top").over(earlier)).drop("_top")
    rows = rows.join(tops, [*by, "_chunk"]).withColumn("_clock", F.greatest(F.max("_time").over(own), F.coalesce("_clock0", F.lit(-never)))).drop("_time", "_clock0")

    def chunk_of(frame: pd.DataFrame) -> _Chunk:
        return _Chunk(frame["_size"].to_numpy(np.int64), frame["_clock"].to_numpy(np.int64), limit, interval)

    def summarise(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(order, kind="stable")
        own = chunk_of(frame)
        columns = [list(c) for c in zip(*own.summary(), strict=True)]
        row = {c: frame[c].iloc[0] for c in [*by, "_chunk"]} | dict(zip(("_records", "_times", "_files", "_left", "_last"), columns, strict=True))
        return pd.DataFrame([row | {"_all": int(own.upto[-1]), "_begins": int(own.clock[0])}])

    def enter(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, records, published, number = None, 0, 0, 1
        for frame in frames:
            out = []
            for r in frame.to_dict("records"):
                here = tuple(r[c] for c in by)
                if here != key:
                    key, records, published, number = here, 0, r["_begins"], 1
                out.append({c: r[c] for c in [*by, "_chunk"]} | {"_open": records, "_published": published, "_number": number})
                k = min(int(np.searchsorted(r["_records"], limit - records)), int(np.searchsorted(r["_times"], published + interval)))
                if k < len(r["_records"]):
                    number, records, published = number + int(r["_files"][k]), int(r["_left"][k]), int(r["_last"][k])
                else:
                    records += r["_all"]
            yield pd.DataFrame(out, columns=[*by, "_chunk", "_open", "_published", "_number"])

    def assign(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(order, kind="stable")
        first = frame.iloc[0]
        ends = chunk_of(frame).ends(int(first["_open"]), int(first["_published"]))
        frame["file_number"] = int(first["_number"]) + np.searchsorted(np.array(ends, dtype=np.int64), np.arange(len(frame)))
        return frame[[*by, "_order", "file_number"]]

    keys = T.StructType([*(spark_schema[c] for c in by), T.StructField("_chunk", T.LongType())])
    longs = lambda kind, *names: T.StructType([T.StructField(n, kind) for n in names])
    summary = T.StructType([*keys, *longs(T.ArrayType(T.LongType()), "_records", "_times", "_files", "_left", "_last"), *longs(T.LongType(), "_all", "_begins")])
    entered = T.StructType([*keys, *longs(T.LongType(), "_open", "_published", "_number")])
    slim = rows.select(*by, "_chunk", order, "_size", "_clock")
    summaries = slim.groupBy(*by, "_chunk").applyInPandas(summarise, summary)
    entries = summaries.repartition(*by).sortWithinPartitions(*by, "_chunk").mapInPandas(enter, entered)
    numbered = T.StructType([*(spark_schema[c] for c in by), T.StructField("_order", spark_schema[order].dataType), T.StructField("file_number", T.LongType())])
    placed = slim.withColumn("_order", F.col(order)).join(entries, [*by, "_chunk"]).groupBy(*by, "_chunk").applyInPandas(assign, numbered)
    return transactions.join(placed.withColumnRenamed("_order", order), [*by, order])
