"""Sinks for micro-batches: change files and SQL scripts, each batch once, offsets after publication."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared_files import Folder


def once(path: str, write: Callable[[DataFrame, int], int]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that writes each batch once: a batch whose number is in the log is skipped, and one is
    logged only after its files are published. path may be in any file system that Spark writes."""

    def run(batch: DataFrame, number: int) -> None:
        log, mark = Folder(batch.sparkSession, f"{path}/_batches"), f"{number:012d}.json"
        if not log.exists(mark):
            log.publish(mark, json.dumps({"batch": number, "files": write(batch, number)}).encode())

    return run


def change_files(path: str, task: str, encode: Callable[[DataFrame], DataFrame], extension: str = "bin") -> Callable[[DataFrame, int], int]:
    """A writer for once(): the (file_number, content) rows that encode makes of a batch, published under the task's names by
    the tasks that hold them, numbered on from the batch's number. Returns how many files there are; without any the batch
    leaves no file, and its offset moves with the next one that does."""

    def write(batch: DataFrame, number: int) -> int:
        name = F.concat(F.lit(f"{task}-"), F.lpad((F.lit(number * 1_000_000) + F.col("file_number")).cast("string"), 16, "0"), F.lit(f"-{0:014d}.{extension}"))
        files = encode(batch).select(name.alias("name"), "content")
        home = f"{path}/{task}/batch={number}"
        files.write.mode("overwrite").parquet(f"{home}.staged")  # a batch that runs again replaces what it left
        staged, folder = batch.sparkSession.read.parquet(f"{home}.staged"), Folder(batch.sparkSession, f"{path}/{task}")
        n = 0
        for row in staged.toLocalIterator():  # one file at a time
            content = row["content"]
            folder.publish(row["name"], content.encode() if isinstance(content, str) else bytes(content))
            n += 1
        return n

    return write


def lines(path: str, order: list[str], line: str = "line") -> Callable[[DataFrame, int], int]:
    """A writer for once(): a batch's lines as text files, in order over the files' names."""

    def write(batch: DataFrame, number: int) -> int:
        batch.orderBy(*order).select(line).write.mode("overwrite").text(f"{path}/batch={number:012d}")
        return 1

    return write


def sql_scripts(statements: DataFrame, file_number: str = "file_number") -> DataFrame:
    """(file_number, content): statements (txid, lsn, ord, stmt) as scripts, a BEGIN and COMMIT around each transaction."""
    own = statements.groupBy(file_number, "lsn", "txid").agg(F.array_sort(F.collect_list(F.struct("ord", "stmt"))).alias("s"))
    block = F.concat(F.lit("BEGIN;\n"), F.array_join(F.transform("s", lambda x: x["stmt"]), "\n"), F.lit("\nCOMMIT;\n"))
    files = own.select(file_number, "lsn", "txid", block.alias("block")).groupBy(file_number).agg(F.array_sort(F.collect_list(F.struct("lsn", "txid", "block"))).alias("b"))
    return files.select(file_number, F.array_join(F.transform("b", lambda x: x["block"]), "").alias("content"))


def envelopes(changes: DataFrame) -> DataFrame:
    """Changes as JSON documents with their source position, for a message bus."""
    source = F.struct(*(c for c in ("commit_lsn", "end_lsn", "txn_key", "seq") if c in changes.columns))
    body = F.struct(F.col("kind").alias("op"), source.alias("source"), *(c for c in ("before", "after") if c in changes.columns))
    return changes.select(F.col("txn_key").alias("key"), F.to_json(body).alias("value"))
