"""Transactions as records of a message bus: begin, one record for each change, end, each with the offset it leaves.

Records carry JSON envelopes in the form that change-data consumers know (before, after, source, op, transaction). They come
out of committed changes by column expressions alone, in batch or in a micro-batch; order is (end_lsn, place).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sequence import CHUNK, running_sum

OPS = {"I": "c", "U": "u", "D": "d", "T": "t", "R": "r"}


def offset(ts_us: Column, txid: Column, lsn: Column, processed: Column, committed: Column) -> Column:
    """The offset document: time, transaction, position of the record, and how far transactions are processed and committed."""
    return F.to_json(F.struct(ts_us.alias("ts_usec"), txid.alias("txId"), lsn.alias("lsn"), processed.alias("lsn_proc"), committed.alias("lsn_commit")))


def resume_position(document: Column) -> Column:
    """struct<lsn, lsn_proc, lsn_commit, txId, ts_usec> of an offset document, null for others."""
    return F.from_json(document, "lsn long, lsn_proc long, lsn_commit long, txId long, ts_usec long")


def _truncates(changes: DataFrame) -> DataFrame:
    """A row per table: a truncate names several, other changes one."""
    one = F.array(F.struct(F.col("schema").alias("schema"), F.col("tbl").alias("tbl")))
    several = F.coalesce(F.col("tables"), one) if "tables" in changes.columns else one
    each = changes.select("*", F.posexplode(several).alias("_k", "_table"))
    return each.withColumns({"schema": F.col("_table.schema"), "tbl": F.col("_table.tbl")}).drop("_table")


def records(changes: DataFrame, prefix: str, database: str, skipped: tuple[str, ...] = ("t",), chunk: int = CHUNK) -> DataFrame:
    """(end_lsn, place, topic, key, value, offset) of committed changes.

    changes: txn_key, xid, end_lsn, commit_ts, ord, lsn, kind (I, U, D, T), schema, tbl, optionally tables (array<struct<schema,
    tbl>> of a truncate), key (map), before and after (map<string, string> or null). Operations in skipped go out nowhere;
    begin and end do, with the number of records between them. Transactions without any change have no records.
    """
    op = F.element_at(F.create_map(*(F.lit(x) for kv in OPS.items() for x in kv)), F.col("kind"))
    rows = _truncates(changes).withColumn("_op", op).where(~F.col("_op").isin(*skipped)) if skipped else _truncates(changes).withColumn("_op", op)
    # A truncate has fewer than 1024 tables here; more would share a place.
    rows = rows.withColumn("_seq", F.col("ord") * 1024 + F.col("_k")).withColumn("_table", F.concat_ws(".", "schema", "tbl"))
    rows = running_sum(rows, F.lit(1), "place", ["txn_key"], "_seq", chunk * 1024)
    rows = running_sum(rows, F.lit(1), "_of_table", ["txn_key", "_table"], "_seq", chunk * 1024)
    txn = F.concat_ws(":", F.col("xid").cast("string"), F.col("end_lsn").cast("string"))
    ts_us = F.unix_micros(F.col("commit_ts").cast("timestamp"))
    ts_ms = F.floor(ts_us / 1000)
    source = F.struct(F.lit(prefix).alias("name"), F.lit(database).alias("db"), "schema", F.col("tbl").alias("table"), F.col("xid").alias("txId"), "lsn", ts_ms.alias("ts_ms"))
    place = F.struct(txn.alias("id"), F.col("place").alias("total_order"), F.col("_of_table").alias("data_collection_order"))
    value = F.to_json(F.struct("before", "after", source.alias("source"), F.col("_op").alias("op"), ts_ms.alias("ts_ms"), place.alias("transaction")))
    here = lambda lsn: offset(ts_us, F.col("xid"), lsn, F.col("end_lsn"), F.col("end_lsn"))
    data = rows.select("end_lsn", "place", F.concat_ws(".", F.lit(prefix), "_table").alias("topic"), F.to_json("key").alias("key"), value.alias("value"), here(F.col("lsn")).alias("offset"))

    by_table = rows.groupBy("txn_key", "xid", "end_lsn", "commit_ts", "_table").agg(F.count(F.lit(1)).alias("event_count"))
    counted = by_table.groupBy("txn_key", "xid", "end_lsn", "commit_ts").agg(
        F.sum("event_count").alias("event_count"), F.sort_array(F.collect_list(F.struct(F.col("_table").alias("data_collection"), "event_count"))).alias("data_collections")
    )
    ends = counted.select("*", F.explode(F.array(F.lit("BEGIN"), F.lit("END"))).alias("status"))
    ended = F.col("status") == "END"
    marker = F.to_json(F.struct("status", txn.alias("id"), F.when(ended, F.col("event_count")).alias("event_count"), F.when(ended, F.col("data_collections")).alias("data_collections"), ts_ms.alias("ts_ms")))
    marks = ends.select(
        "end_lsn", F.when(ended, F.col("event_count") + 1).otherwise(0).alias("place"), F.lit(f"{prefix}.transaction").alias("topic"), F.to_json(F.struct(txn.alias("id"))).alias("key"), marker.alias("value"), here(F.col("end_lsn")).alias("offset")
    )
    return data.unionByName(marks)


def heartbeat(spark: SparkSession, prefix: str, ts_us: int, lsn: int, name: str = "heartbeat") -> DataFrame:
    """The record that a quiet stream sends, so that its offset moves: same columns as records()."""
    at = spark.range(1).select(F.lit(lsn).cast("long").alias("end_lsn"), F.lit(ts_us).cast("long").alias("us"))
    none = F.lit(None).cast("long")
    value = F.to_json(F.struct(F.floor(F.col("us") / 1000).alias("ts_ms")))
    return at.select("end_lsn", F.lit(0).cast("long").alias("place"), F.lit(f"{prefix}.{name}").alias("topic"), F.to_json(F.struct(F.lit(prefix).alias("serverName"))).alias("key"), value.alias("value"), offset(F.col("us"), none, F.col("end_lsn"), F.col("end_lsn"), F.col("end_lsn")).alias("offset"))


def log_lines(records_out: DataFrame) -> DataFrame:
    """A line per record, for a log: topic, key and a summary of the envelope."""
    field = lambda path: F.get_json_object("value", path)
    status = field("$.status")
    change = F.concat_ws(" ", F.concat(F.lit("op="), field("$.op")), F.concat(F.lit("lsn="), field("$.source.lsn")), F.concat(F.lit("txn="), field("$.transaction.id")), F.concat(F.lit("key="), F.col("key")))
    marker = F.concat_ws(" ", status, field("$.id"), F.concat(F.lit("events="), field("$.event_count")))
    return records_out.select("end_lsn", "place", F.concat(F.lit("["), F.col("topic"), F.lit("] "), F.when(status.isNotNull(), marker).otherwise(change)).alias("line"))
