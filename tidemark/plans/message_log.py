"""The events table read as a log of replication messages.

A user is a transaction stream: view, click and purchase insert, update and delete a row in a block of their own, with
sub-transaction event_id % 4; signup commits what the user did since the last commit, error rolls back the sub-transaction of
its number. Every event becomes the messages that the protocol would send for it.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sequence import running_sum

def folder(spark: SparkSession) -> str:
    """A new folder below the shared one, or, where none is named and all runs in this process (as in tests), a temporary one."""
    root, master = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.master
    if not root and (not master.startswith("local") or master.startswith("local-cluster")):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    root = root or tempfile.mkdtemp(prefix="tidemark-")
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


def landed(messages: DataFrame) -> DataFrame:
    """The log as a table of its own: assembly reads its headers several times."""
    spark = messages.sparkSession
    path = folder(spark)
    messages.write.parquet(path)
    return spark.read.schema(messages.schema).parquet(path)


ROWS = ("view", "click", "purchase")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def streamed_messages(events: DataFrame, full_aborts: bool = False) -> DataFrame:
    """Blocks (S, unit, E) for row events, c for signup, A for error. With full_aborts, errors whose number is divisible by 5
    roll back the whole transaction. What would end a transaction without rows sends nothing."""
    whole = (F.col("event_type") == "error") & (F.col("event_id") % 5 == 0) & F.lit(full_aborts)
    rows = running_sum(events, ((F.col("event_type") == "signup") | whole).cast("int"), "seg", ["user_id"], "event_id", before=True)
    first = rows.where(F.col("event_type").isin(*ROWS)).groupBy("user_id", "seg").agg(F.min("event_id").alias("opens"))
    rows = rows.join(first, ["user_id", "seg"]).where("opens <= event_id").withColumn("whole", whole)
    unit = F.when(F.col("event_type") == "view", "I").when(F.col("event_type") == "click", "U").otherwise("D")
    part = F.when(F.col("event_type").isin(*ROWS), F.array(F.lit("S"), unit, F.lit("E"))).when(F.col("event_type") == "signup", F.array(F.lit("c"))).otherwise(F.array(F.lit("A")))
    each = rows.select("event_id", "user_id", "ts", "opens", "whole", F.posexplode(part).alias("k", "kind"))
    return each.select(
        F.lit(0).alias("slot"),
        (F.col("event_id") * 3 + F.col("k")).alias("seq"),
        "kind",
        F.col("user_id").alias("xid"),
        F.when(F.col("whole"), F.col("user_id")).when(F.col("kind").isin("I", "U", "D", "A"), (F.col("event_id") % 4) + 1_000_000).alias("subxid"),
        F.lit(None).cast("string").alias("gid"),
        (F.col("event_id") == F.col("opens")).alias("first_segment"),
        F.when(F.col("kind") == "c", F.col("event_id")).alias("commit_lsn"),
        F.when(F.col("kind") == "c", F.col("event_id") + 1).alias("end_lsn"),
        F.when(F.col("kind") == "c", F.col("ts")).alias("commit_ts"),
    )


def normal_messages(events: DataFrame, size: int = 7) -> DataFrame:
    """B, units, C: every size events make a transaction, in their order."""
    n = F.col("event_id")
    unit = F.when(F.col("event_type") == "view", "I").when(F.col("event_type") == "click", "U").otherwise("D")
    part = F.concat(F.when(n % size == 0, F.array(F.lit("B"))).otherwise(F.array().cast("array<string>")), F.array(unit), F.when(n % size == size - 1, F.array(F.lit("C"))).otherwise(F.array().cast("array<string>")))
    each = events.select("event_id", "ts", F.explode(part).alias("kind"))
    place = F.when(F.col("kind") == "B", 0).when(F.col("kind") == "C", 2).otherwise(1)
    return each.select(
        F.lit(0).alias("slot"), (F.col("event_id") * 3 + place).alias("seq"), "kind", F.floor(F.col("event_id") / size).alias("xid"), F.lit(None).cast("bigint").alias("subxid"), F.lit(None).cast("string").alias("gid"),
        F.lit(False).alias("first_segment"), F.when(F.col("kind") == "C", F.col("event_id")).alias("commit_lsn"), F.when(F.col("kind") == "C", F.col("event_id") + 1).alias("end_lsn"), F.when(F.col("kind") == "C", F.col("ts")).alias("commit_ts"),
    )


def two_phase_messages(events: DataFrame, size: int = 5) -> DataFrame:
    """b, units, P: every size events are prepared under a gid that comes back every hundred transactions; it is decided one
    transaction later, K for those of even number and r for the others."""
    n, number = F.col("event_id"), F.floor(F.col("event_id") / size)
    unit = F.when(F.col("event_type") == "view", "I").when(F.col("event_type") == "click", "U").otherwise("D")
    none = F.array().cast("array<string>")
    end = F.when(n % size == size - 1, F.array(F.lit("P"), F.lit("decide"))).otherwise(none)
    each = events.select("event_id", "ts", number.alias("number"), F.explode(F.concat(F.when(n % size == 0, F.array(F.lit("b"))).otherwise(none), F.array(unit), end)).alias("kind"))
    each = each.where("kind <> 'decide' or number > 0")
    target = F.when(F.col("kind") == "decide", F.col("number") - 1).otherwise(F.col("number"))
    place = F.when(F.col("kind") == "b", 0).when(F.col("kind") == "P", 2).when(F.col("kind") == "decide", 3).otherwise(1)
    kind = F.when(F.col("kind") != "decide", F.col("kind")).when((F.col("number") - 1) % 2 == 0, "K").otherwise("r")
    return each.select(
        F.lit(0).alias("slot"), (F.col("event_id") * 4 + place).alias("seq"), kind.alias("kind"), target.alias("xid"), F.lit(None).cast("bigint").alias("subxid"), F.concat(F.lit("g"), target % 100).alias("gid"),
        F.lit(False).alias("first_segment"), F.when(F.col("kind") == "decide", F.col("event_id")).alias("commit_lsn"), F.when(F.col("kind") == "decide", F.col("event_id") + 1).alias("end_lsn"), F.when(F.col("kind") == "decide", F.col("ts")).alias("commit_ts"),
    )
