"""Transactions out of an ordered message stream, in batch.

Input: a messages table with slot, seq, kind and the fields of the kind. Kinds are the protocol's letters: B/C begin and commit
of a normal transaction; S/E start and stop of a block of a streamed one, c its commit, A an abort of it (subxid = xid) or of a
sub-transaction; b/P begin-prepare and prepare, p a prepare of a streamed one, K/r commit and rollback of a prepared one;
I/U/D/T row changes, M a logical message, R/Y/O definitions.

Markers are carried forward to the units between them, transactions get a key that is never used again (kind, id and opening
sequence number), and everything else is joins by that key: the outcome by an inner join, rolled-back sub-transactions by an
anti join. Only headers take part; payloads are joined to what survives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .sequence import CHUNK, carry_all, carry_last, running_sum

UNITS = ("I", "U", "D", "T", "M")
CONTROL = ("B", "C", "S", "E", "c", "A", "b", "P", "p", "K", "r")


def _kind(*kinds: str) -> Column:
    return F.col("kind").isin(*kinds)


def _key(letter: str, name: Column, opened: Column) -> Column:
    return F.concat_ws(":", F.lit(letter), name.cast("string"), opened.cast("string"))


def openings(messages: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Control messages with the key of the transaction they belong to, carried by transaction id over chunks of the stream: a
    transaction of millions of blocks is many tasks."""
    marks = messages.where(_kind("S", "c", "A", "p"))
    streamed = carry_last(marks, F.when(_kind("S") & F.col("first_segment"), F.col("seq")), "opened", ["slot", "xid"], "seq", chunk)
    return streamed.withColumn("txn_key", _key("S", F.col("xid"), F.col("opened")))


def route(messages: DataFrame, chunk: int = CHUNK, named: DataFrame | None = None) -> DataFrame:
    """Units with their transaction: the open streamed block first, then the open prepare, then the open normal transaction.
    named: openings(messages), if they are at hand; here and below.

    Adds txn_key, stream_xid (the xid a streamed unit names: its sub-transaction) and mode. Messages that are not
    transactional and lie outside of everything have no key.
    """
    opened = (openings(messages, chunk) if named is None else named).where(_kind("S")).select("slot", "seq", "txn_key")
    marks = messages.join(opened, ["slot", "seq"], "left")
    shown = {
        "_block": F.when(_kind("S"), F.col("txn_key")).when(_kind("E"), F.lit("")),
        "_prepare": F.when(_kind("b"), _key("P", F.col("gid"), F.col("seq"))).when(_kind("P"), F.lit("")),
        "_normal": F.when(_kind("B"), _key("N", F.coalesce("xid", F.lit(0)), F.col("seq"))).when(_kind("C"), F.lit("")),
    }
    marks = carry_all(marks, shown, ["slot"], "seq", chunk)
    open_block, open_prepare, open_normal = (F.when(F.col(c) != "", F.col(c)) for c in ("_block", "_prepare", "_normal"))
    key = F.coalesce(open_block, open_prepare, open_normal)
    units = marks.where(_kind(*UNITS)).withColumn("txn_key", key)
    return units.withColumn("in_stream", open_block.isNotNull()).drop("_block", "_prepare", "_normal")


def endings(messages: DataFrame, chunk: int = CHUNK, named: DataFrame | None = None) -> DataFrame:
    """(slot, txn_key, outcome, mode, gid, end_seq, commit_lsn, end_lsn, commit_ts): how each finished transaction ended."""
    control = messages.where(_kind("B", "C", "b", "P"))
    normal = carry_last(control.where(_kind("B", "C")), F.when(_kind("B"), _key("N", F.coalesce("xid", F.lit(0)), F.col("seq"))), "txn_key", ["slot"], "seq", chunk)
    normal = normal.where(_kind("C")).withColumn("outcome", F.lit("commit")).withColumn("mode", F.lit("NORMAL"))
    prepared = carry_last(control.where(_kind("b", "P")), F.when(_kind("b"), _key("P", F.col("gid"), F.col("seq"))), "txn_key", ["slot"], "seq", chunk).where(_kind("P"))
    named = openings(messages, chunk) if named is None else named
    streamed = named.where(_kind("c") | _kind("A") & (F.col("subxid") == F.col("xid")))
    streamed = streamed.withColumn("outcome", F.when(_kind("c"), "commit").otherwise("abort")).withColumn("mode", F.lit("STREAMED"))
    # A gid names the transaction prepared last under it.
    pool = prepared.select("slot", "seq", "gid", "txn_key").unionByName(named.where(_kind("p")).select("slot", "seq", "gid", "txn_key"))
    later = messages.where(_kind("K", "r"))
    both = later.withColumn("txn_key", F.lit(None).cast("string")).unionByName(pool.withColumn("kind", F.lit("P")), allowMissingColumns=True)
    decided = carry_last(both, F.col("txn_key"), "txn_key", ["slot", "gid"], "seq", chunk).where(_kind("K", "r"))
    decided = decided.withColumn("outcome", F.when(_kind("K"), "commit").otherwise("rollback")).withColumn("mode", F.lit("TWO_PHASE"))
    columns = ["slot", "txn_key", "outcome", "mode", "xid", "gid", F.col("seq").alias("end_seq"), "commit_lsn", "end_lsn", "commit_ts"]
    return normal.select(*columns).unionByName(streamed.select(*columns)).unionByName(decided.select(*columns)).where("txn_key is not null")


def aborted_parts(messages: DataFrame, chunk: int = CHUNK, named: DataFrame | None = None) -> DataFrame:
    """(txn_key, stream_xid) of rolled-back sub-transactions."""
    parts = (openings(messages, chunk) if named is None else named).where(_kind("A") & (F.col("subxid") != F.col("xid")))
    return parts.select("txn_key", F.col("subxid").alias("stream_xid")).distinct()


def committed_units(messages: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Units of committed transactions with their end and a flag for those of rolled-back sub-transactions."""
    ends = endings(messages, chunk).where("outcome = 'commit'").select("txn_key", "mode", "end_seq", F.col("gid").alias("txn_gid"), F.col("commit_lsn").alias("txn_lsn"), F.col("end_lsn").alias("txn_end_lsn"), F.col("commit_ts").alias("txn_ts"))
    units = route(messages, chunk).where("txn_key is not null").join(ends, "txn_key")
    stream_xid = F.when(F.col("in_stream"), F.col("subxid"))
    gone = aborted_parts(messages, chunk).withColumn("aborted", F.lit(True))
    return units.withColumn("stream_xid", stream_xid).join(gone, ["txn_key", "stream_xid"], "left").withColumn("aborted", F.coalesce("aborted", F.lit(False)))


def changes(messages: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Surviving units, numbered within their transaction in order of arrival: chunk by chunk, so that a giant one is many tasks."""
    kept = committed_units(messages, chunk).where("not aborted")
    return running_sum(kept, F.lit(1), "ord", ["txn_key"], "seq", chunk)


def transactions(messages: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Committed transactions in commit order, with expected (before the abort filter) and emitted changes."""
    ends = endings(messages, chunk).where("outcome = 'commit'")
    units = route(messages, chunk).where("txn_key is not null").withColumn("stream_xid", F.when(F.col("in_stream"), F.col("subxid")))
    # Counted by part before any join: what is joined are a few rows per transaction, not its units.
    parts = units.groupBy("txn_key", "stream_xid").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(_kind("I")).alias("i"), F.count_if(_kind("U")).alias("u"), F.count_if(_kind("D")).alias("d"), F.min("seq").alias("lo"), F.max("seq").alias("hi")
    )
    gone = aborted_parts(messages, chunk).withColumn("aborted", F.lit(True))
    parts = parts.join(gone, ["txn_key", "stream_xid"], "left").withColumn("live", F.col("aborted").isNull())
    kept = lambda c: F.when(F.col("live"), F.col(c))
    counts = parts.groupBy("txn_key").agg(
        F.sum("n").alias("expected_changes"), F.sum(kept("n")).alias("emitted_changes"), F.sum(kept("i")).alias("n_insert"), F.sum(kept("u")).alias("n_update"), F.sum(kept("d")).alias("n_delete"), F.min(kept("lo")).alias("first_seq"), F.max(kept("hi")).alias("last_seq")
    )
    zero = {c: 0 for c in ("expected_changes", "emitted_changes", "n_insert", "n_update", "n_delete")}
    return ends.join(counts, "txn_key", "left").fillna(zero)


def open_transactions(messages: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(slot, txn_key, first_seq, n_units) of transactions without an end yet, prepared ones among them."""
    units = route(messages, chunk).where("txn_key is not null")
    still = units.join(endings(messages, chunk).select("txn_key"), "txn_key", "left_anti")
    return still.groupBy("slot", "txn_key").agg(F.min("seq").alias("first_seq"), F.count(F.lit(1)).alias("n_units"))


def low_water_mark(messages: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(slot, low_seq): the smallest sequence number still needed: of open transactions, else the next one."""
    top = messages.groupBy("slot").agg((F.max("seq") + 1).alias("next_seq"))
    low = open_transactions(messages, chunk).groupBy("slot").agg(F.min("first_seq").alias("low_seq"))
    return top.join(low, "slot", "left").select("slot", F.coalesce("low_seq", "next_seq").alias("low_seq"))


def blocks(numbered: DataFrame, most: int = 100_000) -> DataFrame:
    """Streamed events folded into rows of at most so many changes: (txn_key, end_seq, block, changes as an ordered array).
    Blocks are numbered from 0; all but giant transactions have one."""
    item = F.struct("ord", "seq", "kind")
    block = F.floor((F.col("ord") - 1) / most).cast("int").alias("block")
    return numbered.groupBy("txn_key", "end_seq", block).agg(F.sort_array(F.collect_list(item)).alias("changes"))


def relations_touched(units: DataFrame, oid: str) -> DataFrame:
    """(txn_key, oid) of the relations that each transaction's units name, each once. oid: a column of one or an array of them."""
    many = units.schema[oid].dataType.typeName() == "array"
    return units.where("txn_key is not null").select("txn_key", (F.explode(oid) if many else F.col(oid)).alias("oid")).where("oid is not null").distinct()


def frontier(transactions_done: DataFrame, received: DataFrame) -> DataFrame:
    """(slot, confirm_lsn): what may be confirmed upstream: never beyond the last output, nothing before the first output."""
    done = transactions_done.groupBy("slot").agg(F.max("end_lsn").alias("frontier"))
    got = received.groupBy("slot").agg(F.max("end_lsn").alias("received"))
    return got.join(done, "slot", "left").select("slot", F.least("received", F.coalesce("frontier", F.lit(0))).alias("confirm_lsn"))


def safe_message_advance(standalone: DataFrame, pending: DataFrame) -> DataFrame:
    """(slot, seq, lsn, advance): a message outside transactions moves the frontier only where nothing handed over is pending."""
    waiting = pending.groupBy("slot").agg(F.min("first_seq").alias("_low"))
    joined = standalone.join(waiting, "slot", "left")
    return joined.withColumn("advance", F.when(F.col("_low").isNull() | (F.col("seq") < F.col("_low")), F.col("end_lsn")).otherwise(F.lit(0))).drop("_low")


def violations(messages: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(slot, seq, kind, problem): messages that no legal stream holds."""
    before = carry_last(messages.where(_kind("B", "C")), F.col("kind"), "_prev", ["slot"], "seq", chunk, before=True)
    normal = before.withColumn(
        "problem", F.when(_kind("B") & (F.col("_prev") == "B"), "begin inside a transaction").when(_kind("C") & (F.coalesce("_prev", F.lit("C")) == "C"), "commit without begin")
    )
    before = carry_last(messages.where(_kind("S", "E")), F.col("kind"), "_prev", ["slot"], "seq", chunk, before=True)
    stream = before.withColumn("problem", F.when(_kind("S") & (F.col("_prev") == "S"), "block inside a block").when(_kind("E") & (F.coalesce("_prev", F.lit("E")) == "E"), "stop without start"))
    before = carry_last(messages.where(_kind("b", "P")), F.struct("kind", "gid"), "_prev", ["slot"], "seq", chunk, before=True)
    prepare = before.withColumn(
        "problem",
        F.when(_kind("b") & (F.col("_prev.kind") == "b"), "begin-prepare inside a transaction")
        .when(_kind("P") & (F.coalesce("_prev.kind", F.lit("P")) == "P"), "prepare without begin")
        .when(_kind("P") & (F.col("_prev.gid") != F.col("gid")), "gid differs"),
    )
    named = openings(messages, chunk).withColumn("problem", F.when(F.col("opened").isNull(), F.when(_kind("S"), "later block of an unknown transaction").otherwise("end of an unknown transaction")))
    by_gid = Window.partitionBy("slot", "gid").orderBy("seq")
    pool = messages.where(_kind("P", "p", "K", "r")).withColumn("_prev", F.lag("kind").over(by_gid))
    pool = pool.withColumn(
        "problem",
        F.when(_kind("P", "p") & F.coalesce(F.col("_prev").isin("P", "p"), F.lit(False)), "gid is prepared already").when(_kind("K", "r") & ~F.coalesce(F.col("_prev").isin("P", "p"), F.lit(False)), "gid is not prepared"),
    )
    found = [x.where("problem is not null").select("slot", "seq", "kind", "problem") for x in (normal, stream, prepare, named, pool)]
    out = found[0]
    for x in found[1:]:
        out = out.unionByName(x)
    # Within a block every unit names its transaction, outside none does: a transaction never mixes both.
    mixed = F.when(F.col("in_stream") & F.col("subxid").isNull(), "unit without a transaction id in a block").when(~F.col("in_stream") & F.col("subxid").isNotNull(), "unit with a transaction id outside of blocks")
    units = route(messages, chunk).withColumn("problem", F.when(F.col("txn_key").isNull(), F.when(_kind("I", "U", "D", "T"), "change outside of transactions")).otherwise(mixed))
    return out.unionByName(units.where("problem is not null").select("slot", "seq", "kind", "problem"))


def reconciliation(transactions_done: DataFrame, delivered: DataFrame) -> DataFrame:
    """Transactions whose delivered changes differ from those announced, or exceed those expected."""
    got = delivered.groupBy("txn_key").agg(F.count(F.lit(1)).alias("delivered"))
    both = transactions_done.join(got, "txn_key", "left").withColumn("delivered", F.coalesce("delivered", F.lit(0)))
    return both.where((F.col("delivered") != F.col("emitted_changes")) | (F.col("emitted_changes") > F.col("expected_changes"))).select("txn_key", "end_seq", "expected_changes", "emitted_changes", "delivered")
