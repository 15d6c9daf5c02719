"""Transaction assembly, versions and filters over the message log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import assembly, filters, lookups, rolling, sequence
from .message_log import landed, normal_messages, read, streamed_messages, two_phase_messages
from .registry import query

SEGMENTS = """
with m as (select event_id as seq, user_id as sid, event_type, ts, event_id % 4 as subxid,
  coalesce(sum(case when event_type='signup' then 1 else 0 end) over (partition by user_id order by event_id rows between unbounded preceding and 1 preceding),0) as seg from events),
o as (select sid, seg, min(seq) as opens from m where event_type in ('view','click','purchase') group by 1,2),
c as (select m.sid, m.seg, seq as commit_seq, ts as commit_ts, opens from m join o on m.sid=o.sid and m.seg=o.seg where event_type='signup'),
a as (select distinct m.sid, m.seg, subxid from m join o on m.sid=o.sid and m.seg=o.seg where event_type='error' and seq > opens),
u as (select m.*, opens from m join o on m.sid=o.sid and m.seg=o.seg where event_type in ('view','click','purchase')),
k as (select u.*, case when a.subxid is not null then 1 else 0 end as aborted from u left join a on u.sid=a.sid and u.seg=a.seg and u.subxid=a.subxid)
"""
OP = "case event_type when 'view' then 'I' when 'click' then 'U' else 'D' end"


def _streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed(streamed_messages(read(spark, sf_dir, "events")))


@query(SEGMENTS + """select c.sid as stream_id, c.commit_seq, c.commit_ts, count(*) as expected_changes, cast(sum(1-aborted) as bigint) as emitted_changes,
 cast(sum(case when aborted=0 and k.event_type='view' then 1 else 0 end) as bigint) as n_insert, cast(sum(case when aborted=0 and k.event_type='click' then 1 else 0 end) as bigint) as n_update,
 cast(sum(case when aborted=0 and k.event_type='purchase' then 1 else 0 end) as bigint) as n_delete, min(case when aborted=0 then k.seq end) as first_seq, max(case when aborted=0 then k.seq end) as last_seq
 from c join k on c.sid=k.sid and c.seg=k.seg group by 1,2,3""")
def txn_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Committed transactions with rolled-back parts removed."""
    t = assembly.transactions(_streamed(spark, sf_dir))
    event = lambda c: F.floor(F.col(c) / 3).cast("long")
    return t.select(F.col("xid").alias("stream_id"), F.col("commit_lsn").alias("commit_seq"), "commit_ts", "expected_changes", "emitted_changes", "n_insert", "n_update", "n_delete", event("first_seq").alias("first_seq"), event("last_seq").alias("last_seq"))


@query(SEGMENTS + "select c.sid as stream_id, c.commit_seq, count(*) as n_blocks, min(k.seq) as first_block, max(k.seq) as last_block from c join k on c.sid=k.sid and c.seg=k.seg group by 1,2")
def txn_streamed_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of each streamed transaction (A3)."""
    messages = _streamed(spark, sf_dir)
    ends = assembly.endings(messages).where("outcome = 'commit'").select("txn_key", F.col("xid").alias("stream_id"), F.col("commit_lsn").alias("commit_seq"))
    starts = assembly.openings(messages).where("kind = 'S'").groupBy("txn_key").agg(F.count(F.lit(1)).alias("n_blocks"), F.floor(F.min("seq") / 3).alias("first_block"), F.floor(F.max("seq") / 3).alias("last_block"))
    return ends.join(starts, "txn_key").drop("txn_key")


@query(SEGMENTS + "select k.sid as stream_id, k.seq, k.subxid + 1000000 as stream_xid from c join k on c.sid=k.sid and c.seg=k.seg where aborted=1")
def txn_subxact_abort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units that a rolled-back sub-transaction takes away."""
    gone = assembly.committed_units(_streamed(spark, sf_dir)).where("aborted")
    return gone.select(F.col("xid").alias("stream_id"), F.floor(F.col("seq") / 3).alias("seq"), "stream_xid")


@query("""with m as (select event_id as seq, user_id as sid, event_type, (event_type='error' and event_id % 5 = 0) as whole, coalesce(sum(case when event_type='signup' or (event_type='error' and event_id % 5 = 0) then 1 else 0 end)
  over (partition by user_id order by event_id rows between unbounded preceding and 1 preceding),0) as seg from events),
 o as (select sid, seg, count(*) as n_units from m where event_type in ('view','click','purchase') group by 1,2)
 select m.sid as stream_id, m.seq as end_seq, case when whole then 'abort' else 'commit' end as outcome, n_units from m join o on m.sid=o.sid and m.seg=o.seg where event_type='signup' or whole""")
def txn_full_abort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole-transaction aborts and commits with the units they decide."""
    messages = landed(streamed_messages(read(spark, sf_dir, "events"), full_aborts=True))
    units = assembly.route(messages).groupBy("txn_key").agg(F.count(F.lit(1)).alias("n_units"))
    return assembly.endings(messages).join(units, "txn_key").select(F.col("xid").alias("stream_id"), F.floor(F.col("end_seq") / 3).alias("end_seq"), "outcome", "n_units")


@query("""select cast(event_id // 7 as bigint) as xid, max(event_id) as commit_lsn, max(ts) as commit_ts, count(*) as expected_changes, count(*) as emitted_changes, min(event_id) as first_seq
 from events group by 1 having count(*) = 7""")
def txn_normal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Begin and commit around consecutive changes; the open rest is left out (A2)."""
    t = assembly.transactions(landed(normal_messages(read(spark, sf_dir, "events"))))
    return t.select(F.regexp_extract("txn_key", "^N:(\\d+):", 1).cast("long").alias("xid"), "commit_lsn", "commit_ts", "expected_changes", "emitted_changes", F.floor(F.col("first_seq") / 3).alias("first_seq"))


@query("""with t as (select event_id // 5 as n, count(*) as units, min(event_id) as first_seq from events group by 1 having count(*)=5), d as (select event_id // 5 - 1 as n, event_id as commit_lsn, ts as commit_ts from events where event_id % 5 = 4 and event_id // 5 > 0)
 select 'g' || cast(d.n % 100 as varchar) as gid, d.commit_lsn, d.commit_ts, case when d.n % 2 = 0 then 'commit' else 'rollback' end as outcome, units as n_units, first_seq from d join t on t.n = d.n""")
def txn_two_phase(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prepared transactions and how they were decided, under gids that come back."""
    messages = landed(two_phase_messages(read(spark, sf_dir, "events")))
    units = assembly.route(messages).groupBy("txn_key").agg(F.count(F.lit(1)).alias("n_units"), F.floor(F.min("seq") / 4).alias("first_seq"))
    return assembly.endings(messages).join(units, "txn_key").select("gid", "commit_lsn", "commit_ts", "outcome", "n_units", "first_seq")


@query(SEGMENTS + "select c.sid as stream_id, count(*) as expected_changes, cast(sum(1-aborted) as bigint) as emitted_changes, count(distinct c.seg) as transactions from c join k on c.sid=k.sid and c.seg=k.seg group by 1")
def txn_expected_vs_emitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts before and after the abort filter, by stream."""
    t = assembly.transactions(_streamed(spark, sf_dir))
    return t.groupBy(F.col("xid").alias("stream_id")).agg(F.sum("expected_changes").alias("expected_changes"), F.sum("emitted_changes").alias("emitted_changes"), F.count(F.lit(1)).alias("transactions"))


@query(SEGMENTS + "select u.sid as stream_id, min(u.seq) as first_seq, count(*) as n_units from u left join c on u.sid=c.sid and u.seg=c.seg where c.sid is null group by 1")
def txn_open_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions that haven't ended, with their first unit."""
    still = assembly.open_transactions(_streamed(spark, sf_dir))
    return still.select(F.split_part("txn_key", F.lit(":"), F.lit(2)).cast("long").alias("stream_id"), F.floor(F.col("first_seq") / 3).alias("first_seq"), "n_units")


@query(SEGMENTS + "select cast(0 as int) as slot, min(u.seq) as low_seq from u left join c on u.sid=c.sid and u.seg=c.seg where c.sid is null")
def low_water_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The smallest sequence number still needed."""
    return assembly.low_water_mark(_streamed(spark, sf_dir)).select("slot", F.floor(F.col("low_seq") / 3).alias("low_seq"))


@query(SEGMENTS + f"select c.sid as stream_id, k.seq, {OP.replace('event_type', 'k.event_type')} as op, row_number() over (partition by k.sid, k.seg order by k.seq) as ord from c join k on c.sid=k.sid and c.seg=k.seg where aborted=0")
def change_row_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Surviving changes numbered within their transaction."""
    return assembly.changes(_streamed(spark, sf_dir)).select(F.col("xid").alias("stream_id"), F.floor(F.col("seq") / 3).alias("seq"), F.col("kind").alias("op"), F.col("ord").cast("long").alias("ord"))


@query(SEGMENTS + f"select c.sid as stream_id, c.commit_seq, string_agg({OP.replace('event_type', 'k.event_type')}, '' order by k.seq) as ops, count(*) as n from c join k on c.sid=k.sid and c.seg=k.seg where aborted=0 group by 1,2")
def txn_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events folded into one row per transaction."""
    folded = assembly.blocks(assembly.changes(_streamed(spark, sf_dir)))
    return folded.select(F.split_part("txn_key", F.lit(":"), F.lit(2)).cast("long").alias("stream_id"), F.floor(F.col("end_seq") / 3).alias("commit_seq"), F.array_join(F.transform("changes", lambda c: c["kind"]), "").alias("ops"), F.size("changes").cast("long").alias("n"))


@query("""with m as (select event_id, event_type, lag(event_id) over (order by event_id) as p from events where event_type in ('view', 'click', 'purchase'))
 select 3 * event_id as n_seq, 'S' as kind, 'block inside a block' as problem from m where (3 * p + 2) % 97 = 0
 union all select 3 * event_id + 1, case event_type when 'view' then 'I' when 'click' then 'U' else 'D' end, 'unit without a transaction id in a block' from m where (3 * event_id + 1) % 89 = 0
 union all select 3 * max(event_id) + 10, 'c', 'end of an unknown transaction' from events union all select 3 * max(event_id) + 11, 'K', 'gid is not prepared' from events union all select 3 * max(event_id) + 12, 'C', 'commit without begin' from events""")
def txn_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lost stops of blocks, units without a transaction id and ends of what never began are found, and nothing else (A2, A3, A7,
    A12)."""
    events = read(spark, sf_dir, "events")
    messages = _streamed(spark, sf_dir)
    lost_stop = (F.col("kind") == "E") & (F.col("seq") % 97 == 0)
    nameless = F.col("kind").isin("I", "U", "D") & (F.col("seq") % 89 == 0)
    spoiled = messages.where(~lost_stop).withColumn("subxid", F.when(~nameless, F.col("subxid")))
    stray = events.agg((F.max("event_id") * 3 + 10).alias("at")).select("at", F.posexplode(F.array(F.lit("c"), F.lit("K"), F.lit("C"))).alias("k", "letter"))
    ends = stray.select(F.lit(0).alias("slot"), (F.col("at") + F.col("k")).alias("seq"), F.col("letter").alias("kind"), F.lit(-1).cast("long").alias("xid"), F.lit("none").alias("gid"), F.lit(False).alias("first_segment"))
    return assembly.violations(spoiled.unionByName(ends, allowMissingColumns=True)).select(F.col("seq").alias("n_seq"), "kind", "problem")


@query(SEGMENTS + """, n as (select c.sid, c.commit_seq, count(*) as expected_changes, cast(sum(1-aborted) as bigint) as emitted_changes, cast(sum(case when aborted=0 and k.seq % 11 <> 0 then 1 else 0 end) as bigint) as delivered
  from c join k on c.sid=k.sid and c.seg=k.seg group by 1, 2) select sid as stream_id, commit_seq, expected_changes, emitted_changes, delivered from n where emitted_changes <> delivered""")
def txn_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions of which every eleventh change got lost on delivery."""
    messages = _streamed(spark, sf_dir)
    delivered = assembly.changes(messages).where(F.floor(F.col("seq") / 3) % 11 != 0)
    short = assembly.reconciliation(assembly.transactions(messages), delivered)
    return short.select(F.split_part("txn_key", F.lit(":"), F.lit(2)).cast("long").alias("stream_id"), F.floor(F.col("end_seq") / 3).alias("commit_seq"), "expected_changes", "emitted_changes", "delivered")


@query(SEGMENTS + "select cast(0 as int) as slot, least(max(seq) + 1, (select max(commit_seq) + 1 from c)) as confirm_lsn from m where event_type = 'signup'")
def output_frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What may be confirmed: received, capped by what was put out."""
    messages = _streamed(spark, sf_dir)
    received = read(spark, sf_dir, "events").where("event_type = 'signup'").select(F.lit(0).alias("slot"), (F.col("event_id") + 1).alias("end_lsn"))
    return assembly.frontier(assembly.transactions(messages), received)


@query(SEGMENTS + """, low as (select min(u.seq) as low from u left join c on u.sid=c.sid and u.seg=c.seg where c.sid is null)
 select seq, case when low is null or seq * 3 < low * 3 then seq + 1 else 0 end as advance from m cross join low where event_type='error'""")
def message_safe_advance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far a message outside transactions moves the frontier."""
    pending = assembly.open_transactions(_streamed(spark, sf_dir))
    alone = read(spark, sf_dir, "events").where("event_type = 'error'").select(F.lit(0).alias("slot"), (F.col("event_id") * 3).alias("seq"), (F.col("event_id") + 1).alias("end_lsn"))
    return assembly.safe_message_advance(alone, pending).select(F.floor(F.col("seq") / 3).alias("seq"), F.col("advance").cast("long").alias("advance"))


@query("""with r as (select event_type, event_id, event_id - row_number() over (partition by event_type order by event_id) as g from events)
 select event_type, min(event_id) as first_seq, max(event_id) as last_seq, count(*) as n from r group by event_type, g""")
def index_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of consecutive numbers."""
    return sequence.index_runs(read(spark, sf_dir, "events"), ["event_type"], "event_id")


@query("""with v as (select user_id, event_id, event_id as version from events where event_type='signup') select e.event_id, e.user_id, v.version from events e asof left join v on e.user_id = v.user_id and e.event_id >= v.event_id""")
def asof_relation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each row with the version in force at its own number."""
    events = read(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    versions = events.where("event_type = 'signup'").select("user_id", "event_id", F.col("event_id").alias("version"))
    return sequence.as_of_join(events.select("event_id", "user_id"), versions, "user_id", "event_id", "version", "version")


@query("""with v as (select user_id as oid, event_id as seq from events where event_type='signup'), u as (select event_id // 100 as owner, user_id as oid, event_id as seq from events where event_type in ('view','click','purchase')),
 t as (select owner, max(seq) as last from u group by 1) select d.owner, v.oid, count(*) as n_versions, max(v.seq) as latest from (select distinct owner, oid from u) d join t on t.owner = d.owner join v on v.oid = d.oid and v.seq <= t.last group by 1, 2""")
def relation_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions that a transaction takes along: how many of each table's, from the first on, and the latest."""
    events = read(spark, sf_dir, "events")
    units = events.where("event_type in ('view','click','purchase')").select(F.floor(F.col("event_id") / 100).alias("owner"), F.col("user_id").alias("oid"), F.col("event_id").alias("seq"))
    versions = events.where("event_type = 'signup'").select(F.col("user_id").alias("oid"), F.col("event_id").alias("seq"))
    return sequence.versions_for(units, versions, "oid", "owner").select("owner", "oid", "n_versions", "latest")


@query("""with v as (select user_id as oid, event_id as seq from events where event_type='signup'), f as (select oid, max(seq) as f from v where seq <= (select max(event_id) // 2 from events) group by 1)
 select v.oid, v.seq from v left join f on v.oid = f.oid where f.f is null or v.seq >= f.f""")
def relation_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions still needed above a low-water mark."""
    events = read(spark, sf_dir, "events")
    versions = events.where("event_type = 'signup'").select(F.col("user_id").alias("oid"), F.col("event_id").alias("seq"))
    low = events.agg(F.floor(F.max("event_id") / 2).alias("low"))
    return sequence.prune_versions(versions.join(F.broadcast(low)), "oid", F.col("low")).select("oid", "seq")


@query("""select user_id, event_id, event_type, value from (select *, row_number() over (partition by user_id order by event_id desc) as r from events) where r = 1 and event_type <> 'purchase'""")
def latest_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dictionary after all changes; a purchase removes its key."""
    rows = read(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value")
    return sequence.latest_by_key(rows, ["user_id"], "event_id", F.col("event_type") == "purchase")


@query("select event_type, min(event_id) as first_seq, cast(row_number() over (order by min(event_id)) as int) as def_id from events group by 1")
def dedup_tabledef(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Definitions numbered by first appearance."""
    return sequence.table_ids(read(spark, sf_dir, "events"), ["event_type"], "event_id")


@query("select o_orderkey, o_orderpriority from orders where o_orderstatus || '.' || o_orderpriority in ('O.1-URGENT', 'F.5-LOW')")
def table_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of listed tables (F1, F2)."""
    rows = read(spark, sf_dir, "orders").withColumn("schema", F.col("o_orderstatus")).withColumn("tbl", F.col("o_orderpriority"))
    return filters.publication(rows, ["O.1-URGENT", "F.5-LOW"]).select("o_orderkey", "o_orderpriority")


@query("select o_orderkey from orders where o_custkey in (select c_custkey from customer where c_nationkey < 5)")
def table_filter_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a list that is a table (F2)."""
    allowed = read(spark, sf_dir, "customer").where("c_nationkey < 5").select(F.col("c_custkey").alias("o_custkey"))
    return filters.semi_filter(read(spark, sf_dir, "orders"), allowed, ["o_custkey"]).select("o_orderkey")


def _partitions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    nation = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("filenode"), F.col("n_regionkey").alias("parent_oid"), F.col("n_name").alias("part_name"))
    classes = read(spark, sf_dir, "region").where("r_regionkey <> 4").select(F.col("r_regionkey").alias("oid"), F.lit("geo").alias("schema"), F.col("r_name").alias("tbl"))
    return read(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("filenode")), nation, classes


@query("""select c_custkey, n_name as part_name, r_name as parent_tbl from customer join nation on c_nationkey=n_nationkey join region on n_regionkey=r_regionkey and r_regionkey<>4
 where r_name in (select r_name from region where r_regionkey=1) or n_name in (select n_name from nation where n_nationkey=3)""")
def partition_double_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose partition or whose partition's parent is listed."""
    rows, nation, classes = _partitions(spark, sf_dir)
    listed = read(spark, sf_dir, "region").where("r_regionkey = 1").select(F.concat(F.lit("geo."), "r_name").alias("t")).union(read(spark, sf_dir, "nation").where("n_nationkey = 3").select(F.concat(F.lit("geo."), "n_name")))
    named = filters.with_partition_parent(rows, nation, classes)
    return filters.partition_semi_filter(named, listed, "t").select("c_custkey", "part_name", "parent_tbl")


@query("select c_custkey from customer left join nation on c_nationkey=n_nationkey where n_regionkey is null or n_regionkey = 4")
def partition_chain_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose partition chain is incomplete."""
    return filters.partition_misses(*_partitions(spark, sf_dir)).select("c_custkey")


@query("select user_id, case when user_id % 3 = 0 then user_id // 3 else user_id end as top_xid, count(*) as n from events group by 1, 2")
def subxid_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sub-transactions counted for the transaction on top."""
    events = read(spark, sf_dir, "events").withColumn("xid", F.col("user_id"))
    assigned = events.where("user_id % 3 = 0").select(F.col("user_id").alias("subxid"), F.floor(F.col("user_id") / 3).alias("top_xid"))
    return lookups.top_transaction(events, assigned).groupBy("user_id", "top_xid").agg(F.count(F.lit(1)).alias("n"))


@query("""with p as (select event_id // 4 as value_id, string_agg(event_type, '' order by event_id) as value, count(*) as n, max(event_id % 4) as top from events where event_type <> 'error' group by 1), s as (select event_id // 4 as value_id, count(*) as n from events group by 1)
 select s.value_id, case when p.n = s.n then p.value end as value, case when p.n is null then 'no chunk' when p.top <> p.n - 1 then 'missing chunk' when p.n <> s.n then 'wrong size' end as problem from s left join p on p.value_id = s.value_id""")
def toast_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Out-of-line values of four chunks put together; those of error events never came."""
    events = read(spark, sf_dir, "events").withColumn("value_id", F.floor(F.col("event_id") / 4))
    chunks = events.where("event_type <> 'error'").select("value_id", (F.col("event_id") % 4).cast("int").alias("chunk_seq"), F.encode("event_type", "UTF-8").alias("data"))
    pointers = events.groupBy("value_id").agg(F.sum(F.length("event_type")).alias("size"))
    return lookups.assemble_chunks(pointers, chunks).select("value_id", F.decode("value", "UTF-8").alias("value"), "problem")


@query("select c.c_custkey as value_id, case when s.s_suppkey is not null then s.s_name else c.c_name end as data from customer c left join supplier s on s.s_suppkey = c.c_custkey union all select s_suppkey, s_name from supplier where s_suppkey not in (select c_custkey from customer)")
def toast_probe_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of the stream and fetched ones, the latter winning."""
    own = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("value_id"), F.lit(0).alias("chunk_seq"), F.col("c_name").alias("data"))
    fetched = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("value_id"), F.lit(0).alias("chunk_seq"), F.col("s_name").alias("data"))
    return lookups.merge_chunks(own, fetched).drop("chunk_seq")


@query("""select c_custkey as node, coalesce(a.n_nationkey, b.n_nationkey) as oid, coalesce(a.n_name, b.n_name) as tbl, coalesce(ra.r_name, rb.r_name) as schema from customer
 left join nation a on a.n_nationkey + 100 = c_custkey left join region ra on ra.r_regionkey = a.n_regionkey left join nation b on b.n_nationkey = c_custkey left join region rb on rb.r_regionkey = b.n_regionkey""")
def relation_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File node first, oid next, then namespace and attributes."""
    rows = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("node"))
    classes = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("oid"), (F.col("n_nationkey") + 100).alias("filenode"), F.col("n_regionkey").alias("namespace"), F.col("n_name").alias("tbl"))
    spaces = read(spark, sf_dir, "region").select(F.col("r_regionkey").alias("oid"), F.col("r_name").alias("name"))
    attributes = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("rel_oid"), F.lit(1).alias("attnum"), F.col("n_name").alias("name"))
    return lookups.resolve_relation(rows, classes, spaces, attributes).select("node", "oid", "tbl", "schema")


@query("select o_orderkey, c_name, c_mktsegment from orders left join customer on o_custkey = c_custkey")
def event_with_definition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File events with their file's definition."""
    events = read(spark, sf_dir, "orders").select("o_orderkey", F.lit("f").alias("file"), F.col("o_custkey").alias("def_id"))
    definitions = read(spark, sf_dir, "customer").select(F.lit("f").alias("file"), F.col("c_custkey").alias("def_id"), "c_name", "c_mktsegment")
    return lookups.with_definition(events, definitions).select("o_orderkey", "c_name", "c_mktsegment")


@query("select n.n_nationkey as rel_oid, n.n_name as name, r.r_name as default_expr, r.r_regionkey < 2 as nullable, r.r_regionkey = 3 as is_pk from nation n left join region r on n.n_nationkey = r.r_regionkey")
def wire_with_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wire columns with defaults, nullability and keys by name."""
    nation = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("rel_oid"), F.col("n_name").alias("name"))
    catalog = nation.join(read(spark, sf_dir, "region"), F.col("rel_oid") == F.col("r_regionkey")).select("rel_oid", "name", F.col("r_name").alias("default_expr"), (F.col("r_regionkey") < 2).alias("nullable"), (F.col("r_regionkey") == 3).alias("is_pk"))
    return lookups.with_catalog(nation, catalog)


@query("with recursive t(oid, base) as (select n_nationkey, n_nationkey // 2 from nation), u(oid, step) as (select oid, oid from t union all select u.oid, t.base from u join t on t.oid = u.step where t.base <> 0) select oid, min(step) as base_oid from u group by 1")
def type_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types resolved to their base, step by doubling steps."""
    types = read(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("oid"), F.floor(F.col("n_nationkey") / 2).alias("base"))
    return lookups.base_types(types)


@query("""with recursive t as (select o_orderkey, cast(sum(l_quantity) as bigint) as q from orders join lineitem on o_orderkey = l_orderkey group by 1),
 p as (select *, cast(sum(q) over (order by o_orderkey) as bigint) as upto from t),
 f as (select cast(1 as bigint) as n, min(upto) as total from p where upto >= 1000 union all select n + 1, (select min(upto) from p where upto >= f.total + 1000) from f where total is not null)
 select o_orderkey, q as records, cast(1 + (select count(*) from f where f.total < p.upto) as bigint) as file_number from p""")
def file_roll_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The file of each transaction; files end at transaction ends only (K3)."""
    sums = read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_quantity").cast("long").alias("records"))
    rows = read(spark, sf_dir, "orders").select("o_orderkey").join(sums, "o_orderkey").withColumn("task", F.lit(0))
    return rolling.roll(rows, "records", "o_orderkey", 1000, ["task"], chunk=1 << 12).drop("task")


@query("""with recursive p as (select event_id, event_id % 5 + 1 as q, row_number() over (order by event_id) as rn, max(ts) over (order by event_id) as clock, cast(sum(event_id % 5 + 1) over (order by event_id) as bigint) as upto from events),
 e as (select cast(1 as bigint) as n, (select min(rn) from p where upto >= 200 or clock >= (select min(clock) from p) + interval 30 minute) as rn union all
  select e.n + 1, (select min(p.rn) from p, p as l where l.rn = e.rn and (p.upto >= l.upto + 200 or p.clock >= l.clock + interval 30 minute) and p.rn > l.rn) from e where e.rn is not null)
 select event_id, cast(q as bigint) as records, cast(1 + (select count(*) from e where e.rn < p.rn) as bigint) as file_number from p""")
def file_roll_ages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with an age limit: a file ends by records or by time, whichever comes first (K3)."""
    rows = read(spark, sf_dir, "events").select("event_id", (F.col("event_id") % 5 + 1).alias("records"), "ts", F.lit(0).alias("task"))
    return rolling.roll(rows, "records", "event_id", 200, ["task"], "ts", 1800, chunk=1 << 10).drop("task", "ts")


@query("select o_orderkey, 'orders-' || lpad(cast(o_orderkey as varchar), 16, '0') || '-' || strftime(o_orderdate, '%Y%m%d%H%M%S') || '.bin' as name from orders")
def file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of change files (K7)."""
    return read(spark, sf_dir, "orders").select("o_orderkey", rolling.file_name(F.lit("orders"), F.col("o_orderkey"), F.col("o_orderdate"), "bin").alias("name"))


@query("select max(o_orderkey) + 1 as next_number from orders where o_orderstatus = 'F'")
def file_next_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next free file number of a task, read from names."""
    names = read(spark, sf_dir, "orders").select(rolling.file_name(F.col("o_orderstatus"), F.col("o_orderkey"), F.col("o_orderdate"), "sql").alias("name"))
    return rolling.next_number(names, "name", "F")


@query("select event_id, user_id from events where event_id in (select event_id from events where event_type='view' intersect select event_id from events where value > 50) ")
def parity_intersection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions that both paths put out."""
    events = read(spark, sf_dir, "events")
    both = events.where("event_type = 'view'").select("event_id").intersect(events.where("value > 50").select("event_id"))
    return events.join(both, "event_id", "left_semi").select("event_id", "user_id")


@query("select event_type, user_id from events where event_id % 2 = 0 except all select event_type, user_id from events where event_id % 2 = 1")
def parity_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of one path that the other lacks, with multiplicity."""
    events = read(spark, sf_dir, "events")
    side = lambda k: events.where(F.col("event_id") % 2 == k).select("event_type", "user_id")
    return side(0).exceptAll(side(1))
