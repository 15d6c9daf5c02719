"""Every kind of message, and what assembly makes of the rarer ones."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import assembly, metrics
from ..sources import pgoutput
from .message_log import landed, normal_messages, read, two_phase_messages
from .registry import query

#: Kinds by the remainder of event_id.
KINDS = "BCORYSEcAbPKrp"


@query("""with k as (select *, substr('BCORYSEcAbPKrp', cast(event_id % 14 as int) + 1, 1) as kind from events)
 select event_id, kind, case when kind in ('B', 'S', 'c', 'A', 'b', 'P', 'K', 'r', 'p') then user_id end as xid, case when kind = 'A' then event_id + 1 when kind in ('R', 'Y') then 7 end as subxid,
 case when kind in ('b', 'P', 'K', 'r', 'p') then 'gid ' || event_id end as gid, case when kind = 'S' then event_id % 3 = 0 end as first_segment,
 case when kind in ('B', 'C', 'O', 'c', 'b', 'P', 'K', 'r', 'p') then event_id * 4096 end as commit_lsn, case when kind in ('C', 'c', 'b', 'P', 'K', 'r', 'p') then event_id * 4096 + 64 end as end_lsn,
 case when kind in ('B', 'C', 'c', 'b', 'P', 'K', 'r', 'p') then ts end as commit_ts, case when kind = 'O' then 'origin ' || user_id end as prefix, case when kind in ('R', 'Y') then event_id end as rel_oid,
 case when kind = 'R' then 'app.' || event_type || ' f id:20:-1:true,' || event_type || ':1043:36:false' when kind = 'Y' then 'app.' || event_type || ' - ' end as relation,
 case when kind = 'A' then event_id * 8 end as abort_lsn, case when kind = 'A' then epoch_us(ts) end as abort_ts_us from k""")
def wire_control_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Begins, commits, origins, relations, types, blocks, aborts and two-phase messages as bytes and back."""

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            raws = []
            for i, u, t, us in zip(b["event_id"], b["user_id"], b["event_type"], b["us"], strict=True):
                k = KINDS[i % 14]
                columns = [{"name": "id", "type_oid": 20, "typmod": -1, "is_key": True}, {"name": t, "type_oid": 1043, "typmod": 36}]
                more = {"abort_lsn": i * 8} if k == "A" else {}
                raws.append(
                    pgoutput.encode_message(
                        k, stream_xid=7, xid=u, subxid=i + 1, gid=f"gid {i}", first_segment=i % 3 == 0, commit_lsn=i * 4096, end_lsn=i * 4096 + 64, ts_us=us, prefix=f"origin {u}", rel_oid=i, schema="app", tbl=t, replident="f", columns=columns, **more
                    )
                )
            yield pd.DataFrame({"event_id": b["event_id"], "raw": raws, "in_stream": True})

    events = read(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    m = pgoutput.decode(events.mapInPandas(encode, "event_id long, raw binary, in_stream boolean"), parallel=True)
    columns = F.array_join(F.transform("relation.columns", lambda c: F.concat_ws(":", c["name"], c["type_oid"].cast("string"), c["typmod"].cast("string"), c["is_key"].cast("string"))), ",")
    relation = F.when(F.col("relation").isNotNull(), F.concat(F.col("relation.schema"), F.lit("."), F.col("relation.tbl"), F.lit(" "), F.coalesce("relation.replident", F.lit("-")), F.lit(" "), columns))
    return m.select(
        "event_id", "kind", "xid", "subxid", "gid", "first_segment", "commit_lsn", "end_lsn", F.col("commit_ts").cast("timestamp_ntz").alias("commit_ts"), "prefix", "rel_oid", relation.alias("relation"), "abort_lsn", "abort_ts_us"
    )


@query("select event_id, case when event_id % 2 = 0 then 'T' else 'M' end as kind, case when event_id % 2 = 0 then '1,' || event_id end as oids, case when event_id % 2 = 0 then case event_id % 8 when 0 then 'CASCADE,RESTART IDENTITY' when 2 then 'CASCADE' when 4 then 'RESTART IDENTITY' else '' end end as options, case when event_id % 2 = 1 then 'p' || user_id end as prefix, case when event_id % 2 = 1 then event_type end as content, case when event_id % 2 = 1 then event_id % 3 = 0 end as transactional from events")
def wire_truncates_and_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Truncates and logical messages as bytes and back."""

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            raws = []
            for i, u, t in zip(b["event_id"], b["user_id"], b["event_type"], strict=True):
                options = {0: ["CASCADE", "RESTART IDENTITY"], 2: ["CASCADE"], 4: ["RESTART IDENTITY"]}.get(i % 8, [])
                raws.append(pgoutput.encode_message("T", rel_oids=[1, i], options=options) if i % 2 == 0 else pgoutput.encode_message("M", transactional=i % 3 == 0, prefix=f"p{u}", content=t.encode()))
            yield pd.DataFrame({"event_id": b["event_id"], "raw": raws, "in_stream": False})

    m = pgoutput.decode(read(spark, sf_dir, "events").select("event_id", "user_id", "event_type").mapInPandas(encode, "event_id long, raw binary, in_stream boolean"))
    oids = F.array_join(F.transform("rel_oids", lambda o: o.cast("string")), ",")
    return m.select("event_id", "kind", oids.alias("oids"), F.array_join("options", ",").alias("options"), "prefix", F.decode("content", "UTF-8").alias("content"), "transactional")


@query("select event_id, case event_id % 4 when 0 then 'text without end' when 1 then 'unknown message' when 2 then 'bytes after message' else 'image tag' end as problem from events")
def wire_broken_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broken messages are named, not guessed (D3)."""

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            raws = []
            for i in b["event_id"]:
                whole = pgoutput.encode_message("I", rel_oid=int(i), new=["x"])
                raws.append([pgoutput.encode_message("O", prefix="p")[:-1], b"?" + whole[1:], whole + b"\0", whole[:5] + b"X" + whole[6:]][i % 4])
            yield pd.DataFrame({"event_id": b["event_id"], "raw": raws, "in_stream": False})

    m = pgoutput.decode(read(spark, sf_dir, "events").select("event_id").mapInPandas(encode, "event_id long, raw binary, in_stream boolean"), permissive=True)
    named = F.regexp_extract("prefix", "(text without end|unknown message|bytes after message|image tag)", 1)
    return m.where("kind is null").select("event_id", named.alias("problem"))


def _streamed_prepares(events: DataFrame) -> DataFrame:
    """Two-phase messages with each unit in a block of its own and a streamed prepare instead of begin-prepare and prepare."""
    m = two_phase_messages(events)
    unit, opens = F.col("kind").isin("I", "U", "D"), F.floor(F.col("seq") / 4) % 5 == 0
    letter = F.when(unit, F.array(F.lit("S"), F.col("kind"), F.lit("E"))).when(F.col("kind") == "P", F.array(F.lit("p"))).otherwise(F.array("kind"))
    each = m.where("kind <> 'b'").select("*", F.posexplode(letter).alias("k", "letter"))
    return each.select(
        "slot", (F.col("seq") * 3 + F.col("k")).alias("seq"), F.col("letter").alias("kind"), "xid", F.when(F.col("letter").isin("I", "U", "D"), F.col("xid")).alias("subxid"), "gid", ((F.col("letter") == "S") & opens).alias("first_segment"),
        "commit_lsn", "end_lsn", "commit_ts",
    )


@query("""with t as (select event_id // 5 as n, count(*) as units, min(event_id) as first_seq from events group by 1 having count(*)=5), d as (select event_id // 5 - 1 as n, event_id as commit_lsn from events where event_id % 5 = 4 and event_id // 5 > 0)
 select 'g' || cast(d.n % 100 as varchar) as gid, d.commit_lsn, case when d.n % 2 = 0 then 'commit' else 'rollback' end as outcome, units as n_units, first_seq from d join t on t.n = d.n""")
def txn_streamed_prepare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streamed transactions prepared under a gid and decided later (A10)."""
    messages = landed(_streamed_prepares(read(spark, sf_dir, "events")))
    units = assembly.route(messages).groupBy("txn_key").agg(F.count(F.lit(1)).alias("n_units"), F.floor(F.min("seq") / 12).alias("first_seq"))
    return assembly.endings(messages).join(units, "txn_key").select("gid", "commit_lsn", "outcome", "n_units", "first_seq")


def _with_messages(events: DataFrame) -> DataFrame:
    """Normal transactions of seven events; errors are logical messages, and so are the last events, which come after the commit."""
    m = normal_messages(events).join(events.select(F.col("event_id").alias("_id"), "event_type"), F.floor(F.col("seq") / 3) == F.col("_id"))
    last, unit = F.col("_id") % 7 == 6, F.col("kind").isin("I", "U", "D")
    kind = F.when(unit & (last | (F.col("event_type") == "error")), "M").otherwise(F.col("kind"))
    return m.withColumn("seq", F.when(F.col("kind") == "C", F.col("seq") - 3).otherwise(F.col("seq"))).withColumn("kind", kind).drop("_id", "event_type")


@query("select event_id, event_id % 7 < 6 and event_id // 7 = (select min(b.event_id // 7) from events b where b.event_id // 7 = events.event_id // 7 and b.event_id % 7 = 0) as inside from events where event_type = 'error' or event_id % 7 = 6")
def txn_logical_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logical messages go with the open transaction; outside of all they stand alone."""
    routed = assembly.route(landed(_with_messages(read(spark, sf_dir, "events")))).where("kind = 'M'")
    return routed.select(F.floor(F.col("seq") / 3).alias("event_id"), F.col("txn_key").isNotNull().alias("inside"))


@query("select distinct cast(event_id // 7 as bigint) as xid, user_id % 5 as oid from events where event_id % 7 < 7 and event_id // 7 in (select event_id // 7 from events where event_id % 7 = 0)")
def txn_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The relations that each transaction touches."""
    events = read(spark, sf_dir, "events")
    units = assembly.route(landed(normal_messages(events))).withColumn("event_id", F.floor(F.col("seq") / 3)).join(events.select("event_id", (F.col("user_id") % 5).alias("rel_oid")), "event_id")
    touched = assembly.relations_touched(units, "rel_oid")
    return touched.select(F.split_part("txn_key", F.lit(":"), F.lit(2)).cast("long").alias("xid"), "oid")


@query("""with t as (select event_id // 5 as n, count(*) as c, max(event_id) as last from events group by 1) select cast(0 as int) as slot, count(case when c = 5 and n >= (select max(n) from t where c = 5) then 1 end) as pending_prepared,
 cast(sum(case when c < 5 then c when n >= (select max(n) from t where c = 5) then c else 0 end) as bigint) as open_units from t""")
def pending_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prepared but undecided transactions, and units of open ones."""
    return metrics.pending(landed(two_phase_messages(read(spark, sf_dir, "events"))))
