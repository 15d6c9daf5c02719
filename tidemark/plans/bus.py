"""Records of a message bus: written from transactions, read back, and turned into change files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import assembly
from ..sources import envelopes
from ..streaming import dispatch
from .message_log import landed, normal_messages, read
from .registry import query

TXN = "with t as (select *, event_id // 7 as xid, row_number() over (partition by event_id // 7 order by event_id) as n, count(*) over (partition by event_id // 7) as size, max(event_id) over (partition by event_id // 7) as last, max(ts) over (partition by event_id // 7) as moment from events)"


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by sevens: views insert, clicks update, purchases delete, errors truncate two tables, signups insert elsewhere."""
    events = read(spark, sf_dir, "events")
    units = assembly.changes(landed(normal_messages(events))).select("txn_key", "xid", F.col("txn_end_lsn").alias("end_lsn"), F.col("txn_ts").alias("commit_ts"), "ord", F.floor(F.col("seq") / 3).alias("event_id"))
    kind = F.expr("case event_type when 'click' then 'U' when 'purchase' then 'D' when 'error' then 'T' else 'I' end")
    image = F.create_map(F.lit("id"), F.col("event_id").cast("string"), F.lit("value"), F.col("value").cast("string"))
    rows = events.select(
        "event_id", kind.alias("kind"), F.lit("app").alias("schema"), F.when(F.col("event_type") == "signup", "users").otherwise("events").alias("tbl"),
        F.when(F.col("event_type") == "error", F.array(F.struct(F.lit("app").alias("schema"), F.lit("a").alias("tbl")), F.struct(F.lit("app").alias("schema"), F.lit("b").alias("tbl")))).alias("tables"),
        F.create_map(F.lit("id"), F.col("event_id").cast("string")).alias("key"), F.when(kind == "D", image).alias("before"), F.when(kind.isin("I", "U"), image).alias("after"), (F.col("event_id") * 10).alias("lsn"),
    )
    return dispatch.records(units.join(rows, "event_id"), "srv", "shop", skipped=())


@query(TXN + """, r as (select xid, event_id, n, k, moment, last, event_type, value, case event_type when 'signup' then 'app.users' when 'error' then 'app.' || case k when 0 then 'a' else 'b' end else 'app.events' end as tbl from t, (select unnest([0, 1]) as k) where (k = 0 or event_type = 'error') and size = 7)
 select event_id, case event_type when 'click' then 'UPDATE' when 'purchase' then 'DELETE' when 'error' then null else 'CREATE' end as op, event_type = 'error' as is_truncate, split_part(tbl, '.', 2) as tbl, xid as txid, event_id * 10 as lsn, epoch_us(moment) // 1000 as ts_ms,
 case when event_type <> 'error' then event_id end as id, case when event_type <> 'error' then value end as value, row_number() over (partition by xid order by event_id, k) as total_order, row_number() over (partition by xid, tbl order by event_id, k) as of_table, cast(last + 1 as bigint) as end_lsn from r""")
def dispatched_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change records as envelopes and back: images, places in the transaction, truncates, offsets."""
    read_back = envelopes.events(envelopes.payloads(_records(spark, sf_dir)))
    known = dispatch.resume_position(F.col("offset"))
    rows = read_back.where(known["lsn_proc"] == F.col("end_lsn"))
    at = lambda name: F.element_at(F.map_from_arrays(F.transform("cols", lambda c: c["name"]), "vals"), name)
    event = F.get_json_object("key", "$.id").cast("long")
    return rows.select(
        event.alias("event_id"), "op", "is_truncate", "tbl", "txid", "lsn", "ts_ms", F.when(~F.col("is_truncate"), at("id").cast("long")).alias("id"), F.when(~F.col("is_truncate"), at("value").cast("double")).alias("value"),
        F.col("transaction.total_order").alias("total_order"), F.col("transaction.data_collection_order").alias("of_table"), "end_lsn",
    )


@query(TXN + """, c as (select xid, last, count(*) + count(case when event_type = 'error' then 1 end) as n from t where size = 7 group by 1, 2)
 select xid || ':' || (last + 1) as id, b as begins, case when b then -1 else n end as event_count, case when b then 0 else n + 1 end as place from c, (select unnest([true, false]) as b)""")
def dispatched_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Begin and end records with their counts (K9)."""
    read_back = envelopes.payloads(_records(spark, sf_dir))
    e = F.col("envelope")
    marks = read_back.where(envelopes.is_transaction())
    return marks.select(e["id"].alias("id"), (e["status"] == "BEGIN").alias("begins"), F.coalesce(e["event_count"], F.lit(-1)).alias("event_count"), "place")


@query(TXN + """, c as (select xid, last, count(*) + count(case when event_type = 'error' then 1 end) as n from t where size = 7 group by 1, 2)
 select '[srv.transaction] BEGIN ' || xid || ':' || (last + 1) as line from c union all select '[srv.transaction] END ' || xid || ':' || (last + 1) || ' events=' || n from c
 union all select '[srv.app.' || case event_type when 'signup' then 'users' when 'error' then u else 'events' end || '] op=' || case event_type when 'click' then 'u' when 'purchase' then 'd' when 'error' then 't' else 'c' end || ' lsn=' || event_id * 10 || ' txn=' || xid || ':' || (last + 1) || ' key={"id":"' || event_id || '"}'
 from t, (select unnest(['a', 'b']) as u) where size = 7 and (u = 'a' or event_type = 'error')""")
def dispatched_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records as lines of a log (K2)."""
    return dispatch.log_lines(_records(spark, sf_dir)).select("line")


@query("""select event_id, 'INT,BOOL,FLOAT64,DATE,TIME,TIMESTAMP,INTERVAL' as types, event_id || '|' || case when event_id % 2 = 0 then 'true' else 'false' end || '|' || strftime(date '2024-01-01' + cast(event_id % 400 as int), '%Y-%m-%d') || '|' || strftime(timestamp '1970-01-01' + to_microseconds(event_id % 86400 * 1000000 + 7), '%H:%M:%S.%f') || '|' || strftime(ts, '%Y-%m-%d %H:%M:%S.%f') || '|' || event_id || ' microseconds' as shown from events""")
def envelope_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes with a schema: column types by name, times as text."""
    fields = [("id", "int64", None), ("flag", "boolean", None), ("value", "double", None), ("day", "int32", "Date"), ("clock", "int64", "MicroTime"), ("at", "int64", "MicroTimestamp"), ("span", "int64", "MicroDuration")]
    item = lambda f, t, n: F.struct(F.lit(f).alias("field"), F.lit(t).alias("type"), F.lit(n and f"x.time.{n}").cast("string").alias("name"))
    schema = F.struct(F.array(F.struct(F.lit("after").alias("field"), F.lit("struct").alias("type"), F.lit(None).cast("string").alias("name"), F.array(*(item(*f) for f in fields)).alias("fields"))).alias("fields"))
    k = F.col("event_id")
    after = F.struct(
        k.alias("id"), (k % 2 == 0).alias("flag"), "value", (F.datediff(F.lit("2024-01-01").cast("date"), F.lit("1970-01-01").cast("date")) + k % 400).cast("int").alias("day"), (k % 86400 * 1000000 + 7).alias("clock"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("at"), k.alias("span"),
    )
    source = F.struct(F.lit("shop").alias("db"), F.lit("app").alias("schema"), F.lit("events").alias("table"), k.alias("lsn"), k.alias("txId"))
    value = F.to_json(F.struct(schema.alias("schema"), F.struct(after.alias("after"), source.alias("source"), F.lit("c").alias("op"), k.alias("ts_ms")).alias("payload")))
    rows = read(spark, sf_dir, "events").select("event_id", F.to_json(F.struct(k.alias("id"))).alias("key"), value.alias("value"))
    out = envelopes.events(envelopes.payloads(rows)).where("problem is null and key_cols[0] = 'id'")
    return out.select("event_id", F.array_join(F.transform("cols", lambda c: c["type"]), ",").alias("types"), F.concat_ws("|", *(F.col("vals")[n] for n in (0, 1, 3, 4, 5, 6))).alias("shown"))
