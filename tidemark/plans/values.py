"""Scalar functions, filters and renderings over the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import binary, render, sql_text, typed
from ..operators import filters
from .message_log import read
from .registry import query


@query("select o_orderkey, to_hex(o_orderkey * 1000003 // 4294967296) || '/' || to_hex((o_orderkey * 1000003) % 4294967296) as lsn, o_orderkey * 1000003 as parsed from orders")
def lsn_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LSN text and back."""
    text = binary.lsn_text(F.col("o_orderkey") * 1000003)
    return read(spark, sf_dir, "orders").select("o_orderkey", text.alias("lsn"), binary.lsn_parse(text).alias("parsed"))


@query("select event_id, 'I' as kind, case when event_id % 2 = 0 then user_id end as xid, event_id as oid from events")
def header_peeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kind, transaction id and relation read from message bytes without decoding."""
    four = lambda c: F.lpad(F.hex(c), 8, "0")
    events = read(spark, sf_dir, "events")
    in_stream = F.col("event_id") % 2 == 0
    raw = F.unhex(F.concat(F.lit("49"), F.when(in_stream, four(F.col("user_id"))).otherwise(""), four(F.col("event_id")), F.lit("4E0000")))
    return events.select("event_id", raw.alias("raw")).select("event_id", binary.kind(F.col("raw")).alias("kind"), binary.peek_xid(F.col("raw"), in_stream).alias("xid"), binary.peek_oid(F.col("raw"), in_stream).alias("oid"))


@query("select s_suppkey, case when s_suppkey % 2 = 1 then 't' else 'f' end as b, -s_suppkey as i, '\\x' || lower(hex(encode(s_name))) as bytes, '0x' || lower(hex(encode(s_name))) as unknown from supplier".replace("'\\x'", "'\\x'"))
def binary_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binary values as text: bool, integers, bytea, unknown types (V2, V8)."""
    s = read(spark, sf_dir, "supplier")
    flag, number = F.unhex(F.when(F.col("s_suppkey") % 2 == 1, "01").otherwise("00")), F.unhex(F.hex(-F.col("s_suppkey")))
    raw = F.encode("s_name", "UTF-8")
    return s.select("s_suppkey", binary.bool_text(flag).alias("b"), binary.signed(number, 0, 8).alias("i"), binary.bytea_text(raw).alias("bytes"), binary.unknown_text(raw).alias("unknown"))


@query("select o_orderkey, cast(o_orderdate as date) as day, o_orderdate as at from orders")
def binary_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days and microseconds since 2000-01-01."""
    micros = F.unix_micros(F.col("o_orderdate").cast("timestamp")) - binary.EPOCH_US
    days = F.datediff(F.col("o_orderdate").cast("date"), F.lit("2000-01-01").cast("date"))
    return read(spark, sf_dir, "orders").select("o_orderkey", binary.pg_date(days).alias("day"), binary.pg_timestamp(micros).cast("timestamp_ntz").alias("at"))


@query("select p_partkey, case when p_size % 3 = 0 then 'numeric(' || (p_size + 5) || ',' || (p_size % 7) || ')' when p_size % 3 = 1 then 'varchar(' || p_size || ')' else 'int4' end as declared from part")
def typmod_expression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared types from type modifiers."""
    size = F.col("p_size")
    kind = F.when(size % 3 == 0, "numeric").when(size % 3 == 1, "varchar").otherwise("int4")
    typmod = F.when(size % 3 == 0, F.shiftleft((size + 5).cast("int"), 16).bitwiseOR((size % 7).cast("int")) + 4).when(size % 3 == 1, size.cast("int") + 4).otherwise(-1)
    return read(spark, sf_dir, "part").select("p_partkey", binary.type_expression(kind, typmod).alias("declared"))


@query("select o_orderkey, case when o_orderkey % 2 = 0 then o_orderkey else o_custkey * 4294967296 + o_orderkey end as txid from orders")
def txid_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transaction ids in text, plain and packed."""
    text = F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderkey").cast("string")).otherwise(F.concat_ws(":", "o_custkey", "o_orderkey"))
    return read(spark, sf_dir, "orders").select("o_orderkey", binary.txid_number(text).alias("txid"))


@query("""with h as (select c_custkey, list_reduce(list_prepend(cast(0 as bigint), list_transform(string_split(c_name, ''), lambda x: cast(ord(x) as bigint))), lambda h, x: (h * 31 + x) % 4294967296) as h from customer)
 select c_custkey, cast(case when h >= 2147483648 then h - 4294967296 else h end as int) as hash from h""")
def txid_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fallback hash of other ids."""
    return read(spark, sf_dir, "customer").select("c_custkey", binary.java_hash(F.col("c_name")).alias("hash"))


@query("""select o_orderkey, 'INSERT INTO "db"."orders" ("id", "status", "note", "price") VALUES (' || o_orderkey || ', ''' || o_orderstatus || ''', ' || case when o_orderkey % 3 = 0 then 'NULL' else '''it''''s ' || o_orderpriority || '''' end || ', ' || o_custkey || ');' as stmt from orders""")
def sql_insert_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """INSERT statements (K5, K6)."""
    note = F.when(F.col("o_orderkey") % 3 != 0, F.concat(F.lit("it's "), "o_orderpriority"))
    values = [sql_text.literal(c, t) for c, t in ((F.col("o_orderkey"), "INT"), (F.col("o_orderstatus"), "STRING"), (note, "STRING"), (F.col("o_custkey"), "INT"))]
    table = sql_text.table_name(F.lit("db"), F.lit("orders"))
    return read(spark, sf_dir, "orders").select("o_orderkey", sql_text.insert(table, ["id", "status", "note", "price"], values).alias("stmt"))


@query("""select o_orderkey, 'UPDATE "db"."orders" SET "id" = ' || o_orderkey || ', "status" = ''' || o_orderstatus || ''' WHERE "id" = ' || (o_orderkey - 1) || ';' as stmt from orders""")
def sql_update_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UPDATE by the former key (K6)."""
    key, status = sql_text.literal(F.col("o_orderkey"), "INT"), sql_text.literal(F.col("o_orderstatus"), "STRING")
    table = sql_text.table_name(F.lit("db"), F.lit("orders"))
    return read(spark, sf_dir, "orders").select("o_orderkey", sql_text.update(table, {"id": key, "status": status}, {"id": key}, {"id": sql_text.literal(F.col("o_orderkey") - 1, "INT")}).alias("stmt"))


@query("""select o_orderkey, 'DELETE FROM "db"."orders" WHERE "id" = ' || o_orderkey || ' AND "status" = ''' || o_orderstatus || ''';' as stmt from orders""")
def sql_delete_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DELETE by key (K6)."""
    keys = {"id": sql_text.literal(F.col("o_orderkey"), "INT"), "status": sql_text.literal(F.col("o_orderstatus"), "STRING")}
    return read(spark, sf_dir, "orders").select("o_orderkey", sql_text.delete(sql_text.table_name(F.lit("db"), F.lit("orders")), keys).alias("stmt"))


@query("""select n_regionkey, 'TRUNCATE TABLE ' || string_agg('"db"."' || n_name || '"', ', ' order by n_nationkey) || case when n_regionkey % 2 = 0 then ' RESTART IDENTITY' else '' end || case when n_regionkey > 2 then ' CASCADE' else '' end || ';' as stmt from nation group by 1""")
def sql_truncate_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TRUNCATE of several tables with options (K6)."""
    n = read(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.transform(F.sort_array(F.collect_list(F.struct("n_nationkey", sql_text.table_name(F.lit("db"), F.col("n_name")).alias("t")))), lambda x: x["t"]).alias("tables"))
    return n.select("n_regionkey", sql_text.truncate(F.col("tables"), F.col("n_regionkey") > 2, F.col("n_regionkey") % 2 == 0).alias("stmt"))


@query("""select event_id, case when event_type = 'error' then '-' else '' end || 'INTERVAL ''' || (event_id // 24) || ' days ' || lpad(cast(event_id % 24 as varchar), 2, '0') || ':00:' || lpad(cast(user_id % 60 as varchar), 2, '0') || '.' || lpad(cast(event_id % 999999 + 1 as varchar), 6, '0') || '''' as lit from events""")
def sql_interval_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intervals as literals, negative ones for errors (K6)."""
    micros = F.floor(F.col("event_id") / 24) * 86_400_000_000 + (F.col("event_id") % 24) * 3_600_000_000 + (F.col("user_id") % 60) * 1_000_000 + F.col("event_id") % 999_999 + 1
    return read(spark, sf_dir, "events").select("event_id", sql_text.interval_literal(F.when(F.col("event_type") == "error", -micros).otherwise(micros)).alias("lit"))


@query("select event_id, case when event_id % 3 <> 0 then event_type when event_id % 2 = 0 then '<unchanged-toast>' else 'old-' || event_type end as v from events")
def unchanged_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unchanged values taken from the old image."""
    state = F.when(F.col("event_id") % 3 == 0, "u").otherwise("t")
    old = F.when(F.col("event_id") % 2 == 0, "u").otherwise("t")
    return read(spark, sf_dir, "events").select("event_id", render.recovered(state, F.col("event_type"), old, F.concat(F.lit("old-"), "event_type")).alias("v"))


@query("""select doc_id, '[id=' || doc_id || ', text=' || case when length(text) > 64 then left(text, 64) || '...(' || strlen(text) || 'B)' else text end || ', #2=' || case when doc_id % 2 = 0 then 'null' else '<unchanged-toast>' end || ']' as line from documents""")
def tuple_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows printed, long values cut, surplus columns by number."""
    item = lambda s, t: F.struct(s.alias("state"), t.cast("string").alias("text"))
    values = F.array(item(F.lit("t"), F.col("doc_id")), item(F.lit("t"), F.col("text")), item(F.when(F.col("doc_id") % 2 == 0, "n").otherwise("u"), F.lit("")))
    return read(spark, sf_dir, "documents").select("doc_id", render.tuple_line(F.array(F.lit("id"), F.lit("text")), values).alias("line"))


@query("""select event_id, case event_type when 'signup' then 'COMMIT lsn=' || event_id || ' end=' || (event_id + 1) when 'error' then 'STREAM ABORT xid=' || user_id || ' subxid=' || (event_id % 4)
 else '[stream xid=' || user_id || '] ' || case event_type when 'view' then 'INSERT app.events [a=1]' when 'click' then 'UPDATE app.events [k=1] [a=1]' else 'DELETE app.events [k=1]' end end as line from events""")
def message_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of messages."""
    events = read(spark, sf_dir, "events")
    kind = F.expr("case event_type when 'signup' then 'C' when 'error' then 'A' when 'view' then 'I' when 'click' then 'U' else 'D' end")
    text = lambda c: c.cast("string")
    fields = {k: F.lit("") for k in ("gid", "first", "name", "prefix", "bytes")}
    fields |= {"xid": text(F.col("user_id")), "subxid": text(F.col("event_id") % 4), "lsn": text(F.col("event_id")), "end": text(F.col("event_id") + 1), "schema": F.lit("app"), "tbl": F.lit("events"), "old": F.lit("[k=1]"), "new": F.lit("[a=1]")}
    fields["stream_xid"] = F.when(F.col("event_type").isin("view", "click", "purchase"), text(F.col("user_id")))
    return events.select("event_id", render.message_line(kind, fields).alias("line"))


@query("select o_orderkey, '=== STREAMED xid=' || o_custkey || ' lsn=' || to_hex(o_orderkey // 4294967296) || '/' || to_hex(o_orderkey % 4294967296) || ' changes=' || (o_orderkey % 9) as line from orders")
def transaction_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header lines of transaction blocks."""
    return read(spark, sf_dir, "orders").select("o_orderkey", render.transaction_header(F.lit("STREAMED"), F.col("o_custkey"), binary.lsn_text(F.col("o_orderkey")), F.col("o_orderkey") % 9).alias("line"))


@query("select c_custkey, case when c_custkey % 2 = 0 then left(c_name || c_name || c_name || c_name || c_name, 64) || case when length(c_name) * 5 > 64 then '...' else '' end else '0x00' || lower(hex(encode(c_name))) end as p from customer")
def content_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Previews of readable and other content."""
    raw = F.when(F.col("c_custkey") % 2 == 0, F.encode(F.repeat("c_name", F.lit(5)), "UTF-8")).otherwise(F.concat(F.unhex(F.lit("00")), F.encode("c_name", "UTF-8")))
    return read(spark, sf_dir, "customer").select("c_custkey", render.preview(raw).alias("p"))


@query("""with k as (select o_orderkey, (o_orderkey // 1000) * 1000 as r, o_orderkey * 1024 as b from orders) select o_orderkey, case when r >= 1000000 then printf('%.2fM/s', r / 1e6) when r >= 1000 then printf('%.2fk/s', r / 1e3) else printf('%.2f/s', r::double) end as rate,
 case when b >= 1073741824 then 'big' when b >= 1048576 then 'MB' when b >= 1024 then printf('%.2fKB', b / 1024.0::double) else b || 'B' end as size from k""")
def figure_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates and sizes as text."""
    k, size = F.col("o_orderkey"), render.bytes_text(F.col("o_orderkey") * 1024)
    shown = F.when(size.endswith("GB"), "big").when(size.endswith("MB"), "MB").otherwise(size)
    return read(spark, sf_dir, "orders").select("o_orderkey", render.rate_text(F.floor(k / 1000) * 1000.0).alias("rate"), shown.alias("size"))


@query("select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as at from events")
def temporal_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wall clock text with microseconds."""
    return read(spark, sf_dir, "events").select("event_id", render.temporal_text(F.col("ts")).alias("at"))


@query("select o_orderkey, o_custkey, o_orderstatus, cast(o_orderdate as date) as day, o_custkey % 2 = 0 as flag from orders")
def typed_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row maps as typed columns."""
    item = lambda c: F.struct(F.lit("t").alias("state"), c.cast("string").alias("text"))
    row = F.create_map(F.lit("o_custkey"), item(F.col("o_custkey")), F.lit("o_orderstatus"), item(F.col("o_orderstatus")), F.lit("day"), item(F.date_format("o_orderdate", "yyyy-MM-dd")), F.lit("flag"), item(F.when(F.col("o_custkey") % 2 == 0, "t").otherwise("f")))
    changes = read(spark, sf_dir, "orders").select("o_orderkey", row.alias("after"))
    columns = [{"name": n, "type_oid": t} for n, t in (("o_custkey", 20), ("o_orderstatus", 25), ("day", 1082), ("flag", 16))]
    return typed.typed_view(changes, columns).drop("after")


@query("select o_orderkey, cast(o_custkey as varchar) as o_custkey, case when o_orderkey % 4 <> 0 then o_orderstatus end as o_orderstatus from orders")
def string_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with all values as strings; null and unchanged have none."""
    item = lambda c, s: F.struct(s.alias("state"), c.cast("string").alias("text"))
    row = F.create_map(F.lit("o_custkey"), item(F.col("o_custkey"), F.lit("t")), F.lit("o_orderstatus"), item(F.col("o_orderstatus"), F.when(F.col("o_orderkey") % 4 == 0, "u").otherwise("t")))
    changes = read(spark, sf_dir, "orders").select("o_orderkey", row.alias("after"))
    return typed.typed_view(changes, [{"name": "o_custkey", "type_oid": 20}, {"name": "o_orderstatus", "type_oid": 25}], as_string=True).drop("after")


@query("select p_partkey, cast(p_partkey as double) / 4 as d, cast(case when p_partkey % 2 = 0 then -p_partkey else p_partkey end as double) as m, case when p_partkey % 3 = 0 then null when p_partkey % 3 = 1 then 'it''s' else '42' end as def, cast(p_size as bigint) as b from part")
def typed_conversions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decimals, money, bit strings, defaults."""
    k = F.col("p_partkey")
    text = F.when(k % 2 == 0, F.concat(F.lit("($"), k.cast("string"), F.lit(".00)"))).otherwise(F.concat(F.lit("$"), k.cast("string"), F.lit(".00")))
    expression = F.when(k % 3 == 0, "nextval('s'::regclass)").when(k % 3 == 1, "'it''s'::character varying(10)").otherwise("42")
    return read(spark, sf_dir, "part").select("p_partkey", typed.decimal_mode((k / 4).cast("string"), "double").alias("d"), typed.money(text).cast("double").alias("m"), typed.default_value(expression).alias("def"), typed.bits(F.conv(F.col("p_size").cast("string"), 10, 2)).alias("b"))


@query("""select p_partkey, case when p_partkey % 2 = 0 then '-' else '' end || (p_partkey + 1) || repeat('0', 40) || '1234567' as unscaled, 7 as scale, cast(1 + p_partkey % 100 as bigint) as n_bits, cast(p_partkey % 256 as int) as low_byte,
 'a' || p_size || '|b.c|-|d"e,f' as paths, case p_partkey % 7 when 0 then '0,0;' || p_size || ',2' when 1 then '1,2;r3' when 2 then 'a1,b-2,c' || p_size when 3 then '1,2;3,4' when 4 then 'open 1,2;3,4;5,' || p_size when 5 then '1,2' else 'closed 0,0;1,0;1,1' end as shape from part""")
def unbounded_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decimals and bit strings of any length, label trees, geometric shapes."""
    k, size = F.col("p_partkey"), F.col("p_size").cast("string")
    big = typed.variable_decimal(F.concat(F.when(k % 2 == 0, "-").otherwise(""), (k + 1).cast("string"), F.lit("0" * 40 + ".1234567")))
    ones = F.concat(F.repeat(F.lit("0"), F.lit(92)), F.lpad(F.conv((k % 256).cast("string"), 10, 2), 8, "0"))
    raw = typed.bit_bytes(F.concat(F.repeat(F.lit("1"), (k % 100).cast("int")), F.lit("0")))
    low = F.conv(F.hex(F.substring(typed.bit_bytes(ones), 1, 1)), 16, 10).cast("int")
    paths = typed.text_array(F.concat(F.lit("{a"), size, F.lit(',b.c,NULL,"d\\"e,f"}')))
    texts = [F.concat(F.lit("("), size, F.lit(",2),(0,0)")), F.lit("<(1,2),3>"), F.concat(F.lit("{1,-2,"), size, F.lit("}")), F.lit("[(1,2),(3,4)]"), F.concat(F.lit("[(1,2),(3,4),(5,"), size, F.lit(")]")), F.lit("(1,2)"), F.lit("((0,0),(1,0),(1,1))")]
    kinds = ["box", "circle", "line", "lseg", "path", "point", "polygon"]
    point = lambda p: F.concat(p["x"].cast("long").cast("string"), F.lit(","), p["y"].cast("long").cast("string"))
    shape = F.lit(None).cast("string")
    for n, (text, kind) in enumerate(zip(texts, kinds, strict=True)):
        s = typed.geometric(text, kind)
        points = F.array_join(F.transform(F.sort_array(s["points"]) if kind == "box" else s["points"], point), ";")
        whole = lambda c, s=s: s[c].cast("long").cast("string")
        shown = {"circle": F.concat(points, F.lit(";r"), whole("radius")), "line": F.concat(F.lit("a"), whole("a"), F.lit(",b"), whole("b"), F.lit(",c"), whole("c"))}
        closed = F.when(s["closed"], "closed ").otherwise("open ") if kind in ("path", "polygon") else F.lit("")
        shape = F.when(k % 7 == n, shown.get(kind, F.concat(closed, points))).otherwise(shape)
    return read(spark, sf_dir, "part").select(
        "p_partkey", big["unscaled"].alias("unscaled"), big["scale"].alias("scale"), (F.length(raw) * 8 - F.pmod(-((k % 100) + 1), F.lit(8))).cast("long").alias("n_bits"), low.alias("low_byte"), F.array_join(F.transform(paths, lambda x: F.coalesce(x, F.lit("-"))), "|").alias("paths"), shape.alias("shape")
    )


@query("select p_partkey, cast(p_size as double) as x, -cast(p_partkey as double) as y, cast(p_size as varchar) as a, p_name as b, cast(4326 as int) as srid from part")
def structured_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points, hstore and EWKB."""
    p = typed.point(F.format_string("(%s,%s)", F.col("p_size").cast("string"), (-F.col("p_partkey")).cast("string")))
    h = typed.hstore_map(F.concat(F.lit('a=>"'), F.col("p_size").cast("string"), F.lit('", "b"=>"'), F.replace("p_name", F.lit('"'), F.lit('\\"')), F.lit('", c=>NULL')))
    shape = typed.ewkb(F.lit("0101000020E6100000000000000000F03F0000000000000040"))
    return read(spark, sf_dir, "part").select("p_partkey", p["x"].alias("x"), p["y"].alias("y"), h["a"].alias("a"), h["b"].alias("b"), shape["srid"].alias("srid"))


@query("select n_nationkey, n_regionkey in (0, 1) and n_name not like 'N%1' as kept, n_nationkey % 5 = 0 as sys from nation")
def table_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User tables, include and exclude patterns, system schemas."""
    kind = F.when(F.col("n_regionkey") == 0, "r").when(F.col("n_regionkey") == 1, "p").otherwise("i")
    schema = F.when(F.col("n_nationkey") % 5 == 0, "pg_catalog").otherwise("app")
    kept = filters.user_table(kind, F.lit("app")) & filters.included(F.col("n_name"), exclude=["N.*1"])
    return read(spark, sf_dir, "nation").select("n_nationkey", kept.alias("kept"), filters.system_table(schema).alias("sys"))


@query("select o_orderkey, case when o_orderkey % 2 = 0 then 'o_orderstatus' else 'o_orderpriority' end as only_key from orders")
def column_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row maps without excluded columns."""
    row = F.when(F.col("o_orderkey") % 2 == 0, F.create_map(F.lit("o_orderstatus"), "o_orderstatus", F.lit("secret_a"), F.lit("x"))).otherwise(F.create_map(F.lit("o_orderpriority"), "o_orderpriority", F.lit("secret_b"), F.lit("x")))
    return read(spark, sf_dir, "orders").select("o_orderkey", F.array_join(F.map_keys(filters.columns_kept(row, exclude=["secret_.*"])), ",").alias("only_key"))


@query("select event_id, event_type from events where event_type in ('signup', 'error') and event_id > (select max(event_id) // 20 from events) and event_id < (select max(event_id) - max(event_id) // 20 from events) and value <> user_id")
def stream_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lifecycle kinds, applied records, LSN bound, empty updates."""
    kind = F.when(F.col("event_type") == "signup", "C").when(F.col("event_type") == "error", "A").otherwise("I")
    events = read(spark, sf_dir, "events")
    reached = events.agg(F.max("event_id").alias("top")).select(F.floor(F.col("top") / 20).alias("applied"), (F.col("top") - F.floor(F.col("top") / 20)).alias("stop"))
    ok = filters.lifecycle(kind) & filters.not_yet_applied(F.col("event_id"), F.col("applied")) & filters.before_lsn(F.col("event_id"), F.col("stop")) & filters.changed(F.col("value"), F.col("user_id").cast("double"))
    return events.join(F.broadcast(reached)).where(ok).select("event_id", "event_type")


@query("select n_nationkey, case when n_regionkey = 0 then 'column store' when n_regionkey = 1 then 'in-place update store' when n_regionkey = 2 then 'delta table' when n_regionkey = 3 then 'partition type' end as problem from nation")
def storage_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables whose storage can't be decoded."""
    k = F.col("n_regionkey")
    options = F.when(k == 0, "orientation=column").when(k == 1, "storage_type=USTORE").otherwise("fillfactor=90")
    return read(spark, sf_dir, "nation").select("n_nationkey", filters.storage_problem(options, F.when(k == 3, "v").otherwise("n"), F.when(k == 2, 5).otherwise(0)).alias("problem"))


@query("select n_regionkey, string_agg(cast(n_nationkey as varchar), ',' order by n_nationkey) as oids from nation where n_nationkey % 6 <> 0 group by 1")
def truncate_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Truncate lists without partitioned parents."""
    n = read(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.sort_array(F.collect_list("n_nationkey")).alias("oids"), F.collect_list(F.when(F.col("n_nationkey") % 6 == 0, F.col("n_nationkey"))).alias("parents"))
    return n.select("n_regionkey", F.array_join(filters.without_parents(F.col("oids"), F.col("parents")), ",").alias("oids"))


@query("select c_nationkey as rel_oid, 'x' || (c_custkey % 10) as lower_name, count(distinct case when c_custkey % 20 < 10 then 'x' else 'X' end || (c_custkey % 10)) as n from customer group by 1, 2 having count(distinct case when c_custkey % 20 < 10 then 'x' else 'X' end || (c_custkey % 10)) > 1")
def case_clashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns that differ only by case."""
    rows = read(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("rel_oid"), F.concat(F.when(F.col("c_custkey") % 20 < 10, "x").otherwise("X"), (F.col("c_custkey") % 10).cast("string")).alias("name"))
    return filters.case_clashes(rows, ["rel_oid"])


@query("select n_nationkey, case when n_nationkey % 2 = 0 then 'id' else 'u' end as pk, case when n_nationkey % 3 = 0 then 'id' else '' end as wire_keys from nation")
def key_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Primary key or unique index, cut to the wire's columns."""
    none = F.array().cast("array<string>")
    k = F.col("n_nationkey")
    pk = filters.primary_key(F.when(k % 2 == 0, F.array(F.lit("id"))).otherwise(none), F.array(F.lit("u")))
    wire = filters.key_columns(F.array(F.lit("id")), F.when(k % 3 == 0, F.array(F.lit("id"), F.lit("v"))).otherwise(F.array(F.lit("v"))))
    return read(spark, sf_dir, "nation").select("n_nationkey", F.array_join(pk, ",").alias("pk"), F.array_join(wire, ",").alias("wire_keys"))


@query("select n_regionkey as rel_oid, string_agg(case when n_nationkey % 4 = 0 then '-' else n_name end, ',' order by n_nationkey) as names, string_agg(cast(case when n_nationkey % 5 = 1 then 25 else 20 end as varchar), ',' order by n_nationkey) as types from nation where n_nationkey > 0 group by 1")
def table_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of relations in order, dropped ones without a name, types remapped."""
    k = F.col("n_nationkey")
    attributes = read(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("rel_oid"), k.cast("int").alias("attnum"), F.col("n_name").alias("name"), F.when(k % 5 == 1, 9999).otherwise(20).alias("type_oid"), (k % 4 == 0).alias("dropped"))
    meta = filters.table_meta(attributes, {9999: 25})
    join = lambda f: F.array_join(F.transform("columns", lambda c: F.coalesce(c[f].cast("string"), F.lit("-"))), ",")
    return meta.select("rel_oid", join("name").alias("names"), join("type_oid").alias("types"))


@query("select o_orderkey, strftime(o_orderdate, '%d/%m/%Y %H') as at, left(o_orderpriority, 4) || case when length(o_orderpriority) > 4 then '...(' || strlen(o_orderpriority) || 'B)' else '' end as cut from orders")
def custom_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A caller's own time pattern and print limit."""
    return read(spark, sf_dir, "orders").select("o_orderkey", render.with_pattern(F.col("o_orderdate"), "dd/MM/yyyy HH").alias("at"), render.shown_value(F.lit("t"), F.col("o_orderpriority"), 4).alias("cut"))


@query("select p_partkey, p_partkey + p_size as total, case when p_size % 2 = 0 then 2 else 3 end as n from part")
def array_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Array texts as typed arrays, NULL elements kept."""
    text = F.concat(F.lit("{"), F.col("p_partkey").cast("string"), F.lit(","), F.col("p_size").cast("string"), F.when(F.col("p_size") % 2 == 0, "").otherwise(",NULL"), F.lit("}"))
    items = typed.typed_value(text, 1016)
    total = F.aggregate(items, F.lit(0).cast("long"), lambda a, x: a + F.coalesce(x, F.lit(0)))
    return read(spark, sf_dir, "part").select("p_partkey", total.alias("total"), F.size(items).alias("n"))


@query("select event_id, case event_id % 4 when 0 then timestamp '2024-01-02 03:04:05.5' when 1 then timestamp '2024-01-02 01:04:05' end as at, case when user_id % 2 = 0 then 'id=' || user_id else 'id=null' end as shown from events")
def row_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows as maps by column name, dropped columns gone; times in several text forms."""
    events = read(spark, sf_dir, "events")
    k = F.col("event_id") % 4
    text = F.when(k == 0, "2024-01-02 03:04:05.5").when(k == 1, "2024-01-02 03:04:05+02:00").when(k == 2, "0044-03-15 00:00:00 BC").otherwise("infinity")
    item = lambda s, t: F.struct(s.alias("state"), t.cast("string").alias("text"))
    values = F.array(item(F.when(F.col("user_id") % 2 == 0, "t").otherwise("n"), F.col("user_id")), item(F.lit("t"), F.lit("gone")))
    row = render.row_map(F.array(F.lit("id"), F.lit(None).cast("string")), values)
    shown = F.array_join(F.transform(F.map_entries(row), lambda e: F.concat(e["key"], F.lit("="), render.shown_value(e["value"]["state"], e["value"]["text"]))), ",")
    return events.select("event_id", typed.timestamp_text(text).cast("timestamp_ntz").alias("at"), shown.alias("shown"))


@query("""with t as (select event_id, event_id % 6 as k, event_id % 1000 as f, user_id % 28 + 1 as d from events) select event_id, cast(case k when 0 then epoch_us(timestamp '2024-01-02 03:04:05') + f * 1000 when 1 then epoch_us(timestamp '2024-01-02 01:04:05.25') when 2 then 9223372036854775807 when 3 then -9223372036854775807 - 1
 when 4 then epoch_us(cast('0044-03-' || lpad(cast(d as varchar), 2, '0') || ' (BC) 10:00:00' as timestamp)) else epoch_us(timestamp '20001-02-03 00:00:00') end as bigint) as us, case when k = 4 then cast(date_diff('day', date '1970-01-01', cast('0044-03-' || lpad(cast(d as varchar), 2, '0') || ' (BC)' as date)) as bigint) end as days from t""")
def far_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times with zones, fractions of any length, years before Christ and beyond 9999, and the two infinities."""
    k, f, d = F.col("event_id") % 6, F.lpad((F.col("event_id") % 1000).cast("string"), 3, "0"), F.lpad((F.col("user_id") % 28 + 1).cast("string"), 2, "0")
    text = F.when(k == 0, F.concat(F.lit("2024-01-02 03:04:05."), f)).when(k == 1, "2024-01-02 03:34:05.25+02:30").when(k == 2, "infinity").when(k == 3, "-infinity").when(k == 4, F.concat(F.lit("0044-03-"), d, F.lit(" 10:00:00 BC"))).otherwise("20001-02-03 00:00:00")
    return read(spark, sf_dir, "events").select("event_id", typed.timestamp_micros(text).alias("us"), F.when(k == 4, typed.date_days(F.concat(F.lit("0044-03-"), d, F.lit(" BC")))).alias("days"))


@query("select event_id, cast(((event_id % 24) * 3600 + user_id % 3600) * 1000000 as bigint) as us, cast(((((event_id % 24) * 3600 + user_id % 3600 - 9000) % 86400 + 86400) % 86400) * 1000000 as bigint) as utc from events")
def clock_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times of day, and those with a zone moved to UTC."""
    rest = F.col("user_id") % 3600
    two = lambda n: F.lpad(n.cast("string"), 2, "0")
    text = F.concat_ws(":", two(F.col("event_id") % 24), two(F.floor(rest / 60)), two(rest % 60))
    return read(spark, sf_dir, "events").select("event_id", typed.time_micros(text).alias("us"), typed.timetz_micros(F.concat(text, F.lit("+02:30"))).alias("utc"))
