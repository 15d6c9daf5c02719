"""JSON envelopes of change records read back: transaction marks, and events with typed columns for change files.

A record's value is the envelope itself, or {"schema", "payload"} where the schema names the fields of the images with their
type and, for times, their semantic name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIELD = "struct<field: string, type: string, name: string, fields: array<struct<field: string, type: string, name: string>>>"
PAYLOAD = (
    "struct<before: map<string, string>, after: map<string, string>, source: struct<db: string, schema: string, table: string, lsn: long, txId: long>, op: string, ts_ms: long, status: string, id: string, "
    "event_count: long, transaction: struct<id: string, total_order: long, data_collection_order: long>>"
)
OPS = {"c": "CREATE", "u": "UPDATE", "d": "DELETE", "r": "READ"}
# Column types of change files by the schema's type, and for times by its semantic name.
TYPES = {"boolean": "BOOL", "int8": "INT", "int16": "INT", "int32": "INT", "int64": "INT", "float": "FLOAT32", "float32": "FLOAT32", "double": "FLOAT64", "float64": "FLOAT64", "string": "STRING", "bytes": "BYTES"}
TIMES = {
    "Timestamp": "TIMESTAMP", "MicroTimestamp": "TIMESTAMP", "NanoTimestamp": "TIMESTAMP", "ZonedTimestamp": "TIMESTAMPTZ", "ZonedTime": "TIMESTAMPTZ", "Date": "DATE", "Time": "TIME", "MicroTime": "TIME", "NanoTime": "TIME",
    "MicroDuration": "INTERVAL",
}


def _choose(key: Column, by: dict[str, object], otherwise: Column) -> Column:
    out = otherwise
    for k, v in by.items():
        out = F.when(key == k, v if isinstance(v, Column) else F.lit(v)).otherwise(out)
    return out


def _time_text(kind: Column, raw: Column) -> Column:
    """Numbers of a semantic time as text; texts stay."""
    n = raw.try_cast("long")
    stamp = lambda us: F.date_format(F.timestamp_micros(us), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    clock = lambda us: F.substring(stamp(us), 12, 15)
    shown = {
        "Date": F.date_add(F.lit("1970-01-01").cast("date"), n.cast("int")).cast("string"), "Time": clock(n * 1000), "MicroTime": clock(n), "NanoTime": clock(F.floor(n / 1000)), "Timestamp": stamp(n * 1000), "MicroTimestamp": stamp(n),
        "NanoTimestamp": stamp(F.floor(n / 1000)), "MicroDuration": F.concat(n.cast("string"), F.lit(" microseconds")),
    }
    return _choose(kind, shown, raw)


def payloads(records: DataFrame, value: str = "value") -> DataFrame:
    """records with the columns envelope (its payload) and fields (of the images: name, type; null without a schema)."""
    whole = F.from_json(value, f"struct<payload: {PAYLOAD}, schema: struct<fields: array<{FIELD}>>>")
    at = records.withColumn("_whole", whole)
    images = F.filter(F.col("_whole.schema.fields"), lambda f: f["field"].isin("after", "before") & f["fields"].isNotNull())
    semantic = lambda f: F.element_at(F.split(f["name"], r"\."), -1)
    kind = lambda f: F.when(f["name"].rlike(r"\.time\.") & semantic(f).isin(*TIMES), _choose(semantic(f), TIMES, F.lit(None))).otherwise(_choose(f["type"], TYPES, F.lit(None)))
    fields = F.transform(F.get(images, F.lit(0))["fields"], lambda f: F.struct(f["field"].alias("name"), kind(f).alias("type"), semantic(f).alias("semantic")))
    plain = F.from_json(value, PAYLOAD)
    return at.withColumns({"envelope": F.coalesce(F.col("_whole.payload"), plain), "fields": fields}).drop("_whole")


def is_transaction(envelope: str = "envelope") -> Column:
    """Begin and end marks: a status and an id, and no operation."""
    e = F.col(envelope)
    return e["status"].isNotNull() & e["id"].isNotNull() & e["op"].isNull()


def transactions(read: DataFrame) -> DataFrame:
    """(begins, id, event_count, ts_ms) of the marks among payloads(); -1 for counts and times that aren't known."""
    e = F.col("envelope")
    return read.where(is_transaction()).select((e["status"] == "BEGIN").alias("begins"), e["id"].alias("id"), F.coalesce(e["event_count"], F.lit(-1)).alias("event_count"), F.coalesce(e["ts_ms"], F.lit(-1)).alias("ts_ms"))


def events(read: DataFrame, key: str = "key") -> DataFrame:
    """Change events of payloads(): db, schema, tbl, key_cols, cols, vals, op, is_truncate, lsn, txid, ts_ms, transaction, and
    problem where an envelope lacks its image, has an unknown operation or a type that has no place in change files.

    The image is the old row of deletes (the new one if there is none), else the new row; without a schema all its columns are
    texts in order of their names.
    """
    e = F.col("envelope")
    rows = read.where(~is_transaction())
    image = F.when(e["op"] == "d", F.coalesce(e["before"], e["after"])).when(e["op"] == "t", F.coalesce(e["before"], e["after"])).otherwise(e["after"])
    rows = rows.withColumn("_image", image)
    named = F.transform(F.sort_array(F.map_keys("_image")), lambda k: F.struct(k.alias("name"), F.lit("STRING").alias("type"), F.lit(None).cast("string").alias("semantic")))
    rows = rows.withColumn("_cols", F.coalesce("fields", named, F.array().cast("array<struct<name: string, type: string, semantic: string>>")))
    truncate = e["op"] == "t"
    value = lambda c: _time_text(F.coalesce(c["semantic"], F.lit("")), F.element_at("_image", c["name"]))
    problem = (
        F.when(truncate, F.lit(None).cast("string")).when(~e["op"].isin(*OPS) | e["op"].isNull(), "unknown operation").when(F.col("_image").isNull(), "no image").when(F.exists("_cols", lambda c: c["type"].isNull()), "unknown column type")
    )
    keys = F.coalesce(F.map_keys(F.from_json(key, "map<string, string>")), F.array().cast("array<string>"))
    return rows.select(
        *(c for c in read.columns if c not in ("envelope", "fields", "_image", "_cols")), e["source"]["db"].alias("db"), e["source"]["schema"].alias("schema"), e["source"]["table"].alias("tbl"), keys.alias("key_cols"),
        F.transform("_cols", lambda c: F.struct(c["name"].alias("name"), c["type"].alias("type"))).alias("cols"), F.when(truncate, F.array().cast("array<string>")).otherwise(F.transform("_cols", value)).alias("vals"),
        F.when(~truncate, _choose(e["op"], OPS, F.lit(None))).alias("op"), truncate.alias("is_truncate"), F.coalesce(e["source"]["lsn"], F.lit(0)).alias("lsn"), F.coalesce(e["source"]["txId"], F.lit(0)).alias("txid"),
        F.coalesce(e["ts_ms"], F.lit(0)).alias("ts_ms"), e["transaction"].alias("transaction"), problem.alias("problem"),
    )
