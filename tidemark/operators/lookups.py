"""Look-ups between changes, catalogs, definitions and out-of-line values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top_transaction(rows: DataFrame, assignments: DataFrame) -> DataFrame:
    """rows (xid) with top_xid: the parent of a sub-transaction, else itself. assignments: subxid, top_xid."""
    known = assignments.groupBy("subxid").agg(F.min("top_xid").alias("_top"))
    return rows.join(known, rows["xid"] == known["subxid"], "left").drop("subxid").withColumn("top_xid", F.coalesce("_top", "xid")).drop("_top")


def resolve_relation(rows: DataFrame, classes: DataFrame, namespaces: DataFrame, attributes: DataFrame) -> DataFrame:
    """rows (node) with schema, tbl and columns: found by file node, else by oid."""
    named = classes.join(namespaces.select(F.col("oid").alias("namespace"), F.col("name").alias("schema")), "namespace", "left").select("oid", "filenode", "schema", "tbl")
    by_node = named.select(F.col("filenode").alias("node"), F.struct("oid", "schema", "tbl").alias("_n"))
    by_oid = named.select(F.col("oid").alias("node"), F.struct("oid", "schema", "tbl").alias("_o"))
    found = rows.join(by_node, "node", "left").join(by_oid, "node", "left").withColumn("_r", F.coalesce("_n", "_o"))
    columns = attributes.where("attnum > 0").groupBy(F.col("rel_oid").alias("oid")).agg(F.sort_array(F.collect_list(F.struct("attnum", "name"))).alias("columns"))
    return found.select(*rows.columns, F.col("_r.oid").alias("oid"), F.col("_r.schema").alias("schema"), F.col("_r.tbl").alias("tbl")).join(columns, "oid", "left")


def joined_bytes(parts: str, data: str) -> Column:
    """The binary field of an array of structs, in its order, as one value: joined as hex text, so that each part is copied a
    fixed number of times however many there are."""
    return F.unhex(F.array_join(F.transform(parts, lambda p: F.hex(p[data])), ""))


def assemble_chunks(pointers: DataFrame, chunks: DataFrame) -> DataFrame:
    """pointers (value_id, size) with the whole value of their chunks (value_id, chunk_seq, data), or why there is none.

    A value's chunks are joined in their order; a missing chunk or a wrong size leaves the value out.
    """
    parts = F.sort_array(F.collect_list(F.struct("chunk_seq", "data")))
    whole = chunks.dropDuplicates(["value_id", "chunk_seq"]).groupBy("value_id").agg(parts.alias("_p"))
    data = joined_bytes("_p", "data")
    dense = F.element_at("_p", -1)["chunk_seq"] == F.size("_p") - 1
    joined = pointers.join(whole.select("value_id", data.alias("_d"), dense.alias("_dense")), "value_id", "left")
    ok = F.col("_dense") & (F.length("_d") == F.col("size"))
    problem = F.when(F.col("_d").isNull(), "no chunk").when(~F.col("_dense"), "missing chunk").when(F.length("_d") != F.col("size"), "wrong size")
    return joined.withColumn("value", F.when(ok, F.col("_d"))).withColumn("problem", problem).drop("_d", "_dense")


def merge_chunks(own: DataFrame, fetched: DataFrame) -> DataFrame:
    """Chunks of the stream and chunks fetched from the server; the latter win."""
    a, b = own.select("value_id", "chunk_seq", F.col("data").alias("_a")), fetched.select("value_id", "chunk_seq", F.col("data").alias("_b"))
    return a.join(b, ["value_id", "chunk_seq"], "full").select("value_id", "chunk_seq", F.coalesce("_b", "_a").alias("data"))


def with_definition(events: DataFrame, definitions: DataFrame) -> DataFrame:
    """File events with the table definition of their file."""
    return events.join(definitions, ["file", "def_id"], "left")


def with_catalog(columns: DataFrame, catalog: DataFrame) -> DataFrame:
    """Wire columns (rel_oid, name) with default, nullability and key membership by name."""
    return columns.join(catalog.select("rel_oid", "name", "default_expr", "nullable", "is_pk"), ["rel_oid", "name"], "left")


def base_types(types: DataFrame, depth: int = 64) -> DataFrame:
    """(oid, base_oid): domains resolved to what they are made of. types: oid, base (0 if none).

    Each turn doubles the steps covered. A type that isn't resolved after depth steps, one of a cycle or of a longer chain, has
    a null base instead of a wrong one.
    """
    resolved = types.select("oid", F.when(F.col("base") != 0, F.col("base")).otherwise(F.col("oid")).alias("base_oid"))
    steps = 1
    while steps < depth:
        above = resolved.select(F.col("oid").alias("base_oid"), F.col("base_oid").alias("_up"))
        resolved = resolved.join(above, "base_oid", "left").select("oid", F.coalesce("_up", "base_oid").alias("base_oid"))
        steps *= 2
    derived = types.where("base <> 0").select(F.col("oid").alias("base_oid"), F.lit(True).alias("_derived"))
    return resolved.join(derived, "base_oid", "left").select("oid", F.when(F.col("_derived").isNull(), F.col("base_oid")).alias("base_oid"))
