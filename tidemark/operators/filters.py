"""Which messages, tables, columns and partitions take part."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Schemas of the server itself.
SYSTEM_SCHEMAS = ("pg_catalog", "information_schema", "pg_toast")
LIFECYCLE = ("B", "C", "S", "E", "c", "A", "b", "P", "p", "K", "r")


def publication(df: DataFrame, tables: list[str], schema: str = "schema", table: str = "tbl") -> DataFrame:
    """Rows of the listed schema.table names; an empty list lets all pass."""
    return df.where(F.concat_ws(".", schema, table).isin(*tables)) if tables else df


def semi_filter(df: DataFrame, allowed: DataFrame, on: list[str]) -> DataFrame:
    """The same for lists that are tables themselves."""
    return df.join(allowed.select(*on).distinct(), on, "left_semi")


def user_table(relkind: Column, schema: Column) -> Column:
    """Ordinary and partitioned tables outside the server's schemas."""
    return relkind.isin("r", "p") & ~schema.isin(*SYSTEM_SCHEMAS) & ~schema.rlike("^pg_(temp|toast_temp)_")


def system_table(schema: Column) -> Column:
    return schema.isin(*SYSTEM_SCHEMAS)


def included(name: Column, include: list[str] | None = None, exclude: list[str] | None = None) -> Column:
    """Whole-name patterns, without regard to case: any of include, if there are some, and none of exclude."""
    any_of = lambda patterns: reduce(lambda a, b: a | b, (name.rlike(f"(?i)^(?:{p})$") for p in patterns))
    ok = any_of(include) if include else F.lit(True)
    return ok & ~any_of(exclude) if exclude else ok


def columns_kept(row: Column, include: list[str] | None = None, exclude: list[str] | None = None) -> Column:
    """A row map with the columns that pass."""
    return F.map_filter(row, lambda k, _: included(k, include, exclude))


def with_partition_parent(rows: DataFrame, partitions: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows of a partition under its parent's name. partitions: filenode, parent_oid, part_name; classes: oid, schema, tbl."""
    known = partitions.join(classes.select(F.col("oid").alias("parent_oid"), F.col("schema").alias("parent_schema"), F.col("tbl").alias("parent_tbl")), "parent_oid", "left")
    return rows.join(known, "filenode", "left")


def partition_filter(rows: DataFrame, tables: list[str]) -> DataFrame:
    """The parent's name or the partition's own name may be listed."""
    parent, part = F.concat_ws(".", "parent_schema", "parent_tbl"), F.concat_ws(".", "parent_schema", "part_name")
    return rows.where(parent.isin(*tables) | part.isin(*tables)) if tables else rows


def partition_semi_filter(rows: DataFrame, allowed: DataFrame, name: str) -> DataFrame:
    """The same for a list that is a table with a column of schema.table names: rows pass once, whichever name is listed."""
    listed = allowed.select(F.col(name).alias("_listed")).distinct()
    parent, part = F.concat_ws(".", "parent_schema", "parent_tbl"), F.concat_ws(".", "parent_schema", "part_name")
    by_parent = rows.withColumn("_name", parent).join(listed, F.col("_name") == F.col("_listed"), "left_semi")
    by_part = rows.withColumn("_name", parent).join(listed, F.col("_name") == F.col("_listed"), "left_anti")
    return by_parent.unionByName(by_part.withColumn("_name", part).join(listed, F.col("_name") == F.col("_listed"), "left_semi")).drop("_name")


def partition_misses(rows: DataFrame, partitions: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows whose partition or whose partition's parent isn't known."""
    complete = partitions.join(classes.select(F.col("oid").alias("parent_oid")), "parent_oid", "left_semi")
    return rows.join(complete.select("filenode"), "filenode", "left_anti")


def table_meta(attributes: DataFrame, type_map: dict[int, int] | None = None) -> DataFrame:
    """(rel_oid, columns): columns in order, dropped ones with a null name, types remapped."""
    oid = F.col("type_oid")
    for old, new in (type_map or {}).items():
        oid = F.when(F.col("type_oid") == old, F.lit(new)).otherwise(oid)
    item = F.struct("attnum", F.when(~F.col("dropped"), F.col("name")).alias("name"), oid.alias("type_oid"))
    return attributes.where("attnum > 0").groupBy("rel_oid").agg(F.sort_array(F.collect_list(item)).alias("columns"))


def lifecycle(kind: Column) -> Column:
    return kind.isin(*LIFECYCLE)


def skipped(op: Column, skip: list[str] | None = None) -> Column:
    """Operations left out; truncates unless stated otherwise."""
    return op.isin(*(["t"] if skip is None else skip)) if skip is None or skip else F.lit(False)


def not_yet_applied(end: Column, applied: Column) -> Column:
    return end > F.coalesce(applied, F.lit(0))


def before_lsn(lsn: Column, limit: Column | int | None) -> Column:
    return F.lit(True) if limit is None else lsn < limit


def storage_problem(reloptions: Column, parttype: Column, reldelta: Column) -> Column:
    """Why a table's storage can't be decoded, or null."""
    return F.when(reloptions.rlike("(?i)orientation=column"), "column store").when(reloptions.rlike("(?i)storage_type=ustore"), "in-place update store").when(F.coalesce(reldelta, F.lit(0)) != 0, "delta table").when(parttype.isNotNull() & ~parttype.isin("n", "p"), "partition type")


def admitted_partition_type(parttype: Column) -> Column:
    return parttype.isin("r", "p")


def without_parents(oids: Column, parents: Column) -> Column:
    """A truncate's list of tables without partitioned parents."""
    return F.filter(oids, lambda o: ~F.array_contains(parents, o))


def case_clashes(columns: DataFrame, keys: list[str], name: str = "name") -> DataFrame:
    """Relations whose column names differ only by case."""
    return columns.groupBy(*keys, F.lower(name).alias("lower_name")).agg(F.count_distinct(name).alias("n")).where("n > 1")


def key_columns(catalog_keys: Column, wire_columns: Column) -> Column:
    return F.array_intersect(catalog_keys, wire_columns)


def primary_key(primary: Column, unique: Column) -> Column:
    """The primary key, else a unique index."""
    return F.when(F.size(primary) > 0, primary).otherwise(unique)


def changed(before: Column, after: Column) -> Column:
    """Whether an update changes anything."""
    return ~before.eqNullSafe(after)


def compatible(mode: str, allowed: tuple[str, ...] = ("PG", "A", "B")) -> str:
    """A database's compatibility mode, or an error."""
    if mode not in allowed:
        raise ValueError(f"compatibility mode {mode} is not supported")
    return mode
