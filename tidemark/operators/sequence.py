"""Operators on totally ordered streams.

A window over a whole stream would run in one task. Everything here cuts a stream into chunks of sequence numbers, works within
the chunks in parallel, and carries one row per chunk across: a stream with a single slot still uses the whole cluster.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Sequence numbers per chunk.
CHUNK = 1 << 16


def _chunked(df: DataFrame, seq: str, chunk: int) -> DataFrame:
    return df.withColumn("_chunk", F.floor(F.col(seq) / chunk))


def carry_last(df: DataFrame, value: Column, out: str, by: list[str], seq: str = "seq", chunk: int = CHUNK, before: bool = False) -> DataFrame:
    """The latest value that isn't null at each row (with before: strictly before it), per stream."""
    return carry_all(df, {out: value}, by, seq, chunk, before)


def carry_all(df: DataFrame, values: dict[str, Column], by: list[str], seq: str = "seq", chunk: int = CHUNK, before: bool = False) -> DataFrame:
    """The same for several values, in one pass."""
    names = {out: (f"_value{k}", f"_end{k}", f"_carried{k}") for k, out in enumerate(values)}
    rows = _chunked(df.withColumns({names[out][0]: value for out, value in values.items()}), seq, chunk)
    own = Window.partitionBy(*by, "_chunk").orderBy(seq).rowsBetween(Window.unboundedPreceding, -1 if before else 0)
    # A chunk without a value of its own still hands on: the next chunk that has rows asks for the last end before it.
    ends = rows.groupBy(*by, "_chunk").agg(*(F.max_by(v, F.when(F.col(v).isNotNull(), F.col(seq))).alias(e) for v, e, _ in names.values()))
    earlier = Window.partitionBy(*by).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*by, "_chunk", *(F.last(e, True).over(earlier).alias(c) for _, e, c in names.values()))
    joined = rows.join(carried, [*by, "_chunk"], "left")
    out = joined.withColumns({o: F.coalesce(F.last(v, True).over(own), c) for o, (v, _, c) in names.items()})
    return out.drop("_chunk", *(x for v, _, c in names.values() for x in (v, c)))


def running_sum(df: DataFrame, value: Column, out: str, by: list[str], seq: str = "seq", chunk: int = CHUNK, before: bool = False) -> DataFrame:
    """The sum of value up to each row (with before: excluding it), per stream. The first row of a stream has 0 before it."""
    rows = _chunked(df.withColumn("_value", F.coalesce(value.cast("long"), F.lit(0).cast("long"))), seq, chunk)
    own = Window.partitionBy(*by, "_chunk").orderBy(seq).rowsBetween(Window.unboundedPreceding, -1 if before else 0)
    sums = rows.groupBy(*by, "_chunk").agg(F.sum("_value").alias("_sum"))
    earlier = Window.partitionBy(*by).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.withColumn("_carried", F.coalesce(F.sum("_sum").over(earlier), F.lit(0))).select(*by, "_chunk", "_carried")
    joined = rows.join(carried, [*by, "_chunk"], "left")
    return joined.withColumn(out, (F.coalesce(F.sum("_value").over(own), F.lit(0)) + F.col("_carried")).cast("long")).drop("_value", "_carried", "_chunk")


def index_runs(df: DataFrame, by: list[str], seq: str = "seq", chunk: int = CHUNK) -> DataFrame:
    """Runs of consecutive sequence numbers: (by, first_seq, last_seq, n)."""
    rows = df.select(*by, seq).distinct()
    previous = carry_last(rows, F.col(seq), "_previous", by, seq, chunk, before=True)
    starts = F.when(F.col("_previous").isNull() | (F.col("_previous") != F.col(seq) - 1), 1).otherwise(0)
    numbered = running_sum(previous, starts, "_run", by, seq, chunk)
    return numbered.groupBy(*by, "_run").agg(F.min(seq).alias("first_seq"), F.max(seq).alias("last_seq"), F.count(F.lit(1)).alias("n")).drop("_run")


def as_of_join(left: DataFrame, versions: DataFrame, key: str, seq: str, value: str, out: str, chunk: int = CHUNK) -> DataFrame:
    """left with the value of the latest version of its key whose sequence number is not larger; null where there is none.

    Both sides are merged and carried forward, so nothing is multiplied and no range is joined; a version stands before a row
    with the same number.
    """
    columns = left.columns
    rows = left.withColumn("_version", F.lit(None).cast(versions.schema[value].dataType)).withColumn("_row", F.lit(1))
    marks = versions.select(*(F.col(c) if c in (key, seq) else F.lit(None).cast(left.schema[c].dataType).alias(c) for c in columns), F.col(value).alias("_version"), F.lit(0).alias("_row"))
    both = rows.unionByName(marks).withColumn("_at", F.col(seq) * 2 + F.col("_row"))
    return carry_last(both, F.col("_version"), out, [key], "_at", chunk * 2).where("_row = 1").select(*columns, out)


def versions_for(units: DataFrame, versions: DataFrame, key: str, owner: str, seq: str = "seq") -> DataFrame:
    """(owner, key, n_versions, latest): the version prefix that a transaction needs of every key it touches, up to its last unit.

    A prefix is told by its length and its last version, so a key's history is never repeated for each transaction; rows of it
    are versions numbered (running_sum) up to n_versions. Keys without a version by then have no row.
    """
    numbered = running_sum(versions.select(key, seq), F.lit(1), "_n", [key], seq).withColumn("_prefix", F.struct(F.col("_n").alias("n_versions"), F.col(seq).alias("latest")))
    touched = units.groupBy(owner).agg(F.max(seq).alias(seq)).join(units.select(owner, key).distinct(), owner)
    return as_of_join(touched, numbered, key, seq, "_prefix", "_prefix").where("_prefix is not null").select(owner, key, "_prefix.*")


def prune_versions(versions: DataFrame, key: str, low: Column, seq: str = "seq") -> DataFrame:
    """Without versions that no live sequence number can need: per key, those before the one in force at the low-water mark."""
    in_force = versions.where(F.col(seq) <= low).groupBy(key).agg(F.max(seq).alias("_force"))
    return versions.join(in_force, key, "left").where(F.col("_force").isNull() | (F.col(seq) >= F.col("_force"))).drop("_force")


def latest_by_key(changes: DataFrame, keys: list[str], seq: str = "seq", removed: Column | None = None) -> DataFrame:
    """The last row of each key; keys whose last row is a removal are gone. Aggregated partially, no sort."""
    rest = [c for c in changes.columns if c not in keys]
    gone = F.lit(False) if removed is None else F.coalesce(removed, F.lit(False))
    last = changes.withColumn("_gone", gone).groupBy(*keys).agg(F.max_by(F.struct(*rest, "_gone"), seq).alias("_last"))
    return last.where("not _last._gone").select(*keys, *(F.col(f"_last.{c}").alias(c) for c in rest))


def table_ids(definitions: DataFrame, columns: list[str], seq: str = "seq") -> DataFrame:
    """Distinct definitions with ids in order of first appearance."""
    first = definitions.groupBy(*columns).agg(F.min(seq).alias("first_seq"))
    return first.withColumn("def_id", F.row_number().over(Window.orderBy("first_seq")).cast("int"))
