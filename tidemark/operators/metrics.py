"""Throughput, distributions, lag and census, in batch and on streams alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .assembly import open_transactions
from .lookups import joined_bytes

def counters(df: DataFrame, by: list[str], kind: str = "kind", size: Column | None = None) -> DataFrame:
    """Cumulative counts: messages, rows, transactions, and bytes where a size is known."""
    k = F.col(kind)
    out = [F.count(F.lit(1)).alias("messages"), F.count_if(k.isin("I", "U", "D")).alias("rows"), F.count_if(k.isin("C", "c", "K")).alias("transactions")]
    if size is not None:
        out.append(F.sum(size).cast("long").alias("bytes"))
    return df.groupBy(*by).agg(*out)


def tumbling_rate(df: DataFrame, ts: str, seconds: int, by: list[str] | None = None) -> DataFrame:
    """(start, n, per_second) of each interval."""
    grouped = df.groupBy(F.window(ts, f"{seconds} seconds").alias("w"), *(by or [])).agg(F.count(F.lit(1)).alias("n"))
    return grouped.select(*(by or []), F.col("w.start").alias("start"), "n", (F.col("n") / seconds).alias("per_second"))


def rates_from_totals(totals: DataFrame, at: str, total: str, by: list[str]) -> DataFrame:
    """Rates between successive cumulative figures."""
    order = Window.partitionBy(*by).orderBy(at)
    elapsed, delta = F.col(at) - F.lag(at).over(order), F.col(total) - F.lag(total).over(order)
    return totals.withColumn("rate", F.when(elapsed > 0, delta / elapsed))


def peak(df: DataFrame, ts: str, unit: str, by: list[str]) -> DataFrame:
    """The largest count of any interval, open ones included."""
    return df.groupBy(*by, F.date_trunc(unit, ts).alias("_b")).agg(F.count(F.lit(1)).alias("n")).groupBy(*by).agg(F.max("n").alias("peak"))


def two_digits(value: Column) -> Column:
    """Rounded to two significant digits, as a histogram with that precision reports."""
    size = F.pow(F.lit(10.0), F.floor(F.log10(F.abs(value))) - 1)
    return F.when(value == 0, F.lit(0.0)).otherwise(F.round(value / size) * size)


def _digits(value: str) -> list[Column]:
    """two_digits of p90, p95 and max, over rows with two_digits of the value as _two. Rounding keeps the order, so the percentile
    of rounded values is the rounded percentile, and what is held is a count for each (91 a decade), whatever the volume."""
    q = lambda p: F.expr(f"percentile_disc({p}) within group (order by _two)")
    return [q("0.9d").alias("p90"), q("0.95d").alias("p95"), two_digits(F.max(value)).alias("max")]


def distribution(df: DataFrame, value: str, by: list[str], exact: bool = False) -> DataFrame:
    """p90, p95 and max. The default gives them with two significant digits, from a histogram of such values, which is exact and
    suits any volume; the exact form holds all distinct values of a group."""
    if exact:
        return df.groupBy(*by).agg(F.percentile(value, F.lit(0.9)).alias("p90"), F.percentile(value, F.lit(0.95)).alias("p95"), F.max(value).alias("max"))
    return df.withColumn("_two", two_digits(F.col(value))).groupBy(*by).agg(*_digits(value))


def interval_distribution(df: DataFrame, ts: str, seconds: int, value: str, by: list[str] | None = None) -> DataFrame:
    """(start, n, p90, p95, max) of each interval, with two significant digits: what a status line reports. Histograms of such
    values, so exact and for any volume; on a stream, behind a watermark, intervals come out as they close."""
    grouped = df.withColumn("_two", two_digits(F.col(value))).groupBy(F.window(ts, f"{seconds} seconds").alias("w"), *(by or [])).agg(F.count(F.lit(1)).alias("n"), *_digits(value))
    return grouped.select(*(by or []), F.col("w.start").alias("start"), "n", "p90", "p95", "max")


def session_maximum(df: DataFrame, value: str, at: str, by: list[str]) -> DataFrame:
    """The largest value so far at each report."""
    return df.withColumn("session_max", F.max(value).over(Window.partitionBy(*by).orderBy(at).rowsBetween(Window.unboundedPreceding, 0)))


def lag_bytes(received: Column, confirmed: Column) -> Column:
    return F.greatest(received - confirmed, F.lit(0))


def pending(messages: DataFrame) -> DataFrame:
    """(slot, pending_prepared, open_units): prepared transactions without a decision, and units not put out yet, which is what
    the pipe still holds."""
    prepared = messages.where(F.col("kind").isin("P", "p")).groupBy("slot").agg(F.count(F.lit(1)).alias("_p"))
    decided = messages.where(F.col("kind").isin("K", "r")).groupBy("slot").agg(F.count(F.lit(1)).alias("_d"))
    units = open_transactions(messages).groupBy("slot").agg(F.sum("n_units").alias("_u"))
    out = messages.select("slot").distinct().join(prepared, "slot", "left").join(decided, "slot", "left").join(units, "slot", "left").fillna(0, ["_p", "_d", "_u"])
    return out.select("slot", (F.col("_p") - F.col("_d")).alias("pending_prepared"), F.col("_u").alias("open_units"))


def census(records: DataFrame, rmid: str = "rmid", info: str = "info") -> DataFrame:
    """Records by resource manager and operation."""
    return records.groupBy(rmid, F.col(info).bitwiseAND(0xF0).alias("op")).agg(F.count(F.lit(1)).alias("n"))


def top_forms(counts: DataFrame, n: int = 3) -> DataFrame:
    """The most frequent forms, for a status line."""
    return counts.orderBy(F.desc("n"), *[c for c in counts.columns if c != "n"]).limit(n)


def stream_health(pages: DataFrame) -> DataFrame:
    """Totals of what a reader had to mend: resyncs, orphans, zero pages, reconnects."""
    return pages.agg(*(F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("resyncs", "orphans", "zero_pages", "reconnects")))


def file_digest(records: DataFrame, file: str, order: str, content: str) -> DataFrame:
    """(file, n, crc32) over a file's records in their order; one file's records are one file's size."""
    parts = records.groupBy(file).agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list(F.struct(order, content))).alias("_p"))
    return parts.select(file, "n", F.crc32(joined_bytes("_p", content)).alias("crc32"))
