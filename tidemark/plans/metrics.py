"""Counters, rates, distributions and census over events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import metrics
from .message_log import normal_messages, read
from .registry import query


@query("""select cast(0 as int) as slot, count(*) + sum(case when event_id % 7 = 0 then 1 else 0 end) + sum(case when event_id % 7 = 6 then 1 else 0 end) as messages, count(*) as rows, cast(sum(case when event_id % 7 = 6 then 1 else 0 end) as bigint) as transactions from events""".replace("count(*) + sum(case when event_id % 7 = 0 then 1 else 0 end) + sum(case when event_id % 7 = 6 then 1 else 0 end)", "cast(count(*) + sum(case when event_id % 7 in (0, 6) then 1 else 0 end) as bigint)"))
def throughput_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cumulative counters."""
    return metrics.counters(normal_messages(read(spark, sf_dir, "events")), ["slot"])


@query("select time_bucket(interval 10 second, ts, timestamp '1970-01-01') as start, count(*) as n, count(*) / 10.0::double as per_second from events group by 1")
def rate_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates of ten-second intervals."""
    return metrics.tumbling_rate(read(spark, sf_dir, "events"), "ts", 10)


@query("select user_id, event_id, (n - lag(n) over w)::double / (event_id - lag(event_id) over w) as rate from (select *, row_number() over (partition by user_id order by event_id) as n from events) window w as (partition by user_id order by event_id)")
def rate_from_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates between cumulative figures."""
    from pyspark.sql import Window

    totals = read(spark, sf_dir, "events").select("user_id", "event_id", F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")).alias("n"))
    return metrics.rates_from_totals(totals, "event_id", "n", ["user_id"]).drop("n")


@query("select event_type, max(n) as peak from (select event_type, date_trunc('second', ts) as b, count(*) as n from events group by 1, 2) group by 1")
def peak_second(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Largest count of any second."""
    return metrics.peak(read(spark, sf_dir, "events"), "ts", "second", ["event_type"])


@query("select event_type, round(quantile_cont(value, 0.9), 6) as p90, round(quantile_cont(value, 0.95), 6) as p95, max(value) as max from events group by 1")
def value_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact percentiles and the maximum."""
    d = metrics.distribution(read(spark, sf_dir, "events"), "value", ["event_type"], exact=True)
    return d.select("event_type", F.round("p90", 6).alias("p90"), F.round("p95", 6).alias("p95"), "max")


@query("""with q as (select event_type, quantile_disc(value, 0.9) as p90, quantile_disc(value, 0.95) as p95, max(value) as max from events group by 1),
 s as (select *, pow(10, floor(log10(abs(p90))) - 1) as a, pow(10, floor(log10(abs(p95))) - 1) as b, pow(10, floor(log10(abs(max))) - 1) as c from q) select event_type, round(p90 / a) * a as p90, round(p95 / b) * b as p95, round(max / c) * c as max from s""")
def value_distribution_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles with two significant digits, for any volume."""
    return metrics.distribution(read(spark, sf_dir, "events"), "value", ["event_type"])


@query("select user_id, event_id, max(value) over (partition by user_id order by event_id) as session_max from events")
def session_maximum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running maxima."""
    return metrics.session_maximum(read(spark, sf_dir, "events"), "value", "event_id", ["user_id"]).select("user_id", "event_id", "session_max")


@query("select o_orderkey, greatest(o_orderkey * 3 - o_custkey * 20, 0) as lag_bytes from orders")
def lag_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Received but not confirmed."""
    return read(spark, sf_dir, "orders").select("o_orderkey", metrics.lag_bytes(F.col("o_orderkey") * 3, F.col("o_custkey") * 20).alias("lag_bytes"))


@query("select l_linenumber as rmid, cast(l_partkey % 256 as bigint) & 240 as op, count(*) as n from lineitem group by 1, 2")
def record_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records by manager and operation."""
    rows = read(spark, sf_dir, "lineitem").select(F.col("l_linenumber").alias("rmid"), (F.col("l_partkey") % 256).alias("info"))
    return metrics.census(rows)


@query("select l_returnflag, l_linestatus, count(*) as n from lineitem group by 1, 2 order by n desc, l_returnflag, l_linestatus limit 3")
def census_top_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three most frequent forms (O3)."""
    counts = read(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))
    return metrics.top_forms(counts)


@query("select cast(sum(case when event_type='view' then 1 else 0 end) as bigint) as resyncs, cast(sum(case when event_type='click' then 1 else 0 end) as bigint) as orphans, cast(sum(case when event_type='error' then 1 else 0 end) as bigint) as zero_pages, cast(0 as bigint) as reconnects from events")
def stream_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a reader had to mend."""
    kind = lambda t: (F.col("event_type") == t).cast("int")
    pages = read(spark, sf_dir, "events").select(kind("view").alias("resyncs"), kind("click").alias("orphans"), kind("error").alias("zero_pages"), F.lit(0).alias("reconnects"))
    return metrics.stream_health(pages)


@query("""with t as (select list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end)) as crcs),
 f as (select event_id // 500 as file, count(*) as n, string_agg(event_type || ',' || user_id, '' order by event_id) as body from events group by 1)
 select file, n, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(body, ''), lambda x: cast(ord(x) as bigint))), lambda c, x: xor(c >> 8, crcs[(xor(c, x) & 255) + 1]))) as crc32 from f, t""")
def file_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Record count and CRC32 of each file's records in order."""
    rows = read(spark, sf_dir, "events").select(F.floor(F.col("event_id") / 500).alias("file"), "event_id", F.encode(F.concat_ws(",", "event_type", "user_id"), "UTF-8").alias("content"))
    return metrics.file_digest(rows, "file", "event_id", "content")


@query("select event_type as op, count(*) as n, count(distinct user_id) as streams, min(event_id) as first_seq, max(event_id) as last_seq from events group by 1")
def op_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operations with their extent."""
    return read(spark, sf_dir, "events").groupBy(F.col("event_type").alias("op")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("streams"), F.min("event_id").alias("first_seq"), F.max("event_id").alias("last_seq"))
