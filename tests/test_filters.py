"""Filters and functions that no query shows by itself."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions import binary, render, sql_text, typed
from tidemark.operators import assembly, filters, metrics, rolling, sequence


def one(spark, **columns):
    return spark.range(1).select(*(c.alias(k) for k, c in columns.items())).first()


def test_filters(spark):
    ops = spark.createDataFrame([("c",), ("t",), ("d",)], "op string")
    assert [r["op"] for r in ops.where(~filters.skipped(F.col("op"))).collect()] == ["c", "d"]
    assert ops.where(~filters.skipped(F.col("op"), [])).count() == 3 and ops.where(~filters.skipped(F.col("op"), ["c", "d"])).count() == 1
    row = one(spark, a=filters.included(F.lit("app.t1"), ["app\\..*"]), b=filters.included(F.lit("APP.t1"), ["app\\..*"], ["app.t1"]), c=filters.admitted_partition_type(F.lit("v")), d=filters.user_table(F.lit("r"), F.lit("pg_toast")))
    assert (row["a"], row["b"], row["c"], row["d"]) == (True, False, False, False)
    assert filters.compatible("PG") == "PG"
    with pytest.raises(ValueError):
        filters.compatible("X")


def test_functions(spark):
    row = one(
        spark, up=binary.unsigned(F.unhex(F.lit("00FFFFFFFF")), 1, 4), down=binary.signed(F.unhex(F.lit("FFFE")), 0, 2), none=binary.lsn_parse(F.lit("x/1")), uuid=binary.uuid_text(F.unhex(F.lit("550e8400e29b41d4a716446655440000"))),
        kept=binary.confirm(F.lit(9), F.lit(None).cast("long")), java=binary.java_hash(F.lit("hello")), empty=binary.java_hash(F.lit("")), wide=binary.java_hash(F.lit("𝄞")), base=typed.binary_mode(F.unhex(F.lit("fbff")), "base64-url-safe"),
        iso=typed.interval_iso(F.lit(14), F.lit(3), F.lit(3_600_000_000)), year=typed.interval_micros(F.lit(12), F.lit(0), F.lit(0)), json=typed.hstore_json(F.lit('"a b"=>"1", c=>NULL')), nan=sql_text.literal(F.lit(float("nan")), "FLOAT64"),
        minus=sql_text.literal(F.lit(float("-inf")), "FLOAT64"), bytes=sql_text.literal(F.unhex(F.lit("00ff")), "BYTES"), time=render.duration_text(F.lit(1_500_000)), two=metrics.two_digits(F.lit(12345.0)), bool=sql_text.literal(F.lit(True), "BOOL"),
    )
    assert row["up"] == 4294967295 and row["down"] == -2 and row["none"] is None and row["uuid"] == "550e8400-e29b-41d4-a716-446655440000" and row["kept"] == 0
    assert row["java"] == 99162322 and row["empty"] == 0 and row["wide"] == 55348 * 31 + 56606 and row["base"] == "-_8="
    assert row["iso"] == "P1Y2M3DT1H0M0.000000S" and row["year"] == 12 * 2_629_800_000_000 and row["json"] == '{"a b":"1","c":null}'
    assert row["nan"] == "'NaN'" and row["minus"] == "'-Infinity'" and row["bytes"] == "decode('00ff', 'hex')" and row["time"] == "1.50ms" and row["two"] == 12000 and row["bool"] == "TRUE"


def test_statements_refuse(spark):
    for bad in (sql_text.delete(F.lit("t"), {}), sql_text.literal(F.lit("a\x00b"), "STRING"), binary.bool_text(F.unhex(F.lit("0001")))):
        with pytest.raises(Exception, match="primary key|NUL|one byte"):
            spark.range(1).select(bad.alias("x")).collect()


def test_rolling_and_names(spark):
    df = spark.createDataFrame([(0, k, 4) for k in range(6)], "task int, seq long, n int")
    assert [r["file_number"] for r in rolling.roll(df, "n", "seq", 10, ["task"]).orderBy("seq").collect()] == [1, 1, 1, 2, 2, 2]
    names = spark.createDataFrame([("t-0000000000000004-20240101000000.sql",), ("other",), ("u-0000000000000009-20240101000000.bin",)], "name string")
    assert rolling.next_number(names, "name", "t").first()[0] == 5 and rolling.next_number(names, "name", "x").first()[0] == 1


def test_frontier_before_any_output(spark):
    received = spark.createDataFrame([(0, 50)], "slot int, end_lsn long")
    assert assembly.frontier(received.limit(0), received).first()["confirm_lsn"] == 0


def test_versions(spark):
    left = spark.createDataFrame([(1, 5, "a"), (1, 9, "b"), (2, 9, "c")], "oid int, seq long, v string")
    versions = spark.createDataFrame([(1, 5, 100), (1, 6, 200), (3, 1, 300)], "oid int, seq long, version int")
    got = sorted((r["v"], r["w"]) for r in sequence.as_of_join(left, versions, "oid", "seq", "version", "w", chunk=2).collect())
    assert got == [("a", 100), ("b", 200), ("c", None)]
    assert sorted(r["seq"] for r in sequence.prune_versions(versions, "oid", F.lit(7)).collect()) == [1, 6]


def test_figures_round_as_printf_does(spark):
    """Halves in decimal are seldom halves in binary, and true halves go to the even digit."""
    values = [1_005_000.0, 1_015_000.0, 1_115_000.0, 8_125_000.0, 999_995_000.0, 1_000_000.0, 1125.0, 2375.0, 0.125, 0.0, 12.345]
    shown = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v double").select(render.rate_text(F.col("v"))).collect()]
    assert shown == [f"{v / 1e6:.2f}M/s" if v >= 1e6 else f"{v / 1e3:.2f}k/s" if v >= 1e3 else f"{v:.2f}/s" for v in values]
    row = one(spark, kb=render.bytes_text(F.lit(1152)), mb=render.bytes_text(F.lit((1 << 20) + (1 << 17))), us=render.duration_text(F.lit(1125)))
    assert tuple(row) == ("1.12KB", "1.12MB", "1.12us")


@pytest.mark.parametrize("above", [4999.6, 5000.4])
@pytest.mark.parametrize("form", ["interval", "group"])
def test_two_digit_percentiles_are_exact(spark, above, form):
    """p90 and p95 lie a step below or above a border of two digits: a percentile one rank off shows."""
    rows = spark.range(1, 200_001, 1, 5).select(F.lit("a").alias("g"), F.expr("timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id % 3600)").alias("ts"), (F.col("id") + above).alias("v"))
    rows = rows.union(spark.sql("select 'a', timestamp'2024-01-01 00:00:00', cast(null as double)"))
    got = metrics.interval_distribution(rows, "ts", 3600, "v") if form == "interval" else metrics.distribution(rows, "v", ["g"])
    row = got.select(*(metrics.two_digits(F.col(c)) for c in ("p90", "p95", "max"))).first()
    assert tuple(row) == ((180_000.0, 190_000.0, 200_000.0) if above < 5000 else (190_000.0, 200_000.0, 210_000.0))
