"""Landed assembly, files in shared folders, rolling, dispatch and the ends of running queries."""

import datetime
import random

import pytest
from pyspark.sql import functions as F
from test_protocol import SCHEMA, frame, message, random_stream

from tidemark.functions import typed
from tidemark.operators import assembly, lookups, rolling
from tidemark.sources import envelopes, pgoutput
from tidemark.sources.shared_files import Folder
from tidemark.streaming import dispatch, host, listener, sinks
from tidemark.streaming.assembler import Assembler
from tidemark.streaming.landed import LandedAssembly


def test_landed_assembly_equals_the_state_machine(spark, tmp_path):
    messages = random_stream(random.Random(3), 260)
    machine, want = Assembler(), []
    for m in messages:
        want += machine.on(m) or ()
    run, cuts = LandedAssembly(str(tmp_path), chunk=16), [0, 37, 38, 120, 200, len(messages)]
    for number, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        batch = frame(spark, messages[a:b])
        run(batch, number)
        if number == 2:  # a batch that runs again
            run(batch, number)
    out = run.out(spark).select("txn_key", "mode", "gid", "commit_lsn", "end_lsn", "end_seq", "expected_changes", "ord", "seq", "kind", "stream_xid").collect()
    assert sorted(map(repr, map(tuple, out))) == sorted(map(repr, want))
    last = len(cuts) - 2
    begun = {m["seq"] for m in messages[: cuts[2]] if m["kind"] in "SBb"}
    assert {r["seq"] for r in run.stale(spark, last, last - 2).collect()} <= begun
    still = spark.read.parquet(f"{tmp_path}/open/batch={last}")
    assert still.count() <= sum(m["kind"] in "SAbPpB" for m in messages)


def test_a_giant_transaction_is_many_tasks(spark):
    n = 60_000
    units = spark.range(1, n + 1).select(F.lit(0).alias("slot"), F.col("id").alias("seq"), F.lit("I").alias("kind"))
    ends = spark.createDataFrame([(0, 0, "B"), (0, n + 1, "C")], "slot int, seq long, kind string")
    none = {"xid": "long", "subxid": "long", "gid": "string", "first_segment": "boolean", "commit_lsn": "long", "end_lsn": "long", "commit_ts": "timestamp"}
    messages = units.unionByName(ends).select("*", *(F.lit(None).cast(t).alias(c) for c, t in none.items()))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = assembly.changes(messages, chunk=1 << 12)
        by_task = [r["count"] for r in numbered.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(by_task) == n and max(by_task) < n / 2
        blocks = assembly.blocks(assembly.changes(messages, chunk=1 << 12), 25_000).select("block", F.size("changes").alias("n")).collect()
        assert sorted(tuple(r) for r in blocks) == [(0, 25_000), (1, 25_000), (2, 10_000)]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("seed,limit,seconds", [(1, 50, None), (2, 50, 40), (3, 7, 5), (4, 10_000, 90), (5, 1, None)])
def test_rolling_against_a_plain_loop(spark, seed, limit, seconds):
    rng, start = random.Random(seed), datetime.datetime(2024, 1, 1)
    rows, at = [], {"a": 0, "b": 0}
    for k in range(600):
        task = rng.choice("aab")
        at[task] += rng.choice([0, 0, 1, 3, 30, -5])
        rows.append((task, k * 3, rng.choice([0, 1, 1, 5, 60]), start + datetime.timedelta(seconds=at[task]) if rng.random() < 0.9 else None))
    want = {}
    for task in "ab":
        records, number, clock, published = 0, 1, None, None
        for t, seq, size, ts in rows:
            if t == task:
                clock = max(x for x in (clock, ts, datetime.datetime.min) if x is not None)
                published = clock if published is None else published
                records += size
                want[task, seq] = number
                if records >= limit or seconds is not None and (clock - published).total_seconds() >= seconds:
                    records, number, published = 0, number + 1, clock
    df = spark.createDataFrame(rows, "task string, seq long, n int, ts timestamp_ntz").repartition(5)
    got = {(r["task"], r["seq"]): r["file_number"] for r in rolling.roll(df, "n", "seq", limit, ["task"], "ts" if seconds else None, seconds, chunk=100).collect()}
    assert got == want


def test_shared_folder(spark, tmp_path):
    folder = Folder(spark, f"file://{tmp_path}/a")
    assert folder.names() == []
    folder.publish("x", b"1\x00\xff")
    folder.publish("x", b"2\x00\xff")
    (tmp_path / "a" / "y.part").write_bytes(b"left")
    assert folder.exists("x") and folder.read("x") == b"2\x00\xff" and folder.remove_stale() == 1
    assert [n for n in folder.names() if not n.endswith(".crc")] == ["x"]


def test_published_batches(spark, tmp_path):
    write = sinks.change_files(f"file://{tmp_path}", "job", lambda b: b.select(F.lit(1).alias("file_number"), F.col("v").cast("binary").alias("content")))
    once = sinks.once(f"file://{tmp_path}", write)
    for number, v in ((0, "a"), (1, "b"), (1, "again")):
        once(spark.createDataFrame([(v,)], "v string"), number)
    names = [n for n in Folder(spark, f"{tmp_path}/job").names() if n.endswith(".bin")]
    assert [int(n.split("-")[1]) for n in names] == [1, 1_000_001]
    assert Folder(spark, f"{tmp_path}/job").read(names[1]) == b"b"


def test_lines_metrics_and_heartbeats(spark, tmp_path):
    sinks.once(str(tmp_path), sinks.lines(f"{tmp_path}/log", ["n"]))(spark.createDataFrame([(2, "b"), (1, "a"), (3, "c")], "n int, line string"), 7)
    assert [r["value"] for r in spark.read.text(f"{tmp_path}/log/batch=000000000007").collect()] == ["a", "b", "c"]
    m = listener.Metrics()
    m.publish(Folder(spark, str(tmp_path)))
    assert Folder(spark, str(tmp_path)).read("metrics.json") == b"{}"
    beat = dispatch.heartbeat(spark, "srv", 5_000_000, 77).select("topic", "value", dispatch.resume_position(F.col("offset")).alias("o")).first()
    assert beat["topic"] == "srv.heartbeat" and beat["value"] == '{"ts_ms":5000}' and beat["o"]["lsn_commit"] == 77


def test_a_query_is_drained_or_stopped(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "in"))
    start = lambda name: spark.readStream.schema("id long").parquet(str(tmp_path / "in")).writeStream.format("memory").queryName(name).start()
    q = start("drained")
    host.close(q)
    assert spark.table("drained").count() == 5 and not q.isActive
    q = start("stopped")
    host.shutdown_fast(q)
    assert not q.isActive


def test_mixed_prefixes_are_found(spark):
    stream = [message(0, "S", xid=1, first_segment=True), message(1, "I", subxid=1), message(2, "I"), message(3, "E"), message(4, "B", xid=2), message(5, "I", subxid=9), message(6, "I"), message(7, "C")]
    assert sorted(r["seq"] for r in assembly.violations(frame(spark, stream)).collect()) == [2, 5]


def test_skipped_operations_and_offsets(spark):
    rows = [("k", 7, 100, 1, 50, "I", "s", "t", {"id": "1"}, None, {"id": "1"}), ("k", 7, 100, 2, 60, "T", "s", "t", None, None, None)]
    schema = "txn_key string, xid long, end_lsn long, ord long, lsn long, kind string, schema string, tbl string, key map<string,string>, before map<string,string>, after map<string,string>"
    changes = spark.createDataFrame(rows, schema).withColumn("commit_ts", F.lit("2024-01-01").cast("timestamp"))
    out = dispatch.records(changes, "p", "d").orderBy("place").collect()
    assert [(r["place"], r["topic"]) for r in out] == [(0, "p.transaction"), (1, "p.s.t"), (2, "p.transaction")]
    known = spark.createDataFrame(out).select(dispatch.resume_position(F.col("offset")).alias("o")).select("o.*").collect()
    assert [(r["lsn"], r["lsn_proc"], r["lsn_commit"], r["txId"]) for r in known] == [(100, 100, 100, 7), (50, 100, 100, 7), (100, 100, 100, 7)]


def test_bad_envelopes_are_named(spark):
    rows = ['{"op":"x","after":{"a":"1"}}', '{"op":"d"}', '{"schema":{"fields":[{"field":"after","type":"struct","fields":[{"field":"a","type":"array"}]}]},"payload":{"op":"c","after":{"a":"1"}}}', '{"op":"c","after":{"b":"1","a":null}}']
    df = spark.createDataFrame([(k, None, v) for k, v in enumerate(rows)], "n int, key string, value string")
    got = {r["n"]: r for r in envelopes.events(envelopes.payloads(df)).collect()}
    assert [got[k]["problem"] for k in range(4)] == ["unknown operation", "no image", "unknown column type", None] and got[3]["vals"] == [None, "1"]


def test_decoded_batches_with_broken_messages(spark):
    whole = [pgoutput.encode_message("U", rel_oid=1, old_kind="K", old=["1", None], new=["2", ...]), pgoutput.encode_message("D", rel_oid=2, old=["3"]), pgoutput.encode_message("I", rel_oid=3, new=[b"\xff", "é"])]
    raws = [r for w in whole for r in (w, w[:-1], w + b"x", b"")] + [pgoutput.encode_message("I", rel_oid=3, new=["a"])[:-1] + b"\xff"]
    df = spark.createDataFrame([(k, bytearray(r), False) for k, r in enumerate(raws)], "n int, raw binary, in_stream boolean").coalesce(1)
    rows = {r["n"]: r for r in pgoutput.decode(df.where("n < 12"), permissive=True).collect()}
    assert [k for k, r in rows.items() if r["kind"]] == [0, 4, 8] and all(r["prefix"] for r in rows.values() if not r["kind"])
    assert [v["text"] for v in rows[0]["old"]] == ["1", None] and [v["state"] for v in rows[0]["new"]] == ["t", "u"] and rows[4]["new"] is None and rows[8]["old"] is None and bytes(rows[8]["new"][0]["bin"]) == b"\xff"
    with pytest.raises(Exception, match="WireError|bytes"):
        pgoutput.decode(df.where("n = 1")).collect()


def test_base_types_of_long_chains_and_cycles(spark):
    rows = [(k, k - 1) for k in range(2, 40)] + [(1, 0), (100, 101), (101, 100)]
    got = {r["oid"]: r["base_oid"] for r in lookups.base_types(spark.createDataFrame(rows, "oid long, base long")).collect()}
    assert all(got[k] == 1 for k in range(1, 40)) and got[100] is None and got[101] is None


def test_values_that_are_none_of_their_type(spark):
    df = spark.createDataFrame([("x",)], "t string")
    null = [typed.variable_decimal(F.lit("NaN")), typed.bit_bytes(F.lit("102")), typed.text_array(F.lit("{a,{b}}")), typed.text_array(F.lit("{a")), typed.geometric(F.lit("(1,2)"), "box"), typed.geometric(F.lit("(a,b)"), "point"), typed.timestamp_micros(F.lit("2024-01-01")), typed.date_days(F.lit("never"))]
    assert all(v is None for v in df.select(*(c.alias(f"c{k}") for k, c in enumerate(null))).first())
    r = df.select(typed.text_array(F.lit("{}")).alias("a"), typed.text_array(F.lit('[2:3]={"",NULL}')).alias("b"), typed.date_days(F.lit("0001-12-31 BC")).alias("c"), typed.timestamp_micros(F.lit("1969-12-31 23:59:59.9999999Z")).alias("d")).first()
    assert tuple(r) == ([], ["", None], -719163, -1)
    assert [r[0] for r in spark.createDataFrame([("a", 25), (None, 20)], "t string, o long").select(typed.mapped(F.col("t"), F.col("o"), lambda oid, t: f"{oid}:{t}")).collect()] == ["25:a", "20:None"]
    assert SCHEMA
