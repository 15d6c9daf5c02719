"""Dictionary, checkpoints, settings, sinks and listeners."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark.config import ReaderConfig
from tidemark.operators import lookups, sequence
from tidemark.sources import wal
from tidemark.streaming import assembler, catalog, listener, sinks


def filled():
    c = catalog.Catalog()
    c.seed([("class", 0, 1, {"oid": 10, "filenode": 100, "namespace": 5, "tbl": "t", "toast": 77}), ("namespace", 0, 1, {"oid": 5, "name": "app"})], 50)
    c.apply(60, 70, "insert", "attribute", 1, 1, {"rel_oid": 10, "attnum": 2, "name": "b"})
    c.apply(61, 71, "insert", "attribute", 1, 2, {"rel_oid": 10, "attnum": 1, "name": "a"})
    return c


def test_dictionary():
    c = filled()
    assert [x["name"] for x in c.columns_of(10)] == ["a", "b"] and c.relation(100) == c.relation(10) and c.schema_of(10) == "app" and c.relation_of_toast(77)["tbl"] == "t"
    c.apply(80, 81, "redirect", "attribute", 1, 2, to=(1, 9))
    c.apply(82, 83, "update", "attribute", 1, 9, {"rel_oid": 10, "attnum": 1, "name": "z"}, (2, 1))
    c.apply(84, 85, "dead", "attribute", 1, 1)
    c.apply(86, 87, "redirect", "attribute", 4, 4, to=(4, 5))
    assert [x["name"] for x in c.columns_of(10)] == ["z"] and c.counts["missing"] == 1 and c.counts["redirected"] == 1
    c.reached(90)
    assert not c.apply(88, 90, "insert", "class", 9, 9, {}) and c.counts["skipped"] == 1
    with pytest.raises(catalog.CatalogError):
        c.apply(95, 96, "what", "class", 1, 1)


def test_checkpoint(tmp_path):
    path = str(tmp_path / "state")
    filled().save(path, floor=40)
    back, floor = catalog.Catalog.load(path)
    assert floor == 40 and back.rows == filled().rows and back.lsn == 50
    text = (tmp_path / "state").read_text()
    for broken in (text.replace('"lsn": 50', '"lsn": 51'), text + " ", "x" + text, text.replace('"version": 1', '"version": 2')):
        (tmp_path / "state").write_text(broken)
        with pytest.raises(catalog.CatalogError):
            catalog.Catalog.load(path)
    assert catalog.start_position(None, None, 7) == ("bootstrap", 7) and catalog.start_position(5, None, 7) == ("bootstrap", 7) and catalog.start_position(9, 8, 7) == ("resume", 8)
    assert catalog.confirm_position(9, None) == 9 and catalog.confirm_position(9, 4) == 4


def test_versions_in_batch_and_stream(spark, tmp_path):
    row = lambda n: json.dumps({"rel_oid": 10, "attnum": 1, "name": n})
    rows = [(0, 10, 11, "insert", "attribute", 0, 1, row("a"), None, None), (0, 20, 21, "redirect", "attribute", 0, 1, None, 0, 5), (0, 30, 31, "update", "attribute", 0, 5, row("b"), 0, 6), (0, 40, 41, "delete", "attribute", 0, 6, None, None, None)]
    changes = spark.createDataFrame(rows, catalog.CHANGES)
    batch = sorted((r["lsn"], json.loads(r["row"])["name"], r["live"]) for r in catalog.catalog_versions(changes).collect())
    assert batch == [(10, "a", True), (30, "b", True), (40, "b", False)]
    for k, r in enumerate(rows):
        spark.createDataFrame([r], catalog.CHANGES).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        assert k < 4
    stream = spark.readStream.schema(changes.schema).option("maxFilesPerTrigger", 100).parquet(str(tmp_path / "in"))
    q = catalog.catalog_stream(stream).writeStream.format("memory").queryName("versions").start()
    q.processAllAvailable()
    q.stop()
    assert sorted((r["lsn"], json.loads(r["row"])["name"], r["live"]) for r in spark.table("versions").collect()) == batch


def test_settings(tmp_path):
    (tmp_path / "p").write_text("# reader\nslot = s1\npath=/data\nroll-records=5\n")
    c = ReaderConfig.load(str(tmp_path / "p"), format="sql")
    assert (c.slot, c.roll_records, c.format, c.two_phase) == ("s1", 5, "sql", False)
    for bad in ({"format": "csv"}, {"colour": 1}, {"slot": ""}):
        with pytest.raises(ValueError):
            ReaderConfig.load(str(tmp_path / "p"), **bad)
    with pytest.raises(ValueError):
        c.same_slot(True)


def test_batches_are_written_once(spark, tmp_path):
    seen = []
    write = sinks.once(str(tmp_path), lambda batch, number: seen.append(number) or batch.count())
    for number in (0, 1, 1, 0):
        write(spark.range(3), number)
    assert seen == [0, 1]


def test_envelopes_and_repeats(spark):
    df = spark.createDataFrame([("k", 1, 2, 3, "I", 1), ("k", 1, 2, 3, "I", 1)], "txn_key string, commit_lsn long, end_lsn long, seq long, kind string, ord long")
    body = json.loads(sinks.envelopes(df).first()["value"])
    assert body["op"] == "I" and body["source"]["commit_lsn"] == 1
    assert assembler.without_repeats(df).count() == 1


def test_restart_goes_on(spark, tmp_path):
    schema = "slot int, seq long, kind string, xid long, subxid long, gid string, first_segment boolean, commit_lsn long, end_lsn long"
    parts = [[(0, 0, "S", 7, None, None, True, None, None), (0, 1, "I", None, 7, None, None, None, None), (0, 2, "E", None, None, None, None, None, None)], [(0, 3, "A", 7, 9, None, None, None, None), (0, 4, "c", 7, None, None, None, 5, 6)]]
    metrics = listener.Metrics()
    spark.streams.addListener(metrics)
    for rows in parts:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        q = assembler.assemble_stream(stream).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        q.awaitTermination()
    spark.streams.removeListener(metrics)
    got = [(r["txn_key"], r["seq"], r["commit_lsn"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert got == [("S:7:0", 1, 5)]


def test_carry_over_chunks(spark):
    rows = [(0, 1, "a"), (0, 5, None), (0, 500, None), (0, 501, "b"), (0, 900, None), (1, 2, None)]
    df = spark.createDataFrame(rows, "slot int, seq long, v string")
    got = sorted((r["slot"], r["seq"], r["c"], r["p"]) for r in sequence.carry_last(sequence.carry_last(df, F.col("v"), "c", ["slot"], chunk=10), F.col("v"), "p", ["slot"], chunk=10, before=True).collect())
    assert got == [(0, 1, "a", None), (0, 5, "a", "a"), (0, 500, "a", "a"), (0, 501, "b", "a"), (0, 900, "b", "b"), (1, 2, None, None)]


def test_missing_chunk(spark):
    pointers = spark.createDataFrame([(1, 4), (2, 4), (3, 4)], "value_id int, size int")
    chunks = spark.createDataFrame([(1, 0, b"ab"), (1, 1, b"cd"), (2, 1, b"cd")], "value_id int, chunk_seq int, data binary")
    got = {r["value_id"]: (r["value"] and bytes(r["value"]), r["problem"]) for r in lookups.assemble_chunks(pointers, chunks).collect()}
    assert got == {1: (b"abcd", None), 2: (None, "missing chunk"), 3: (None, "no chunk")}


def test_segment_names(spark):
    files = spark.createDataFrame([("/x/000000010000000200000003", b"a"), ("/x/000000010000000200000003.partial", b"b"), ("/x/other", b"c")], "path string, content binary")
    assert [tuple(r) for r in wal.segment_files(files).collect()] == [(1, 2 * 256 + 3, b"a")]
