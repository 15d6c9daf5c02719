"""Value codecs, change files, SQL text and log records."""

import datetime
import struct

import pytest
from hypothesis import given
from hypothesis import strategies as st

from tidemark.functions import pgvalues, typed
from tidemark.sources import changefile, wal


@pytest.mark.parametrize("text", ["123.45", "0.000123", "-0.5", "0", "10000000000", "12345.6789", "0.50", "NaN", "Infinity", "-Infinity", "0.000000000001", "0.00"])
def test_numeric(text):
    assert pgvalues.numeric_text(pgvalues.numeric_bytes(text)) == text


@given(st.decimals(allow_nan=False, allow_infinity=False, places=7, min_value=-10**15, max_value=10**15))
def test_any_numeric(d):
    text = format(d, "f")
    text = text[1:] if text.startswith("-") and float(text) == 0 else text
    assert pgvalues.numeric_text(pgvalues.numeric_bytes(text)) == text


@pytest.mark.parametrize("value,digits,text", [(1e20, 15, "1e+20"), (-0.0, 15, "-0"), (0.1, 15, "0.1"), (100000.0, 15, "100000"), (1e15, 15, "1e+15"), (1e-5, 15, "1e-05"), (1e6, 6, "1e+06"), (0.1, 6, "0.1"), (float("nan"), 15, "NaN"), (float("-inf"), 6, "-Infinity")])
def test_float(value, digits, text):
    assert pgvalues.float_text(value, digits) == text


@given(st.floats(allow_nan=False, allow_infinity=False))
def test_any_float_reads_back(x):
    assert float(pgvalues.float_text(x, 15)) == x


@given(st.dates())
def test_any_date(d):
    assert pgvalues.date_text(pgvalues.days_since_2000(d)) == d.isoformat()


def test_times():
    assert pgvalues.date_text(-730120) == "0001-12-31 BC"
    assert pgvalues.date_text(0x7FFFFFFF) == "infinity"
    assert pgvalues.binary_text(1083, struct.pack(">q", 86_400_000_000)) == "24:00:00"
    assert pgvalues.timetz_text(3_600_500_000, -19_800) == "01:00:00.5+05:30"
    assert pgvalues.timestamp_text(-1) == "1999-12-31 23:59:59.999999"
    assert pgvalues.interval_text(0, 0, -18) == "-1 years -6 mons"
    assert pgvalues.interval_text(14_706_500_000, 3, 14) == "1 year 2 mons 3 days 04:05:06.5"
    assert pgvalues.interval_text(0, 0, 0) == "00:00:00"


def test_arrays():
    def item(v):
        return struct.pack(">i", -1) if v is None else struct.pack(">i", len(v)) + v

    raw = struct.pack(">iiI", 1, 1, 25) + struct.pack(">ii", 5, 1) + b"".join(map(item, (b"a b", b"NULL", None, b"", b"x")))
    assert pgvalues.binary_text(1009, raw) == '{"a b","NULL",NULL,"",x}'
    raw = struct.pack(">iiI", 2, 0, 23) + struct.pack(">iiii", 2, 0, 1, 1) + b"".join(item(struct.pack(">i", n)) for n in (1, 2))
    assert pgvalues.binary_text(1007, raw) == "[0:1][1:1]={{1},{2}}"
    assert pgvalues.binary_text(99999, b"\x01\xff") == "0x01ff"
    with pytest.raises(ValueError):
        pgvalues.binary_text(23, b"\0")


DEFINITION = ("db1", "public", "t1", ("id",), (("id", "INT"), ("s", "STRING"), ("b", "BOOL"), ("d", "FLOAT64"), ("f", "FLOAT32"), ("y", "BYTES"), ("ts", "TIMESTAMP"), ("tz", "TIMESTAMPTZ"), ("day", "DATE"), ("t", "TIME"), ("i", "INTERVAL")))
ROW = [-1, "x'y", True, 1.5, 2.5, b"\0\1", "2024-01-01 00:00:00", "2024-01-01T00:00:00Z", "2024-01-01", "24:00:00", "-5 microseconds"]


def change_file():
    e = changefile.Encoder(7, "db1")
    e.begin(-5, 7)
    e.event(DEFINITION, "CREATE", ROW)
    e.event(DEFINITION, "DELETE", [2**62] + [None] * 10)
    e.truncate(DEFINITION)
    e.commit(-5, 9, 1_700_000_000_000)
    return e.finish()


def test_change_file_round_trip():
    records = list(changefile.decode_file(change_file()))
    assert [r["kind"] for r in records] == ["BEGIN", "TABLE_DEF", "EVENT", "EVENT", "TRUNCATE", "COMMIT"]
    assert records[2]["values"] == ROW and records[3]["values"] == [2**62] + [None] * 10 and records[0]["txid"] == -5


@pytest.mark.parametrize("spoil", [lambda b: b[:-1], lambda b: b"X" + b[1:], lambda b: b[:40] + bytes([b[40] ^ 1]) + b[41:], lambda b: b[: len(b) // 2]])
def test_broken_change_files(spoil):
    with pytest.raises((changefile.ChangeFileError, UnicodeDecodeError, IndexError)):
        list(changefile.decode_file(spoil(change_file())))


def test_change_file_rejects_wrong_width():
    with pytest.raises(changefile.ChangeFileError):
        changefile.Encoder(1, "d").event(DEFINITION, "CREATE", [1])


@given(st.integers(-(2**63), 2**63 - 1))
def test_zigzag(n):
    assert changefile._Bytes(changefile.zigzag(n)).zigzag() == n


def test_change_file_source(spark, tmp_path):
    spark.dataSource.register(changefile.ChangeFileSource)
    files = spark.createDataFrame([("t-0000000000000001-20240101000000.bin", change_file())], "name string, content binary")
    files.write.format("changefile").option("path", str(tmp_path)).mode("append").save()
    assert [p.name for p in tmp_path.iterdir()] == ["t-0000000000000001-20240101000000.bin"]
    assert spark.read.format("changefile").option("path", str(tmp_path)).load().count() == 6
    assert changefile.read_change_files(spark, str(tmp_path)).where("kind = 'EVENT'").count() == 2


def test_types():
    assert typed.spark_type(1700, (12 << 16 | 4) + 4) == "decimal(12,4)" and typed.spark_type(1700) == "string" and typed.spark_type(1007) == "array<int>"
    assert typed.relation_schema([{"name": "a", "type_oid": 23}, {"name": "b", "type_oid": 25}]).simpleString() == "struct<a:int,b:string>"


def test_compression():
    assert wal.pglz(bytes([0b00001000]) + b"abc" + bytes([0x03, 0x03]), 9) == b"abcabcabc"
    assert wal.lz4(bytes([0x35]) + b"abc" + b"\x03\x00" + bytes([0x10]) + b"z", 13) == b"abcabcabcabcz"
    with pytest.raises(wal.WalError):
        wal.pglz(b"\0abc", 9)


def test_tuples():
    attributes = [wal.attribute("a", 21), wal.attribute("b", 25), wal.attribute("c", 20), wal.attribute("d", 25), wal.attribute("e", 701)]
    for row in (["1", "x", "-5", "y" * 300, "2.5"], ["1", None, "7", None, "0.1"], [None] * 5):
        raw = wal.build_tuple(row, attributes)
        assert wal.decode_tuple(*struct.unpack_from("<HHB", raw), raw[5:], attributes) == row
    pointer = b"\x01\x12" + struct.pack("<iIII", 5000, 4996, 77, 88)
    assert wal.decode_tuple(1, 0, 24, b"\0" + pointer, [wal.attribute("b", 25)]) == [("toast", 4996, 4996, 77, 88)]
    assert wal.disk_numeric(struct.pack("<HH", 0x8000 | 2 << 7, 1) + struct.pack("<H", 2500)) == "1.25"


def test_updates_deletes_and_multi_inserts():
    attributes = [wal.attribute("a", 23), wal.attribute("b", 25)]
    old, new = wal.build_tuple(["1", "abcdef"], attributes), wal.build_tuple(["1", "abcXef"], attributes)
    body_old, body_new = old[5 + 1 :], new[5 + 1 :]
    prefix = next(k for k in range(len(body_old)) if body_old[k] != body_new[k])
    log = wal.SegmentBuilder(1 << 16)
    main = struct.pack("<IHBBIH", 0, 1, 0, 0x04 | 0x60, 0, 2) + old
    log.add(wal.RM_HEAP, 0x20, 9, main, [(1, struct.pack("<HH", prefix, 2) + new[:6] + body_new[prefix : len(body_new) - 2])])
    log.add(wal.RM_HEAP, 0x10, 9, struct.pack("<IHBB", 0, 1, 0, 2) + old, [(1, b"")])
    data = b""
    for row in (["5", "p"], ["6", None]):
        t = wal.build_tuple(row, attributes)
        data += b"\0" * (len(data) % 2) + struct.pack("<H", len(t) - 5) + t
    log.add(wal.RM_HEAP2, 0x50, 9, struct.pack("<BxH", 0, 2), [(1, data)])
    log.add(wal.RM_HEAP, 0x30, 9, struct.pack("<IIBxxxII", 5, 2, 3, 100, 101))
    (number, content), = log.segments()
    changes = [c for kind, _, raw in wal.walk(content, number << 16) if kind == "record" for c in wal.heap_changes(wal.parse_record(raw))]
    rows = [(c["op"], *(wal.decode_tuple(*c[k], attributes) if c.get(k) else None for k in ("old", "new"))) for c in changes[:4]]
    assert rows == [("update", ["1", "abcdef"], ["1", "abcXef"]), ("delete", ["1", "abcdef"], None), ("insert", None, ["5", "p"]), ("insert", None, ["6", None])]
    assert [(c["op"], c["node"], c["cascade"], c["restart"]) for c in changes[4:]] == [("truncate", 100, True, True), ("truncate", 101, True, True)]


def test_walker_reports_what_it_skips():
    log = wal.SegmentBuilder(1 << 16)
    for k in range(600):
        log.add(wal.RM_HEAP, 0, k, b"m" * 40)
    (number, content), = log.segments()
    spoiled = content[:16384] + b"\xff" * 8192 + content[24576:]
    kinds = [k for k, _, _ in wal.walk(spoiled, number << 16)]
    assert "lost" in kinds and kinds.count("record") > 300
    assert not list(wal.walk(bytes(1 << 16), 0))


def test_segment_audit(spark):
    names = spark.createDataFrame([(1, 3), (1, 4), (1, 6), (2, 7)], "timeline int, segment_no long")
    got = sorted((r["problem"], r["segment_no"]) for r in wal.audit_segments(names, 2).collect())
    assert got == [("first segment missing", 2), ("gap", 6), ("several timelines", 3)]
    with pytest.raises(wal.WalError):
        wal.layout_for("9.6")


def test_prepared_log_transactions():
    record = {"rmid": 1, "info": 0xB0, "main": struct.pack("<qI", 0, 16 | 128) + struct.pack("<I", 55) + b"gid-1\0"}
    assert {k: wal.xact_event(record)[k] for k in ("op", "two_phase_xid", "gid")} == {"op": "commit_prepared", "two_phase_xid": 55, "gid": "gid-1"}
    assert datetime.timedelta(microseconds=wal.xact_event(record)["ts_us"]) == datetime.datetime(2000, 1, 1) - datetime.datetime(1970, 1, 1)
