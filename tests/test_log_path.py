"""Log segments: damage, layouts, positions, stored values; sessions and recordings of them."""

import os
import random
import socket
import struct
import threading

import pytest

from tidemark.sources import live, recorded, wal
from tidemark.streaming import catalog

ATTRIBUTES = [wal.attribute("id", 20), wal.attribute("t", 25)]


def insert(log, xid, i, text):
    return log.add(wal.RM_HEAP, 0, xid, struct.pack("<HB", 1, 0), [(7, wal.build_tuple([str(i), text], ATTRIBUTES))])


def segments(n, layout=wal.PG17, seed=1):
    rng, log = random.Random(seed), wal.SegmentBuilder(1 << 16, layout)
    at = [insert(log, 5, i, "x" * rng.choice([1, 30, 125, 126, 300, 9000])) for i in range(n)]
    return log.segments(), at


@pytest.mark.parametrize("layout", [wal.PG17, wal.PG18, wal.GAUSS, wal.GAUSS_WIDE])
def test_records_across_pages_and_segments(spark, layout):
    parts, at = segments(300, layout)
    assert len(parts) > 5
    df = spark.createDataFrame(parts, "segment_no long, content binary").repartition(4)
    records = wal.read_records(df, 1 << 16, layout)
    assert sorted(r["lsn"] for r in records.select("lsn").collect()) == at
    rows = wal.decode_rows(records, {7: ATTRIBUTES}, layout).collect()
    assert sorted(int(r["new"][0]) for r in rows) == list(range(300)) and {r["xid"] for r in rows} == {5}


def test_a_damaged_page_costs_its_records_alone(spark):
    parts, at = segments(300)
    number, content = parts[2]
    spoiled = content[: 3 * 8192] + b"\xff" * 8192 + content[4 * 8192 :]
    df = spark.createDataFrame([(n, spoiled if n == number else c) for n, c in parts], "segment_no long, content binary")
    left = {r["lsn"] for r in wal.read_records(df, 1 << 16).collect()}
    bad = range(number * (1 << 16) + 3 * 8192, number * (1 << 16) + 4 * 8192)
    lost = sorted(set(at) - left)
    assert left < set(at) and lost and all(bad.start - 10_000 < x < bad.stop for x in lost)
    health = {r["segment_no"]: r for r in wal.log_health(df, 1 << 16).collect()}
    assert health[number]["lost"] >= 1 and health[number]["lost_bytes"] >= 8192 and sum(h["lost"] for k, h in health.items() if k != number) == 0
    assert sum(h["records"] + h["tails"] for h in health.values()) >= len(left) and health[parts[-1][0]]["zero_pages"] > 0


def test_layouts_by_server():
    assert wal.layout_of(170004) is wal.PG17 and wal.layout_of(180000, "PostgreSQL 18") is wal.PG18
    assert wal.layout_of(90204, "(openGauss 5.0.1 build x)") is wal.GAUSS and wal.layout_of(90204, "PostgreSQL 9.2.4", 128) is wal.GAUSS_WIDE
    for bad in ((160000, None, None), (90204, None, None), (90204, "(openGauss 6.0.0 build x)", 128), (90204, "PostgreSQL 9.2.4", 64)):
        with pytest.raises(wal.WalError):
            wal.layout_of(*bad)


def test_transaction_records_of_the_gauss_family():
    event = lambda info, main: wal.xact_event({"info": info, "main": main}, wal.GAUSS)
    assert event(0x20, struct.pack("<qiii", 7, 0, 2, 0) + struct.pack("<QQ", 1 << 40, 9))["subs"] == [1 << 40, 9]
    assert event(0x20 | 0x04, struct.pack("<qiii", 7, 1, 1, 0) + b"\0" * 24 + struct.pack("<Q", 9))["subs"] == [9]
    assert event(0x40, struct.pack("<Qqiii", 77, 7, 0, 0, 0)) | {"ts_us": 0} == {"op": "abort_prepared", "subs": [], "gid": None, "two_phase_xid": 77, "ts_us": 0, "top_xid": None}
    assert event(0x50, struct.pack("<Qi4xQ", 5, 1, 6))["top_xid"] == 5
    for info, main in ((0x00, b"\0" * 20), (0x60, struct.pack("<qQi4x", 0, 0, 3)), (0x10, b"\0" * 272), (0x20, struct.pack("<qiii", 7, 0, -1, 0))):
        with pytest.raises(wal.WalError):
            event(info, main)


def test_ids_that_come_back_belong_to_the_next_end(spark):
    log = wal.SegmentBuilder(1 << 16)
    insert(log, 9, 1, "kept")
    log.add(wal.RM_XACT, 0x00, 9, struct.pack("<q", 1))
    insert(log, 9, 2, "gone")
    log.add(wal.RM_XACT, 0x20, 9, struct.pack("<q", 2))
    insert(log, 9, 3, "part")
    insert(log, 8, 4, "top")
    insert(log, 9, 5, "part")
    log.add(wal.RM_XACT, 0x80, 8, struct.pack("<qIiI", 3, 2, 1, 9))
    insert(log, 9, 6, "open")
    rows = wal.decode_rows(wal.read_records(spark.createDataFrame(log.segments(), "segment_no long, content binary"), 1 << 16), {7: ATTRIBUTES})
    got = sorted((r["commit_lsn"], r["n_in_txn"], r["new"][0], r["txn_xid"]) for r in wal.committed_rows(rows, stretch=64).collect())
    assert [g[1:] for g in got] == [(1, "1", 9), (1, "3", 8), (2, "4", 8), (3, "5", 8)]


def test_sizes_of_any_byte_are_read_across_segments(spark):
    sizes = list(range(60, 900, 7)) + [0xC8, 0xE0, 0xF0, 0x1C8, 0x8080]
    log = wal.SegmentBuilder(1 << 15)
    at = [log.add(99, 0, 1, b"m" * n) for n in sizes * 8]
    df = spark.createDataFrame(log.segments(), "segment_no long, content binary")
    assert sorted(r["lsn"] for r in wal.read_records(df, 1 << 15).collect()) == at


def test_broken_stored_values():
    raw = b"abcdef" * 50
    whole = struct.pack("<I", len(raw)) + wal.pack_pglz(raw, 6)
    assert wal.stored_value(whole, len(raw)) == raw
    for data, size in ((whole, len(raw) + 1), (struct.pack("<I", len(raw) | 2 << 30) + whole[4:], len(raw)), (whole[:-3], len(raw))):
        with pytest.raises((wal.WalError, IndexError)):
            wal.stored_value(data, size)


# --- sessions


def server(frames):
    """A socket whose other end has sent these frames; and what came back, once it is closed."""
    mine, theirs = socket.socketpair()
    back = []

    def run():
        for f in frames:
            theirs.sendall(f)
        theirs.shutdown(socket.SHUT_WR)
        while part := theirs.recv(1 << 16):
            back.append(part)

    t = threading.Thread(target=run)
    t.start()
    return mine, lambda: (mine.close(), t.join(), b"".join(back))[-1]


def data(position, raw, end=None):
    return live.frame(b"d", live.DATA + struct.pack(">QQq", position, end or position + len(raw), 0) + raw)


def test_messages_are_recorded_and_confirmed(tmp_path):
    keep = live.frame(b"d", live.KEEPALIVE + struct.pack(">Qq?", 99, 0, True))
    pipe, sent = server([data(10, b"B"), keep, data(20, b"I" * 70_000), data(30, b"C"), live.frame(b"c", b"")])
    session = live.StreamSession(pipe, clock=lambda: 0)
    assert live.record_messages(session, str(tmp_path), 5, each=2) == 8
    assert [x for _, p in recorded._segments(str(tmp_path)) for x in recorded.read_segment(p)] == [(5, 10, b"B"), (6, 20, b"I" * 70_000), (7, 30, b"C")]
    assert session.confirmed == 30 and session.keepalives == 1
    replies = sent()
    assert len(replies) == 3 * len(live.frame(b"d", live.status_update(0, 0, 0, 0)))
    copy = live.RecordedSession(str(tmp_path), 6)
    assert list(copy.messages()) == [(20, b"I" * 70_000), (30, b"C")]


def test_a_log_session_writes_segments(spark, tmp_path):
    parts, at = segments(200)
    whole, start = b"".join(c for _, c in parts), parts[0][0] << 16
    pieces = [(k, whole[k : k + 5000]) for k in range(0, len(whole), 5000)]
    pieces.insert(3, pieces[1])  # bytes that come twice
    pipe, sent = server([data(start + k, raw) for k, raw in pieces] + [live.frame(b"c", b"")])
    assert live.record_log(live.StreamSession(pipe), str(tmp_path), segment_bytes=1 << 16) == start + len(whole)
    sent()
    assert not [n for n in os.listdir(tmp_path) if n.endswith(".partial")]
    files = spark.read.format("binaryFile").load(str(tmp_path))
    found = wal.segment_files(files, 1 << 16)
    assert found.count() == len(parts) and wal.audit_segments(found, parts[0][0]).count() == 0
    assert sorted(r["lsn"] for r in wal.read_records(found, 1 << 16).select("lsn").collect()) == at


def test_breaks_are_errors_and_lead_to_another_try(tmp_path):
    pipe, sent = server([data(10, b"B")[:-1]])
    with pytest.raises(live.SessionError):
        list(live.StreamSession(pipe).messages())
    sent()
    for bad in (b"x", live.DATA + b"short", live.KEEPALIVE + b"0" * 16):
        with pytest.raises(live.SessionError):
            live.parse_data(bad)
    waits = []

    def run(k):
        if k < 3:
            raise live.SessionError("broke off")
        return "done"

    assert live.supervise(run, sleep=waits.append, most=3) == "done" and waits == [1, 2, 3]
    with pytest.raises(live.SessionError):
        live.supervise(lambda k: run(0), attempts=2, sleep=waits.append)
    assert live.start_command("s", (3 << 32) + 255, ["p"]) == "START_REPLICATION SLOT \"s\" LOGICAL 3/FF (proto_version '4', publication_names '\"p\"', messages 'true', streaming 'on')"
    assert live.start_command("s", 0) == 'START_REPLICATION SLOT "s" PHYSICAL 0/0'


# --- catalogs


def test_catalog_rows_are_followed_and_healed():
    known = {("class", 4, 5): {"oid": 1}, ("attribute", 2, 2): {"rel_oid": 1, "attnum": 1, "name": "a"}}
    c = catalog.Catalog(lambda kind, block, offset: known.get((kind, block, offset)))
    c.seed([("class", 0, 1, {"oid": 10, "filenode": 100})], 50)
    c.track("t", "class", 0, 1)
    c.apply(60, 61, "update", "class", 0, 1, {"oid": 10, "filenode": 101}, (0, 2))
    c.apply(62, 63, "redirect", "class", 0, 2, to=(0, 7))
    assert c.where("t") == (0, 7) and c.relation(101)["oid"] == 10
    c.apply(64, 65, "redirect", "class", 4, 4, to=(4, 5))
    c.apply(66, 67, "redirect", "namespace", 4, 4, to=(4, 5))
    c.apply(68, 69, "update", "attribute", 2, 1, None, (2, 2))
    assert c.counts["adopted"] == c.counts["healed"] == c.counts["missing"] == 1 and c.columns_of(1)[0]["name"] == "a"
    with pytest.raises(catalog.CatalogError):
        c.apply(70, 71, "update", "attribute", 9, 9, None, (9, 9))
    c.apply(72, 73, "dead", "class", 0, 7)
    assert c.where("t") is None
    assert catalog.Catalog.parse(c.dump(5))[1] == 5


# --- stored values


def test_quick_and_careful_readers_agree():
    rng = random.Random(4)
    oids = [20, 23, 21, 25, 1043, 701, 16, 17]
    for _ in range(400):
        attributes = [wal.attribute(f"c{k}", rng.choice(oids)) for k in range(rng.randint(1, 8))]
        values = []
        for a in attributes:
            if rng.random() < 0.1:
                values.append(None)
            elif a.length < 0:
                values.append("x" * rng.choice([0, 1, 5, 125, 126, 127, 4000]))
            else:
                values.append({701: repr(rng.choice([0.1, -2.5, 1e300, 3.0])), 16: rng.choice("tf")}.get(a.type_oid, str(rng.randint(-30_000, 30_000))))
        raw = wal.build_tuple(values, attributes)
        parts = (*struct.unpack_from("<HHB", raw), raw[5:])
        careful = wal.decode_tuple(*parts, attributes)
        assert wal.TupleDecoder(attributes).parts(*parts) == careful
        log = wal.SegmentBuilder(1 << 16)
        log.add(wal.RM_HEAP, 0, 77, struct.pack("<HB", 1, 0), [(7, raw)])
        ((kind, _, record),) = [x for _, c in log.segments() for x in wal.walk(c, 1 << 16)]
        xid, node, at = wal._plain_insert(record, wal.PG17)
        assert (kind, xid, node) == ("record", 77, 7) and wal.TupleDecoder(attributes)(record, at) == careful


@pytest.mark.parametrize(
    "oid,raw,text",
    [
        (790, struct.pack("<q", -1205), "-12.05"), (600, struct.pack("<dd", 1, -0.5), "(1,-0.5)"), (27, struct.pack("<HHH", 1, 2, 3), "(65538,3)"), (829, bytes(range(6)), "00:01:02:03:04:05"), (1562, struct.pack("<i", 5) + b"\xb0", "10110"),
        (869, bytes([2, 24, 10, 0, 0, 1]), "10.0.0.1/24"), (869, bytes([3, 128]) + b"\0" * 15 + b"\1", "::1"), (650, bytes([2, 32, 10, 0, 0, 1]), "10.0.0.1/32"), (1186, struct.pack("<qii", 1_000_000, -1, 14), "1 year 2 mons -1 days +00:00:01"),
        (5069, struct.pack("<Q", 1 << 40), str(1 << 40)),
    ],
)
def test_stored_text(oid, raw, text):
    assert wal.disk_text(oid, raw) == text


def test_readers_hold_few_segments(spark):
    """A row group is what a reader holds at a time: segments are large rows."""
    import pyarrow.parquet as pq

    from tidemark.plans import log

    files = log._segments(spark, "/root/testdata/sf0.01", log._stored).inputFiles()
    groups = [g for f in files for m in (pq.ParquetFile(f.removeprefix("file://")).metadata,) for g in (m.row_group(k).num_rows for k in range(m.num_row_groups))]
    assert sum(groups) > 32 and max(groups) <= 32
