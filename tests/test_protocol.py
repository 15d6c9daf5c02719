"""Message codec, streaming state machine and its batch form."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import assembly
from tidemark.sources import pgoutput
from tidemark.streaming.assembler import Assembler, ProtocolError

value = st.one_of(st.none(), st.just(...), st.text(max_size=20), st.binary(max_size=20))


@given(st.lists(value, max_size=6), st.one_of(st.none(), st.integers(0, 2**32 - 1)), st.integers(0, 2**32 - 1))
def test_rows_survive(values, xid, oid):
    for kind, images in (("I", {"new": values}), ("U", {"old": values, "old_kind": "O", "new": values}), ("D", {"old": values})):
        m = pgoutput.decode_message(pgoutput.encode_message(kind, stream_xid=xid, rel_oid=oid, **images), xid is not None)
        assert m["rel_oid"] == oid and m.get("subxid") == xid
        for image in ("old", "new"):
            if image in images:
                back = [None if v["state"] == "n" else ... if v["state"] == "u" else v["text"] if v["state"] == "t" else v["bin"] for v in m[image]]
                assert back == values


@pytest.mark.parametrize(
    "kind,fields",
    [
        ("B", {"commit_lsn": 5, "xid": 7}), ("C", {"commit_lsn": 5, "end_lsn": 6}), ("c", {"commit_lsn": 5, "end_lsn": 6, "xid": 9}), ("S", {"xid": 3, "first_segment": True}), ("E", {}), ("A", {"xid": 3, "subxid": 4}),
        ("b", {"commit_lsn": 1, "end_lsn": 2, "xid": 3, "gid": "g"}), ("P", {"commit_lsn": 1, "end_lsn": 2, "xid": 3, "gid": "g"}), ("K", {"commit_lsn": 1, "end_lsn": 2, "xid": 3, "gid": "g"}), ("p", {"commit_lsn": 1, "end_lsn": 2, "xid": 3, "gid": "g"}),
        ("r", {"commit_lsn": 1, "end_lsn": 2, "xid": 3, "gid": "g"}), ("O", {"commit_lsn": 1, "prefix": "o"}), ("M", {"commit_lsn": 1, "prefix": "p", "content": b"xy", "transactional": False}), ("T", {"rel_oids": [1, 2], "options": ["CASCADE"]}),
    ],
)
def test_other_kinds_survive(kind, fields):
    raw = pgoutput.encode_message(kind, **fields)
    m = pgoutput.decode_message(raw, False)
    assert {k: m[k] for k in fields} == fields
    with pytest.raises(pgoutput.WireError):
        pgoutput.decode_message(raw + b"x", False)


def test_unknown_kind():
    with pytest.raises(pgoutput.WireError):
        pgoutput.decode_message(b"Z", False)


def test_abort_details_in_parallel_mode():
    m = pgoutput.decode_message(pgoutput.encode_message("A", xid=1, subxid=2, abort_lsn=77), False, parallel=True)
    assert m["abort_lsn"] == 77


def message(seq, kind, **f):
    return {"seq": seq, "kind": kind} | dict.fromkeys(("xid", "subxid", "gid", "first_segment", "transactional", "commit_lsn", "end_lsn")) | f


def random_stream(rng, n):
    """A legal stream of interleaved streamed, normal and prepared transactions."""
    out, live, prepared, gid = [], {}, [], 0
    add = lambda kind, **f: out.append(message(len(out), kind, **f))
    while len(out) < n:
        what = rng.random()
        if what < 0.45:
            xid = rng.choice([*live, len(out) + 1000]) if live else len(out) + 1000
            add("S", xid=xid, first_segment=xid not in live)
            live[xid] = True
            for _ in range(rng.randint(0, 3)):
                add(rng.choice("IUDT"), subxid=rng.choice([xid, 1, 2, 3]))
            add("E")
        elif what < 0.6 and live:
            xid = rng.choice([*live])
            if rng.random() < 0.6:
                add("A", xid=xid, subxid=rng.choice([1, 2, 3]))
            else:
                add("A", xid=xid, subxid=xid)
                del live[xid]
        elif what < 0.75 and live:
            xid = rng.choice([*live])
            del live[xid]
            if rng.random() < 0.5:
                add("c", xid=xid, commit_lsn=len(out), end_lsn=len(out) + 1)
            else:
                gid += 1
                add("p", xid=xid, gid=f"g{gid}")
                prepared.append(f"g{gid}")
        elif what < 0.85:
            add("B", xid=len(out))
            for _ in range(rng.randint(0, 3)):
                add(rng.choice("IUD"))
            add("C", commit_lsn=len(out), end_lsn=len(out) + 1)
        elif what < 0.93:
            gid += 1
            add("b", xid=len(out), gid=f"g{gid}")
            for _ in range(rng.randint(0, 3)):
                add(rng.choice("IUD"))
            add("P", xid=len(out), gid=f"g{gid}")
            prepared.append(f"g{gid}")
        elif prepared:
            add(rng.choice("Kr"), gid=prepared.pop(rng.randrange(len(prepared))), commit_lsn=len(out), end_lsn=len(out) + 1)
    return out


SCHEMA = "slot int, seq long, kind string, xid long, subxid long, gid string, first_segment boolean, commit_lsn long, end_lsn long, commit_ts timestamp"


def frame(spark, messages):
    return spark.createDataFrame([(0, m["seq"], m["kind"], m["xid"], m["subxid"], m["gid"], m["first_segment"], m["commit_lsn"], m["end_lsn"], None) for m in messages], SCHEMA)


@pytest.mark.parametrize("seed", [1, 2])
def test_batch_equals_state_machine(spark, seed):
    messages = random_stream(random.Random(seed), 400)
    machine, want, counts = Assembler(), [], {}
    for m in messages:
        for r in machine.on(m) or ():
            counts[r[0]] = r[6]
            if r[7] is not None:
                want.append((r[0], r[1], r[7], r[8], r[9]))
    df = frame(spark, messages).repartition(5).cache()
    got = [tuple(r) for r in assembly.changes(df, chunk=16).select("txn_key", "mode", "ord", "seq", "kind").collect()]
    assert sorted(got) == sorted(want)
    expected = {r["txn_key"]: r["expected_changes"] for r in assembly.transactions(df, chunk=16).select("txn_key", "expected_changes").collect()}
    assert expected == counts
    assert assembly.violations(df, chunk=16).count() == 0
    low = assembly.low_water_mark(df, chunk=16).first()["low_seq"]
    assert low == (machine.low_water_mark() if machine.low_water_mark() is not None else len(messages))
    df.unpersist()


BROKEN = [
    [message(0, "B"), message(1, "B")], [message(0, "C")], [message(0, "S", xid=1, first_segment=True), message(1, "S", xid=2, first_segment=True)], [message(0, "E")], [message(0, "S", xid=1, first_segment=False)],
    [message(0, "c", xid=1)], [message(0, "A", xid=1, subxid=1)], [message(0, "K", gid="g")], [message(0, "b", gid="a"), message(1, "P", gid="b")], [message(0, "I")], [message(0, "p", xid=1, gid="g")],
    [message(0, "b", gid="a"), message(1, "P", gid="a"), message(2, "b", gid="a"), message(3, "P", gid="a")],
]


@pytest.mark.parametrize("k", range(len(BROKEN)))
def test_illegal_streams(spark, k):
    machine = Assembler()
    with pytest.raises(ProtocolError):
        for m in BROKEN[k]:
            machine.on(m)
    assert assembly.violations(frame(spark, BROKEN[k])).count() > 0


def test_messages_outside_transactions_pass_by():
    assert Assembler().on(message(0, "M", transactional=False)) is None


@settings(max_examples=30)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 500)), max_size=30))
def test_releasing_segments(items):
    import tempfile

    from tidemark.sources import recorded

    with tempfile.TemporaryDirectory() as d:
        for k in range(3):
            recorded.write_segment(d, [(k * 10 + j, j, b"x" * j) for j in range(10)])
        recorded.release_below(d, 10)
        kept = [s for _, p in recorded._segments(d) for s, _, _ in recorded.read_segment(p)]
        assert kept == list(range(10, 30))


def test_recorded_source(spark, tmp_path):
    from tidemark.sources import recorded

    spark.dataSource.register(recorded.RecordedSource)
    for k in range(4):
        recorded.write_segment(str(tmp_path), [(k * 5 + j, 100, f"B{j}".encode()) for j in range(5)])
    batch = spark.read.format("walwire").option("path", str(tmp_path)).load()
    assert batch.count() == 20 and batch.where(F.col("slot") == 7).count() == 0
    stream = spark.readStream.format("walwire").option("path", str(tmp_path)).option("max_segments", 2).load()
    q = stream.writeStream.format("memory").queryName("wire_rows").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r["seq"] for r in spark.table("wire_rows").collect()) == list(range(20))
