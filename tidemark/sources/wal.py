"""Write-ahead-log segments: pages, records, heap tuples and transaction records.

Segments are parsed in parallel. A record that crosses a segment's end leaves a tail there and a head in the next one; tails and
heads are few, and are put together by a grouping afterwards, so no task needs two segments.
"""

from __future__ import annotations

import ipaddress
import json
import struct
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, replace
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import pgvalues
from ..operators.lookups import assemble_chunks, joined_bytes
from ..operators.sequence import as_of_join, running_sum


@dataclass(frozen=True)
class Layout:
    """What differs between servers."""

    magic: int = 0xD116
    page: int = 8192
    record_header: int = 24
    stats_item: int = 12
    xid_at: int = 4
    info_at: int = 16
    node_bytes: int = 12
    block_tail: int = 0  # bytes behind a block reference's page number
    update_main: int = 14
    delete_main: int = 8
    name_bytes: int = 64
    gauss: bool = False  # transaction ids of 64 bits, its own transaction records, images that state their hole only


# Page magics and record layouts of server versions.
PG17, PG18 = Layout(), Layout(magic=0xD118, stats_item=16)
GAUSS = Layout(magic=0xD074, record_header=32, xid_at=8, info_at=24, node_bytes=14, block_tail=8, update_main=13, delete_main=11, gauss=True)
GAUSS_WIDE = replace(GAUSS, name_bytes=128)
LAYOUTS = {"17": PG17, "18": PG18}
#: Transaction records of the openGauss family: offsets of the sub-transactions in whole and compact commits, aborts and
#: assignments, sizes of a relation entry, and by magic the size of a prepare's header.
GAUSS_COMMIT, GAUSS_COMPACT, GAUSS_ABORT, GAUSS_ASSIGNMENT = 48, 24, 20, 16
GAUSS_RELATION, GAUSS_RELATION_PACKED, GAUSS_PACKED = 20, 24, 0x04
GAUSS_PREPARE = {0x57F94532: 264, 0x57F94533: 272, 0x57F94534: 272}
GAUSS_GID, GAUSS_GID_BYTES = 53, 200
GAUSS_XACT_OPS = {0x60: "commit", 0x70: "abort"}
CONTINUES, LONG_PAGE = 1, 2
RM_XACT, RM_HEAP2, RM_HEAP = 1, 9, 10
HEAP_OPS = {0x00: "insert", 0x10: "delete", 0x20: "update", 0x30: "truncate", 0x40: "update", 0x50: "confirm", 0x60: "lock", 0x70: "inplace"}
XACT_OPS = {0x00: "commit", 0x10: "prepare", 0x20: "abort", 0x30: "commit_prepared", 0x40: "abort_prepared", 0x50: "assignment", 0x60: "invalidations"}


class WalError(ValueError):
    """Bytes that are no log."""


def layout_for(version: str) -> Layout:
    """By the major number of a server version text."""
    major = version.split(".")[0].strip()
    if major not in LAYOUTS:
        raise WalError(f"no layout for server version {version}")
    return LAYOUTS[major]


def layout_of(number: int, text: str | None = None, name_bytes: int | None = None) -> Layout:
    """By server_version_num; releases that report 9.2 are told apart by the version's text, or else by the length of a name
    column in the catalog."""
    if number // 10_000 in (17, 18):
        return LAYOUTS[str(number // 10_000)]
    if number // 10_000 == 9:
        if text and "openGauss" in text:
            if "openGauss 5.0." in text:
                return GAUSS
        elif name_bytes == 128:
            return GAUSS_WIDE
    raise WalError(f"no layout for server {number}: {text} (names of {name_bytes} bytes)")


def _aligned(n: int, to: int = 8) -> int:
    return -(-n // to) * to


_offset = itemgetter(0)


def walk(segment: bytes, start: int, layout: Layout = PG17) -> Iterator[tuple[str, int, bytes]]:
    """(kind, lsn, bytes) of one segment that begins at start: a head (the rest of an earlier record), records, a tail.

    A page of zeros ends the log. A page whose header is wrong makes the walker go on at the next good page that starts a
    record; what it skipped is reported as lost.
    """
    data, marks = bytearray(), []  # payload of pages in a row; (offset in data, lsn) where each page's payload begins
    head_left, first = 0, True

    def lsn_of(at: int) -> int:
        o, lsn = marks[bisect_right(marks, at, key=_offset) - 1]
        return lsn + at - o

    def after(end: int) -> int:
        """Where the next record starts: alignment counts in log positions, which jump at page headers."""
        o, lsn = marks[max(0, bisect_left(marks, end, key=_offset) - 1)]
        return o + _aligned(lsn + end - o) - lsn

    def records(final: bool) -> Iterator[tuple[str, int, bytes]]:
        at, whole, size, header = 0, bytes(data), len(data), layout.record_header
        if head_left:
            # Behind a damaged page it is the rest of a record whose beginning is lost.
            yield "head" if marks[0][1] - start <= 40 else "lost", marks[0][1], whole[: min(head_left, size)]
            at = after(head_left) if head_left < size else size
        k, last = bisect_right(marks, at, key=_offset) - 1, len(marks) - 1
        while at + 4 <= size:
            total = int.from_bytes(whole[at : at + 4], "little")
            if total == 0:
                return
            if total < header:
                yield "lost", lsn_of(at), whole[at:]
                return
            end = at + total
            if end > size:
                yield "tail" if final else "lost", lsn_of(at), whole[at:]
                return
            while k < last and marks[k + 1][0] <= at:
                k += 1
            yield "record", marks[k][1] + at - marks[k][0], whole[at:end]
            while k < last and marks[k + 1][0] < end:
                k += 1
            offset, lsn = marks[k]
            at = offset - lsn + (lsn + end - offset + 7 & -8)
        if at < size and any(whole[at:]):
            yield "tail" if final else "lost", lsn_of(at), whole[at:]

    for at in range(0, len(segment), layout.page):
        page = segment[at : at + layout.page]
        if not any(page):
            break
        magic, info, _, address, rest = struct.unpack_from("<HHIQI", page)
        size = 40 if info & LONG_PAGE else 24
        if magic != layout.magic or address != start + at:
            if marks:
                yield from records(False)
            yield "lost", start + at, page
            data, marks, head_left, first = bytearray(), [], 0, True
            continue
        if first:
            head_left, first = rest if info & CONTINUES else 0, False
        marks.append((len(data), start + at + size))
        data += page[size:]
    if marks:
        yield from records(True)


def read_records(segments: DataFrame, segment_bytes: int = 16 << 20, layout: Layout = PG17, end_lsn: int | None = None) -> DataFrame:
    """(lsn, raw) of all records of (segment_no, content) rows; those that cross segments are put together."""
    schema = pa.schema([("segment_no", pa.int64()), ("kind", pa.string()), ("lsn", pa.int64()), ("raw", pa.binary())])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for number, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                kinds, lsns, raws, held = [], [], [], 0
                for kind, lsn, raw in walk(content, number * segment_bytes, layout):
                    kinds.append(kind)
                    lsns.append(lsn)
                    raws.append(raw)
                    held += len(raw)
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array([number] * len(lsns), pa.int64()), pa.array(kinds, pa.string()), pa.array(lsns, pa.int64()), pa.array(raws, pa.binary())], schema=schema)
                        kinds, lsns, raws, held = [], [], [], 0
                yield pa.RecordBatch.from_arrays([pa.array([number] * len(lsns), pa.int64()), pa.array(kinds, pa.string()), pa.array(lsns, pa.int64()), pa.array(raws, pa.binary())], schema=schema)

    parts = segments.select("segment_no", "content").mapInArrow(parse, "segment_no long, kind string, lsn long, raw binary")
    records = parts.where("kind = 'record'").select("lsn", "raw").unionByName(_glued(parts.where("kind in ('head', 'tail')"), segment_bytes))
    return records if end_lsn is None else records.where(F.col("lsn") < end_lsn)


def _glued(parts: DataFrame, segment_bytes: int) -> DataFrame:
    """(lsn, raw) of the records whose heads and tails these are: a few rows a segment, numbered in stretches of 4096 segments."""
    pieces = running_sum(parts.withColumn("all", F.lit(0)), (F.col("kind") == "tail").cast("int"), "number", ["all"], "lsn", segment_bytes << 12)
    joined = pieces.where("number > 0").groupBy("number").agg(F.sort_array(F.collect_list(F.struct("lsn", "raw"))).alias("p"))
    glued = joined.select(F.col("p")[0]["lsn"].alias("lsn"), joined_bytes("p", "raw").alias("raw"))
    size = F.conv(F.concat(*(F.hex(F.substring("raw", k, 1)) for k in (4, 3, 2, 1))), 16, 10).cast("long")
    return glued.where(F.length("raw") == size)


HEALTH = ("records", "heads", "tails", "lost", "lost_bytes", "zero_pages")


def log_health(segments: DataFrame, segment_bytes: int = 16 << 20, layout: Layout = PG17) -> DataFrame:
    """(segment_no, records, heads, tails, lost, lost_bytes, zero_pages): what the walker met in each segment: whole records,
    rests of records before it and beginnings of records behind it, stretches it had to skip, and pages after the log's end."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for number, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                seen = dict.fromkeys(HEALTH, 0)
                for kind, _, raw in walk(content, number * segment_bytes, layout):
                    seen["lost" if kind == "lost" else kind + "s"] += 1
                    seen["lost_bytes"] += len(raw) if kind == "lost" else 0
                pages = [content[k : k + layout.page] for k in range(0, len(content), layout.page)]
                seen["zero_pages"] = sum(not any(p) for p in pages)
                yield pa.RecordBatch.from_pylist([{"segment_no": number} | seen])

    return segments.select("segment_no", "content").mapInArrow(count, "segment_no long, " + ", ".join(f"{n} long" for n in HEALTH))


def audit_segments(segments: DataFrame, first: int) -> DataFrame:
    """(problem, segment_no): the first segment is missing, gaps, more than one timeline. segments: timeline, segment_no."""
    order = Window.orderBy("segment_no")
    numbers = segments.select("segment_no").distinct().withColumn("_before", F.lag("segment_no").over(order))
    gaps = numbers.where("_before is not null and segment_no <> _before + 1").select(F.lit("gap").alias("problem"), "segment_no")
    missing = segments.agg(F.min("segment_no").alias("segment_no")).where(F.col("segment_no").isNull() | (F.col("segment_no") > first)).select(F.lit("first segment missing").alias("problem"), F.lit(first).cast("long").alias("segment_no"))
    lines = segments.agg(F.count_distinct("timeline").alias("n"), F.min("segment_no").alias("segment_no")).where("n > 1").select(F.lit("several timelines").alias("problem"), "segment_no")
    return gaps.unionByName(missing).unionByName(lines)


def parse_record(raw: bytes, layout: Layout = PG17) -> dict:
    """Header, block references with image and data, main data."""
    total, xid, previous, info, rmid, crc = struct.unpack_from("<I4xQQBB2xI" if layout.gauss else "<IIQBB2xI", raw)
    if total != len(raw):
        raise WalError(f"record of {total} bytes in {len(raw)}")
    at, blocks, main_size, origin, top = layout.record_header, [], 0, None, None
    left, same = total - at, None
    while left > main_size + sum(b["image_size"] + b["data_size"] for b in blocks):
        (key,) = struct.unpack_from("<B", raw, at)
        if key in (254, 255):
            main_size = raw[at + 1] if key == 255 else struct.unpack_from("<I", raw, at + 1)[0]
            used = 2 if key == 255 else 5
        elif key == 253:
            (origin,), used = struct.unpack_from("<H", raw, at + 1), 3
        elif key == 252:
            (top,), used = struct.unpack_from("<I", raw, at + 1), 5
        elif key <= 32:
            flags, size = struct.unpack_from("<BH", raw, at + 1)
            used, image, hole, hole_size, image_info = 4, 0, 0, 0, 0
            if flags & 0x10 and layout.gauss:
                hole, hole_size = struct.unpack_from("<HH", raw, at + used)
                image, used = layout.page - hole_size, used + 4
            elif flags & 0x10:
                image, hole, image_info = struct.unpack_from("<HHB", raw, at + used)
                used += 5
                if image_info & 0x1C and image_info & 1:
                    (hole_size,) = struct.unpack_from("<H", raw, at + used)
                    used += 2
                elif image_info & 1:
                    hole_size = layout.page - image
            if not flags & 0x80:
                same = struct.unpack_from("<III", raw, at + used)
                used += layout.node_bytes
            if same is None:
                raise WalError("block refers to an earlier relation that isn't there")
            (number,) = struct.unpack_from("<I", raw, at + used)
            used += 4 + layout.block_tail
            blocks.append({"id": key, "flags": flags, "image_size": image, "hole": hole, "hole_size": hole_size, "image_info": image_info, "data_size": size, "space": same[0], "db": same[1], "node": same[2], "number": number})
        else:
            raise WalError(f"unknown block id {key}")
        at, left = at + used, left - used
    for b in blocks:
        b["image"], at = raw[at : at + b["image_size"]], at + b["image_size"]
        b["data"], at = raw[at : at + b["data_size"]], at + b["data_size"]
    return {"xid": xid, "top_xid": top, "rmid": rmid, "info": info, "blocks": blocks, "main": raw[at : at + main_size], "origin": origin, "prev": previous, "crc": crc}


def page_image(block: dict) -> bytes:
    """The page of a full-page image, its hole filled with zeros."""
    if block["image_info"] & 0x1C:
        raise WalError("compressed page image")
    return block["image"][: block["hole"]] + bytes(block["hole_size"]) + block["image"][block["hole"] :]


def page_tuple(page: bytes, offset: int) -> bytes:
    """The item at a 1-based line pointer, with its tuple header."""
    (pointer,) = struct.unpack_from("<I", page, 24 + 4 * (offset - 1))
    at, flags, size = pointer & 0x7FFF, pointer >> 15 & 3, pointer >> 17
    if flags != 1:
        raise WalError(f"line pointer {offset} holds no tuple")
    return page[at : at + size]


@dataclass(frozen=True)
class Attribute:
    name: str
    type_oid: int
    length: int  # -1: variable
    align: int


# Storage length and alignment of types.
STORAGE = {16: (1, 1), 18: (1, 1), 21: (2, 2), 23: (4, 4), 20: (8, 8), 26: (4, 4), 700: (4, 4), 701: (8, 8), 1082: (4, 4), 1083: (8, 8), 1114: (8, 8), 1184: (8, 8), 1266: (12, 8), 2950: (16, 1), 19: (64, 1), 28: (4, 4), 29: (4, 4), 27: (6, 2), 600: (16, 8), 790: (8, 8), 829: (6, 4), 774: (8, 4), 1186: (16, 8), 5069: (8, 8)}


def attribute(name: str, type_oid: int) -> Attribute:
    return Attribute(name, type_oid, *STORAGE.get(type_oid, (-1, 4)))


def decode_tuple(infomask2: int, infomask: int, hoff: int, body: bytes, attributes: list[Attribute]) -> list:
    """Values of a tuple whose body begins after the 23 fixed header bytes: text, None for null, and for a value stored
    elsewhere ("toast", raw size, stored size, value id, relation)."""
    stored, at = infomask2 & 0x7FF, hoff - 23
    out: list = []
    for k, a in enumerate(attributes):
        if k >= stored or infomask & 1 and not body[k >> 3] >> (k & 7) & 1:
            out.append(None)
            continue
        if a.length < 0:
            if at < len(body) and body[at] == 0:  # padding before a long header
                at = _aligned(at + 23, a.align) - 23
            value, at = _varlena(body, at)
            out.append(value if isinstance(value, tuple) else disk_text(a.type_oid, value))
        else:
            at = _aligned(at + 23, a.align) - 23
            raw, at = body[at : at + a.length], at + a.length
            if len(raw) < a.length:
                raise WalError(f"tuple ends within {a.name}")
            out.append(disk_text(a.type_oid, raw))
    return out


def _plain_insert(raw: bytes, layout: Layout) -> tuple[int, int, int] | None:
    """(xid, node, where the tuple's header begins) of an insert with one block that holds its data, as nearly all have; None
    for any other record."""
    if layout.gauss or raw[16] & 0x70 or raw[24] or raw[25] != 0x20 or raw[44] != 255:
        return None
    return int.from_bytes(raw[4:8], "little"), int.from_bytes(raw[36:40], "little"), 46


class TupleDecoder:
    """decode_tuple for one relation, with a reader for each column made beforehand."""

    def __init__(self, attributes: list[Attribute]) -> None:
        self.attributes = attributes
        self.readers = [(a.length, a.align, _NUMBERS.get(a.type_oid), a.type_oid) for a in attributes]

    def __call__(self, raw: bytes, at: int) -> list:
        """The tuple of a plain insert: its header stands at a place of the record, its size in the block reference."""
        mask2, mask, hoff = struct.unpack_from("<HHB", raw, at)
        return self.parts(mask2, mask, hoff, raw[at + 5 : at + int.from_bytes(raw[26:28], "little")])

    def parts(self, mask2: int, mask: int, hoff: int, body: bytes) -> list:
        if mask & 1 or mask2 & 0x7FF < len(self.readers):
            return decode_tuple(mask2, mask, hoff, body, self.attributes)
        at, out, size = hoff - 23, [], len(body)
        for length, align, number, oid in self.readers:
            if length < 0:
                if at >= size:
                    raise WalError("tuple ends before a value")
                first = body[at]
                if first & 1 and first != 1:  # a short header
                    end = at + (first >> 1)
                    value = body[at + 1 : end]
                    out.append(value.decode() if oid == 25 or oid == 1043 else disk_text(oid, value))
                    at = end
                    continue
                if not first:
                    at = _aligned(at + 23, align) - 23
                value, at = _varlena(body, at)
                out.append(value if isinstance(value, tuple) else disk_text(oid, value))
                continue
            at = (at + 23 + align - 1) // align * align - 23
            end = at + length
            if end > size:
                raise WalError("tuple ends within a value")
            out.append(number(body, at) if number else disk_text(oid, body[at:end]))
            at = end
        return out


def _varlena(body: bytes, at: int) -> tuple:
    if at >= len(body):
        raise WalError("tuple ends before a value")
    first = body[at]
    if first == 1:
        if body[at + 1] != 18:
            raise WalError(f"pointer kind {body[at + 1]}")
        raw_size, info, value, relation = struct.unpack_from("<iIII", body, at + 2)
        return ("toast", raw_size - 4, info & 0x3FFFFFFF, value, relation), at + 18
    if first & 1:
        size = first >> 1
        return body[at + 1 : at + size], at + size
    (head,) = struct.unpack_from("<I", body, at)
    size = head >> 2
    content = body[at + 4 : at + size]
    if head & 3 == 2:
        return inflate(content), at + size
    return content, at + size


def _number(form: str):
    unpack = struct.Struct(form).unpack_from
    return lambda body, at: str(unpack(body, at)[0])


def _double(body: bytes, at: int) -> str:
    return pgvalues.float_text(struct.unpack_from("<d", body, at)[0], 15)


#: Readers of numbers by type.
_NUMBERS = {21: _number("<h"), 23: _number("<i"), 20: _number("<q"), 26: _number("<I"), 701: _double}


def inflate(content: bytes) -> bytes:
    """A compressed value: raw size and method, then the stream."""
    (info,) = struct.unpack_from("<I", content)
    return (pglz if info >> 30 == 0 else lz4)(content[4:], info & 0x3FFFFFFF)


def pglz(data: bytes, size: int) -> bytes:
    out, at = bytearray(), 0
    while at < len(data) and len(out) < size:
        control, at = data[at], at + 1
        for bit in range(8):
            if at >= len(data) or len(out) >= size:
                break
            if control >> bit & 1:
                length, back = (data[at] & 15) + 3, (data[at] & 0xF0) << 4 | data[at + 1]
                at += 2
                if length == 18:
                    length, at = length + data[at], at + 1
                _copy(out, back, length)
            else:
                out.append(data[at])
                at += 1
    if len(out) != size:
        raise WalError("compressed value of a wrong size")
    return bytes(out)


def lz4(data: bytes, size: int) -> bytes:
    out, at = bytearray(), 0

    def extended(n: int) -> int:
        nonlocal at
        if n == 15:
            while True:
                n, at = n + data[at], at + 1
                if data[at - 1] != 255:
                    break
        return n

    while at < len(data):
        token, at = data[at], at + 1
        literals = extended(token >> 4)
        out += data[at : at + literals]
        at += literals
        if at >= len(data):
            break
        back, at = struct.unpack_from("<H", data, at)[0], at + 2
        _copy(out, back, extended(token & 15) + 4)
    if len(out) != size:
        raise WalError("compressed value of a wrong size")
    return bytes(out)


def _copy(out: bytearray, back: int, length: int) -> None:
    if not 0 < back <= len(out):
        raise WalError("copy from before the start")
    for _ in range(length):
        out.append(out[-back])


def disk_numeric(raw: bytes) -> str:
    """Short, long and special headers."""
    (head,) = struct.unpack_from("<H", raw)
    if head & 0xC000 == 0xC000:
        return {0xC000: "NaN", 0xD000: "Infinity", 0xF000: "-Infinity"}[head & 0xF000]
    if head & 0x8000:
        sign, scale, weight, at = 0x4000 if head & 0x2000 else 0, head >> 7 & 0x3F, (head & 0x3F) - (0x40 if head & 0x40 else 0), 2
    else:
        sign, scale, weight, at = head & 0x4000, head & 0x3FFF, struct.unpack_from("<h", raw, 2)[0], 4
    n = (len(raw) - at) // 2
    groups = struct.unpack_from(f"<{n}H", raw, at)
    return pgvalues.numeric_text(struct.pack(">HhHH", n, weight, sign, scale) + struct.pack(f">{n}H", *groups))


def disk_text(oid: int, raw: bytes) -> str:
    """A stored value as text: little-endian numbers, then as on the wire."""
    if oid == 1700:
        return disk_numeric(raw)
    if oid == 19:
        return raw.split(b"\0")[0].decode()
    if oid in (21, 23, 20, 26, 28, 29, 700, 701, 1082, 1083, 1114, 1184):
        return pgvalues.binary_text(oid, raw[::-1])
    if oid == 1266:
        return pgvalues.binary_text(oid, raw[7::-1] + raw[:7:-1])
    if oid == 1186:
        return pgvalues.interval_text(*struct.unpack("<qii", raw))
    if oid == 5069:
        return str(int.from_bytes(raw, "little"))
    if oid == 790:  # cents, without a locale's sign
        cents = int.from_bytes(raw, "little", signed=True)
        return f"{'-' if cents < 0 else ''}{abs(cents) // 100}.{abs(cents) % 100:02d}"
    if oid == 600:
        return "({},{})".format(*(pgvalues.float_text(x, 15) for x in struct.unpack("<dd", raw)))
    if oid == 27:
        high, low, place = struct.unpack("<HHH", raw)
        return f"({high << 16 | low},{place})"
    if oid in (829, 774):
        return raw.hex(":")
    if oid in (1560, 1562):
        return "".join(f"{x:08b}" for x in raw[4:])[: struct.unpack_from("<i", raw)[0]]
    if oid in (869, 650):
        address = ipaddress.ip_address(raw[2 : 6 if raw[0] == 2 else 18])
        return f"{address}/{raw[1]}" if oid == 650 or raw[1] != address.max_prefixlen else str(address)
    return pgvalues.binary_text(oid, raw)


def splice(old: bytes, prefix: int, suffix: int, middle: bytes) -> bytes:
    """A new tuple's data whose beginning and end are those of the old one."""
    if prefix + suffix > len(old):
        raise WalError("prefix and suffix exceed the old tuple")
    return old[:prefix] + middle + (old[len(old) - suffix :] if suffix else b"")


def heap_changes(record: dict, layout: Layout = PG17) -> Iterator[dict]:
    """Row changes of a heap record: op, node, tuple parts (infomask2, infomask, hoff, body) of the old and new row."""
    shift = 8 if layout.gauss and record["info"] & 0x80 else 0  # a new page's base of transaction ids comes first

    def tuple_at(raw: bytes, at: int = 0) -> tuple:
        mask2, mask, hoff = struct.unpack_from("<HHB", raw, at)
        return mask2, mask, hoff, raw[at + 5 :]

    main, blocks = record["main"], record["blocks"]
    if record["rmid"] == RM_HEAP2:
        if record["info"] & 0x70 != 0x50:
            return
        packed, n = struct.unpack_from("<xBH", main, shift)
        if layout.gauss and packed:
            raise WalError("page dictionaries are not supported")
        data, at = blocks[0]["data"], 0
        for _ in range(n):
            at = _aligned(at, 2)
            size, mask2, mask, hoff = struct.unpack_from("<HHHB", data, at)
            yield {"op": "insert", "node": blocks[0]["node"], "new": (mask2, mask, hoff, data[at + 7 : at + 7 + size])}
            at += 7 + size
        return
    op = HEAP_OPS[record["info"] & 0x70]
    if op == "insert":
        block = blocks[0]
        if block["data"]:
            yield {"op": op, "node": block["node"], "new": tuple_at(block["data"])}
        elif block["image"]:
            whole = page_tuple(page_image(block), struct.unpack_from("<H", main, shift)[0])
            yield {"op": op, "node": block["node"], "new": (*struct.unpack_from("<HHB", whole, 18), whole[23:])}
    elif op == "delete":
        flags = main[shift + 2 if layout.gauss else 7]
        yield {"op": op, "node": blocks[0]["node"], "old": tuple_at(main, shift + layout.delete_main) if flags & 6 else None}
    elif op == "update":
        flags, old, block = main[shift + 4 if layout.gauss else 7], None, blocks[0]
        if flags & 0x0C:
            old = tuple_at(main, shift + layout.update_main)
        data, at, prefix, suffix = block["data"], 0, 0, 0
        if flags & 0x20:
            (prefix,), at = struct.unpack_from("<H", data, at), at + 2
        if flags & 0x40:
            (suffix,), at = struct.unpack_from("<H", data, at), at + 2
        new = tuple_at(data, at) if data else None
        if new and (prefix or suffix):
            if old is None or not flags & 0x04:
                yield {"op": "skipped_update", "node": block["node"]}  # parts of the row are only on the page
                return
            skip = new[2] - 23
            new = (*new[:3], new[3][:skip] + splice(old[3][old[2] - 23 :], prefix, suffix, new[3][skip:]))
        yield {"op": op, "node": block["node"], "old": old, "new": new}
    elif op == "truncate" and not layout.gauss:
        _, n, flags = struct.unpack_from("<IIB", main)
        for oid in struct.unpack_from(f"<{n}I", main, 12):
            yield {"op": op, "node": oid, "cascade": bool(flags & 1), "restart": bool(flags & 2)}


# Operations of page pruning and what their flags announce.
PRUNE_OPS, FREEZES, REDIRECTS, DEAD, UNUSED = (0x10, 0x20, 0x30), 0x10, 0x20, 0x40, 0x80


def pruned_items(record: dict) -> Iterator[tuple[str, int, int | None]]:
    """(op, offset, new offset) of a pruning record: redirects first, then dead and unused line pointers."""
    main, data, at = record["main"], record["blocks"][0]["data"], 0
    flags = main[1]
    if not data:
        return
    if flags & FREEZES:
        at = 4 + 12 * struct.unpack_from("<H", data)[0]
    for bit, op, width in ((REDIRECTS, "redirect", 2), (DEAD, "dead", 1), (UNUSED, "unused", 1)):
        if flags & bit:
            (n,) = struct.unpack_from("<H", data, at)
            items = struct.unpack_from(f"<{n * width}H", data, at + 2)
            at += 2 + 2 * n * width
            for k in range(0, len(items), width):
                yield op, items[k], items[k + 1] if width == 2 else None


def addressed_changes(record: dict, layout: Layout = PG17) -> Iterator[dict]:
    """Changes of a heap record with the addresses of their rows, as catalogs need them: op, node, block, pos, to (block and pos
    an update or redirect leads to), new (tuple parts) or data (an in-place row's bytes behind its header)."""
    main, blocks, info, op = record["main"], record["blocks"], record["info"], record["info"] & 0x70
    if not blocks or layout.gauss:
        return
    node, here = blocks[0]["node"], blocks[0]["number"]
    if record["rmid"] == RM_HEAP2:
        if op in PRUNE_OPS:
            for what, pos, to in pruned_items(record):
                yield {"op": what, "node": node, "block": here, "pos": pos, "to": None if to is None else (here, to)}
        elif op == 0x50:
            (n,) = struct.unpack_from("<H", main, 2)
            places = range(1, n + 1) if info & 0x80 else struct.unpack_from(f"<{n}H", main, 4)
            for pos, change in zip(places, heap_changes(record, layout), strict=True):
                yield {"op": "insert", "node": node, "block": here, "pos": pos, "new": change["new"]}
        return
    kind = HEAP_OPS[op]
    if kind == "inplace":
        yield {"op": kind, "node": node, "block": here, "pos": struct.unpack_from("<H", main)[0], "data": blocks[0]["data"]}
        return
    for change in heap_changes(record, layout):
        if kind == "insert":
            yield {"op": kind, "node": node, "block": here, "pos": struct.unpack_from("<H", main)[0], "new": change["new"]}
        elif kind == "delete":
            yield {"op": kind, "node": node, "block": here, "pos": struct.unpack_from("<H", main, 4)[0]}
        elif kind == "update":
            old, new = struct.unpack_from("<4xH6xH", main)
            there = next((b["number"] for b in blocks[1:] if b["number"] != here), here)
            yield {"op": kind, "node": node, "block": there, "pos": old, "to": (here, new), "new": change.get("new")}


CATALOG_DDL = "slot int, lsn long, end_lsn long, op string, kind string, block int, pos int, row string, to_block int, to_pos int"


def catalog_changes(records: DataFrame, catalogs: dict[int, tuple[str, list[Attribute]]], layout: Layout = PG17, slot: int = 0) -> DataFrame:
    """Changes of catalog relations (by file node: kind and columns) as streaming.catalog folds them. A row that was cut to its
    middle has a null row, which a probe may heal."""
    known = records.sparkSession.sparkContext.broadcast(catalogs)
    schema = pa.schema([(n, {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}[t]) for n, t in (x.split() for x in CATALOG_DDL.split(", "))])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for lsn, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if raw[layout.info_at + 1] not in (RM_HEAP, RM_HEAP2):
                    continue
                record = parse_record(raw, layout)
                for x in addressed_changes(record, layout):
                    if x["node"] not in known.value:
                        continue
                    kind, attributes = known.value[x["node"]]
                    values = None
                    if x.get("new"):
                        values = decode_tuple(*x["new"], attributes)
                    elif x.get("data"):
                        values = decode_tuple(len(attributes), 0, 24, b"\0" + x["data"], attributes)
                    row = None if values is None else json.dumps({a.name: _json_value(a, v) for a, v in zip(attributes, values, strict=True)})
                    to = x.get("to") or (None, None)
                    out.append({"slot": slot, "lsn": lsn, "end_lsn": lsn + _aligned(len(raw)), "op": x["op"], "kind": kind, "block": x["block"], "pos": x["pos"], "row": row, "to_block": to[0], "to_pos": to[1]})
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return records.select("lsn", "raw").mapInArrow(read, CATALOG_DDL)


def _json_value(a: Attribute, text: object) -> object:
    return int(text) if isinstance(text, str) and a.type_oid in (20, 21, 23, 26) else text if isinstance(text, str) else None


def xact_event(record: dict, layout: Layout = PG17) -> dict:
    """op, time, sub-transactions, two-phase xid and gid of a transaction record."""
    op, main = XACT_OPS.get(record["info"] & 0x70), record["main"]
    out: dict = {"op": op, "subs": [], "gid": None, "two_phase_xid": None, "ts_us": None, "top_xid": None}
    if layout.gauss:
        return out | _gauss_xact_event(record)
    if op == "assignment":
        top, n = struct.unpack_from("<Ii", main)
        return out | {"top_xid": top, "subs": list(struct.unpack_from(f"<{n}I", main, 8))}
    if op not in ("commit", "abort", "commit_prepared", "abort_prepared"):
        return out
    out["ts_us"], at = struct.unpack_from("<q", main)[0] + 946_684_800_000_000, 8
    flags = 0
    if record["info"] & 0x80:
        (flags,), at = struct.unpack_from("<I", main, at), at + 4
    if flags & 1:
        at += 8
    for bit, size in ((2, 4), (4, 12), (256, layout.stats_item), (8, 16)):
        if flags & bit:
            (n,) = struct.unpack_from("<i", main, at)
            if bit == 2:
                out["subs"] = list(struct.unpack_from(f"<{n}I", main, at + 4))
            at += 4 + n * size
    if flags & 16:
        (out["two_phase_xid"],), at = struct.unpack_from("<I", main, at), at + 4
        if flags & 128:
            out["gid"] = main[at : main.index(b"\0", at)].decode()
    return out


POINTER = "struct<place: int, raw_size: long, stored_size: long, value_id: long, relation: long>"
def _gauss_xact_event(record: dict) -> dict:
    """The same for records of the openGauss family: counts at fixed places, ids of 64 bits, the gid in the prepare only."""
    code, main, info = record["info"] & 0x70, record["main"], record["info"]
    op = GAUSS_XACT_OPS.get(code) or XACT_OPS.get(code)

    def subs(at: int, n: int) -> list[int]:
        if n < 0 or at + 8 * n > len(main):
            raise WalError(f"{n} sub-transactions at {at} of {len(main)} bytes")
        return list(struct.unpack_from(f"<{n}Q", main, at))

    def members(base: int, counts: int, names: int) -> list[int]:
        relations, n = struct.unpack_from("<ii", main, base + counts)
        return subs(base + names + relations * (GAUSS_RELATION_PACKED if info & GAUSS_PACKED else GAUSS_RELATION), n)

    try:
        if op == "assignment":
            top, n = struct.unpack_from("<Qi", main)
            return {"op": op, "top_xid": top, "subs": subs(GAUSS_ASSIGNMENT, n)}
        if op == "prepare":
            magic, xid, at, n = (struct.unpack_from(f, main, k)[0] for f, k in (("<I", 0), ("<Q", 8), ("<q", 24), ("<i", 36)))
            if magic not in GAUSS_PREPARE:
                raise WalError(f"unknown prepare {magic:#x}")
            gid, end, _ = main[GAUSS_GID : GAUSS_GID + GAUSS_GID_BYTES].partition(b"\0")
            if not end:
                raise WalError("gid without end")
            return {"op": op, "two_phase_xid": xid, "ts_us": at + 946_684_800_000_000, "gid": gid.decode(), "subs": subs(GAUSS_PREPARE[magic], n)}
        if op not in ("commit", "abort", "commit_prepared", "abort_prepared"):
            return {"op": op}
        base = 8 if op.endswith("prepared") else 0
        out = {"op": op, "ts_us": struct.unpack_from("<q", main, base)[0] + 946_684_800_000_000}
        if base:
            out["two_phase_xid"] = struct.unpack_from("<Q", main)[0]
        if code == 0x60:
            return out | {"subs": subs(GAUSS_COMPACT, struct.unpack_from("<i", main, 16)[0])}
        return out | {"subs": members(base, 24, GAUSS_COMMIT) if op.startswith("commit") else members(base, 8, GAUSS_ABORT)}
    except struct.error as error:
        raise WalError(f"transaction record {op} of {len(main)} bytes") from error


ROWS_DDL = f"lsn long, xid long, top_xid long, op string, node long, ord int, old array<string>, new array<string>, unchanged array<int>, pointers array<{POINTER}>, cascade boolean, restart boolean, subs array<long>, gid string, ts_us long"


def _row_schema() -> pa.Schema:
    pointer = pa.struct([("place", pa.int32()), *((n, pa.int64()) for n in ("raw_size", "stored_size", "value_id", "relation"))])
    fields = [("lsn", pa.int64()), ("xid", pa.int64()), ("top_xid", pa.int64()), ("op", pa.string()), ("node", pa.int64()), ("ord", pa.int32()), ("old", pa.list_(pa.string())), ("new", pa.list_(pa.string())), ("unchanged", pa.list_(pa.int32())), ("pointers", pa.list_(pointer)), ("cascade", pa.bool_()), ("restart", pa.bool_()), ("subs", pa.list_(pa.int64())), ("gid", pa.string()), ("ts_us", pa.int64())]
    return pa.schema(fields)


class _RowReader:
    """Records to row changes and transaction events, as Arrow columns."""

    def __init__(self, relations: dict[int, list[Attribute]], layout: Layout) -> None:
        self.decoders = {node: TupleDecoder(attributes) for node, attributes in relations.items()}
        self.layout, self.schema = layout, _row_schema()

    def __call__(self, records: Iterable[tuple[int, bytes]]) -> list[pa.Array]:
        decoders, layout, schema = self.decoders, self.layout, self.schema
        names = [f.name for f in schema]
        columns: dict[str, list] = {n: [] for n in names}
        lsns, xids, ops, nodes, ords, olds, news, lacks, points = (columns[n] for n in ("lsn", "xid", "op", "node", "ord", "old", "new", "unchanged", "pointers"))
        rest = [columns[n] for n in names if n not in ("lsn", "xid", "op", "node", "ord", "old", "new", "unchanged", "pointers")]
        more: list[tuple[int, dict]] = []  # (row, fields that few rows have)

        def add(lsn: int, xid: int, op: str, node: int | None, k: int | None, old: list | None, new: list | None) -> None:
            lsns.append(lsn)
            xids.append(xid)
            ops.append(op)
            nodes.append(node)
            ords.append(k)
            olds.append(old)
            news.append(new)
            if new is None:
                lacks.append(None)
                points.append(None)
            elif tuple in map(type, new):
                away = [n for n, v in enumerate(new) if type(v) is tuple]
                lacks.append(away)
                points.append([dict(zip(("place", "raw_size", "stored_size", "value_id", "relation"), (n, *new[n][1:]), strict=True)) for n in away])
                news[-1] = [None if type(v) is tuple else v for v in new]
            else:
                lacks.append([])
                points.append([])

        for lsn, raw in records:
            rmid = raw[layout.info_at + 1]
            if rmid not in (RM_XACT, RM_HEAP, RM_HEAP2):
                continue
            if rmid == RM_HEAP and (quick := _plain_insert(raw, layout)):
                xid, node, at = quick
                if node in decoders:
                    add(lsn, xid, "insert", node, 0, None, decoders[node](raw, at))
                continue
            record = parse_record(raw, layout)
            if rmid == RM_XACT:
                event = xact_event(record, layout)
                xid = event.pop("two_phase_xid") or record["xid"]
                more.append((len(lsns), {k: v for k, v in event.items() if k != "op"}))
                add(lsn, xid, event["op"], None, None, None, None)
                continue
            for k, change in enumerate(heap_changes(record, layout)):
                decoder = decoders.get(change["node"])
                if decoder is None and change["op"] != "truncate":
                    continue
                old, new = (decoder.parts(*change[x]) if change.get(x) else None for x in ("old", "new"))
                if change["op"] == "truncate" or record["top_xid"] is not None:
                    more.append((len(lsns), {"cascade": change.get("cascade"), "restart": change.get("restart"), "top_xid": record["top_xid"]}))
                add(lsn, record["xid"], change["op"], change["node"], k, old and [None if type(v) is tuple else v for v in old], new)
        for c in rest:
            c.extend([None] * len(lsns))
        for row, fields in more:
            for name, value in fields.items():
                columns[name][row] = value
        return [pa.array(columns[f.name], f.type) for f in schema]


def decode_rows(records: DataFrame, relations: dict[int, list[Attribute]], layout: Layout = PG17) -> DataFrame:
    """Row changes of known relations (by file node) and transaction events of (lsn, raw) records.

    A value stored elsewhere is null here, its place is listed in unchanged and where it is stored in pointers; see with_stored.
    """
    known = records.sparkSession.sparkContext.broadcast(relations)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _RowReader(known.value, layout)
        for b in batches:
            yield pa.RecordBatch.from_arrays(reader(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)), schema=reader.schema)

    return records.select("lsn", "raw").mapInArrow(decode, ROWS_DDL)


def read_rows(segments: DataFrame, relations: dict[int, list[Attribute]], land: Callable[[DataFrame], DataFrame], segment_bytes: int = 16 << 20, layout: Layout = PG17, records: int = 20_000) -> DataFrame:
    """decode_rows of read_records in one pass over the segments: only what crosses a segment's end leaves the pass as bytes.

    land writes a table and reads it back (the rows are read several times afterwards, the pieces of records once more).
    """
    known = segments.sparkSession.sparkContext.broadcast(relations)
    extra = [("kind", pa.string()), ("raw", pa.binary())]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _RowReader(known.value, layout)
        schema = pa.schema([*reader.schema, *(pa.field(*x) for x in extra)])

        def rows(held: list[tuple[int, bytes]]) -> pa.RecordBatch:
            columns = reader(held)
            return pa.RecordBatch.from_arrays([*columns, *(pa.nulls(len(columns[0]), t) for _, t in extra)], schema=schema)

        for b in batches:
            for number, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                held, pieces = [], []
                for kind, lsn, raw in walk(content, number * segment_bytes, layout):
                    if kind == "record":
                        held.append((lsn, raw))
                        if len(held) == records:
                            yield rows(held)
                            held = []
                    elif kind != "lost":
                        pieces.append({"lsn": lsn, "kind": kind, "raw": raw})
                yield rows(held)
                yield pa.RecordBatch.from_pylist(pieces, schema=schema)

    parts = land(segments.select("segment_no", "content").mapInArrow(read, f"{ROWS_DDL}, kind string, raw binary"))
    whole = parts.where("kind is null").drop("kind", "raw")
    return whole.unionByName(decode_rows(_glued(parts.where("kind is not null").select("kind", "lsn", "raw"), segment_bytes), relations, layout))


def committed_rows(rows: DataFrame, stretch: int = 1 << 24) -> DataFrame:
    """Row changes of committed transactions with commit_lsn, txn_xid and their ordinal in it, by position in the log.

    A row belongs to the next end that names its xid: a commit or abort names its own and its sub-transactions', an abort of a
    sub-transaction its own, a prepared transaction ends with its commit-prepared. An xid that comes again later is another
    transaction. The next end is carried backwards over stretches of the log, ordinals forwards, so that no transaction,
    however long, meets in one task. rows are read several times: land them first if they come out of a decoder.
    """
    none = F.expr("cast(array() as array<long>)")
    ends = rows.where(F.col("op").isin("commit", "commit_prepared", "abort", "abort_prepared"))
    # Where a decision doesn't name its gid, the prepare before it does.
    named = as_of_join(ends, rows.where("op = 'prepare' and gid is not null"), "xid", "lsn", "gid", "_gid", stretch)
    ends = named.withColumn("gid", F.coalesce("gid", F.when(F.col("op").endswith("prepared"), F.col("_gid"))))
    end = F.struct(F.col("op").startswith("commit").alias("kept"), F.col("lsn").alias("commit_lsn"), F.col("xid").alias("txn_xid"), "gid", "ts_us")
    members = ends.select(end.alias("_end"), (-F.col("lsn")).alias("_behind"), F.explode(F.array_distinct(F.concat(F.array("xid"), F.coalesce("subs", none)))).alias("xid"))
    # Only places and ids travel; the rows themselves are joined to what is left, once.
    changes = rows.where(F.col("op").isin("insert", "update", "delete", "truncate", "skipped_update")).drop("gid", "ts_us", "subs")
    slim = changes.select("lsn", "ord", "xid", (-F.col("lsn")).alias("_behind"))
    ended = as_of_join(slim, members, "xid", "_behind", "_end", "_end", stretch).where("_end.kept")
    flat = ended.select("lsn", "ord", *(F.col(f"_end.{c}").alias(c) for c in ("commit_lsn", "txn_xid", "gid", "ts_us")))
    # A record has fewer than 1024 changes: more tuples don't fit on a page.
    placed = flat.withColumn("_place", F.col("lsn") * 1024 + F.col("ord"))
    return changes.join(running_sum(placed, F.lit(1), "n_in_txn", ["commit_lsn"], "_place", stretch << 10).drop("_place"), ["lsn", "ord"])


#: How rows of the relations that hold out-of-line values are stored.
CHUNK_ATTRIBUTES = [Attribute("chunk_id", 26, 4, 4), Attribute("chunk_seq", 23, 4, 4), Attribute("chunk_data", 17, -1, 4)]


def stored_chunks(rows: DataFrame, nodes: list[int]) -> DataFrame:
    """(relation, value_id, chunk_seq, data) of inserts into the relations that hold out-of-line values (decoded with
    CHUNK_ATTRIBUTES), rolled-back ones included: a value that nothing refers to is never asked for."""
    new = lambda k: F.col("new")[k]
    own = rows.where((F.col("op") == "insert") & F.col("node").isin(*nodes))
    return own.select(F.col("node").alias("relation"), new(0).cast("long").alias("value_id"), new(1).cast("int").alias("chunk_seq"), F.unhex(F.substr(new(2), F.lit(3))).alias("data"))


def with_stored(rows: DataFrame, chunks: DataFrame, unavailable: str | None = None) -> DataFrame:
    """rows with the values that the log stores elsewhere put in their place in new.

    A pointer whose chunks the log holds gives its text (decompressed where the stored size is smaller than the raw one; a
    size or method that differs from the pointer is an error of the value). Without chunks the value is unchanged: its place
    stays in unchanged and shows unavailable. pointer_problems lists places whose chunks are there but broken.
    """
    keyed = rows.select("lsn", "ord", F.explode("pointers").alias("p")).select("lsn", "ord", F.col("p.place").alias("place"), F.col("p.raw_size").alias("raw_size"), F.col("p.stored_size").alias("size"), F.concat_ws(":", "p.relation", "p.value_id").alias("value_id"))
    own = chunks.select(F.concat_ws(":", "relation", "value_id").alias("value_id"), "chunk_seq", "data")
    asked = keyed.select("value_id", "size", "raw_size").dropDuplicates(["value_id"])

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, problems = [], []
            for value, raw_size, problem in zip(*(b.column(k).to_pylist() for k in (1, 2, 3)), strict=True):
                text = None
                if value is not None:
                    try:
                        if len(value) < raw_size:
                            value = stored_value(value, raw_size)
                        text = value.decode() if len(value) == raw_size else None
                        problem = None if text is not None else "wrong size"
                    except (WalError, ValueError, IndexError, struct.error) as error:
                        problem = str(error) or "broken value"
                texts.append(text)
                problems.append(problem)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string()), pa.array(problems, pa.string())], names=["value_id", "text", "problem"])

    values = assemble_chunks(asked, own).select("value_id", "value", "raw_size", "problem").mapInArrow(unpack, "value_id string, text string, problem string")
    found = keyed.join(values, "value_id").groupBy("lsn", "ord").agg(F.collect_list(F.struct("place", "text", "problem")).alias("_found"))
    joined = rows.join(found, ["lsn", "ord"], "left")
    at = lambda k: F.filter("_found", lambda x: x["place"] == k)[0]
    held = lambda k: F.array_contains(F.coalesce("unchanged", F.expr("cast(array() as array<int>)")), k)
    new = F.transform("new", lambda v, k: F.when(~held(k), v).otherwise(F.coalesce(at(k)["text"], F.lit(unavailable))))
    still = F.filter("unchanged", lambda k: at(k)["text"].isNull())
    problems = F.transform(F.filter("_found", lambda x: x["problem"].isNotNull() & (x["problem"] != "no chunk")), lambda x: F.concat_ws(": ", x["place"].cast("string"), x["problem"]))
    return joined.withColumns({"new": new, "unchanged": still, "pointer_problems": problems}).drop("_found")


def stored_value(data: bytes, raw_size: int) -> bytes:
    """An out-of-line value that is stored compressed: raw size and method, which the pointer must agree with, then the stream."""
    (info,) = struct.unpack_from("<I", data)
    if info & 0x3FFFFFFF != raw_size:
        raise WalError(f"value of {info & 0x3FFFFFFF} bytes where {raw_size} were announced")
    if info >> 30 > 1:
        raise WalError(f"unknown compression {info >> 30}")
    return inflate(data)


class SegmentBuilder:
    """Writes records into pages and segments: the inverse of walk, for tests and examples."""

    def __init__(self, segment_bytes: int, layout: Layout = PG17, first: int = 1) -> None:
        self.size, self.layout, self.first = segment_bytes, layout, first
        self.out, self.previous = bytearray(), 0

    def _position(self) -> int:
        return self.first * self.size + len(self.out)

    def _page(self, rest: int) -> None:
        here = self._position()
        long = here % self.size == 0
        info = (CONTINUES if rest else 0) | (LONG_PAGE if long else 0)
        self.out += struct.pack("<HHIQI4x", self.layout.magic, info, 1, here, rest) + (struct.pack("<QII", 1, self.size, self.layout.page) if long else b"")

    def add(self, rmid: int, info: int, xid: int, main: bytes, blocks: list[tuple[int, bytes]] = (), top_xid: int | None = None) -> int:
        """blocks: (file node, data), (file node, data, page) or (file node, data, page or None, block number). Returns the
        record's position."""
        head, body = b"", b""
        for k, (node, data, *image) in enumerate((b[0], b[1], *b[2:3]) for b in blocks):
            number = blocks[k][3] if len(blocks[k]) > 3 else 0
            image = [x for x in image if x]
            head += struct.pack("<BBH", k, (0x20 if data else 0) | (0x10 if image else 0), len(data))
            gauss = self.layout.gauss
            if image:
                hole = struct.unpack_from("<HH", image[0], 12)  # lower, upper
                head += struct.pack("<HH", hole[0], hole[1] - hole[0]) if gauss else struct.pack("<HHB", len(image[0]) - (hole[1] - hole[0]), hole[0], 1)
                body += image[0][: hole[0]] + image[0][hole[1] :]
            head += struct.pack("<IIIhIQ", 1663, 5, node, -1, number, 0) if gauss else struct.pack("<IIII", 1663, 5, node, number)
            body += data
        if top_xid is not None:
            head += struct.pack("<BI", 252, top_xid)
        head += struct.pack("<BB", 255, len(main)) if len(main) < 256 else struct.pack("<BI", 254, len(main))
        total = self.layout.record_header + len(head) + len(body) + len(main)
        while len(self.out) % 8:
            self.out += b"\0"
        if self._position() % self.layout.page == 0:
            self._page(0)
        lsn = self._position()
        start = struct.pack("<I4xQQBBxxI" if self.layout.gauss else "<IIQBBxxI", total, xid, self.previous, info, rmid, 0)
        raw = start + head + body + main
        self.previous = lsn
        while raw:
            room = self.layout.page - self._position() % self.layout.page
            self.out += raw[:room]
            raw = raw[room:]
            if raw:
                self._page(len(raw))
        return lsn

    def segments(self) -> list[tuple[int, bytes]]:
        out = bytes(self.out)
        return [(self.first + k, out[k * self.size : (k + 1) * self.size].ljust(self.size, b"\0")) for k in range(-(-len(out) // self.size))]


def build_tuple(values: list[str | None], attributes: list[Attribute]) -> bytes:
    """xl_heap_header and body of a row, for examples: text, int and float types; bytes are a stored value, header and all."""
    nulls = any(v is None for v in values)
    bits = sum(1 << k for k, v in enumerate(values) if v is not None).to_bytes((len(values) + 7) // 8, "little") if nulls else b""
    hoff = _aligned(23 + len(bits))
    body = bytearray(bits.ljust(hoff - 23, b"\0"))
    for v, a in zip(values, attributes, strict=True):
        if v is None:
            continue
        if isinstance(v, bytes):
            body += b"" if a.length < 0 and v[0] & 1 else bytes(_aligned(len(body) + 23, a.align) - 23 - len(body))
            body += v
        elif a.length < 0:
            raw = v.encode()
            if len(raw) < 126:
                body += bytes([len(raw) + 1 << 1 | 1]) + raw
            else:
                body += bytes(_aligned(len(body) + 23, a.align) - 23 - len(body)) + struct.pack("<I", len(raw) + 4 << 2) + raw
        else:
            body += bytes(_aligned(len(body) + 23, a.align) - 23 - len(body))
            form = {21: "<h", 23: "<i", 20: "<q", 26: "<I", 701: "<d", 700: "<f", 1114: "<q", 1082: "<i"}.get(a.type_oid)
            body += struct.pack(form, float(v) if a.type_oid in (700, 701) else int(v)) if form else (b"\1" if v == "t" else b"\0")
    return struct.pack("<HHB", len(values), 1 if nulls else 0, hoff) + bytes(body)


def build_page(items: list[bytes], page: int = 8192) -> bytes:
    """A heap page with tuples (header included) at line pointers 1, 2, ..., for examples."""
    out, upper = bytearray(page), page
    for k, item in enumerate(items):
        upper = (upper - len(item)) & ~7
        out[upper : upper + len(item)] = item
        struct.pack_into("<I", out, 24 + 4 * k, upper | 1 << 15 | len(item) << 17)
    struct.pack_into("<HHHH", out, 10, 0, 24 + 4 * len(items), upper, page)
    return bytes(out)


def pack_numeric(text: str) -> bytes:
    """A decimal text of few digits as it is stored, with its short header, for examples."""
    wire = pgvalues.numeric_bytes(text)
    n, weight, sign, scale = struct.unpack_from(">HhHH", wire)
    groups = struct.unpack_from(f">{n}H", wire, 8)
    return struct.pack("<H", 0x8000 | (0x2000 if sign else 0) | scale << 7 | weight & 0x7F) + struct.pack(f"<{n}H", *groups)


def pack_short(raw: bytes) -> bytes:
    """A variable-length value of less than 127 bytes with its header."""
    return bytes([len(raw) + 1 << 1 | 1]) + raw


def pack_pglz(raw: bytes, period: int) -> bytes:
    """A compressed stream of a text that repeats its first period bytes, for examples."""
    items: list[bytes | tuple[int, int]] = [raw[k : k + 1] for k in range(period)]
    left = len(raw) - period
    while left >= 3:
        items.append((period, min(left, 273)))
        left -= items[-1][1]
    items += [raw[len(raw) - left + k : len(raw) - left + k + 1] for k in range(left)]
    out = b""
    for k in range(0, len(items), 8):
        control, body = 0, b""
        for n, x in enumerate(items[k : k + 8]):
            if isinstance(x, tuple):
                back, size = x
                control |= 1 << n
                body += bytes([back >> 4 & 0xF0 | min(size - 3, 15), back & 255]) + (bytes([size - 18]) if size >= 18 else b"")
            else:
                body += x
        out += bytes([control]) + body
    return out


def segment_files(files: DataFrame, segment_bytes: int = 16 << 20) -> DataFrame:
    """(timeline, segment_no, content) of binaryFile rows named as the server names segments; a finished segment wins over a
    partial one."""
    name = F.element_at(F.split("path", "/"), -1)
    hexed = lambda a: F.conv(F.substring(name, a, 8), 16, 10).cast("long")
    per = (1 << 32) // segment_bytes
    rows = files.where(name.rlike(r"^[0-9A-F]{24}(\.partial)?$")).select(hexed(1).alias("timeline"), (hexed(9) * per + hexed(17)).alias("segment_no"), name.endswith(".partial").alias("_partial"), "content")
    return rows.groupBy("timeline", "segment_no").agg(F.min_by("content", F.col("_partial").cast("int")).alias("content"))


def tail_segments(spark, path: str) -> DataFrame:
    """A stream of the folder's segments as they are finished."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    return spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", "*").load(path)
