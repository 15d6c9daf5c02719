"""WARC archives: a writer with payload de-duplication and a reader that salvages damaged archives.

An archive is one row (archive_id, content): the bytes of one .warc.gz file, of bounded size. The same reader takes the
(path, content) rows of Spark's binaryFile source, so archives from elsewhere are read alike, packed (a record a member or
many) or plain. Urls return as they were: characters that a head line can't hold are escaped in WARC-Target-URI and the url
itself goes along in a head line of our own.

Defined results: null html is an empty payload; null url leaves the target out; null page_id is kept and never chosen as the
record that others refer to unless all are null; repeated rows give a record each, and all rows that hold the largest page_id
of a payload are responses; an empty table gives no archive. Records of one member share its offset and length.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .workspace import Workspace

VERSION = b"WARC/1.1"
MEMBER = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
START = re.compile(rb"\x1f\x8b\x08|WARC/\d\.\d\r\n")
START_PLAIN = re.compile(rb"WARC/\d\.\d\r\n")
HEAD = re.compile(rb"WARC/\d\.\d\r\n((?:[^\r\n:]+:[^\r\n]*\r\n)*)\r\n")
#: Characters that a head line can't hold, at its ends or at all; the head line for urls with such, and what stands there as it is.
UNSAFE = re.compile(r"[\x00-\x20\x7f]|^\s|\s$")
OWN_URL, URL_SAFE = "X-Page-URL", "/:?#[]@!$&'()*+,;="
#: Bytes given to the unpacker at a time, so that finding a member's end copies little.
CHUNK = 1 << 15
RECORDS = pa.schema(
    [("archive_id", pa.string()), ("kind", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("reason", pa.string()), ("page_id", pa.int64()), ("url", pa.string()),
     ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())]
)
RECORDS_DDL = "archive_id string, kind string, offset long, length long, reason string, page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def decide(pages: DataFrame, minimum_bytes: int = 0, heavy: int = 1000) -> DataFrame:
    """(page_id, url, payload, refers_to): which records revisit another.

    The groups of equal payloads are counted on their digests alone, partially before the shuffle. Groups with more than one
    in heavy of all rows, heavy at most, are broadcast; all other keys are small, so no key of the look-up is hot, whatever
    share of the pages one payload has. Payloads move once.
    """
    work = Workspace(pages.sparkSession, "warc-digests")
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"))
    own = own.withColumn("_digest", F.sha1("payload"))
    slim = work.stage(own.where(F.length("payload") >= minimum_bytes).select("page_id", "_digest"), "pages")
    groups = work.stage(slim.groupBy("_digest").agg(F.max("page_id").alias("_last"), F.count(F.lit(1)).alias("_n")).where("_n > 1"), "groups")
    rows = slim.count()
    large = F.broadcast(groups.where(F.col("_n") * heavy > rows).select("_digest", "_last"))
    small = groups.where(F.col("_n") * heavy <= rows).select("_digest", "_last")
    later = slim.join(large, "_digest").unionByName(slim.join(large, "_digest", "left_anti").join(small, "_digest"))
    later = later.where(~F.col("page_id").eqNullSafe(F.col("_last"))).select("page_id", "_digest", F.col("_last").alias("refers_to")).distinct()
    known = later.select(F.coalesce("page_id", F.lit(0)).alias("_id"), F.col("page_id").isNull().alias("_null"), "_digest", "refers_to")
    own = own.withColumn("_id", F.coalesce("page_id", F.lit(0))).withColumn("_null", F.col("page_id").isNull())
    return own.join(known, ["_id", "_null", "_digest"], "left").select("page_id", "url", "payload", "refers_to")


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _number(name: str | None) -> int | None:
    m = re.fullmatch(r"<urn:page:(-?\d+)>", name or "")
    return int(m[1]) if m else None


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One packed record. A revisit carries the payload's HTTP head, and so its length, but not the payload."""
    revisit = refers_to is not None
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload) + (b"" if revisit else payload)
    head = [f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_name(page_id)}", "WARC-Date: 1970-01-01T00:00:00Z", "Content-Type: application/http;msgtype=response"]
    if url is not None:
        uri = UNSAFE.sub(lambda m: quote(m[0], safe=""), url)
        head += [f"WARC-Target-URI: {uri}"] + [f"{OWN_URL}: {quote(url, safe=URL_SAFE)}"] * (uri != url)
    if revisit:
        head += [f"WARC-Refers-To: {_name(refers_to)}", f"WARC-Profile: {PROFILE}"]
    head += [f"WARC-Payload-Digest: sha1:{digest(payload)}", f"WARC-Block-Digest: sha1:{digest(block)}", f"Content-Length: {len(block)}"]
    pack = zlib.compressobj(3, zlib.DEFLATED, 31)
    return pack.compress(VERSION + b"\r\n" + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + pack.flush()


def write_archives(decided: DataFrame, archive_bytes: int = 4 << 20) -> DataFrame:
    """(archive_id, content) rows of at most archive_bytes each, or of one record; named after their first record, so a task that runs again makes the same."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[bytes] = []
        size, first = 0, ""

        def archive() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"archive_id": [first], "content": [b"".join(parts)]}, schema=pa.schema([("archive_id", pa.string()), ("content", pa.binary())]))

        for batch in batches:
            ids, urls, payloads, refers = (batch.column(k) for k in range(4))
            for k in range(batch.num_rows):
                page_id = ids[k].as_py()
                record = record_bytes(page_id, urls[k].as_py(), payloads[k].as_py(), refers[k].as_py())
                if parts and size + len(record) > archive_bytes:
                    yield archive()
                    parts, size = [], 0
                if not parts:
                    first = f"{page_id}.warc.gz"
                parts.append(record)
                size += len(record)
        if parts:
            yield archive()

    return decided.mapInArrow(write, "archive_id string, content binary")


def _record(data: bytes, at: int = 0, vouched: bool = False) -> tuple[dict | None, int, str]:
    """The record at a place in data and its end, or None and why not. vouched: only if a digest of its block agrees."""
    m = HEAD.match(data, at)
    if not m:
        return None, 0, "no version line or a broken head"
    head = {k.strip(" \t").lower(): v.strip(" \t") for k, _, v in (line.partition(":") for line in m[1].decode("utf-8", "replace").split("\r\n") if line)}
    size = head.get("content-length", "")
    if not (size.isascii() and size.isdigit()) or len(size) > 18:
        return None, 0, "no content length"
    end = m.end() + int(size)
    if data[end : end + 4] != b"\r\n\r\n":
        return None, 0, "content length and record end differ"
    block = data[m.end() : end]
    claimed = head.get("warc-block-digest", "").removeprefix("sha1:")
    if claimed != digest(block) if claimed else vouched:
        return None, 0, "block digest differs" if claimed else "no block digest in a broken member"
    kind = head.get("warc-type")
    http, _, payload = block.partition(b"\r\n\r\n") if head.get("content-type", "").startswith("application/http") else (b"", b"", block)
    known = head.get("warc-payload-digest", "").removeprefix("sha1:")
    length = len(payload)
    if kind == "revisit":
        m = re.search(rb"(?i)\r\ncontent-length:\s*(\d{1,18})", http)
        length = int(m[1]) if m else None
    elif known and known != digest(payload):
        return None, 0, "payload digest differs"
    url = unquote(head[OWN_URL.lower()]) if OWN_URL.lower() in head else head.get("warc-target-uri")
    return {
        "page_id": _number(head.get("warc-record-id")), "url": url, "record_type": kind, "payload_bytes": length, "payload_digest": known or digest(payload),
        "refers_to": _number(head.get("warc-refers-to")), "payload": None if kind == "revisit" else payload,
    }, end + 4, ""


def _unpacked(content: bytes, at: int) -> tuple[bytes, int, str]:
    """What the member at a place holds, where it ends, and why it is broken, if it is (then what came out before that)."""
    unpack, parts, end, view = zlib.decompressobj(31), [], at, memoryview(content)
    try:
        while end < len(content) and not unpack.eof:
            parts.append(unpack.decompress(view[end : end + CHUNK]))
            end = min(len(content), end + CHUNK)
    except zlib.error as error:
        return b"".join(parts), 0, f"broken member: {error}"
    return b"".join(parts), end - len(unpack.unused_data), "" if unpack.eof else "truncated member"


def _member(content: bytes, at: int) -> tuple[list[dict], int, str]:
    """All records of the member at a place, where it ends, and what is wrong with it or with one of them."""
    data, end, why = _unpacked(content, at)
    found, place, broken = [], 0, bool(why)
    while place < len(data):
        row, after, reason = _record(data, place, vouched=broken)
        if row:
            found.append(row)
            place = after
            continue
        why = why or (reason if not found or data.startswith(b"WARC/", place) else "bytes after the record in its member")
        m = START_PLAIN.search(data, place + 1)
        place = m.start() if m else len(data)
    return found, end, why or ("" if found else "an empty member")


def salvage(content: bytes) -> Iterator[dict]:
    """The records of one archive in order, and a gap for every stretch of bytes that holds none.

    After a failed check the search goes on at the next member or version line, so a damaged record costs itself alone. A
    member in which only some records hold gives these, and is a gap as well.
    """
    at, gap, why, n = 0, None, "", len(content)
    while at < n:
        found, end, reason = [], 0, "no member or version line"
        if content.startswith(MEMBER, at):
            found, end, reason = _member(content, at)
        elif content.startswith(b"WARC/", at):
            row, end, reason = _record(content, at)
            found = [row] if row else []
        if found and gap is not None:
            yield {"kind": "gap", "offset": gap, "length": at - gap, "reason": why}
            gap = None
        for row in found:
            yield row | {"kind": "record", "offset": at, "length": (end or n) - at}
        if end and (found or reason == "an empty member"):
            if reason and found:
                yield {"kind": "gap", "offset": at, "length": end - at, "reason": reason}
            at = end
            continue
        if gap is None:
            gap, why = at, reason
        m = START.search(content, at + 1)
        at = m.start() if m else n
    if gap is not None:
        yield {"kind": "gap", "offset": gap, "length": n - gap, "reason": why}


def read_archives(archives: DataFrame, name: str = "archive_id", with_payload: bool = True) -> DataFrame:
    """A row per record and per quarantined gap of (name, content) archives."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                own, rows, size = batch.column(0)[k].as_py(), [], 0
                for row in salvage(batch.column(1)[k].as_py() or b""):
                    size += len(row.get("payload") or b"")
                    rows.append(row | {"archive_id": own} | ({} if with_payload else {"payload": None}))
                    if with_payload and size > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=RECORDS)
                        rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=RECORDS)

    return archives.select(F.col(name).alias("archive_id"), "content").mapInArrow(read, RECORDS_DDL)
