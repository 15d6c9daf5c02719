"""Recorded message streams as a source: format("walwire"), in batch and as a stream.

A recording is a folder of segment files, each a run of records: seq (8 bytes), position (8 bytes), length (4 bytes), message;
big-endian. Segments are named by their first seq in 16 digits, so the list of names is the index: a batch has a partition per
segment, a stream's offset is a seq, and a trigger takes max_segments segments at most.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterable, Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, InputPartition

HEAD = struct.Struct(">qqi")


def write_segment(path: str, records: Iterable[tuple[int, int, bytes]]) -> str | None:
    """Append-only log: one new segment of (seq, position, message) records, published by renaming."""
    rows = list(records)
    if not rows:
        return None
    name = f"{rows[0][0]:016d}.wire"
    with open(os.path.join(path, name + ".part"), "wb") as f:
        for seq, position, raw in rows:
            f.write(HEAD.pack(seq, position, len(raw)) + raw)
        f.flush()
        os.fsync(f.fileno())
    os.replace(os.path.join(path, name + ".part"), os.path.join(path, name))
    return name


def read_segment(path: str, low: int = 0, high: int | None = None) -> Iterator[tuple[int, int, bytes]]:
    """Records with low <= seq < high; a record cut short is an error."""
    with open(path, "rb") as f:
        while head := f.read(HEAD.size):
            if len(head) < HEAD.size:
                raise ValueError(f"{path} ends within a record")
            seq, position, n = HEAD.unpack(head)
            raw = f.read(n)
            if len(raw) < n:
                raise ValueError(f"{path} ends within a record")
            if high is not None and seq >= high:
                return
            if seq >= low:
                yield seq, position, raw


def release_below(path: str, seq: int) -> list[str]:
    """Delete segments all of whose records lie below seq: those followed by one that starts at seq or earlier."""
    names = sorted(n for n in os.listdir(path) if n.endswith(".wire"))
    gone = [a for a, b in zip(names, names[1:], strict=False) if int(b[:16]) <= seq]
    for n in gone:
        os.remove(os.path.join(path, n))
    return gone


class _Segment(InputPartition):
    def __init__(self, path: str, low: int, high: int | None) -> None:
        self.path, self.low, self.high = path, low, high


def _segments(path: str) -> list[tuple[int, str]]:
    return sorted((int(n[:16]), os.path.join(path, n)) for n in os.listdir(path) if n.endswith(".wire"))


class _Batch(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path, self.slot, self.low, self.empty = options["path"], int(options.get("slot", 0)), int(options.get("start", 0)), False

    def pushFilters(self, filters):  # noqa: N802
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("slot",):
                self.empty |= f.value != self.slot
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        return [] if self.empty else [_Segment(p, self.low, None) for _, p in _segments(self.path)]

    def read(self, partition: _Segment | None) -> Iterator[tuple]:
        if partition is None:  # what an empty list of partitions becomes
            return
        for seq, position, raw in read_segment(partition.path, partition.low, partition.high):
            yield self.slot, seq, position, raw


class _Stream(DataSourceStreamReader):
    def __init__(self, options: dict) -> None:
        self.path, self.slot = options["path"], int(options.get("slot", 0))
        self.start, self.most = int(options.get("start", 0)), int(options.get("max_segments", 64))
        self.reached = self.start

    def initialOffset(self) -> dict:  # noqa: N802
        return {"seq": self.start}

    def latestOffset(self) -> dict:  # noqa: N802
        names = _segments(self.path)
        open_now = [k for k, (first, _) in enumerate(names) if k + 1 == len(names) or names[k + 1][0] > self.reached][: self.most]
        if open_now:
            k = open_now[-1]
            last = names[k + 1][0] if k + 1 < len(names) else max((s for s, _, _ in read_segment(names[k][1])), default=self.reached - 1) + 1
            self.reached = max(self.reached, last)
        return {"seq": self.reached}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self.reached = max(self.reached, end["seq"])
        names = _segments(self.path)
        ends = [first for first, _ in names[1:]] + [None]
        return [_Segment(p, start["seq"], end["seq"]) for (first, p), stop in zip(names, ends, strict=True) if first < end["seq"] and (stop is None or stop > start["seq"])]

    def read(self, partition: _Segment | None) -> Iterator[tuple]:
        if partition is None:  # what an empty list of partitions becomes
            return
        for seq, position, raw in read_segment(partition.path, partition.low, partition.high):
            yield self.slot, seq, position, raw

    def commit(self, end: dict) -> None:
        """What lies below a committed offset may be released; the recording's owner does it."""


class RecordedSource(DataSource):
    """Options: path, slot, start (first seq), max_segments (of a trigger)."""

    @classmethod
    def name(cls) -> str:
        return "walwire"

    def schema(self) -> str:
        return "slot int, seq long, wal_start long, raw binary"

    def reader(self, schema) -> _Batch:
        return _Batch(dict(self.options))

    def streamReader(self, schema) -> _Stream:  # noqa: N802
        return _Stream(dict(self.options))
