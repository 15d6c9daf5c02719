"""Replication sessions: the frames that a server and its receiver exchange, a receiver over any byte stream, recordings of it,
and a supervisor that starts it again.

A session is whatever gives (position, bytes) and takes confirmations: a socket to a server, or a recording of one. What it
gives is recorded in segments that the rest of the engine reads (sources.recorded for messages, segment files for the log), so
only this module needs a server.
"""

from __future__ import annotations

import os
import struct
import time
from collections.abc import Callable, Iterator
from typing import Protocol

from .recorded import read_segment, write_segment

# Letters of the frames, and microseconds between 1970 and 2000.
DATA, KEEPALIVE, STATUS = b"w", b"k", b"r"
EPOCH_US = 946_684_800_000_000


class SessionError(ConnectionError):
    """A stream that ends, or bytes that are no frame."""


class Pipe(Protocol):
    """A byte stream, such as a socket."""

    def recv(self, n: int) -> bytes: ...

    def sendall(self, data: bytes) -> None: ...


def frame(letter: bytes, payload: bytes) -> bytes:
    """A protocol message: its letter, its length with itself, its payload."""
    return letter + struct.pack(">I", len(payload) + 4) + payload


def _exactly(pipe: Pipe, n: int) -> bytes:
    out = b""
    while len(out) < n:
        part = pipe.recv(n - len(out))
        if not part:
            raise SessionError("the stream ended within a frame" if out or n != 1 else "the stream ended")
        out += part
    return out


def read_frame(pipe: Pipe) -> tuple[bytes, bytes]:
    letter = _exactly(pipe, 1)
    (size,) = struct.unpack(">I", _exactly(pipe, 4))
    if size < 4:
        raise SessionError(f"frame of {size} bytes")
    return letter, _exactly(pipe, size - 4)


def parse_data(payload: bytes) -> dict:
    """The content of a copy-data frame: log data with its position, or a keepalive that may ask for a reply."""
    kind = payload[:1]
    if kind == DATA and len(payload) >= 25:
        start, end, us = struct.unpack_from(">QQq", payload, 1)
        return {"kind": "data", "start": start, "end": end, "ts_us": us + EPOCH_US, "raw": payload[25:]}
    if kind == KEEPALIVE and len(payload) == 18:
        end, us, reply = struct.unpack_from(">Qq?", payload, 1)
        return {"kind": "keepalive", "end": end, "ts_us": us + EPOCH_US, "reply": reply}
    raise SessionError(f"unknown frame {kind!r} of {len(payload)} bytes")


def status_update(written: int, flushed: int, applied: int, ts_us: int, reply: bool = False) -> bytes:
    """What a receiver tells the server: how far it has written, flushed and applied."""
    return STATUS + struct.pack(">QQQq?", written, flushed, applied, ts_us - EPOCH_US, reply)


def start_command(slot: str, position: int, publications: list[str] | None = None, version: int = 4, two_phase: bool = False) -> str:
    """The command that begins logical decoding of a slot, or, without publications, the physical log."""
    at = f"{position >> 32:X}/{position & 0xFFFFFFFF:X}"
    if publications is None:
        return f'START_REPLICATION SLOT "{slot}" PHYSICAL {at}'
    names = ",".join('"' + p.replace('"', '""') + '"' for p in publications).replace("'", "''")
    options = [f"proto_version '{version}'", f"publication_names '{names}'", "messages 'true'"] + ["streaming 'on'"] * (version >= 2) + ["two_phase 'on'"] * two_phase
    return f'START_REPLICATION SLOT "{slot}" LOGICAL {at} ({", ".join(options)})'


class Session(Protocol):
    """What a receiver needs of its source."""

    def messages(self) -> Iterator[tuple[int, bytes]]: ...

    def confirm(self, position: int) -> None: ...


class StreamSession:
    """A session over a byte stream that is past its start command."""

    def __init__(self, pipe: Pipe, clock: Callable[[], int] = lambda: time.time_ns() // 1000) -> None:
        self.pipe, self.clock = pipe, clock
        self.received = self.confirmed = self.keepalives = 0

    def messages(self) -> Iterator[tuple[int, bytes]]:
        """(position, bytes) until the server ends the copy; keepalives that ask for it are answered."""
        while True:
            letter, payload = read_frame(self.pipe)
            if letter == b"c":
                return
            if letter == b"E":
                raise SessionError(payload.replace(b"\0", b" ").decode("utf-8", "replace"))
            if letter != b"d":
                continue
            x = parse_data(payload)
            self.received = max(self.received, x["end"])
            if x["kind"] == "data":
                yield x["start"], x["raw"]
                continue
            self.keepalives += 1
            if x["reply"]:
                self._report()

    def confirm(self, position: int) -> None:
        """Nothing beyond this position will be asked for again. Never moves back."""
        self.confirmed = max(self.confirmed, position)
        self._report()

    def _report(self) -> None:
        self.pipe.sendall(frame(b"d", status_update(self.received, self.confirmed, self.confirmed, self.clock())))


class RecordedSession:
    """The same from a folder of recorded segments."""

    def __init__(self, path: str, start: int = 0) -> None:
        self.path, self.start, self.confirmed = path, start, 0

    def messages(self) -> Iterator[tuple[int, bytes]]:
        for name in sorted(n for n in os.listdir(self.path) if n.endswith(".wire")):
            for seq, position, raw in read_segment(os.path.join(self.path, name)):
                if seq >= self.start:
                    yield position, raw

    def confirm(self, position: int) -> None:
        self.confirmed = max(self.confirmed, position)


def record_messages(session: Session, path: str, first: int = 0, each: int = 10_000) -> int:
    """Write a session's messages as segments of a recording, numbered on from first; what is on disk is confirmed. Returns the
    next number. A session that breaks off leaves whole segments."""
    rows, seq = [], first

    def publish() -> None:
        if rows:
            write_segment(path, rows)
            session.confirm(rows[-1][1])
            rows.clear()

    try:
        for position, raw in session.messages():
            rows.append((seq, position, raw))
            seq += 1
            if len(rows) == each:
                publish()
    finally:
        publish()
    return seq


def record_log(session: Session, path: str, timeline: int = 1, segment_bytes: int = 16 << 20) -> int:
    """Write a physical session's bytes as segment files, the last one partial, by position: bytes that come twice fall on
    themselves. Returns the position reached."""
    per, reached = (1 << 32) // segment_bytes, 0
    name = lambda number: f"{timeline:08X}{number // per:08X}{number % per:08X}"
    for position, raw in session.messages():
        while raw:
            number, at = divmod(position, segment_bytes)
            part, raw = raw[: segment_bytes - at], raw[segment_bytes - at :]
            whole = os.path.join(path, name(number))
            partial = whole + ".partial"
            if not os.path.exists(whole):
                with open(partial, "r+b" if os.path.exists(partial) else "w+b") as f:
                    f.truncate(segment_bytes)
                    f.seek(at)
                    f.write(part)
                    f.flush()
                    os.fsync(f.fileno())
                if at + len(part) == segment_bytes:
                    os.replace(partial, whole)
            position += len(part)
            reached = max(reached, position)
        session.confirm(reached)
    return reached


def supervise(run: Callable[[int], object], attempts: int = 5, wait: float = 1.0, most: float = 60.0, sleep: Callable[[float], None] = time.sleep) -> object:
    """Run a receiver until it ends by itself; after a break it starts again, later each time. run gets the attempt's number."""
    for k in range(attempts):
        try:
            return run(k)
        except (SessionError, OSError):
            if k + 1 == attempts:
                raise
            sleep(min(most, wait * 2**k))
    return None
