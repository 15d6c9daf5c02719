"""Text forms of rows, messages, transactions and figures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Printed values are cut here; data never is.
SHOWN = 64
UNCHANGED = "<unchanged-toast>"


def shown_value(state: Column, text: Column, limit: int = SHOWN) -> Column:
    """One column value for a log line."""
    cut = F.when(F.length(text) > limit, F.concat(F.left(text, F.lit(limit)), F.lit("...("), F.octet_length(text), F.lit("B)"))).otherwise(text)
    return F.when(state == "n", "null").when(state == "u", UNCHANGED).otherwise(cut)


def tuple_line(names: Column, values: Column) -> Column:
    """[a=1, b=x]; values beyond the known columns are named by their place. values: array<struct<state, text>>."""
    own = F.transform(values, lambda v, k: F.concat(F.coalesce(F.get(names, k), F.concat(F.lit("#"), k)), F.lit("="), shown_value(v["state"], v["text"])))
    return F.when(values.isNull(), "-").otherwise(F.concat(F.lit("["), F.array_join(own, ", "), F.lit("]")))


def row_map(names: Column, values: Column) -> Column:
    """map<name, struct<state, text>>; a dropped column (null name) leaves."""
    pairs = F.filter(F.arrays_zip(names.alias("k"), values.alias("v")), lambda p: p["k"].isNotNull())
    return F.map_from_entries(F.transform(pairs, lambda p: F.struct(p["k"].alias("key"), p["v"].alias("value"))))


def message_line(kind: Column, fields: dict[str, Column]) -> Column:
    """The line of one message. fields: columns by name, as in the messages table."""
    f = fields
    table = F.concat_ws(".", f["schema"], f["tbl"])
    stream = F.when(f["stream_xid"].isNotNull(), F.concat(F.lit("[stream xid="), f["stream_xid"], F.lit("] "))).otherwise("")
    forms = {
        "B": ("BEGIN xid=%s lsn=%s", ("xid", "lsn")), "C": ("COMMIT lsn=%s end=%s", ("lsn", "end")), "S": ("STREAM START xid=%s first=%s", ("xid", "first")), "E": ("STREAM STOP", ()),
        "c": ("STREAM COMMIT xid=%s lsn=%s", ("xid", "lsn")), "A": ("STREAM ABORT xid=%s subxid=%s", ("xid", "subxid")), "b": ("BEGIN PREPARE gid=%s xid=%s", ("gid", "xid")), "P": ("PREPARE gid=%s xid=%s", ("gid", "xid")),
        "K": ("COMMIT PREPARED gid=%s xid=%s", ("gid", "xid")), "r": ("ROLLBACK PREPARED gid=%s xid=%s", ("gid", "xid")), "p": ("STREAM PREPARE gid=%s xid=%s", ("gid", "xid")), "O": ("ORIGIN %s", ("name",)),
        "M": ("MESSAGE prefix=%s bytes=%s", ("prefix", "bytes")),
    }
    rows = {"I": ("INSERT", ("new",)), "U": ("UPDATE", ("old", "new")), "D": ("DELETE", ("old",)), "T": ("TRUNCATE", ()), "R": ("RELATION", ()), "Y": ("TYPE", ())}
    out = F.lit(None).cast("string")
    for letter, (form, names) in forms.items():
        out = F.when(kind == letter, F.format_string(form, *(f[n] for n in names)) if names else F.lit(form)).otherwise(out)
    for letter, (word, images) in rows.items():
        out = F.when(kind == letter, F.concat_ws(" ", F.lit(word), table, *(f[i] for i in images))).otherwise(out)
    return F.concat(stream, out)


def transaction_header(mode: Column, xid: Column, lsn: Column, expected: Column) -> Column:
    return F.concat(F.lit("=== "), mode, F.lit(" xid="), xid.cast("string"), F.lit(" lsn="), lsn, F.lit(" changes="), expected.cast("string"))


def preview(content: Column, printable: int = 64, raw: int = 32) -> Column:
    """Readable content as its first characters, other content as hex of its first bytes."""
    text = F.decode(content, "UTF-8")
    readable = F.hex(content).rlike("^(?:2[0-9A-F]|[3-6][0-9A-F]|7[0-9A-E]|09|0A|0D)*$")
    as_text = F.when(F.length(text) > printable, F.concat(F.left(text, F.lit(printable)), F.lit("..."))).otherwise(text)
    as_hex = F.concat(F.lit("0x"), F.lower(F.hex(F.substring(content, 1, raw))), F.when(F.length(content) > raw, "...").otherwise(""))
    return F.when(readable, as_text).otherwise(as_hex)


def two_places(x: Column) -> Column:
    """With two decimals, rounded as the stored binary value asks, as C's printf does: format_string rounds the shortest decimal
    text (1.005, stored a little lower, to 1.01)."""
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), F.format_string("%.2f", x)).otherwise(F.call_function("format_number", x, F.lit("0.00")))


def rate_text(per_second: Column) -> Column:
    """1234.5 -> 1.23k/s and so on."""
    shown = lambda unit, end: F.concat(two_places(per_second / unit), F.lit(end))
    return F.when(per_second >= 1e6, shown(1e6, "M/s")).when(per_second >= 1e3, shown(1e3, "k/s")).otherwise(shown(1.0, "/s"))


def bytes_text(n: Column) -> Column:
    shown = lambda unit, end: F.concat(two_places(n / float(unit)), F.lit(end))
    return F.when(n >= 1 << 30, shown(1 << 30, "GB")).when(n >= 1 << 20, shown(1 << 20, "MB")).when(n >= 1 << 10, shown(1 << 10, "KB")).otherwise(F.format_string("%dB", n.cast("long")))


def duration_text(nanos: Column) -> Column:
    shown = lambda unit, end: F.concat(two_places(nanos / unit), F.lit(end))
    return F.when(nanos >= 1e9, shown(1e9, "s")).when(nanos >= 1e6, shown(1e6, "ms")).when(nanos >= 1e3, shown(1e3, "us")).otherwise(F.format_string("%dns", nanos.cast("long")))


def temporal_text(ts: Column) -> Column:
    """Wall clock in UTC with microseconds."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def recovered(state: Column, new: Column, old_state: Column, old: Column, placeholder: str = UNCHANGED) -> Column:
    """The new value; where it says unchanged, the old image's value at the same place, else a placeholder."""
    return F.when(state != "u", new).when(old_state.isNotNull() & (old_state != "u"), old).otherwise(placeholder)


def with_pattern(value: Column, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Dates and times by a caller's own pattern."""
    return F.date_format(value, pattern)
