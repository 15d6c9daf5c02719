"""Header peeks into raw messages, LSN text and binary scalars: plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Microseconds from 1970-01-01 to 2000-01-01, the epoch of the wire's times.
EPOCH_US = 946_684_800_000_000


def unsigned(raw: Column, at: int, size: int) -> Column:
    """Big-endian unsigned integer of up to 7 bytes at a 0-based offset."""
    return F.conv(F.hex(F.substring(raw, at + 1, size)), 16, 10).cast("long")


def signed(raw: Column, at: int, size: int) -> Column:
    """Big-endian two's complement integer of up to 8 bytes."""
    text = F.hex(F.substring(raw, at + 1, size))
    if size == 8:
        return F.conv(text, 16, -10).cast("long")
    value, limit = F.conv(text, 16, 10).cast("long"), 1 << (8 * size)
    return F.when(value >= limit // 2, value - limit).otherwise(value)


def kind(raw: Column) -> Column:
    """The letter of a message."""
    return F.decode(F.substring(raw, 1, 1), "UTF-8")


def peek_xid(raw: Column, in_stream: Column) -> Column:
    """The transaction id that data messages carry inside a streamed block."""
    return F.when(in_stream, unsigned(raw, 1, 4))


def peek_oid(raw: Column, in_stream: Column) -> Column:
    """The relation of a row message, after the transaction id inside a block."""
    return F.when(kind(raw).isin("I", "U", "D", "R"), F.when(in_stream, unsigned(raw, 5, 4)).otherwise(unsigned(raw, 1, 4)))


def pg_timestamp(micros: Column) -> Column:
    """Microseconds since 2000-01-01 as a timestamp."""
    return F.timestamp_micros(micros + EPOCH_US)


def pg_date(days: Column) -> Column:
    return F.date_add(F.lit("2000-01-01").cast("date"), days.cast("int"))


def lsn_text(lsn: Column) -> Column:
    """hi/lo in upper-case hex without leading zeros."""
    return F.concat(F.hex(F.shiftrightunsigned(lsn, 32)), F.lit("/"), F.hex(lsn.bitwiseAND(0xFFFFFFFF)))


def lsn_parse(text: Column) -> Column:
    """The number of hi/lo; null for anything else."""
    ok = text.rlike("^[0-9A-Fa-f]{1,8}/[0-9A-Fa-f]{1,8}$")
    part = lambda n: F.conv(F.split_part(text, F.lit("/"), F.lit(n)), 16, 10).cast("long")
    return F.when(ok, F.shiftleft(part(1), 32).bitwiseOR(part(2)))


def confirm(received: Column, frontier: Column) -> Column:
    """What may be confirmed: received, but never beyond the output."""
    return F.least(received, F.coalesce(frontier, F.lit(0)))


def bool_text(raw: Column) -> Column:
    return F.when(F.length(raw) != 1, F.raise_error(F.lit("bool must have one byte"))).when(F.hex(raw) == "00", "f").otherwise("t")


def bytea_text(raw: Column) -> Column:
    return F.concat(F.lit("\\x"), F.lower(F.hex(raw)))


def uuid_text(raw: Column) -> Column:
    return F.regexp_replace(F.lower(F.hex(raw)), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def unknown_text(raw: Column) -> Column:
    """Values of types that aren't known."""
    return F.concat(F.lit("0x"), F.lower(F.hex(raw)))


def typmod_length(typmod: Column) -> Column:
    """Declared length of a character type; null without one."""
    return F.when(typmod >= 4, typmod - 4)


def numeric_precision(typmod: Column) -> Column:
    return F.when(typmod >= 4, F.shiftright(typmod - 4, 16).bitwiseAND(65535))


def numeric_scale(typmod: Column) -> Column:
    return F.when(typmod >= 4, (typmod - 4).bitwiseAND(65535))


def type_expression(name: Column, typmod: Column) -> Column:
    """The declared type: numeric(p,s), varchar(n) or the name alone."""
    with_scale = F.concat(name, F.lit("("), numeric_precision(typmod), F.lit(","), numeric_scale(typmod), F.lit(")"))
    with_length = F.concat(name, F.lit("("), typmod_length(typmod), F.lit(")"))
    return F.when(typmod < 0, name).when(name == "numeric", with_scale).when(name.isin("varchar", "bpchar", "char"), with_length).when(name.isin("timestamp", "timestamptz", "time", "timetz"), F.concat(name, F.lit("("), typmod, F.lit(")"))).otherwise(name)


def txid_number(text: Column) -> Column:
    """A transaction id in text as a number: plain digits, or a:b packed into two halves; null otherwise (see java_hash)."""
    a, b = (F.split_part(text, F.lit(":"), F.lit(n)).cast("long") for n in (1, 2))
    return F.when(text.rlike("^[0-9]+$"), text.cast("long")).when(text.rlike("^[0-9]+:[0-9]+$"), F.shiftleft(a, 32).bitwiseOR(b.bitwiseAND(0xFFFFFFFF)))


def java_hash(text: Column) -> Column:
    """s[0]*31^(n-1) + ... + s[n-1] over UTF-16 units, in 32 bits: the fallback for ids that are no numbers."""
    units = F.transform(F.sequence(F.lit(0), F.greatest(F.length(F.encode(text, "UTF-16BE")) / 2 - 1, F.lit(0)).cast("int")), lambda k: F.conv(F.hex(F.substring(F.encode(text, "UTF-16BE"), k * 2 + 1, F.lit(2))), 16, 10).cast("long"))
    folded = F.aggregate(units, F.lit(0).cast("long"), lambda h, c: F.pmod(h * 31 + c, F.lit(1 << 32)))
    return F.when(F.length(text) == 0, F.lit(0)).otherwise(F.when(folded >= 1 << 31, folded - (1 << 32)).otherwise(folded)).cast("int")
