"""Text values to typed columns, and schemas from definitions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Public type names and oids of PostgreSQL with the Spark type and the change-file type of each.
TYPES: dict[int, tuple[str, str, str]] = {
    16: ("bool", "boolean", "BOOL"), 17: ("bytea", "binary", "BYTES"), 18: ("char", "string", "STRING"), 19: ("name", "string", "STRING"), 20: ("int8", "bigint", "INT"), 21: ("int2", "smallint", "INT"),
    23: ("int4", "int", "INT"), 25: ("text", "string", "STRING"), 26: ("oid", "bigint", "INT"), 28: ("xid", "bigint", "INT"), 29: ("cid", "bigint", "INT"), 114: ("json", "string", "STRING"), 700: ("float4", "float", "FLOAT32"),
    701: ("float8", "double", "FLOAT64"), 1042: ("bpchar", "string", "STRING"), 1043: ("varchar", "string", "STRING"), 1082: ("date", "date", "DATE"), 1083: ("time", "string", "TIME"), 1114: ("timestamp", "timestamp_ntz", "TIMESTAMP"),
    1184: ("timestamptz", "timestamp", "TIMESTAMPTZ"), 1186: ("interval", "string", "INTERVAL"), 1266: ("timetz", "string", "TIMESTAMPTZ"), 1700: ("numeric", "decimal(38,18)", "STRING"), 2950: ("uuid", "string", "STRING"),
    3802: ("jsonb", "string", "STRING"),
}
ELEMENT_OF = {1000: 16, 1001: 17, 1005: 21, 1007: 23, 1009: 25, 1014: 1042, 1015: 1043, 1016: 20, 1021: 700, 1022: 701, 1028: 26, 1115: 1114, 1182: 1082, 1183: 1083, 1185: 1184, 1187: 1186, 1231: 1700, 1270: 1266, 2951: 2950}


def spark_type(oid: int, typmod: int = -1) -> str:
    """The Spark type of a column: decimal by its declaration where it fits, string for what has no exact type."""
    if oid == 1700:
        if typmod < 4:
            return "string"
        precision, scale = (typmod - 4) >> 16 & 65535, typmod - 4 & 65535
        return f"decimal({precision},{scale})" if precision <= 38 and scale <= precision else "string"
    if oid in ELEMENT_OF:
        return f"array<{spark_type(ELEMENT_OF[oid])}>"
    return TYPES[oid][1] if oid in TYPES else "string"


def typed_value(text: Column, oid: int, typmod: int = -1) -> Column:
    """Text as its type; null where it isn't of the type or has no finite value there."""
    kind = spark_type(oid, typmod)
    if kind == "boolean":
        return F.when(F.lower(text).isin("t", "true"), True).when(F.lower(text).isin("f", "false"), False)
    if kind == "binary":
        return F.when(text.startswith("\\x"), F.unhex(F.substr(text, F.lit(3))))
    if kind.startswith("array<"):
        return F.transform(text_array(text), lambda x: x.try_cast(kind[6:-1]))
    return text.try_cast(kind)


def text_array(text: Column) -> Column:
    """array<string> of an array text of one dimension: quoted and escaped elements, NULL, an explicit lower bound. Null for
    anything else. Label tree arrays have the same form."""
    body = F.regexp_extract(text, r"^(?:\[-?\d+:-?\d+\]=)?\{(.*)\}$", 1)
    element = r'"(?:[^"\\]|\\.)*+"|[^,{}"\\]++'
    legal = text.rlike(rf"^(?:\[-?\d+:-?\d+\]=)?\{{(?:(?:{element})(?:,(?:{element}))*+)?\}}$")
    bare = lambda x: F.when(x.startswith('"'), F.regexp_replace(F.substring(x, F.lit(2), F.length(x) - 2), r"(?s)\\(.)", "$1")).otherwise(F.when(F.upper(x) != "NULL", x))
    return F.when(legal, F.transform(F.regexp_extract_all(body, F.lit(element), F.lit(0)), bare))


def relation_schema(columns: list[dict]) -> T.StructType:
    """The row type of a relation: columns with name, type_oid, typmod."""
    return T._parse_datatype_string(", ".join(f"`{c['name']}` {spark_type(c['type_oid'], c.get('typmod', -1))}" for c in columns))


def typed_view(changes, columns: list[dict], image: str = "after", as_string: bool = False):
    """changes of one table with a column per table column. image: map<name, struct<state, text>>."""
    text = lambda c: F.when(F.col(image)[c["name"]]["state"] == "t", F.col(image)[c["name"]]["text"])
    return changes.select("*", *((text(c) if as_string else typed_value(text(c), c["type_oid"], c.get("typmod", -1))).alias(c["name"]) for c in columns))


def mapped(text: Column, oid: Column, mapper: Callable[[int, str | None], str | None]) -> Column:
    """Values as a caller's own function of type and text gives them, by Arrow batches."""

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, oids in batches:
            yield pd.Series([mapper(int(o), None if t is None or t is pd.NA else t) for t, o in zip(texts, oids, strict=True)], index=texts.index, dtype=object)

    return F.pandas_udf(run, "string")(text, oid)


def decimal_mode(value: Column, mode: str) -> Column:
    """precise: decimal(38,18), null beyond it; variable: see variable_decimal; double: nearest; string: text."""
    return {"precise": value.try_cast("decimal(38,18)"), "variable": variable_decimal(value), "double": value.try_cast("double"), "string": value.cast("string")}[mode]


def variable_decimal(text: Column) -> Column:
    """struct<unscaled string, scale int> of a decimal text of any length: exact where no decimal type holds it; null for NaN
    and infinities."""
    sign, whole, part = (F.regexp_extract(text, r"^([+-]?)(\d*)\.?(\d*)$", n) for n in (1, 2, 3))
    digits = F.regexp_replace(F.concat(whole, part), "^0+(?=.)", "")
    unscaled = F.concat(F.when((sign == "-") & (digits != "0"), "-").otherwise(""), digits)
    return F.when(text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)$"), F.struct(unscaled.alias("unscaled"), F.length(part).alias("scale")))


def binary_mode(value: Column, mode: str) -> Column:
    """bytes, base64, base64-url-safe or hex."""
    b64 = F.regexp_replace(F.base64(value), "\\s", "")
    return {"bytes": value, "base64": b64, "base64-url-safe": F.translate(b64, "+/", "-_"), "hex": F.lower(F.hex(value))}[mode]


def interval_iso(months: Column, days: Column, micros: Column) -> Column:
    """ISO-8601 text of an interval."""
    return F.format_string("P%dY%dM%dDT%dH%dM%.6fS", (months / 12).cast("int"), (months % 12).cast("int"), days, (micros / 3_600_000_000).cast("long"), ((micros / 60_000_000).cast("long") % 60), (micros % 60_000_000) / 1e6)


def interval_micros(months: Column, days: Column, micros: Column) -> Column:
    """Microseconds with months of 30.4375 days, a year's twelfth."""
    return (months.cast("double") * 2_629_800_000_000 + days.cast("double") * 86_400_000_000 + micros).cast("long")


def money(text: Column) -> Column:
    """Digits of a money text: currency signs and group separators go, parentheses are a minus."""
    digits = F.regexp_replace(text, "[^0-9.]", "")
    return F.when(text.rlike(r"^\s*[-(]"), F.concat(F.lit("-"), digits)).otherwise(digits).try_cast("decimal(38,2)")


def bits(text: Column) -> Column:
    """A bit string of up to 64 bits as a number."""
    return F.when(text.rlike("^[01]{1,64}$"), F.conv(text, 2, -10).cast("long"))


def bit_bytes(text: Column) -> Column:
    """A bit string of any length as bytes, the last eight bits first; null for other texts."""
    size = F.ceil(F.length(text) / 8).cast("int")
    padded = F.lpad(text, size * 8, F.lit("0"))
    byte = lambda k: F.lpad(F.conv(F.substring(padded, (size - k - 1) * 8 + 1, F.lit(8)), 2, 16), 2, "0")
    return F.when(text.rlike("^[01]+$"), F.unhex(F.array_join(F.transform(F.sequence(F.lit(0), size - 1), byte), "")))


def default_value(expression: Column) -> Column:
    """The literal of a column default: casts and quotes stripped; null for calls and NULL."""
    bare = F.regexp_replace(F.trim(expression), r"::[a-z \"]+(?:\([0-9, ]+\))?(?:\[\])?$", "")
    bare = F.regexp_replace(bare, r"^\((.*)\)$", "$1")
    quoted = bare.rlike("^[BEbe]?'(?:[^']|'')*'$")
    inner = F.replace(F.regexp_extract(bare, "^[BEbe]?'(.*)'$", 1), F.lit("''"), F.lit("'"))
    return F.when(quoted, inner).when(bare.rlike(r"^(?i)null$|[()]"), F.lit(None).cast("string")).otherwise(bare)


def point(text: Column) -> Column:
    """(x,y) as a struct."""
    part = lambda n: F.regexp_extract(text, r"^\(\s*([^,()]+?)\s*,\s*([^,()]+?)\s*\)$", n).try_cast("double")
    return F.when(text.rlike(r"^\(.*,.*\)$"), F.struct(part(1).alias("x"), part(2).alias("y")))


#: Numbers of each kind of geometric value; None: any number of points.
GEOMETRIC = {"point": 2, "lseg": 4, "box": 4, "circle": 3, "line": 3, "path": None, "polygon": None}


def geometric(text: Column, kind: str) -> Column:
    """struct<points array<struct<x, y>>, closed, radius, a, b, c> of a geometric text: corners of a box, ends of a segment,
    centre of a circle and so on; closed is false for open paths only. Null for texts that aren't of the kind."""
    number = r"-?(?:Infinity|NaN|\d+(?:\.\d*)?(?:[eE][-+]?\d+)?|\.\d+(?:[eE][-+]?\d+)?)"
    values = F.transform(F.regexp_extract_all(text, F.lit(number), F.lit(0)), lambda v: v.try_cast("double"))
    n = F.size(values)
    legal = (n == GEOMETRIC[kind]) if GEOMETRIC[kind] else (n > 0) & (n % 2 == 0)
    used = {"line": F.lit(0), "circle": F.lit(1)}.get(kind, F.floor(n / 2).cast("int"))
    points = F.when(used > 0, F.transform(F.sequence(F.lit(0), used - 1), lambda k: F.struct(values[k * 2].alias("x"), values[k * 2 + 1].alias("y"))))
    no = F.lit(None).cast("double")
    last = lambda on, k: (values[k] if kind == on else no)
    closed = ~text.startswith("[") if kind == "path" else F.lit(True)
    shape = F.struct(points.alias("points"), closed.alias("closed"), last("circle", 2).alias("radius"), last("line", 0).alias("a"), last("line", 1).alias("b"), last("line", 2).alias("c"))
    return F.when(text.rlike(rf"^[\s(){{}}<>,\[\]]*+(?:{number}[\s(){{}}<>,\[\]]*+)+$") & legal, shape)


def ewkb(hex_text: Column) -> Column:
    """struct<wkb, srid> of hex EWKB; the SRID is there if the type's flag says so."""
    little = F.left(hex_text, F.lit(2)) == "01"

    def number(at: int) -> Column:
        own = F.substring(hex_text, at, 8)
        swapped = F.concat(*(F.substring(hex_text, at + k, 2) for k in (6, 4, 2, 0)))
        return F.conv(F.when(little, swapped).otherwise(own), 16, 10).cast("long")

    srid = F.when(number(3).bitwiseAND(0x20000000) != 0, number(11).cast("int"))
    return F.when(hex_text.rlike("^0[01]([0-9A-Fa-f]{2}){4,}$"), F.struct(F.unhex(hex_text).alias("wkb"), srid.alias("srid")))


def hstore_map(text: Column) -> Column:
    """map<string, string> of hstore text, quoted or bare, NULL values kept."""
    pair = r'(?:"(?:[^"\\]|\\.)*"|[^\s,=>"]+)\s*=>\s*(?:"(?:[^"\\]|\\.)*"|[^\s,"]+)'
    side = r'^((?:"(?:[^"\\]|\\.)*"|[^\s,=>"]+))\s*=>\s*((?:"(?:[^"\\]|\\.)*"|[^\s,"]+))$'
    bare = lambda x: F.when(x.startswith('"'), F.regexp_replace(F.regexp_extract(x, '^"(.*)"$', 1), r"\\(.)", "$1")).otherwise(F.when(F.upper(x) != "NULL", x))
    entries = F.transform(F.regexp_extract_all(text, F.lit(pair), F.lit(0)), lambda p: F.struct(bare(F.regexp_extract(p, side, 1)).alias("key"), bare(F.regexp_extract(p, side, 2)).alias("value")))
    return F.map_from_entries(entries)


def hstore_json(text: Column) -> Column:
    return F.to_json(hstore_map(text))


DATE = r"^\s*(\d{4,6})-(\d{1,2})-(\d{1,2})"
CLOCK = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:\.(\d{1,9}))?)?"
ZONE = r"\s*(?:Z|([+-])(\d{1,2})(?::?(\d{2}))?(?::?(\d{2}))?)?"
INFINITE = (1 << 63) - 1


def _days(text: Column, pattern: str) -> Column:
    """Days since 1970-01-01 in the proleptic Gregorian calendar, by eras of 400 years; the year before 1 is 1 BC."""
    y, m, d = (F.regexp_extract(text, pattern, n).cast("long") for n in (1, 2, 3))
    y = F.when(text.rlike(r"(?i)BC\s*$"), 1 - y).otherwise(y) - F.when(m <= 2, 1).otherwise(0)
    era = F.floor(y / 400)
    of_era = y - era * 400
    of_year = F.floor((153 * (m + F.when(m > 2, -3).otherwise(9)) + 2) / 5) + d - 1
    return (era * 146_097 + of_era * 365 + F.floor(of_era / 4) - F.floor(of_era / 100) + of_year - 719_468).cast("long")


def _clock(text: Column, pattern: str, first: int) -> Column:
    """Microseconds of a time of day; fractions beyond six digits are cut."""
    h, m, s = (F.coalesce(F.regexp_extract(text, pattern, first + n).try_cast("long"), F.lit(0)) for n in range(3))
    return ((h * 60 + m) * 60 + s) * 1_000_000 + F.rpad(F.regexp_extract(text, pattern, first + 3), 6, "0").cast("long")


def _east(text: Column, pattern: str, first: int) -> Column:
    """Microseconds that the zone lies east of Greenwich."""
    h, m, s = (F.coalesce(F.regexp_extract(text, pattern, first + n).try_cast("long"), F.lit(0)) for n in (1, 2, 3))
    size = ((h * 60 + m) * 60 + s) * 1_000_000
    return F.when(F.regexp_extract(text, pattern, first) == "-", -size).otherwise(size)


def _infinite(text: Column, otherwise: Column) -> Column:
    return F.when(F.lower(F.trim(text)) == "infinity", F.lit(INFINITE)).when(F.lower(F.trim(text)) == "-infinity", F.lit(-INFINITE - 1)).otherwise(otherwise)


def date_days(text: Column) -> Column:
    """Days since 1970 of a date text, years before Christ and of more than four digits included; the infinities are the ends
    of the type."""
    return _infinite(text, F.when(text.rlike(DATE + r"(?:\s+(?i:BC|AD))?\s*$"), _days(text, DATE)))


def timestamp_micros(text: Column) -> Column:
    """Microseconds since 1970 of a timestamp text: fractions of any length, zones, years before Christ and beyond 9999; the
    infinities are the ends of the type. Texts without a zone are taken as they stand."""
    whole = DATE + r"[T\s]+" + CLOCK + ZONE + r"(?:\s+(?i:BC|AD))?\s*$"
    return _infinite(text, F.when(text.rlike(whole), _days(text, whole) * 86_400_000_000 + _clock(text, whole, 4) - _east(text, whole, 8)))


def time_micros(text: Column) -> Column:
    """Microseconds of a time of day."""
    whole = "^" + CLOCK + r"\s*$"
    return F.when(text.rlike(whole), _clock(text, whole, 1))


def timetz_micros(text: Column) -> Column:
    """Microseconds of a time of day with a zone, moved to UTC."""
    whole = "^" + CLOCK + ZONE + r"\s*$"
    return F.when(text.rlike(whole), F.pmod(_clock(text, whole, 1) - _east(text, whole, 5), F.lit(86_400_000_000)))


def timestamp_text(text: Column) -> Column:
    """Timestamps in text with 0 to 6 fraction digits and an optional zone; for BC years and infinity, which the type doesn't
    hold, null: see timestamp_micros."""
    return F.when(text.rlike(r"(?i)bc|infinity"), F.lit(None).cast("timestamp")).otherwise(F.try_to_timestamp(text))
