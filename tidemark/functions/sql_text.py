"""Changes as SQL statements: quoting of names and literals, INSERT, UPDATE, DELETE, TRUNCATE."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def identifier(name: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(name, F.lit('"'), F.lit('""')), F.lit('"'))


def table_name(schema: Column, table: Column) -> Column:
    return F.concat(identifier(schema), F.lit("."), identifier(table))


def text_literal(text: Column) -> Column:
    """Quoted text; NUL can't be written in SQL."""
    nul = F.raise_error(F.lit("text holds NUL"))
    return F.when(text.contains("\x00"), nul).otherwise(F.concat(F.lit("'"), F.replace(text, F.lit("'"), F.lit("''")), F.lit("'")))


def bytes_literal(raw: Column) -> Column:
    return F.concat(F.lit("decode('"), F.lower(F.hex(raw)), F.lit("', 'hex')"))


def number_literal(value: Column) -> Column:
    """Finite numbers as they are, the others quoted."""
    return F.when(F.isnan(value), "'NaN'").when(value == float("inf"), "'Infinity'").when(value == float("-inf"), "'-Infinity'").otherwise(value.cast("string"))


def interval_literal(micros: Column) -> Column:
    """n microseconds as days and seconds with one sign."""
    size = F.abs(micros)
    days, rest = (size / 86_400_000_000).cast("long"), size % 86_400_000_000
    hours, minutes, seconds = (rest / 3_600_000_000).cast("long"), ((rest % 3_600_000_000) / 60_000_000).cast("long"), (rest % 60_000_000)
    text = F.format_string("%d days %02d:%02d:%02d.%06d", days, hours, minutes, (seconds / 1_000_000).cast("long"), seconds % 1_000_000)
    return F.when(micros < 0, F.concat(F.lit("-INTERVAL '"), text, F.lit("'"))).otherwise(F.concat(F.lit("INTERVAL '"), text, F.lit("'")))


def literal(value: Column, type_code: str) -> Column:
    """A value by its change-file type; null is NULL."""
    form = {
        "STRING": text_literal, "BYTES": bytes_literal, "FLOAT32": number_literal, "FLOAT64": number_literal, "INTERVAL": interval_literal,
        "BOOL": lambda v: F.when(v, "TRUE").otherwise("FALSE"), "INT": lambda v: v.cast("string"),
    }.get(type_code, lambda v: F.concat(F.lit("'"), v.cast("string"), F.lit("'")))
    return F.when(value.isNull(), "NULL").otherwise(form(value))


def insert(table: Column, names: list[str], literals: list[Column]) -> Column:
    return F.concat(F.lit("INSERT INTO "), table, F.lit(" (" + ", ".join(f'"{n}"' for n in names) + ") VALUES ("), F.concat_ws(", ", *literals), F.lit(");"))


def _where(keys: dict[str, Column]) -> Column:
    if not keys:
        return F.raise_error(F.lit("no primary key"))
    return F.concat_ws(" AND ", *(F.when(v == "NULL", F.lit(f'"{k}" IS NULL')).otherwise(F.concat(F.lit(f'"{k}" = '), v)) for k, v in keys.items()))


def update(table: Column, values: dict[str, Column], keys: dict[str, Column], old_keys: dict[str, Column] | None = None) -> Column:
    """Sets all columns. With old_keys the row is found by its former key, else by the new one."""
    assign = F.concat_ws(", ", *(F.concat(F.lit(f'"{n}" = '), v) for n, v in values.items()))
    return F.concat(F.lit("UPDATE "), table, F.lit(" SET "), assign, F.lit(" WHERE "), _where(old_keys or keys), F.lit(";"))


def delete(table: Column, keys: dict[str, Column]) -> Column:
    return F.concat(F.lit("DELETE FROM "), table, F.lit(" WHERE "), _where(keys), F.lit(";"))


def truncate(tables: Column, cascade: Column, restart: Column) -> Column:
    """TRUNCATE of an array of table names with its options."""
    return F.concat(F.lit("TRUNCATE TABLE "), F.array_join(tables, ", "), F.when(restart, " RESTART IDENTITY").otherwise(""), F.when(cascade, " CASCADE").otherwise(""), F.lit(";"))
