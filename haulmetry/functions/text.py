"""Text, JSON and version expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_CORRUPT = "_corrupt_record"


def json_document(doc: Column, fields: str) -> Column:
    """Parse a JSON text column once into the listed fields (a DDL string of string fields)."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    return F.from_json(doc, f"{fields}, {_CORRUPT} string", options)


def json_field(parsed: Column, path: str) -> Column:
    """Text of one field: NULL for a NULL or malformed document, ``''`` for a missing key."""
    value = reduce(lambda col, name: col[name], path.split("."), parsed)
    readable = parsed.isNotNull() & parsed[_CORRUPT].isNull()
    return F.when(readable, F.coalesce(value, F.lit("")))


def json_text(doc: Column, key: str) -> Column:
    """``json_field`` for a single top-level key; the document is parsed once wherever the value is used."""
    parsed = F.array(json_document(doc, f"`{key}` string"))
    return F.get(F.transform(parsed, lambda one: json_field(one, key)), 0)


def json_item(parsed: Column, array: str, position: int, field: str) -> Column:
    """Text of a field of one item of an array, with the same missing-key rule."""
    readable = parsed.isNotNull() & parsed[_CORRUPT].isNull()
    return F.when(readable, F.coalesce(F.get(parsed[array], position)[field], F.lit("")))


def number(text: Column) -> Column:
    """Text to double; blank or unreadable text is NULL."""
    return text.try_cast("double")


def key_lookup(entries: Column, key: str) -> Column:
    """First value stored under ``key`` in an array of ``{key, value{string_value}}``.

    Written with array positions rather than a lambda so that it stays in generated code.
    """
    position = F.array_position(entries["key"], F.lit(key)).cast("int")
    return F.get(entries["value"]["string_value"], position - F.lit(1))


def text_or_none(col: Column) -> Column:
    """Text with a missing value spelled ``None``."""
    return F.coalesce(col.cast("string"), F.lit("None"))


def ilike_any(col: Column, patterns) -> Column:
    """True where any case-insensitive LIKE pattern matches."""
    return reduce(lambda a, b: a | b, [col.ilike(p) for p in patterns])


def none_ilike(col: Column, patterns) -> Column:
    """True where no pattern matches; a NULL text stays NULL and so drops the row in a filter."""
    return reduce(lambda a, b: a & b, [~col.ilike(p) for p in patterns])


def version_key(version: Column) -> Column:
    """Orderable numeric parts of a version text, so that 1.10.0 follows 1.9.0."""
    digits = F.regexp_extract_all(version, F.lit(r"(\d+)"), F.lit(1))
    return F.transform(digits, lambda part: part.try_cast("bigint"))
