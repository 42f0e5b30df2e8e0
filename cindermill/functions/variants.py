"""Navigation of JSON documents as VARIANT: paths, and fields that hold one object or many. No Python runs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def document(text) -> Column:
    """A JSON text as a variant; null where it is none."""
    return F.try_parse_json(text)


def at(v: Column, *keys: str, kind: str = "variant") -> Column:
    """The value under ``keys``; null where the way is not there, or where it doesn't read as ``kind``."""
    path = "$" + "".join(f'["{k}"]' for k in keys)
    return F.try_variant_get(v, path, kind)


def text(v: Column, *keys: str) -> Column:
    """The text of a scalar under ``keys``; objects and arrays give null."""
    value = at(v, *keys)
    scalar = ~F.schema_of_variant(value).rlike("^(OBJECT|ARRAY)")
    return F.when(scalar, F.try_variant_get(value, "$", "string"))


def many(v: Column) -> Column:
    """A field that may hold one value or an array of these, as an array; nothing or null: empty."""
    kind = F.schema_of_variant(v)
    none = F.array().cast("array<variant>")
    return F.when(v.isNull() | (kind == "VOID"), none).when(kind.startswith("ARRAY"), F.try_variant_get(v, "$", "array<variant>")).otherwise(F.array(v))
