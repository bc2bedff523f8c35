"""Fields of JSON texts by type. A value of another type, or none, takes the default.

Numbers read as text too, but a text is never read as a number. Paths go through nested objects;
what is not an object has no fields.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_json(text: Column | str) -> Column:
    """The text as VARIANT; NULL for malformed JSON."""
    return F.try_parse_json(text)


def _at(node: Column, path: str) -> Column:
    return F.try_variant_get(node, "$." + path if path else "$", "variant")


def _kind(value: Column) -> Column:
    return F.schema_of_variant(value)


def _is_number(value: Column) -> Column:
    return _kind(value).rlike("^(BIGINT|DECIMAL.*|DOUBLE)$")


def _or_default(value: Column, default) -> Column:
    return value if default is None else F.coalesce(value, default if isinstance(default, Column) else F.lit(default))


def text_field(node: Column, path: str, default=None) -> Column:
    """A string, or a number as its text."""
    value = _at(node, path)
    return _or_default(F.when((_kind(value) == "STRING") | _is_number(value),
                              F.try_variant_get(value, "$", "string")), default)


def string_field(node: Column, path: str, default=None) -> Column:
    """A string that is not blank, trimmed."""
    value = _at(node, path)
    text = F.trim(F.try_variant_get(value, "$", "string"))
    return _or_default(F.when((_kind(value) == "STRING") & (text != ""), text), default)


def double_field(node: Column, path: str, default=None) -> Column:
    value = _at(node, path)
    return _or_default(F.when(_is_number(value), F.try_variant_get(value, "$", "double")), default)


def long_field(node: Column, path: str, default=None) -> Column:
    """A number without its fraction; one that is out of range has no value."""
    value = _at(node, path)
    whole = F.try_variant_get(value, "$", "decimal(38,9)")
    real = F.try_variant_get(value, "$", "double")
    read = (F.when(_kind(value) == "BIGINT", F.try_variant_get(value, "$", "bigint"))
            .when(_is_number(value), F.coalesce(
                F.when(whole < 0, F.ceil(whole)).otherwise(F.floor(whole)).try_cast("bigint"),
                F.when(F.abs(real) < float(1 << 63), real.cast("bigint")))))
    return _or_default(read, default)


def bool_field(node: Column, path: str, default=None) -> Column:
    value = _at(node, path)
    return _or_default(F.when(_kind(value) == "BOOLEAN", F.try_variant_get(value, "$", "boolean")), default)


def elements(node: Column, path: str = "") -> Column:
    """The elements of a list as array<variant>; an object counts as a list of one, anything else
    as an empty list."""
    value = _at(node, path)
    return F.coalesce(F.when(_kind(value).startswith("ARRAY"), F.try_variant_get(value, "$", "array<variant>"))
                      .when(_kind(value).startswith("OBJECT"), F.array(value)),
                      F.array().cast("array<variant>"))
