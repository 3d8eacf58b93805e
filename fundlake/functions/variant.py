"""JSON handling on Spark's VARIANT type (O-38, O-39, O-40, truthiness).

VARIANT keeps JSON numbers, strings, booleans and nulls apart, which a cast
to STRING does not. Every accessor here uses the ``try_`` forms so malformed
input becomes NULL (and is quarantined by the caller) instead of failing the
job under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_INTEGER_TYPES = ("TINYINT", "SMALLINT", "INT", "BIGINT")


def parse(text: Column, strict: bool = False) -> Column:
    """JSON text -> VARIANT (O-38). Malformed text gives NULL unless strict."""
    return F.parse_json(text) if strict else F.try_parse_json(text)


def to_json_text(c: Column) -> Column:
    """Value -> JSON text (O-39, and O-40 as valid JSON instead of a repr)."""
    return F.to_json(c)


def vtype(v: Column) -> Column:
    """Type name of a VARIANT value: 'STRING', 'BIGINT', 'DECIMAL(3,2)',
    'DOUBLE', 'BOOLEAN', 'VOID' (JSON null), 'ARRAY<..>', 'OBJECT<..>';
    NULL when the value itself is missing."""
    return F.schema_of_variant(v)


def field(v: Column, name: str) -> Column:
    """Object member as VARIANT; NULL when absent or when ``v`` is no object."""
    return F.try_variant_get(v, f"$.{name}", "variant")


def is_json_null(v: Column) -> Column:
    """Missing or JSON null."""
    return v.isNull() | F.coalesce(F.is_variant_null(v), F.lit(False))


def as_array(v: Column) -> Column:
    """ARRAY<VARIANT> when ``v`` is a JSON array, else NULL."""
    return F.try_variant_get(v, "$", "array<variant>")


def is_object(v: Column) -> Column:
    return F.coalesce(vtype(v).startswith("OBJECT"), F.lit(False))


def is_string(v: Column) -> Column:
    return F.coalesce(vtype(v) == "STRING", F.lit(False))


def string_value(v: Column) -> Column:
    """The string of a JSON string, NULL for any other type."""
    return F.when(is_string(v), F.try_variant_get(v, "$", "string"))


def truthy(v: Column, t: Column | None = None) -> Column:
    """Python truthiness of a decoded JSON value.

    JSON null / missing, false, 0, "", [] and {} are false; everything else is
    true. Decided on the VARIANT type, never on the text, because the text of
    the string "{}" and of the object {} look alike. ``t`` may pass an
    already computed ``vtype(v)`` so the type is derived once per value.
    """
    t = vtype(v) if t is None else t
    return (
        F.when(v.isNull() | (t == "VOID"), F.lit(False))
        .when(t == "BOOLEAN", F.try_variant_get(v, "$", "boolean"))
        .when(t == "STRING", F.length(F.try_variant_get(v, "$", "string")) > 0)
        .when(t.startswith("ARRAY"), F.array_size(as_array(v)) > 0)
        .when(t.startswith("OBJECT"), t != "OBJECT<>")
        .otherwise(F.coalesce(F.try_variant_get(v, "$", "double") != 0, F.lit(True)))
    )


def python_text(v: Column, t: Column | None = None) -> Column:
    """Text a Python ``str()`` gives for the decoded JSON value.

    Strings are themselves; integers print as digits; fractional JSON numbers
    decode to floats and print in shortest round-trip form (``5.21``,
    ``2021.0``); booleans print ``True``/``False``; containers fall back to
    their JSON text (no branch of the date cascade accepts either form).
    """
    t = vtype(v) if t is None else t
    return (
        F.when(t == "STRING", F.try_variant_get(v, "$", "string"))
        .when(t.isin(*_INTEGER_TYPES), F.try_variant_get(v, "$", "bigint").cast("string"))
        .when(
            t.startswith("DECIMAL") | t.isin("DOUBLE", "FLOAT"),
            F.try_variant_get(v, "$", "double").cast("string"),
        )
        .when(
            t == "BOOLEAN",
            F.when(F.try_variant_get(v, "$", "boolean"), F.lit("True")).otherwise(F.lit("False")),
        )
        .when(t == "VOID", F.lit("None"))
        .otherwise(F.to_json(v))
    )


def scalar_text(v: Column) -> Column:
    """Text of a scalar JSON value (strings unquoted), NULL for JSON null."""
    return F.when(~is_json_null(v), F.try_variant_get(v, "$", "string"))
