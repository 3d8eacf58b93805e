"""Numeric coercion of funding amounts (O-57, O-58, O-61)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fundlake.functions.variant import vtype

# floor() of a double beyond the BIGINT range saturates silently; such a value
# cannot be represented in the output column, so it is flagged instead.
_BIGINT_LIMIT = 9.2e18
_INTEGER_TYPES = ("TINYINT", "SMALLINT", "INT", "BIGINT")


def amount_kind(v: Column, t: Column | None = None) -> Column:
    """'int', 'frac', 'bool' or 'other' for a VARIANT amount (``t``: its vtype)."""
    t = vtype(v) if t is None else t
    return (
        F.when(t.isin(*_INTEGER_TYPES), F.lit("int"))
        .when(t.startswith("DECIMAL") | t.isin("DOUBLE", "FLOAT"), F.lit("frac"))
        .when(t == "BOOLEAN", F.lit("bool"))
        .otherwise(F.lit("other"))
    )


def amount_out_of_range(v: Column, kind: Column | None = None) -> Column:
    """True when a numeric amount cannot be truncated into a BIGINT."""
    kind = amount_kind(v) if kind is None else kind
    dbl = F.try_variant_get(v, "$", "double")
    return (kind == "frac") & (F.abs(dbl) >= F.lit(_BIGINT_LIMIT))


def coerce_amount(v: Column, kind: Column | None = None) -> Column:
    """Numbers keep their value, booleans count 1/0, anything else is 0 (O-57),
    truncated toward minus infinity to a BIGINT (O-58). Callers take
    ``greatest(.., 0)`` after the max, so floor equals Python's int()."""
    kind = amount_kind(v) if kind is None else kind
    return (
        F.when(kind == "int", F.try_variant_get(v, "$", "bigint"))
        .when(kind == "frac", F.floor(F.try_variant_get(v, "$", "double")).cast("bigint"))
        .when(kind == "bool", F.try_variant_get(v, "$", "boolean").cast("bigint"))
        .otherwise(F.lit(0).cast("bigint"))
    )


def to_millions(c: Column) -> Column:
    """Scale an amount to millions (O-61)."""
    return c / F.lit(1_000_000.0)
