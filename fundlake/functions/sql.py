"""SQL-text forms of the VARIANT helpers, for staged ``selectExpr`` plans.

Same rules as ``variant`` / ``amounts`` / ``rounds``; a SQL expression is
parsed once on the JVM, where the Column API costs one round trip per node,
which dominates plan construction for wide expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from fundlake.schemas import FUNDING_ROUNDS, UNKNOWN_ROUND

INTEGER_TYPES = "('TINYINT', 'SMALLINT', 'INT', 'BIGINT')"
BIGINT_LIMIT = "9.2e18"


def lit(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def truthy(v: str, t: str) -> str:
    """Python truthiness of VARIANT ``v`` whose vtype column is ``t``."""
    return f"""CASE WHEN {v} IS NULL OR {t} = 'VOID' THEN false
      WHEN {t} = 'BOOLEAN' THEN try_variant_get({v}, '$', 'boolean')
      WHEN {t} = 'STRING' THEN length(try_variant_get({v}, '$', 'string')) > 0
      WHEN {t} LIKE 'ARRAY%' THEN array_size(try_variant_get({v}, '$', 'array<variant>')) > 0
      WHEN {t} LIKE 'OBJECT%' THEN {t} <> 'OBJECT<>'
      ELSE coalesce(try_variant_get({v}, '$', 'double') <> 0, true) END"""


def python_text(v: str, t: str) -> str:
    """Text Python's str() gives for the decoded value (see variant.python_text)."""
    return f"""CASE WHEN {t} = 'STRING' THEN try_variant_get({v}, '$', 'string')
      WHEN {t} IN {INTEGER_TYPES} THEN CAST(try_variant_get({v}, '$', 'bigint') AS STRING)
      WHEN {t} LIKE 'DECIMAL%' OR {t} IN ('DOUBLE', 'FLOAT') THEN CAST(try_variant_get({v}, '$', 'double') AS STRING)
      WHEN {t} = 'BOOLEAN' THEN CASE WHEN try_variant_get({v}, '$', 'boolean') THEN 'True' ELSE 'False' END
      WHEN {t} = 'VOID' THEN 'None'
      ELSE to_json({v}) END"""


def amount_kind(t: str) -> str:
    return f"""CASE WHEN {t} IN {INTEGER_TYPES} THEN 'int'
      WHEN {t} LIKE 'DECIMAL%' OR {t} IN ('DOUBLE', 'FLOAT') THEN 'frac'
      WHEN {t} = 'BOOLEAN' THEN 'bool' ELSE 'other' END"""


def coerce_amount(v: str, kind: str) -> str:
    return f"""CASE WHEN {kind} = 'int' THEN try_variant_get({v}, '$', 'bigint')
      WHEN {kind} = 'frac' THEN CAST(floor(try_variant_get({v}, '$', 'double')) AS BIGINT)
      WHEN {kind} = 'bool' THEN CAST(try_variant_get({v}, '$', 'boolean') AS BIGINT)
      ELSE CAST(0 AS BIGINT) END"""


def amount_out_of_range(v: str, kind: str) -> str:
    return f"({kind} = 'frac' AND abs(try_variant_get({v}, '$', 'double')) >= {BIGINT_LIMIT})"


def scalar_text(v: str, t: str) -> str:
    """Text of a scalar JSON value, NULL for missing / JSON null."""
    return f"CASE WHEN {v} IS NULL OR {t} = 'VOID' THEN NULL ELSE try_variant_get({v}, '$', 'string') END"


def fix_round_name(name: str, vocab: Sequence[str] = FUNDING_ROUNDS) -> str:
    """O-49 as one CASE: exact member kept, else first vocabulary entry (in
    order) contained in the lower-cased name, else Unknown."""
    members = ", ".join(lit(v) for v in vocab)
    whens = " ".join(f"WHEN contains(lower({name}), {lit(v.lower())}) THEN {lit(v)}" for v in vocab)
    return f"CASE WHEN {name} IN ({members}) THEN {name} {whens} ELSE {lit(UNKNOWN_ROUND)} END"
