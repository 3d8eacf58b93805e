"""Declared JSON schemas compiled to column expressions (O-44..O-47).

A declaration is a dict in JSON-Schema style: ``type`` (a name or several), for objects
``properties``, ``required`` and ``additionalProperties`` (False: none), for arrays ``items``,
and for texts ``vocabulary`` (the value must be one of these) or ``list_vocabulary`` (a comma
list of these). ``only_if`` on a property, ``(name, value)``, checks the property's words and
asks for a value only where the sibling ``name`` has that value.

The compiler turns it into one expression over a VARIANT that gives all violations as
``array<struct<path, rule, found>>``, by path: rules are ``unparsable``, ``type`` (found: the
value's type), ``missing``, ``additional``, ``no_value`` and ``vocabulary`` (found: the word).
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from fundlake.functions.sql import INTEGER_TYPES, lit

Spec = Mapping[str, Any]

DOT = lit(".")
_EMPTY = "CAST(array() AS ARRAY<STRUCT<path: STRING, rule: STRING, found: STRING>>)"


def _let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _is(t: str, accepted: str) -> str:
    """Whether a VARIANT of type ``t`` has the accepted JSON type."""
    return {
        "string": f"{t} = 'STRING'", "boolean": f"{t} = 'BOOLEAN'", "null": f"{t} = 'VOID'",
        "integer": f"{t} IN {INTEGER_TYPES}", "array": f"startswith({t}, 'ARRAY')", "object": f"startswith({t}, 'OBJECT')",
        "number": f"({t} IN {INTEGER_TYPES} OR {t} IN ('DOUBLE', 'FLOAT') OR startswith({t}, 'DECIMAL'))",
    }[accepted]


def _kind(t: str) -> str:
    """The JSON type name of a VARIANT type."""
    names = ("string", "boolean", "null", "integer", "array", "object")
    return f"CASE {' '.join(f'WHEN {_is(t, n)} THEN {lit(n)}' for n in names)} ELSE 'number' END"


def _one(path: str, rule: str, found: str = "CAST(NULL AS STRING)") -> str:
    return f"named_struct('path', {path}, 'rule', {lit(rule)}, 'found', {found})"


def _words(v: str, spec: Spec, path: str) -> str:
    """Violations of a text's vocabulary (of nothing, without one)."""
    items, words = f"array(try_variant_get({v}, '$', 'string'))", spec.get("vocabulary")
    if words is None:
        if "list_vocabulary" not in spec:
            return _EMPTY
        words = spec["list_vocabulary"]
        items = f"transform(split(try_variant_get({v}, '$', 'string'), ','), w -> trim(w))"
    known = ", ".join(lit(w) for w in words)
    return f"transform(array_except({items}, array({known})), w -> {_one(path, 'vocabulary', 'w')})"


def _check(v: str, spec: Spec, path: str, depth: int = 0) -> str:
    """All violations of a value that is there."""
    accepted = [spec["type"]] if isinstance(spec["type"], str) else list(spec["type"])
    t = f"t{depth}"
    cases = []
    if "object" in accepted:
        cases.append(f"WHEN {_is(t, 'object')} THEN {_object(v, spec, path, depth)}")
    if "array" in accepted and "items" in spec:
        e, i = f"e{depth}", f"i{depth}"
        inner = _check(e, spec["items"], f"concat({path}, '[', {i}, ']')", depth + 1)
        cases.append(f"WHEN {_is(t, 'array')} THEN flatten(transform(try_variant_get({v}, '$', 'array<variant>'), ({e}, {i}) -> {inner}))")
    if "string" in accepted and "only_if" not in spec:
        cases.append(f"WHEN {_is(t, 'string')} THEN {_words(v, spec, path)}")
    cases.append(f"WHEN {' OR '.join(_is(t, a) for a in accepted)} THEN {_EMPTY}")
    return _let(f"schema_of_variant({v})", t, f"CASE {' '.join(cases)} ELSE array({_one(path, 'type', _kind(t))}) END")


def _object(v: str, spec: Spec, path: str, depth: int) -> str:
    """All violations of an object, whose members are looked up in one map."""
    m = f"m{depth}"
    parts = [_property(m, name, inner, path, name in spec.get("required", ()), depth) for name, inner in spec["properties"].items()]
    if spec.get("additionalProperties") is False:
        known = ", ".join(lit(n) for n in spec["properties"])
        parts.append(f"transform(array_except(map_keys({m}), array({known})), n -> {_one(f'concat({path}, {DOT}, n)', 'additional')})")
    return _let(f"try_variant_get({v}, '$', 'map<string, variant>')", m, f"concat({', '.join(parts)})")


def _property(m: str, name: str, spec: Spec, path: str, required: bool, depth: int) -> str:
    v, place = f"v{depth}", f"concat({path}, {lit('.' + name)})"
    absent = f"array({_one(place, 'missing')})" if required else _EMPTY
    found = _check(v, spec, place, depth + 1)
    if "only_if" in spec:
        sibling, expected = spec["only_if"]
        asked = f"coalesce(to_json({m}[{lit(sibling)}]) = {lit(json.dumps(expected))}, false)"
        none = f"is_variant_null({v}) OR {_is(f'schema_of_variant({v})', 'string')} AND trim(try_variant_get({v}, '$', 'string')) = ''"
        words = f"CASE WHEN {_is(f'schema_of_variant({v})', 'string')} THEN {_words(v, spec, place)} ELSE {_EMPTY} END"
        found = f"concat({found}, CASE WHEN NOT {asked} THEN {_EMPTY} WHEN {none} THEN array({_one(place, 'no_value')}) ELSE {words} END)"
    return _let(f"{m}[{lit(name)}]", v, f"CASE WHEN {v} IS NULL THEN {absent} ELSE {found} END")


def violations(v: Column, spec: Spec) -> Column:
    """All violations of VARIANT ``v`` against the declaration, by path, rule and word; a NULL
    (text that could not be parsed) is one of its own."""
    compiled = F.expr(f"x -> CASE WHEN x IS NULL THEN array({_one(lit('$'), 'unparsable')}) ELSE {_check('x', spec, lit('$'))} END")
    return F.array_sort(F.get(F.call_function("transform", F.array(v), compiled), 0))
