"""Declared schemas and tolerant parsing against plain Python versions."""

import json
import random
import re

from pyspark.sql import functions as F

from fundlake.functions.repair import repair_json
from fundlake.functions.schema_rules import violations
from fundlake.schemas import COMPANY_DECLARATION, FUNDING_DECLARATION


def plain_violations(value, spec, path="$"):
    """The declaration's meaning, value by value."""
    kind = ("null" if value is None else "boolean" if isinstance(value, bool) else "integer" if isinstance(value, int)
            else "number" if isinstance(value, float) else "string" if isinstance(value, str) else "array" if isinstance(value, list) else "object")
    accepted = [spec["type"]] if isinstance(spec["type"], str) else list(spec["type"])
    if kind not in accepted and not (kind == "integer" and "number" in accepted):
        return [(path, "type", kind)]
    found = []
    if kind == "object":
        for name, inner in spec["properties"].items():
            if name not in value:
                found += [(f"{path}.{name}", "missing", None)] if name in spec["required"] else []
                continue
            found += plain_violations(value[name], {k: v for k, v in inner.items() if "only_if" not in inner or "vocabulary" not in k}, f"{path}.{name}")
            if "only_if" in inner and value.get(inner["only_if"][0]) is inner["only_if"][1]:
                if value[name] is None or (isinstance(value[name], str) and not value[name].strip()):
                    found.append((f"{path}.{name}", "no_value", None))
                elif isinstance(value[name], str):
                    found += plain_words(value[name], inner, f"{path}.{name}")
        found += [(f"{path}.{n}", "additional", None) for n in value if n not in spec["properties"]]
    if kind == "array":
        for i, e in enumerate(value):
            found += plain_violations(e, spec["items"], f"{path}[{i}]")
    if kind == "string":
        found += plain_words(value, spec, path)
    return found


def plain_words(value, spec, path):
    words = [value] if "vocabulary" in spec else [w.strip(" ") for w in value.split(",")] if "list_vocabulary" in spec else []
    known = spec.get("vocabulary") or spec.get("list_vocabulary") or ()
    return [(path, "vocabulary", w) for w in dict.fromkeys(words) if w not in known]


def checked(spark, texts, spec):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    rows = df.select("id", violations(F.try_parse_json("t"), spec).alias("v")).collect()
    return {r.id: [tuple(x) for x in r.v] for r in rows}


def test_random_replies(spark):
    rng = random.Random(2)
    words = [None, True, False, 3, 2.5, "", " ", "Energy", "Energy, Space", "Europe", "living", "Seed", "x", [], {}, [1], {"a": 1}]
    company = [{n: rng.choice(words) for n in [*COMPANY_DECLARATION["properties"], "extra"] if rng.random() < 0.9} for _ in range(150)]
    names = ["currency_symbol", "round_name", "amount", "date", "note"]
    funding = [{"funding_rounds": [rng.choice([1, None, *[{n: rng.choice(words) for n in names if rng.random() < 0.8}] * 4]) for _ in range(rng.randint(0, 3))]}
               for _ in range(100)] + [{"funding_rounds": None}, {}, [], 5, "x", {"funding_rounds": {}}]
    order = lambda v: sorted(v, key=lambda x: (x[0], x[1], x[2] is not None, x[2]))
    for values, spec in ((company, COMPANY_DECLARATION), (funding, FUNDING_DECLARATION)):
        got = checked(spark, [json.dumps(v) for v in values], spec)
        assert got == {i: order(plain_violations(v, spec)) for i, v in enumerate(values)}


def test_unparsable_and_null_replies(spark):
    assert checked(spark, ["oops", None, '{"funding_rounds":[]}'], FUNDING_DECLARATION) == {
        0: [("$", "unparsable", None)], 1: [("$", "unparsable", None)], 2: []}


def plain_repair(text):
    """The longest start at a token's end that closes to JSON, found by trying them all."""
    at = re.search(r"[{\[]", text)
    if at is None:
        return None
    text = text[at.start() :]
    ends = [m.end() for m in re.finditer(r'"(?:[^"\\]|\\.)*(?:"|\\?$)|[{}\[\]:,]|[^\s"{}\[\]:,]+', text, re.S)]
    for end in reversed(ends):
        part, stack, inside, skip = text[:end], [], False, False
        for c in part:
            if skip:
                skip = False
            elif inside:
                skip, inside = c == "\\", c != '"'
            elif c == '"':
                inside = True
            elif c in "{[":
                stack.append({"{": "}", "[": "]"}[c])
            elif c in "}]" and stack:
                stack.pop()
        if inside:
            part = re.sub(r"(?<!\\)((?:\\\\)*)\\(?:u[0-9A-Fa-f]{0,3})?$", r"\1", part) + '"'
        part = re.sub(r'(\\["\\/bfnrt]|\\u[0-9A-Fa-f]{4})|\\', lambda m: m[1] or "", part)
        try:
            return json.loads(part + "".join(reversed(stack)))
        except ValueError:
            continue
    return None


def test_cut_replies_are_closed(spark):
    rng = random.Random(8)

    def value(depth):
        kind = rng.randint(0, 8 if depth else 5)
        if kind < 6:
            return [None, True, 17, -2.5e3, "", 'q "x" \\ é\n,{]'][kind]
        if kind == 6:
            return [value(depth - 1) for _ in range(rng.randint(0, 3))]
        return {rng.choice(["a", "b c", 'k"', "d:"]) + str(i): value(depth - 1) for i in range(rng.randint(0, 3))}

    texts = []
    for _ in range(500):
        whole = json.dumps({"a": value(2), "b": [value(2)]}, ensure_ascii=rng.random() < 0.5, separators=rng.choice([(",", ":"), (", ", ": ")]))
        texts.append(rng.choice(["", "reply: "]) + whole[: rng.randint(0, len(whole))] + rng.choice(["", "", "", "}", "]", " done", ","]))
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    rows = df.select("id", repair_json(F.col("t")).alias("r"), F.try_parse_json(repair_json(F.col("t"))).isNull().alias("bad")).collect()
    for r in rows:
        expected = plain_repair(texts[r.id])
        assert (json.loads(r.r) if r.r is not None else None) == expected, texts[r.id]
        assert not (r.r is not None and r.bad), texts[r.id]


def test_raw_line_breaks_and_nothing_to_repair(spark):
    df = spark.createDataFrame([('{"a":"x\ny',), ("no bracket",), (None,), ("",)], "t string")
    assert [r.r for r in df.select(repair_json(F.col("t")).alias("r")).collect()] == ['{"a":"x\\ny"}', None, None, None]
