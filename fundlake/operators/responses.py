"""Model-response handling (O-18, O-41..O-47, O-62).

Raw responses are landed as a table first; everything here is deterministic
column logic over that table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlake.functions import variant
from fundlake.functions.repair import repair_json
from fundlake.functions.text import contains_ci, ustrip
from fundlake.schemas import FINAL_ANSWER_MARKER


def repair_final_answer(text: Column) -> Column:
    """O-42: take what follows the last ``Final Answer":`` (the whole text
    when that form is absent), drop its last character, strip, and append
    ``}`` when the result is not valid JSON."""
    t = ustrip(text)
    tail = F.element_at(F.split(t, FINAL_ANSWER_MARKER, -1), -1)
    cut = ustrip(F.substring(tail, F.lit(1), F.length(tail) - 1))
    return F.when(F.try_parse_json(cut).isNull(), F.concat(cut, F.lit("}"))).otherwise(cut)


def classify_response(text: Column) -> tuple[Column, Column, Column, Column]:
    """O-43: (kind, output, tool, tool_input).

    ``final`` when the text mentions ``Final Answer`` (output = repaired
    text); ``tool`` when the text is a JSON object holding both ``Action`` and
    ``Action Input``; otherwise ``unparseable``.
    """
    t = ustrip(text)
    is_final = t.contains("Final Answer")
    parsed = F.try_parse_json(t)
    action = F.try_variant_get(parsed, "$.Action", "variant")
    action_input = F.try_variant_get(parsed, "$['Action Input']", "variant")
    is_tool = ~is_final & action.isNotNull() & action_input.isNotNull() & t.contains("Action Input")
    kind = F.when(is_final, F.lit("final")).when(is_tool, F.lit("tool")).otherwise(F.lit("unparseable"))
    output = F.when(is_final, repair_final_answer(t))
    return kind, output, F.when(is_tool, variant.scalar_text(action)), F.when(is_tool, variant.scalar_text(action_input))


def unwrap_envelope(output_json: Column) -> Column:
    """O-41: the ``properties`` member; when that holds a truthy
    ``properties`` member itself, that inner one (VARIANT; NULL when the
    outer member is missing)."""
    v = F.try_parse_json(output_json)
    outer = variant.field(v, "properties")
    inner = variant.field(outer, "properties")
    return F.when(variant.truthy(inner), inner).otherwise(outer)


def with_classified_response(df: DataFrame, text_col: str) -> DataFrame:
    """O-42 + O-43 + O-41 as staged columns (each parse happens once): adds
    kind, output, tool, tool_input and ``obj`` (the unwrapped VARIANT).

    A final answer or tool call that the one-brace rule leaves unreadable (cut
    off, or with text behind it) is closed and trimmed by ``repair_json``;
    ``repaired`` says so."""
    staged = df.withColumn("__t", ustrip(F.col(text_col)))
    t = F.col("__t")
    staged = staged.withColumns({
        "__final": t.contains("Final Answer"),
        "__tail": F.element_at(F.split(t, FINAL_ANSWER_MARKER, -1), -1),
    })
    staged = staged.withColumns({
        "__whole": F.when(~F.col("__final"), F.try_parse_json(t)),
        "__cut": F.when(F.col("__final"), ustrip(F.substring("__tail", F.lit(1), F.length("__tail") - 1))),
    })
    staged = staged.withColumn("__cut_v", F.try_parse_json("__cut"))
    staged = staged.withColumn("__braced_v", F.when(F.col("__cut_v").isNull(), F.try_parse_json(F.concat("__cut", F.lit("}")))))
    broken = (F.col("__final") & F.col("__cut_v").isNull() & F.col("__braced_v").isNull()
              | ~F.col("__final") & F.col("__whole").isNull() & t.contains("Action Input"))
    staged = staged.withColumn("__fixed", repair_json(F.when(broken, F.col("__tail"))))
    staged = staged.withColumn("__fixed_v", F.try_parse_json("__fixed"))
    staged = staged.withColumn("__parsed", F.when(~F.col("__final"), F.coalesce("__whole", "__fixed_v")))
    staged = staged.withColumns({
        "__action": F.try_variant_get("__parsed", "$.Action", "variant"),
        "__action_input": F.try_variant_get("__parsed", "$['Action Input']", "variant"),
    })
    is_tool = (~F.col("__final") & F.col("__action").isNotNull() & F.col("__action_input").isNotNull()
               & t.contains("Action Input"))
    braced = F.concat("__cut", F.lit("}"))
    staged = staged.withColumns({
        "kind": F.when(F.col("__final"), F.lit("final")).when(is_tool, F.lit("tool")).otherwise(F.lit("unparseable")),
        "output": F.when(F.col("__final"), F.when(F.col("__cut_v").isNotNull(), F.col("__cut"))
                         .when(F.col("__braced_v").isNotNull(), braced)
                         .otherwise(F.coalesce(F.col("__fixed"), braced))),
        "__out_v": F.when(F.col("__final"), F.coalesce("__cut_v", "__braced_v", "__fixed_v")),
        "tool": F.when(is_tool, variant.scalar_text(F.col("__action"))),
        "tool_input": F.when(is_tool, variant.scalar_text(F.col("__action_input"))),
        "repaired": F.col("__fixed_v").isNotNull() & (F.col("__final") | is_tool),
    })
    staged = staged.withColumn("__outer", variant.field(F.col("__out_v"), "properties"))
    staged = staged.withColumn("__inner", variant.field(F.col("__outer"), "properties"))
    staged = staged.withColumn("__inner_t", variant.vtype(F.col("__inner")))
    staged = staged.withColumn(
        "obj", F.when(variant.truthy(F.col("__inner"), F.col("__inner_t")), F.col("__inner")).otherwise(F.col("__outer")))
    return staged.drop(*[c for c in staged.columns if c.startswith("__")])


def object_keys(v: Column) -> Column:
    """Keys of a JSON object (NULL for anything else)."""
    return F.when(variant.is_object(v), F.json_object_keys(F.to_json(v)))


def validate_object(
    v: Column,
    required: Sequence[str],
    allowed: Sequence[str],
    types: dict[str, Sequence[str]] | None = None,
) -> tuple[Column, Column, Column]:
    """O-44..O-46: (missing required keys, additional keys, type violations),
    each a sorted comma-joined string ('' when clean)."""
    keys = F.coalesce(object_keys(v), F.array().cast("array<string>"))
    req = F.array(*[F.lit(x) for x in required])
    allow = F.array(*[F.lit(x) for x in allowed])
    missing = F.array_join(F.array_sort(F.array_except(req, keys)), ",")
    extra = F.array_join(F.array_sort(F.array_except(keys, allow)), ",")
    bad = []
    for name, accepted in (types or {}).items():
        t = variant.vtype(variant.field(v, name))
        ok = F.lit(False)
        for a in accepted:
            if a == "string":
                ok = ok | (t == "STRING")
            elif a == "boolean":
                ok = ok | (t == "BOOLEAN")
            elif a == "integer":
                ok = ok | t.isin("TINYINT", "SMALLINT", "INT", "BIGINT")
            elif a == "number":
                ok = ok | t.isin("TINYINT", "SMALLINT", "INT", "BIGINT", "DOUBLE", "FLOAT") | t.startswith("DECIMAL")
            elif a == "null":
                ok = ok | (t == "VOID")
        bad.append(F.when(t.isNotNull() & ~ok, F.lit(name)))
    type_bad = F.array_join(F.array_sort(F.filter(F.array(*bad), lambda x: x.isNotNull())), ",") if bad else F.lit("")
    return missing, extra, type_bad


def vocabulary_violations(values: Column, vocab: Sequence[str]) -> Column:
    """O-47: items of a comma list (trimmed) outside the vocabulary."""
    items = F.transform(F.split(values, ","), lambda x: ustrip(x))
    return F.array_join(F.array_sort(F.array_except(items, F.array(*[F.lit(x) for x in vocab]))), ",")


def drop_schema_echo_names(df: DataFrame, name_col: str = "company_name") -> DataFrame:
    """O-18: drop rows whose name contains ``type`` in any case (a schema
    echo); a NULL name is kept, as the text ``nan`` would be."""
    return df.where(~contains_ci(F.col(name_col).cast("string"), "type"))


def first_step_tokens(steps: Column) -> Column:
    """O-62: total tokens over the message log of the first intermediate step
    (0 when there is no step or no log)."""
    first = F.get(steps, 0)
    log = first["message_log"]
    return F.coalesce(
        F.aggregate(
            F.transform(log, lambda m: F.coalesce(m["total_tokens"], F.lit(0).cast("bigint"))),
            F.lit(0).cast("bigint"),
            lambda acc, x: acc + x,
        ),
        F.lit(0).cast("bigint"),
    )
