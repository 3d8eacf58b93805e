"""Closing and trimming broken JSON replies (O-42, O-43 beyond one brace).

A reply can end anywhere: in a string, behind an escape, between a key and its value,
with brackets open; or it goes on behind its value. The text from its first bracket on is
cut into tokens, and an automaton with a stack of open brackets reads them. It
remembers the last place at which everything open could be closed; the result is the
text up to there and the closing brackets. So:

* a string that is cut as a value is closed where it ends, an escape cut in two is dropped;
* line breaks and tabs that stand in a string as they are become escapes, the backslash of
  an escape that JSON does not know goes;
* a key without a whole value goes, with the comma before it;
* a bare word that is no number, ``true``, ``false`` or ``null`` ends the text, as does any
  token in a wrong place (a closing bracket of the other kind, two values in a row);
* what follows the closed outermost value goes.

White space between tokens goes too. Text without a bracket has no result (NULL). All of it
is built-in Spark; only texts given (not NULL) are cut into tokens.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A whole string, a string the text ends in, a sign, or a bare word.
_TOKEN = r'("(?:[^"\\]|\\(?s:.))*(?:"|\\?$)|[{}\[\]:,]|[^\s"{}\[\]:,]+)'
_STRING_END = r'^"(?s:[^"\\]|\\.)*"$'
#: An escape that the end of the text cuts in two.
_CUT_ESCAPE = r"(?<!\\)((?:\\\\)*)\\(?:u[0-9A-Fa-f]{0,3})?$"
_ESCAPES = r'(\\["\\/bfnrt]|\\u[0-9A-Fa-f]{4})|\\'  # known ones, or a backslash of others
_WORD = r"^(?:true|false|null|-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?)$"

# The automaton. ``at`` says what may come next: v a value, a value or the end of an array (behind
# its bracket), k a key or the end of an object, K a key, c a colon, e the end of a value, d done,
# x wrong. ``stack`` holds the open brackets, the innermost first. ``safe`` counts the tokens up
# to the last place at which all that is open could be closed, ``open`` was the stack there.
_START = "named_struct('n', 0, 'at', 'v', 'stack', '', 'safe', 0, 'open', '')"
_NEXT = """CASE
    WHEN s.at IN ('d', 'x') THEN s.at
    WHEN s.at IN ('v', 'a') AND t = '{' THEN 'k'
    WHEN s.at IN ('v', 'a') AND t = '[' THEN 'a'
    WHEN s.at IN ('v', 'a') AND (left(t, 1) = '"' OR t RLIKE r'%s') AND s.stack <> '' THEN 'e'
    WHEN s.at IN ('k', 'K') AND left(t, 1) = '"' THEN 'c'
    WHEN s.at = 'c' AND t = ':' THEN 'v'
    WHEN s.at = 'e' AND t = ',' THEN if(left(s.stack, 1) = '{', 'K', 'v')
    WHEN s.at IN ('k', 'e') AND t = '}' AND left(s.stack, 1) = '{' OR s.at IN ('a', 'e') AND t = ']' AND left(s.stack, 1) = '['
        THEN if(length(s.stack) = 1, 'd', 'e')
    ELSE 'x' END""" % _WORD
_STACK = """CASE WHEN t IN ('{', '[') THEN concat(t, s.stack) WHEN t IN ('}', ']') THEN substr(s.stack, 2) ELSE s.stack END"""
#: One step: first what comes next, then whether everything could be closed here.
_STEP = f"""transform(array(named_struct('at', {_NEXT}, 'stack', {_STACK})), q -> named_struct(
    'n', s.n + 1, 'at', q.at, 'stack', if(q.at IN ('x', 'd'), s.stack, q.stack),
    'safe', if(s.at NOT IN ('d', 'x') AND q.at IN ('k', 'a', 'e', 'd'), s.n + 1, s.safe),
    'open', if(s.at NOT IN ('d', 'x') AND q.at IN ('k', 'a', 'e', 'd'), q.stack, s.open)))[0]"""


def json_tokens(text: Column) -> Column:
    """The tokens of a text from its first bracket on; a string the text ends in is closed."""
    found = F.regexp_extract_all(F.regexp_extract(text, r"(?s)([{\[].*)", 1), F.lit(_TOKEN), F.lit(1))

    def closed(token: Column) -> Column:
        for raw, escape in (("\n", "n"), ("\r", "r"), ("\t", "t")):
            token = F.replace(token, F.lit(raw), F.lit("\\" + escape))
        cut = token.startswith('"') & ~F.regexp_like(token, F.lit(_STRING_END))
        whole = F.when(cut, F.concat(F.regexp_replace(token, _CUT_ESCAPE, "$1"), F.lit('"'))).otherwise(token)
        return F.when(F.contains(token, F.lit("\\")), F.regexp_replace(whole, _ESCAPES, "$1")).otherwise(whole)

    return F.transform(found, closed)


def repair_json(text: Column) -> Column:
    """The longest start of ``text`` that closes to a JSON object or array, closed."""
    return repaired(F.transform(F.array(json_tokens(text)), lambda tokens: F.struct(tokens.alias("t"))))


def repaired(held: Column) -> Column:
    """The repaired text of ``array(struct(t))``: the tokens, bound once."""
    def one(x: Column) -> Column:
        end = F.call_function("aggregate", x["t"], F.expr(_START), F.expr(f"(s, t) -> {_STEP}"))
        return F.struct(x["t"].alias("t"), end.alias("end"))

    def text(x: Column) -> Column:
        closers = F.translate(x["end"]["open"], "{[", "}]")
        return F.when(x["end"]["safe"] > 0, F.concat(F.array_join(F.slice(x["t"], F.lit(1), x["end"]["safe"]), ""), closers))

    return F.get(F.transform(F.transform(held, one), text), 0)
