"""URL filters: pattern rules found by their rarest literal token.

A rule is an (action, host, path) rule or a pattern. Both become regular expressions
over a URL's canonical form: a bar, the host in lower case, and the rest
(``|blog.example.net/en/1?x=y``).

* A host rule fits its host and all subdomains when the path starts with the rule's.
* Patterns are plain text with ``*`` (anything) and ``^`` (a separator: any character but
  letters, digits and ``_ - . %``, or the end), anchored by a leading ``||`` (start of the
  host or of one of its labels) or ``|`` (start of the host) and a trailing ``|`` (end).

Tokens are runs of ASCII letters and digits, lower-cased. A literal run of a rule
is a token of every URL it fits if a literal other character, a separator or an
anchor stands on both of its sides; only those count. How often each of the rules'
tokens occurs is counted over all URLs, a rule is indexed under its rarest one, and
a URL's tokens fetch candidate rules by an equi-join. Only candidates run their
regular expression. Rules without a token (``*ad*``) are run against every URL, as
a stated set of rules that no token can leave out.

Host rules go before patterns; the longest fitting rule wins (then block before allow,
then the text). Without a fitting rule the verdict is the default, allow.

URLs are judged once per distinct text, so that one URL on a third of all rows is one
row to judge; the judged ones come back by a join on the URL, left to Spark's sizes
and skew handling.

Defined results: null URLs and URLs without ``://`` have an empty host and path and no
rule; repeated rows are judged alike; pages without an id stay; no pages give no rows;
no rules give the default everywhere; extra columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.llm.common import read_table
from fundlake.session import materialize

ALLOW, BLOCK = "allow", "block"

#: The query's rules: (action, host, path).
HOST_RULES = (
    (BLOCK, "net", "/"),
    (ALLOW, "example.net", "/en/"),
    (BLOCK, "example.com", "/de/"),
    (ALLOW, "org", "/fr/"),
)
#: Patterns for the URLs that no host rule fits: gambling, adverts, link farms, pills and
#: adult pages by a label of the host, pages that hold no article by their path.
PATTERNS = (
    (BLOCK, "||casino-"),
    (BLOCK, "-casino."),
    (BLOCK, "||bet-"),
    (BLOCK, "-bets."),
    (BLOCK, "||ads."),
    (BLOCK, "||ads-"),
    (BLOCK, "||spam-"),
    (BLOCK, "-pills."),
    (BLOCK, "||adult-"),
    (BLOCK, "||adult."),
    (BLOCK, "/ads/"),
    (BLOCK, "/login^"),
    (BLOCK, "/wp-admin/"),
    (BLOCK, "^sessionid="),
    (BLOCK, ".jpg|"),
    (BLOCK, ".zip|"),
)

_SEPARATOR = r"(?:[^A-Za-z0-9_.%-]|\z)"
#: The start of the host or of one of its labels.
_LABEL = r"^\|(?:[^/?#]*\.)?"


@dataclass(frozen=True)
class Rule:
    text: str  # what is reported, and what its length is measured on
    action: str
    kind: str  # HOST or PATTERN: a host rule goes before any pattern
    regex: str  # over the canonical form
    tokens: tuple[str, ...]  # every URL it fits holds all of them


HOST, PATTERN = "host", "pattern"


def host_rule(action: str, host: str, path: str) -> Rule:
    host = ascii_lower(host)
    regex = f"{_LABEL}{re.escape(host)}(?=[/?#]|\\z){re.escape(path)}"
    # The host ends at a delimiter; the path is a prefix, and its last run may go on.
    return Rule(host + path, action, HOST, regex, whole_tokens(f"|{host}|{path}"))


def pattern_rule(action: str, pattern: str) -> Rule:
    body, front, back = pattern, "", ""
    if body.startswith("||"):
        body, front = body[2:], _LABEL
    elif body.startswith("|"):
        body, front = body[1:], r"^\|"
    if body.endswith("|"):
        body, back = body[:-1], r"\z"
    regex = "".join(".*" if c == "*" else _SEPARATOR if c == "^" else re.escape(c) for c in body)
    literal = ("|" if front else "*") + body.replace("^", "|") + ("|" if back else "*")
    return Rule(pattern, action, PATTERN, f"(?s){front}{regex}{back}", whole_tokens(literal))


def ascii_lower(text: str) -> str:
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text)


def whole_tokens(literal: str) -> tuple[str, ...]:
    """The token runs of a literal with a literal delimiter on both sides; a ``*`` and
    the literal's own ends delimit nothing."""
    found = []
    for m in re.finditer("[A-Za-z0-9]+", literal):
        around = literal[m.start() - 1 : m.start()] or "*", literal[m.end() : m.end() + 1] or "*"
        if "*" not in around:
            found.append(ascii_lower(m[0]))
    return tuple(dict.fromkeys(found))


def rules_table(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    rows = [(r.text, r.action, r.kind, r.regex, list(r.tokens)) for r in rules]
    return spark.createDataFrame(rows, "rule string, action string, kind string, regex string, tokens array<string>")


def lower(text: Column) -> Column:
    """A-Z lower-cased, nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return lower(F.regexp_extract(_after(url), r"^([^/?#]*)", 1))


def url_path(url: Column) -> Column:
    """Behind the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after(url), r"^[^/?#]*([^?#]*)", 1)


def _after(url: Column) -> Column:
    """What follows the first ``://`` (empty without one)."""
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def canonical(url: Column) -> Column:
    """``|`` and what follows ``://``, the host lower-cased."""
    rest = _after(url)
    host = url_host(url)
    return F.concat(F.lit("|"), host, F.substring(rest, F.length(host) + 1, F.length(rest)))


def url_tokens(canon: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(lower(canon), F.lit("([a-z0-9]+)"), F.lit(1)))


def rule_index(rules: DataFrame, urls: DataFrame) -> DataFrame:
    """(token, rule, action, kind, regex): every rule with tokens under the one that the
    fewest of ``urls`` (``canon``) hold; at equal counts the longest, then the smallest."""
    rows = rules.select("rule", "action", "kind", "regex", F.explode("tokens").alias("token"))
    held = urls.select(F.explode(url_tokens(F.col("canon"))).alias("token"))
    # The rules are a list in the driver's memory, which bounds what is broadcast here.
    counts = held.join(F.broadcast(rows.select("token").distinct()), "token", "left_semi").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    rarity = F.struct(F.coalesce("n", F.lit(0)), -F.length("token"), F.col("token"))
    return rows.join(counts, "token", "left").groupBy("rule", "action", "kind", "regex").agg(F.min_by("token", rarity).alias("token"))


def matching_rules(urls: DataFrame, rules: list[Rule]) -> DataFrame:
    """(_url, rule, action, kind): every rule that fits each URL (``_url``, ``canon``; a written table)."""
    spark = urls.sparkSession
    fits = F.regexp_like(F.col("canon"), F.col("regex"))
    index = materialize(rule_index(rules_table(spark, [r for r in rules if r.tokens]), urls), "rule-index")
    tokens = urls.select("_url", "canon", F.explode(url_tokens(F.col("canon"))).alias("token"))
    found = tokens.join(F.broadcast(index), "token").where(fits).select("_url", "rule", "action", "kind")
    bare = [F.struct(*[F.lit(v).alias(n) for n, v in (("rule", r.text), ("action", r.action), ("kind", r.kind), ("regex", r.regex))])
            for r in rules if not r.tokens]
    if bare:  # a stated set of rules, run against every URL
        each = urls.select("_url", "canon", F.explode(F.array(*bare)).alias("r")).select("_url", "canon", "r.*")
        found = found.unionByName(each.where(fits).select("_url", "rule", "action", "kind"))
    return found


def judge_urls(pages: DataFrame, rules: list[Rule], keys: tuple[str, ...] = ("page_id",), url: str = "url", default: str = ALLOW) -> DataFrame:
    """The ``keys`` of every page with host, path, ``rule`` (the host rule that decides, else
    null), ``verdict`` and ``pattern`` (the pattern that decides, else null)."""
    urls = pages.where(F.instr(url, "://") > 0).select(F.col(url).alias("_url")).distinct()
    urls = materialize(urls.withColumn("canon", canonical(F.col("_url"))), "urls")
    order = F.struct((F.col("kind") == HOST).alias("h"), F.length("rule").alias("n"), F.col("action").alias("a"), F.col("rule").alias("r"))
    won = matching_rules(urls, rules).groupBy("_url").agg(F.max(order).alias("_won"))
    rows = pages.select(*[F.col(k) for k in keys], F.col(url).alias("_page_url"))
    judged = rows.join(won, F.col("_page_url") == F.col("_url"), "left")
    return judged.select(
        *keys,
        url_host(F.col("_page_url")).alias("host"),
        url_path(F.col("_page_url")).alias("path"),
        F.when(F.col("_won.h"), F.col("_won.r")).alias("rule"),
        F.coalesce(F.col("_won.a"), F.lit(default)).alias("verdict"),
        F.when(~F.col("_won.h"), F.col("_won.r")).alias("pattern"),
    )


def default_rules() -> list[Rule]:
    return [host_rule(*r) for r in HOST_RULES] + [pattern_rule(*p) for p in PATTERNS]


def op11_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(read_table(spark, sf_dir, "pages"), default_rules())


def oracle() -> str:
    """DuckDB: every rule against every URL, without tokens or index."""
    def text(value: str) -> str:
        return "'" + value.replace("'", "''") + "'"

    hosts = ", ".join(f"({text(h + p)}, {text(a)}, {text(h)}, {text(p)})" for a, h, p in HOST_RULES)
    patterns = ", ".join(f"({text(r.text)}, {text(r.action)}, {text(r.regex)})" for r in (pattern_rule(*p) for p in PATTERNS))
    return f"""
WITH hosts(rule, action, rule_host, rule_path) AS (VALUES {hosts}),
patterns(pattern, action, regex) AS (VALUES {patterns}),
rest AS (SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
split AS (SELECT page_id, r, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path,
                 contains(coalesce(url, ''), '://') AS judged, row_number() OVER () AS row FROM rest),
by_host AS (SELECT row, max({{'n': length(rule), 'a': action, 'r': rule}}) AS w FROM split, hosts
            WHERE judged AND (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY row),
by_pattern AS (SELECT row, max({{'n': length(pattern), 'a': action, 'r': pattern}}) AS w FROM split, patterns
               WHERE judged AND regexp_matches('|' || host || substr(r, length(host) + 1), regex) GROUP BY row)
SELECT page_id, host, path, h.w.r AS rule, coalesce(h.w.a, p.w.a, {text(ALLOW)}) AS verdict,
       CASE WHEN h.w IS NULL THEN p.w.r END AS pattern
FROM split LEFT JOIN by_host h USING (row) LEFT JOIN by_pattern p USING (row)"""
