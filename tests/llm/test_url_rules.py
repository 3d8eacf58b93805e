"""op11 against every rule's own meaning on every URL."""

import random
import re

import pytest

from fundlake.llm import url_rules as U

URLS = [
    "http://a.example.net/en/1", "http://a.example.net/en", "http://example.net/EN/", "https://EXAMPLE.net/en/x?y#z",
    "http://notexample.net/en/", "http://net/", "http://net", "http://x.org/fr/", "http://org.x/fr/", "http://x.org?/fr/",
    "http://example.com/de/1", "http://example.com/x.net/", "http://u@example.com/de/", "http://example.com:80/de/",
    "x://y://z.net/", "no scheme", "", None, "://", "http://é.net/", "http://a.net/\nb", "http://m.casino-win.example.com/en/1",
    "http://www.cheap-pills.example.org/fr/2", "http://b.example.com/Ads/", "http://b.example.com/ads/1", "http://b.example.com/pic.jpg",
    "http://b.example.com/pic.jpg?x", "http://b.example.com/login", "http://b.example.com/login2", "http://b.example.com/?sessionid=3",
]


def by_hand(url, rules):
    """(host, path, rule, verdict, pattern) by string comparison and one search per pattern."""
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host) :])[0]
    canon = "|" + U.ascii_lower(host) + rest[len(host) :]
    host = U.ascii_lower(host)
    won = []
    for r in rules if url and "://" in url else []:
        if r.kind == U.HOST:
            name, _, prefix = r.text.partition("/")
            fits = ("." + host).endswith("." + name) and path.startswith("/" + prefix)
        else:
            fits = re.search(r.regex.replace(r"\z", r"\Z"), canon) is not None
        if fits:
            won.append((r.kind == U.HOST, len(r.text), r.action, r.text))
    top = max(won, default=None)
    if top is None:
        return host, path, None, U.ALLOW, None
    return host, path, top[3] if top[0] else None, top[2], None if top[0] else top[3]


def judged(spark, urls, rules):
    pages = spark.createDataFrame(
        [(i, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, host string, rule string")
    return {r.page_id: tuple(r)[1:] for r in U.judge_urls(pages, rules).collect()}


def test_odd_urls(spark):
    rules = U.default_rules()
    assert judged(spark, URLS, rules) == {i: by_hand(u, rules) for i, u in enumerate(URLS)}


def test_random_urls_and_rules(spark):
    rng = random.Random(3)
    parts = ["a", "b", "ab", "a1", ".", "/", "-", "?", "=", "ads", "é", "x", "_", "%", "K"]
    urls = ["http://" + "".join(rng.choices(parts, k=rng.randint(1, 9))) for _ in range(300)]
    rules = [U.host_rule(rng.choice([U.ALLOW, U.BLOCK]), rng.choice(["a", "b.a", "ab"]), rng.choice(["/", "/a", "/b/"])) for _ in range(8)]
    for _ in range(60):
        body = "".join(rng.choices([*parts, "*", "^"], k=rng.randint(1, 4)))
        rules.append(U.pattern_rule(rng.choice([U.ALLOW, U.BLOCK]), rng.choice(["", "|", "||"]) + body + rng.choice(["", "|"])))
    rules = list({r.text: r for r in rules}.values())
    assert any(not r.tokens for r in rules) and any(r.tokens for r in rules)
    assert judged(spark, urls, rules) == {i: by_hand(u, rules) for i, u in enumerate(urls)}


def test_rules_stand_under_their_rarest_token(spark):
    urls = spark.createDataFrame([(u, "|" + u) for u in ["example.net/en/", "example.org/fr/", "x.net/"]], "_url string, canon string")
    index = U.rule_index(U.rules_table(spark, [U.host_rule(*r) for r in U.HOST_RULES]), urls)
    assert {r.rule: r.token for r in index.collect()} == {"net/": "net", "example.net/en/": "en", "example.com/de/": "com", "org/fr/": "org"}


@pytest.mark.parametrize("literal,tokens", [("|a.b/en", ("a", "b")), ("*a.b*", ()), ("*/Ads/*", ("ads",)), ("||x|", ("x",))])
def test_only_delimited_runs_are_tokens(literal, tokens):
    assert U.whole_tokens(literal) == tokens


def test_no_pages_no_rules_repeated_rows(spark):
    empty = spark.createDataFrame([], "page_id long, url string")
    assert U.judge_urls(empty, U.default_rules()).count() == 0
    rows = spark.createDataFrame([(None, "http://x.net/")] * 3, "page_id long, url string")
    assert [tuple(r) for r in U.judge_urls(rows, U.default_rules()).collect()] == [(None, "x.net", "/", "net/", "block", None)] * 3
    assert {r.verdict for r in U.judge_urls(rows, []).collect()} == {"allow"}
