"""HTML fixtures (FIXTURES §6): one per outcome of the card and article rules."""

import pytest

from fundlake.operators import html_extract as H
from fundlake.operators.html_extract import (
    ArticleSpec, ListingSpec, article_record, listing_records, parse_html, select,
)

CARD = ('<li class="wp-block-post">{title}{author}{time}</li>')
TITLE = '<h3 class="loop-card__title"><a href="https://x/a">  Big &amp; News </a></h3>'
AUTHOR = '<a class="loop-card__author"> Jane </a>'
TIME = '<time datetime="2024-01-02T03:04:05"></time>'


def page(*cards, extra=""):
    return ('<html><body><ul class="wp-block-post-template">' + "".join(cards) + "</ul>" + extra
            + "</body></html>")


def test_complete_card():
    recs = listing_records(page(CARD.format(title=TITLE, author=AUTHOR, time=TIME)), ListingSpec())
    assert recs == [{"pos": 0, "title": "Big & News", "url": "https://x/a", "author": " Jane ",
                     "publication_date": "2024-01-02T03:04:05", "error": None}]


def test_defaults_and_drops():
    cards = [
        CARD.format(title="", author=AUTHOR, time=TIME),  # no title: '' and '' kept
        CARD.format(title=TITLE, author=AUTHOR, time=""),  # no time: '' kept
        CARD.format(title='<h3 class="loop-card__title">t</h3>', author=AUTHOR, time=TIME),  # no link
        CARD.format(title=TITLE, author="", time=TIME),  # no author
        CARD.format(title=TITLE, author=AUTHOR, time="<time></time>"),  # time without datetime
    ]
    recs = listing_records(page(*cards), ListingSpec())
    assert [(r["title"], r["url"], r["publication_date"], r["error"]) for r in recs] == [
        ("", "", "2024-01-02T03:04:05", None),
        ("Big & News", "https://x/a", "", None),
        ("t", "", "", "title without link"),
        ("Big & News", "https://x/a", "", "missing author"),
        ("Big & News", "https://x/a", "", "time without datetime"),
    ]


def test_nested_li_is_not_a_card():
    nested = '<li class="wp-block-post"><ul><li class="wp-block-post">inner</li></ul></li>'
    root = parse_html(page(nested))
    assert len(select(root, "ul.wp-block-post-template > li.wp-block-post")) == 1


ARTICLE = ('<html><body><h1 class="wp-block-post-title"> Title </h1>{authors}'
           '<div class="wp-block-post-date"><time datetime="2024-05-06"></time></div>'
           '<div class="wp-block-post-content"><p>Hello <b>world</p></div></body></html>')


def test_article_author_blocks():
    primary = '<div class="post-authors-list__authors"><a>Ann</a></div><div class="article-hero__authors"><a>Bob</a></div>'
    fallback = '<div class="article-hero__authors"><a> Bob </a></div>'
    a = article_record(ARTICLE.format(authors=primary), ArticleSpec())
    b = article_record(ARTICLE.format(authors=fallback), ArticleSpec())
    assert (a["title"], a["author"], a["publication_date"], a["content"], a["error"]) == (
        "Title", "Ann", "2024-05-06", "Hello world", None)
    assert b["author"] == " Bob " and b["error"] is None


def test_article_missing_parts():
    assert article_record(ARTICLE.format(authors=""), ArticleSpec())["error"] == "missing author"
    no_title = ARTICLE.replace('<h1 class="wp-block-post-title"> Title </h1>', "")
    assert article_record(no_title.format(authors=""), ArticleSpec())["error"] == "missing title"


def test_script_text_is_not_markup():
    html = '<html><head><script>var t="</p>";</script></head><body><h1>A &amp; B</h1><article>x</article></body></html>'
    rec = article_record(html, ArticleSpec(title="h1", author_blocks=(), time=None, content="article"))
    assert rec["title"] == "A & B" and rec["error"] is None


def test_scripts_styles_and_templates_are_no_text():
    html = "<article><p>a</p><script>var x;</script><style>p{}</style><template><p>t</p></template><b>b</b></article>"
    assert H.select_one(H.parse_html(html), "article").text() == "ab"
    assert H.select_one(H.parse_html(html), "script").text() == "var x;"


def test_pages_without_a_status_need_to_say_so(spark):
    pages = spark.createDataFrame([("u", "<p>")], "url string, html string")
    with pytest.raises(ValueError):
        H.successful_pages(pages)
    assert H.successful_pages(pages, status_col=None).count() == 1 and H.failed_pages(pages, status_col=None).count() == 0
    mixed = spark.createDataFrame([("a", 200), ("b", 404), ("c", None)], "url string, status int")
    assert [r.url for r in H.successful_pages(mixed).collect()] == ["a"]
    assert sorted(map(tuple, H.failed_pages(mixed).collect())) == [("b", "status 404"), ("c", "status unknown")]
