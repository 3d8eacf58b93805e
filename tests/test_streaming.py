"""The landing stream processes the driver's pages once, resumably."""

import os

from fundlake.operators import html_extract as H
from fundlake.session import scratch_path
from fundlake.streaming.landing import articles_stream, land_articles, read_landed_pages

from sf_dirs import SF_SMALL


def test_land_articles_available_now(spark):
    pages = read_landed_pages(spark, SF_SMALL, "page_id bigint, url string, html string", glob="pages.parquet")
    sink = scratch_path(spark, "articles-sink")
    ckpt = scratch_path(spark, "articles-ckpt")
    q = land_articles(articles_stream(pages, H.DRIVER_ARTICLE, status_col=None), sink, ckpt)
    q.awaitTermination(300)
    landed = spark.read.parquet(sink)
    expected = spark.read.parquet(os.path.join(SF_SMALL, "pages.parquet")).count()
    assert landed.count() == expected
    # A second run over the same files adds nothing (offsets are checkpointed).
    land_articles(articles_stream(pages, H.DRIVER_ARTICLE, status_col=None), sink, ckpt).awaitTermination(300)
    assert spark.read.parquet(sink).count() == expected
