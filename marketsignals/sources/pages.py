"""Landed web pages: page text and listing-page links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.text import absolute_url, anchors


def listing_links(pages: DataFrame, source: Column,
                  href_substring: str = K.LISTING_HREF_SUBSTRING,
                  min_title_chars: int = K.LISTING_MIN_TITLE_CHARS,
                  max_items: int | None = K.LISTING_MAX_ITEMS,
                  base: str = K.LISTING_BASE_URL) -> DataFrame:
    """O05 + O06: announcement items from listing pages.

    Per page: anchors whose href contains ``href_substring`` and whose text
    is long enough, first ``max_items`` *after* filtering, links made
    absolute, no de-duplication, empty summary.  The selection happens in the
    page's own row (array functions), so no shuffle is needed.
    """
    kept = anchors(F.col("html"), href_substring, min_title_chars)
    if max_items:
        kept = F.slice(kept, 1, max_items)
    return (pages.select(source.alias("source"), "page_id", F.posexplode(kept).alias("pos", "a"))
            .select("source", "page_id", F.col("pos").cast("bigint").alias("pos"),
                    F.col("a.title").alias("title"), F.lit("").alias("summary"),
                    absolute_url(F.col("a.href"), base).alias("link"), F.lit("").alias("published")))


def all_links(pages: DataFrame, base: str = K.LISTING_BASE_URL) -> DataFrame:
    """Every anchor of every page with its absolute URL (O06 on its own)."""
    arr = anchors(F.col("html"), "", 0)
    return (pages.select("page_id", F.posexplode(arr).alias("pos", "a"))
            .select("page_id", F.col("pos").cast("bigint").alias("pos"), F.col("a.href").alias("href"),
                    absolute_url(F.col("a.href"), base).alias("link")))
