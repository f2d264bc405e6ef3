"""Queries over pages, documents and announcement items (O02-O07, O09,
O10, O12, O16)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import contains_any, html_to_text, is_blank
from ..operators import items as IT
from ..sources import fixtures as FX
from ..sources import pages as PG
from ..sources.tables import read_table
from . import text_sql as X
from .fixture_sql import with_fixtures
from .registry import query

# Parameters for the landed tables: their anchors look like <a href="/The">The</a>.
HREF_SUBSTRING = "/"
MIN_TITLE = 4
# Keywords that occur in the documents table (the default list has no hits).
DOC_KEYWORDS = ["nicht", "eaux", "ción", "price", "wzrost cen"]
LISTING_SOURCES = 25


def _listing_source():
    """Each landed page is the listing page of one source src0..src24 (the
    feeds of src20..src24 are down, so only their listings are used)."""
    return F.concat(F.lit("src"), (F.col("page_id") % LISTING_SOURCES).cast("string"))


_LISTING_SOURCE_SQL = f"'src' || cast(page_id % {LISTING_SOURCES} as varchar)"


@query("page_text", f"select page_id, url, {X.html_to_text('html')} as page_text from pages")
def q_page_text(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages")
    return pages.select("page_id", "url", html_to_text(F.col("html")).alias("page_text"))


@query("listing_links", f"""with {X.anchors_cte('a', 'url', HREF_SUBSTRING, MIN_TITLE)}
select source, page_id, pos, title, '' as summary, {X.absolute('href')} as link, '' as published
from a where pos < 15""")
def q_listing_links(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages")
    return PG.listing_links(pages, F.col("url"), HREF_SUBSTRING, MIN_TITLE, 15)


@query("absolute_links", f"""with {X.anchors_cte('a', 'url', '', 0)}
select page_id, pos, href, {X.absolute('href')} as link from a""")
def q_absolute_links(spark, sf_dir):
    return PG.all_links(read_table(spark, sf_dir, "pages"))


_KW_SQL = " or ".join(f"contains(lower(text), {X.lit(k)})" for k in DOC_KEYWORDS)


@query("keyword_filter", f"select doc_id, source from documents where {_KW_SQL}")
def q_keyword_filter(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return docs.where(contains_any(F.col("text"), DOC_KEYWORDS)).select("doc_id", "source")


@query("blank_guard", f"select doc_id, {X.blank('text')} as blank from documents")
def q_blank_guard(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return docs.select("doc_id", is_blank(F.col("text")).alias("blank"))


_FIRST5 = """first5 as (
  select * exclude (rn) from (select *, row_number() over (partition by source order by pos) as rn from f2) where rn <= 5)"""


@query("first_n_per_source", with_fixtures(f"with {_FIRST5} select * from first5", "f2"))
def q_first_n_per_source(spark, sf_dir):
    return IT.first_n_per_source(FX.items_table(spark, sf_dir), 5)


# The registered sources in reading order.
SOURCES = [f"src{i}" for i in reversed(range(LISTING_SOURCES))]
_REGISTRY = "registry(source, source_ord) as (values " + ", ".join(f"('{s}', {i}::bigint)" for i, s in enumerate(SOURCES, 1)) + ")"
_LISTING = f"""{X.anchors_cte('la', _LISTING_SOURCE_SQL, HREF_SUBSTRING, MIN_TITLE)},
listing as (select source, page_id, pos, title, '' as summary, {X.absolute('href')} as link, '' as published from la)"""


@query("union_sources", with_fixtures(f"with {_REGISTRY} select f2.*, registry.source_ord from f2 join registry using (source)",
                                      "f2"))
def q_union_sources(spark, sf_dir):
    return IT.union_sources(FX.items_table(spark, sf_dir), IT.source_registry(spark, SOURCES))


@query("source_fallback", with_fixtures(f"""with {_REGISTRY}, {_LISTING},
spare as (
  select source, row_number() over (partition by source order by page_id, pos) - 1 as pos, title, summary, link, published
  from listing where source not in (select source from f2))
select f2.*, registry.source_ord from f2 join registry using (source)
union all
select spare.*, registry.source_ord from spare join registry using (source)""", "f2"))
def q_source_fallback(spark, sf_dir):
    listing = PG.listing_links(read_table(spark, sf_dir, "pages"), _listing_source(), HREF_SUBSTRING, MIN_TITLE, None)
    return IT.with_fallback(FX.items_table(spark, sf_dir), listing, IT.source_registry(spark, SOURCES),
                            fallback_order=["page_id", "pos"])


_ENRICH = f"""enriched as (
  select f2.source, f2.pos, f2.title, f2.link,
    case when f2.link <> '' and length(f2.summary) < 200
         then coalesce(p.page, f2.summary) else f2.summary end as text
  from f2 left join (select url, min({X.html_to_text('html')}) as page from pages group by url) p
    on f2.link <> '' and length(f2.summary) < 200 and f2.link = p.url)"""


@query("enrich_items", with_fixtures(f"with {_ENRICH} select * from enriched", "f2"))
def q_enrich_items(spark, sf_dir):
    items = FX.items_table(spark, sf_dir)
    out = IT.enrich_items(items, read_table(spark, sf_dir, "pages"))
    return out.select("source", "pos", "title", "link", "text")


@query("assembled_text", with_fixtures(
    f"with {_ENRICH} select source, pos, title || chr(10) || chr(10) || text as full_text from enriched", "f2"))
def q_assembled_text(spark, sf_dir):
    items = FX.items_table(spark, sf_dir)
    out = IT.assembled_text(IT.enrich_items(items, read_table(spark, sf_dir, "pages")))
    return out.select("source", "pos", "full_text")
