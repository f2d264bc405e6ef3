"""Announcement items: per-source limits, union of sources with fallback,
page enrichment and text assembly."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.text import assemble, html_to_text
from .ids import assign_ids


def first_n_per_source(items: DataFrame, n: int = K.FEED_MAX_ITEMS,
                       order_cols: list[str] = ("pos",), renumber: bool = False) -> DataFrame:
    """The first ``n`` items of each source in feed order.

    ``row_number() <= n`` is planned with a WindowGroupLimit before the
    shuffle, so a source holding most of the rows ships at most ``n`` rows
    per map task.
    """
    w = Window.partitionBy("source").orderBy(*order_cols)
    out = items.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n)
    if renumber:  # position in the merged list of the source, from 0
        out = out.withColumn("pos", (F.col("_rn") - 1).cast("bigint"))
    return out.drop("_rn")


def literal_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small parameter table as literals, whose size Spark knows when it plans a join
    (a frame made from driver rows has none and is shuffled with the big side)."""
    fields = [field.split() for field in schema.split(",")]
    kind = "array<struct<" + ",".join(f"{name}:{type_}" for name, type_ in fields) + ">>"
    values = [F.struct(*[F.lit(v).alias(name) for (name, _), v in zip(fields, row)]) for row in rows]
    whole = F.array(*values).cast(kind) if values else F.from_json(F.lit("[]"), kind)
    return spark.range(1).select(F.inline(whole))


def source_registry(spark: SparkSession, sources: list[str]) -> DataFrame:
    """(source, source_ord): the registered sources in the order in which
    they are read.  The list is a parameter of the run, not data."""
    return literal_table(spark, [(s, i) for i, s in enumerate(sources, 1)], "source string, source_ord long")


def union_sources(primary: DataFrame, registry: DataFrame, n: int | None = None) -> DataFrame:
    """The items of every registered source, tagged with the source's
    registry position; ``n`` composes O02 in front."""
    return (first_n_per_source(primary, n) if n else primary).join(registry, "source")


def with_fallback(primary: DataFrame, fallback: DataFrame, registry: DataFrame,
                  n_primary: int | None = None, n_fallback: int | None = None,
                  fallback_order: list[str] = ("pos",)) -> DataFrame:
    """Sources with zero primary items take their listing items, which
    are numbered anew per source; everything keeps the registry's source
    name.  ``n_primary`` and ``n_fallback`` compose O02 per side."""
    main = union_sources(primary, registry, n_primary)
    # At most as many rows as there are registered sources, which the caller lists.
    have = F.broadcast(main.select("source").distinct())
    spare = fallback.join(registry.select("source"), "source", "left_semi").join(have, "source", "left_anti")
    order = list(fallback_order)
    if n_fallback:
        spare = first_n_per_source(spare, n_fallback, order, renumber=True)
    else:
        spare = spare.withColumn("pos", F.struct(*order))
        place = assign_ids(spare, ["source", "pos"], base=-1, id_col="_at")
        first = place.groupBy("source").agg(F.min("_at").alias("_first"))
        spare = place.join(F.broadcast(first), "source").withColumn("pos", F.col("_at") - F.col("_first"))
    spare = spare.select(*primary.columns).join(registry, "source")
    return main.unionByName(spare, allowMissingColumns=True)


def enrich_items(items: DataFrame, pages: DataFrame,
                 short_chars: int = K.SHORT_SUMMARY_CHARS) -> DataFrame:
    """Items with a link and a summary shorter than ``short_chars``
    read the landed page's text instead; a missing page keeps the summary,
    a page whose text is empty replaces it with ''.

    Items that need no page (all the empty links among them) stay out of the
    join.  Only pages that some item needs are cleaned, and a URL that was
    landed more than once counts once, with the smallest of its texts.
    """
    short = F.coalesce((F.col("link") != "") & (F.length("summary") < short_chars), F.lit(False))
    rest = items.where(~short).withColumn("text", F.col("summary"))
    asking = items.where(short)
    needed = asking.select(F.col("link").alias("url")).distinct()
    texts = (pages.select("url", "html").join(needed, "url", "left_semi")
             .groupBy(F.col("url").alias("_url")).agg(F.min(html_to_text(F.col("html"))).alias("_page")))
    found = asking.join(texts, F.col("link") == F.col("_url"), "left")
    found = found.withColumn("text", F.coalesce("_page", "summary")).drop("_url", "_page")
    return rest.unionByName(found)


def assembled_text(enriched: DataFrame) -> DataFrame:
    """The text handed to extraction."""
    return enriched.withColumn("full_text", assemble(F.col("title"), F.col("text")))
