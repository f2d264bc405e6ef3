"""Operational tables derived from the landed Parquet tables.

The engine works on announcement items, stored signals, raw model
responses, token usage and quotes.  These builders derive such tables from
the driver's TPC-H-like tables with plain column expressions, so every
query's work grows with the input (F1..F6 in FIXTURES.md).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shuffle_partitions
from .tables import read_table

ORDER_COLS = ["o1", "o2", "o3", "o4", "o5"]


def signals_table(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """one signal per lineitem, with NULLs and blanks in the key columns.

    Every join's build side is a base table, so Spark sizes it from its
    files: a side below ``spark.sql.autoBroadcastJoinThreshold`` is broadcast,
    a large one (part, supplier at big scale factors) is a sort-merge join.
    (Joining supplier+nation+region first would hide that: the estimate of
    a join is the product of its inputs, which is never broadcast.)

    A split of lineitem makes signals of twenty times its size.  With
    ``spread`` its narrow rows are dealt to more tasks first, for callers
    that sort the signals in the tasks of the scan and would spill them.
    """
    li = read_table(spark, sf_dir, "lineitem")
    if spread:
        n = shuffle_partitions(spark)
        li = li.repartition(max(n, min(200, 4 * n)), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    sup = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    j = (li.join(part, F.col("l_partkey") == F.col("p_partkey"))
         .join(sup, F.col("l_suppkey") == F.col("s_suppkey"))
         .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
         .join(region, F.col("n_regionkey") == F.col("r_regionkey")))
    material = (F.when(F.col("p_type") == "STANDARD", "celuloza")
                .when(F.col("p_type") == "ECONOMY", "tektura")
                .when(F.col("p_type") == "MEDIUM", "papier")
                .when(F.col("p_type") == "PROMO", "PE")
                .when(F.col("p_type") == "SMALL", "PP")
                .otherwise("PET"))
    tax = F.round(F.col("l_tax") * 100)
    return j.select(
        F.col("l_orderkey").alias("o1"), F.col("l_linenumber").alias("o2"),
        F.col("l_partkey").alias("o3"), F.col("l_suppkey").alias("o4"),
        F.col("l_shipdate").alias("o5"),
        material.alias("material"),
        F.when(F.col("l_partkey") % 3 == 0, F.lit(None).cast("string"))
         .when(F.col("l_partkey") % 7 == 0, "").otherwise(F.col("p_name")).alias("material_detail"),
        F.when(F.col("l_returnflag") == "A", "podwyzka").when(F.col("l_returnflag") == "R", "obnizka")
         .otherwise("utrzymanie").alias("change_type"),
        F.when(F.col("l_linenumber") == 7, F.lit(None).cast("double"))
         .when(F.col("l_linestatus") == "F", F.round(F.col("l_discount") * 100))
         .otherwise(F.col("l_quantity")).alias("amount"),
        F.when(F.col("l_linestatus") == "F", "procent").otherwise("EUR/t").alias("unit"),
        F.when(F.col("l_linestatus") == "O", "EUR").alias("currency"),
        F.when(F.col("l_suppkey") % 11 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("r_name")).alias("region"),
        F.when(F.col("l_linenumber") == 5, F.lit(None).cast("string"))
         .otherwise(F.date_trunc("month", "l_shipdate").cast("date").cast("string")).alias("effective_date"),
        F.when(F.col("l_linenumber") == 6, F.lit(None).cast("string"))
         .otherwise((F.col("l_shipdate") - F.expr("INTERVAL 30 DAYS")).cast("date").cast("string"))
         .alias("announcement_date"),
        F.when(F.col("l_suppkey") % 10 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("s_name")).alias("source_company"),
        F.concat(F.lit("https://example.org/n/"), F.col("l_orderkey").cast("string")).alias("source_url"),
        F.when(tax <= 2, "low").when(tax <= 5, "medium").otherwise("high").alias("confidence"),
        F.concat(F.col("l_returnflag"), F.lit(" "), F.col("p_name")).alias("summary_pl"),
        F.lit("2026-01-01").alias("extracted_on"),
    )


def items_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """announcement items, one per document (title: its first line,
    summary: its whole text); links point at pages."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    j = docs.join(pages, F.col("page_id") == F.col("doc_id"), "left")
    return j.select(
        "source",
        F.col("doc_id").alias("pos"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.col("text").alias("summary"),
        F.when(F.col("doc_id") % 7 == 0, "")
         .when(F.col("url").isNull(), F.concat(F.lit("http://missing.example/"), F.col("doc_id").cast("string")))
         .otherwise(F.col("url")).alias("link"),
        F.lit("").alias("published"),
    )


def usage_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """token usage log, one row per event."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias("id"),
        F.col("event_type").alias("process"),
        F.concat(F.lit("m"), (F.col("user_id") % 3).cast("string")).alias("model"),
        F.regexp_extract("props", "([0-9]+)", 1).try_cast("bigint").alias("input_tokens"),
        F.floor("value").cast("bigint").alias("output_tokens"),
        F.when(F.col("event_type") == "error", F.col("user_id") % 5).otherwise(0)
         .cast("bigint").alias("reasoning_tokens"),
        F.col("ts").alias("logged_at"),
    )


def _inflect(change_type: Column) -> Column:
    return (F.when(change_type == "podwyzka", "podwyżce")
            .when(change_type == "obnizka", "obniżce").otherwise("utrzymaniu"))


# English words of the generated announcements.
_ENGLISH = {"celuloza": "pulp", "tektura": "containerboard", "papier": "paper"}


def _if(value: Column, *parts) -> Column:
    """A phrase that is left out when its value is not known."""
    return F.when(value.isNotNull(), F.concat(*parts)).otherwise(F.lit(""))


def announcements_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one announcement text per signal, three in four Polish, the others
    English; phrases of unknown fields are left out.  The generating columns
    are kept as ground truth for extraction."""
    f1 = signals_table(spark, sf_dir)
    c = F.col
    lit = F.lit
    amount = c("amount").cast("int").cast("string")
    head = F.concat(_if(c("source_company"), lit(" — "), c("source_company")),
                    _if(c("announcement_date"), lit(", "), c("announcement_date")), lit("\n"))
    polish = F.concat(
        lit("Komunikat prasowy"), head, F.coalesce("source_company", lit("Producent")), lit(" informuje o "),
        _inflect(c("change_type")), lit(" cen: "), c("material"),
        _if(c("amount"), lit(" o "), amount, F.when(c("unit") == "procent", "%").otherwise(" EUR/t")),
        _if(c("region"), lit(" w regionie "), c("region")), lit("."),
        _if(c("effective_date"), lit(" Nowe ceny od "), c("effective_date"), lit(".")))
    noun = (F.when(c("change_type") == "podwyzka", "an increase").when(c("change_type") == "obnizka", "a decrease")
            .otherwise("unchanged prices"))
    english = F.concat(
        lit("Press release"), head, F.coalesce("source_company", lit("The producer")), lit(" announces "), noun,
        _if(c("amount"), lit(" of "), F.when(c("unit") == "procent", F.concat(amount, lit("%")))
            .otherwise(F.concat(lit("€"), amount, lit(" per tonne")))),
        lit(" for "), F.coalesce(F.create_map(*[lit(x) for kv in _ENGLISH.items() for x in kv])[c("material")], c("material")),
        _if(c("region"), lit(" in the "), c("region"), lit(" region")),
        _if(c("effective_date"), lit(", effective "), c("effective_date")), lit("."))
    return f1.select(
        *ORDER_COLS, F.when(c("o1") % 4 == 1, english).otherwise(polish).alias("text"), "material", "change_type", "amount",
        F.when(c("amount").isNotNull(), c("unit")).alias("unit"), "region",
        "effective_date", "announcement_date", "source_company")


def announcement_items(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(items, pages) that carry the announcements of F4.  The title is
    the text's first line, the body its rest: in the item's summary, or for
    every fifth order behind the item's link, as a page.  The uniqueness key
    of the signal goes along, for dealing items to files."""
    f4 = announcements_table(spark, sf_dir)
    title = F.substring_index("text", "\n", 1)
    body = F.substr("text", F.length(title) + 2)
    linked = F.col("o1") % 5 == 0
    url = F.concat(F.lit("https://example.org/n/"), F.concat_ws("-", *[F.col(o).cast("string") for o in ORDER_COLS[:4]]))
    source = F.concat(F.lit("s"), (F.col("o1") % len(RUN_SOURCES)).cast("string"))
    items = f4.select(source.alias("source"), *ORDER_COLS, title.alias("title"), F.when(linked, "").otherwise(body).alias("summary"),
                      url.alias("link"), F.lit("").alias("published"), "material", "source_company", "effective_date", "amount")
    html = F.concat(F.lit("<html><head><style>p{}</style></head><body><nav>menu</nav><p>"), body, F.lit("</p></body></html>"))
    return items, f4.where(linked).select(url.alias("url"), html.alias("html"))


# Sources of F7 in the order in which a run reads them.
RUN_SOURCES = ["s2", "s0", "s1"]


def _q(col: Column) -> Column:
    """JSON string literal of a column, or ``null``."""
    return F.coalesce(F.concat(F.lit('"'), col, F.lit('"')), F.lit("null"))


def _body(material: Column, amount_text: Column) -> Column:
    c = F.col
    return F.concat(
        F.lit('"material": '), material,
        F.lit(', "material_detail": '), _q(c("material_detail")),
        F.lit(', "change_type": "'), c("change_type"),
        F.lit('", "amount": '), amount_text,
        F.lit(', "unit": "'), c("unit"),
        F.lit('", "currency": '), _q(c("currency")),
        F.lit(', "region": '), _q(c("region")),
        F.lit(', "effective_date": '), _q(c("effective_date")),
        F.lit(', "announcement_date": '), _q(c("announcement_date")),
        F.lit(', "source_company": '), _q(c("source_company")),
        F.lit(', "confidence": "'), c("confidence"),
        F.lit('", "summary_pl": "'), c("summary_pl"), F.lit('"}'),
    )


def responses_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw model responses in ten shapes (ok, fenced, irrelevant,
    garbage, missing / extra keys, null material, array, string amount,
    padding, trailing text)."""
    f1 = signals_table(spark, sf_dir)
    c = F.col
    variant = (c("o1") * 7 + c("o2")) % 10
    mat = F.concat(F.lit('"'), c("material"), F.lit('"'))
    amt = F.coalesce(c("amount").cast("int").cast("string"), F.lit("null"))
    ok_body = _body(mat, amt)
    raw = (F.when(variant == 0, F.concat(F.lit('```json\n{"not_relevant": false, '), ok_body, F.lit("\n```")))
           .when(variant == 1, F.lit('{"not_relevant": true, "material": null}'))
           .when(variant == 2, F.lit("przepraszam, brak danych"))
           .when(variant == 3, F.lit('{"not_relevant": false, "material": "PE"}'))
           .when(variant == 4, F.concat(F.lit('{"not_relevant": false, "extra": 1, '), ok_body))
           .when(variant == 5, F.concat(F.lit('{"not_relevant": false, '), _body(F.lit("null"), amt)))
           .when(variant == 6, F.lit("[1]"))
           .when(variant == 7, F.concat(F.lit('{"not_relevant": false, '), _body(mat, F.lit('"35"'))))
           .when(variant == 8, F.concat(F.lit("  {"), ok_body, F.lit(" ")))
           .otherwise(F.concat(F.lit('{"not_relevant": false, '), ok_body, F.lit(" koniec"))))
    return f1.select(*ORDER_COLS, variant.alias("variant"), raw.alias("raw_output"))


def quotes_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """commodity quotes, one close per event."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select(F.col("event_type").alias("ticker"), "ts", F.col("value").alias("close"))
