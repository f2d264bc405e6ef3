"""RSS feed files: scan (O01) and a writer for landing announcement items
as feeds.

A feed is one or more XML files under ``<root>/source=<name>/``; each file
holds ``<channel><item>…</item>…</channel>``.  Files of one source are read
in name order, items in document order, so a very large feed may be split
over many files and still keep one position sequence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import RSS_ITEM

ITEM_READ = {"rowTag": "item", "ignoreSurroundingSpaces": "false", "mode": "PERMISSIVE"}
XML_READ = {"rowTag": "channel", "ignoreSurroundingSpaces": "false", "mode": "PERMISSIVE"}


def write_feeds(items: DataFrame, path: str, files_per_source_hint: int | None = None) -> None:
    """Write (source, pos, title, summary, link, published) items as feed
    files.  Items are range-partitioned on (source, pos), so a source with a
    third of all rows is spread over several files (several tasks) whose
    part numbers follow feed order."""
    n = files_per_source_hint or int(items.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = items.select("source", "pos", "title", F.col("summary").alias("description"), "link",
                        F.col("published").alias("pubDate"))
    (rows.repartitionByRange(n, "source", "pos").sortWithinPartitions("source", "pos").drop("pos")
         .write.mode("overwrite").partitionBy("source").format("xml")
         .option("rootTag", "channel").option("rowTag", "item").save(path))


def scan_feeds(spark: SparkSession, path: str) -> DataFrame:
    """One row per feed entry: source, pos (0-based, per source),
    title, summary, link, published; absent fields become ''.

    The position is file offset + index in file.  Offsets come from per-file
    counts (one row per file), so no task ever sees a whole source.  An empty
    feed yields no rows.
    """
    schema = T.StructType([T.StructField("item", T.ArrayType(RSS_ITEM)),
                           T.StructField("source", T.StringType())])
    ch = (spark.read.format("xml").options(**XML_READ).schema(schema).load(path)
          .select("source", F.input_file_name().alias("_file"), F.posexplode("item").alias("_i", "it")))
    counts = ch.groupBy("source", "_file").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy("source").orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("source", "_file", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    e = lambda f: F.coalesce(F.col(f"it.{f}"), F.lit(""))
    return (ch.join(offsets, ["source", "_file"])
            .select("source", (F.col("_off") + F.col("_i")).cast("bigint").alias("pos"),
                    e("title").alias("title"), e("description").alias("summary"), e("link").alias("link"),
                    e("pubDate").alias("published")))


def stream_feeds(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """O01 as a stream: one row per entry of every feed file that lands below ``path``: source, file, title, summary,
    link, published; absent fields become ''.

    Each file is parsed once and entry by entry, so a large one is never a single row.  Batches add their entries'
    order with ``feed_order``.  Files should land under names that sort as they are to be read.
    """
    schema = T.StructType([*RSS_ITEM, T.StructField("source", T.StringType())])
    reader = spark.readStream.format("xml").options(**ITEM_READ).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    e = lambda f: F.coalesce(F.col(f), F.lit(""))
    return reader.load(path).select("source", F.col("_metadata.file_name").alias("file"), e("title").alias("title"),
                                    e("description").alias("summary"), e("link").alias("link"),
                                    e("pubDate").alias("published"))


FEED_ORDER = ["source_ord", "file", "ordinal"]


def feed_order(batch: DataFrame) -> DataFrame:
    """A micro-batch of ``stream_feeds`` with ``ordinal``, which rises within each file (a file is read by one task in
    document order).  Only its order counts: numbers have gaps."""
    return batch.withColumn("ordinal", F.monotonically_increasing_id())
