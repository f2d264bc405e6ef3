"""Small helpers: intermediate tables, text keys and fixed-size bitmaps."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

# The whitespace that separates words where a contract says [^\x20\x09-\x0D]+.
SPACE_WORD = r"[^\x20\x09-\x0D]+"
SPACE_RUN = r"[\x20\x09-\x0D]+"

BITMAP_BITS = 27


def materialize(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs its running tasks, not the steps
    before, and every reader sees the same rows.  ``by`` names a column whose
    few values get a folder each.  ``discard`` deletes the table.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.folder = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``materialize`` wrote, once all that reads them is written itself."""
    for table in tables:
        jvm, conf = table.sparkSession.sparkContext._jvm, table.sparkSession.sparkContext._jsc.hadoopConfiguration()
        folder = jvm.org.apache.hadoop.fs.Path(table.folder)
        folder.getFileSystem(conf).delete(folder, True)


def named(column: str) -> Column:
    """A column by its whole name, dots and backticks included."""
    return F.col("`" + column.replace("`", "``") + "`")


def bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, also where a lambda refers to it again and again."""
    return F.element_at(F.transform(F.array(value), use), 1)


def thinned(rows: DataFrame, cols: list[str], want: int) -> DataFrame:
    """About ``want`` of the rows of a written table, by a hash of ``cols``: a filter, so no task gets what all have kept."""
    share = min(1.0, want / max(1, rows.count()))
    return rows.where(F.pmod(F.xxhash64(*cols), F.lit(1 << 31)) < F.lit(int(share * (1 << 31))))


def text_key(text: Column | str) -> list[Column]:
    """128 bits that stand for a text; null and empty texts share one."""
    whole = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    return [F.xxhash64(whole).alias("k1"), F.xxhash64(F.lit(7), whole).alias("k2")]


def hash_bitmap(spark: SparkSession, hashes: DataFrame, col: str, bits: int = BITMAP_BITS) -> np.ndarray:
    """A bitmap of the top ``bits`` bits of the hashes: always 2**bits / 8 bytes (16 MB), whatever the input's size.

    A filter, not a decision: what passes it is checked again by a join or a
    grouping.  When it fills up, more rows pass and the results stay the same.
    """
    at = F.shiftrightunsigned(F.col(col), 64 - bits) + F.lit(1)
    parts = (hashes.select(at.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("bucket"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits")))
    out = np.zeros((1 << bits) // 8, np.uint8)
    for row in parts.collect():     # at most 2**bits / 32768 rows of 4 KB
        i = (row["bucket"] - 1) * 4096
        out[i:i + 4096] = np.frombuffer(bytes(row["bits"]), np.uint8)
    return out


def in_bitmap(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bits = int(len(bitmap) * 8).bit_length() - 1
    at = (hashes >> np.uint64(64 - bits)).astype(np.int64)
    return ((bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(bool)
