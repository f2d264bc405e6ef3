"""Contiguous, order-preserving row ids without a single-task window.

A global ``row_number()`` over an ORDER BY without PARTITION BY moves every
row to one task.  Instead: range-partition on the order, sort inside each
partition, tag rows with ``monotonically_increasing_id`` (partition index in
the upper 31 bits, position in the lower 33 — documented behaviour), count
rows per partition, turn the counts into offsets (one row per partition, so
the offsets table is bounded by the partition count and safe to broadcast),
and add offset + position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, without_shuffle_files

_LOW_BITS = (1 << 33) - 1


def assign_ids(df: DataFrame, order_cols: list[str], base: Column | int = 0,
               id_col: str = "id", num_partitions: int | None = None,
               checkpoint: bool = True, folder: str | None = None) -> DataFrame:
    """Add ``id_col`` = base + 1 + rank of the row in ``order_cols`` order.

    ``order_cols`` must identify rows uniquely (ties would make the order
    within a partition arbitrary).  The tagged rows are checkpointed to the
    shared checkpoint folder so the two passes (counts, then ids) read the
    same rows even if executors are lost and tasks re-run.  With ``folder``
    they are written there as Parquet instead, which is smaller than a
    checkpoint of rows, and their shuffles' files go at once; the caller
    removes the folder when the rows with ids are written.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tagged = (df.repartitionByRange(n, *order_cols)
              .sortWithinPartitions(*order_cols)
              .withColumn("_mid", F.monotonically_increasing_id()))
    tagged = (tagged.withColumn("_part", F.shiftright("_mid", 33).cast("int"))
              .withColumn("_pos", F.col("_mid").bitwiseAND(F.lit(_LOW_BITS))))
    if folder:
        with without_shuffle_files(spark):
            tagged.write.parquet(folder)
        tagged = spark.read.schema(tagged.schema).parquet(folder)
    elif checkpoint:
        tagged = tagged.checkpoint(eager=True)
    counts = tagged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    base_col = base if isinstance(base, Column) else F.lit(base)
    return (tagged.join(F.broadcast(offsets), "_part")
            .withColumn(id_col, (base_col + F.col("_off") + F.col("_pos") + 1).cast("bigint"))
            .drop("_mid", "_part", "_pos", "_off"))
