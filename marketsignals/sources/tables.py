"""Access to the landed input tables (one Parquet dataset per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Plain Parquet scan; projections and filters applied downstream are
    pushed into the scan by Catalyst (ReadSchema / PushedFilters)."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(table_path(sf_dir, name))
