"""Corpus pipeline: quality rules, near-dedup, decontamination, secret redaction, mixing.

Every stage gets what its predecessor kept, written as Parquet and read again;
``run`` does this in the session's shared checkpoint folder.  All stages but the
last return the columns they got, whatever their names.  A null text is an empty
one, which the quality rules reject; a null source is a source of its own; of rows
that repeat a doc_id each is a document, but exact copies end in near-dedup; ties
are broken by hashes of the text, so reruns agree; empty tables give empty tables.

There is no SQL for SimHash fingerprints, so
the query is tested against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketsignals.llm import decontaminate, mixing, quality_rules, secrets, simhash
from marketsignals.llm.shared import materialize, named, text_key


def _whole(docs: DataFrame):
    """A row's columns as one struct, so that helper columns cannot clash with them."""
    return F.struct(*[named(c) for c in docs.columns]).alias("row")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy of the rule ledger passes."""
    rows = quality_rules.ledger(docs.select(_whole(docs), F.col("text").alias("text")))
    return rows.where(quality_rules.passes()).select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component, that with the smallest doc_id."""
    return simhash.keep_one(docs)


def clean_of_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.decontaminate(docs, bench).where("contaminated").select("k1", "k2").distinct()
    rows = docs.select(_whole(docs), *text_key("text"))
    return rows.join(found, ["k1", "k2"], "left_anti").select("row.*")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, found secrets replaced by a mark; n_chars follows the text."""
    found = (secrets.secret_spans(docs).where(F.size("spans") > 0)
             .groupBy("k1", "k2").agg(F.first("spans").alias("spans")))   # equal texts have equal spans
    rows = docs.select(_whole(docs), *text_key("text")).join(found, ["k1", "k2"], "left")
    hit = F.col("spans").isNotNull()
    rows = rows.withColumn("clean", F.when(hit, secrets.redact(F.col("row.text"), F.col("spans"))).otherwise(F.col("row.text")))
    new = {"text": F.col("clean"), "n_chars": F.when(hit, F.length("clean").cast("long")).otherwise(F.col("row.n_chars"))}
    return rows.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to their sources' target weights; adds copy (1, 2, ...)."""
    return mixing.mixed_documents(docs)


STAGES = [
    ("quality_rules", quality),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", clean_of_benchmarks),
    ("secret_scans", redact_secrets),
    ("mix_sources", mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
