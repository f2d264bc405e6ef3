"""Mixing sources to target weights, with DataFrame operations only.

Sizes are words.  Sources in code point order (null last) weigh 1, 2, 3, 1, 2,
3, ...; their targets share the whole size by weight, but stop at ``cap`` times
the source's own size, and the excess is shared again by weight until no target
is above its stop.  A source's repetition rate is target / size; each document
is taken floor(rate) times, and once more with the rate's fraction as probability:
documents of a source stand in the order of u, a number in [0, 1) from a hash of
their id and text, and the extra copies go to the first of them until they hold the
words that the whole copies leave open.  The document in which these words end gets
its copy if a second number of its hash is below the share of it that is left, so a
source's words are its target in expectation and differ from it by less than one
document.

Sizes are summed per source before the shuffle.  The sources' order comes from a
range sort, not from a window in one task; every round of sharing is one
aggregate, of which the driver sees one row.  Where the extra copies of a source end
is found in sums over ``BINS`` ranges of u, which are aggregated before the shuffle,
and then in the one range in which they end.  The per-source rates join the
documents as Spark plans it (a broadcast below its threshold, else a shuffle
whose hot source AQE splits).

Defined results: a null or empty text has size 0 and is taken as often as its
rate says, which adds no words; a source without words has target and rate 0;
rows that repeat (id and text) decide alike; other columns are kept by ``mixed_documents`` and
ignored by ``mix_sources``; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ids import assign_ids
from .shared import materialize, named, SPACE_WORD

CAP = 3
WEIGHTS = (1, 2, 3)
SEED = 17
BINS = 1 << 16


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(SPACE_WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, source_size, target, rate) from rows of (source, size)."""
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    # null last; the flag orders before the name
    ranked = assign_ids(sums.withColumn("no_name", F.col("source").isNull()), ["no_name", "source"], base=-1, id_col="pos")
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod("pos", F.lit(len(weights))).cast("int") + 1)
    table = materialize(ranked.select("source", "source_size", weight.alias("w")), "sources")
    whole = table.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0     # words per unit of weight
    while True:
        stopped = F.lit(level) * F.col("w") > F.col("source_size") * cap
        row = table.agg(F.sum(F.when(stopped, F.col("source_size") * cap)).alias("given"),
                        F.sum(F.when(~stopped, F.col("w"))).alias("w")).first()
        if not row["w"]:
            break
        new = (whole - (row["given"] or 0)) / row["w"]
        if new <= level:
            break
        level = new
    target = F.least(F.lit(level) * F.col("w"), (F.col("source_size") * cap).cast("double"))
    rate = F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(F.lit(0.0))
    return table.select("source", "source_size", target.alias("target"), rate.alias("rate"))


def draws(doc_id: Column, text: Column, seed: int = SEED) -> list[Column]:
    """u and v: numbers in [0, 1) from twice 52 bits of a hash of id and text."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), doc_id.cast("string"), text))
    part = lambda at: F.conv(F.substring(digest, at, 13), 16, 10).cast("double") / F.lit(float(1 << 52))
    return [part(1).alias("u"), part(14).alias("v")]


def _bin(u: Column) -> Column:
    return F.floor(u * BINS).cast("int")


def last_draws(sized: DataFrame, rates: DataFrame) -> DataFrame:
    """Per source with extra copies: its_source, the bin of u in which they end, and the last u in it that gets one (null:
    none), from rows of (source, size, u, v)."""
    its = rates.select(F.col("source").alias("its_source"), (F.col("target") - F.floor("rate") * F.col("source_size")).alias("open"))
    worded = sized.where("size > 0").withColumn("bin", _bin(F.col("u")))
    before = lambda col, by: F.coalesce(F.sum(col).over(
        Window.partitionBy("source").orderBy(by).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # At most BINS rows a source.
    bins = worded.groupBy("source", "bin").agg(F.sum("size").alias("words")).withColumn("before", before("words", "bin"))
    ends = bins.join(its, F.col("source").eqNullSafe(F.col("its_source"))).where("before < open")
    ends = ends.groupBy("its_source").agg(F.max("bin").alias("end_bin"), F.max_by("before", "bin").alias("before"),
                                          F.first("open").alias("open"))
    ends = materialize(ends, "ends")
    # One bin of each source, equal draws as one row.
    drawn = worded.join(ends, F.col("source").eqNullSafe(F.col("its_source")) & (F.col("bin") == F.col("end_bin")))
    drawn = drawn.groupBy("source", "u").agg(F.sum("size").alias("words"), F.min("v").alias("v"), F.first("before").alias("start"),
                                             F.first("open").alias("open"))
    mark = F.col("v") * F.col("words") + (F.col("start") + before("words", "u")).cast("double")
    last = drawn.withColumn("mark", mark).where("mark < open").groupBy("source").agg(F.max("u").alias("last"))
    return ends.select("its_source", "end_bin").join(last, F.col("its_source").eqNullSafe(F.col("source")), "left").drop("source")


def _taken(rows: DataFrame, sized: DataFrame) -> DataFrame:
    """rows with source and u, plus source_size, target and copies; ``sized``: a written table of (source, size, u, v)."""
    rates = materialize(source_targets(sized), "rates")
    ends = last_draws(sized, rates)
    rates = materialize(rates.join(ends, F.col("source").eqNullSafe(F.col("its_source")), "left").drop("its_source")
                        .withColumnRenamed("source", "its_source"), "draws")
    joined = rows.join(rates, F.col("source").eqNullSafe(F.col("its_source"))).drop("its_source")
    bin_ = _bin(F.col("u"))
    extra = (bin_ < F.col("end_bin")) | ((bin_ == F.col("end_bin")) & (F.col("u") <= F.col("last")))
    return joined.withColumn("copies", (F.floor("rate") + F.coalesce(extra, F.lit(False)).cast("int")).cast("long"))


def mix_sources(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
                seed: int = SEED) -> DataFrame:
    """Per row: doc_id, source, size, source_size, target (of its source), copies and taken (size times copies)."""
    rows = materialize(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
                                   word_count(F.col(text)).alias("size"),
                                   *draws(F.col(doc_id), F.col(text), seed)), "sizes")
    out = _taken(rows, rows)
    return out.select("doc_id", "source", "size", "source_size", "target", "copies",
                      (F.col("size") * F.col("copies")).alias("taken"))


def mixed_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
                    seed: int = SEED) -> DataFrame:
    """The mix itself: all columns of ``docs``, once per copy, plus copy (1, 2, ...; replaces a column of that name, in upper or lower case)."""
    drawn = draws(F.col(doc_id), F.col(text), seed)
    sized = materialize(docs.select(F.col(source).alias("source"), word_count(F.col(text)).alias("size"), *drawn), "sizes")
    rows = docs.select(F.struct(*[named(c) for c in docs.columns if c.lower() != "copy"]).alias("row"), F.col(source).alias("source"), drawn[0])
    taken = _taken(rows, sized).where("copies > 0")
    return taken.select("row.*", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))


def op4(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


# Sources sorted by 3 * size / weight: those that stop are a prefix, and the level of the first that does not is final.
OP4_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(concat_ws('|', '17', doc_id::VARCHAR, text)), 1, 13))::BIGINT::DOUBLE / 4503599627370496 AS u,
         ('0x' || substr(md5(concat_ws('|', '17', doc_id::VARCHAR, text)), 14, 13))::BIGINT::DOUBLE / 4503599627370496 AS v
  FROM documents),
sums AS (
  SELECT source, sum(size)::BIGINT AS s, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w
  FROM sized GROUP BY source),
levels AS (
  SELECT *, ((sum(s) OVER () - coalesce(sum(3 * s) OVER (ORDER BY 3 * s / w::DOUBLE, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / sum(w) OVER (ORDER BY 3 * s / w::DOUBLE, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE) AS level
  FROM sums),
chosen AS (SELECT level FROM levels WHERE NOT level * w > 3 * s ORDER BY 3 * s / w::DOUBLE, source NULLS LAST LIMIT 1),
rates AS (
  SELECT source, s, least(c.level * w, 3 * s::DOUBLE) AS target,
         CASE WHEN s > 0 THEN least(c.level * w, 3 * s::DOUBLE) / s ELSE 0 END AS rate
  FROM levels, chosen c),
drawn AS (SELECT source, u, sum(size) AS g, min(v) AS v FROM sized WHERE size > 0 GROUP BY source, u),
marks AS (
  SELECT source, u, v * g + coalesce(sum(g) OVER (PARTITION BY source ORDER BY u ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS mark
  FROM drawn),
ends AS (
  SELECT r.source, max(u) AS last FROM rates r JOIN marks m ON m.source IS NOT DISTINCT FROM r.source
  WHERE mark < target - floor(rate) * s GROUP BY r.source)
SELECT doc_id, size, s AS source_size, target,
       (size * (floor(rate) + CASE WHEN u <= last THEN 1 ELSE 0 END))::BIGINT AS taken
FROM sized JOIN rates r ON sized.source IS NOT DISTINCT FROM r.source
LEFT JOIN ends e ON e.source IS NOT DISTINCT FROM r.source
"""
