"""Dashboard marts: history view, KPIs, material list, CSV export, JSON
rendering and latest commodity quotes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from ..schemas import SIGNAL_FIELDS
from .store import KEY, key_complete


def signal_history(signals: DataFrame, material: str = K.ALL_MATERIALS,
                   columns: list[str] = K.HISTORY_COLUMNS) -> DataFrame:
    """Optional material filter (the "all" sentinel means none) and the
    ten on-screen columns."""
    df = signals if material == K.ALL_MATERIALS else signals.where(F.col("material") == material)
    return df.select(*columns)


def filtered_signals(signals: DataFrame, material: str = K.ALL_MATERIALS) -> DataFrame:
    """The filtered set behind the history view, with every column (what
    the CSV export carries)."""
    return signals if material == K.ALL_MATERIALS else signals.where(F.col("material") == material)


def signal_kpis(signals: DataFrame) -> DataFrame:
    """Total, rises, cuts (holds count only in the total); 0 on an
    empty table.  One global aggregate with map-side partials."""
    return signals.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("change_type") == K.RISE).alias("rises"),
        F.count_if(F.col("change_type") == K.CUT).alias("cuts"),
    )


def distinct_materials(signals: DataFrame) -> DataFrame:
    """Non-NULL materials, ascending in code-point order."""
    return (signals.where(F.col("material").isNotNull()).select("material")
            .distinct().orderBy("material"))


# CSV dialect of the export: header, no index, quotes doubled inside quoted
# fields, NULL and '' both written as nothing, UTF-8.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "emptyValue": "",
               "nullValue": "", "encoding": "UTF-8", "multiLine": "true"}


def write_csv(df: DataFrame, path: str) -> None:
    """O37 sink: all columns of the filtered set."""
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).options(**CSV_OPTIONS).csv(path)


def signals_json(signals: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Each signal rendered as a JSON object with every field, NULLs
    written as ``null``."""
    fields = [f.name for f in SIGNAL_FIELDS] + (["extracted_on"] if "extracted_on" in signals.columns else [])
    cols = [F.col(f) for f in fields]
    if "amount_text" in signals.columns:  # the amount as the response wrote it (35, not 35.0)
        amount = F.coalesce(F.try_parse_json("amount_text"), F.col("amount").cast("variant")).alias("amount")
        cols = [amount if f == "amount" else F.col(f) for f in fields]
    js = F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
    return signals.select(*(keep or []), js.alias("signal_json"))


def latest_quotes(quotes: DataFrame, as_of=None, days: int = K.QUOTE_WINDOW_DAYS) -> DataFrame:
    """Last close per ticker within the trailing ``days`` calendar days,
    rounded to 2; tickers without a quote in the window are omitted.

    ``as_of`` defaults to the newest quote in the table, evaluated once as a
    scalar subquery.  ``max_by`` aggregates with map-side partials, so a
    ticker with most of the rows is no hot spot.
    """
    end = F.lit(as_of).cast("timestamp_ntz") if as_of is not None else quotes.agg(F.max("ts")).scalar()
    window = (F.col("ts") >= end - F.make_dt_interval(F.lit(days))) & (F.col("ts") <= end)
    return (quotes.where(window).groupBy("ticker")
            .agg(F.round(F.max(F.struct("ts", "close"))["close"], 2).alias("close")))


def _outcomes() -> list[Column]:
    c = F.col("status")
    return [
        F.count(F.lit(1)).alias("items_read"),
        F.count_if(c == "ok").alias("ok"),
        F.count_if(c == "irrelevant").alias("irrelevant"),
        F.count_if(c == "error").alias("errors"),
        F.count_if(c == "rejected").alias("rejected"),
    ]


def observe_outcomes(parsed: DataFrame) -> tuple[DataFrame, Observation]:
    """O27 as a by-product: ``parsed``, whose next action (one that reads every row in its last stage, such as a
    write) also counts the outcomes."""
    seen = Observation()
    return parsed.observe(seen, *_outcomes()), seen


def observed_counters(spark: SparkSession, seen: Observation, new_signals: int) -> DataFrame:
    """O27 from what a write has observed: the row that ``run_counters`` gives, without reading anything."""
    counts = {c: seen.get.get(c) or 0 for c in ("items_read", "ok", "irrelevant", "errors", "rejected")}
    counts |= {"new_signals": new_signals, "duplicates": counts["ok"] - new_signals}
    return spark.range(1, numPartitions=1).select(*[F.lit(n).cast("bigint").alias(c) for c, n in counts.items()])


def run_counters(parsed: DataFrame, new_rows: DataFrame | None = None) -> DataFrame:
    """Counters of one run - items read, outcome of parsing, signals
    new to the store and the rest (duplicates).

    With the rows that were stored, they are counted in a scalar subquery.
    Without (nothing stored before), new signals follow from the same single
    pass: ``ok`` rows with an open key, plus distinct complete keys.
    """
    ok, parts = F.col("status") == "ok", _outcomes()
    if new_rows is not None:
        out = parsed.agg(*parts).withColumn("new_signals", new_rows.agg(F.count(F.lit(1))).scalar())
    else:
        complete = key_complete()
        key = F.when(ok & complete, F.struct(*KEY))
        out = parsed.agg(*parts, (F.count_if(ok & ~complete & F.col("material").isNotNull())
                                  + F.count_distinct(key)).alias("new_signals"))
    return out.withColumn("duplicates", F.col("ok") - F.col("new_signals"))
