"""Token-usage accounting: capture from raw responses, summary, totals,
chart series and the most-recent log.

Every aggregation here is keyed by low-cardinality labels (process, model,
token kind), so Spark's partial (map-side) hash aggregation collapses even a
process holding most rows to one buffer per task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K


def capture_usage(responses: DataFrame, run_ts: Column | str | None = None,
                  default_model: str = K.DEFAULT_MODEL) -> DataFrame:
    """One usage row per response that reports usage.

    Rules: no usage -> no row; NULL counts -> 0; NULL or empty model -> the
    default model; total = input + output + reasoning (reasoning is counted
    on top of the completion tokens, as logged).  Usage is captured from the
    raw responses, before any parsing, so irrelevant and failed responses
    still cost.  ``run_ts`` is the logging time of the run (a parameter, so a
    rerun reproduces the same rows); it defaults to ``current_timestamp``.
    """
    ts = (F.current_timestamp() if run_ts is None
          else (F.lit(run_ts) if isinstance(run_ts, str) else run_ts))
    present = F.col("usage_present") if "usage_present" in responses.columns else F.lit(True)
    inp = F.coalesce(F.col("prompt_tokens").cast("bigint"), F.lit(0).cast("bigint"))
    out = F.coalesce(F.col("completion_tokens").cast("bigint"), F.lit(0).cast("bigint"))
    rea = F.coalesce(F.col("reasoning_tokens").cast("bigint"), F.lit(0).cast("bigint"))
    response_cols = {"raw_output", "model", "prompt_tokens", "completion_tokens", "reasoning_tokens",
                     "usage_present", "process"}
    keys = [c for c in responses.columns if c not in response_cols]  # whatever identifies the item
    return responses.where(present).select(
        *keys,
        F.col("process"),
        F.coalesce(F.nullif(F.col("model"), F.lit("")), F.lit(default_model)).alias("model"),
        inp.alias("input_tokens"), out.alias("output_tokens"), rea.alias("reasoning_tokens"),
        (inp + out + rea).alias("total_tokens"),
        ts.cast("timestamp_ntz").alias("logged_at"),
    )


def as_usage_log(df: DataFrame) -> DataFrame:
    """Normalise an (id, process, model, counts, logged_at) table to the
    stored log layout, computing the total the way it is logged."""
    inp = F.coalesce(F.col("input_tokens"), F.lit(0)).cast("bigint")
    out = F.coalesce(F.col("output_tokens"), F.lit(0)).cast("bigint")
    rea = F.coalesce(F.col("reasoning_tokens"), F.lit(0)).cast("bigint")
    return df.select(
        "id", "process", "model", inp.alias("input_tokens"), out.alias("output_tokens"),
        rea.alias("reasoning_tokens"), (inp + out + rea).alias("total_tokens"), "logged_at")


def usage_summary(log: DataFrame) -> DataFrame:
    """Calls and token sums per (process, model), largest total first."""
    return (log.groupBy("process", "model")
            .agg(F.count(F.lit(1)).alias("wywolania"),
                 F.sum("input_tokens").alias("suma_wejsciowych"),
                 F.sum("output_tokens").alias("suma_wyjsciowych"),
                 F.sum("reasoning_tokens").alias("suma_myslenia"),
                 F.sum("total_tokens").alias("suma_calkowita"))
            .orderBy(F.desc("suma_calkowita")))


def usage_totals(summary: DataFrame) -> DataFrame:
    """Grand totals over the summary (0 on an empty summary)."""
    zero = F.lit(0).cast("bigint")
    return summary.agg(
        F.coalesce(F.sum("wywolania"), zero).cast("bigint").alias("total_calls"),
        F.coalesce(F.sum("suma_wejsciowych"), zero).cast("bigint").alias("total_input"),
        F.coalesce(F.sum("suma_wyjsciowych"), zero).cast("bigint").alias("total_output"),
        F.coalesce(F.sum("suma_myslenia"), zero).cast("bigint").alias("total_reasoning"),
    )


def usage_report(summary: DataFrame) -> DataFrame:
    """The summary with display column names."""
    return summary.withColumnsRenamed(K.USAGE_DISPLAY_NAMES)


def usage_melt(summary: DataFrame) -> DataFrame:
    """O25 (long form): one row per (process, model, token kind).

    Only ``process`` is kept as identifier, so two models of one process
    give repeated (process, typ) rows; labels come from a literal map and an
    unmapped kind would become NULL.
    """
    kinds = list(K.USAGE_KIND_LABELS)
    long = summary.unpivot(["process"], kinds, "typ", "tokeny")
    labels = F.create_map(*[F.lit(x) for kv in K.USAGE_KIND_LABELS.items() for x in kv])
    return long.select("process", labels[F.col("typ")].alias("typ"), "tokeny")


def usage_series(summary: DataFrame) -> DataFrame:
    """O25 (chart series): stacked-bar heights per (process, token kind)."""
    return (usage_melt(summary).groupBy("process", "typ")
            .agg(F.sum("tokeny").alias("tokeny")))


def usage_log_topk(log: DataFrame, limit: int = K.USAGE_LOG_LIMIT) -> DataFrame:
    """Most recent log rows.  The id tie-break makes equal timestamps
    deterministic; the plan is a TakeOrderedAndProject (per-partition top-k
    merged on one task, bounded by ``limit``)."""
    return log.orderBy(F.desc("logged_at"), F.desc("id")).limit(limit)
