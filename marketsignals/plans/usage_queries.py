"""Queries over token usage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import usage as U
from ..sources import fixtures as FX
from .fixture_sql import with_fixtures
from .registry import query

RUN_TS = "2026-01-01 06:00:00"

# The stored usage log: F3 with the total computed as logged.
LOG_SQL = """usage_log as (
  select id, process, model, coalesce(input_tokens, 0) as input_tokens, coalesce(output_tokens, 0) as output_tokens,
    coalesce(reasoning_tokens, 0) as reasoning_tokens,
    coalesce(input_tokens, 0) + coalesce(output_tokens, 0) + coalesce(reasoning_tokens, 0) as total_tokens, logged_at
  from f3)"""

SUMMARY_SQL = LOG_SQL + """, summary as (
  select process, model, cast(count(*) as bigint) as wywolania,
    cast(sum(input_tokens) as bigint) as suma_wejsciowych, cast(sum(output_tokens) as bigint) as suma_wyjsciowych,
    cast(sum(reasoning_tokens) as bigint) as suma_myslenia, cast(sum(total_tokens) as bigint) as suma_calkowita
  from usage_log group by process, model)"""


def usage_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return U.as_usage_log(FX.usage_table(spark, sf_dir))


def responses_with_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F5 responses with a usage block: some without usage, some with NULL
    counts, empty or missing model names and reasoning tokens."""
    r = FX.responses_table(spark, sf_dir)
    v = F.col("variant")
    return r.select(
        *FX.ORDER_COLS, "raw_output",
        F.lit("ekstrakcja_automatyczna").alias("process"),
        F.when(v == 2, "").when(v == 3, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("m"), (F.col("o4") % 3).cast("string"))).alias("model"),
        F.when(v == 6, F.lit(None).cast("bigint")).otherwise(F.col("o3") % 900 + 100).alias("prompt_tokens"),
        F.length("raw_output").cast("bigint").alias("completion_tokens"),
        F.when(v == 9, F.col("o2")).otherwise(0).cast("bigint").alias("reasoning_tokens"),
        (F.col("o3") % 13 != 0).alias("usage_present"),
    )


RESPONSES_USAGE_SQL = """responses as (
  select o1, o2, o3, o4, o5, raw_output, 'ekstrakcja_automatyczna' as process,
    case when variant = 2 then '' when variant = 3 then null else 'm' || cast(o4 % 3 as string) end as model,
    case when variant = 6 then null else o3 % 900 + 100 end as prompt_tokens,
    cast(length(raw_output) as bigint) as completion_tokens,
    cast(case when variant = 9 then o2 else 0 end as bigint) as reasoning_tokens,
    o3 % 13 <> 0 as usage_present
  from f5)"""


@query("usage_summary", with_fixtures(f"with {SUMMARY_SQL} select * from summary", "f3"))
def q_usage_summary(spark, sf_dir):
    return U.usage_summary(usage_log(spark, sf_dir))


@query("usage_totals", with_fixtures(f"""with {SUMMARY_SQL}
select cast(coalesce(sum(wywolania), 0) as bigint) as total_calls,
  cast(coalesce(sum(suma_wejsciowych), 0) as bigint) as total_input,
  cast(coalesce(sum(suma_wyjsciowych), 0) as bigint) as total_output,
  cast(coalesce(sum(suma_myslenia), 0) as bigint) as total_reasoning from summary""", "f3"))
def q_usage_totals(spark, sf_dir):
    return U.usage_totals(U.usage_summary(usage_log(spark, sf_dir)))


@query("usage_report", with_fixtures(f"""with {SUMMARY_SQL}
select process as proces, model, wywolania as "wywołania", suma_wejsciowych as "wejściowe",
  suma_wyjsciowych as "wyjściowe", suma_myslenia as "myślenie", suma_calkowita as razem from summary""", "f3"))
def q_usage_report(spark, sf_dir):
    return U.usage_report(U.usage_summary(usage_log(spark, sf_dir)))


_MELT_SQL = """melt as (
  select process, 'wejściowe' as typ, suma_wejsciowych as tokeny from summary
  union all select process, 'wyjściowe', suma_wyjsciowych from summary
  union all select process, 'myślenie', suma_myslenia from summary)"""


@query("usage_melt", with_fixtures(f"with {SUMMARY_SQL}, {_MELT_SQL} select * from melt", "f3"))
def q_usage_melt(spark, sf_dir):
    return U.usage_melt(U.usage_summary(usage_log(spark, sf_dir)))


@query("usage_series", with_fixtures(f"""with {SUMMARY_SQL}, {_MELT_SQL}
select process, typ, cast(sum(tokeny) as bigint) as tokeny from melt group by process, typ""", "f3"))
def q_usage_series(spark, sf_dir):
    return U.usage_series(U.usage_summary(usage_log(spark, sf_dir)))


@query("usage_log_topk", with_fixtures(f"""with {LOG_SQL}
select * from usage_log order by logged_at desc, id desc limit 100""", "f3"))
def q_usage_log_topk(spark, sf_dir):
    return U.usage_log_topk(usage_log(spark, sf_dir), 100)


@query("usage_capture", with_fixtures(f"""with {RESPONSES_USAGE_SQL}
select o1, o2, o3, o4, o5, process, coalesce(nullif(model, ''), 'openai/gpt-4o-mini') as model,
  coalesce(prompt_tokens, 0) as input_tokens, coalesce(completion_tokens, 0) as output_tokens,
  coalesce(reasoning_tokens, 0) as reasoning_tokens,
  coalesce(prompt_tokens, 0) + coalesce(completion_tokens, 0) + coalesce(reasoning_tokens, 0) as total_tokens,
  timestamp '{RUN_TS}' as logged_at
from responses where usage_present""", "f5"))
def q_usage_capture(spark, sf_dir):
    return U.capture_usage(responses_with_usage(spark, sf_dir), run_ts=F.lit(RUN_TS).cast("timestamp_ntz"))
