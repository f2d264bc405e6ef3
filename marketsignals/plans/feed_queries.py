"""Feed scan (O01) and the incremental run."""

from __future__ import annotations

from ..operators import store as ST
from ..schemas import STORED_SIGNAL
from ..session import scratch_path, shuffle_partitions
from ..sources import feeds as FD
from ..sources import fixtures as FX
from ..streaming.incremental import RunConfig, start_incremental
from .fixture_sql import with_fixtures
from .flagship import CONFIDENCE_SQL, FIRST_SQL, SUMMARY_SQL
from .registry import query

RUN_DATE = "2026-01-01"


@query("feed_scan", with_fixtures("""
select source, cast(row_number() over (partition by source order by pos) - 1 as bigint) as pos,
  coalesce(title, '') as title, coalesce(summary, '') as summary, coalesce(link, '') as link,
  coalesce(published, '') as published from f2""", "f2"))
def q_feed_scan(spark, sf_dir):
    path = scratch_path(spark, "feeds")
    FD.write_feeds(FX.items_table(spark, sf_dir), path)
    return FD.scan_feeds(spark, path)


_STORED_COLS = [c for c in STORED_SIGNAL.fieldNames() if c not in ("id", "batch_id")]


@query("incremental_run", with_fixtures(f"""
with ranked as (
  select *, row_number() over (partition by material, source_company, effective_date, amount
                               order by case o1 % 3 when 2 then 1 when 0 then 2 else 3 end, o1, o2, o3, o4, o5) as rn from f4)
select material, cast(null as varchar) as material_detail, change_type, amount, unit,
  case unit when 'EUR/t' then 'EUR' end as currency, region, effective_date, announcement_date,
  source_company, 'https://example.org/n/' || concat_ws('-', o1, o2, o3, o4) as source_url, {CONFIDENCE_SQL} as confidence,
  {SUMMARY_SQL} as summary_pl,
  '{RUN_DATE}' as extracted_on, cast(cast(amount as int) as varchar) as amount_text
from ranked where {FIRST_SQL}""", "f4"))
def q_incremental_run(spark, sf_dir):
    """The daily run from items and pages, in several micro-batches over the
    landed item files.  Files are dealt by the uniqueness key, so the stored
    set does not depend on the order in which the stream picks them up."""
    root = scratch_path(spark, "run")
    landing, pages = f"{root}/landing", f"{root}/pages"
    items, html = FX.announcement_items(spark, sf_dir)
    html.write.parquet(pages)
    n = shuffle_partitions(spark)
    items.repartition(n, *ST.KEY).drop(*ST.KEY).write.parquet(landing)
    cfg = RunConfig(root=root, order_cols=["source_ord", *FX.ORDER_COLS], run_date=RUN_DATE, pages=pages,
                    sources=FX.RUN_SOURCES, partitions=n)
    q = start_incremental(spark, landing, items.drop(*ST.KEY).schema, cfg, f"{root}/_checkpoint", files_per_batch=max(1, n // 3))
    q.awaitTermination()
    stored = cfg.store(spark).read("price_signals", STORED_SIGNAL)
    return stored.select(*_STORED_COLS)
