"""Queries over stored signals: scan, uniqueness, append."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import store as ST
from ..operators.batches import Attempt, BatchStore
from ..schemas import STORED_SIGNAL
from ..session import scratch_path
from ..sources import fixtures as FX
from .fixture_sql import with_fixtures
from .registry import query

SPLIT_TS = "1996-01-01 00:00:00"

# First writer per complete key; open-key rows always kept; NULL material rejected.
DEDUP_SQL = """dedup as (
  select * exclude (rn) from (
    select *, row_number() over (partition by material, source_company, effective_date, amount
                                 order by o1, o2, o3, o4, o5) as rn
    from f1 where material is not null)
  where rn = 1 or source_company is null or effective_date is null or amount is null or isnan(amount))"""


@query("signals_all", with_fixtures("select * from f1", "f1"))
def q_signals_all(spark, sf_dir):
    return ST.scan_signals(FX.signals_table(spark, sf_dir), then=FX.ORDER_COLS)


@query("signals_by_material", with_fixtures("select * from f1 where material = 'tektura'", "f1"))
def q_signals_by_material(spark, sf_dir):
    return ST.scan_signals(FX.signals_table(spark, sf_dir), "tektura", FX.ORDER_COLS)


@query("dedup_batch", with_fixtures(f"with {DEDUP_SQL} select * from dedup", "f1"))
def q_dedup_batch(spark, sf_dir):
    return ST.dedup_batch(FX.signals_table(spark, sf_dir, spread=True), FX.ORDER_COLS)


@query("dedup_against_history", with_fixtures(f"""
with hist as (select * from f1 where o5 < timestamp '{SPLIT_TS}'),
batch as (select * from f1 where o5 >= timestamp '{SPLIT_TS}'),
ranked as (
  select *, row_number() over (partition by material, source_company, effective_date, amount
                               order by o1, o2, o3, o4, o5) as rn
  from batch where material is not null)
select * exclude (rn) from ranked r
where source_company is null or effective_date is null or amount is null or isnan(amount)
   or (rn = 1 and not exists (
        select 1 from hist h where h.material = r.material and h.source_company = r.source_company
          and h.effective_date = r.effective_date and h.amount = r.amount))""", "f1"))
def q_dedup_against_history(spark, sf_dir):
    split = F.lit(SPLIT_TS).cast("timestamp_ntz")
    history = FX.signals_table(spark, sf_dir).where(F.col("o5") < split)
    batch = FX.signals_table(spark, sf_dir, spread=True).where(F.col("o5") >= split)
    return ST.new_signals(batch, history, FX.ORDER_COLS)


@query("append_signals", with_fixtures(f"""with {DEDUP_SQL}
select cast(row_number() over (order by o1, o2, o3, o4, o5) as bigint) as id, material, material_detail,
  change_type, amount, unit, currency, region, effective_date, announcement_date, source_company, source_url,
  confidence, summary_pl, extracted_on, cast(null as varchar) as amount_text, cast(1 as bigint) as batch_id
from dedup""", "f1"))
def q_append_signals(spark, sf_dir):
    rows = ST.dedup_batch(FX.signals_table(spark, sf_dir, spread=True), FX.ORDER_COLS)
    store, attempt = BatchStore(spark, scratch_path(spark, "signals")), Attempt(1)
    ST.append_signals(store, attempt, rows, FX.ORDER_COLS)
    store.commit(attempt)
    return store.read("price_signals", STORED_SIGNAL)
