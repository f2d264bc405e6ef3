"""Dashboard queries."""

from __future__ import annotations

from ..operators import marts as M
from ..session import scratch_path
from ..sources import fixtures as FX
from .fixture_sql import with_fixtures
from .registry import query


@query("signal_history", with_fixtures(
    "select announcement_date, material, material_detail, change_type, amount, unit, region, "
    "source_company, confidence, summary_pl from f1", "f1"))
def q_signal_history(spark, sf_dir):
    return M.signal_history(FX.signals_table(spark, sf_dir))


@query("signal_history_material", with_fixtures(
    "select announcement_date, material, material_detail, change_type, amount, unit, region, "
    "source_company, confidence, summary_pl from f1 where material = 'PET'", "f1"))
def q_signal_history_material(spark, sf_dir):
    return M.signal_history(FX.signals_table(spark, sf_dir), "PET")


@query("signal_kpis", with_fixtures(
    "select count(*) as total, count(*) filter (where change_type = 'podwyzka') as rises, "
    "count(*) filter (where change_type = 'obnizka') as cuts from f1", "f1"))
def q_signal_kpis(spark, sf_dir):
    return M.signal_kpis(FX.signals_table(spark, sf_dir))


@query("distinct_materials", with_fixtures(
    "select distinct material from f1 where material is not null", "f1"))
def q_distinct_materials(spark, sf_dir):
    return M.distinct_materials(FX.signals_table(spark, sf_dir))


@query("csv_roundtrip", with_fixtures(
    "select o1, o2, o3, o4, o5, nullif(material, '') as material, nullif(material_detail, '') as material_detail, "
    "change_type, amount, unit, currency, region, effective_date, announcement_date, source_company, source_url, "
    "confidence, summary_pl, extracted_on from f1", "f1"))
def q_csv_roundtrip(spark, sf_dir):
    f1 = M.filtered_signals(FX.signals_table(spark, sf_dir))
    path = scratch_path(spark, "export-csv")
    M.write_csv(f1, path)
    return M.read_csv(spark, path, f1.schema)


@query("signals_json", with_fixtures(
    "select o1, o2, o3, o4, o5, to_json(struct_pack(material := material, material_detail := material_detail, "
    "change_type := change_type, amount := amount, unit := unit, currency := currency, region := region, "
    "effective_date := effective_date, announcement_date := announcement_date, source_company := source_company, "
    "confidence := confidence, summary_pl := summary_pl, extracted_on := extracted_on)) as signal_json from f1", "f1"))
def q_signals_json(spark, sf_dir):
    return M.signals_json(FX.signals_table(spark, sf_dir), keep=FX.ORDER_COLS)


@query("latest_quotes", with_fixtures(
    "select ticker, round(arg_max(close, ts), 2) as close from f6 "
    "where ts >= (select max(ts) from f6) - interval 5 day and ts <= (select max(ts) from f6) group by ticker", "f6"))
def q_latest_quotes(spark, sf_dir):
    return M.latest_quotes(FX.quotes_table(spark, sf_dir))
