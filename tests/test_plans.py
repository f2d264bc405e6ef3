"""Plan-shape guards for the scale properties (see README, Scale design)."""

from pyspark.sql import functions as F

from marketsignals.functions import rules as R
from marketsignals.functions.rules import MATERIAL_TOKENS as MATERIALS
from marketsignals.functions.rules import rule_response
from marketsignals.operators import alerts as AL
from marketsignals.operators import extract as EX
from marketsignals.operators import items as IT
from marketsignals.operators import store as ST
from marketsignals.plans import QUERIES, load_all
from marketsignals.sources import fixtures as FX

SF = "/root/testdata/sf0.001"


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_parse_runs_once_even_under_a_status_filter(spark):
    parsed = EX.parse_responses(FX.responses_table(spark, SF), run_date="2026-01-01")
    plan = _optimized(EX.quarantine_of(parsed))
    assert plan.count("from_json") == 1


def test_uniqueness_aggregates_before_the_shuffle(spark):
    f1 = FX.signals_table(spark, SF)
    plan = _physical(ST.new_signals(f1, f1.limit(0), FX.ORDER_COLS))
    assert "partial_min" in plan  # map-side first-writer aggregate


def test_each_pattern_of_the_rules_stands_once(spark):
    """NULL for an empty match is decided on the bound match, not by a second pass of the regex."""
    texts = spark.read.schema("k long, text string").parquet(SF + "/events.parquet")
    plan = _optimized(texts.select(rule_response(F.col("text")).alias("r")))
    whole = {R.CHANGE_TOKEN: 1, R.PRICE: 2, R.REGION: 3, R.HEADER: 3, R.EFFECTIVE: 2, MATERIALS[0]: 4}
    assert {p: plan.count(p) for p in whole} == whole


def test_rules_are_compiled(spark):
    """Only the clauses are looked at in a ``transform``, which is interpreted, and no method is too long for the JIT."""
    texts = spark.read.schema("k long, text string").parquet(SF + "/events.parquet")
    df = EX.extract_responses(texts, "text", ["k"])
    assert _optimized(df).count("transform(") == 2
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    stages = debug.codegenStringSeq(df._jdf.queryExecution().executedPlan())
    assert max(stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())) < 8000


def test_steps_of_the_rules_agree_with_the_expression(spark):
    """As projections and as one expression, also for texts that hold the mark of clauses, and for keys named like steps."""
    texts = [None, "", "podwyżka cen papieru o 5%; ceny PE bez zmian", "Press release — A, August 15, 2026\nPulp prices rise. Up 3 EUR/t",
             "cut\x00prices of paper fall. New prices of pulp, increase of 1,250 EUR per tonne in the CEE region, effective 15.08.2026"]
    df = spark.createDataFrame(list(enumerate(texts)), "best int, material string")
    got = R.with_rule_response(df, "material", ["best"], "out").select("best", "out")
    assert sorted(got.collect()) == sorted(df.select("best", rule_response(F.col("material"))).collect())


def test_blank_guard_builds_the_text_once(spark):
    plan = _optimized(EX.guard_blank(FX.announcements_table(spark, SF), "text"))
    assert plan.count("Komunikat prasowy") == 1


def test_signals_are_deduplicated_in_small_tasks(spark):
    """Signals are made and sorted in more tasks than lineitem has splits."""
    for name in ("dedup_batch", "dedup_against_history"):
        spread = [line for line in _exchanges_of_rows(_query_plan(spark, name)) if "REPARTITION_BY_NUM" in line]
        assert len(spread) == 1 and "l_orderkey" in spread[0], name


def test_first_n_limits_before_the_shuffle(spark):
    plan = _physical(IT.first_n_per_source(FX.items_table(spark, SF), 5))
    assert "WindowGroupLimit" in plan


def _query_plan(spark, name):
    load_all()
    return _physical(QUERIES[name](spark, SF))


def test_scans_read_what_the_query_needs(spark):
    """No exchange of whole tables, and pruned scans."""
    for name, absent in {"signal_kpis": ("l_extendedprice", "l_tax", "l_shipdate"), "usage_summary": ("ts:", "session"),
                         "keyword_filter": ("lang", "n_chars"), "enrich_items": ("lang", "n_chars")}.items():
        plan = _query_plan(spark, name)
        assert "REPARTITION_BY_NUM" not in plan, name
        schemas = [x.split(">")[0] for x in plan.split("ReadSchema: struct<")[1:]]
        assert schemas and not [s for s in schemas for a in absent if a in s], (name, schemas)


def test_margin_runs_without_python(spark):
    assert "Python" not in _query_plan(spark, "margin_impact")


def _exchanges_of_rows(plan):
    return [line for line in plan.splitlines() if "Exchange" in line and "Broadcast" not in line]


def test_literal_tables_move_no_rows(spark):
    """Registry and cost shares are literals whose size Spark knows: the big side stays where it is."""
    for name in ("union_sources", "margin_impact"):
        plan = _query_plan(spark, name)
        literal = plan.count("inline")
        assert literal and "ExistingRDD" not in plan and "BroadcastHashJoin" in plan, name
    items = spark.read.schema("source string, pos long, title string").parquet(SF + "/events.parquet")
    registry = IT.source_registry(spark, ["a", "b"])
    assert not _exchanges_of_rows(_physical(IT.union_sources(items, registry)))
    signals = spark.read.schema("material string, amount double, unit string, change_type string").parquet(SF + "/events.parquet")
    assert not _exchanges_of_rows(_physical(AL.margin_impact(signals, AL.cost_share_table(spark))))
    fallback = IT.with_fallback(items, items, registry, n_fallback=3)
    sides = _physical(fallback).split("Union")[1]
    assert "SortMergeJoin" not in sides


def test_equal_dates_are_cut_into_ranges(spark):
    """A date with nine tenths of the rows does not go to one task, and the order holds."""
    rows = spark.range(20_000).select(F.col("id"), F.when(F.col("id") % 10 == 0, F.concat(F.lit("2026-0"), (F.col("id") % 7 + 1).cast("string")))
                                      .when(F.col("id") % 10 < 8, F.lit("2026-05-01")).alias("announcement_date"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = ST.scan_signals(rows)
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) > 4 and max(sizes) < 20_000 / 3
        got = [(r.announcement_date is None, r.announcement_date, r.id) for r in out.collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    dated = [g for g in got if not g[0]]
    assert [g[0] for g in got] == sorted(g[0] for g in got)
    assert dated == sorted(sorted(dated, key=lambda g: g[2]), key=lambda g: g[1], reverse=True)
