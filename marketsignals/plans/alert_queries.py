"""Queries for alerting and margin impact."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from ..operators import alerts as AL
from ..sources import fixtures as FX
from ..sources.tables import read_table
from .fixture_sql import with_fixtures
from .registry import query

RUN_DATE = "2026-01-01"
KEYS = FX.ORDER_COLS

RULE_SQL = """case when coalesce(confidence = 'low', false) then false
  when coalesce(unit = 'procent' and amount is not null, false) then coalesce(amount >= 3.0 and not isnan(amount), false)
  else coalesce(confidence = 'high', false) end"""

MESSAGE_SQL = """concat_ws(chr(10),
  case when change_type = 'podwyzka' then '🔺 podwyżka' else '🔻 obniżka' end || ' — ' || coalesce(material, 'None')
    || case when coalesce(material_detail, '') <> '' then ' (' || material_detail || ')' else '' end,
  'Zmiana: ' || case when amount is not null and amount <> 0
                     then cast(amount as varchar) || ' ' || coalesce(unit, 'None') else 'brak danych o kwocie' end,
  'Region: ' || coalesce(nullif(region, ''), 'nie podano'),
  'Wejście w życie: ' || coalesce(nullif(effective_date, ''), 'nie podano'),
  'Źródło: ' || coalesce(nullif(source_company, ''), 'nieznane'),
  'Podsumowanie: ' || coalesce(summary_pl, 'None'))"""

SHARES_SQL = ("shares(material, share_pct) as (values " +
              ", ".join(f"('{m}', {s})" for m, s in K.MATERIAL_COST_SHARE) + ")")

OUTBOX_SQL = f"""outbox as (
  select o1, o2, o3, o4, o5, ch.channel, {MESSAGE_SQL} as alert_message, '{RUN_DATE}' as created_on
  from f1, (values ('slack'), ('email')) ch(channel)
  where {RULE_SQL})"""


def _alerted(spark, sf_dir):
    f1 = FX.signals_table(spark, sf_dir)
    return AL.with_message(AL.with_alert(f1).where("alert"))


def deliveries_table(spark, sf_dir):
    """Delivery results as channels report them, a table of its own: some
    slack posts and some e-mails fail."""
    li = read_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o1"), F.col("l_linenumber").alias("o2"), F.col("l_partkey").alias("o3"),
        F.col("l_suppkey").alias("o4"), F.col("l_shipdate").alias("o5"))
    each = li.select("*", F.explode(F.array(*map(F.lit, K.ALERT_CHANNELS))).alias("channel"))
    return each.withColumn("ok", F.when(F.col("channel") == "slack", F.col("o1") % 4 != 0).otherwise(F.col("o2") % 3 != 0))


@query("alert_rule", with_fixtures(f"select o1, o2, o3, o4, o5, {RULE_SQL} as alert from f1", "f1"))
def q_alert_rule(spark, sf_dir):
    return AL.with_alert(FX.signals_table(spark, sf_dir)).select(*KEYS, "alert")


@query("alert_message", with_fixtures(f"select o1, o2, o3, o4, o5, {MESSAGE_SQL} as alert_message from f1", "f1"))
def q_alert_message(spark, sf_dir):
    return AL.with_message(FX.signals_table(spark, sf_dir)).select(*KEYS, "alert_message")


@query("margin_impact", with_fixtures(f"""with {SHARES_SQL},
m as (select f1.*, s.share_pct,
        case when amount is not null and coalesce(unit = 'procent', false)
             then (case when change_type = 'podwyzka' then amount else -amount end) * (s.share_pct / 100) end as impact
      from f1 left join shares s on f1.material = s.material)
select o1, o2, o3, o4, o5, material, share_pct, impact as margin_impact_pct,
  case when impact > 0 then 'wzrost kosztu' when impact is not null then 'spadek kosztu' end as margin_direction,
  case when not (amount is not null and coalesce(unit = 'procent', false)) then '{K.MARGIN_NO_DATA}'
       when share_pct is null then null
       else printf('Przy udziale surowca %d%% w koszcie wytworzenia: %s o ok. %.1f p.p. marży, jeśli cena sprzedaży nie zostanie skorygowana.',
                   share_pct, case when impact > 0 then 'wzrost kosztu' else 'spadek kosztu' end, abs(impact)) end as margin_note
from m""", "f1"))
def q_margin_impact(spark, sf_dir):
    f1 = FX.signals_table(spark, sf_dir)
    out = AL.margin_impact(f1, shares=AL.cost_share_table(spark))
    return out.select(*KEYS, "material", "share_pct", "margin_impact_pct", "margin_direction", "margin_note")


@query("alert_outbox", with_fixtures(f"with {OUTBOX_SQL} select * from outbox", "f1"))
def q_alert_outbox(spark, sf_dir):
    return AL.alert_outbox(_alerted(spark, sf_dir), KEYS, K.ALERT_CHANNELS, RUN_DATE)


@query("alert_log", with_fixtures(f"""with {OUTBOX_SQL}
select o1, o2, o3, o4, o5, alert_message, '{RUN_DATE}' as sent_on, channel from outbox
where case when channel = 'slack' then o1 % 4 <> 0 else o2 % 3 <> 0 end""", "f1"))
def q_alert_log(spark, sf_dir):
    outbox = AL.alert_outbox(_alerted(spark, sf_dir), KEYS, K.ALERT_CHANNELS, RUN_DATE)
    return AL.alert_log(outbox, deliveries_table(spark, sf_dir), KEYS, RUN_DATE)


@query("alerts_without_channel", with_fixtures(
    f"select count(*) as alerts_without_channel from f1 where {RULE_SQL}", "f1"))
def q_alerts_without_channel(spark, sf_dir):
    """O19 with no channel configured: nothing is sent, the alerts are
    counted as a warning."""
    return AL.alerts_without_channel(_alerted(spark, sf_dir), [])
