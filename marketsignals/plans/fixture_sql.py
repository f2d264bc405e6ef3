"""DuckDB definitions of the derived tables (FIXTURES.md F1..F6).

Oracle queries are written against these CTEs; ``with_fixtures`` prepends
the ones a query needs (dependencies first).
"""

from __future__ import annotations

F1 = """
select l_orderkey as o1, l_linenumber as o2, l_partkey as o3, l_suppkey as o4, l_shipdate as o5,
  case p_type when 'STANDARD' then 'celuloza' when 'ECONOMY' then 'tektura' when 'MEDIUM' then 'papier'
       when 'PROMO' then 'PE' when 'SMALL' then 'PP' else 'PET' end as material,
  case when l_partkey % 3 = 0 then null when l_partkey % 7 = 0 then '' else p_name end as material_detail,
  case l_returnflag when 'A' then 'podwyzka' when 'R' then 'obnizka' else 'utrzymanie' end as change_type,
  case when l_linenumber = 7 then null when l_linestatus = 'F' then round(l_discount * 100) else l_quantity end as amount,
  case l_linestatus when 'F' then 'procent' else 'EUR/t' end as unit,
  case l_linestatus when 'O' then 'EUR' end as currency,
  case when l_suppkey % 11 = 0 then null else r_name end as region,
  case when l_linenumber = 5 then null else cast(cast(date_trunc('month', l_shipdate) as date) as string) end as effective_date,
  case when l_linenumber = 6 then null else cast(cast(l_shipdate - interval '30' day as date) as string) end as announcement_date,
  case when l_suppkey % 10 = 0 then null else s_name end as source_company,
  'https://example.org/n/' || cast(l_orderkey as string) as source_url,
  case when round(l_tax * 100) <= 2 then 'low' when round(l_tax * 100) <= 5 then 'medium' else 'high' end as confidence,
  l_returnflag || ' ' || p_name as summary_pl, '2026-01-01' as extracted_on
from lineitem join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey
join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey
"""

F2 = """
select source, doc_id as pos, split_part(text, chr(10), 1) as title, text as summary,
  case when doc_id % 7 = 0 then '' when url is null then 'http://missing.example/' || cast(doc_id as string) else url end as link,
  '' as published
from documents left join pages on page_id = doc_id
"""

F3 = """
select event_id as id, event_type as process, 'm' || cast(user_id % 3 as string) as model,
  try_cast(regexp_extract(props, '([0-9]+)', 1) as bigint) as input_tokens, cast(floor(value) as bigint) as output_tokens,
  cast(case when event_type = 'error' then user_id % 5 else 0 end as bigint) as reasoning_tokens, ts as logged_at
from events
"""

F4 = """
select o1, o2, o3, o4, o5,
  case when o1 % 4 = 1 then 'Press release' else 'Komunikat prasowy' end || coalesce(' — ' || source_company, '')
  || coalesce(', ' || announcement_date, '') || chr(10)
  || case when o1 % 4 = 1 then coalesce(source_company, 'The producer') || ' announces '
       || case change_type when 'podwyzka' then 'an increase' when 'obnizka' then 'a decrease' else 'unchanged prices' end
       || coalesce(' of ' || case unit when 'procent' then cast(cast(amount as int) as string) || '%'
                                       else '€' || cast(cast(amount as int) as string) || ' per tonne' end, '')
       || ' for ' || case material when 'celuloza' then 'pulp' when 'tektura' then 'containerboard' when 'papier' then 'paper'
                                   else material end
       || coalesce(' in the ' || region || ' region', '') || coalesce(', effective ' || effective_date, '') || '.'
     else coalesce(source_company, 'Producent') || ' informuje o '
       || case change_type when 'podwyzka' then 'podwyżce' when 'obnizka' then 'obniżce' else 'utrzymaniu' end || ' cen: ' || material
       || coalesce(' o ' || cast(cast(amount as int) as string) || case unit when 'procent' then '%' else ' EUR/t' end, '')
       || coalesce(' w regionie ' || region, '') || '.' || coalesce(' Nowe ceny od ' || effective_date || '.', '') end as text,
  material, change_type, amount, case when amount is not null then unit end as unit, region, effective_date, announcement_date,
  source_company
from f1
"""


def _body(material: str, amount: str) -> str:
    return (
        "'\"material\": ' || " + material + " || ', \"material_detail\": ' || coalesce('\"' || material_detail || '\"', 'null')"
        " || ', \"change_type\": \"' || change_type || '\", \"amount\": ' || " + amount +
        " || ', \"unit\": \"' || unit || '\", \"currency\": ' || coalesce('\"' || currency || '\"', 'null')"
        " || ', \"region\": ' || coalesce('\"' || region || '\"', 'null')"
        " || ', \"effective_date\": ' || coalesce('\"' || effective_date || '\"', 'null')"
        " || ', \"announcement_date\": ' || coalesce('\"' || announcement_date || '\"', 'null')"
        " || ', \"source_company\": ' || coalesce('\"' || source_company || '\"', 'null')"
        " || ', \"confidence\": \"' || confidence || '\", \"summary_pl\": \"' || summary_pl || '\"}'"
    )


_MAT = "'\"' || material || '\"'"
_AMT = "coalesce(cast(cast(amount as int) as string), 'null')"
_OK = _body(_MAT, _AMT)

F5 = f"""
select o1, o2, o3, o4, o5, (o1 * 7 + o2) % 10 as variant, case (o1 * 7 + o2) % 10
  when 0 then '```json' || chr(10) || '{{"not_relevant": false, ' || {_OK} || chr(10) || '```'
  when 1 then '{{"not_relevant": true, "material": null}}'
  when 2 then 'przepraszam, brak danych'
  when 3 then '{{"not_relevant": false, "material": "PE"}}'
  when 4 then '{{"not_relevant": false, "extra": 1, ' || {_OK}
  when 5 then '{{"not_relevant": false, ' || {_body("'null'", _AMT)}
  when 6 then '[1]'
  when 7 then '{{"not_relevant": false, ' || {_body(_MAT, "'\"35\"'")}
  when 8 then '  {{' || {_OK} || ' '
  else '{{"not_relevant": false, ' || {_OK} || ' koniec' end as raw_output
from f1
"""

F6 = "select event_type as ticker, ts, value as close from events"

FIXTURES = {"f1": F1, "f2": F2, "f3": F3, "f4": F4, "f5": F5, "f6": F6}
DEPENDS = {"f4": ["f1"], "f5": ["f1"]}


def with_fixtures(sql: str, *names: str) -> str:
    """Prefix ``sql`` with the CTEs it reads (plus their dependencies)."""
    ordered: list[str] = []
    for n in names:
        for d in DEPENDS.get(n, []) + [n]:
            if d not in ordered:
                ordered.append(d)
    ctes = ",\n".join(f"{n} as ({FIXTURES[n]})" for n in ordered)
    body = sql.strip()
    if body.lower().startswith("with "):
        return f"with {ctes},\n{body[5:]}"
    return f"with {ctes}\n{body}"
