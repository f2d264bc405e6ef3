"""Literal cases for the rules of SURVEY §1.3 (expected values reasoned from
the behaviour being reproduced, never by running it)."""

import html
import json
import math
import random

from pyspark.sql import functions as F

from marketsignals import constants as K
from marketsignals.functions.formatting import one_decimal
from marketsignals.functions.json_rules import clean_response, truthy
from marketsignals.functions.text import anchors, html_to_text, is_blank, unescape
from marketsignals.operators import alerts as AL
from marketsignals.operators import extract as EX
from marketsignals.operators import store as ST
from marketsignals.operators import usage as U
from marketsignals.operators.marts import signals_json

SIG = ("material string, material_detail string, change_type string, amount double, unit string, "
       "currency string, region string, effective_date string, announcement_date string, "
       "source_company string, confidence string, summary_pl string")


def _signal(spark, **kw):
    base = dict(material="tektura", material_detail="kraftliner", change_type="podwyzka", amount=35.0,
                unit="EUR/t", currency="EUR", region="CEE", effective_date="2026-09-01",
                announcement_date="2026-08-15", source_company="Fabryka Brzoza", confidence="high",
                summary_pl="Brzoza: drożej o 35 EUR/t.")
    base.update(kw)
    cols = [c.split()[0] for c in SIG.split(", ")]
    return spark.createDataFrame([tuple(base[c] for c in cols)], SIG)


def test_l1_message_and_rule(spark):
    df = AL.with_message(AL.with_alert(_signal(spark)))
    row = df.first()
    assert row.alert is True
    assert row.alert_message.split("\n") == [
        "🔺 podwyżka — tektura (kraftliner)", "Zmiana: 35.0 EUR/t", "Region: CEE",
        "Wejście w życie: 2026-09-01", "Źródło: Fabryka Brzoza", "Podsumowanie: Brzoza: drożej o 35 EUR/t."]


def test_t13_amount_printed_as_parsed(spark):
    df = _signal(spark).withColumn("amount_text", F.lit("35"))
    msg = AL.with_message(df, amount_text="amount_text").first().alert_message
    assert msg.split("\n")[1] == "Zmiana: 35 EUR/t"


def test_t12_message_edges(spark):
    df = _signal(spark, change_type=None, material_detail="", amount=0.0, region="", effective_date=None,
                 source_company="", unit=None, summary_pl=None)
    lines = AL.with_message(df, margin_note=None).first().alert_message.split("\n")
    assert lines == ["🔻 obniżka — tektura", "Zmiana: brak danych o kwocie", "Region: nie podano",
                     "Wejście w życie: nie podano", "Źródło: nieznane", "Podsumowanie: None"]
    df2 = _signal(spark, unit=None).withColumn("note", F.lit("x"))
    lines2 = AL.with_message(df2, margin_note="note").first().alert_message.split("\n")
    assert lines2[1] == "Zmiana: 35.0 None" and lines2[-1] == "Wpływ na marżę: x"


def test_l5_alert_rule(spark):
    cases = [("low", "procent", 50.0, False), ("medium", "procent", 3.0, True), ("high", "procent", 2.9, False),
             ("medium", "EUR/t", 35.0, False), ("high", "procent", None, True), ("high", "procent", -8.0, False),
             (None, "procent", 5.0, True), ("high", "procent", float("nan"), False), (None, "EUR/t", 1.0, False)]
    df = spark.createDataFrame([(i, c, u, a) for i, (c, u, a, _) in enumerate(cases)],
                               "i int, confidence string, unit string, amount double")
    got = {r.i: r.alert for r in AL.with_alert(df).collect()}
    assert got == {i: e for i, (_, _, _, e) in enumerate(cases)}


def test_l4_margin(spark):
    rows = [(0, 5.0, "procent", "podwyzka"), (1, 5.0, "procent", "obnizka"), (2, 5.0, "procent", "utrzymanie"),
            (3, 0.0, "procent", "podwyzka"), (4, 35.0, "EUR/t", "podwyzka"), (5, None, "procent", "podwyzka"),
            (6, 0.5, "procent", "podwyzka"), (7, 0.7, "procent", "podwyzka")]
    df = spark.createDataFrame(rows, "i int, amount double, unit string, change_type string")
    out = {r.i: r for r in AL.margin_impact(df, share_pct=60).collect()}
    assert out[0].margin_impact_pct == 3.0 and out[0].margin_direction == "wzrost kosztu"
    assert out[1].margin_impact_pct == -3.0 and out[2].margin_impact_pct == -3.0
    assert out[3].margin_impact_pct == 0.0 and "spadek kosztu o ok. 0.0" in out[3].margin_note
    assert out[4].margin_impact_pct is None and out[4].margin_note == K.MARGIN_NO_DATA
    assert out[5].margin_note == K.MARGIN_NO_DATA
    assert out[0].margin_note.startswith("Przy udziale surowca 60% w koszcie wytworzenia: wzrost kosztu o ok. 3.0")
    # .1f of the exact binary value: 0.5*0.6=0.3 -> 0.3, 0.7*0.6=0.42 -> 0.4
    assert "o ok. 0.3 p.p." in out[6].margin_note and "o ok. 0.4 p.p." in out[7].margin_note


def test_t15_rounding_of_binary_ties(spark):
    df = spark.createDataFrame([(0, 0.25 / 0.6 * 100 / 100), (1, 0.35)], "i int, x double")
    # direct check of the renderer through margin_impact with share 100
    df = spark.createDataFrame([(0, 0.25), (1, 0.35)], "i int, amount double") \
        .withColumn("unit", F.lit("procent")).withColumn("change_type", F.lit("podwyzka"))
    out = {r.i: r.margin_note for r in AL.margin_impact(df, share_pct=100).collect()}
    assert "o ok. 0.2 p.p." in out[0] and "o ok. 0.3 p.p." in out[1]


def test_margin_note_prints_like_python(spark):
    """Binary ties, neighbours of ties, whole numbers, large and odd values."""
    rng = random.Random(5)
    xs = [i / 20 for i in range(400)] + [i / 40 for i in range(200)] + [rng.random() * 10 ** rng.randrange(-3, 12) for _ in range(2000)]
    xs += [math.nextafter(x, d) for x in xs[:300] for d in (0.0, 1e9)] + [float(1 << 53), 1e16, 1e20, 0.05, 0.25, 2.5]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [(r.x, r.t) for r in df.select("x", one_decimal(F.col("x")).alias("t")).collect()]
    assert [(x, t) for x, t in got if t != f"{x:.1f}"] == []
    odd = spark.createDataFrame([(float("nan"),), (float("inf"),)], "x double")
    assert [r.t for r in odd.select(one_decimal(F.col("x")).alias("t")).collect()] == ["nan", "inf"]


def test_margin_direction_of_nan(spark):
    df = spark.createDataFrame([(float("nan"), "procent", "podwyzka")], "amount double, unit string, change_type string")
    row = AL.margin_impact(df, share_pct=50).first()
    assert row.margin_direction == K.MARGIN_DOWN and K.MARGIN_DOWN + " o ok. nan" in row.margin_note
    assert "Python" not in AL.margin_impact(df, share_pct=50)._jdf.queryExecution().executedPlan().toString()


def test_l3_cleaning(spark):
    cases = ['```json\n{"a": 1}\n```', '```\n{"a": 1}\n```', '```JSON\n{"a": 1}\n```', '   {"a": 1}  ',
             '```json {"a": 1}```', '```json\r\n{"a": 1}\r\n```', '```json\n{"a": "x`y"}\n```', '`{"a": 1}`']
    expected = ['{"a": 1}\n', '\n{"a": 1}\n', 'JSON\n{"a": 1}\n', '{"a": 1}', 'json {"a": 1}',
                'json\r\n{"a": 1}\r\n', '{"a": "x`y"}\n', '`{"a": 1}`']
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, raw string")
    got = {r.i: r.c for r in df.select("i", clean_response(F.col("raw")).alias("c")).collect()}
    assert [got[i] for i in range(len(cases))] == expected


def test_t5_truthiness(spark):
    vals = {'false': False, '"false"': True, '1': True, '0': False, '0.0': False, '""': False, 'null': False,
            '[]': False, '{}': False, 'true': True, '"x"': True, '[0]': True, '-0': False, 'NaN': True}
    rows = [(k, '{"v": ' + k + '}') for k in vals] + [("missing", "{}")]
    df = spark.createDataFrame(rows, "k string, raw string")
    p = F.from_json("raw", "v variant")
    got = {r.k: r.t for r in df.select("k", truthy(p["v"]).alias("t")).collect()}
    assert got == {**vals, "missing": False}


def _route(spark, raws):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raws)], "i int, raw_output string")
    return {r.i: (r.status, r.reason) for r in EX.parse_responses(df, run_date="2026-01-01").collect()}


FULL = ('{"material": "PE", "material_detail": null, "change_type": "podwyzka", "amount": 5, "unit": "procent",'
        ' "currency": null, "region": null, "effective_date": null, "announcement_date": null,'
        ' "source_company": null, "confidence": "high", "summary_pl": "x"}')


def test_t4_t8_routing(spark):
    raws = [FULL, "{'material': 'PE'}", FULL + " koniec", "[1]", '"text"', '{"not_relevant": "false"}',
            '{"not_relevant": 1, "x": 2}', FULL.replace('"amount": 5', '"amount": "35"'),
            FULL.replace('"PE"', 'null'), FULL.replace('{', '{"extra": 1, ', 1), '{"material": "PE"}',
            FULL.replace('"amount": 5', '"amount": NaN'), None,
            FULL.replace('{', '{"extracted_on": null, ', 1), FULL.replace('"PE"', '"PP", "material": "PE"'),
            '{"not_relevant": true} {"a":1}', FULL + FULL, FULL + "," + FULL]
    got = _route(spark, raws)
    assert got[0] == ("ok", None)
    assert got[1] == ("error", "invalid_json")
    assert got[2] == ("error", "invalid_json")
    assert got[3] == ("error", "not_object") and got[4] == ("error", "not_object")
    assert got[5] == ("irrelevant", None) and got[6] == ("irrelevant", None)
    assert got[7] == ("rejected", "amount_not_numeric")
    assert got[8] == ("rejected", "null_material")
    assert got[9] == ("error", "unexpected_keys") and got[10] == ("error", "missing_keys")
    assert got[11] == ("ok", None)
    assert got[12] == ("error", "no_content")
    assert got[13] == ("rejected", "null_extracted_on")
    assert got[15] == got[16] == got[17] == ("error", "invalid_json")  # a second object
    assert got[14] == ("ok", None)  # duplicate key: last one wins, still twelve distinct keys


def test_t7_duplicate_key_last_wins_and_amount_text(spark):
    df = spark.createDataFrame([(0, FULL.replace('"PE"', '"PP", "material": "PE"'))], "i int, raw_output string")
    row = EX.parse_responses(df, run_date="2026-01-01").first()
    assert row.material == "PE" and row.amount == 5.0 and row.amount_text == "5"


def test_l6_uniqueness_with_nulls(spark):
    rows = [(1, "x", "y", "2020", 35.0), (2, "x", "y", "2020", 35.0), (3, "x", "y", None, 35.0),
            (4, "x", "y", None, 35.0), (5, "X", "y", "2020", 35.0), (6, None, "y", "2020", 35.0),
            (7, "x", "y", "2020", float("nan")), (8, "x", "y", "2020", float("nan"))]
    df = spark.createDataFrame(rows, "pos int, material string, source_company string, effective_date string, amount double")
    kept = sorted(r.pos for r in ST.dedup_batch(df, ["pos"]).collect())
    assert kept == [1, 3, 4, 5, 7, 8]
    hist = spark.createDataFrame([("X", "y", "2020", 35.0), ("x", "y", None, 35.0)],
                                 "material string, source_company string, effective_date string, amount double")
    fresh = sorted(r.pos for r in ST.new_signals(df, hist, ["pos"]).collect())
    assert fresh == [1, 3, 4, 7, 8]
    # idempotent: stored rows are never new again
    stored = ST.new_signals(df, hist, ["pos"])
    again = ST.new_signals(df, hist.unionByName(stored.select(*hist.columns)), ["pos"])
    assert sorted(r.pos for r in again.collect()) == [3, 4, 7, 8]


def test_t22_nulls_last(spark):
    df = spark.createDataFrame([("a", None), ("b", "2026-01-02"), ("c", "2026-01-03")],
                               "material string, announcement_date string")
    assert [r.material for r in ST.scan_signals(df).collect()] == ["c", "b", "a"]


def test_t19_usage_capture(spark):
    rows = [("p", "", 10, None, None, True), ("p", None, None, 5, 2, True), ("p", "m", 1, 1, 1, False)]
    df = spark.createDataFrame(rows, "process string, model string, prompt_tokens long, completion_tokens long, "
                                     "reasoning_tokens long, usage_present boolean")
    out = U.capture_usage(df, run_ts="2026-01-01 06:00:00").collect()
    assert len(out) == 2
    assert {(r.model, r.input_tokens, r.output_tokens, r.reasoning_tokens, r.total_tokens) for r in out} == {
        (K.DEFAULT_MODEL, 10, 0, 0, 10), (K.DEFAULT_MODEL, 0, 5, 2, 7)}


def test_t25_melt_and_totals(spark):
    log = spark.createDataFrame([(1, "a", "m1", 1, 2, 3, 6), (2, "a", "m2", 10, 20, 0, 30), (3, "b", "m1", 5, 5, 5, 15)],
                                "id long, process string, model string, input_tokens long, output_tokens long, "
                                "reasoning_tokens long, total_tokens long")
    s = U.usage_summary(log)
    melt = U.usage_melt(s).collect()
    assert len(melt) == 9 and sum(1 for r in melt if r.process == "a" and r.typ == "wejściowe") == 2
    series = {(r.process, r.typ): r.tokeny for r in U.usage_series(s).collect()}
    assert series[("a", "wejściowe")] == 11 and series[("a", "myślenie")] == 3
    tot = U.usage_totals(s).first()
    assert (tot.total_calls, tot.total_input, tot.total_output, tot.total_reasoning) == (3, 16, 27, 8)
    assert sum(series.values()) == tot.total_input + tot.total_output + tot.total_reasoning
    assert [r.suma_calkowita for r in s.collect()] == [30, 15, 6]  # per (process, model), largest first


def test_o07_page_text(spark):
    html = ('<!DOCTYPE html><html><head><title>T &amp; U</title><style>p{}</style><script>var t="</p>";</script>'
            '</head><body><nav><a href="/x">nav</a></nav>a<!-- c -->b<p> x&nbsp; </p><footer>f</footer>'
            '<header>h</header><p>&lt;y&gt; &quot;q&quot; &#39;s&#39; &amp;lt;</p></body></html>')
    df = spark.createDataFrame([(html,)], "html string")
    assert df.select(html_to_text(F.col("html")).alias("t")).first().t == 'T & U\na\nb\nx\n<y> "q" \'s\' &lt;'


def test_o05_anchors(spark):
    html = ('<a href="/news-releases/a">  Short </a><a class="x" href="/news-releases/b"><b>A long enough</b> '
            'title here</a><a href="/other/c">Another long title text</a><a href="/news-releases/d"></a>')
    df = spark.createDataFrame([(html,)], "html string")
    got = df.select(anchors(F.col("html")).alias("a")).first().a
    assert [(x.href, x.title) for x in got] == [("/news-releases/b", "A long enoughtitle here")]


def test_o05_anchors_as_they_occur(spark):
    page = ("<!-- <a href='/news-releases/hidden'>In a comment, not shown</a> -->"
            "<a data-href='/news-releases/no' title='a > b'>No link of its own here</a>"
            "<A class=x HREF='/news-releases/single'>In single quotes, upper case</A >"
            '<a href=/news-releases/bare target=_blank>Without any quotes at all</a>'
            '<a href = "/news-releases/q?a=1&amp;b=2">Spaces around the equals sign</a>')
    got = spark.createDataFrame([(page,)], "html string").select(anchors(F.col("html")).alias("a")).first().a
    assert [x.href for x in got] == ["/news-releases/single", "/news-releases/bare", "/news-releases/q?a=1&b=2"]


def test_references_decode_like_the_standard_library(spark):
    cases = ["&eacute;&euro;&#8211;&#x27;&#X1F600;", "&amp;lt;", "&nosuch; & &; &#; a&b", "&hellip;&rarr;&NotEqualTilde;", "&#0;&#xD800;",
             "R&D &lt;&gt;&quot;&nbsp;&copy;"]
    df = spark.createDataFrame(list(enumerate(cases)), "i int, t string")
    got = {r.i: r.u for r in df.select("i", unescape(F.col("t")).alias("u")).collect()}
    assert [got[i] for i in range(len(cases))] == [html.unescape(c) for c in cases]


def test_o07_whole_page(spark):
    page = "<p>" + "x" * 9000 + "</p>"
    df = spark.createDataFrame([(page,)], "html string")
    assert len(df.select(html_to_text(F.col("html")).alias("t")).first().t) == 9000


def test_o38_amount_as_parsed(spark):
    df = _signal(spark).withColumn("amount_text", F.lit("35")).unionByName(_signal(spark).withColumn("amount_text", F.lit(None)))
    assert [json.loads(r.signal_json, parse_float=str, parse_int=str)["amount"] for r in signals_json(df).collect()] == ["35", "35.0"]


def test_o12_blank(spark):
    df = spark.createDataFrame([(0, " \n\t "), (1, " 　"), (2, " a "), (3, "")], "i int, t string")
    got = {r.i: r.b for r in df.select("i", is_blank(F.col("t")).alias("b")).collect()}
    assert got == {0: True, 1: True, 2: False, 3: True}


def _extracted(spark, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    out = EX.parse_responses(EX.extract_responses(df, "text", ["k"]), run_date="2026-01-01")
    return {r.k: r for r in out.collect()}


def test_l2_offline_extraction(spark):
    r = _extracted(spark, """
        Informacja prasowa — Fabryka Brzoza, 3 maja 2026

        Fabryka Brzoza zapowiada wzrost cen testlinera o 42,5 EUR/tonę
        w regionie Europy Zachodniej. Cennik obowiązuje od 12 czerwca 2026 roku.
        """, "Dywidenda za rok 2025 wyniesie 1 zł na akcję.")
    assert r[0].status == "ok"
    assert (r[0].material, r[0].material_detail, r[0].change_type, r[0].amount, r[0].unit, r[0].currency, r[0].region,
            r[0].effective_date, r[0].announcement_date, r[0].source_company) == (
        "tektura", "testliner", "podwyzka", 42.5, "EUR/t", "EUR", "Europa Zachodnia", "2026-06-12", "2026-05-03", "Fabryka Brzoza")
    assert r[0].amount_text == "42.5"
    assert r[1].status == "irrelevant"


def test_english_announcements(spark):
    r = _extracted(
        spark, "Northern Paper Mills raises containerboard prices by $50 per ton, effective September 1, 2026.",
        "Press release — Acme, 4 July 2026\nAcme reduces pulp prices in the Nordic region by 3.5 percent from 1 August 2026.",
        "Raw material costs: steel prices will increase by USD 20.", "Acme opens a museum of paper.")
    assert (r[0].material, r[0].change_type, r[0].amount_text, r[0].unit, r[0].currency, r[0].effective_date) == (
        "tektura", "podwyzka", "50", "USD/t", "USD", "2026-09-01")
    assert (r[1].material, r[1].change_type, r[1].amount, r[1].unit, r[1].region, r[1].announcement_date, r[1].effective_date,
            r[1].source_company) == ("celuloza", "obnizka", 3.5, "procent", "Nordic", "2026-07-04", "2026-08-01", "Acme")
    assert (r[2].material, r[2].unit, r[2].currency) == ("inne", None, "USD")
    assert r[3].status == "irrelevant"


def test_numbers_with_separators(spark):
    said = {"1,250 EUR": "1250", "1 200 PLN/t": "1200", "1\u00a0200,50 PLN": "1200.5", "12.500 EUR": "12500", "42,5 EUR": "42.5",
            "1.250,75 EUR": "1250.75", "0,125 EUR": "0.125", "$1,100": "1100", "1234567 EUR": "1234567", "3.5%": "3.5", "1.000.000 PLN": "1000000"}
    r = _extracted(spark, *[f"Acme raises pulp prices by {x}." for x in said])
    assert {x: r[i].amount_text for i, x in enumerate(said)} == said


def test_change_and_amount_come_from_one_clause(spark):
    r = _extracted(
        spark, "Acme will not raise prices of pulp; sales rose by 5%.",
        "Acme's turnover grew by 12% to 900 EUR. From 01.09.2026 Acme lowers paper prices by 30 EUR per tonne.",
        "Spółka nie podnosi cen celulozy. Dywidenda wyniesie 3 zł.",
        "Cena PET wzrośnie o 4%, ale sprzedaż PP spadła o 20%.",
        "Acme not only raises pulp prices by 7%, it also invests 300 EUR.",
        "Paper demand is weak. Prices of PET increase by 2% effective 2026-03-01.",
        "Acme celebrates. PE prices: unchanged.")
    assert r[0].status == "irrelevant" and r[2].status == "irrelevant"
    assert (r[1].material, r[1].change_type, r[1].amount, r[1].unit, r[1].effective_date) == ("papier", "obnizka", 30, "EUR/t", "2026-09-01")
    assert (r[3].material, r[3].change_type, r[3].amount) == ("PET", "podwyzka", 4)
    assert (r[4].change_type, r[4].amount) == ("podwyzka", 7)
    assert (r[5].material, r[5].amount, r[5].effective_date) == ("PET", 2, "2026-03-01")
    assert (r[6].material, r[6].change_type, r[6].amount) == ("PE", "utrzymanie", None)


def test_words_are_found_in_any_case(spark):
    r = _extracted(spark, "PODWYŻKA CEN ŻYWIC O 5%.", "\u212aRAFTLINER: PRICE RAISED BY 3 PERCENT", "NBSK: Nigdy BEZ ZMIAN",
                   "FluTing price Not At All Reduced; PET hike 2,5 %", "Aluminium and pet prices lower by zł1 200 per tonne")
    got = [(x.status, x.material, x.material_detail, x.change_type, x.amount, x.unit) for _, x in sorted(r.items())]
    assert got == [("ok", "inne", None, "podwyzka", 5.0, "procent"), ("ok", "tektura", "kraftliner", "podwyzka", 3.0, "procent"),
                   ("ok", "celuloza", "NBSK", "utrzymanie", None, None), ("ok", "PET", None, "podwyzka", 2.5, "procent"),
                   ("ok", "inne", None, "obnizka", 1200.0, "PLN/t")]


def test_units_are_not_guessed(spark):
    r = _extracted(spark, "Papier wzrósł o 200 EUR.", "Papier: podwyżka o 200 EUR za tonę.", "Cena PET spadła o 4%.")
    assert (r[0].change_type, r[0].unit, r[0].currency, r[0].amount_text) == ("podwyzka", None, "EUR", "200")
    assert r[1].unit == "EUR/t" and (r[2].unit, r[2].change_type, r[2].currency) == ("procent", "obnizka", None)


def test_nan_message(spark):
    df = _signal(spark, amount=float("nan"))
    assert AL.with_message(df).first().alert_message.split("\n")[1] == "Zmiana: nan EUR/t"
    assert math.isnan(df.first().amount)
