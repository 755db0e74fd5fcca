"""Literal edge rows."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from laptrace.functions import dates, encoding, events, jsontext, lookups, marks, markup, names
from laptrace.operators import athletes, labels


def apply(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    rows = df.select("i", fn(F.col("v")).alias("out")).orderBy("i").collect()
    return [r["out"] for r in rows]


def apply_all(spark, fn, *values):
    return apply(spark, values, fn)


def test_race_dates(spark):
    cases = {
        "Apr 21–24, 2025": "2025-04-21", "Jul 27–Aug 4, 2024": "2024-07-27", "2024-07-27": "2024-07-27",
        "April 21, 2025": "2025-04-21", "Feb 31, 2024": None, "Foo 3–4, 2024": None, "July 3-5, 2024": "2024-07-03",
        "": None, None: None, "7/4/2024": "2024-07-04", "13/4/2024": "2024-04-13", "21 April 2024": "2024-04-21",
        "2024-07-04 10:11:12": "2024-07-04", "garbage": None, "APR 5, 2024": "2024-04-05", "2024-02-30": None,
    }
    out = apply(spark, list(cases), dates.race_date)
    assert [d and d.isoformat() for d in out] == list(cases.values())


def test_birth_dates(spark):
    assert apply(spark, ["1997-03-17", "1997", "", None], dates.birth_date) == [
        dt.date(1997, 3, 17), dt.date(1997, 1, 1), None, None]


def test_times(spark):
    cases = {"22.50": 22.5, "1:30.45": 90.45, "1:02:03.5": 3723.5, "DQ": None, "": None, None: None, "1:2:3:4": None,
             "nan": None, "5d": None, " 22.5 ": 22.5, ":5": None}
    assert apply(spark, list(cases), marks.seconds) == list(cases.values())
    assert apply(spark, ["1:30.45", "1:02:03.5", "1.5:20", "x"], marks.entered_seconds) == [90.45, None, 110.0, None]


def test_valid_marks(spark):
    assert apply(spark, [50.0, 0.0, 999.0, float("nan"), None], marks.is_valid_mark, "double") == [
        True, False, False, False, False]


def test_event_keys(spark):
    cases = {"400 L Free": "400mFree", "100m Butterfly": "100mFly", "200 Individual Medley": "200mIM",
             "Prelim 100 Back": "100mBack", "200 IM": "200mIM", "200IM": "200mIM", "Diving": "Diving", None: "", "": ""}
    assert apply(spark, list(cases), events.event_key) == list(cases.values())


def test_programme_keys_keep_relays_apart(spark):
    out = apply(spark, ["100m Freestyle", "4x100m Freestyle Relay", "4x100m Mixed Medley Relay", "50 Free Relay"],
                events.programme_key)
    assert out == ["100mFree", "4x100mFreeRelay", "4x100mMixedIMRelay", None]


def test_individual(spark):
    names_ = ["4x100 Free Relay", "10k Marathon", "Open Water 5", "50 Free", "", None]
    assert apply(spark, names_, events.is_individual) == [False, False, False, True, False, False]


def test_labels_and_names(spark):
    assert apply(spark, ["1650mFree", "50mBreast", "50mButterfly", "500mFree", "200IM"], events.event_label) == [
        None, "50m_Breaststroke", "50m_Butterfly", None, "200m_IM"]
    assert apply(spark, ["50m Freestyle"], events.indicator_name) == ["Olympic_50m__Freestyle"]
    assert apply(spark, ["Olympic_50m__Freestyle"], events.indicator_label) == ["50m_Freestyle"]
    assert apply(spark, ["100mFreestyle_SCY_Age12_FastestTime", "100mBack_SCY_Age12_FastestTime"],
                 events.standard_feature) == ["100Freestyle_SCY_Age12_FastestTime", "100mBack_SCY_Age12_FastestTime"]
    parts = spark.range(1).select(F.lit("200mIM_LCM_Age9_FastestTime").alias("f")).select(
        *[c.alias(n) for n, c in events.feature_parts(F.col("f")).items()]).first()
    assert tuple(parts) == ("200mIM", "LCM", 9)
    assert apply(spark, ["500mFree", "777mFree", "100mFree"], events.baseline_seconds) == [60.0, 60.0, 48.0]


@pytest.mark.parametrize("born, at, age", [
    ("2000-02-29", "2023-02-28", 22), ("2000-02-29", "2023-03-01", 23), ("2000-05-05", "2010-05-05", 10),
    ("2000-05-05", "1999-01-01", 0), (None, "2020-01-01", None), ("2000-05-05", None, None)])
def test_ages(spark, born, at, age):
    row = spark.range(1).select(dates.completed_years(F.lit(born).cast("date"), F.lit(at).cast("date")).alias("a")).first()
    assert row["a"] == age


def test_person_names(spark):
    cases = {"Jack AlexyUnited States": "Jack Alexy", "Relay Team A": None, "Bo": None, "A1 Smith": None,
             " Ana \t Lee  South Africa": "Ana Lee", "Tom and Jerry Cat": None, "Jo France": None, None: None}
    assert apply(spark, list(cases), names.person_name) == list(cases.values())


def test_body_index(spark):
    rows = [(75.0, 180.0), (75.0, 0.0), (None, 180.0)]
    df = spark.createDataFrame(rows, "w double, h double")
    out = [r[0] for r in df.select(encoding.body_index(F.col("w"), F.col("h"))).collect()]
    assert out == [75.0 / 1.8 ** 2, None, None]


def test_one_hot_and_sex(spark):
    df = spark.createDataFrame([("Asian",), ("asian",), ("unknown",), (None,), ("Pacific_Islander",)], "g string")
    flags = encoding.one_hot(F.col("g"), ["asian", "pacific islander"], "G_")
    out = [tuple(r) for r in df.select(*[c.alias(n) for n, c in flags.items()]).collect()]
    assert out == [(1, 0), (1, 0), (0, 0), (0, 0), (0, 1)]
    assert apply(spark, ["Male", "f", "other", None], encoding.sex_code) == [0, 1, None, None]


def test_json(spark):
    texts = ['```json\n{"a": 1}\n```', '```{"a": 2}```', '{"a": 3}', '{"a"', None]
    out = apply(spark, texts, lambda c: jsontext.json_object(c, "a int")["a"])
    assert out == [1, 2, 3, None, None]


def test_missing_fields(spark):
    df = spark.createDataFrame([("x", "", [], None)], "name string, dob string, paris_2024_races array<string>, height_cm double")
    assert df.select(athletes.audit(df).alias("m")).first()["m"] == [
        "dob", "height_cm", "weight_kg", "gender", "race", "paris_2024_races"]


def test_thresholds(spark):
    df = spark.createDataFrame([("50m_Freestyle", 18), ("50m_Freestyle", 25), ("50m_Backstroke", 12)], "l string, a int")
    assert [r[0] for r in df.select(labels.threshold(F.col("l"), F.col("a"))).collect()] == [24.0, 999.0, 999.0]


PAGE = """<html><head><title>T</title><script>var a="<h2>Finals</h2>";</script></head><body>
<h1>Spring <b>Meet</b></h1><p>Apr 21–24, 2025 scm</p><!-- Access -->
<h2>Men's Semifinals</h2><table><tr><td>1</td><td><a href="/swimmer/7">Ana  LeeFrance</a></td><td>200 IM</td><td>1:02:03.50</td></tr>
<tr><td>2</td><td>x</td></tr></table>
<h3>Finals</h3><div><table><tr><td>1</td><td>50 Free</td><td>100 Fly</td><td>59.10</td><td>LCM</td><td>May 1, 2025</td></tr></table></div>
<a href="/event/1">One</a><a href="/event/1">One</a><a href="/event/2">Free Relay</a><a href="mailto:a">m</a></body></html>"""


def test_page(spark):
    from laptrace.operators import pages as P

    df = spark.createDataFrame([(1, "/r/1", PAGE), (2, "/r/2", "<h1>403 Forbidden</h1>")], "page_id int, url string, html string")
    out = [tuple(r) for r in P.race_records(df).orderBy("table_pos").collect()]
    assert out == [
        (1, "/r/1", "Spring Meet", 0, 0, "Ana Lee", "200 IM", 3723.5, "SCM", "Apr 21–24, 2025"),
        (1, "/r/1", "Spring Meet", 1, 0, None, "100 Fly", 59.1, "LCM", "May 1, 2025")]
    links = P.links(df, "https://b.example", ["/none/", "/event/"]).orderBy("page_id").collect()
    assert [r["links"] for r in links] == [["https://b.example/event/1"], []]
    sessions = P.sessions_to_read(P.with_sessions(df)).orderBy("page_id").collect()
    assert [sorted(r["to_read"]) for r in sessions] == [["finals", "semifinals"], []]
    text = df.where("page_id = 1").select(markup.plain_text(F.col("html")).alias("t")).first()["t"]
    assert "var a" not in text and "Access" not in text and text.startswith("T Spring Meet Apr 21–24, 2025 scm")


def test_entities(spark):
    assert apply_all(spark, markup.unescape, "a&#8211;b &#x27;c&#x27; &eacute; &amp;lt; &nope; &#0; & x", None) == [
        "a–b 'c' é &lt; &nope; &#0; & x", None]


def test_text_of_untidy_pages(spark):
    assert apply_all(spark, markup.plain_text, "<script>x</script >y<p title='a>b'>t</p><!-- open <b>z",
                  "a<style>p{}</style>b<script>open") == ["y t", "a b"]


def test_links_in_every_quoting(spark):
    page = "<a href='/x'>1</a><a href=/y>2</a><A HREF = \"/z\">3</a ><a href=\"/open\">no<a class=c href=\"/w\"><b>4</b></a>"
    assert [tuple(a) for a in apply_all(spark, markup.anchors, page)[0]] == [("/x", "1"), ("/y", "2"), ("/z", "3"), ("/w", "4")]


def test_untidy_tables(spark):
    page = ("<!-- <table><tr><td>c</table> --><table><tr><td>o<table><tr><td>i</table></td></tr></table>"
            "<table><tr><td>1<tr><td>2</tr></table ><table>")
    read = lambda c: F.transform(markup.tables(c), markup.rows)
    assert apply_all(spark, read, page) == [[["<td>i"], ["<td>1", "<td>2"]]]


@pytest.mark.parametrize("text, found, day", [
    ("x Jul 27–Aug 4, 2024 y", "Jul 27–Aug 4, 2024", "2024-07-27"), ("Jul 27 – 28, 2024", "Jul 27 – 28, 2024", "2024-07-27"),
    ("on 27 July 2024.", "27 July 2024", "2024-07-27"), ("April 21, 2025 LCM", "April 21, 2025", "2025-04-21"),
    ("no day", None, None)])
def test_header_dates_are_read_as_race_dates(spark, text, found, day):
    assert apply_all(spark, dates.first_date_text, text) == [found]
    assert [d and str(d) for d in apply_all(spark, lambda c: dates.race_date(dates.first_date_text(c)), text)] == [day]


def test_a_name_is_no_event(spark):
    read = lambda c: markup.last_cell(c, markup.EVENT_CELL)
    assert apply_all(spark, read, "Kim Backman", "1\x1f50 Free\x1fKim Backman") == [None, "50 Free"]


@pytest.mark.parametrize("part", ["<a href='/x'>", "<table><tr><td>x", "<script>a", "<!-- a", "<tr><td"])
def test_broken_pages_take_linear_time(spark, part):
    def took(size):
        page = part * (size // len(part))
        start = time.perf_counter()
        for fn in (lambda c: F.size(markup.lines(c)), markup.plain_text, lambda c: F.size(markup.anchors(c))):
            apply_all(spark, fn, page)
        return time.perf_counter() - start

    took(1000)
    small = took(100_000)
    assert took(400_000) < 5 * max(small, 2)


def test_rows_and_tables_of_odd_markup(spark):
    page = ("<TABLE a='<b>'>\n<tr class=x><td>1</tr >lost<TR><td>2<tr <tr><td>3</table x></tables><td>4</TABLE ><table><tr>"
            "<table><tr/><td>5</table>")
    read = lambda c: F.transform(markup.tables(c), markup.rows)
    assert apply_all(spark, read, page) == [[["<td>1", "<td>2", "", "<td>3</table x></tables><td>4"], ["<td>5"]]]


def test_costly_texts_are_mentioned_once():
    text = F.concat(F.lit("costly"), F.col("c"))
    for fn in (markup.plain_text, markup.inner_text, markup.unescape, markup.session_of, lookups.none_if_blank):
        assert str(fn(text)).count("costly") == 1
    assert str(markup.page_title(text)).count("costly") == 2  # a search for either tag
