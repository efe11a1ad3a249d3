"""Golden values of the scalar operators."""

import datetime

import pytest
from pyspark.sql import functions as F

from parley.operators import fiscal, text, values


def one(spark, column, **row):
    """The value of a column over one row of literals."""
    df = spark.range(1)
    for k, v in row.items():
        df = df.withColumn(k, F.lit(v) if v is not None else F.lit(None).cast("string"))
    r = df.select(column.alias("x")).first()["x"]
    return tuple(r) if hasattr(r, "asDict") else r


@pytest.mark.parametrize("value,expected", [("18-20", (18.0, 20.0)), ("3,000", (3000.0, 3000.0)), ("high single digit", (None, None)), ("20–18", (20.0, 18.0)), ("", (None, None)), (None, (None, None)), ("2x", (None, None))])
def test_bounds(spark, value, expected):
    assert one(spark, values.bounds(F.col("v")), v=value) == expected


def test_bounds_of_multiples(spark):
    assert one(spark, values.bounds(F.col("v"), True), v="1.5-2x") == (1.5, 2.0)


@pytest.mark.parametrize("line,expected", [("FY28-29", (2028, 2029)), ("H1 FY27", (2027, 2027)), ("FY2027-FY25", (2025, 2027)), ("next year", (None, None)), (None, (None, None))])
def test_year_range(spark, line, expected):
    assert one(spark, fiscal.year_range(F.col("v")), v=line) == expected


@pytest.mark.parametrize("line,years", [("FY27", 1.0), ("H1 FY27", 0.5), ("FY26", 0.25), ("Q1 FY27", 0.25), ("Q3 FY28", 1.75)])
def test_years(spark, line, years):
    assert one(spark, fiscal.years_until(fiscal.year_range(F.col("v"))["hi"], F.lit(2026), F.col("v")), v=line) == years


def test_margin_bridge(spark):
    m = lambda hi: round(one(spark, values.net_margin_equivalent(F.lit(hi), F.lit("ebitda_margin_pct"), F.lit(8.0), F.lit(19.0), F.lit(None).cast("double"))), 4)
    assert m(25.0) == 0.1053
    assert m(15.0) == 0.08
    assert one(spark, values.net_margin_equivalent(F.lit(15.0), F.lit("ebitda_margin_pct"), F.lit(8.0), F.lit(None).cast("double"), F.lit(None).cast("double"))) == 0.08


@pytest.mark.parametrize("value,timeframe,low,high", [("2", "in 3 years", 0.26, 0.26), ("3-4", "over four years", 0.316, 0.414), ("3", "by FY27", 0.442, 0.442)])
def test_multiples_annualised(spark, value, timeframe, low, high):
    r = one(spark, values.forward_growth(F.lit("revenue_multiple"), F.col("v"), F.lit("times"), F.col("t"), F.lit("INR")), v=value, t=timeframe)
    assert r[0] == "ok" and r[1] == pytest.approx(low, abs=0.001) and r[2] == pytest.approx(high, abs=0.001)


def test_growth_statuses(spark):
    g = lambda m, v, u, c="INR": one(spark, values.forward_growth(F.lit(m), F.col("v"), F.lit(u), F.lit("FY27"), F.lit(c)), v=v)[::3]
    assert g("none", "5", "%") == ("none", None)
    assert g("x", "low teens", "%") == ("unparseable", "value")
    assert g("x", "1000", "billion", "USD") == ("unparseable", "absurd")
    assert g("x", "5", "crore") == ("needs_base", None)
    assert g("x", "5", "MW") == ("unparseable", "unit")


DAY = datetime.date(2026, 5, 15)


@pytest.mark.parametrize(
    "raw,expected",
    [("FY27", "FY27"), ("FY2027", "FY27"), ("2026-27", "FY27"), ("by 2028", "FY28"), ("Q2 FY27", "Q2 FY27"), ("second half of FY28", "H2 FY28"), ("next quarter", "Q2 FY27"), ("this quarter", "Q1 FY27"), ("end of this fiscal year", "FY27"), ("next year", "FY28"), ("H1", "H1 FY27"), ("Q4", "Q4 FY27"), ("FY28-FY29", "FY28"), ("over time", "over time"), ("H1FY27", "H1 FY27"), ("", "")],
)
def test_normalize_timeline(spark, raw, expected):
    assert one(spark, fiscal.normalize_timeline(F.col("v"), F.lit(DAY)), v=raw) == expected


@pytest.mark.parametrize("line,end", [("FY27", (2027, 3, 31)), ("H1 FY27", (2026, 9, 30)), ("H2 FY27", (2027, 3, 31)), ("Q1 FY27", (2026, 6, 30)), ("Q3 FY27", (2026, 12, 31)), ("Q4 FY27", (2027, 3, 31)), ("someday", None)])
def test_timeline_end(spark, line, end):
    assert one(spark, fiscal.timeline_end(F.col("v")), v=line) == (end and datetime.date(*end))


def test_calendar(spark):
    assert one(spark, fiscal.fiscal_year2(F.lit(DAY))) == 27 and one(spark, fiscal.fiscal_quarter(F.lit(DAY))) == 1
    assert one(spark, fiscal.reported_quarter(F.lit(DAY))) == ("Q4", 2026)
    assert one(spark, fiscal.reported_quarter(F.lit(datetime.date(2025, 8, 1)))) == ("Q1", 2026)
    assert one(spark, fiscal.base_year(F.col("v")), v="Q4 FY24") == 2024 and one(spark, fiscal.base_year(F.col("v")), v="Q2 FY25") == 2024 and one(spark, fiscal.base_year(F.col("v")), v=None) == 2024


@pytest.mark.parametrize("day,rate", [("2024-05-15", 83.4), ("2018-10-12", 72.6), ("2013-09-01", 61.5), ("2009-01-01", 54.3), ("2031-01-01", 86.5), ("soon", 83.4), (None, 83.4)])
def test_rates(spark, day, rate):
    assert one(spark, fiscal.usdinr_on(F.col("v")), v=day) == rate


@pytest.mark.parametrize("raw,expected", [("18", "18"), ("~18", "18"), ("about 18 to 20", "18-20"), ("18%", "18"), ("18-20", "18-20"), ("high teens", None), ("≥ 5.5%", "5.5")])
def test_clean_value(spark, raw, expected):
    assert one(spark, values.clean_value(F.col("v")), v=raw) == expected


@pytest.mark.parametrize("raw,expected", [("20-18.04", "18.0-20.0"), ("18.0-20.0", "18.0-20.0"), ("Low Teens ", "low teens"), (None, None), ("1,000", "1000.0")])
def test_value_key(spark, raw, expected):
    assert one(spark, values.value_key(F.col("v")), v=raw) == expected


def test_titles(spark):
    q = lambda t: one(spark, fiscal.detect_quarter(F.col("v")), v=t)
    assert q("Q4 & FY24 Earnings Conference Call") == ("Q4", "FY24")
    assert q("call for the third quarter FY 2023-24") == ("Q3", "FY24")
    assert q("for the quarter ended June 30, 2024") == ("Q1", "FY25")
    assert q("a talk") == (None, None)


def test_page_stripping(spark):
    page = "\n Asha Works Limited\nMay 5, 2025\n\nHello there\nOmega Limited\nmore\n\nPage 3 of 9\n 12 |\n"
    assert one(spark, text.strip_page(F.col("v")), v=page) == "Hello there\nOmega Limited\nmore"
    assert one(spark, text.strip_page(F.col("v")), v="Asha Works Limited\n\n") == ""
    assert one(spark, text.strip_page(F.col("v")), v="") == "" and one(spark, text.strip_page(F.col("v")), v=None) is None


def test_classifier(spark):
    c = lambda t, p: one(spark, text.classify_transcript(F.col("v"), F.lit(p)), v=t)
    assert c("", 5) == "NEEDS_OCR"
    assert c("moderator: welcome " + "x" * 500, 90) == "NOTTRANSCRIPT"
    assert c("ladies and gentlemen, the balance sheet as at " + "x" * 400, 20) == "OK"
    assert c("notice of the annual general meeting, conference call " + "x" * 400, 20) == "NOTTRANSCRIPT"
    assert c("our conference call " + "x" * 20000, 8) == "OK"
    v = lambda size, magic, p: one(spark, text.file_verdict(F.lit(size), F.lit(magic), F.lit(p), F.lit("moderator " + "x" * 500)))
    assert [v(0, "%PDF", 9), v(9, "<htm", 9), v(9, "%PDF", -1), v(9, "%PDF", 2), v(9, "%PDF", 9)] == ["MISSING", "BADPDF", "BADPDF", "COVER?", "OK"]


def test_filter_lexicon_is_by_parts_of_words(spark):
    r = lambda t: one(spark, text.filter_reasons(F.col("v")), v=t)
    assert r("maybe") == "temporal" and r("annually launched") == "temporal+commitment" and r("nothing here") == "" and r("5 plants") == "digit" and r(None) == ""


def test_small_texts(spark):
    assert one(spark, text.slug(F.col("v")), v="Asha & Sons Paints Ltd.") == "asha_sons_paints"
    assert one(spark, text.urls(F.col("v")), v="see https://a.in/x.pdf, (https://b.in/y) https://a.in/x.pdf.") == ["https://a.in/x.pdf", "https://b.in/y"]
    assert one(spark, text.first_pdf_link(F.col("v"), F.lit("https://a.in/b/c.html")), v="<a href='d/e.pdf'>") == "https://a.in/b/d/e.pdf"
    assert one(spark, text.first_pdf_link(F.col("v"), F.lit("https://a.in/b/c.html")), v='<a href="/e.pdf?x">') == "https://a.in/e.pdf?x"
    assert one(spark, text.year_in_passage(F.col("p"), F.col("t")), p="by '28 we will", t="FY28") is True
    assert one(spark, text.year_in_passage(F.col("p"), F.col("t")), p="by FY27", t="FY28") is False
    assert one(spark, text.speaker_parts(F.col("v")), v="Asha Rao: yes.\nR. Mehta: no") == ["yes.", "no"]
