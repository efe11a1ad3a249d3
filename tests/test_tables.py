"""Operators on tables: order, ties, nulls, empty tables, clashing names."""

import datetime
import re

import pytest
from pyspark.sql import functions as F

from parley.operators import cascade, dedup, match, segment, series, validate

# Published ranking of six companies, base figures of fiscal year 2024.
FUNDAMENTALS = [
    ("A", 624.0, 137.0, 21.96, 33.0, 30.13, "ok", -3.2), ("B", 8653.0, 1262.0, 14.58, 23.0, 19.29, "ok", 36.1), ("C", 94.0, 10.0, 10.64, 14.0, 13.83, "base_pat_nonpositive", None),
    ("D", 1805.0, 183.0, 10.14, 14.0, 12.85, "ok", 163.5), ("E", 421.0, 36.0, 8.55, 14.0, 11.88, "ok", 8.7), ("F", 4544.0, 290.0, 6.38, 15.0, 8.65, "base_pat_nonpositive", None),
]
ITEMS = {
    "A": [("revenue_growth_pct", "13-16", "%", None, "FY25"), ("ebitda_margin_pct", "33", "%", None, "FY25"), ("revenue_absolute", "1000", "crores", "INR", "FY29")],
    "B": [("revenue_growth_pct", "18-20", "%", None, "FY25"), ("ebitda_margin_pct", "25", "%", None, "FY25")],
    "C": [("net_margin_pct", "10-13", "%", None, "FY25"), ("revenue_growth_pct", "40-50", "%", None, "FY25"), ("revenue_absolute", "140-150", "crores", "INR", "FY25"), ("revenue_growth_pct", "50", "%", None, "FY28-FY30"), ("revenue_growth_pct", "30-35", "%", None, "FY26-FY30")],
    "D": [("revenue_growth_pct", "60", "%", None, "FY25"), ("ebitda_margin_pct", "15", "%", None, "FY25"), ("ebitda_margin_pct", "14.5-15", "%", None, "FY29"), ("revenue_absolute", "1", "billion", "USD", "FY28"), ("ebitda_margin_pct", "15", "%", None, "FY28"), ("net_margin_pct", "10", "%", None, "FY28")],
    "E": [("revenue_growth_pct", "15", "%", None, "FY25"), ("ebitda_margin_pct", "14", "%", None, "FY25"), ("revenue_absolute", "1000", "crore", "INR", "FY28"), ("revenue_growth_pct", "20-25", "%", None, "FY27")],
    "F": [("revenue_growth_pct", "10-15", "%", None, "FY25"), ("revenue_growth_pct", "20-25", "%", None, "FY26"), ("revenue_absolute", "25000", "crores", "INR", "FY25"), ("ebitda_margin_pct", "14", "%", None, "FY25"), ("revenue_growth_pct", "20", "%", None, "FY27"), ("pat_growth_pct", "10-15", "%", None, "FY25")],
}
RANKED = [
    ("A", 13.0, 16.0, 9.9, 9.9, "near", 16.2, 19.2), ("E", 15.0, 15.0, 24.1, 24.1, "long", 15.4, 15.4), ("B", 18.0, 30.4, None, None, "near", -18.1, -5.7),
    ("D", 60.0, 71.5, 46.6, 49.2, "near", -103.5, -92.0), ("C", 49.0, 59.6, 50.0, 50.0, "long", None, None), ("F", 10.0, 15.0, 20.0, 25.0, "long", None, None),
]


def frames(spark):
    items = [(c, n, *i, "company", 1) for c, rows in ITEMS.items() for n, i in enumerate(rows)]
    items = spark.createDataFrame(items, "company string, ord int, metric string, value string, unit string, currency string, timeline string, level string, page int")
    from parley.operators import fiscal

    items = items.withColumn("block", cascade.block_of(fiscal.horizon(F.col("timeline"), F.lit(2024))))
    f = spark.createDataFrame(FUNDAMENTALS, "company string, current_revenue double, current_pat double, net_margin double, ebitda_margin double, pbt_margin double, status string, pat_cagr double")
    return items, f.withColumns({"call_fy": F.lit(2024), "usdinr": F.lit(83.4), "forward_pe": F.lit(30.0)})


def test_acceleration_golden(spark):
    items, f = frames(spark)
    r = cascade.acceleration(items, f)
    got = [tuple(x) for x in r.select("company", "near_base", "near_bull", "long_base", "long_bull", "fwd_horizon", "accel_base", "accel_bull").collect()]
    assert got == RANKED


def test_plain_cascade(spark):
    items = spark.createDataFrame([("X", 1, "revenue_absolute", "1000", "crore", "INR", "FY28", "company", 1), ("X", 2, "ebitda_margin_pct", "22", "%", None, "FY28", "company", 1)], "company string, ord int, metric string, value string, unit string, currency string, timeline string, level string, page int").withColumn("block", F.lit("long"))
    f = spark.createDataFrame([("X", 631.0, 64.0, 10.14, 19.0, 12.0, 2026, 30.0)], "company string, current_revenue double, current_pat double, net_margin double, ebitda_margin double, pbt_margin double, call_fy int, forward_pe double")
    r = cascade.block_growth(items, f, False).first()
    assert r["bull"] == pytest.approx(35.4, abs=0.1)
    v = cascade.forward_valuation(items, f).first()
    assert v["forward_peg"] == round(30.0 / r["base"], 2)


def test_cascade_of_nothing(spark):
    items, f = frames(spark)
    assert cascade.block_growth(items.limit(0), f, True).count() == 0
    assert cascade.acceleration(items.limit(0), f).where("accel_base is null").count() == 6
    assert cascade.block_growth(items.withColumn("value", F.lit(None).cast("string")), f, True).count() == 0


def test_earliest_with_ties_and_nulls(spark):
    rows = [("a", None, 1), ("a", 5, 3), ("a", 5, 2), (None, 1, 9), ("b", None, 4)]
    df = spark.createDataFrame(rows, "k string, t int, o int").withColumn("value", F.lit("extra"))
    got = {(r["k"], r["t"], r["o"]) for r in dedup.earliest(df, "k", "t", "o").collect()}
    assert got == {("a", 5, 2), (None, 1, 9), ("b", None, 4)}
    assert dedup.earliest(df.limit(0), "k", "t", "o").count() == 0


def test_best_passage(spark):
    rows = [("c", 1, "m", "18-20", "FY28", "company", "long text without the year at all"), ("c", 2, "m", "20-18.0", " fy28", "company", "by 2028"), ("c", 3, "m", "18-20", "FY28", "segment", None), ("c", 4, "m", None, None, None, None), ("c", 5, "m", None, None, None, None)]
    df = spark.createDataFrame(rows, "company string, ord int, metric string, value string, timeline string, level string, passage string")
    got = sorted(tuple(r)[1:2] + (r["group_order"],) for r in dedup.best_passage(df, ["company"], "metric", "value", "timeline", "level", "passage", "ord").collect())
    assert got == [(2, 1), (3, 3), (4, 4)]


def test_masters(spark):
    a = spark.createDataFrame([("1", "X"), ("2", None)], "scrip string, isin string")
    b = spark.createDataFrame([("", "X"), ("", "Y"), ("", None), ("", ""), ("", "Y")], "scrip string, isin string")
    got = sorted((r["scrip"], r["isin"] or "") for r in dedup.union_masters(a, b).collect())
    assert got == [("", ""), ("", ""), ("", "Y"), ("", "Y"), ("1", "X"), ("2", "")]


@pytest.mark.parametrize("n", [1, 7, 37, 100, 300])
def test_stride(spark, n):
    df = spark.range(100).select((F.col("id") * 7919 % 100).alias("x"), F.lit(1).alias("y"))
    step = 100 / n
    expected = sorted({min(99, int(i * step)) for i in range(n)}) if n < 100 else list(range(100))
    assert sorted(r["x"] for r in dedup.stride_sample(df, n, ["x"]).collect()) == expected
    assert dedup.stride_sample(df.limit(0), n, ["x"]).count() == 0


def test_trailing_statuses(spark):
    rows = [("a", 2024, 100.0, 20.0), ("a", 2021, 50.0, 10.0), ("b", 2024, 100.0, 5.0), ("b", 2021, 90.0, -1.0), ("c", 2024, 0.0, 5.0), (None, 2024, 1.0, 1.0)]
    r = {x["company"]: x for x in series.base_and_trailing(spark.createDataFrame(rows, "company string, fy int, sales double, net_profit double"), "company", 2024).collect()}
    assert (r["a"]["status"], r["a"]["pat_cagr"], r["a"]["net_margin"]) == ("ok", 26.0, 20.0)
    assert (r["b"]["status"], r["b"]["pat_cagr"]) == ("base_pat_nonpositive", None) and r["c"]["status"] == "missing" and r["c"]["net_margin"] is None


RULES = "doc int, ord int, chunk_id string, metric string, value string, unit string, timeline string, passage string, page int"


def checked(spark, rows):
    df = spark.createDataFrame([(1, n, "c", *r, 1) for n, r in enumerate(rows)], RULES)
    return validate.apply_rules(df.withColumns({"call_date": F.lit(datetime.date(2026, 5, 15)), "transcript": F.lit("We said  this is told\nhere")}))


def test_rules(spark):
    rows = [("m", None, "%", "FY27", "p"), ("m", "high teens", "%", "FY27", "p"), ("m", "5", "%", "Q3 FY26", "p"), ("commissioning_event", "12", None, "FY27", "this is told here"), ("m", "~5 to 6%", "%", "next year", "p"), ("m", "5", "%", "someday", None), ("m", "5", "%", None, "p")]
    got = [(r["rule"], r["clean_value"], r["clean_timeline"]) for r in checked(spark, rows).orderBy("ord").collect()]
    assert [g[0] for g in got] == ["rule1", "rule2", "rule3", None, None, None, None]
    assert got[3] == (None, None, "FY27") and got[4] == (None, "5-6", "FY28") and got[5][2] == "someday"
    assert [r["found_verbatim"] for r in checked(spark, rows).orderBy("ord").collect()][3] is True
    assert validate.rejections(checked(spark, rows)).count() == 3
    assert validate.rejections(checked(spark, rows).limit(0)).count() == 0


def test_two_passes_of_repeats(spark):
    base = "Our plant in the north will add five hundred crore of revenue next year"
    rows = [("m", "5", "%", "FY27", base), ("m", "5.0", "%", "FY27", base + " now"), ("m", "6", "%", "FY27", base + " as said"), ("m", "7", "%", "FY28", base), ("m", "5", "%", "FY27", "short")]
    c = checked(spark, rows)
    kept = {r["ord"]: r["kept"] for r in validate.exact_repeats(c).collect()}
    assert kept == {0: False, 1: True, 2: True, 3: True, 4: False}
    fold = {r["ord"]: r["kept_as"] for r in validate.fuzzy_repeats(validate.exact_repeats(c)).collect()}
    assert fold == {1: 2, 2: 2, 3: 3}


def test_greedy_and_two_pass(spark):
    s = "doc string, ord int, metric string, timeline string, mid double, lo double, hi double, years array<int>, passage string"
    ref = spark.createDataFrame([("d", 1, "m", "FY27", 10.0, 10.0, 10.0, [2027], "alpha beta gamma"), ("d", 2, "m", "FY27", 10.5, 10.5, 10.5, [2027], "x"), ("d", 3, "k", "", None, None, None, [], "the plant will be commissioned soon")], s)
    fnd = spark.createDataFrame([("d", 1, "m", "FY27", 10.9, 10.9, 10.9, [2027], "q"), ("d", 2, "m", "FY27", 9.5, 9.5, 9.5, [2027, 2028], "r"), ("d", 3, "z", "", None, None, None, [], "the plant will be commissioned very soon")], s)
    assert sorted((r["ref_ord"], r["found_ord"]) for r in match.greedy_pairs(ref, fnd).collect()) == [(1, 1), (2, 2)]
    assert sorted((r["ref_ord"], r["found_ord"], r["kind"]) for r in match.two_pass_pairs(ref, fnd).collect()) == [(1, 1, "strict"), (2, 2, "strict"), (3, 3, "soft")]
    pr = match.precision_recall(match.greedy_pairs(ref, fnd), ref, fnd).first()
    assert (pr["recall"], pr["precision"]) == (2 / 3, 2 / 3)
    assert match.greedy_pairs(ref.limit(0), fnd).count() == 0 and match.two_pass_pairs(ref.limit(0), fnd).count() == 0
    assert match.precision_recall(match.greedy_pairs(ref.limit(0), fnd), ref.limit(0), fnd).first()["recall"] == 0.0


def test_similarity_is_difflib(spark):
    df = spark.createDataFrame([("tide", "diet"), ("diet", "tide"), (None, None), ("x" * 3000, "x" * 3000)], "a string, b string")
    assert [r[0] for r in df.select(match.passage_similarity(F.col("a"), F.col("b"))).collect()] == [0.25, 0.5, 1.0, 1.0]
    assert match.similarity_above("tide", "diet", 0.2) == 0.25 and match.similarity_above("tide", "diet", 0.25) == 0.0


def test_pages_and_offsets(spark):
    pages = spark.createDataFrame([(1, 3, "abcde"), (1, 4, ""), (1, 5, "xyz")], "doc int, page_no int, text string")
    b = sorted((r["page_no"], r["start"], r["end"]) for r in segment.page_bounds(pages).collect())
    assert b == [(3, 0, 5), (4, 6, 6), (5, 7, 10)]
    offs = spark.createDataFrame([(1, x) for x in (0, 4, 5, 6, 7, 9, 99)], "doc int, offset long")
    got = {r["offset"]: r["page_no"] for r in segment.page_of(offs, segment.page_bounds(pages)).collect()}
    assert got == {0: 3, 4: 3, 5: 5, 6: 5, 7: 5, 9: 5, 99: 5}


TURNS = "doc int, turn_no int, speaker string, role string, text string"


def test_sessions_and_chunks(spark):
    rows = [("Op", "moderator", "hello"), ("M1", "management", "w " * 400), ("M2", "management", "w " * 300), ("Op", "moderator", "next question"), ("A", "analyst", "q"), ("M1", "management", "a"), ("Op", "moderator", "follow"), ("A", "analyst", "q2"), ("Op", "moderator", "next"), ("B", "analyst", "q"), ("M2", "management", "a"), ("Op", "moderator", "bye")]
    df = spark.createDataFrame([(1, n, *r) for n, r in enumerate(rows)], TURNS)
    got = [r["session"] for r in segment.sessions(df).orderBy("turn_no").collect()]
    assert got == [None, None, None, 1, 1, 1, 1, 1, 2, 2, 2, 2]
    c = [(r["chunk_no"], r["chunk_type"], r["speaker"], r["analyst_speaker"], r["n_turns"]) for r in segment.build_chunks(segment.chunk_turns(df)).orderBy("chunk_no").collect()]
    assert c == [(1, "opening_remarks", "M1", None, 2), (2, "opening_remarks", "M2", None, 1), (3, "qa_session", "M1", "A", 5), (4, "qa_session", "M2", "B", 4)]
    assert segment.build_chunks(segment.chunk_turns(df.limit(0))).count() == 0


def test_segmenter(spark):
    body = "Page 3 of 9\nAsha Works Limited\nModerator: Welcome to the call.\n\nRavi Mehta: We grew. It\nwas good.\n\nNote: not a speaker here\n\nKiran Shah: A question?\n\nRavi Mehta: An answer.\n\nTara Iyer: Another?\n\nMehta: Yes."
    pages = [(1, 2, "MANAGEMENT: MR. RAVI MEHTA - Head\nMODERATOR: MS. TINA DAS - Host"), (1, 3, body), (2, 3, "no speakers at all"), (3, 3, None)]
    df = spark.createDataFrame(pages, "doc int, page_no int, text string")
    got = [(r["doc"], r["chunk_type"], r["analyst_speaker"], r["text"]) for r in segment.segment(df).orderBy("doc", "chunk_no").collect()]
    assert [g[:3] for g in got] == [(1, "opening_remarks", None), (1, "qa_session", "Kiran Shah"), (1, "qa_session", "Tara Iyer"), (2, "management_solo", None)]
    assert "Management (Ravi Mehta): We grew. It was good." in got[0][3] and "Management (Mehta): Yes." in got[2][3]


def test_every_query_runs_on_the_smallest_tables(spark, small):
    from parley.queries import QUERIES, SQL

    assert set(SQL) <= set(QUERIES)
    for name in ("driver_ladder", "series_splice", "segmented_pages", "extracted_items", "union_of_runs", "best_matches"):
        QUERIES[name](spark, small).count()


def test_core_needs_no_text_subpackage():
    import pathlib

    root = pathlib.Path(__file__).resolve().parents[1]
    for p in (root / "parley").rglob("*.py"):
        if "llm" not in p.relative_to(root).parts:
            assert not re.search(r"(?:import|from)\s+\S*\bllm\b", p.read_text()), p
