"""Queries over small tables of their own: nothing of a call or page is left out."""

import datetime

import pytest

from parley.operators import segment
from parley.plans.pipeline import staged
from parley.queries import QUERIES
from parley.sources import scans

GUIDANCE = "call_id bigint, guidance_id bigint, metric string, timeline string, guidance_value string, passage string, horizon string, level string, track string, credibility_scorable boolean"
CHUNKS = "chunk_key bigint, call_id bigint, chunk_id string, char_start int, text string"
ITEMS = "scrip string, guidance_id bigint, metric string, guidance_value string, guidance_unit string, currency string, timeline string, level string, horizon string, page_number int, passage string, call_id bigint"


@pytest.fixture
def tables(spark, tmp_path):
    def write(**tables):
        for name, (rows, schema) in tables.items():
            spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write


def guidance(*rows):
    return [(*r, "near", "company", "A", True) for r in rows], GUIDANCE


def test_best_match_under_another_metric_and_timeline(spark, tables):
    said = "The plant in the north will be commissioned by the end of the year"
    d = tables(guidance_items=guidance((1, 2, "revenue_growth_pct", "FY27", "5", said), (1, 3, "commissioning_event", "FY28", None, said + " as planned"), (2, 5, "revenue_growth_pct", "FY27", "5", said)))
    assert [tuple(r)[:4] for r in QUERIES["best_matches"](spark, d).collect()] == [(1, 2, 3, "contained")]


def test_two_passes_over_a_whole_call(spark, tables):
    said = "The plant in the north will be commissioned by the end of the year"
    d = tables(guidance_items=guidance((1, 2, "m", "FY27", "10", "alpha"), (1, 3, "m", "FY26-FY27", "10.5", "beta"), (1, 4, "k", "FY28", "7", said), (1, 5, "z", "soon", None, said + " now"), (2, 7, "m", "FY27", "10", "alpha")))
    assert sorted(tuple(r) for r in QUERIES["two_pass_match"](spark, d).collect()) == [(1, 2, 3, "strict"), (1, 4, 5, "soft")]


def test_passages_are_looked_up_in_the_whole_transcript(spark, tables):
    item = lambda n, passage, call: ("s", n, "m", "5", "%", None, "FY27", "company", "near", 1, passage, call)
    d = tables(
        filings=([(1, datetime.date(2026, 5, 15)), (2, datetime.date(2026, 5, 15))], "call_id bigint, call_date date"),
        chunks=([(9, 1, "chunk_001", 0, "We begin."), (3, 1, "chunk_002", 10, "Sales will  grow"), (4, 1, "chunk_003", 30, "by a fifth.\nThank you."), (5, 1, "chunk_002", 10, "Sales will  grow")], CHUNKS),
        guidance_items=([item(1, "We begin.", 1), item(2, "Sales will grow", 1), item(3, "will grow by a fifth. Thank you.", 1), item(4, "nobody said so", 1), item(5, "We begin.", 2)], ITEMS),
    )
    assert {r["ord"]: r["found_verbatim"] for r in QUERIES["validation"](spark, d).collect()} == {1: True, 2: True, 3: True, 4: False, 5: None}


def test_the_pipeline_looks_passages_up(spark):
    pages = spark.createDataFrame([(1, 3, "Welcome. We will grow revenue by 18 to 20%"), (1, 4, "in FY27. Thank you.")], "doc int, page_no int, text string")
    calls = spark.createDataFrame([(1, datetime.date(2026, 5, 15))], "doc int, call_date date")
    passages = lambda texts, run: [[{"passage": p, "metric_description": "revenue growth", "guidance_value": v, "guidance_unit": "%", "timeline": "FY27"} for p, v in (("We will grow revenue by 18 to 20%", "18-20"), ("made up", "7"))] for _ in texts]
    assert {(r["passage"], r["found_verbatim"]) for r in staged(pages, calls, passages).items.collect()} == {("We will grow revenue by 18 to 20%", True), ("made up", False)}


def test_passages_part_from_their_own_chunk(spark, tables):
    d = tables(
        chunks=([(1, 1, "chunk_001", 0, "one two three four five six"), (3, 1, "chunk_002", 9, "we will grow sales by a fifth next year"), (2, 1, "chunk_002", 9, "we will grow sales by a third next year"), (4, 2, "chunk_002", 0, "other words")], CHUNKS),
        raw_items=([(1, 1, "chunk_002", "will grow sales by a fifth next year"), (2, 1, "chunk_001", "one two three four five six"), (3, 1, "chunk_009", "one two three four five six")], "item_id bigint, call_id bigint, chunk_id string, passage string"),
    )
    assert sorted(tuple(r)[:2] for r in QUERIES["passage_divergence"](spark, d).collect()) == [(1, 5), (2, 6), (3, -1)]


def test_the_whole_passage_stands_in_the_chunk(spark, tables):
    d = tables(
        chunks=([(1, 1, "chunk_001", 0, "We said so. Capex is Rs. 7 crore. Sales fall."), (2, 1, "chunk_002", 50, "We said so. Capex is  Rs. 9 crore – this year.\nWe’ll tell more.")], CHUNKS),
        raw_items=([(1, 1, "We said so. Capex is Rs. 9 crore - this year."), (2, 1, "Capex is Rs. 8 crore."), (3, 1, "Ravi Mehta: Capex is Rs. 9 crore\nTara Iyer: …We'll tell more."), (4, 1, "sales fall.")], "item_id bigint, call_id bigint, passage string"),
    )
    assert sorted(tuple(r) for r in QUERIES["item_chunks"](spark, d).collect()) == [(1, 2), (2, None), (3, 2), (4, 1)]


def test_all_calls_of_a_long_page(spark):
    li = lambda year: f'<li class="flex flex-gap-8 x"><div> May {year} </div><a href="https://x.invalid/{year}"> Transcript </a></li>'
    html = "<h2>Concalls</h2><ul>" + li(2024) * 300 + li(2025) + "</ul><h3 class='b'>Announcements</h3><ul>" + li(2026) + "</ul>"
    got = scans.calls(spark.createDataFrame([("k", html), ("none", "<h2>Filings</h2>" + li(2024))], "key string, html string"))
    assert got.count() == 301 and [tuple(r)[:3] for r in got.where("date >= '2025'").collect()] == [("k", 300, "2025-05")]


def test_closing_moderators_of_a_call_without_analysts(spark):
    rows = [(1, 0, "Op", "moderator", "hello"), (1, 1, "M", "management", "we grew"), (1, 2, "Op", "moderator", "no questions"), (1, 3, "Op", "moderator", "goodbye"), (2, 0, "Op", "moderator", "alone")]
    t = spark.createDataFrame(rows, "doc int, turn_no int, speaker string, role string, text string")
    assert [(r["doc"], r["chunk_no"], r["n_turns"], "goodbye" in r["text"]) for r in segment.build_chunks(segment.chunk_turns(t)).collect()] == [(1, 1, 4, True)]
