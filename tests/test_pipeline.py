"""From pages to validated items, and the plans of the queries."""

import datetime
import re

import pytest

from parley.plans.pipeline import staged

SAID = "We will grow revenue by 18 to 20% in FY27. In Q3 FY26 we will see 5% growth."


def test_staged(spark):
    body = f"Moderator: Welcome.\n\nRavi Mehta: {SAID}\n\nKiran Shah: A question?\n\nRavi Mehta: {SAID}\n\nTara Iyer: Another?\n\nRavi Mehta: We should commission the plant with 10 MW by next year."
    pages = spark.createDataFrame([(1, 2, "MANAGEMENT: MR. RAVI MEHTA - Head"), (1, 3, body), (2, 3, None)], "doc int, page_no int, text string")
    calls = spark.createDataFrame([(1, datetime.date(2026, 5, 15)), (2, None)], "doc int, call_date date")
    r = staged(pages, calls)
    got = sorted((x["guidance_value"] or "", x["timeline"]) for x in r.items.collect())
    assert ("18-20", "FY27") in got and all(t != "Q3 FY26" for _, t in got) and len(got) == len(set(got))
    counts = r.counts()
    assert counts["chunks"] == 3 and counts["valid"] == len(got)
    assert {x["rule"] for x in r.rejected.collect()} == {"rule3"}
    assert staged(pages.limit(0), calls).items.count() == 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["acceleration_rank", "block_growth", "precision_recall", "item_chunks", "chunk_pages", "page_calls", "rejection_log", "series_splice", "p3_found"])
def test_no_pairs_of_everything(spark, small, name):
    from parley.queries import QUERIES

    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython", plan(QUERIES[name](spark, small)))


def test_scans_read_what_they_need(spark, small):
    from parley.queries import QUERIES

    p = plan(QUERIES["cap_cohort"](spark, small))
    assert "ReadSchema: struct<scrip:string,bse_mcap_cr:double>" in p and "Or(IsNull(bse_mcap_cr),LessThanOrEqual(bse_mcap_cr,5000.0))" in p
    p = plan(QUERIES["trailing_growth"](spark, small))
    assert "l_shipdate" not in p and "o_totalprice" not in p
