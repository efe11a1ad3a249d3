"""Scans, sinks, extraction and the stream."""

import datetime
import json

from pyspark.sql import functions as F

from parley.plans import extraction, scores
from parley.sources import scans, sinks
from parley.streaming.earliest import earliest_stream


def test_ground_truth(spark):
    text = 'id: 1\npassage: "we will grow"\nmetric: revenue_growth_pct\nguidance_value: "18-20"\npage_number: 4\n\n- id: 2\n- metric: commissioning_event\nguidance_value: null\ncredibility_scorable: true\n\nid: 3\nno metric here\n\n1. an old layout'
    r = scans.ground_truth(spark.createDataFrame([("d", text), ("e", ""), ("f", None)], "doc string, text string")).orderBy("id").collect()
    assert [(x["id"], x["metric"], x["guidance_value"], x["page_number"], x["credibility_scorable"]) for x in r] == [(1, "revenue_growth_pct", "18-20", 4, None), (2, "commissioning_event", None, None, True)]


def test_item_files(spark, tmp_path):
    (tmp_path / "asha.json").write_text(json.dumps({"call_period": "Q4 FY24", "items": [{"metric": "m", "guidance_value": "5"}, {"metric": "n"}]}))
    (tmp_path / "bare.json").write_text(json.dumps([{"metric": "k", "page_number": 3}]))
    got = sorted((r["slug"], r["call_period"], r["ord"], r["metric"], r["page_number"]) for r in scans.item_files(spark, str(tmp_path)).collect())
    assert got == [("asha", "Q4 FY24", 0, "m", None), ("asha", "Q4 FY24", 1, "n", None), ("bare", None, 0, "k", 3)]


def test_documents(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"%PDF one|two||four")
    (tmp_path / "b.pdf").write_bytes(b"<html>")
    files = scans.binary_files(spark, str(tmp_path))
    assert {(r["doc"], r["magic"]) for r in files.collect()} == {("a", "%PDF"), ("b", "<htm")}

    def reader(content):
        if not content.startswith(b"%PDF"):
            raise ValueError
        return [p.decode() or None for p in content[5:].split(b"|")]

    pages = scans.pdf_pages(files, reader)
    assert scans.whole_text(pages).collect()[0]["text"] == "[Page 1]\none\n\n[Page 2]\ntwo\n\n[Page 4]\nfour"
    assert scans.whole_text(pages, False, 2).collect()[0]["text"] == "onetwo"
    r = scans.first_text(pages, 2).first()
    assert (r["text"], r["pages"]) == ("one\ntwo", 4)


def test_feed(spark, tmp_path):
    rows = [{"SCRIP_CD": "1", "SLONGNAME": " Asha ", "NEWS_DT": "2024-05-01", "ATTACHMENTNAME": "x.pdf", "SUBCATNAME": "Earnings Call Transcript", "HEADLINE": "", "NSURL": "https://h/stock-share-price/asha-ltd/asha/1/"}, {"SCRIP_CD": "2", "ATTACHMENTNAME": "y.pdf", "SUBCATNAME": "Other", "HEADLINE": "Transcript of call", "NEWS_DT": "2024-05-02"}, {"SCRIP_CD": "3", "SUBCATNAME": "transcript"}]
    (tmp_path / "f.json").write_text("\n".join(map(json.dumps, rows)))
    f = scans.announcements(spark, str(tmp_path))
    assert [(r["scrip"], r["slug"], r["nse_ticker"], r["name"]) for r in scans.transcript_filings(f).collect()] == [("1", "asha-ltd", "asha", "Asha")]
    assert scans.transcript_filings(f, True).count() == 2
    known = spark.createDataFrame([("9",)], "scrip string")
    assert [r["scrip"] for r in scans.wrongly_tagged(f, known).collect()] == ["2"]


def test_masters_from_files(spark, tmp_path):
    (tmp_path / "e.csv").write_text("SYMBOL , NAME OF COMPANY, ISIN NUMBER\n ASHA , Asha Ltd ,IN1\n,none,IN2\n")
    r = scans.exchange_master(spark, str(tmp_path / "e.csv"), "csv").collect()
    assert [(x["ticker"], x["isin"], x["exchanges"]) for x in r] == [("ASHA", "IN1", "NSE")]
    (tmp_path / "b.json").write_text(json.dumps({"SCRIP_CD": "5", "scrip_id": "A", "Mktcap": "2,53,727.5"}) + "\n" + json.dumps({"scrip_id": "B"}))
    r = scans.exchange_master(spark, str(tmp_path / "b.json"), "json").collect()
    assert [(x["scrip"], x["bse_mcap_cr"]) for x in r] == [("5", 253727.5)]


def test_windows_of_dates(spark):
    d = datetime.date
    df = spark.createDataFrame([(1, d(2024, 1, 1), d(2024, 2, 5)), (2, d(2024, 1, 1), d(2024, 1, 1)), (3, d(2024, 2, 1), d(2024, 1, 1)), (4, None, d(2024, 1, 1))], "k int, from date, to date")
    got = sorted((r["k"], r["start"], r["end"]) for r in scans.date_windows(df).collect())
    assert got == [(1, d(2024, 1, 1), d(2024, 1, 28)), (1, d(2024, 1, 29), d(2024, 2, 5)), (2, d(2024, 1, 1), d(2024, 1, 1))]


def test_company_page(spark):
    grid = "<section><h2> Profit &amp; Loss</h2><table><tr><th></th><th>Mar 2023</th><th>Mar 2024</th><th>TTM</th></tr><tr><td><b>Sales +</b></td><td>1,200</td><td>−5</td><td>9</td></tr><tr><td>Other</td><td>1</td><td>2</td></tr><tr><td>Net Profit +</td><td>10%</td><td></td></tr></table>"
    pages = spark.createDataFrame([("a", grid), ("b", "nothing"), ("c", None)], "key string, html string")
    got = sorted((r["key"], r["fy"], r["sales"], r["pat"]) for r in scans.profit_grid(pages, {"Sales": "sales", "Net Profit": "pat"}).collect())
    assert got == [("a", 2023, 1200.0, 10.0), ("a", 2024, -5.0, None)]
    calls = '<h2>Concalls</h2>x<b>Concalls</b><span>Concalls</span>>Concalls<<li class="flex flex-gap-8 y"><div>\n May 2024 </div><a href="u1">Transcript</a></li><li class="flex flex-gap-8"><div> Jul 2024 </div><div>Transcript</div></li><li class="flex flex-gap-8">none</li>'
    listed = scans.calls(spark.createDataFrame([("a", calls)], "key string, html string"))
    assert [(r["date"], r["quarter"], r["fy"], r["transcript_url"]) for r in listed.orderBy("ord").collect()] == [("2024-05", "Q4", 2024, "u1"), ("2024-07", "Q1", 2025, None)]
    assert scans.nearest_month(listed).count() == 1


def test_extraction(spark):
    chunks = spark.createDataFrame([(1, 1, "management", "We will grow revenue by 18 to 20% in FY27. Nothing else."), (1, 2, "moderator", "In FY27 we will see 5%."), (1, 3, "management", None)], "doc int, chunk_no int, role string, text string")
    items = extraction.extract(chunks)
    got = [(r["run_index"], r["guidance_value"], r["guidance_unit"], r["timeline"]) for r in items.orderBy("run_index").collect()]
    assert got == [(0, "18-20", "%", "FY27"), (1, "18-20", "%", "FY27")]
    assert extraction.merged(items).count() == 1

    def broken(texts, run):
        raise RuntimeError

    assert extraction.extract(chunks, broken).count() == 0
    lines = extraction.requests(spark.createDataFrame([(7, "said")], "doc int, text string"), "m", "Read: {transcript}", "{}").first()
    assert json.loads(lines["line"])["body"]["messages"][0]["content"] == "Read: said"
    assert spark.range(1).select(extraction.classify_metric(F.lit("capacity utilisation of the plant by FY27"), F.lit("%"))).first()[0] == "other_capacity_utilisation"


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.0, "cohort"), ("b", None, "unresolved")], "slug string, mcap double, status string")
    sinks.append(df, str(tmp_path / "t"))
    sinks.append(df, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 4
    sinks.cohort_files(df, str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c/all")).count() == 2
    sinks.json_by(df, str(tmp_path / "j"), "slug")
    assert spark.read.json(str(tmp_path / "j")).count() == 2
    sinks.enrich(df, spark.createDataFrame([("a", "x")], "slug string, sector string"), "slug", str(tmp_path / "e"))
    assert {r["sector"] for r in spark.read.parquet(str(tmp_path / "e")).collect()} == {"x", None}
    assert sinks.markdown(df).splitlines()[2] == "| a | 1.0 | cohort |" or "| b |" in sinks.markdown(df)


def test_scores(spark):
    t = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", float("-inf")), ("d", None)], "k string, v double")
    assert scores.top_overlap(t, t, "k", "v", 3).first()["shared"] == 2
    assert scores.composite(spark.createDataFrame([(1.0, 1.0, None, 1.0, True)], "credibility double, growth double, valuation double, acceleration double, promoter_buying boolean")).first()["score"] == 0.15 + 0.20 + 0.25 + 0.5


def test_stream(spark, tmp_path):
    rows = [("a", datetime.datetime(2024, 5, 2), 2), ("a", datetime.datetime(2024, 5, 1), 3), ("b", datetime.datetime(2024, 5, 3), 1)]
    df = spark.createDataFrame(rows, "scrip string, news_dt timestamp, filing_id int")
    df.write.parquet(str(tmp_path / "in"))
    s = earliest_stream(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), "scrip", "news_dt", "filing_id")
    q = s.writeStream.format("memory").queryName("earliest").outputMode("complete").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
    q.awaitTermination(120)
    assert {(r["scrip"], r["filing_id"]) for r in spark.table("earliest").collect()} == {("a", 3), ("b", 1)}
