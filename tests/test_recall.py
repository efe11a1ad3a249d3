"""Recall on two levels, call years, attachments, answers of a batch, cohorts, and the top against the median."""

import json

from pyspark.sql import functions as F

from parley.functions.binding import let
from parley.operators import cascade, dedup, match, segment
from parley.plans import extraction, scores

SIDE = "doc int, ord int, metric string, timeline string, mid double, text string, bare string"


def test_two_levels_and_reasons(spark):
    said = [f"the plant in town {x} will be commissioned by the end of the next year" for x in ("alpha", "bravo and beyond", "c", "delta delta")]
    ref = spark.createDataFrame([(1, 1, "m", "FY27", 10.0, said[0], ""), (1, 2, "m", "FY27", 20.0, said[1], ""), (1, 3, "m", "FY28", 5.0, "nothing of the kind was found", ""), (2, 4, "m", None, None, None, None)], SIDE)
    ext = spark.createDataFrame([(1, 11, "m", "FY27", 10.5, said[0] + " indeed", ""), (1, 12, "k", "FY27", 20.0, said[1], "")], SIDE)
    best = match.best_match(ref.withColumn("bare", F.lit("x")).drop("metric", "timeline", "mid"), ext.withColumn("bare", F.lit("y")).drop("metric", "timeline", "mid"))
    told = match.two_level_recall(best, match.greedy_pairs(ref, ext), ref, ext)
    assert {r["ord"]: tuple(r)[2:] for r in told.collect()} == {1: (True, True, None), 2: (True, False, "metric mismatch"), 3: (False, False, "passage not found"), 4: (False, False, "passage not found")}
    report = {r["doc"]: r for r in match.recall_report(told).collect()}
    assert (report[1]["items"], report[1]["gap"], report[1]["accepted"], report[2]["passage_recall"]) == (3, 1, False, 0.0)
    assert match.two_level_recall(best.limit(0), match.greedy_pairs(ref, ext).limit(0), ref.limit(0), ext).count() == 0


def test_best_match_ladder(spark):
    t = spark.createDataFrame([(1, 1, "alpha beta gamma delta", "q"), (1, 2, "one two three four five six", "w"), (1, 3, "entirely else", "e")], "doc int, ord int, text string, bare string")
    f = spark.createDataFrame([(1, 5, "alpha beta gamma delta epsilon", "a"), (1, 6, "alpha beta gamma", "b"), (1, 7, "one two three four five seven", "c")], "doc int, ord int, text string, bare string")
    assert {r["ord"]: (r["found_ord"], r["mode"]) for r in match.best_match(t, f).collect()} == {1: (5, "contained"), 2: (7, "similar")}


def test_call_year(spark):
    df = spark.createDataFrame([("acme_Q4_FY26", "Q4 FY25"), ("acme", "Q1 FY2025"), (None, None), ("acme_FY27", None)], "f string, h string")
    got = [tuple(r["y"]) for r in df.select(cascade.call_year(F.col("f"), F.col("h")).alias("y")).collect()]
    assert got == [(2026, "file", True), (2025, "header", False), (2026, "default", False), (2027, "file", False)]


def test_attachment_candidates(spark):
    rows = [("k", "a.pdf", "Audio recording of the transcript", 900), ("k", "b.pdf", "Transcript", 10), ("k", "b.pdf", "notice", 999), ("k", "c.pdf", "Transcript", 20), ("k", "d.mp3", "Audio recording", 5000), ("k", None, "Transcript", 1), ("n", "x.pdf", None, None)]
    df = spark.createDataFrame(rows, "key string, attachment string, headline string, size int")
    got = {(r["key"], r["place"]): r["attachment"] for r in dedup.attachment_candidates(df).collect()}
    assert got == {("k", 1): "c.pdf", ("k", 2): "b.pdf", ("k", 3): "a.pdf", ("k", 4): "d.mp3", ("n", 1): "x.pdf"}


def test_answers_of_a_batch(spark):
    item = {"candidate_id": 1, "passage": "p", "metric": "m", "guidance_value": None, "uncertain": True}
    body = lambda text, code=200: {"response": {"status_code": code, "body": {"output_text": text}}}
    lines = [json.dumps({"custom_id": "1"} | body(json.dumps({"company": "c", "candidates": [item, item]}))), json.dumps({"custom_id": "2"} | body("{}", 500)), json.dumps({"custom_id": "2"} | body("no json")), "not a line", json.dumps({"custom_id": "3", "error": "late"})]
    got = extraction.answers(spark.createDataFrame([(x,) for x in lines], "line string"))
    sent = spark.createDataFrame([(1, "t"), (2, "t"), (3, "t"), (4, "t"), (5, " "), (6, None)], "doc int, text string")
    assert {r["doc"]: r["state"] for r in extraction.batch_status(sent, got).collect()} == {1: "done", 2: "done", 3: "failed", 4: "waiting", 5: "waiting", 6: "waiting"}
    assert [r["doc"] for r in extraction.to_send(sent, got.where("state = 'done'")).orderBy("doc").collect()] == [3, 4] and extraction.to_send(sent, got, True).count() == 4
    assert [(r["doc"], r["place"], r["metric"], r["guidance_value"], r["uncertain"], r["horizon"]) for r in extraction.proposals(got).collect()] == [("1", 0, "m", None, True, None), ("1", 1, "m", None, True, None)]


def test_cohort_and_choice(spark):
    df = spark.createDataFrame([("a", None), ("b", 10.0), ("c", 90.0), ("d", 900.0)], "slug string, cap double")
    assert {tuple(r)[::2] for r in dedup.cohort(df, "cap", 50, 100).collect()} == {("a", "unresolved"), ("b", "cohort"), ("c", "over_cap")} and dedup.cohort(df, "cap", 50).count() == 4
    assert [r["slug"] for r in dedup.chosen(df, "slug", ["d", "b", "z"]).orderBy("slug").collect()] == ["b", "d"] and dedup.chosen(df, "slug", sample=2).count() == 2 and dedup.chosen(df, "slug", limit=1).first()["slug"] == "a"


def test_anchors(spark):
    long = "a" * 80
    p = spark.createDataFrame([(1, 1, [long + "edited"]), (1, 2, [long + "whole"]), (1, 3, [])], "doc int, ord int, parts array<string>")
    c = spark.createDataFrame([(1, 1, "xx" + long + "original"), (1, 2, long + "whole")], "doc int, chunk_no int, text string")
    assert {r["ord"]: r["chunk_no"] for r in match.containing_chunk(p, c, 80).collect()} == {1: 1, 2: 2, 3: None}
    assert {r["ord"]: r["chunk_no"] for r in match.containing_chunk(p, c).collect()} == {1: None, 2: 2, 3: None}


def test_top_against_median(spark):
    df = spark.createDataFrame([(float(i), float(i % 10)) for i in range(1, 101)] + [(None, 1.0), (5.0, None)], "s double, o double")
    r = scores.top_against_median(df, "s", "o").first()
    assert (r["companies"], r["top"], r["median"], r["hit_rate"]) == (100, 5, 4.5, 0.8) and scores.top_against_median(df.limit(0), "s", "o").count() == 0


def test_opening_is_packed_in_order(spark):
    rows = [(1, 0, "Op", "moderator", "a b"), (1, 1, "M", "management", "c d e"), (1, 2, "M", "management", "f"), (1, 3, "Op", "moderator", "g h i j k l m"), (1, 4, "A", "analyst", "q"), (1, 5, "Op", "moderator", "next"), (1, 6, "B", "analyst", "r")]
    t = spark.createDataFrame(rows, "doc int, turn_no int, speaker string, role string, text string")
    assert {r["turn_no"]: r["chunk_no"] for r in segment.chunk_turns(t, 5).collect()} == {0: 1, 1: 1, 2: 2, 3: 3, 4: 3, 5: 4, 6: 4}


def test_let(spark):
    assert spark.range(3).select(let(F.col("id") + 1, lambda x: x * x + F.col("id")).alias("y")).collect() == [(1,), (5,), (11,)]
