"""Queries of the core operators over the test tables. Their SQL is in sql.py."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .operators import cascade, dedup, fiscal, match, segment, series, text, units, validate, values
from .plans import extraction, scores
from .session import table
from .sources import scans
from .sql import SQL  # noqa: F401

#: Fiscal year of the call and of the last complete year of the synthetic fundamentals.
CALL_FY, BASE_FY = 2026, 2000


def _items(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "guidance_items")
    return g.select(
        F.col("scrip").alias("company"), F.col("guidance_id").alias("ord"), "metric", F.col("guidance_value").alias("value"), F.col("guidance_unit").alias("unit"), "currency", "timeline", "level", "horizon", F.col("page_number").alias("page"), "passage", "call_id"
    )


def _chunks_once(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """(call_id, chunk_id, text, columns) of the first delivery of each chunk."""
    c = table(spark, d, "chunks").groupBy("call_id", "chunk_id").agg(F.min_by(F.struct("text", *columns), "chunk_key").alias("c"))
    return c.select("call_id", "chunk_id", "c.*")


def _series(spark: SparkSession, d: str) -> DataFrame:
    """(company, fy, sales, net_profit): orders by fiscal year; sums are decimal, so their order doesn't matter."""
    o, l = table(spark, d, "orders"), table(spark, d, "lineitem")  # noqa: E741
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    rows = l.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    fy = F.year(F.add_months(F.col("o_orderdate").cast("date"), 9))
    rows = rows.groupBy(F.col("o_custkey").alias("company"), fy.alias("fy")).agg(F.sum(net.cast("decimal(18,4)")).alias("s"), F.sum((net * (F.col("l_tax") - 0.03)).cast("decimal(18,4)")).alias("p"))
    return rows.select("company", "fy", F.round("s", 2).cast("double").alias("sales"), F.round("p", 2).cast("double").alias("net_profit"))


def _fundamentals(spark: SparkSession, d: str) -> DataFrame:
    """Base figures of the listed companies, each taken from the order series of one customer."""
    s = _series(spark, d).withColumns({"opm_pct": F.lit(19.0), "pbt": F.col("net_profit") * 1.3})
    base = series.base_and_trailing(s, "company", BASE_FY).withColumnRenamed("company", "customer")
    m = table(spark, d, "company_master").select(F.col("scrip").alias("company"), "name", (F.col("scrip").cast("bigint") % 100 + 1).alias("customer"), F.round(F.col("bse_mcap_cr") / 100, 2).alias("forward_pe"))
    f = m.join(base, "customer").select(
        "company", "name", "forward_pe", F.col("revenue").alias("current_revenue"), F.col("pat").alias("current_pat"), "net_margin", "ebitda_margin", "pbt_margin", "status", "pat_cagr", "revenue_cagr", F.lit(CALL_FY).alias("call_fy"), F.lit(85.125).alias("usdinr")
    )
    return f


def _cascade_items(spark: SparkSession, d: str) -> DataFrame:
    return _items(spark, d).where("level = 'company'").withColumn("block", cascade.block_of(fiscal.horizon(F.col("timeline"), F.lit(CALL_FY))))


# --- problem 3 ------------------------------------------------------------------------------------


def p3_quantities(spark: SparkSession, d: str) -> DataFrame:
    return units.quantities(table(spark, d, "guidance_items"), table(spark, d, "unit_base"), table(spark, d, "fx_rates"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return p3_quantities(spark, d).select("guidance_id", "common_unit", "lo", "hi")


# --- scalar functions -----------------------------------------------------------------------------


def fiscal_fields(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "guidance_items")
    t, q = F.col("timeline"), F.col("quarter")
    span = fiscal.year_range(t)
    call = fiscal.period_year(q)
    return g.select(
        "guidance_id", call.alias("call_fy"), fiscal.base_year(q).alias("base_fy"), fiscal.trailing_year(t).alias("last_year"), span["lo"].alias("fy_lo"), span["hi"].alias("fy_hi"), fiscal.part_offset(t).alias("part_offset"),
        fiscal.years_until(span["hi"], call, t).alias("years"), fiscal.horizon(t, call).alias("horizon_derived"), F.array_join(fiscal.years_spanned(t).cast("array<string>"), ",").alias("years_spanned"),
    )


def fiscal_calendar(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "filings")
    day = F.col("call_date")
    r = fiscal.reported_quarter(day)
    return f.select("filing_id", fiscal.fiscal_year2(day).alias("fy2"), fiscal.fiscal_quarter(day).alias("q"), fiscal.quarter_start(day).alias("q_start"), r["quarter"].alias("reported_q"), r["fy"].alias("reported_fy"))


def timeline_normal(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "guidance_items")
    normal = fiscal.normalize_timeline(F.col("timeline"), F.col("extracted_at").cast("date"))
    return g.select("guidance_id", normal.alias("normal"), fiscal.timeline_end(normal).alias("ends"))


def title_quarter(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "filings")
    title = F.concat_ws(" ", F.col("name"), F.col("headline"), F.regexp_replace("call_period", r"^(\d)QFY", "Q$1 FY"))
    q = fiscal.detect_quarter(title)
    return f.select("filing_id", q["quarter"].alias("quarter"), q["fy"].alias("fy"))


def value_fields(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "guidance_items")
    v = F.col("guidance_value")
    b, s = values.bounds(v), values.spread(v)
    return g.select("guidance_id", b["lo"].alias("lo"), b["hi"].alias("hi"), values.midpoint(v).alias("mid"), s["lo"].alias("least"), s["hi"].alias("most"), values.clean_value(v).alias("clean"), values.value_key(v).alias("value_key"), values.credible_metric(F.col("metric")).alias("credible"), values.credible_item(F.col("metric"), F.col("level"), F.col("horizon")).alias("credible_strict"))


def implied_growth(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "guidance_items")
    f = values.forward_growth(F.col("metric"), F.col("guidance_value"), F.col("guidance_unit"), F.col("timeline"), F.col("currency"))
    y = values.years_ahead(F.col("timeline"))
    return g.select("guidance_id", y["lo"].alias("years_lo"), y["hi"].alias("years_hi"), f["status"].alias("status"), F.round(f["low"], 6).alias("low"), F.round(f["high"], 6).alias("high"), f["reason"].alias("reason"))


def crore_amounts(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "guidance_items")
    lo = values.bounds(F.col("guidance_value"), True)["lo"]
    rate = fiscal.usdinr_on(F.col("extracted_at").cast("date").cast("string"))
    return g.select("guidance_id", rate.alias("usdinr"), F.round(values.to_crore(lo, F.col("guidance_unit"), F.col("currency"), rate), 4).alias("crore"), F.round(values.rough_crore(lo, F.col("guidance_unit"), F.col("currency")), 4).alias("rough_crore"))


def passage_forms(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "guidance_items")
    p, t = F.col("passage"), F.col("timeline")
    return g.select("guidance_id", text.collapse(p).alias("collapsed"), text.plain_punctuation(p, False).alias("squeezed"), text.timeline_key(t).alias("timeline_key"), text.year_in_passage(p, t).alias("year_told"), F.sha2(p, 256).alias("sha"), text.item_label(F.col("metric"), F.col("guidance_value"), F.col("guidance_unit"), F.col("currency"), t).alias("label"))


def speaker_label_parts(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "chunks")
    parts = text.speaker_parts(F.regexp_replace("text", r"(?:Moderator|Management|Analyst) \(([^)]*)\):", "$1:"))
    return c.select("chunk_key", F.size(parts).alias("n_parts"), F.length(F.array_join(parts, "|")).alias("length"), text.collapse_layout(F.col("text")).alias("flat"))


def filing_names(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "filings")
    url = F.concat(F.lit("https://exchange.invalid/stock-share-price/"), F.col("slug"), F.lit("/"), F.lower(F.substring("name", 1, 6)), F.lit("/"), F.col("scrip"), F.lit("/"))
    q = text.quote_url(url)
    return f.select("filing_id", text.slug(F.col("name")).alias("slug_of_name"), q["ticker"].alias("ticker"), q["slug"].alias("url_slug"), text.loose_number(F.concat(F.col("scrip"), F.lit(",000"))).alias("number"))


# --- filters --------------------------------------------------------------------------------------


def candidate_chunks(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "chunks")
    return c.where(text.passes_filter(F.col("role"), F.col("text"))).select("chunk_key", text.filter_reasons(F.col("text")).alias("reasons"))


def filter_pass_rate(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "chunks")
    ok = text.passes_filter(F.col("role"), F.col("text"))
    r = c.rollup("chunk_type").agg(F.count("*").alias("chunks"), F.count_if(ok).alias("passed"))
    return r.select(F.coalesce("chunk_type", F.lit("all")).alias("chunk_type"), "chunks", "passed", F.round(F.col("passed") / F.col("chunks"), 6).alias("share"))


def document_verdicts(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "documents")
    pages = F.ceil(F.col("n_chars") / 1800).cast("int")
    magic = F.when(F.col("doc_id") % 11 == 0, "<htm").otherwise("%PDF")
    rows = t.select("doc_id", "n_chars", pages.alias("pages"), text.classify_transcript(F.lower("text"), pages).alias("verdict"))
    return rows.select("doc_id", "pages", "verdict", text.file_verdict(F.col("n_chars"), magic, F.col("pages"), F.lit(None), verdict=F.col("verdict")).alias("file_verdict"))


def stripped_pages(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "documents")
    page = F.concat_ws("\n", F.lit(""), F.lit("Asha Works Limited"), F.lit("May 5, 2025"), F.col("text"), F.lit("Page 3 of 9"), F.concat(F.lit("  "), F.col("doc_id").cast("string"), F.lit(" |")))
    return t.select("doc_id", text.strip_page(page).alias("stripped"))


def _document_pages(spark: SparkSession, d: str) -> DataFrame:
    """Paragraphs of the documents as pages; every seventh is an empty page."""
    t = table(spark, d, "documents").select(F.col("doc_id").alias("doc"), F.posexplode(F.split("text", "\n\n")).alias("p", "text"))
    return t.select("doc", (F.col("p") + 1).alias("page_no"), F.when((F.col("p") + 1) % 7 != 0, F.col("text")).alias("text"))


def joined_pages(spark: SparkSession, d: str) -> DataFrame:
    return scans.whole_text(_document_pages(spark, d))


def first_pages(spark: SparkSession, d: str) -> DataFrame:
    return scans.first_text(_document_pages(spark, d), 2)


def roster_members(spark: SparkSession, d: str) -> DataFrame:
    """Which labels of a call name somebody of its management."""
    names = table(spark, d, "participants").where("role = 'management'").groupBy(F.col("call_id").alias("c")).agg(F.array_sort(F.collect_set("name")).alias("names"))
    labels = table(spark, d, "turns").where("speaker is not null").select("call_id", "speaker").distinct()
    return labels.join(names, F.col("call_id") == F.col("c")).select("call_id", "speaker", segment.in_roster(F.col("speaker"), F.col("names")).alias("management"))


def validation(spark: SparkSession, d: str) -> DataFrame:
    return _checked(spark, d).select("ord", "rule", "clean_value", "clean_timeline", "found_verbatim")


def _checked(spark: SparkSession, d: str) -> DataFrame:
    items = _items(spark, d).withColumns({"doc": F.col("call_id"), "chunk_id": F.lit("chunk")})
    calls = table(spark, d, "filings").groupBy("call_id").agg(F.min("call_date").alias("call_date"))
    chunks = _chunks_once(spark, d, "char_start").groupBy("call_id").agg(F.array_sort(F.collect_list(F.struct("char_start", "chunk_id", "text"))).alias("c"))
    said = chunks.select("call_id", text.collapse(F.array_join("c.text", "\n")).alias("plain_transcript"))
    return validate.apply_rules(items.join(calls, "call_id").join(said, "call_id", "left"))


def rejection_log(spark: SparkSession, d: str) -> DataFrame:
    return validate.rejections(_checked(spark, d)).select("ord", "rule", "reason", "summary")


def exact_repeats(spark: SparkSession, d: str) -> DataFrame:
    return validate.exact_repeats(_checked(spark, d)).select("ord", "kept", "group_order")


def fuzzy_repeats(spark: SparkSession, d: str) -> DataFrame:
    return validate.fuzzy_repeats(validate.exact_repeats(_checked(spark, d))).select("doc", "ord", "kept_as")


def cap_cohort(spark: SparkSession, d: str) -> DataFrame:
    return dedup.cohort(table(spark, d, "company_master"), "bse_mcap_cr", 3000, 5000).select("scrip", "status", F.col("bse_mcap_cr").alias("mcap"))


# --- joins ----------------------------------------------------------------------------------------


def cohort_items(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "company_master").select("scrip", "ticker", "exchanges")
    return table(spark, d, "guidance_items").join(m, "scrip").select("guidance_id", "scrip", "ticker", "exchanges")


def prompt_versions(spark: SparkSession, d: str) -> DataFrame:
    """Items of two prompt versions side by side, by company and metric."""
    g = table(spark, d, "guidance_items")
    one = lambda odd: g.where(F.col("guidance_id") % 2 == odd).groupBy("scrip", "metric").agg(F.count("*").alias(f"n{odd}"))
    return one(0).join(one(1), ["scrip", "metric"], "full").select("scrip", "metric", "n0", "n1")


def missed_filings(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "filings").withColumn("subcategory", F.col("headline"))
    known = scans.transcript_filings(f).select("scrip")
    return scans.wrongly_tagged(f.where("attachment is not null").withColumn("subcategory", F.regexp_replace("headline", "(?i)transcript", "document")), known.where(F.col("scrip") % 3 != 0)).select("scrip", "news_dt", "attachment")


def usable_calls(spark: SparkSession, d: str) -> DataFrame:
    f, c = table(spark, d, "filings"), table(spark, d, "chunks").select(F.col("call_id").alias("c"))
    return f.join(c, F.col("call_id") == F.col("c"), "left_semi").select("filing_id", "call_id")


def chunk_pages(spark: SparkSession, d: str) -> DataFrame:
    """The page each chunk of a call begins on, pages of a call being its chunks' page spans."""
    c = table(spark, d, "chunks").where("char_start is not null and page_start is not null")
    pages = c.groupBy(F.col("call_id").alias("doc"), F.col("page_start").alias("page_no")).agg(F.max(F.length("text")).alias("n"))
    pages = pages.select("doc", "page_no", F.repeat(F.lit("x"), F.col("n")).alias("text"))
    offsets = c.select(F.col("call_id").alias("doc"), F.col("char_start").cast("bigint").alias("offset"), "chunk_key")
    return segment.page_of(offsets, segment.page_bounds(pages)).select("chunk_key", "offset", "page_no")


def item_anchor_chunks(spark: SparkSession, d: str) -> DataFrame:
    """item_chunks, and for a passage that no chunk holds the first chunk with the first 80 characters of each part."""
    return match.containing_chunk(*_parts_and_chunks(spark, d), 80).select("ord", "chunk_no")


def item_chunks(spark: SparkSession, d: str) -> DataFrame:
    """The first chunk of its call that holds all parts of a passage, each part whole; case, punctuation marks and white space don't count."""
    return match.containing_chunk(*_parts_and_chunks(spark, d)).select("ord", "chunk_no")


def _parts_and_chunks(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    r = table(spark, d, "raw_items")
    part = lambda p: text.plain_punctuation(F.regexp_replace(p, r"^[…\s]+", ""), False)
    parts = F.filter(F.transform(text.speaker_parts(F.col("passage")), part), lambda p: p != "")
    passages = r.select(F.col("call_id").alias("doc"), F.col("item_id").alias("ord"), parts.alias("parts"))
    return passages, table(spark, d, "chunks").select(F.col("call_id").alias("doc"), F.col("chunk_key").alias("chunk_no"), text.plain_punctuation(F.col("text"), False).alias("text"))


def _eval_sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    g = table(spark, d, "guidance_items").where("call_id is not null")
    b = values.bounds(F.col("guidance_value"))
    rows = g.select(F.col("call_id").alias("doc"), F.col("guidance_id").alias("ord"), "metric", F.coalesce("timeline", F.lit("")).alias("timeline"), values.midpoint(F.col("guidance_value")).alias("mid"), b["lo"].alias("lo"), b["hi"].alias("hi"), fiscal.years_spanned(F.col("timeline")).alias("years"), "passage", "horizon", "level", "track", "credibility_scorable")
    return rows.where(F.col("ord") % 2 == 0), rows.where(F.col("ord") % 2 == 1)


def greedy_match(spark: SparkSession, d: str) -> DataFrame:
    r, f = _eval_sides(spark, d)
    return match.greedy_pairs(r, f)


def two_pass_match(spark: SparkSession, d: str) -> DataFrame:
    r, f = _eval_sides(spark, d)
    return match.two_pass_pairs(r, f)


def precision_recall(spark: SparkSession, d: str) -> DataFrame:
    r, f = _eval_sides(spark, d)
    s = match.precision_recall(match.greedy_pairs(r, f), r, f)
    return s.select("doc", "reference_items", "found_items", "matched", F.round("recall", 6).alias("recall"), F.round("precision", 6).alias("precision"))


def tag_agreement(spark: SparkSession, d: str) -> DataFrame:
    r, f = _eval_sides(spark, d)
    return match.tag_agreement(match.greedy_pairs(r, f), r, f)


def two_level_recall(spark: SparkSession, d: str) -> DataFrame:
    r, f = _eval_sides(spark, d)
    return match.two_level_recall(best_matches(spark, d), match.greedy_pairs(r, f), r, f)


def recall_report(spark: SparkSession, d: str) -> DataFrame:
    return match.recall_report(two_level_recall(spark, d))


def best_matches(spark: SparkSession, d: str) -> DataFrame:
    r, f = _eval_sides(spark, d)
    side = lambda t: t.select("doc", "ord", F.col("passage").alias("text"), text.without_labels(F.col("passage")).alias("bare"))
    return match.best_match(side(r), side(f))


# --- aggregates -----------------------------------------------------------------------------------


def label_counts(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "chunks").select(F.col("chunk_key").alias("doc"), F.regexp_replace("text", r"(?:Moderator|Management|Analyst) \(([^)]*)\):", "$1:").alias("text"))
    return segment.speaker_counts(c)


def run_delta(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "raw_items")
    rows = r.groupBy("call_id", "chunk_id").agg(F.count_if(F.col("run_index") == 0).alias("n0"), F.count_if(F.col("run_index") == 1).alias("n1"))
    return rows.withColumn("delta", F.abs(F.col("n0") - F.col("n1")))


def arm_scores(spark: SparkSession, d: str) -> DataFrame:
    """By prompt version: companies, the mean share of credible items, and how many companies have 0.70 or more."""
    g = table(spark, d, "guidance_items")
    by = g.groupBy("prompt_version", "scrip").agg(F.count_if("credibility_scorable").alias("c"), F.count("*").alias("n"))
    share = F.col("c") / F.col("n")
    return by.groupBy("prompt_version").agg(F.count("*").alias("companies"), F.round(F.avg(share), 6).alias("mean_share"), F.count_if(share >= 0.70).alias("clear"))


def chunk_shares(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "chunks")
    by = c.groupBy("call_id").agg(F.count("*").alias("chunks"), F.count_if(F.col("chunk_type") == "qa_session").alias("qa"), F.max(F.when(F.col("chunk_type") == "opening_remarks", F.col("chunk_id"))).alias("last_opening"))
    return by.withColumn("qa_share", F.round(F.col("qa") / F.col("chunks"), 6))


def earliest_filing(spark: SparkSession, d: str) -> DataFrame:
    return dedup.earliest(table(spark, d, "filings"), "scrip", "news_dt", "filing_id").select("scrip", "filing_id", "news_dt")


def filing_quarters(spark: SparkSession, d: str) -> DataFrame:
    return scans.filing_for_quarter(table(spark, d, "filings").where("scrip is not null and news_dt is not null and attachment is not null"))


def transcript_quarters(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "filings").withColumn("subcategory", F.lit(None).cast("string"))
    return scans.filing_for_quarter(f.where("news_dt is not null"), transcripts=True)


def call_years(spark: SparkSession, d: str) -> DataFrame:
    """The fiscal year of each filing's call, from the name of its file, else from its period."""
    f = table(spark, d, "filings")
    named = F.when(F.col("filing_id") % 3 != 0, F.concat_ws("_", "slug", F.regexp_replace("headline", r"\s+", "_")))
    return f.select("filing_id", cascade.call_year(named, F.col("call_period")).alias("y")).select("filing_id", "y.fy", "y.source", "y.mismatch")


def attachment_candidates(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "filings").where("call_id is not null").select(F.col("call_id").alias("key"), "attachment", "headline", F.length("headline").alias("size"))
    return dedup.attachment_candidates(f).select("key", "attachment", "place")


def verdict_tally(spark: SparkSession, d: str) -> DataFrame:
    return document_verdicts(spark, d).groupBy("file_verdict").agg(F.count("*").alias("documents"))


def sector_top(spark: SparkSession, d: str) -> DataFrame:
    """The fifteen kinds of business with most companies; ties go by name."""
    m = table(spark, d, "company_master").select(F.regexp_extract("name", r"^\S+\s+(.*?)(?:\s+(?:Limited|Ltd\.?))?$", 1).alias("sector"))
    return m.groupBy("sector").agg(F.count("*").alias("companies")).orderBy(F.col("companies").desc(), "sector").limit(15)


def status_kinds(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select(F.concat_ws(":", "event_type", "props").alias("status"), (F.col("user_id") % 10).alias("batch"))
    r = e.withColumn("kind", F.substring_index("status", ":", 1)).rollup("batch", "kind").agg(F.count("*").alias("n"))
    return r.select(F.coalesce(F.col("batch"), F.lit(-1)).alias("batch"), F.coalesce("kind", F.lit("all")).alias("kind"), "n")


def token_usage(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    n = F.get_json_object("props", "$.k").cast("bigint")
    body = F.to_json(F.struct(F.struct(n.alias("prompt_tokens"), F.struct((n % 7).alias("cached_tokens")).alias("prompt_tokens_details"), (n % 5).alias("completion_tokens")).alias("usage")))
    u = e.select("event_type", text.usage_tokens(body).alias("u"))
    by = u.groupBy("event_type").agg(*(F.sum(f"u.{c}").alias(c) for c in ("prompt", "cached", "completion")))
    return by.withColumn("cached_pct", F.coalesce(F.round(F.expr("try_divide(100 * cached, prompt)"), 4), F.lit(0.0)))


def trailing_growth(spark: SparkSession, d: str) -> DataFrame:
    s = _series(spark, d)
    r = series.base_and_trailing(s, "company", 2001)
    return r.select("company", F.round("revenue", 2).alias("revenue"), F.round("pat", 2).alias("pat"), "net_margin", "status", "pat_cagr", "revenue_cagr")


def series_pivot(spark: SparkSession, d: str) -> DataFrame:
    s = _series(spark, d)
    long = s.select("company", "fy", F.explode(F.create_map(F.lit("Sales"), F.col("sales"), F.lit("Net Profit"), F.col("net_profit"))).alias("label", "value"))
    g = series.grid(long, ["company", "fy"], "label", "value", {"Sales": "sales", "Net Profit": "net_profit"})
    return g.select("company", "fy", F.round("sales", 2).alias("sales"), F.round("net_profit", 2).alias("net_profit"))


def _two_bases(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    s = _series(spark, d)
    con = s.where((F.col("company") % 5 != 0) & ((F.col("company") % 3 != 0) | (F.col("fy") > 1999)))
    off = F.when(F.col("company") % 2 == 0, 1.05).otherwise(1.5)
    std = s.where(F.col("company") % 7 != 0).withColumns({"sales": F.col("sales") * off, "net_profit": F.col("net_profit") * off})
    return con, std


def overlap_divergence(spark: SparkSession, d: str) -> DataFrame:
    con, std = _two_bases(spark, d)
    return series.overlap_divergence(con, std, "company")


def series_splice(spark: SparkSession, d: str) -> DataFrame:
    con, std = _two_bases(spark, d)
    r = series.resolve(con, std, "company", 2001)
    return r.select("company", "fy", F.round("sales", 4).alias("sales"), F.round("net_profit", 4).alias("net_profit"), "source")


# --- ranking and cascade --------------------------------------------------------------------------


def driver_ladder(spark: SparkSession, d: str) -> DataFrame:
    r = cascade.ranked_drivers(_cascade_items(spark, d))
    return r.select("company", "block", "class", "rank", "ord")


def block_growth(spark: SparkSession, d: str) -> DataFrame:
    return cascade.block_growth(_cascade_items(spark, d), _fundamentals(spark, d), True).select("company", "block", "base", "bull")


def block_growth_plain(spark: SparkSession, d: str) -> DataFrame:
    return cascade.block_growth(_cascade_items(spark, d), _fundamentals(spark, d), False).select("company", "block", "base", "bull", "basis")


def acceleration_rank(spark: SparkSession, d: str) -> DataFrame:
    r = cascade.acceleration(_cascade_items(spark, d), _fundamentals(spark, d))
    return r.select("company", "status", "pat_cagr", "near_base", "long_base", "fwd_horizon", "fwd_base", "fwd_bull", "accel_base", "accel_bull")


def revenue_rank(spark: SparkSession, d: str) -> DataFrame:
    r = cascade.revenue_acceleration(_cascade_items(spark, d), _fundamentals(spark, d))
    return r.select("company", "status", "fwd_base", "fwd_bull", "accel_base")


def forward_peg_rank(spark: SparkSession, d: str) -> DataFrame:
    r = cascade.forward_valuation(_cascade_items(spark, d), _fundamentals(spark, d))
    return r.select("company", "forward_pe", "best_base", "forward_peg")


def other_signals(spark: SparkSession, d: str) -> DataFrame:
    items = _items(spark, d).withColumn("company", F.concat_ws("/", "company", "call_id"))  # a company on one call
    return cascade.other_signals(items)


def attachment_rank(spark: SparkSession, d: str) -> DataFrame:
    """The best attachment of each call: one whose headline says transcript, then the later, then by name."""
    f = table(spark, d, "filings").where("call_id is not null and attachment is not null")
    says = F.lower(F.coalesce("headline", F.lit(""))).contains("transcript")
    best = dedup.first_by(f.withColumn("says", says), ["call_id"], [F.col("says").desc(), F.col("news_dt").desc_nulls_last(), F.col("attachment")])
    return best.select("call_id", "attachment", "says")


def turn_ends(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "turns").where("char_start is not null").groupBy("call_id", "char_start").agg(F.min("turn_id").alias("turn_no"))
    ends = table(spark, d, "turns").groupBy(F.col("call_id").alias("c")).agg(F.max("char_end").alias("total"))
    rows = t.join(ends, F.col("call_id").eqNullSafe(F.col("c"))).withColumnRenamed("call_id", "doc")
    return segment.turn_ends(rows, F.col("total")).select("doc", "turn_no", "char_start", "char_end")


# --- sort, sample, sets ---------------------------------------------------------------------------


def stride_sample(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "company_master")
    return dedup.stride_sample(m, 37, [F.col("bse_mcap_cr").asc_nulls_last(), F.col("scrip")]).select("scrip", "bse_mcap_cr")


def recent_quarters(spark: SparkSession, d: str) -> DataFrame:
    q = filing_quarters(spark, d).select("scrip", "fy", "quarter", "attachment")
    return dedup.latest_quarters(q, "scrip", "fy", "quarter", 2)


def master_union(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "company_master")
    first = m.where(F.col("exchanges").contains("BSE")).select("scrip", "ticker", "isin", "name", F.lit("BSE").alias("exchanges"))
    second = m.where(F.col("exchanges").contains("NSE")).select(F.lit("").alias("scrip"), "ticker", "isin", "name", F.lit("NSE").alias("exchanges"))
    return dedup.union_masters(first, second)


def slug_sets(spark: SparkSession, d: str) -> DataFrame:
    """Sizes of the intersection, union and difference of two sets of companies."""
    f = table(spark, d, "filings").select("scrip").where("scrip is not null").distinct()
    m = table(spark, d, "company_master").select("scrip").where("scrip is not null").distinct()
    n = lambda t, what: t.agg(F.count("*").alias("n")).select(F.lit(what).alias("what"), "n")
    return n(f.intersect(m), "both").unionAll(n(f.union(m).distinct(), "any")).unionAll(n(m.subtract(f), "listed_only"))


def filled_links(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "filings").where("call_id is not null and attachment is not null")
    first = f.where(F.col("filing_id") % 2 == 0).select("call_id", "attachment", "filing_id")
    second = f.select("call_id", F.concat(F.lit("mirror/"), F.col("attachment")).alias("attachment"), "filing_id")
    return dedup.by_priority([first, second], ["call_id"], "filing_id")


def union_of_runs(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "raw_items").select(F.coalesce(F.concat(F.col("call_id").cast("string"), F.lit("/"), F.col("chunk_id")), F.concat(F.lit("item "), F.col("item_id").cast("string"))).alias("chunk"), F.col("run_index").alias("run"), F.col("item_id").alias("ord"), "passage")
    return match.union_runs(r)


def exact_first(spark: SparkSession, d: str) -> DataFrame:
    return dedup.exact_first(_items(spark, d), ["company", "metric", "value", "timeline"], "ord").select("ord")


def best_passage(spark: SparkSession, d: str) -> DataFrame:
    r = dedup.best_passage(_items(spark, d), ["company"], "metric", "value", "timeline", "level", "passage", "ord")
    return r.select("ord", "group_order")


def date_windows(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "filings").where("scrip is not null and call_date is not null")
    r = f.groupBy("scrip").agg(F.min("call_date").alias("from"), F.max("call_date").alias("to"))
    return scans.date_windows(r).select("scrip", "start", "end")


# --- pages ----------------------------------------------------------------------------------------


def _pages(spark: SparkSession, d: str) -> DataFrame:
    """One page for each company, written from the filings and the master list."""
    f = table(spark, d, "filings").where("scrip is not null and call_date is not null")
    li = F.concat(F.lit('<li class="flex flex-gap-8 x"><div>'), F.lit("> "), F.date_format("call_date", "MMM yyyy"), F.lit(" </div>"), F.when(F.col("attachment").isNotNull(), F.concat(F.lit('<a href="https://files.invalid/'), F.col("attachment"), F.lit('"> Transcript </a>'))).otherwise(F.lit("<div>Transcript</div>")), F.lit("</li>"))
    li = F.replace(li, F.lit("<div>> "), F.lit("<div> "))
    lists = f.groupBy("scrip").agg(F.array_sort(F.collect_list(F.struct("filing_id", li.alias("li")))).alias("x")).select("scrip", F.array_join(F.col("x.li"), "").alias("lis"))
    m = table(spark, d, "company_master").join(lists, "scrip", "left")
    cap = F.when(F.col("bse_mcap_cr").isNotNull(), F.concat(F.lit('Market Cap <span class="number">'), F.format_number(F.round(F.col("bse_mcap_cr"), 0), 0), F.lit("</span>"))).otherwise(F.lit(""))
    html = F.concat(F.lit("<h1 class='a'> "), F.col("name"), F.lit(" </h1>"), cap, F.concat(F.lit('<a title="Sector">Goods</a><a title="Sector">'), F.replace(F.concat_ws(" & ", "exchanges", "ticker"), F.lit("&"), F.lit("&amp;")), F.lit('</a><a title="Industry">'), F.col("name"), F.lit("</a><h2>Concalls</h2><ul>")), F.coalesce("lis", F.lit("")), F.concat(F.lit("</ul> see https://x.invalid/"), F.col("scrip"), F.lit(".pdf, https://x.invalid/"), F.coalesce("ticker", F.lit("none")), F.lit("; https://x.invalid/"), F.col("scrip"), F.lit(".pdf.")))
    return m.select(F.col("scrip").alias("key"), html.alias("html"))


def page_scrape(spark: SparkSession, d: str) -> DataFrame:
    p = _pages(spark, d)
    s = text.sector_industry(F.col("html"))
    return p.select("key", text.market_cap(F.col("html")).alias("mcap"), text.page_name(F.col("html")).alias("name"), s["sector"].alias("sector"), s["industry"].alias("industry"))


def page_links(spark: SparkSession, d: str) -> DataFrame:
    p = _pages(spark, d).select(F.col("key").alias("doc"), F.regexp_extract("html", "(see .*)$", 1).alias("text"))
    return scans.links_in(p)


def page_calls(spark: SparkSession, d: str) -> DataFrame:
    return scans.calls(_pages(spark, d))


def call_picks(spark: SparkSession, d: str) -> DataFrame:
    return scans.pick_call(scans.calls(_pages(spark, d))).select("key", "fy", "quarter", "transcript_url")


def _profit_pages(spark: SparkSession, d: str) -> DataFrame:
    """A page with profit tables for each customer, written from the order series."""
    s = _series(spark, d)
    fixed = lambda c: F.format_number(F.col(c), 2)
    cells = s.groupBy("company").agg(F.array_sort(F.collect_list(F.struct("fy", fixed("sales").alias("s"), fixed("net_profit").alias("p")))).alias("y"))
    row = lambda label, c: F.concat(F.lit(f"<tr><td><b>{label}</b></td>"), F.array_join(F.transform("y", lambda y: F.concat(F.lit("<td>"), c(y), F.lit("</td>"))), ""), F.lit("</tr>"))
    body = F.concat(row("", lambda y: F.concat(F.lit("Mar "), y["fy"].cast("string"))), row("Sales +", lambda y: y["s"]), row("Net Profit +", lambda y: y["p"]))
    table_ = lambda head: F.concat(F.lit(f"<section><h2>{head}</h2><table>"), body, F.lit("</table></section>"))
    top = F.concat(F.lit('Market Cap <span class="number">'), F.format_number(F.col("company") * 1000, 0), F.lit('</span> Stock P/E <span class="number">'), (F.col("company") % 40 + 0.5).cast("string"), F.lit("</span>"))
    return cells.select(F.col("company").alias("key"), F.concat(top, table_("Quarterly Results"), table_("Profit &amp; Loss")).alias("html"))


def profit_grid(spark: SparkSession, d: str) -> DataFrame:
    return scans.profit_grid(_profit_pages(spark, d), {"Sales": "sales", "Net Profit": "net_profit"})


def company_snapshot(spark: SparkSession, d: str) -> DataFrame:
    return scans.company_snapshot(_profit_pages(spark, d)).select("key", "fiscal_year", "revenue", "pat", "net_margin", "pe", "mcap", "forward_pat", "forward_pe")


def passage_divergence(spark: SparkSession, d: str) -> DataFrame:
    """Where the passages of items part from the chunk they were taken from."""
    rows = table(spark, d, "raw_items").join(_chunks_once(spark, d), ["call_id", "chunk_id"], "left").select("item_id", match.divergence(F.col("passage"), F.col("text")).alias("x"))
    return rows.select("item_id", "x.at", "x.expected", "x.found")


def ground_truth_blocks(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "guidance_items")
    block = F.concat(F.lit("- id: "), F.col("guidance_id").cast("string"), F.lit('\npassage: "'), F.regexp_replace("passage", r"[\r\n]+", " "), F.lit('"\nmetric: '), F.col("metric"), F.lit("\nguidance_value: "), F.coalesce(F.concat(F.lit('"'), F.col("guidance_value"), F.lit('"')), F.lit("null")))
    docs = g.where("passage is not null and metric is not null").select(F.col("call_id").alias("doc"), F.struct("guidance_id", block.alias("b")).alias("x")).groupBy("doc").agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["b"]), "\n\n").alias("text"))
    return scans.ground_truth(docs).select("id", "metric", "guidance_value")


# --- sessions -------------------------------------------------------------------------------------


def _spoken_turns(spark: SparkSession, d: str) -> DataFrame:
    """Turns as delivered with the role of their row, one for each place in a call."""
    t = table(spark, d, "turns").where("call_id is not null and char_start is not null and text is not null")
    t = t.groupBy("call_id", "char_start").agg(F.min_by(F.struct("speaker", "role", "text"), "turn_id").alias("t"))
    r = F.lower(F.trim("t.role"))
    role = F.when(r.isin("analyst", "investor", "participant"), "analyst").when(r.isin("moderator", "operator", "host"), "moderator").otherwise("management")
    return t.select(F.col("call_id").alias("doc"), F.col("char_start").alias("turn_no"), F.coalesce("t.speaker", F.lit("")).alias("speaker"), role.alias("role"), F.col("t.text").alias("text"))


def turn_sessions(spark: SparkSession, d: str) -> DataFrame:
    return segment.sessions(_spoken_turns(spark, d)).select("doc", "turn_no", "session")


def session_chunks(spark: SparkSession, d: str) -> DataFrame:
    return segment.build_chunks(segment.chunk_turns(_spoken_turns(spark, d)))


def segmented_pages(spark: SparkSession, d: str) -> DataFrame:
    """Pages written from the chunks of a call, cut into sessions again."""
    c = table(spark, d, "chunks").where("call_id is not null and text is not null")
    said = F.regexp_replace("text", r"(?:Moderator|Management|Analyst) \(([^)]*)\):", "\n\n$1:")
    content = c.select(F.col("call_id").alias("doc"), (F.col("chunk_key") + 2).cast("int").alias("page_no"), F.concat(F.lit("Asha Works Limited\n"), said, F.lit("\nPage 3 of 9")).alias("text"))
    people = table(spark, d, "participants").where("role <> 'analyst'").groupBy(F.col("call_id").alias("doc"), "role").agg(F.array_sort(F.collect_list(F.concat(F.lit("MR. "), F.col("name"), F.lit(" - title")))).alias("n"))
    roster = people.groupBy("doc").agg(F.array_join(F.array_sort(F.collect_list(F.concat(F.upper("role"), F.lit(": "), F.array_join("n", " "), F.lit("\n")))), "").alias("text")).select("doc", F.lit(2).alias("page_no"), "text")
    return segment.segment(content.unionByName(roster))


# --- extraction and scores ------------------------------------------------------------------------


def extracted_items(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "chunks").select(F.col("call_id").alias("doc"), F.col("chunk_key").alias("chunk_no"), "role", "text")
    return extraction.merged(extraction.extract(c))


def batch_requests(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "documents").select(F.col("doc_id").alias("doc"), "text")
    return extraction.manifest(t, "Read: {transcript}", "{}")


def batch_states(spark: SparkSession, d: str) -> DataFrame:
    """Requests for all documents, with answers for some: done, failed, or waiting."""
    t = table(spark, d, "documents").select(F.col("doc_id").alias("doc"), "n_chars")
    ok = F.col("n_chars") % 3 != 0
    body = F.struct(F.when(ok, "200").otherwise("500").alias("status_code"), F.struct(F.lit("{}").alias("output_text")).alias("body"))
    lines = t.where("n_chars % 5 <> 0").select(F.to_json(F.struct(F.col("doc").cast("string").alias("custom_id"), body.alias("response"))).alias("line"))
    return extraction.batch_status(t, extraction.answers(lines))


def proposals(spark: SparkSession, d: str) -> DataFrame:
    """Answers with candidates of ground truth, written from the items of a call and read again."""
    g = table(spark, d, "guidance_items").where("call_id is not null")
    c = F.struct(F.col("guidance_id").cast("int").alias("candidate_id"), "passage", "metric", "guidance_value", "timeline", "credibility_scorable", F.col("guidance_unit").isNull().alias("uncertain"))
    by = g.groupBy("call_id").agg(F.array_sort(F.collect_list(c)).alias("candidates"), F.min("company").alias("company"))
    body = F.struct(F.lit("200").alias("status_code"), F.struct(F.to_json(F.struct("company", "candidates")).alias("output_text")).alias("body"))
    lines = by.select(F.to_json(F.struct(F.col("call_id").cast("string").alias("custom_id"), body.alias("response"))).alias("line"))
    return extraction.proposals(extraction.answers(lines)).select("doc", "company", "place", "candidate_id", "passage", "metric", "guidance_value", "timeline", "credibility_scorable", "uncertain")


def metric_classes(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "raw_items")
    return r.select("item_id", extraction.classify_metric(F.col("metric_description"), F.col("guidance_unit")).alias("metric"))


def gate_scores(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "guidance_items")
    f = values.forward_growth(F.col("metric"), F.col("guidance_value"), F.col("guidance_unit"), F.col("timeline"), F.col("currency"))
    side = lambda odd: g.where(F.col("guidance_id") % 2 == odd).select(F.concat_ws("/", "scrip", "metric").alias("slug"), "guidance_id", "metric", f.alias("g")).groupBy("slug").agg(F.min_by(F.struct("metric", "g"), "guidance_id").alias("x")).select("slug", F.col("x.metric").alias("metric"), F.col("x.g.status").alias("status"), F.round("x.g.low", 6).alias("low"))
    return scores.gate(side(0), side(1))


def top_overlap(spark: SparkSession, d: str) -> DataFrame:
    s = _series(spark, d)
    year = lambda y: s.where(F.col("fy") == y).select("company", F.round("sales", 2).alias("sales"))
    return scores.top_overlap(year(1999), year(2000), "company", "sales", 200)


def composite_score(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "company_master")
    n = F.col("scrip").cast("bigint")
    rows = m.select("scrip", (n % 11).cast("double").alias("credibility"), (n % 7).cast("double").alias("growth"), F.when(n % 5 != 0, (n % 9).cast("double")).alias("valuation"), (n % 3).cast("double").alias("acceleration"), (n % 4 == 0).alias("promoter_buying"))
    return scores.composite(rows).select("scrip", F.round("score", 6).alias("score"))


def delivery_ratio(spark: SparkSession, d: str) -> DataFrame:
    s = _series(spark, d).select("company", F.col("fy").alias("quarter_no"), F.round("sales", 2).alias("actual"), F.round(F.col("net_profit") * 20, 2).alias("guided"))
    return scores.delivery_ratio(s).select("company", "quarter_no", F.round("delivery", 6).alias("delivery"))


def excess_returns(spark: SparkSession, d: str) -> DataFrame:
    s = _series(spark, d).select("company", F.col("fy").alias("day"), F.round("sales", 2).alias("close"))
    market = s.groupBy("day").agg((F.sum(F.col("close").cast("decimal(20,2)")) / 1000).cast("double").alias("level"))
    return scores.adjusted_returns(s, market, (1, 2)).select("company", "day", F.round("excess_1", 6).alias("excess_1"), F.round("excess_2", 6).alias("excess_2"))


def top_returns(spark: SparkSession, d: str) -> DataFrame:
    """The companies of highest sales of a year against all, by the growth of their sales in the next."""
    s = _series(spark, d)
    at = lambda y: F.max(F.when(F.col("fy") == y, F.round("sales", 2)))
    rows = s.groupBy("company").agg(at(1996).alias("sales"), at(1997).alias("next")).withColumn("growth", F.expr("try_divide(next, sales)"))
    r = scores.top_against_median(rows, "sales", "growth")
    return r.select("companies", "top", F.round("top_mean", 6).alias("top_mean"), F.round("median", 6).alias("median"), F.round("hit_rate", 6).alias("hit_rate"))


_NOT_QUERIES = {"Column", "DataFrame", "SparkSession", "Window"}
QUERIES = {k: v for k, v in list(globals().items()) if callable(v) and not k.startswith("_") and getattr(v, "__module__", "") == __name__ and k not in _NOT_QUERIES}
