"""Scans: documents, feeds, item files, ground truth, cohort files.

Network and PDF parsing stay outside the engine: a feed is landed JSON, a page
cache is a table of (key, html), a PDF becomes (doc, page_no, text) once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import fiscal, series
from ..operators.dedup import by_priority, first_by
from ..operators.text import market_cap, quote_url, urls
from . import schemas


# --- documents ------------------------------------------------------------------------------------


def binary_files(spark: SparkSession, path: str, pattern: str = "*.pdf") -> DataFrame:
    """(doc, size, magic, content) of the files in a folder; magic is the text of the first four bytes."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    doc = F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1)
    return rows.select(doc.alias("doc"), F.col("length").alias("size"), F.decode(F.substring("content", 1, 4), "ISO-8859-1").alias("magic"), "content")


def pdf_pages(files: DataFrame, reader: Callable[[bytes], list[str | None]] | None = None) -> DataFrame:
    """(doc, page_no, text) of (doc, content). Page numbers are positions; unreadable files have no rows, empty pages null text.

    `reader` turns the bytes of a file into its page texts; by default a PDF library
    if one is installed on the workers.
    """

    def read(content: bytes) -> list[str | None]:
        if reader is not None:
            return reader(content)
        import io

        import pdfplumber  # optional

        with pdfplumber.open(io.BytesIO(content)) as pdf:
            return [p.extract_text() for p in pdf.pages]

    def pages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, content in zip(batch["doc"], batch["content"]):
                try:
                    texts = read(content)
                except Exception:
                    continue
                out += [(doc, n, t) for n, t in enumerate(texts, 1)]
            yield pd.DataFrame(out, columns=["doc", "page_no", "text"])

    return files.select("doc", "content").mapInPandas(pages, "doc string, page_no int, text string")


def whole_text(pages: DataFrame, markers: bool = True, first: int | None = None) -> DataFrame:
    """(doc, text): pages in their order. markers: '[Page N]' above each page, a blank line between, empty pages left out; without, plain concatenation. first: only so many pages."""
    rows = pages.where(F.coalesce("text", F.lit("")) != "")
    if first is not None:
        rows = rows.where(F.col("page_no") <= first)
    part = F.concat(F.lit("[Page "), F.col("page_no").cast("string"), F.lit("]\n"), F.col("text")) if markers else F.col("text")
    got = rows.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("page_no", part.alias("t")))).alias("p"))
    docs = pages.select("doc").distinct()
    return docs.join(got, "doc", "left").select("doc", F.coalesce(F.array_join(F.col("p.t"), "\n\n" if markers else ""), F.lit("")).alias("text"))


def first_text(pages: DataFrame, n: int = 6) -> DataFrame:
    """(doc, text, pages): lower-case text of the first n pages and the number of pages."""
    rows = pages.groupBy("doc").agg(F.array_sort(F.collect_list(F.when(F.col("page_no") <= n, F.struct("page_no", F.coalesce("text", F.lit("")).alias("t"))))).alias("p"), F.max("page_no").alias("pages"))
    return rows.select("doc", F.lower(F.array_join(F.col("p.t"), "\n")).alias("text"), "pages")


# --- feeds ----------------------------------------------------------------------------------------


def announcements(spark: SparkSession, path: str) -> DataFrame:
    """Landed pages of an announcement feed, one JSON object a line, as filings with their sub-category."""
    rows = spark.read.schema(schemas.ANNOUNCEMENT).json(path)
    name = quote_url(F.col("NSURL"))
    return rows.select(F.col("SCRIP_CD").alias("scrip"), F.trim("SLONGNAME").alias("name"), F.col("NEWS_DT").alias("news_dt"), F.col("ATTACHMENTNAME").alias("attachment"), F.col("SUBCATNAME").alias("subcategory"), F.col("HEADLINE").alias("headline"), name["ticker"].alias("nse_ticker"), name["slug"].alias("slug"))


def transcript_filings(filings: DataFrame, headline_too: bool = False) -> DataFrame:
    """Filings whose sub-category (or headline) says transcript and that have an attachment and a scrip."""
    says = lambda c: F.lower(F.coalesce(F.col(c), F.lit(""))).contains("transcript")
    told = says("subcategory") | says("headline") if headline_too else says("subcategory")
    filled = lambda c: F.coalesce(F.trim(c), F.lit("")) != ""
    return filings.where(told & filled("attachment") & filled("scrip"))


def wrongly_tagged(filings: DataFrame, known: DataFrame) -> DataFrame:
    """The earliest filing of each unknown scrip that reads like a transcript under another tag."""
    t = F.lower(F.concat_ws(" ", "subcategory", "headline"))
    strict = F.lower(F.coalesce("subcategory", F.lit(""))).contains("transcript")
    rows = filings.where(t.rlike(r"transcript|con\s*call|earnings call|analyst meet") & ~strict)
    rows = rows.join(known.select(F.col("scrip").alias("__k")).distinct(), F.col("scrip") == F.col("__k"), "left_anti")
    return first_by(rows, ["scrip"], [F.col("news_dt").asc_nulls_last(), "attachment"])


def date_windows(ranges: DataFrame, days: int = 28) -> DataFrame:
    """(from, to) as consecutive windows (start, end) of at most `days` days; a range that ends before it begins has none."""
    rows = ranges.where(F.col("from") <= F.col("to"))
    starts = F.explode(F.expr(f"sequence(`from`, `to`, interval {days} days)")).alias("start")
    return rows.select("*", starts).withColumn("end", F.least(F.date_add("start", days - 1), F.col("to")))


def filing_for_quarter(filings: DataFrame, when: str = "news_dt", transcripts: bool = False) -> DataFrame:
    """(scrip, quarter, fy, attachment, news_dt): the earliest filing of each scrip and reported quarter.

    transcripts: only of those whose sub-category or headline says transcript.
    """
    if transcripts:
        filings = transcript_filings(filings, True)
    q = fiscal.reported_quarter(F.col(when).cast("date"))
    rows = filings.withColumns({"quarter": q["quarter"], "fy": q["fy"]})
    return rows.groupBy("scrip", "quarter", "fy").agg(F.min_by("attachment", F.struct(when, "attachment")).alias("attachment"), F.min(when).alias(when))


# --- masters and cohort files ---------------------------------------------------------------------


def exchange_master(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """An exchange's list of companies, from its JSON or its CSV with padded names; rows without an id are dropped."""
    if kind == "json":
        rows = spark.read.schema("SCRIP_CD string, scrip_id string, ISIN_NUMBER string, Scrip_Name string, NSURL string, Mktcap string").json(path)
        rows = rows.select(F.col("SCRIP_CD").alias("scrip"), F.col("scrip_id").alias("ticker"), F.col("ISIN_NUMBER").alias("isin"), F.col("Scrip_Name").alias("name"), F.col("NSURL").alias("nsurl"), F.replace("Mktcap", F.lit(","), F.lit("")).try_cast("double").alias("bse_mcap_cr"), F.lit("BSE").alias("exchanges"))
        return rows.where("scrip is not null and trim(scrip) <> ''")
    rows = spark.read.option("header", True).option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).csv(path)
    by = {c.strip().upper(): c for c in rows.columns}
    col = lambda n: F.trim(F.col(f"`{by[n]}`"))
    rows = rows.select(F.lit("").alias("scrip"), col("SYMBOL").alias("ticker"), col("ISIN NUMBER").alias("isin"), col("NAME OF COMPANY").alias("name"), F.lit("").alias("nsurl"), F.lit(None).cast("double").alias("bse_mcap_cr"), F.lit("NSE").alias("exchanges"))
    return rows.where("ticker is not null and ticker <> ''")


def csv_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)


def company_names(sources: list[DataFrame]) -> DataFrame:
    """(slug, name): the name of the first source that knows a slug; sources have slug and name."""
    return by_priority([s.select("slug", "name").where("name is not null") for s in sources], ["slug"], "name")


def with_metadata(files: DataFrame, meta: DataFrame) -> DataFrame:
    """Files (slug) with their cohort row, those of unknown market cap last, by size of the company and slug."""
    rows = files.join(meta, "slug", "left").withColumn("mcap", F.coalesce("mcap", F.lit(float("inf"))))
    return rows.orderBy("mcap", "slug")


def not_yet_written(rows: DataFrame, written: DataFrame, key: str) -> DataFrame:
    """Rows whose result isn't there yet."""
    return rows.join(written.select(F.col(key).alias("__k")).distinct(), F.col(key) == F.col("__k"), "left_anti")


def cached_pages(spark: SparkSession, path: str, least: int = 500) -> DataFrame:
    """(key, html) of a page cache; files of up to `least` bytes are no hit."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", "*.html").load(path).where(F.col("length") > least)
    return rows.select(F.regexp_extract("path", r"([^/]+)\.html$", 1).alias("key"), F.decode("content", "UTF-8").alias("html"))


# --- pages of companies ---------------------------------------------------------------------------

# How a company page marks its calls.
_LI = r'(?s)<li class="flex flex-gap-8[^"]*">(.*?)</li>'
_HEADING = r"(?i)<h[1-6][\s>]"
_CALL_MONTH = r">\s*(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)\s+(20\d\d)\s*<"
_CALL_LINK = r'(?s)<a[^>]*href="([^"]+)"[^>]*>\s*Transcript\s*</a>'
_MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


def calls(pages: DataFrame) -> DataFrame:
    """(key, ord, date, fy, quarter, transcript_url): the calls a company page lists up to its next heading; entries without a date are none."""
    at = F.instr("html", ">Concalls<")
    part = F.when(at > 0, F.split(F.substring(F.col("html"), at, F.length("html")), _HEADING, 2)[0])
    rows = pages.select("key", F.posexplode(F.regexp_extract_all(part, F.lit(_LI), F.lit(1))).alias("ord", "li"))
    day = _CALL_MONTH
    month = F.array_position(F.array(*map(F.lit, _MONTHS)), F.regexp_extract("li", day, 1)).cast("int")
    rows = rows.withColumns({"m": month, "y": F.regexp_extract("li", day, 2).try_cast("int")}).where("y is not null")
    q = fiscal.reported_quarter(F.make_date("y", "m", F.lit(1)))
    link = F.regexp_extract("li", _CALL_LINK, 1)
    return rows.select("key", "ord", F.format_string("%04d-%02d", "y", "m").alias("date"), q["fy"].alias("fy"), q["quarter"].alias("quarter"), F.nullif(link, F.lit("")).alias("transcript_url"))


def pick_call(listed: DataFrame, keys: list[str] = ["key", "fy", "quarter"]) -> DataFrame:  # noqa: B006
    """One call for each company and quarter: one with a link before one without, then the page's order."""
    return first_by(listed, keys, [F.col("transcript_url").isNull(), F.col("ord")])


def nearest_month(listed: DataFrame) -> DataFrame:
    """(key, fy, quarter, transcript_url): the linked call nearest to the middle month in which a quarter is announced."""
    m = F.substring("date", 6, 2).cast("int")
    middle = F.when(F.col("quarter") == "Q4", 5).when(F.col("quarter") == "Q1", 8).when(F.col("quarter") == "Q2", 11).otherwise(2)
    return listed.where("transcript_url is not null").groupBy("key", "fy", "quarter").agg(F.min_by("transcript_url", F.struct(F.abs(m - middle), "ord")).alias("transcript_url"))


def table_cells(pages: DataFrame, heading: str) -> DataFrame:
    """(key, r, c, cell): the cells of the first table below a heading that begins with a word, tags taken out."""
    section = F.regexp_extract("html", rf"(?s)<h2[^>]*>\s*{heading}.*?<table[^>]*>(.*?)</table>", 1)
    text = F.trim(F.regexp_replace(F.regexp_replace("cell", "<[^>]+>", " "), r"\s+", " "))
    rows = pages.select("key", F.posexplode(F.regexp_extract_all(section, F.lit(r"(?s)<tr[^>]*>(.*?)</tr>"), F.lit(1))).alias("r", "row"))
    cells = rows.select("key", "r", F.posexplode(F.regexp_extract_all("row", F.lit(r"(?s)<t[hd][^>]*>(.*?)</t[hd]>"), F.lit(1))).alias("c", "cell"))
    return cells.withColumn("cell", text)


def _number(c: Column) -> Column:
    return F.replace(F.regexp_replace(c, r"[₹,%\s]", ""), F.lit("−"), F.lit("-")).try_cast("double")


def _labels(cells: DataFrame) -> DataFrame:
    return cells.where("r > 0 and c = 0").select("key", "r", F.trim(F.replace("cell", F.lit("+"), F.lit(""))).alias("label"))


def profit_grid(pages: DataFrame, labels: dict[str, str]) -> DataFrame:
    """(key, fy, one column for each of `labels`) of the annual profit table of a company page.

    Cells become long rows inside the JVM, then one aggregate over the fixed labels.
    """
    long = table_cells(pages, "Profit")
    head = long.where("r = 0").select("key", "c", F.regexp_extract("cell", r"Mar\s+(\d{4})", 1).try_cast("int").alias("fy")).where("fy is not null")
    body = long.where("r > 0 and c > 0").select("key", "r", "c", _number(F.col("cell")).alias("value"))
    return series.grid(body.join(head, ["key", "c"]).join(_labels(long), ["key", "r"]), ["key", "fy"], "label", "value", labels)


def last_column(pages: DataFrame, heading: str, labels: dict[str, str]) -> DataFrame:
    """(key, period, one column for each of `labels`): the last column of the table below a heading."""
    long = table_cells(pages, heading)
    head = long.where("r = 0").groupBy("key").agg(F.max("c").alias("c"), F.max_by("cell", "c").alias("period"))
    body = long.where("r > 0 and c > 0").select("key", "r", "c", _number(F.col("cell")).alias("value"))
    return series.grid(body.join(head, ["key", "c"]).join(_labels(long), ["key", "r"]), ["key", "period"], "label", "value", labels)


def company_snapshot(pages: DataFrame) -> DataFrame:
    """One row for each page that tells revenue and profit: figures of the last year, run rate of the last quarter, forward price to earnings."""
    annual = last_column(pages, "Profit", {"Sales": "revenue", "Net Profit": "pat", "OPM %": "ebitda_margin", "Profit before tax": "pbt"}).withColumnRenamed("period", "fiscal_year")
    quarter = last_column(pages, "Quarterly", {"Net Profit": "quarter_pat"}).withColumnRenamed("period", "quarter")
    ratio = F.regexp_extract("html", r'(?s)Stock P/E.*?<span[^>]*class="number"[^>]*>\s*([\d,]+(?:\.\d+)?)\s*</span>', 1)
    top = pages.select("key", _number(F.nullif(ratio, F.lit(""))).alias("pe"), market_cap(F.col("html")).alias("mcap"))
    rows = top.join(annual, "key").join(quarter, "key", "left").where("revenue is not null and pat is not null")
    share = lambda c: F.round(F.nullif(F.col(c), F.lit(0.0)) / F.nullif(F.col("revenue"), F.lit(0.0)) * 100, 2)
    rows = rows.withColumns({"net_margin": share("pat"), "pbt_margin": share("pbt"), "forward_pat": F.round(F.nullif(F.col("quarter_pat"), F.lit(0.0)) * 4, 1)})
    return rows.withColumn("forward_pe", F.round(F.nullif(F.col("mcap"), F.lit(0.0)) / F.nullif(F.col("forward_pat"), F.lit(0.0)), 1))


def links_in(texts: DataFrame) -> DataFrame:
    """(doc, ord, url) of the addresses in (doc, text)."""
    return texts.select("doc", F.posexplode(urls(F.col("text"))).alias("ord", "url"))


# --- items ----------------------------------------------------------------------------------------


def item_files(spark: SparkSession, path: str, item: str = schemas.ITEM) -> DataFrame:
    """(slug, call_period, ord, item fields) of JSON files that hold an object with items or a bare list of them."""
    fields = [c.split()[0] for c in item.split(", ")]
    array = f"array<struct<{', '.join(f'{c.split()[0]}: {c.split()[1]}' for c in item.split(', '))}>>"
    rows = spark.read.option("wholetext", True).text(path).select(F.regexp_extract(F.input_file_name(), r"([^/]+)\.json$", 1).alias("slug"), F.col("value").alias("body"))
    parsed = F.when(F.trim("body").startswith("["), F.from_json("body", array)).otherwise(F.from_json("body", f"struct<items: {array}>")["items"])
    rows = rows.select("slug", F.get_json_object("body", "$.call_period").alias("call_period"), F.posexplode(parsed).alias("ord", "i"))
    return rows.select("slug", "call_period", "ord", *(F.col(f"i.{f}").alias(f) for f in fields))


def ground_truth(texts: DataFrame) -> DataFrame:
    """(doc, ord, id, passage, speaker, page_number, metric, guidance_value, guidance_unit, timeline, credibility_scorable) from texts of 'key: value' blocks.

    Blocks are parted by blank lines; quotes, list dashes and the word null are taken
    off; a block counts with an id and a metric.
    """
    blocks = texts.select("doc", F.posexplode(F.split("text", r"\n\s*\n")).alias("ord", "block"))

    def field(name: str) -> Column:
        x = F.trim(F.regexp_extract("block", rf"(?m)^\s*(?:-\s*)?{name}:[ \t]*(.*)$", 1))
        x = F.regexp_replace(x, r"""^["'](.*)["']$""", "$1")
        return F.when((x != "") & (x != "null"), x)

    out = blocks.select("doc", "ord", *(field(n).alias(n) for n in ("id", "passage", "speaker", "page_number", "metric", "guidance_value", "guidance_unit", "timeline", "credibility_scorable")))
    return out.where("id is not null and metric is not null").withColumns({"id": F.col("id").try_cast("int"), "page_number": F.col("page_number").try_cast("int"), "credibility_scorable": F.col("credibility_scorable").try_cast("boolean")})
