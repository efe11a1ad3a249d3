"""Text operators: normalising, labels, classifiers, page fields. Column -> Column, no UDF.

Null texts give null, or what the docstring says.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.binding import let

# Phrases of the candidate filter, searched as parts of the lower-case text.
TEMPORAL = (
    "first half", "second half", "first quarter", "second quarter", "third quarter", "fourth quarter", "h1 ", "h2 ", "q1 ", "q2 ", "q3 ", "q4 ",
    "this financial year", "this fiscal year", "this fiscal", "next financial year", "next fiscal year", "next year", "coming year", "current year",
    "by end of", "by the end of", "year-end", "year end", "coming quarter", "upcoming quarter", "going forward", "full year", "annual", "next quarter",
    "next few quarters", "january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december",
)
COMMITMENT = (
    "commission", "go live", "goes live", "went live", "operationalize", "operational", "commence operations", "commencement",
    "breakeven", "break even", "break-even", "stabilize", "ramp up", "ramping up", "complete", "completion", "launch",
)
# What a transcript of a call, or a statutory document, says.
CALL_MARKERS = (
    r"earnings\s*(?:call|meet|conference)|conference\s*call|con\s*call|concall|analyst\s*(?:call|meet)|investor\s*(?:call|conference|meet)|"
    r"ladies\s+and\s+gentlemen|\bmoderator\b|\bq&a\b|question[\s-]and[\s-]answer|question\s+session|floor\s+is\s+now\s+open|(?:first|next)\s+question"
)
DIALOGUE = r"ladies\s+and\s+gentlemen|\bmoderator\b|the\s+operator|floor\s+is\s+now\s+open"
STATUTORY = (
    r"notice\s+is\s+hereby\s+given|annual\s+general\s+meeting|\b(?:board'?s?|directors?'?)\s+report|independent\s+auditor|balance\s+sheet\s+as\s+at|"
    r"statement\s+of\s+profit\s+and\s+loss|notes\s+to\s+the\s+(?:standalone\s+|consolidated\s+)?financial\s+statements|cash\s+flow\s+statement|corporate\s+governance\s+report"
)
# Lines that only furnish a page, and a page number beside a bar.
FURNITURE = (
    r"(?i)^(January|February|March|April|May|June|July|August|September|October|November|December)\s+\d{1,2},?\s+\d{4}$",
    r"(?i)^.+\b(Limited|Ltd\.?|Inc\.?|Corp\.?|Pvt\.?)$",
    r"(?i)^Page\s+\d+\s+of\s+\d+$",
)
PAGE_BAR = r"^\d+\s*\|$|^\|\s*\d+$"
# Bounds of the classifier.
MAX_PAGES = 70
DENSE, NO_TEXT = 1500, 400


def collapse(text: Column) -> Column:
    """Trimmed, every run of white space one space."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def collapse_layout(text: Column) -> Column:
    """Line feeds as spaces and runs of spaces as one, trimmed."""
    return F.trim(F.regexp_replace(F.replace(text, F.lit("\n"), F.lit(" ")), " {2,}", " "))


def timeline_key(timeline: Column) -> Column:
    return F.upper(collapse(F.coalesce(timeline, F.lit(""))))


def plain_punctuation(text: Column, spaces: bool = True) -> Column:
    """Lower case with straight quotes, hyphens and full stops; white space collapsed, or removed with spaces=False."""
    t = F.translate(text, "‘’“”–— ", "''\"\"-- ")
    t = F.lower(F.replace(t, F.lit("…"), F.lit("...")))
    return collapse(t) if spaces else F.regexp_replace(t, r"\s+", "")


_LABEL = r"(?:^|\n)\s*[A-Z][A-Za-z.]*(?: [A-Z][A-Za-z.]*){0,3}\s*:\s*"


def speaker_parts(passage: Column) -> Column:
    """The parts of a passage between speaker labels, trimmed, empty ones left out."""
    return F.filter(F.transform(F.split(passage, _LABEL), lambda p: F.trim(p)), lambda p: p != "")


def without_labels(text: Column) -> Column:
    return collapse(F.regexp_replace(text, _LABEL, " "))


def year_in_passage(passage: Column, timeline: Column) -> Column:
    """Whether a passage names a year of the timeline, as 2028, FY28, FY'28 or '28."""
    years = F.regexp_extract_all(F.coalesce(timeline, F.lit("")), F.lit(r"(\d{2,4})"), F.lit(1))
    p = F.coalesce(passage, F.lit(""))

    def named(y: Column) -> Column:
        n = y.cast("int")
        full = F.when(n > 100, n).otherwise(n + 2000)
        two = F.lpad((full % 100).cast("string"), 2, "0")
        return p.contains(full.cast("string")) | F.regexp_like(F.lower(p), F.concat(F.lit(r"fy\s*'?"), two, F.lit(r"\b"))) | F.regexp_like(p, F.concat(F.lit("'"), two, F.lit(r"\b")))

    return F.exists(years, named)


def slug(name: Column) -> Column:
    """'Asha Paints Ltd.' -> 'asha_paints'."""
    bare = F.regexp_replace(name, r"(?i)\b(Ltd|Limited)\b\.?", "")
    return F.lower(F.trim(F.regexp_replace(F.regexp_replace(bare, "[^A-Za-z0-9]+", "_"), "^_+|_+$", "")))


def quote_url(url: Column) -> Column:
    """struct(ticker, slug) of a quote page address; nulls if it is none."""
    pattern = r"/stock-share-price/([^/]+)/([^/]+)/\d+/?"
    part = lambda g: F.nullif(F.regexp_extract(url, pattern, g), F.lit(""))
    return F.struct(part(2).alias("ticker"), part(1).alias("slug"))


def loose_number(text: Column) -> Column:
    return F.replace(F.trim(text), F.lit(","), F.lit("")).try_cast("double")


# --- filters --------------------------------------------------------------------------------------


def _any(text: Column, phrases: tuple[str, ...]) -> Column:
    escaped = "|".join(p.replace("-", r"\-") for p in phrases)
    return F.coalesce(F.lower(text), F.lit("")).rlike(escaped)


def filter_reasons(text: Column, temporal: tuple[str, ...] = TEMPORAL, commitment: tuple[str, ...] = COMMITMENT) -> Column:
    """Why a chunk may hold guidance: 'digit', 'temporal' and 'commitment', joined by '+'; empty if nothing speaks for it."""
    return F.concat_ws("+", F.when(F.coalesce(text, F.lit("")).rlike(r"\d"), "digit"), F.when(_any(text, temporal), "temporal"), F.when(_any(text, commitment), "commitment"))


def passes_filter(role: Column, text: Column) -> Column:
    """Candidates: no moderator, and a digit, a time phrase or a commitment."""
    return ~F.coalesce(role == "moderator", F.lit(False)) & (filter_reasons(text) != "")


def classify_transcript(text: Column, pages: Column, sampled_pages: int = 6) -> Column:
    """OK, NOTTRANSCRIPT or NEEDS_OCR from the lower-case text of the first pages and the number of pages."""

    def told(t: Column) -> Column:
        chars = F.length(F.trim(t))
        density = chars / F.greatest(F.least(pages, F.lit(sampled_pages)), F.lit(1))
        markers = F.size(F.array_distinct(F.regexp_extract_all(t, F.lit(f"({CALL_MARKERS})"), F.lit(1))))
        by_markers = lambda n: F.when(n >= 2, "OK").when(t.rlike(STATUTORY), "NOTTRANSCRIPT").when((n >= 1) & (density > DENSE), "OK").otherwise("NOTTRANSCRIPT")
        return F.when((pages >= 3) & (chars < NO_TEXT), "NEEDS_OCR").when(pages > MAX_PAGES, "NOTTRANSCRIPT").when(t.rlike(DIALOGUE), "OK").otherwise(let(markers, by_markers))

    return let(F.coalesce(text, F.lit("")), told)


def file_verdict(size: Column, magic: Column, pages: Column, text: Column, min_pages: int = 5, verdict: Column | None = None) -> Column:
    """MISSING, BADPDF, COVER? or the classifier's word on a file; verdict: that word, where it is known already."""
    return (
        F.when(F.coalesce(size, F.lit(0)) == 0, "MISSING")
        .when(F.coalesce(magic, F.lit("")) != "%PDF", "BADPDF")
        .when(F.coalesce(pages, F.lit(-1)) < 0, "BADPDF")
        .when(pages < min_pages, "COVER?")
        .otherwise(classify_transcript(text, pages) if verdict is None else verdict)
    )


def is_page_furniture(line: Column) -> Column:
    """Whether a line is only a date, a company name or a page number."""
    day, company, number = FURNITURE
    return line.rlike(day) | line.rlike(company) | line.rlike(number)


def strip_page(page: Column) -> Column:
    """A page without furniture and blank lines at its edges; lines in the middle are never touched.

    The last line may also be a page number beside a bar.
    """
    lines = F.split(page, "\n")
    trimmed = F.transform(lines, lambda x: F.trim(x))
    n = F.size(trimmed)
    content = F.transform(trimmed, lambda x: (x != "") & ~is_page_furniture(x))
    first = F.array_position(content, True)
    last_line = n - F.array_position(F.reverse(F.transform(trimmed, lambda x: x != "")), True) + 1
    below = F.transform(trimmed, lambda x, i: (x != "") & ~is_page_furniture(x) & ~((i + 1 == last_line) & x.rlike(PAGE_BAR)))
    last = n - F.array_position(F.reverse(below), True) + 1
    empty = ~F.exists(below, lambda c: c)
    return F.when(page.isNotNull(), F.when(empty | (last < first), F.lit("")).otherwise(F.array_join(F.slice(lines, F.greatest(first, F.lit(1)), F.greatest(last - first + 1, F.lit(0))), "\n")))


# --- page fields ----------------------------------------------------------------------------------


# How a company page marks its market cap and name, how texts write addresses.
MARKET_CAP = r'(?s)Market Cap.*?<span[^>]*class="number"[^>]*>\s*([\d,]+(?:\.\d+)?)\s*</span>'
PAGE_NAME = r"<h1[^>]*>\s*([^<]+?)\s*</h1>"
ADDRESS = r"""(https?://[^\s\]\)>"']+)"""


def market_cap(html: Column) -> Column:
    """Market cap of a company page, digits grouped the Indian way."""
    x = F.regexp_extract(html, MARKET_CAP, 1)
    return F.replace(F.nullif(x, F.lit("")), F.lit(","), F.lit("")).try_cast("double")


def page_name(html: Column) -> Column:
    return F.nullif(F.regexp_extract(html, PAGE_NAME, 1), F.lit(""))


def unescape(text: Column) -> Column:
    t = text
    for k, v in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        t = F.replace(t, F.lit(k), F.lit(v))
    return t


def sector_industry(html: Column) -> Column:
    """struct(sector, industry): the last sector and the first industry a page names."""
    found = lambda tag, at: unescape(F.trim(F.try_element_at(F.regexp_extract_all(html, F.lit(tag + r'">\s*([^<]{1,60})'), F.lit(1)), F.lit(at))))
    return F.struct(found("Sector", -1).alias("sector"), found("Industry", 1).alias("industry"))


def urls(text: Column) -> Column:
    """Distinct addresses in a text in the order of their first mention, closing punctuation dropped."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(ADDRESS), F.lit(1)), lambda u: F.regexp_replace(u, r"[.,;)]+$", "")))


def first_pdf_link(html: Column, base: Column) -> Column:
    """The first link to a .pdf, made absolute against a base address."""
    href = F.nullif(F.regexp_extract(html, r"""(?i)href=["']([^"']*\.pdf[^"']*)["']""", 1), F.lit(""))
    root = F.regexp_extract(base, r"^(https?://[^/]+)", 1)
    folder = F.regexp_extract(base, r"^(https?://[^/]+(?:/.*)?)/[^/]*$", 1)
    return F.when(href.startswith("http"), href).when(href.startswith("/"), F.concat(root, href)).otherwise(F.concat(F.coalesce(F.nullif(folder, F.lit("")), base), F.lit("/"), href))


def item_label(metric: Column, value: Column, unit: Column, currency: Column, timeline: Column) -> Column:
    """'metric = value unit currency | timeline', a dash for what is missing."""
    dash, none = F.lit("—"), F.lit("")
    filled = lambda c, d: F.coalesce(F.nullif(c, none), d)
    t = F.concat(metric, F.lit(" = "), filled(value, dash), F.lit(" "), filled(unit, none), F.lit(" "), filled(currency, none), F.lit(" | "), filled(timeline, dash))
    return F.trim(F.replace(t, F.lit("  "), F.lit(" ")))


def signal_label(level: Column, metric: Column, value: Column, unit: Column, currency: Column, timeline: Column) -> Column:
    none = F.lit("")
    filled = lambda c: F.coalesce(c, none)
    head = F.concat(F.when(level != "company", F.concat(F.lit("["), level, F.lit("] "))).otherwise(none), filled(metric))
    told = F.when(filled(value) != "", F.concat(F.lit(": "), value, F.lit(" "), filled(unit), F.lit(" "), filled(currency))).otherwise(none)
    return F.trim(F.concat(head, told, F.lit(" by "), filled(timeline)))


def usage_tokens(body: Column) -> Column:
    """struct(prompt, cached, completion) tokens of a response in JSON; 0 where it tells none."""
    at = lambda path: F.coalesce(F.get_json_object(body, path).try_cast("bigint"), F.lit(0))
    return F.struct(at("$.usage.prompt_tokens").alias("prompt"), at("$.usage.prompt_tokens_details.cached_tokens").alias("cached"), at("$.usage.completion_tokens").alias("completion"))
