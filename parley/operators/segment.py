"""Pages to speaker turns to sessions.

Lines and pages are plain tables: (doc, page_no, text). What depends on a whole
transcript (the alternation of its speakers, greedy packing) runs per document in
Python; the session numbers themselves are windows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import merge_join
from .match import fold_groups
from .text import strip_page

OPENING_WORDS = 600
LEAST_TURNS = 5
# Words that look like a speaker but open a paragraph, and the labels of roster blocks in their order.
NO_SPEAKER = (
    "Note", "Disclaimer", "Background", "Summary", "Conclusion", "Important", "Update", "Result", "Overview", "Outlook", "Please", "Date",
    "Venue", "Time", "Subject", "Dear", "Thanks", "Regards", "Encl", "Sir", "Madam", "Yours",
)
ROSTER_BLOCKS = ("MANAGEMENT", "PARTICIPANTS", "PARTICIPANT", "SPEAKERS", "SPEAKER")
# Where a roster block ends, how a paragraph names its speaker, and how a roster names a person.
_BLOCK_END = r"(?=^[ \t]*(?:MANAGEMENT|MODERATOR|ANALYST|PARTICIPANTS?|SPEAKERS?)\s*:|\z)"
_HEAD = r"^\s*((?:[A-Z]\.\s+){0,2}[A-Z][a-z]+(?:\s+[A-Z][a-z.]*){0,3})\s*:"
_PERSON = r"(?i)(?:MR|MS|MRS|DR)\.\s+([A-Z][A-Za-z.]+(?:\s+[A-Z][A-Za-z.]+){0,2})\s*[–\-:]"


def clean_pages(pages: DataFrame, first_page: int = 3) -> DataFrame:
    """(doc, page_no, text) of the content pages without page furniture."""
    return pages.where(F.col("page_no") >= first_page).select("doc", "page_no", strip_page(F.col("text")).alias("text"))


def page_bounds(pages: DataFrame) -> DataFrame:
    """(doc, page_no, start, end): where each page lies in the document's text, pages joined by one line feed."""
    before = Window.partitionBy("doc").orderBy("page_no").rowsBetween(Window.unboundedPreceding, -1)
    n = F.length(F.coalesce("text", F.lit(""))).cast("bigint")
    start = F.coalesce(F.sum(n + 1).over(before), F.lit(0))
    return pages.select("doc", "page_no", start.alias("start"), (start + n).alias("end"))


def page_of(offsets: DataFrame, bounds: DataFrame) -> DataFrame:
    """`offsets` (doc, offset, ...) with page_no: the page an offset lies in, else the document's last.

    An as-of join: both tables in one ordered stream per document, the last page begun
    at or before an offset is carried along. No pair of an offset and a page is made
    that isn't the answer.
    """
    extra = [c for c in offsets.columns if c not in ("doc", "offset")]
    b = bounds.select("doc", F.col("start").alias("offset"), F.lit(0).alias("__is"), "page_no", "end", *(F.lit(None).cast(offsets.schema[c].dataType).alias(c) for c in extra))
    o = offsets.select("doc", "offset", F.lit(1).alias("__is"), F.lit(None).cast("int").alias("page_no"), F.lit(None).cast("bigint").alias("end"), *extra)
    upto = Window.partitionBy("doc").orderBy("offset", "__is").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("doc")
    rows = b.unionByName(o).withColumns({"__page": F.last("page_no", True).over(upto), "__end": F.last("end", True).over(upto), "__last": F.max("page_no").over(whole)})
    page = F.when(F.col("offset") < F.col("__end"), F.col("__page")).otherwise(F.col("__last"))
    return rows.where("__is = 1").select("doc", "offset", *extra, page.alias("page_no"))


def roster(page: Column, block: str) -> Column:
    """Names with a title in a block of the participant page, as an array."""
    body = F.regexp_extract(page, rf"(?smi)^[ \t]*{block}\s*:(.*?){_BLOCK_END}", 1)
    names = F.regexp_extract_all(body, F.lit(_PERSON), F.lit(1))
    return F.array_distinct(F.transform(names, lambda n: F.initcap(F.trim(F.regexp_replace(n, r"\s+", " ")))))


def management(page: Column) -> Column:
    """Names of the first roster block that has any."""
    blocks = [roster(page, b) for b in ROSTER_BLOCKS]
    out = blocks[-1]
    for b in reversed(blocks[:-1]):
        out = F.when(F.size(b) > 0, b).otherwise(out)
    return out


def in_roster(name: Column, names: Column) -> Column:
    """Whether a name is in a roster: as it is, or a single word of four letters or more as a last name."""
    single = ~F.contains(F.trim(name), F.lit(" ")) & (F.length(F.trim(name)) >= 4)
    return F.array_contains(names, name) | (single & F.exists(names, lambda n: F.lower(F.element_at(F.split(n, " "), -1)) == F.lower(F.trim(name))))


def speaker_counts(documents: DataFrame) -> DataFrame:
    """(doc, name, n): how often each name heads a paragraph of (doc, text)."""
    paragraphs = documents.select("doc", F.explode(F.split("text", r"(?:\n[ \t]*){2,}")).alias("p"))
    name = F.trim(F.regexp_extract("p", _HEAD, 1))
    return paragraphs.select("doc", name.alias("name")).where((F.col("name") != "") & ~F.col("name").isin(*sorted(NO_SPEAKER))).groupBy("doc", "name").agg(F.count("*").alias("n"))


def extract_turns(documents: DataFrame) -> DataFrame:
    """(doc, turn_no, speaker, role, text, char_start, char_end) from (doc, text, management, moderators).

    Speakers of a document are split at its own names, longer ones first; empty turns
    are left out. moderator: the word itself or a name of that roster; management by
    in_roster; everybody else is an analyst.
    """

    def turns(batches):
        head = re.compile(_HEAD)
        for batch in batches:
            out = []
            for doc, text, mgmt, mods in zip(batch["doc"], batch["text"], batch["management"], batch["moderators"]):
                text = text or ""
                mgmt, mods = set(mgmt if mgmt is not None else ()), set(mods if mods is not None else ())
                lasts = {m.split()[-1].lower() for m in mgmt if m}
                names = set()
                for p in re.split(r"(?:\n[ \t]*){2,}", text):
                    line = next((x for x in p.split("\n") if x.strip()), "")
                    if (m := head.match(line)) and m.group(1).strip() not in NO_SPEAKER:
                        names.add(m.group(1).strip())
                if not names:
                    continue
                split = re.compile(r"^\s*(" + "|".join(re.escape(n) for n in sorted(names, key=lambda n: (-len(n), n))) + r")\s*:", re.M)
                found = list(split.finditer(text))
                for k, m in enumerate(found):
                    end = found[k + 1].start() if k + 1 < len(found) else len(text)
                    said = re.sub(" {2,}", " ", text[m.end() : end].replace("\n", " ")).strip()
                    if not said:
                        continue
                    who = m.group(1).strip()
                    single = " " not in who and len(who) >= 4
                    role = "moderator" if who.lower() in ("moderator", "operator") or who in mods else "management" if who in mgmt or single and who.lower() in lasts else "analyst"
                    out.append((doc, k + 1, who, role, said, m.start(), end))
            yield pd.DataFrame(out, columns=["doc", "turn_no", "speaker", "role", "text", "char_start", "char_end"])

    t = dict(documents.dtypes)["doc"]
    return documents.select("doc", "text", "management", "moderators").mapInPandas(turns, f"doc {t}, turn_no int, speaker string, role string, text string, char_start int, char_end int")


def turn_ends(turns: DataFrame, doc_length: Column) -> DataFrame:
    """Turns with char_end: the start of the next turn of the document, or the document's length."""
    return turns.withColumn("char_end", F.lead("char_start").over(Window.partitionBy("doc").orderBy("char_start", "turn_no"))).withColumn("char_end", F.coalesce("char_end", doc_length))


def sessions(turns: DataFrame) -> DataFrame:
    """`turns` (doc, turn_no, speaker, role, ...) with session: null before the first analyst, then the number of the analyst's engagement.

    A new engagement begins where an analyst speaks who isn't the one who spoke before;
    moderators between two engagements belong to the next, those within one stay, and
    trailing ones stay with the last.
    """
    order = Window.partitionBy("doc").orderBy("turn_no")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    analyst = F.when(F.col("role") == "analyst", F.col("speaker"))
    rows = turns.withColumns({"__a": analyst, "__before": F.last(analyst, True).over(order.rowsBetween(Window.unboundedPreceding, -1))})
    rows = rows.withColumn("__new", (F.col("__a").isNotNull() & ~F.col("__a").eqNullSafe(F.col("__before"))).cast("int"))
    rows = rows.withColumn("__no", F.sum("__new").over(upto))
    # a moderator takes the number of the next turn that is none; read backwards, so that the frame only grows
    later = Window.partitionBy("doc").orderBy(F.col("turn_no").desc()).rowsBetween(Window.unboundedPreceding, -1)
    following = F.last(F.when(F.col("role") != "moderator", F.col("__no")), True).over(later)
    number = F.when(F.col("role") == "moderator", F.coalesce(following, F.col("__no"))).otherwise(F.col("__no"))
    return rows.withColumn("session", F.when(number > 0, number)).drop("__a", "__before", "__new", "__no")


def chunk_turns(turns: DataFrame, limit: int = OPENING_WORDS) -> DataFrame:
    """`turns` (doc, turn_no, speaker, role, text) with chunk_no, chunk_type and analyst_speaker.

    Opening: turns up to the first analyst, packed greedily up to `limit` words;
    moderators wait for the next management turn, at the end of a call without analysts
    they join the last chunk. Then one chunk for each engagement of `sessions`. Moderators
    that open a document without anything else have no chunk (null).
    """
    parts = sessions(turns)

    def pack(items: list[dict]) -> Iterator[tuple]:
        number, words, last = 0, 0, max((i for i, x in enumerate(items) if x["role"] != "moderator"), default=-1)
        for i, x in enumerate(items):
            if last < 0:
                return
            if i <= last and (not number or words + x["words"] > limit):
                number, words = number + 1, 0
            words += x["words"]
            yield x["turn_no"], number

    opening = parts.where("session is null").select("doc", "turn_no", "role", F.size(F.split(F.trim("text"), r"\s+")).alias("words"))
    packed = fold_groups(opening, ["doc"], ["turn_no", "role", "words"], pack, {"turn_no": dict(parts.dtypes)["turn_no"], "opening_no": "int"})
    packed = packed.withColumnRenamed("doc", "__d").withColumnRenamed("turn_no", "__n")
    rows = merge_join(parts, packed, (F.col("doc") == F.col("__d")) & (F.col("turn_no") == F.col("__n")), "left").drop("__d", "__n")
    last = F.max("opening_no").over(Window.partitionBy("doc"))
    in_session = Window.partitionBy("doc", "session").orderBy("turn_no").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    asked = F.first(F.when(F.col("role") == "analyst", F.col("speaker")), True).over(in_session)
    rows = rows.withColumns({"chunk_no": F.when(F.col("session").isNull(), F.col("opening_no")).otherwise(F.coalesce(last, F.lit(0)) + F.col("session")), "chunk_type": F.when(F.col("session").isNotNull(), "qa_session").when(F.col("opening_no").isNotNull(), "opening_remarks"), "analyst_speaker": F.when(F.col("session").isNotNull(), asked)})
    return rows.drop("opening_no", "session")


def build_chunks(turns: DataFrame) -> DataFrame:
    """(doc, chunk_no, chunk_type, speaker, analyst_speaker, text, word_count, n_turns) from chunk_turns.

    speaker is the first of management, else the first; text is 'Role (Speaker): said', turns parted by a blank line.
    """
    place = F.struct("turn_no", "speaker", "role", "text")
    rows = turns.where("chunk_no is not null").groupBy("doc", "chunk_no").agg(F.first("chunk_type").alias("chunk_type"), F.max("analyst_speaker").alias("analyst_speaker"), F.array_sort(F.collect_list(place)).alias("t"))
    managers = F.filter("t", lambda x: x["role"] == "management")
    text = F.array_join(F.transform("t", lambda x: F.concat(F.initcap(x["role"]), F.lit(" ("), x["speaker"], F.lit("): "), x["text"])), "\n\n")
    rows = rows.withColumn("text", text)
    speaker = F.coalesce(F.try_element_at(managers, F.lit(1))["speaker"], F.element_at("t", 1)["speaker"])
    return rows.select("doc", "chunk_no", "chunk_type", speaker.alias("speaker"), "analyst_speaker", "text", F.size(F.split(F.trim("text"), r"\s+")).alias("word_count"), F.size("t").alias("n_turns"))


def page_chunks(pages: DataFrame) -> DataFrame:
    """Degraded mode: one chunk for each page with text."""
    rows = pages.where(F.trim("text") != "")
    return rows.select("doc", F.row_number().over(Window.partitionBy("doc").orderBy("page_no")).alias("chunk_no"), F.lit("management_solo").alias("chunk_type"), F.lit("Unknown").alias("speaker"), F.lit(None).cast("string").alias("analyst_speaker"), F.trim("text").alias("text"), F.size(F.split(F.trim("text"), r"\s+")).alias("word_count"), F.lit(1).alias("n_turns"))


def segment(pages: DataFrame, first_page: int = 3) -> DataFrame:
    """Chunks of (doc, page_no, text): by sessions, or by page for documents with fewer than LEAST_TURNS turns."""
    content = clean_pages(pages, first_page)
    text = content.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("page_no", "text"))).alias("p")).select("doc", F.array_join(F.col("p.text"), "\n").alias("text"))
    second = pages.where("page_no = 2").select(F.col("doc").alias("__d"), management(F.col("text")).alias("management"), roster(F.col("text"), "MODERATOR").alias("moderators"))
    turns = extract_turns(text.join(second, F.col("doc") == F.col("__d"), "left"))
    rich = turns.groupBy(F.col("doc").alias("__d")).agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_TURNS).select("__d")
    by_session = build_chunks(chunk_turns(turns.join(rich, F.col("doc") == F.col("__d"), "left_semi")))
    by_page = page_chunks(content.join(rich, F.col("doc") == F.col("__d"), "left_anti"))
    return by_session.unionByName(by_page)
