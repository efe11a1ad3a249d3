"""Validation of extracted items: rules one after the other, a log of what was rejected, and two passes against repeats.

Items: doc, ord, chunk_id, metric, value, unit, timeline, passage, page, call_date
(and, if passages are to be looked up, transcript, or better plain_transcript, in which
white space was collapsed once for the document and not for each item).
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import fiscal, values
from .match import fold_groups, similarity_above
from .text import collapse


def apply_rules(items: DataFrame) -> DataFrame:
    """Items with rule, reason, value and timeline as they come out; rule is null for those that pass.

    rule1: no value, commissioning events apart. rule2: a value that is no number or
    range. rule3: a timeline that ended before the quarter of the call began; one that
    can't be normalised has no end. found_verbatim only informs. Commissioning events
    lose their value.
    """
    event = F.col("metric") == "commissioning_event"
    # step by step, so that no expression is repeated inside another
    rows = items.withColumns({"__clean": values.clean_value(F.col("value")), "clean_timeline": fiscal.normalize_timeline(F.col("timeline"), F.col("call_date")), "__start": fiscal.quarter_start(F.col("call_date"))})
    rows = rows.withColumn("__end", fiscal.timeline_end(F.col("clean_timeline")))
    rows = rows.withColumn("rule", F.when(~event & F.col("value").isNull(), "rule1").when(F.col("value").isNotNull() & F.col("__clean").isNull(), "rule2").when(F.col("__end") < F.col("__start"), "rule3"))
    past = F.concat(F.lit("past_timeline: "), F.col("clean_timeline"), F.lit(" ended "), F.col("__end").cast("string"), F.lit(" before "), F.col("__start").cast("string"))
    reason = F.when(F.col("rule") == "rule1", "null_value_non_binary_metric").when(F.col("rule") == "rule2", "malformed_guidance_value").when(F.col("rule") == "rule3", past)
    told = F.col("plain_transcript") if "plain_transcript" in items.columns else collapse(F.col("transcript")) if "transcript" in items.columns else F.lit(None).cast("string")
    verbatim = F.when(F.coalesce(told, F.lit("")) != "", F.contains(told, collapse(F.col("passage"))))
    return rows.withColumns({"reason": reason, "clean_value": F.when(~event, F.col("__clean")), "found_verbatim": verbatim}).drop("__clean", "__start", "__end")


def rejections(checked: DataFrame) -> DataFrame:
    """(doc, ord, chunk_id, rule, reason, summary) of the rejected items."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("None"))
    summary = F.concat(F.col("metric"), F.lit(" | "), text("value"), F.lit(" "), F.coalesce("unit", F.lit("")), F.lit(" | "), text("timeline"), F.lit(" | p"), text("page"))
    return checked.where("rule is not null").select("doc", "ord", "chunk_id", "rule", "reason", summary.alias("summary"))


def exact_repeats(checked: DataFrame) -> DataFrame:
    """Passed items with `kept`: within a document the longest passage of each (metric, value, timeline), the first among equals."""
    key = ["doc", "metric", values.value_key(F.col("clean_value")), "clean_timeline"]
    passed = checked.where("rule is null")
    n = F.row_number().over(Window.partitionBy(*key).orderBy(F.length(F.coalesce("passage", F.lit(""))).desc(), "ord"))
    first = F.min("ord").over(Window.partitionBy(*key))
    return passed.withColumns({"kept": n == 1, "group_order": first})


def fuzzy_repeats(kept: DataFrame, threshold: float = 0.90) -> DataFrame:
    """(doc, ord, kept_as): each item of exact_repeats, and the item that stands for it.

    Within (doc, metric, timeline), in the order of group_order, an item joins the
    first earlier one whose passage is more than `threshold` similar; the longer
    passage stands for both, at the earlier one's place. A sequential fold: one small
    group at a time, blocked by its key.
    """

    def fold(items: list[dict]) -> Iterator[tuple]:
        places: list[list] = []  # [ord, passage, members]
        for item in items:
            ord_, passage = item["ord"], item["passage"] or ""
            for p in places:
                if similarity_above(passage, p[1], threshold) > threshold:
                    if len(passage) > len(p[1]):
                        p[0], p[1] = ord_, passage
                    p[2].append(ord_)
                    break
            else:
                places.append([ord_, passage, [ord_]])
        for p in places:
            for m in p[2]:
                yield m, p[0]

    rows = kept.where("kept")
    kind = dict(rows.dtypes)["ord"]
    folded = fold_groups(rows, ["doc", "metric", "clean_timeline"], ["group_order", "ord", "passage"], fold, {"ord": kind, "kept_as": kind})
    return folded.select("doc", "ord", "kept_as")
