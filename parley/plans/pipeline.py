"""The staged pipeline from pages to validated items, with the number of rows at each stage boundary."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..operators import segment, validate, values
from ..operators.text import collapse
from .extraction import Extractor, classify_metric, extract, merged, rule_extractor
from .scores import counted


@dataclass
class Result:
    """`items` and `rejected` are lazy; `stages` have their counts once a result was computed."""

    items: DataFrame
    rejected: DataFrame
    stages: dict[str, Observation]

    def counts(self) -> dict[str, int]:
        """Rows at the stage boundaries; call it after an action on `items`."""
        return {k: o.get["rows"] for k, o in self.stages.items()}


def staged(pages: DataFrame, calls: DataFrame, extractor: Extractor = rule_extractor, first_page: int = 3) -> Result:
    """Segment, filter, extract twice and merge, classify, validate, drop repeats.

    pages: doc, page_no, text; calls: doc, call_date. Documents without a call date
    have no items, those without text no rows anywhere. Items tell by found_verbatim
    whether their passage stands in the text of the document's pages.
    """
    stages: dict[str, Observation] = {}

    def stage(name: str, df: DataFrame) -> DataFrame:
        df, stages[name] = counted(df, name)
        return df

    chunks = stage("chunks", segment.segment(pages, first_page).withColumn("role", F.lit("management")))
    raw = stage("extracted", merged(extract(chunks.select("doc", "chunk_no", "role", "text"), extractor)))
    items = raw.select(
        "doc", (F.col("chunk_no") * 1_000_000 + F.col("ord")).alias("ord"), F.format_string("chunk_%03d", "chunk_no").alias("chunk_id"), classify_metric(F.col("metric_description"), F.col("guidance_unit")).alias("metric"),
        F.col("guidance_value").alias("value"), F.col("guidance_unit").alias("unit"), "timeline", "passage", F.lit(None).cast("int").alias("page"),
    )
    said = segment.clean_pages(pages, 1).groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("page_no", "text"))).alias("p")).select("doc", collapse(F.array_join("p.text", "\n")).alias("plain_transcript"))
    checked = validate.apply_rules(items.join(calls.select("doc", "call_date"), "doc").join(said, "doc", "left"))
    once = validate.exact_repeats(checked)
    kept = validate.fuzzy_repeats(once).select(F.col("doc").alias("__d"), F.col("kept_as").alias("__o")).distinct()
    valid = once.where("kept").join(kept, F.col("doc").eqNullSafe(F.col("__d")) & (F.col("ord") == F.col("__o")), "left_semi")
    out = valid.select("doc", "ord", "chunk_id", "metric", F.col("clean_value").alias("guidance_value"), F.col("unit").alias("guidance_unit"), F.col("clean_timeline").alias("timeline"), "passage", values.credible_metric(F.col("metric")).alias("credibility_scorable"), "found_verbatim")
    return Result(stage("valid", out), validate.rejections(checked), stages)
