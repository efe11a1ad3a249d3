"""The extraction step behind a replaceable function, and the request files of a remote model.

An extractor is any function (texts) -> list of item lists; it runs on workers in
batches. The rule-based one below is deterministic and needs no model.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.match import union_runs
from ..operators.text import passes_filter

Extractor = Callable[[list[str], int], list[list[dict]]]

_FUTURE = re.compile(r"\b(?:will|should|expect\w*|target\w*|guid\w+|plan\w*|aim\w*|likely|by FY\d{2}|in FY\d{2})\b", re.I)
_AMOUNT = re.compile(r"(\d[\d,]*(?:\.\d+)?(?:\s*(?:-|to)\s*\d[\d,]*(?:\.\d+)?)?)\s*(%|bps|basis points|crore|lakh|million|billion|times|MW|tons?|tonnes?)", re.I)
_TIMELINE = re.compile(r"\b((?:[HQ][1-4] )?FY\d{2}(?:\s*-\s*FY?\d{2})?|next year|this fiscal year|the coming quarter)\b", re.I)
_FIELDS = ("passage", "metric_description", "guidance_value", "guidance_unit", "timeline")


def rule_extractor(texts: list[str], run: int) -> list[list[dict]]:
    """Sentences that look ahead and tell an amount."""
    out = []
    for text in texts:
        items = []
        for sentence in re.split(r"(?<=[.!?])\s+(?=[A-Z])", text or ""):
            amount = _AMOUNT.search(sentence)
            if amount and _FUTURE.search(sentence):
                when = _TIMELINE.search(sentence)
                items.append({"passage": sentence.strip(), "metric_description": sentence.strip()[:80], "guidance_value": re.sub(r"\s*to\s*", "-", amount[1]), "guidance_unit": amount[2], "timeline": when[1] if when else ""})
        out.append(items)
    return out


def extract(chunks: DataFrame, extractor: Extractor = rule_extractor, runs: int = 2, prefilter: bool = True) -> DataFrame:
    """(doc, chunk_no, run_index, ord, item fields) of chunks (doc, chunk_no, role, text).

    Only candidate chunks reach the extractor. A chunk for which it raises has no
    items in that run; `ord` counts within the chunk over its runs.
    """
    rows = chunks.where(passes_filter(F.col("role"), F.col("text"))) if prefilter else chunks
    rows = rows.select("doc", "chunk_no", "text").withColumn("run_index", F.explode(F.array(*map(F.lit, range(runs)))))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for doc, chunk, text, r in zip(b["doc"], b["chunk_no"], b["text"], b["run_index"]):
                try:
                    items = extractor([text], int(r))[0]
                except Exception:
                    items = []
                out += [(doc, chunk, r, int(r) * 100_000 + k, *(i.get(f) for f in _FIELDS)) for k, i in enumerate(items)]
            yield pd.DataFrame(out, columns=["doc", "chunk_no", "run_index", "ord", *_FIELDS])

    t = dict(rows.dtypes)
    return rows.mapInPandas(run, f"doc {t['doc']}, chunk_no {t['chunk_no']}, run_index int, ord int, {', '.join(f'{f} string' for f in _FIELDS)}")


def merged(items: DataFrame, threshold: float = 0.85) -> DataFrame:
    """The items that stand for the union of two runs."""
    keyed = items.withColumn("chunk", F.concat_ws("/", F.col("doc").cast("string"), F.col("chunk_no").cast("string")))
    kept = union_runs(keyed.select("chunk", F.col("run_index").alias("run"), "ord", "passage"), threshold)
    kept = kept.select(F.col("chunk").alias("__c"), F.col("kept_as").alias("__o")).distinct()
    return keyed.join(kept, (F.col("chunk") == F.col("__c")) & (F.col("ord") == F.col("__o"))).drop("__c", "__o", "chunk")


def requests(texts: DataFrame, model: str, prompt: str, schema: str) -> DataFrame:
    """(custom_id, line): a request in JSON for each (doc, text) of a remote batch."""
    content = F.replace(F.lit(prompt), F.lit("{transcript}"), F.coalesce("text", F.lit("")))
    body = F.struct(F.lit(model).alias("model"), F.lit(0).alias("temperature"), F.array(F.struct(F.lit("user").alias("role"), content.alias("content"))).alias("messages"), F.lit(schema).alias("response_format"))
    line = F.to_json(F.struct(F.col("doc").cast("string").alias("custom_id"), F.lit("POST").alias("method"), body.alias("body")))
    return texts.select(F.col("doc").cast("string").alias("custom_id"), line.alias("line"))


def manifest(texts: DataFrame, prompt: str, schema: str) -> DataFrame:
    """(doc, chars, prompt_sha, schema_sha, request_sha) beside the requests; request_sha is of the prompt with its text filled in."""
    filled = F.replace(F.lit(prompt), F.lit("{transcript}"), F.coalesce("text", F.lit("")))
    return texts.select("doc", F.length("text").alias("chars"), F.sha2(F.lit(prompt), 256).alias("prompt_sha"), F.sha2(F.lit(schema), 256).alias("schema_sha"), F.sha2(filled, 256).alias("request_sha"))


#: Fields of a proposal of ground truth, one for each candidate of an answer.
PROPOSAL = (
    "candidate_id int, passage string, speaker string, page_number int, section string, metric string, metric_is_novel boolean, guidance_value string, guidance_unit string, "
    "timeline string, horizon string, level string, track string, credibility_scorable boolean, uncertain boolean, adjudication_note string"
)


def answers(lines: DataFrame) -> DataFrame:
    """(doc, state, content) of the lines (line) of a batch's output: state is done, failed or unreadable."""
    from pyspark.sql.types import StringType, StructField, StructType

    text = lambda *names: StructType([StructField(n, StringType()) for n in names])
    schema = StructType([StructField("custom_id", StringType()), StructField("error", StringType()), StructField("response", StructType([StructField("status_code", StringType()), StructField("body", text("output_text"))]))])
    j = F.from_json("line", schema)
    rows = lines.select(j.alias("j"))
    fine = (F.col("j.response.status_code") == "200") & F.col("j.error").isNull()
    state = F.when(F.col("j.custom_id").isNull(), "unreadable").when(F.coalesce(fine, F.lit(False)), "done").otherwise("failed")
    return rows.select(F.col("j.custom_id").alias("doc"), state.alias("state"), F.when(fine, F.col("j.response.body.output_text")).alias("content"))


def batch_status(sent: DataFrame, got: DataFrame) -> DataFrame:
    """(doc, state) of every request sent (doc): done, failed, or waiting if it has no answer yet; of several answers the best counts."""
    rank = F.when(F.col("state") == "done", 0).otherwise(1)
    best = got.where("doc is not null").groupBy(F.col("doc").alias("__d")).agg(F.min_by("state", rank).alias("state"))
    return sent.select("doc").join(best, F.col("doc").cast("string") == F.col("__d"), "left").select("doc", F.coalesce("state", F.lit("waiting")).alias("state"))


def to_send(sent: DataFrame, done: DataFrame, force: bool = False) -> DataFrame:
    """Documents (doc, text) still to be asked about: those with a text and, unless forced, without an answer."""
    rows = sent.where(F.trim("text") != "")
    return rows if force else rows.join(done.select(F.col("doc").alias("__d")), F.col("doc").cast("string") == F.col("__d"), "left_anti")


def proposals(got: DataFrame) -> DataFrame:
    """One row for each candidate in the answers (doc, content), with the fields of PROPOSAL; `place` is its order. Answers that are no such JSON have none."""
    schema = f"struct<company:string, quarter:string, candidates:array<struct<{', '.join(f.strip().replace(' ', ':') for f in PROPOSAL.split(','))}>>>"
    rows = got.where("content is not null").select("doc", F.from_json("content", schema).alias("j"))
    return rows.select("doc", F.col("j.company").alias("company"), F.col("j.quarter").alias("quarter"), F.posexplode("j.candidates").alias("place", "c")).select("doc", "company", "quarter", "place", "c.*")


def classify_metric(description: Column, unit: Column) -> Column:
    """A metric for a description: the rule behind which a model can be put."""
    d, percent = F.lower(F.coalesce(description, F.lit(""))), F.lower(F.coalesce(unit, F.lit(""))).rlike(r"%|percent|pct|bps")
    has = lambda *w: d.rlike("|".join(w))
    snake = F.regexp_replace(F.regexp_replace(F.regexp_replace(d, r"\s+(of|by|in)\s.*$", ""), "[^a-z0-9]+", "_"), "^_+|_+$", "")
    return (
        F.when(has("commission"), "commissioning_event")
        .when(has("capex", "capital outlay"), "capex_absolute")
        .when(has("gross margin"), "gross_margin_pct")
        .when(has("ebitda margin", "operating margin"), "ebitda_margin_pct")
        .when(has("pbt margin"), "pbt_margin_pct")
        .when(has("volume growth"), "volume_growth_pct")
        .when(has("pat growth", "profit growth"), F.when(percent, "pat_growth_pct").otherwise("pat_absolute"))
        .when(has(r"\bpat\b", "profit after tax"), "pat_absolute")
        .when(has("revenue growth", "sales growth"), "revenue_growth_pct")
        .when(has("revenue", "topline"), F.when(percent, "revenue_growth_pct").otherwise("revenue_absolute"))
        .when(has("capacity addition"), "capacity_addition")
        .otherwise(F.concat(F.lit("other_"), snake))
    )
