"""Scores that are specified beside the main rankings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

# Weights of the composite score and the addition for buying promoters.
WEIGHTS = {"credibility": 0.15, "growth": 0.20, "valuation": 0.35, "acceleration": 0.25}
PROMOTER_BONUS = 0.5


def counted(df: DataFrame, stage: str) -> tuple[DataFrame, Observation]:
    """A stage of a pipeline with the number of its rows, observed while it runs: no second pass."""
    o = Observation(stage)
    return df.observe(o, F.count(F.lit(1)).alias("rows")), o


def has_target(metric: Column) -> Column:
    return F.lower(F.coalesce(metric, F.lit("none"))) != "none"


def composite(rows: DataFrame) -> DataFrame:
    """`score` of rows with the four parts (0 to 10) and promoter_buying; a missing part counts 0."""
    total = sum((F.coalesce(F.col(k), F.lit(0.0)) * w for k, w in WEIGHTS.items()), F.lit(0.0))
    return rows.withColumn("score", total + F.when(F.col("promoter_buying"), F.lit(PROMOTER_BONUS)).otherwise(F.lit(0.0)))


def delivery_ratio(rows: DataFrame, quarters: int = 4) -> DataFrame:
    """(company, quarter_no, actual, guided) with delivery: the mean of actual over guided in the last quarters."""
    ratio = F.expr("try_divide(actual, guided)")
    return rows.withColumn("delivery", F.avg(ratio).over(Window.partitionBy("company").orderBy("quarter_no").rowsBetween(1 - quarters, 0)))


def adjusted_returns(prices: DataFrame, market: DataFrame, days: tuple[int, ...] = (21, 252, 504)) -> DataFrame:
    """Prices (company, day, close) and an index (day, level): for each day the return after n trading days less the index's."""
    w = Window.partitionBy("company").orderBy("day")
    rows = prices.join(market, "day")
    for n in days:
        own = F.lead("close", n).over(w) / F.col("close")
        index = F.lead("level", n).over(w) / F.col("level")
        rows = rows.withColumn(f"excess_{n}", own - index)
    return rows


def gate(candidate: DataFrame, reference: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """One row: agreement of a candidate model's targets (slug, metric, status, low) with a reference's."""
    has = lambda c: has_target(F.col(c))
    r = reference.select("slug", F.col("metric").alias("r_metric"), F.col("status").alias("r_status"), F.col("low").alias("r_low"))
    both = candidate.join(r, "slug")
    ok = has("metric") & has("r_metric") & (F.col("status") == "ok") & (F.col("r_status") == "ok")
    return both.agg(F.count("*").alias("companies"), F.count_if(has("metric") == has("r_metric")).alias("has_target_agree"), F.count_if(ok).alias("both_ok"), F.count_if(ok & (F.abs(F.col("low") - F.col("r_low")) <= tolerance)).alias("within_tolerance"))


def top_overlap(a: DataFrame, b: DataFrame, key: str, by: str, n: int) -> DataFrame:
    """One row: how many of the n best of two lists they share. Only ranked values count; ties go by key."""
    top = lambda t: t.where(F.col(by).isNotNull() & (F.col(by) > float("-inf"))).orderBy(F.col(by).desc(), key).limit(n).select(key)
    return top(a).intersect(top(b)).agg(F.count("*").alias("shared"))


def top_against_median(rows: DataFrame, by: str, outcome: str, share: float = 0.05) -> DataFrame:
    """One row: the top `share` of rows by a score against all: (companies, top, top_mean, median, hit_rate).

    hit_rate: how many of the top have an outcome above the median. Rows without a score or an
    outcome don't take part; ties at the border are all in the top.
    """
    known = rows.where(F.col(by).isNotNull() & F.col(outcome).isNotNull()).select(F.col(by).alias("s"), F.col(outcome).alias("o"))
    # the border and the median are two numbers; no window over all rows
    facts = known.agg(F.percentile("s", 1 - share).alias("border"), F.percentile("o", 0.5).alias("median"), F.count("*").alias("companies"))
    top = known.crossJoin(F.broadcast(facts)).where("s >= border")  # facts is one row
    return top.groupBy("companies", "median").agg(F.count("*").alias("top"), F.avg("o").alias("top_mean"), F.avg((F.col("o") > F.col("median")).cast("int")).alias("hit_rate"))
