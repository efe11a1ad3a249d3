"""Yearly fundamentals: base figures, trailing growth, divergence of two bases, and splicing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .values import cagr


def base_and_trailing(series: DataFrame, company: str, base_year: int, lookback: int = 3) -> DataFrame:
    """One row for each company of (company, fy, sales, net_profit[, opm_pct, pbt]): figures of the base year and growth up to it.

    status: missing without both profits, base_pat_nonpositive if the earlier one is
    no profit, else ok. Conditional aggregation: one shuffle with partial sums.
    """
    at = lambda c, y: F.max(F.when(F.col("fy") == y, F.col(c)))
    has = set(series.columns)
    prior = base_year - lookback
    rows = series.groupBy(company).agg(
        at("sales", base_year).alias("revenue"), at("net_profit", base_year).alias("pat"), at("sales", prior).alias("prior_revenue"), at("net_profit", prior).alias("prior_pat"),
        *([at("opm_pct", base_year).alias("ebitda_margin")] if "opm_pct" in has else [F.lit(None).cast("double").alias("ebitda_margin")]),
        *([at("pbt", base_year).alias("pbt")] if "pbt" in has else [F.lit(None).cast("double").alias("pbt")]),
    )
    years = F.lit(float(lookback))
    status = F.when(F.col("prior_pat").isNull() | F.col("pat").isNull(), "missing").when(F.col("prior_pat") <= 0, "base_pat_nonpositive").otherwise("ok")
    share = lambda c: F.round(F.col(c) / F.nullif(F.col("revenue"), F.lit(0)) * 100, 2)
    rows = rows.withColumns({"net_margin": share("pat"), "pbt_margin": share("pbt"), "status": status})
    return rows.withColumns({"pat_cagr": F.when(F.col("status") == "ok", cagr(F.col("pat"), F.col("prior_pat"), years)), "revenue_cagr": cagr(F.col("revenue"), F.col("prior_revenue"), years)})


def grid(long: DataFrame, keys: list[str], label: str, value: str, labels: dict[str, str]) -> DataFrame:
    """Long rows (keys, label, value) as one row for each key with a column for each of the fixed labels."""
    return long.groupBy(*keys).agg(*(F.max(F.when(F.col(label) == k, F.col(value))).alias(v) for k, v in labels.items()))


def overlap_divergence(a: DataFrame, b: DataFrame, company: str) -> DataFrame:
    """(company, divergence): the largest difference of sales in percent of b over the years both have; zero or missing sales don't count."""
    both = a.select(company, "fy", F.nullif("sales", F.lit(0)).alias("__a")).join(b.select(company, "fy", F.nullif("sales", F.lit(0)).alias("__b")), [company, "fy"])
    both = both.where("__a is not null and __b is not null")
    return both.groupBy(company).agg(F.round(F.max(F.abs(F.col("__a") - F.col("__b")) / F.col("__b") * 100), 1).alias("divergence"))


def resolve(consolidated: DataFrame, standalone: DataFrame, company: str, base_year: int, lookback: int = 3, most: float = 10.0) -> DataFrame:
    """(company, fy, sales, net_profit, source): one series for each company.

    The consolidated one; with its missing earlier year borrowed from the standalone
    one if their sales differ by less than `most` percent; the standalone one if there
    is no consolidated base year; else the longer of the two.
    """
    prior = base_year - lookback
    years = lambda t, s: t.groupBy(company).agg(F.max((F.col("fy") == base_year) & F.col("sales").isNotNull()).alias(f"{s}_base"), F.max((F.col("fy") == prior) & F.col("sales").isNotNull()).alias(f"{s}_prior"), F.count("*").alias(f"{s}_n"))
    facts = years(consolidated, "c").join(years(standalone, "s"), company, "full").join(overlap_divergence(consolidated, standalone, company), company, "left")
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    source = (
        F.when(yes("c_base") & yes("c_prior"), "consolidated")
        .when(yes("c_base") & yes("s_prior") & (F.col("divergence") < most), "standalone_borrowed")
        .when(yes("c_base"), "consolidated_short")
        .when(yes("s_base"), "standalone_only")
        .otherwise("fallback_richest")
    )
    facts = facts.select(company, source.alias("source"), (F.coalesce("c_n", F.lit(0)) >= F.coalesce("s_n", F.lit(0))).alias("__c_longer"))
    columns = [company, "fy", "sales", "net_profit"]
    rows = consolidated.select(*columns, F.lit("c").alias("__t")).unionByName(standalone.select(*columns, F.lit("s").alias("__t"))).join(facts, company)
    first = F.col("source").isin("consolidated", "standalone_borrowed", "consolidated_short") | (F.col("source") == "fallback_richest") & F.col("__c_longer")
    borrowed = (F.col("source") == "standalone_borrowed") & (F.col("__t") == "s") & (F.col("fy") == prior)
    return rows.where(F.when(F.col("__t") == "c", first & ~((F.col("source") == "standalone_borrowed") & (F.col("fy") == prior))).otherwise(~first | borrowed)).select(*columns, "source")
