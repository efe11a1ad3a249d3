"""First-wins, best-of and union operators. Order is a column; ties go by it, so results don't depend on the partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut
from .text import timeline_key, year_in_passage
from .values import value_key


def first_by(df: DataFrame, keys: list[str], order: list[Column | str], blocks: int = 32) -> DataFrame:
    """The first row of each key in an order.

    Rows are reduced within salted blocks of a key before the final pick, so a key
    with a third of all rows is no hot task: at most `blocks` rows of it meet.
    Null keys are keys.
    """
    rows = df.withColumn("__salt", F.pmod(F.xxhash64(*[c for c in df.columns if c not in keys]), F.lit(blocks)))
    for by in ([*keys, "__salt"], keys):
        rows = rows.withColumn("__n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where("__n = 1").drop("__n")
    return rows.drop("__salt")


def earliest(df: DataFrame, key: str, when: str, order: str) -> DataFrame:
    """One row for each key, the one with the least `when`; the smallest `order` among equals. Null times come last."""
    return first_by(df, [key], [F.col(when).asc_nulls_last(), F.col(order)])


def exact_first(items: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The first item of each (metric, value, timeline) or other key; null equals null."""
    return first_by(items, keys, [F.col(order)])


def best_passage(items: DataFrame, company: list[str], metric: str, value: str, timeline: str, level: str, passage: str, order: str) -> DataFrame:
    """One item for each (metric, value, timeline, level) after normalising: the passage that names its year, then the longest, then the first.

    group_order is the place where the group was first seen.
    """
    keyed = items.withColumns({"__v": value_key(F.col(value)), "__t": timeline_key(F.col(timeline)), "__in": year_in_passage(F.col(passage), F.col(timeline)), "__len": F.length(F.coalesce(F.col(passage), F.lit("")))})
    keys = [*company, metric, "__v", "__t", level]
    first = keyed.groupBy(*keys).agg(F.min(order).alias("group_order"))
    best = first_by(keyed, keys, [F.col("__in").desc(), F.col("__len").desc(), F.col(order)])
    same = [best[k].eqNullSafe(first[k]) for k in keys]
    return best.join(first, same).select(*(best[c] for c in items.columns), "group_order")


def by_priority(tables: list[DataFrame], keys: list[str], order: str) -> DataFrame:
    """Union of tables in which an earlier table's row for a key wins; within a table the smallest `order`."""
    union = None
    for n, t in enumerate(tables):
        t = t.withColumn("__source", F.lit(n))
        union = t if union is None else union.unionByName(t)
    return first_by(union, keys, ["__source", order]).drop("__source")


def union_masters(first: DataFrame, second: DataFrame, isin: str = "isin") -> DataFrame:
    """All rows of the first list, and those of the second whose identifier is blank or not in the first."""
    known = first.select(F.col(isin).alias("__isin")).where(F.coalesce(F.trim("__isin"), F.lit("")) != "").distinct()
    return first.unionByName(second.join(known, second[isin] == known["__isin"], "left_anti"))


def stride_sample(df: DataFrame, n: int, order: list[Column | str]) -> DataFrame:
    """n rows at even steps of an order (all rows if there are fewer): row int(i * rows / n) for i below n.

    The place of a row comes from one distributed sort: numbers within its
    partitions plus the sizes of those before, no single-task window.
    """
    placed = cut(df.orderBy(*order).select("*", F.spark_partition_id().alias("__part"), F.monotonically_increasing_id().alias("__id")))
    sizes = placed.groupBy("__part").agg(F.count("*").alias("__n"), F.min("__id").alias("__base"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("__part", "__base", before.alias("__before"), F.sum("__n").over(Window.partitionBy(F.lit(1))).alias("__total"))
    rows = placed.join(offsets, "__part").withColumn("__at", F.col("__id") - F.col("__base") + F.col("__before"))
    step = F.col("__total") / F.lit(n)
    near = F.floor(F.col("__at") / step)
    hit = F.lit(False)
    for k in (-1, 0, 1):
        i = near + k
        hit = hit | ((i >= 0) & (i < n) & (F.floor(i * step) == F.col("__at")))
    return rows.where((F.col("__total") <= n) | hit).select(*df.columns)


def latest_quarters(df: DataFrame, key: str, fy: str, quarter: str, n: int, blocks: int = 32) -> DataFrame:
    """The n most recent (fy, quarter) rows of each key; rows of the same quarter count apart, all columns break ties."""
    rest = [c for c in df.columns if c not in (key, fy, quarter)]
    order = [F.col(fy).desc(), F.col(quarter).desc(), *rest]
    rows = df.withColumn("__salt", F.pmod(F.xxhash64(*df.columns), F.lit(blocks)))
    for by in ([key, "__salt"], [key]):
        rows = rows.withColumn("__n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("__n") <= n).drop("__n")
    return rows.drop("__salt")


def attachment_candidates(filings: DataFrame) -> DataFrame:
    """Filings (key, attachment, headline, size) that may hold a transcript, one for each attachment, with `place` from the best on.

    A headline that says transcript comes first, then one that doesn't speak of a recording,
    then the larger file, then by name.
    """
    low = F.lower(F.coalesce("headline", F.lit("")))
    rows = filings.where("attachment is not null").withColumns({"says": low.contains("transcript"), "written": ~(low.contains("audio") | low.contains("recording")), "size": F.coalesce("size", F.lit(0))})
    order = [F.col("says").desc(), F.col("written").desc(), F.col("size").desc(), F.col("attachment")]
    once = first_by(rows, ["key", "attachment"], order)
    return once.withColumn("place", F.row_number().over(Window.partitionBy("key").orderBy(*order))).drop("says", "written")


def cohort(master: DataFrame, cap: str, most: float, known: float | None = None) -> DataFrame:
    """`master` with status: unresolved without a market cap, cohort up to `most`, else over_cap.

    known: companies above it are left out beforehand, those without a cap stay.
    """
    rows = master if known is None else master.where(F.col(cap).isNull() | (F.col(cap) <= known))
    return rows.withColumn("status", F.when(F.col(cap).isNull(), "unresolved").when(F.col(cap) <= most, "cohort").otherwise("over_cap"))


def chosen(rows: DataFrame, key: str, keys: list[str] | None = None, sample: int | None = None, limit: int | None = None) -> DataFrame:
    """All rows, those with the given keys, or a stride sample in the order of the key; `limit` keeps the first of them by key."""
    out = rows.where(F.col(key).isin(*keys)) if keys is not None else stride_sample(rows, sample, [F.col(key)]) if sample is not None else rows
    return out if limit is None else out.orderBy(key).limit(limit)
