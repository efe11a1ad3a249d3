"""Problem 7 - mixing sources to target weights.

Method: systematic sampling. Within a source every document is expected to be
taken r times, r being what brings the source to its target size in tokens; the
expected copies are prefix-summed, one random offset is added, and a document is
emitted once for each integer boundary its interval crosses. A document is thus
taken floor(r) or ceil(r) times, never more often than the source allows.

The total size of the mixture is the largest one that every source can feed
within its cap, or a given number of tokens; with a given one, a source at its
cap falls short and the report says so. Documents are ordered by size within
salted blocks, so the documents taken once more are of all sizes and the actual
share stays close to the target; the report says how close.

Defined results: a document of an unknown or null source, or of a source
without a target, is taken 0 times. Null and empty texts have no tokens and are
taken like any other of their source. Sources without documents get a report row
with 0. Rows with equal keys are documents of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import merge_join

#: Size classes to an octave, and salted blocks within a class, of the order within a source.
CLASSES, SALTS = 8, 64


def rates(docs: DataFrame, targets: DataFrame, size: str = "n_tokens", total_tokens: float | None = None) -> DataFrame:
    """(source, target_share, max_repeats, docs, tokens, rate): one row for each source of `targets`."""
    have = docs.groupBy(F.col("source").alias("__source")).agg(F.count("*").alias("docs"), F.sum(size).cast("double").alias("tokens"))
    t = targets.select("source", "target_share", "max_repeats").join(have, F.col("source") == F.col("__source"), "left").drop("__source")
    t = t.withColumn("docs", F.coalesce("docs", F.lit(0))).withColumn("tokens", F.coalesce("tokens", F.lit(0.0)))
    if total_tokens is None:
        # a source without tokens can feed nothing and doesn't hold the others back; the window spans one row for each source
        feeds = F.when((F.col("tokens") > 0) & (F.col("target_share") > 0), F.col("tokens") * F.col("max_repeats") / F.col("target_share"))
        t = t.withColumn("__total", F.min(feeds).over(Window.partitionBy(F.lit(1))))
    else:
        t = t.withColumn("__total", F.lit(float(total_tokens)))
    want = F.when(F.col("tokens") > 0, F.col("__total") * F.col("target_share") / F.col("tokens")).otherwise(F.lit(0.0))
    return t.withColumn("rate", F.coalesce(F.least(want, F.col("max_repeats").cast("double")), F.lit(0.0))).drop("__total")


def copies(docs: DataFrame, targets: DataFrame, key: str, size: str = "n_tokens", total_tokens: float | None = None, seed: int = 7) -> DataFrame:
    """(key, source, size, copies) of every document."""
    rate = rates(docs, targets, size, total_tokens).select(F.col("source").alias("__source"), "rate")
    rows = docs.select(key, "source", size).join(rate, F.col("source") == F.col("__source"), "left").drop("__source")
    rows = rows.withColumn("rate", F.coalesce("rate", F.lit(0.0)))
    # the order within a source is by size class; a salted block of a class is the most that one task numbers
    size_class = F.floor(F.lit(CLASSES) * F.log2(F.greatest(F.coalesce(F.col(size).cast("double"), F.lit(0.0)), F.lit(0.0)) + 1)).cast("int")
    rows = rows.withColumn("__block", size_class * SALTS + F.pmod(F.xxhash64(F.lit(seed), key), F.lit(SALTS)).cast("int"))
    number = F.row_number().over(Window.partitionBy("source", "__block").orderBy(size, F.xxhash64(F.lit(seed), key), key))
    sizes = rows.groupBy(F.col("source").alias("__s"), F.col("__block").alias("__b")).agg(F.count("*").alias("__n"))
    before = Window.partitionBy("__s").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    # rows without a source have no number and are taken 0 times
    rows = merge_join(rows.withColumn("__no", number), sizes, (F.col("source") == F.col("__s")) & (F.col("__block") == F.col("__b")), "left")
    # every document of a source has the same expected copies, so the prefix sum up to a document is its number times the rate
    offset = F.pmod(F.xxhash64(F.lit(seed), "source"), F.lit(1_000_003)) / F.lit(1_000_003)  # one for each source
    upto = lambda k: F.floor(k.cast("double") * F.col("rate") + offset)
    k = F.col("__no") + F.col("__before")
    return rows.select(key, "source", size, F.coalesce((upto(k) - upto(k - 1)).cast("int"), F.lit(0)).alias("copies"))


def shares(taken: DataFrame, targets: DataFrame, size: str = "n_tokens") -> DataFrame:
    """Report: one row for each source with its target and actual share of the taken tokens."""
    by = taken.groupBy(F.col("source").alias("__source")).agg(
        F.count("*").alias("docs"), F.sum(size).alias("tokens"), F.sum("copies").alias("docs_taken"), F.sum(F.col(size) * F.col("copies")).alias("tokens_taken"), F.max("copies").alias("most_copies")
    )
    t = targets.select("source", "target_share", "max_repeats").join(by, F.col("source") == F.col("__source"), "left").drop("__source")
    zero = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("docs", "tokens", "docs_taken", "tokens_taken", "most_copies")}
    t = t.withColumns(zero)
    t = t.withColumn("actual_share", F.coalesce(F.expr("try_divide(tokens_taken, sum(tokens_taken) over (partition by 1))"), F.lit(0.0)))
    return t.withColumn("share_error", F.col("actual_share") - F.col("target_share"))
