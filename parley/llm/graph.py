"""Connected components of an edge table, by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut, discard, merge_join


def _state(edges: DataFrame) -> tuple[int, int]:
    r = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], int(r["h"] or 0)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, component) of every id in `edges` (u, v); component is its smallest id.

    Each round hangs the neighbours of a node on the smallest of them: first the
    larger neighbours, then the smaller ones. Minima are pre-aggregated before the
    shuffle and joined back by a merge join, so no list of neighbours is ever
    collected and a hub is split like any other skewed join key. The lineage is cut
    every round and the files of the round before are deleted; the driver sees one
    count and one checksum.
    """
    e = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    e = cut(e)
    before = _state(e)
    for _ in range(max_rounds if before[0] else 0):
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = merge_join(both, least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.unionAll(least.where("m < u").select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = merge_join(large, least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionAll(least.select("u", F.col("m").alias("v"))).where("u <> v")
        old, e = e, cut(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
        discard(old)
        after = _state(e)
        if after == before:
            break
        before = after
    else:
        if before[0]:
            raise RuntimeError("components did not settle")
    roots = e.select(F.col("v").alias("id")).distinct()
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionAll(roots.select("id", F.col("id").alias("component")))
