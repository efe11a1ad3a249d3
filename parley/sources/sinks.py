"""Sinks: append tables, ranked files, one JSON for each company, requests, reports of small results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def append(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Append a run's rows. A failed job leaves nothing behind: files appear when the job commits."""
    w = df.write.mode("append")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)


def append_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str]) -> None:
    df.write.mode("append").jdbc(url, table, properties=properties)


def ranked_csv(df: DataFrame, path: str) -> None:
    """A ranked result as one CSV file with a header, for results that people read."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def json_by(df: DataFrame, path: str, key: str) -> None:
    """JSON rows in a folder for each key; rows are brought together by key first, so each key has few files."""
    df.repartition(F.col(key)).write.mode("overwrite").partitionBy(key).json(path)


def cohort_files(rows: DataFrame, path: str) -> None:
    """The cohort, the unresolved and all rows, from rows with mcap and status."""
    ranked_csv(rows.where("status = 'cohort'").orderBy("mcap", "slug"), f"{path}/cohort")
    ranked_csv(rows.where("status = 'unresolved'").orderBy("slug"), f"{path}/unresolved")
    ranked_csv(rows.orderBy(F.col("mcap").desc_nulls_last(), "slug"), f"{path}/all")


def enrich(table: DataFrame, facts: DataFrame, key: str, path: str) -> None:
    """A table with new columns joined on, written to another path; running it again gives the same."""
    new = [c for c in facts.columns if c != key]
    table.drop(*new).join(facts, key, "left").write.mode("overwrite").parquet(path)


def markdown(df: DataFrame, rows: int = 200) -> str:
    """A small result as a Markdown table, at most `rows` rows."""
    cell = lambda v: "—" if v is None else str(v).replace("|", "\\|").replace("\n", " ")
    lines = [f"| {' | '.join(df.columns)} |", f"|{'---|' * len(df.columns)}"]
    lines += [f"| {' | '.join(map(cell, r))} |" for r in df.limit(rows).collect()]
    return "\n".join(lines)
