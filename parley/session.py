"""Session helpers: table access and lineage cuts that survive the loss of executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each Spark context.

    The archive is made on the driver and served by Spark; where the package is
    installed on the workers anyway, it is the same code.
    """
    sc = spark.sparkContext
    if getattr(sc, "_parley_shipped", False):
        return
    root = Path(__file__).resolve().parent
    archive = os.path.join(tempfile.mkdtemp(prefix="parley-"), "parley.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, Path(root.name, p.relative_to(root)))
    sc.addPyFile(archive)
    sc._parley_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the test tables; columns and filters are pushed to the scan by Catalyst."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def merge_join(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """A join of two tables that both grow with the data: sorted and merged, never broadcast, whatever sizes the optimizer estimates."""
    return left.hint("merge").join(right.hint("merge"), on, how)


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint.

    The folder is the one the cluster names in spark.checkpoint.dir. Only a
    session without that setting, as in tests, gets a folder of its own.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="parley-checkpoint-"))
    return df.checkpoint(eager=True)


def discard(df: DataFrame) -> None:
    """Delete the files of a checkpoint made by `cut` that nothing reads any more."""
    file = df._jdf.queryExecution().analyzed().rdd().getCheckpointFile()
    if file.isDefined():
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(file.get())
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
