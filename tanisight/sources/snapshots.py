"""Versioned tables: every save is kept, with a history and reads as of a version.

A version's rows live below ``data/_version=N``; its history row is written last and makes it
visible, so a save that dies half-way is never read. A read opens the files of one version only, so
versions may differ in their column types.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_HISTORY = "version long, timestamp timestamp, operation string, n_rows long"


def history(spark: SparkSession, path: str) -> DataFrame:
    """Versions with time, operation and number of rows."""
    try:
        return spark.read.schema(_HISTORY).parquet(f"{path}/history")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _HISTORY)


def save_version(df: DataFrame, path: str, timestamp: str, operation: str = "WRITE") -> int:
    """Save the table as the next version. Rows are counted while they are written."""
    spark = df.sparkSession
    last = history(spark, path).agg(F.max("version")).first()[0]
    version = 0 if last is None else last + 1
    counted = Observation("rows")
    df.observe(counted, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(
        f"{path}/data/_version={version}"
    )
    entry = spark.createDataFrame([(version, operation, counted.get["n"])], "version long, operation string, n_rows long")
    entry.select(
        "version", F.lit(timestamp).cast("timestamp").alias("timestamp"), "operation", "n_rows"
    ).coalesce(1).write.mode("append").parquet(f"{path}/history")
    return version


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The table as of a version; the newest one by default."""
    known = history(spark, path)
    if version is None:
        version = known.agg(F.max("version")).first()[0]
        if version is None:
            raise ValueError(f"no version of {path}")
    elif known.filter(F.col("version") == version).isEmpty():
        raise ValueError(f"no version {version} of {path}")
    return spark.read.parquet(f"{path}/data/_version={version}")
