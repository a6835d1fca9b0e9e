"""Tables that grow by batches and are kept by day.

A batch writes the whole new content of the days it touches below ``_batch=N/date=D``; the content of a day is that of
the newest finished batch that holds it. A batch reads only batches before it, so one that is repeated after a failure
overwrites its own folder and changes nothing else. A day has few files however many batches touched it, and a filter
on ``date`` opens those days only. One writer at a time; the driver lists folders, at most a few per calendar day.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructType

_FINISHED = "_FINISHED"
_NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def _at(spark: SparkSession, path: str):
    """(file system, path) of a folder."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, where = _at(spark, path)
    return [entry.getPath().getName() for entry in fs.listStatus(where)] if fs.exists(where) else []


def _folder(day: date | None) -> str:
    return f"date={_NO_DAY if day is None else day}"


def batches(spark: SparkSession, path: str) -> dict[int, list[str]]:
    """Day folders of every finished batch, oldest batch first."""
    found = {}
    for name in _children(spark, path):
        if name.startswith("_batch="):
            inside = _children(spark, f"{path}/{name}")
            if _FINISHED in inside:
                found[int(name.partition("=")[2])] = [n for n in inside if n.startswith("date=")]
    return dict(sorted(found.items()))


def newest(spark: SparkSession, path: str, before: int | None = None) -> dict[str, int]:
    """For each day folder the newest finished batch (before ``before``) that holds it."""
    held: dict[str, int] = {}
    for batch, folders in batches(spark, path).items():
        if before is None or batch < before:
            held |= dict.fromkeys(folders, batch)
    return held


def next_batch(spark: SparkSession, path: str) -> int:
    return max(batches(spark, path), default=-1) + 1


def read(
    spark: SparkSession, path: str, schema: StructType, before: int | None = None, days: Iterable[date | None] | None = None
) -> DataFrame:
    """Rows of all days, or of some, with the columns of ``schema`` and ``date``; empty when there are none."""
    held = newest(spark, path, before)
    wanted = held if days is None else [f for f in map(_folder, days) if f in held]
    paths = [f"{path}/_batch={held[folder]}/{folder}" for folder in wanted]
    full = StructType(list(schema.fields)).add("date", DateType())
    if not paths:
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("basePath", path).parquet(*paths).select(*full.names)


def replace(
    spark: SparkSession, path: str, batch: int, days: Iterable[date | None], schema: StructType,
    content: Callable[[DataFrame], DataFrame],
) -> None:
    """Write a batch: ``content`` makes the new rows of the days from those they hold so far.

    A day left without rows is empty from now on. The batch counts once its last file is there.
    """
    days = list(days)
    target = f"{path}/_batch={batch}"
    rows = content(read(spark, path, schema, batch, days)).select(*schema.names, "date")
    rows.hint("rebalance", F.col("date")).write.mode("overwrite").partitionBy("date").parquet(target)
    fs, where = _at(spark, target)
    for folder in set(map(_folder, days)).difference(_children(spark, target)):
        fs.mkdirs(_at(spark, f"{target}/{folder}")[1])
    fs.create(_at(spark, f"{target}/{_FINISHED}")[1]).close()


def compact(spark: SparkSession, path: str) -> None:
    """Delete day folders that a newer batch replaces, as seen by the newest batch, which can still be repeated.
    Readers that started before that batch must have ended."""
    found = batches(spark, path)
    last = max(found, default=0)
    keep = newest(spark, path, last)
    for batch, folders in found.items():
        if batch < last:
            old = [f for f in folders if keep[f] != batch]
            whole = len(old) == len(folders)
            for name in [f"{path}/_batch={batch}"] if whole else [f"{path}/_batch={batch}/{f}" for f in old]:
                fs, where = _at(spark, name)
                fs.delete(where, True)
