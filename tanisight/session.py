"""Session settings, the shared folder for cut lineage, and scratch paths below it."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL_FOLDERS: dict[str, str] = {}
_SHIPPED: set[str] = set()
_SCOPES: list[list[str]] = []


def build_session(app_name: str = "tanisight", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators rely on; callers may override any of them."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session without that
    setting gets a temporary folder; a cluster without it is an error, because a
    machine-local folder would be lost with its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="tanisight-")
    return _LOCAL_FOLDERS[app]


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application.

    Python workers import the functions of an operator by name; without the package they only work
    where the driver's folder is on their path.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    name = os.path.join(tempfile.mkdtemp(prefix="tanisight-"), "tanisight.zip")
    with zipfile.ZipFile(name, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, files in os.walk(root):
            for file in files:
                if file.endswith(".py"):
                    path = os.path.join(folder, file)
                    out.write(path, os.path.join("tanisight", os.path.relpath(path, root)))
    sc.addPyFile(name)
    _SHIPPED.add(sc.applicationId)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder. It belongs to the innermost open scratch_scope, if there is one."""
    path = f"{shared_folder(spark)}/scratch/{name}-{uuid.uuid4().hex[:12]}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end the scratch paths made within. What is needed later must be materialized inside.

    Dropped references also let Spark's cleaner remove the shuffle files of finished work.
    """
    made: list[str] = []
    _SCOPES.append(made)
    try:
        yield
    finally:
        _SCOPES.remove(made)
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for name in made:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(conf).delete(path, True)
        gc.collect()
        spark.sparkContext._jvm.java.lang.System.gc()


def materialize(df: DataFrame) -> DataFrame:
    """Compute a layer once and read it back, so later branches do not rescan the raw tables.

    A reliable checkpoint survives the loss of executors.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


def materialize_by(df: DataFrame, key: str) -> DataFrame:
    """Write a layer below one folder per key value and read it back.

    A filter on the key then reads that folder only. Rebalancing gives few files per key and
    splits a key that holds much of the data.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "layer")
    df.hint("rebalance", F.col(key)).write.partitionBy(key).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)
