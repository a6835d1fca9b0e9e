"""Layer tables as parquet, bronze metadata, validation and manifest."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tanisight.operators.clean import union_sources


def write_table(
    df: DataFrame, path: str, mode: str = "append", source: DataFrame | None = None
) -> bool:
    """Overwrite with a new schema, or append (readers merge schemas). Nothing is written, and an
    existing table stays, when there is no data.

    Give the raw ``source`` where ``df`` is costly: looking for its first row reads one split,
    while ``df`` would be computed up to its last shuffle just for the test.
    """
    if (df if source is None else source).isEmpty():
        return False
    df.write.mode(mode).parquet(path)
    return True


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A table with its merged schema; a missing one is empty with the declared schema."""
    try:
        return spark.read.option("mergeSchema", True).parquet(path)
    except AnalysisException as error:
        if schema is None or error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def bronze(df: DataFrame, stream: str) -> DataFrame:
    """Layer and stream name on every record. The ingest time is added by ``stamp`` in the sink."""
    return df.withColumns({"_source_layer": F.lit("bronze"), "_stream_name": F.lit(stream)})


def stamp(df: DataFrame, column: str = "_ingested_to_bronze_at") -> DataFrame:
    """Wall-clock column, only for tables that are written and not compared."""
    return df.withColumn(column, F.current_timestamp())


def validate_layers(layers: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Rows, rows with a null in the key, and surplus rows per key, for every (table, key)."""
    reports = []
    for name, (table, key) in layers.items():
        null_key = F.greatest(*[F.col(c).isNull() for c in key]) if len(key) > 1 else F.col(key[0]).isNull()
        per_key = table.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
        reports.append(
            per_key.agg(
                F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
                F.coalesce(F.sum(F.when(null_key, F.col("_n"))), F.lit(0)).alias("null_keys"),
                F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("dup_keys"),
            ).select(F.lit(name).alias("layer"), "n_rows", "null_keys", "dup_keys")
        )
    return union_sources(reports)


def ingest_manifest(streams: Mapping[str, DataFrame]) -> DataFrame:
    """Records, first and last day and number of days per stream and key, with a total row.

    Each input has (key, date).
    """
    rows = union_sources([df.select(F.lit(n).alias("stream"), "key", "date") for n, df in streams.items()])
    per_day = rows.groupBy("stream", "key", "date").agg(F.count(F.lit(1)).alias("_n"))
    per_key = per_day.groupBy("stream", "key").agg(
        F.sum("_n").alias("records"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.count("date").alias("n_days"),
    )
    per_total = per_day.groupBy("date").agg(F.sum("_n").alias("_n")).agg(
        F.lit("TOTAL").alias("stream"),
        F.lit("").alias("key"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("records"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.count("date").alias("n_days"),
    )
    return per_key.unionByName(per_total)


def price_history(daily: DataFrame) -> DataFrame:
    """One row per commodity with its prices as an array sorted by day (one entry per day)."""
    points = F.struct(F.col("date_parsed").alias("date"), F.col("avg_price").alias("price"))
    known = daily.filter(F.col("avg_price").isNotNull())
    return known.groupBy("komoditas").agg(F.array_sort(F.collect_list(points)).alias("history"))
