"""JSON lines: tolerant reading with a quarantine, and date-partitioned writing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, FractionalType, IntegralType, StringType, StructType

from tanisight.functions.numeric import safe_double
from tanisight.functions.temporal import date_prefix
from tanisight.functions.text import pin


def _texts(schema: StructType) -> StructType:
    """The same fields, all as text: a JSON value of any form fits."""
    out = StructType()
    for field in schema.fields:
        out = out.add(field.name, StringType())
    return out


def _typed(text: Column, kind: DataType) -> Column:
    """JSON text as a value of the type, null where it is none. A single value fits an array."""
    if isinstance(kind, IntegralType):
        return F.coalesce(text.try_cast(kind), safe_double(text).try_cast(kind))
    if isinstance(kind, FractionalType):
        return safe_double(text).cast(kind)
    if isinstance(kind, ArrayType):
        parts = F.coalesce(F.from_json(text, ArrayType(StringType())), F.when(text.isNotNull(), F.array(text)))
        return F.transform(parts, lambda part: _typed(part, kind.elementType))
    if isinstance(kind, StructType):
        # The lambda names the parsed struct, so it is parsed once for all its fields
        parsed = F.array(F.from_json(text, _texts(kind)))
        return F.get(F.transform(parsed, lambda s: F.when(text.isNotNull(), _struct(s, kind))), F.lit(0))
    return text if isinstance(kind, StringType) else text.try_cast(kind)


def _struct(parsed: Column, kind: StructType) -> Column:
    return F.struct(*[_typed(parsed[f.name], f.dataType).alias(f.name) for f in kind.fields])


def decode(lines: DataFrame, schema: StructType, value: str = "value") -> DataFrame:
    """Parse JSON text into ``record`` (typed struct); ``_corrupt`` keeps text that is no JSON object.

    A field that does not fit its type becomes null and the rest of the record stays; a number given
    as text is a number. Works on batch and streaming tables. Each line is parsed once.
    """
    full = _texts(schema).add("_corrupt", StringType())
    parsed = F.from_json(
        F.col(value).cast("string"), full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    )
    rows = pin(lines, "_parsed", parsed)
    corrupt = F.when(F.col("_parsed").isNull(), F.col(value)).otherwise(F.col("_parsed._corrupt"))
    return rows.withColumn("_corrupt", corrupt).withColumn("record", _struct(F.col("_parsed"), schema)).drop("_parsed")


def good(decoded: DataFrame, *keep: str) -> DataFrame:
    """Fields of the rows that parsed."""
    fields = decoded.schema["record"].dataType.names
    return decoded.filter(F.col("_corrupt").isNull()).select(*keep, *[F.col(f"record.{f}") for f in fields])


def rejected(decoded: DataFrame, *keep: str) -> DataFrame:
    """Text of the rows that did not parse."""
    return decoded.filter(F.col("_corrupt").isNotNull()).select(*keep, F.col("_corrupt").alias("raw"))


def scan(spark: SparkSession, path: str, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """All JSON lines below a folder (any file system Spark can reach): (records, rejects).
    Blank lines are skipped."""
    lines = spark.read.option("recursiveFileLookup", True).text(path).filter(F.trim("value") != "")
    decoded = decode(lines, schema)
    return good(decoded), rejected(decoded)


def write_partitioned(df: DataFrame, path: str, timestamp: str, mode: str = "append") -> None:
    """Write JSON lines below ``date=YYYY-MM-DD`` folders; records without a time go to 1970-01-01.

    Rows are rebalanced by date: few files per day, and a day that holds much of the data is
    split over several tasks.
    """
    day = F.coalesce(date_prefix(F.col(timestamp).cast("string")), F.lit("1970-01-01"))
    df.withColumn("date", day).hint("rebalance", F.col("date")).write.mode(mode).partitionBy("date").json(path)


def export_json(df: DataFrame, path: str) -> None:
    """Export a table as JSON lines, written by all tasks."""
    df.write.mode("overwrite").json(path)
