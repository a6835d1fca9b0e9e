"""Dates from ISO-8601 text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def iso_date(x: Column | str) -> Column:
    """Date of an ISO-8601 text as it is written, null when it is not one. An offset moves no day.

    The form YYYY, YYYY-... or YYYYMMDD is required: a cast alone would also take a bare time of
    day and put today's date on it.
    """
    text = F.trim(F.col(x) if isinstance(x, str) else x)
    starts_with_year = (F.substring(text, 5, 1) == "-") | (F.length(text) == 4)
    written = F.regexp_extract(text, r"^(\d{4}(?:-\d{1,2}){0,2})", 1).try_cast("date")
    basic = F.to_date(F.try_to_timestamp(F.substring(text, 1, 8), F.lit("yyyyMMdd")))
    return F.when(starts_with_year & text.try_cast("timestamp").isNotNull(), written).when(
        text.rlike(r"^\d{8}(T\d{2}.*)?$"), basic
    )


def day_of(df: DataFrame, column: str) -> Column:
    """Date of a column that holds dates, timestamps or ISO-8601 text."""
    kind = df.schema[column].dataType
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.to_date(column)
    return iso_date(F.col(column).cast("string"))


def date_prefix(*candidates: Column) -> Column:
    """First ten characters of the first candidate that is not null or empty."""
    return F.substring(F.coalesce(*[F.when(c != "", c) for c in candidates]), 1, 10)
