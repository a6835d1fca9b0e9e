"""Keep one record per business key.

``row_number() = 1`` (not ``dropDuplicates``) makes the choice explicit. Spark prunes each map
task to its best row per key before the shuffle (WindowGroupLimit), so a key that holds a large
part of all rows still sends at most one row per task. Name the key column with the most
values first: it leads the sort, and most comparisons then end with it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tanisight.functions.temporal import date_prefix

# Business key of each raw stream
STREAM_KEYS = {
    "weather": ["sentra", "_date"],
    "news": ["article_id"],
    "kurs": ["pair", "_date"],
    "price": ["komoditas", "_date"],
}


def top_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int | None) -> DataFrame:
    """The first ``n`` rows per key in the given order, or all, with their rank in ``_rank``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn("_rank", F.row_number().over(w))
    return ranked if n is None else ranked.filter(F.col("_rank") <= n)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key; ``order`` should end in a tie key that makes it total."""
    return top_rows(df, keys, [F.col(c).asc_nulls_last() for c in order], 1).drop("_rank")


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last row per key."""
    return top_rows(df, keys, [F.col(c).desc_nulls_last() for c in order], 1).drop("_rank")


def stream_date(df: DataFrame) -> Column:
    """Business date of a raw record: date_parsed, else the day of fetched_at_utc or ingestion_ts."""
    present = [F.col(c).cast("string") for c in ("date_parsed", "fetched_at_utc", "ingestion_ts") if c in df.columns]
    return date_prefix(*present) if present else F.lit(None).cast("string")


def merge_copies(copies: Sequence[DataFrame], stream: str, tie: Sequence[str]) -> DataFrame:
    """Union of several copies of one raw stream; for equal keys the later copy wins."""
    merged = None
    for rank, copy in enumerate(copies):
        ranked = copy.withColumn("_src_rank", F.lit(rank))
        merged = ranked if merged is None else merged.unionByName(ranked, allowMissingColumns=True)
    if "commodity" in merged.columns:
        known = [F.col(c) for c in ("komoditas", "commodity") if c in merged.columns]
        merged = merged.withColumn("komoditas", F.coalesce(*known))
    keys = STREAM_KEYS.get(stream, STREAM_KEYS["price"])
    dated = merged.withColumn("_date", stream_date(merged))
    return keep_last(dated, keys, ["_src_rank", *tie]).drop("_date", "_src_rank")
