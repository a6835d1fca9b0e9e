"""The given tables in the shape of the raw streams.

Each adapter is a projection (plus the joins it needs) over whole tables; nothing is generated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tanisight.dims import FeedDictionary, NewsDictionary
from tanisight.functions.numeric import exact_sum, rnd
from tanisight.functions.text import join_title, matched_words, pin, strip_tags

TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
INDICATORS = ["ind_1", "ind_2", "ind_3", "ind_4", "ind_5"]
# Order of price records of one day. Records equal in all of these have the same price too.
PRICE_TIE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]

# Words that occur in the given documents, in the roles of the news dictionaries.
TEST_NEWS = NewsDictionary(
    topics={
        "ECONOMY": ["thanea", "thsh"],
        "LARGE": ["que", "ertion"],
        "MEDIUM": ["thanedble", "aned"],
        "PROMO": ["retion", "rely"],
        "SMALL": ["onhe", "erwh"],
        "STANDARD": ["eriner", "of the"],
    },
    disruptions={
        "attion": 3, "erble": 3, "onble": 2, "ontion": 2, "thwh": 2, "erhe": 1, "der": 1,
        "les": 1, "in the": 1,
    },
    regions=["anan", "ernd", "eror", "onou"],
    bullish=["attion", "erble", "onble"],
    bearish=["anre", "ernt", "onnt"],
)
TEST_FEED = FeedDictionary(
    commodities=["aned", "eriner", "ertion", "onhe", "que", "rely", "thsh"],
    supply=["der", "erhe", "erly", "thon", "thti"],
    regions=["anan", "ernd", "eror"],
)


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """One given table; its schema is read from the files once, not by every query."""
    path = f"{sf}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def tables(spark: SparkSession, sf: str, *names: str) -> list[DataFrame]:
    return [table(spark, sf, n) for n in names]


def prices(spark: SparkSession, sf: str) -> DataFrame:
    """Price feed: one record per line item, source = region of the supplier."""
    line, part, supplier, nation, region = tables(
        spark, sf, "lineitem", "part", "supplier", "nation", "region"
    )
    joined = (
        line.join(part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
        .join(supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation.select("n_nationkey", "n_regionkey"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return joined.select(
        F.col("r_name").alias("source"),
        F.col("p_type").alias("commodity"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_shipdate").alias("fetched_at_utc"),
        *PRICE_TIE,
    )


def kurs(spark: SparkSession, sf: str) -> DataFrame:
    """Exchange-rate feed: all orders, source = order status."""
    orders = table(spark, sf, "orders")
    return orders.select(
        F.col("o_orderstatus").alias("source"),
        F.lit("USD/IDR").alias("pair"),
        F.col("o_totalprice").alias("kurs_tengah"),
        F.col("o_orderdate").alias("fetched_at_utc"),
        "o_orderkey", "o_custkey",
    )


def weather(spark: SparkSession, sf: str) -> DataFrame:
    """Weather feed: events of January 2024 moved to 1998, with nested fields."""
    events = table(spark, sf, "events")
    temp = (F.col("user_id") % 45).cast("double")
    code = F.from_json("props", "k int")["k"]
    return events.select(
        F.concat(F.lit("S"), (F.col("user_id") % 25).cast("string")).alias("sentra"),
        F.struct(
            F.col("value").alias("precipitation"), code.alias("weather_code"), temp.alias("temperature_2m")
        ).alias("current"),
        F.struct(
            F.col("value").alias("precipitation_sum"), temp.alias("temperature_2m_max")
        ).alias("daily"),
        F.add_months(F.to_date("ts"), -312).alias("ingestion_ts"),
        F.col("ts").cast("timestamp").alias("seen_at"),
        "event_id",
    )


def articles(spark: SparkSession, sf: str) -> DataFrame:
    """News feed: documents, with a title and a day of 1998."""
    docs = table(spark, sf, "documents")
    day = F.date_add(F.lit("1998-01-01").cast("date"), (F.col("doc_id") % 365).cast("int"))
    return docs.select(
        F.col("doc_id").alias("article_id"),
        "source",
        F.substring("text", 1, 200).alias("title"),
        F.col("text").alias("summary"),
        day.alias("ingestion_ts"),
    )


def scored_articles(spark: SparkSession, sf: str) -> DataFrame:
    """News feed with the relevance score of the feed filter (before it drops articles)."""
    rows = pin(
        articles(spark, sf),
        "_text",
        F.lower(join_title(strip_tags(F.col("title")), strip_tags(F.col("summary")))),
    )
    score = (
        3 * F.size(matched_words(F.col("_text"), TEST_FEED.commodities))
        + F.size(matched_words(F.col("_text"), TEST_FEED.supply))
        + 2 * F.size(matched_words(F.col("_text"), TEST_FEED.regions))
    )
    return rows.select("article_id", "source", "ingestion_ts", score.alias("relevance_score"))


def macro(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly indicators: order value per month, priority (indicator) and status (source)."""
    orders = table(spark, sf, "orders")
    return (
        orders.groupBy(
            F.col("o_orderstatus").alias("source"),
            F.concat(F.lit("ind_"), F.substring("o_orderpriority", 1, 1)).alias("indicator"),
            F.trunc(F.to_date("o_orderdate"), "month").alias("date"),
        ).agg(exact_sum("o_totalprice").alias("value"))
    )


def regions(spark: SparkSession, sf: str) -> DataFrame:
    """Region weights: suppliers per nation, weight = share of their positive balance."""
    supplier, nation = tables(spark, sf, "supplier", "nation")
    names = F.array(*[F.lit(t) for t in TYPES])
    per_region = (
        supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .groupBy(
            F.get(names, (F.col("s_suppkey") % len(TYPES)).cast("int")).alias("komoditas"),
            F.concat(F.lit("S"), F.col("s_nationkey").cast("string")).alias("nama"),
            F.col("n_name").alias("provinsi"),
            F.col("s_nationkey").cast("double").alias("lat"),
            (F.col("s_nationkey") + 100).cast("double").alias("lon"),
        )
        .agg(exact_sum(F.greatest("s_acctbal", F.lit(0.0))).alias("_balance"))
    )
    total = per_region.groupBy("komoditas").agg(exact_sum("_balance").alias("_total"))
    return per_region.join(total, "komoditas").select(
        "komoditas", "nama", "provinsi", "lat", "lon",
        rnd(F.try_divide("_balance", "_total"), 4).alias("bobot"),
    )


def alerts(spark: SparkSession, sf: str) -> DataFrame:
    """Alert stream: error events, ten commodities."""
    events = table(spark, sf, "events").filter(F.col("event_type") == "error")
    return events.select(
        F.concat(F.lit("K"), (F.col("user_id") % 10).cast("string")).alias("komoditas"),
        F.col("ts").cast("timestamp").alias("ts"),
        "event_id",
    )
