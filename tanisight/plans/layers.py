"""Silver and gold layers over the stand-ins; the queries start from these."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tanisight.functions.numeric import exact_sum, rnd
from tanisight.operators import clean, evaluate, features, gold, news, risk
from tanisight.operators.dedup import top_rows
from tanisight.plans import standins
from tanisight.session import materialize


def silver_prices(spark: SparkSession, sf: str) -> DataFrame:
    return clean.silver_prices(standins.prices(spark, sf), standins.TYPES, standins.PRICE_TIE)


def daily(spark: SparkSession, sf: str) -> DataFrame:
    return gold.daily_prices(silver_prices(spark, sf))


def silver_kurs(spark: SparkSession, sf: str) -> DataFrame:
    return clean.silver_kurs(standins.kurs(spark, sf), ["o_orderkey", "o_custkey"])


def silver_weather(spark: SparkSession, sf: str) -> DataFrame:
    return clean.silver_weather(standins.weather(spark, sf), ["seen_at", "event_id"])


def silver_news(spark: SparkSession, sf: str) -> DataFrame:
    return clean.silver_news(standins.scored_articles(spark, sf), ["ingestion_ts", "source"])


def silver_macro(spark: SparkSession, sf: str) -> DataFrame:
    return clean.silver_macro(standins.macro(spark, sf))


def feature_store(spark: SparkSession, sf: str) -> DataFrame:
    return gold.feature_store(
        daily(spark, sf),
        macro=silver_macro(spark, sf),
        indicators=standins.INDICATORS,
        fx=silver_kurs(spark, sf),
        weather=silver_weather(spark, sf),
        news=silver_news(spark, sf),
    )


def daily_with_weather(spark: SparkSession, sf: str) -> DataFrame:
    return gold.feature_store(daily(spark, sf), weather=silver_weather(spark, sf), reuse=False)


def model_input(spark: SparkSession, sf: str) -> DataFrame:
    """The columns of the feature store that the models use."""
    return gold.feature_store(
        daily(spark, sf), weather=silver_weather(spark, sf), news=silver_news(spark, sf), reuse=False
    )


def commodities(spark: SparkSession) -> DataFrame:
    """Commodity dimension of the stand-ins, with labels."""
    return spark.createDataFrame(
        [(t, t.title(), i) for i, t in enumerate(standins.TYPES)],
        "komoditas string, label string, position int",
    )


AS_OF = "1998-06-30"


def signals(spark: SparkSession, sf: str) -> DataFrame:
    return news.extract_signals(standins.articles(spark, sf), standins.TEST_NEWS, day="ingestion_ts")


def velocity(spark: SparkSession, sf: str) -> DataFrame:
    return news.keyword_velocity(signals(spark, sf), commodities(spark), AS_OF)


def latest_weather(spark: SparkSession, sf: str) -> DataFrame:
    return risk.latest_per_region(standins.weather(spark, sf), "seen_at", "event_id")


def series(spark: SparkSession, sf: str) -> DataFrame:
    """The daily prices, computed once, for views that use them in several places."""
    return materialize(daily(spark, sf))


def risk_index(
    spark: SparkSession, sf: str, prices: DataFrame | None = None, speed: DataFrame | None = None
) -> DataFrame:
    """Risk index; ``prices`` and ``speed`` (velocity) may be given when already computed."""
    dim = commodities(spark)
    return risk.risk_index(
        risk.price_signal(daily(spark, sf) if prices is None else prices, dim),
        risk.weather_signal(latest_weather(spark, sf), standins.regions(spark, sf), dim),
        risk.news_signal(velocity(spark, sf) if speed is None else speed, dim),
    )


def moves(spark: SparkSession, sf: str, prices: DataFrame | None = None) -> DataFrame:
    """Daily prices with their changes over 3, 7 and 14 rows."""
    prices = daily(spark, sf) if prices is None else prices
    return prices.withColumns({f"p{n}": features.change(n) for n in (3, 7, 14)})


def daily_risk(spark: SparkSession, sf: str, prices: DataFrame | None = None) -> DataFrame:
    """The risk index of every commodity and day, as known on that day."""
    weather = standins.weather(spark, sf).withColumn("date_parsed", F.col("ingestion_ts"))
    mentions = news.mentions_daily(signals(spark, sf))
    return risk.daily_risk_index(
        moves(spark, sf, prices), weather, standins.regions(spark, sf), mentions, "seen_at", "event_id"
    )


def forecast(prices: DataFrame) -> DataFrame:
    """Forecast table without a model: the mean of the last 7 and 14 prices."""
    recent = top_rows(prices, ["komoditas"], [F.col("date_parsed").desc()], 14)

    def mean(n: int):
        price = F.when(F.col("_rank") <= n, F.col("avg_price"))
        return rnd(exact_sum(price) / F.count(price), 0)

    means = recent.groupBy("komoditas").agg(
        rnd(F.max_by("avg_price", "date_parsed"), 0).alias("current_price"),
        mean(7).alias("forecast_7d"),
        mean(14).alias("forecast_14d"),
    )
    errors = evaluate.naive_backtest(prices).select(
        "komoditas", F.col("baseline_mape").alias("model_mape"), F.col("baseline_rmse").alias("_rmse")
    )

    def change(column: str):
        return rnd((F.col(column) - F.col("current_price")) / F.col("current_price") * 100, 2)

    return means.join(errors, "komoditas").select(
        "komoditas", "current_price", "forecast_7d", "forecast_14d",
        change("forecast_7d").alias("predicted_change_pct"),
        change("forecast_14d").alias("predicted_change_pct_14d"),
        (F.col("forecast_7d") - F.col("_rmse")).alias("confidence_lower"),
        (F.col("forecast_7d") + F.col("_rmse")).alias("confidence_upper"),
        "model_mape",
    )


def real_prices(spark: SparkSession, sf: str) -> DataFrame:
    """Newest price of one source."""
    one = silver_prices(spark, sf).filter(F.col("source") == "ASIA")
    last = clean.latest_positive(one, ["komoditas"], ["date_parsed"], "price_idr_per_kg")
    return last.withColumnRenamed("price_idr_per_kg", "price")


def top_phrases(spark: SparkSession, sf: str) -> DataFrame:
    return news.phrase_lists(news.top_phrases(signals(spark, sf), AS_OF))
