"""The risk index of every day against one run of the single-day operators per day."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tanisight.operators import news, risk
from tests.conftest import rows

START = dt.date(2026, 1, 1)
NAMES = ["beras", "cabai", "telur"]
WEATHER = (
    "sentra string, date_parsed date, current struct<precipitation: double, weather_code: int, temperature_2m: double>, "
    "ingestion_ts string, id int"
)
SIGNALS = "date date, signal_score int, komoditas_matched array<string>"
PRICES = "komoditas string, date_parsed date, avg_price double, n_sources long"
REGIONS = [("beras", "a", 0.25), ("beras", "b", 0.75), ("cabai", "b", 1.0), ("telur", "nowhere", 1.0)]


def day(i):
    return START + dt.timedelta(days=i)


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(7)
    prices = [(k, day(i), float(rng.randint(9000, 15000)), 1) for k in NAMES for i in range(45) if rng.random() < 0.9]
    prices += [("beras", day(50), None, 1), ("beras", day(51), 0.0, 1), ("telur", None, 5.0, 1)]
    weather = []
    for i in range(120):
        at = rng.randint(0, 44)
        now = (rng.choice([None, 10.0, 60.0]), rng.choice([None, 3, 61, 95]), rng.choice([None, 12.0, 25.0, 36.0]))
        # Hours repeat, so that the id decides
        weather.append((rng.choice(["a", "b", "c", None]), day(at), now, f"{day(at)}T{rng.randint(10, 12)}:00:00", i))
    weather.append(("a", None, (99.0, 99, 40.0), None, 999))
    articles = [
        (day(rng.randint(0, 44)), rng.randint(0, 20), rng.sample(NAMES, rng.randint(0, 2))) for _ in range(60)
    ]
    return (
        spark.createDataFrame(prices, PRICES), spark.createDataFrame(weather, WEATHER),
        spark.createDataFrame(REGIONS, "komoditas string, nama string, bobot double"),
        spark.createDataFrame(articles, SIGNALS), spark.createDataFrame([(k,) for k in NAMES], "komoditas string"),
    )


def every_day(tables):
    prices, weather, regions, signals, _ = tables
    return risk.daily_risk_index(prices, weather, regions, news.mentions_daily(signals), tie="id")


def test_each_day_equals_a_run_on_that_day(tables):
    prices, weather, regions, signals, dim = tables
    wanted = ["komoditas", "price_signal", "weather_signal", "news_signal", "risk_index", "level"]
    found = every_day(tables).cache()
    for i in (0, 3, 6, 13, 29, 30, 44):
        until = F.col("date_parsed") <= F.lit(day(i))
        latest = risk.latest_per_region(weather.filter(until), "ingestion_ts", "id")
        one = risk.risk_index(
            risk.price_signal(prices.filter(until), dim), risk.weather_signal(latest, regions, dim),
            risk.news_signal(news.keyword_velocity(signals, dim, str(day(i))), dim),
        )
        priced = prices.filter((F.col("date_parsed") == F.lit(day(i))) & (F.col("avg_price") > 0)).select("komoditas")
        got = rows(found.filter(F.col("date_parsed") == F.lit(day(i))), *wanted)
        assert got == rows(one.join(priced, "komoditas"), *wanted) and got


def test_rows_without_a_day_or_price_have_no_index_and_other_columns_stay(tables):
    found = every_day(tables)
    assert "n_sources" in found.columns
    assert found.filter("avg_price is null or avg_price = 0 or date_parsed is null").count() == 0
    assert found.count() == tables[0].filter("avg_price > 0 and date_parsed is not null").count()


def test_without_weather_and_news_the_price_alone_counts(tables):
    prices, weather, regions, signals, _ = tables
    found = every_day((prices, weather.limit(0), regions, signals.limit(0), None))
    assert found.filter("weather_signal <> 0 or news_signal <> 0").count() == 0
    assert found.filter("abs(risk_index - 0.5 * price_signal) > 0.0051").count() == 0
    assert every_day((prices.limit(0), weather, regions, signals, None)).count() == 0
