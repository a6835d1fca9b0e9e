"""Daily aggregates and the gold feature store.

The raw tables are reduced to one row per (day, commodity) or per day first. Windows over the
whole calendar run only on per-day tables: they hold one row per calendar day, however large
the raw tables are. Joins carry no broadcast hint; Spark broadcasts a side when its measured
size is under the threshold and sorts and merges otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tanisight.functions.numeric import exact_avg, rnd
from tanisight.session import materialize

DAY = "date_parsed"


def daily_prices(prices: DataFrame) -> DataFrame:
    """Mean price and number of distinct sources per day and commodity."""
    # Two steps: the first is a plain map-side aggregate per source, so counting sources
    # needs no expansion of the raw rows.
    per_source = prices.groupBy(DAY, "komoditas", "source").agg(
        F.sum(F.col("price_idr_per_kg").cast("decimal(18,2)")).alias("_sum"),
        F.count("price_idr_per_kg").alias("_n"),
    )
    mean = F.try_divide(F.sum("_sum").cast("double"), F.sum("_n"))
    return per_source.groupBy(DAY, "komoditas").agg(
        rnd(mean, 2).alias("avg_price"), F.count("source").alias("n_sources")
    )


def daily_fx(kurs: DataFrame) -> DataFrame:
    """Mean middle rate per day."""
    return kurs.groupBy(DAY).agg(exact_avg("kurs_tengah").alias("kurs_usd_idr"))


def _today(df: DataFrame, struct: str, name: str) -> Column:
    """A daily field: the value itself, or today's element of a forecast array."""
    kind = df.schema[struct].dataType[name].dataType
    value = F.col(f"{struct}.{name}")
    return F.get(value, F.lit(0)) if isinstance(kind, T.ArrayType) else value


def daily_weather(weather: DataFrame) -> DataFrame:
    """Mean rain and maximum temperature over the regions per day."""
    rows = weather.filter(F.col(DAY).isNotNull()).select(
        DAY,
        _today(weather, "daily", "precipitation_sum").cast("double").alias("_rain"),
        _today(weather, "daily", "temperature_2m_max").cast("double").alias("_temp"),
    )
    return rows.groupBy(DAY).agg(
        rnd(exact_avg("_rain"), 1).alias("precipitation_sum"),
        rnd(exact_avg("_temp"), 1).alias("temperature_max"),
    )


def daily_news(news: DataFrame) -> DataFrame:
    """Mean relevance and number of articles per day."""
    return news.groupBy(DAY).agg(
        rnd(exact_avg(F.coalesce(F.col("relevance_score").cast("double"), F.lit(0.0)), 4), 2).alias("news_score"),
        F.count(F.lit(1)).alias("article_count"),
    )


def news_velocity(daily: DataFrame, window: int = 7) -> DataFrame:
    """Articles of the day over the mean of the last ``window`` days that have any."""
    w = Window.orderBy(DAY).rowsBetween(-(window - 1), 0)
    mean = F.sum("article_count").over(w) / F.count(F.lit(1)).over(w)
    return daily.select(
        DAY,
        "news_score",
        "article_count",
        F.when(mean > 0, rnd(F.col("article_count") / mean, 2)).otherwise(0.0).alias("news_velocity"),
    )


def macro_pivot(macro: DataFrame, indicators: Sequence[str]) -> DataFrame:
    """Indicators as columns, first value per day in source order. The list fixes the schema."""
    return macro.groupBy(DAY).pivot("indicator", list(indicators)).agg(F.min_by("value", "source"))


def forward_fill(spine: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Last known value of each column up to the day. ``spine`` has one row per day."""
    w = Window.orderBy(DAY).rowsBetween(Window.unboundedPreceding, 0)
    filled = {c: F.last(c, ignorenulls=True).over(w) for c in columns}
    return spine.withColumns(filled)


def macro_in_force(daily: DataFrame, macro: DataFrame, indicators: Sequence[str]) -> DataFrame:
    """Indicators per commodity and day of ``daily``: the value of the newest period that began by then, of the
    commodity itself or else of the records about none. ``macro`` has one row per commodity, indicator and period.

    Periods take their place between the days of a commodity and are filled forward, so no day meets a period
    that is not its own and periods without prices count too.
    """

    def wide(rows: DataFrame, *keys: str) -> DataFrame:
        return rows.groupBy(*keys).pivot("indicator", list(indicators)).agg(F.max("value"))

    spine = daily.select("komoditas", DAY)
    own = spine.withColumn("_priced", F.lit(True)).join(
        wide(macro.filter(F.col("komoditas").isNotNull()), "komoditas", DAY), ["komoditas", DAY], "full"
    )
    w = Window.partitionBy("komoditas").orderBy(DAY).rowsBetween(Window.unboundedPreceding, 0)
    own = own.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in indicators}).filter("_priced")
    common = wide(macro.filter(F.col("komoditas").isNull()), DAY)
    common = forward_fill(spine.select(DAY).distinct().join(common, DAY, "full"), indicators)
    common = common.withColumnsRenamed({c: f"_{c}" for c in indicators})
    return own.join(common, DAY, "left").select(
        "komoditas", DAY, *[F.coalesce(c, f"_{c}").alias(c) for c in indicators]
    )


def feature_store(
    daily: DataFrame,
    macro: DataFrame | None = None,
    indicators: Sequence[str] = (),
    fx: DataFrame | None = None,
    weather: DataFrame | None = None,
    news: DataFrame | None = None,
    reuse: bool = True,
) -> DataFrame:
    """Daily prices with macro and exchange rate (filled forward) and weather and news (0 when
    missing). Macro with a ``komoditas`` goes to the days of that commodity (``macro_in_force``).

    ``daily`` feeds both the day spine and the result. With ``reuse`` it is computed once and
    read twice, which saves a second scan of the raw prices.
    """
    if reuse:
        daily = materialize(daily)
    days = daily.select(DAY).distinct()
    by_commodity = macro is not None and "komoditas" in macro.columns
    in_force = macro_in_force(daily, macro, indicators) if by_commodity and indicators else None
    if macro is not None and not by_commodity:
        days = days.join(macro_pivot(macro, indicators), DAY, "left")
    if fx is not None:
        days = days.join(daily_fx(fx), DAY, "left")
    fill = [*([] if by_commodity else indicators), *(["kurs_usd_idr"] if fx is not None else [])]
    days = forward_fill(days, fill) if fill else days
    if weather is not None:
        days = days.join(daily_weather(weather), DAY, "left").fillna(
            0.0, subset=["precipitation_sum", "temperature_max"]
        )
    if news is not None:
        per_day = news_velocity(daily_news(news)).drop("article_count")
        days = days.join(per_day, DAY, "left").fillna(0.0, subset=["news_score", "news_velocity"])
    store = daily.join(days, DAY, "left")
    if in_force is None:
        return store
    return store.join(in_force, ["komoditas", DAY], "left").select(*store.columns, *indicators)


def price_summary(daily: DataFrame) -> DataFrame:
    """Days, lowest, mean and highest price per commodity."""
    return daily.groupBy("komoditas").agg(
        F.countDistinct(DAY).alias("n_days"),
        F.min("avg_price").alias("min_price"),
        rnd(exact_avg("avg_price"), 2).alias("mean_price"),
        F.max("avg_price").alias("max_price"),
    )
