"""Price, weather and news signals (0-100), their fusion and the risk level."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tanisight.dims import RiskSettings
from tanisight.functions.numeric import clamp, exact_sum, frame, rnd, scaled, spread_agg, spread_over
from tanisight.operators.dedup import top_rows

KEY, DAY, PRICE = "komoditas", "date_parsed", "avg_price"


def momentum_and_z(now: str, week: str, n: str, total: str, gap: str) -> tuple[Column, Column]:
    """Change since the price of a week ago in percent, and distance from the mean in deviations; 0 where there is none."""
    momentum = F.when(F.col(week).isNotNull(), (F.col(now) - F.col(week)) / F.col(week) * 100).otherwise(0.0)
    z = F.when(
        F.col(gap) > 0, (F.col(n) * scaled(now).cast("double") - F.col(total)) / F.sqrt(gap)
    ).otherwise(0.0)
    return momentum, z


def price_score(momentum: str, z: str) -> Column:
    steep = clamp((F.col(momentum) + 20) / 40 * 100, 0, 100)
    far = clamp((F.col(z) + 2) / 4 * 100, 0, 100)
    return rnd(0.6 * steep + 0.4 * far, 2)


def price_signal(daily: DataFrame, commodities: DataFrame, lookback: int = 30) -> DataFrame:
    """Seven-row momentum (60 %) and distance from the mean of the last rows (40 %); 50 without
    prices.

    The z-score is taken from whole cents, so equal prices give exactly 0.
    """
    priced = daily.filter(F.col(PRICE).isNotNull() & (F.col(PRICE) != 0))
    recent = top_rows(priced, [KEY], [F.col(DAY).desc()], lookback)
    n, total, gap = spread_agg(PRICE)
    stats = recent.groupBy(KEY).agg(
        F.max_by(PRICE, DAY).alias("_now"),
        F.max(F.when(F.col("_rank") == 7, F.col(PRICE))).alias("_week"),
        n.alias("_n"),
        total.cast("double").alias("_total"),
        gap.alias("_gap"),
    )
    momentum, z = momentum_and_z("_now", "_week", "_n", "_total", "_gap")
    scored = stats.select(KEY, momentum.alias("_m"), z.alias("_z")).select(
        KEY, price_score("_m", "_z").alias("price_signal")
    )
    return commodities.select(KEY).join(scored, KEY, "left").fillna(50.0, subset=["price_signal"])


def latest_per_region(weather: DataFrame, seen: str, tie: str) -> DataFrame:
    """Newest record of each region; the first one wins on equal times."""
    return top_rows(weather, ["sentra"], [F.col(seen).desc(), F.col(tie).asc()], 1).drop("_rank")


def weather_score(current: str = "current", heavy_rain_mm: float = 50.0) -> Column:
    """Rain, storm code and extreme temperature of one region, capped at 100."""
    rain = F.when(F.coalesce(F.col(f"{current}.precipitation"), F.lit(0.0)) > heavy_rain_mm, 50.0).otherwise(0.0)
    code = F.coalesce(F.col(f"{current}.weather_code"), F.lit(0))
    storm = F.when(code >= 80, 40.0).when(code >= 60, 20.0).otherwise(0.0)
    temp = F.col(f"{current}.temperature_2m")
    heat = F.when(temp >= 35.0, 15.0).when(temp <= 15.0, 10.0).otherwise(0.0)
    return F.least(rain + storm + heat, F.lit(100.0))


def weighted_mean(value: Column, weight: Column) -> Column:
    """Mean over the rows present, by weight (weights with at most 4 decimals)."""
    return F.try_divide(exact_sum(value * weight, 4), exact_sum(weight, 4))


def weather_signal(
    latest: DataFrame, regions: DataFrame, commodities: DataFrame, heavy_rain_mm: float = 50.0
) -> DataFrame:
    """Weighted weather score over a commodity's regions; 0 where none reported."""
    scores = latest.select(F.col("sentra").alias("nama"), weather_score(heavy_rain_mm=heavy_rain_mm).alias("_s"))
    signal = (
        regions.join(scores, "nama")
        .groupBy(KEY)
        .agg(rnd(weighted_mean(F.col("_s"), F.col("bobot")), 2).alias("weather_signal"))
    )
    return commodities.select(KEY).join(signal, KEY, "left").fillna(0.0, subset=["weather_signal"])


def news_score(velocity: str, mean_score: str) -> Column:
    speed = F.least(F.lit(100.0), F.col(velocity) / 3 * 100)
    score = F.least(F.lit(100.0), F.col(mean_score) / 15 * 100)
    return rnd(0.6 * speed + 0.4 * score, 2)


def news_signal(velocity: DataFrame, commodities: DataFrame) -> DataFrame:
    """Mention velocity (60 %) and mean article score (40 %); 0 without news."""
    signal = velocity.select(KEY, news_score("velocity", "avg_score").alias("news_signal"))
    return commodities.select(KEY).join(signal, KEY, "left").fillna(0.0, subset=["news_signal"])


def risk_level(index: Column, settings: RiskSettings = RiskSettings()) -> Column:
    """Name of the highest threshold reached."""
    steps = sorted(settings.levels.items(), key=lambda kv: -kv[1])
    name, bound = steps[0]
    level = F.when(index >= bound, name)
    for name, bound in steps[1:]:
        level = level.when(index >= bound, name)
    return level.otherwise(settings.lowest)


def risk_index(
    price: DataFrame, weather: DataFrame, news: DataFrame, settings: RiskSettings = RiskSettings()
) -> DataFrame:
    """Weighted fusion of the three signals and its level."""
    return fused(price.join(weather, KEY).join(news, KEY), settings)


def fused(signals: DataFrame, settings: RiskSettings = RiskSettings()) -> DataFrame:
    """The rows with ``risk_index`` and ``level`` from their three signals."""
    index = rnd(
        settings.price_weight * F.col("price_signal")
        + settings.weather_weight * F.col("weather_signal")
        + settings.news_weight * F.col("news_signal"),
        2,
    )
    return signals.withColumn("risk_index", index).withColumn("level", risk_level(F.col("risk_index"), settings))


# --- the index of every day ---------------------------------------------------------------
# All three signals as they stood on each day, in one pass over a small table of at most one row per
# commodity and day, instead of one run per day.


def daily_price_signal(daily: DataFrame, lookback: int = 30) -> DataFrame:
    """``price_signal`` at every priced row, from that row and the ones before it. Other columns stay."""
    n, total, gap = spread_over(PRICE, frame(KEY, DAY, lookback))
    priced = daily.filter(F.col(DAY).isNotNull() & F.col(PRICE).isNotNull() & (F.col(PRICE) != 0))
    framed = priced.withColumns(
        {"_week": F.lag(PRICE, 6).over(Window.partitionBy(KEY).orderBy(DAY)), "_n": n,
         "_total": total.cast("double"), "_gap": gap}
    )
    momentum, z = momentum_and_z(PRICE, "_week", "_n", "_total", "_gap")
    scored = framed.withColumns({"_m": momentum, "_z": z}).withColumn("price_signal", price_score("_m", "_z"))
    return scored.drop("_week", "_n", "_total", "_gap", "_m", "_z")


def weather_steps(
    weather: DataFrame, regions: DataFrame, seen: str, tie: str, heavy_rain_mm: float = 50.0
) -> DataFrame:
    """Changes of the weighted score and of the weight reported so far, per commodity and day.

    ``weather`` has (sentra, date_parsed, current, ``seen``, ``tie``); the newest record of a region's day
    counts, as in ``latest_per_region``. Sums are whole numbers of 10^-4, so a running sum of the steps is
    exact. Days on which a region's score stays the same are not sent.
    """
    newest = top_rows(
        weather.filter(F.col(DAY).isNotNull()), ["sentra", DAY], [F.col(seen).desc(), F.col(tie).asc()], 1
    )
    scores = newest.select(
        F.col("sentra").alias("nama"), DAY, weather_score(heavy_rain_mm=heavy_rain_mm).cast("long").alias("_s")
    )
    before = F.lag("_s").over(Window.partitionBy("nama").orderBy(DAY))
    steps = scores.withColumn("_before", before).select(
        "nama", DAY, (F.col("_s") - F.coalesce("_before", F.lit(0))).alias("_up"),
        F.col("_before").isNull().cast("long").alias("_new"),
    ).filter("_up <> 0 or _new = 1")
    weights = regions.select(KEY, "nama", F.round(F.col("bobot") * 10000).cast("long").alias("_w"))
    return steps.join(weights, "nama").groupBy(KEY, DAY).agg(
        F.sum(F.col("_up") * F.col("_w")).alias("_score"), F.sum(F.col("_new") * F.col("_w")).alias("_weight")
    )


def daily_risk_index(
    daily: DataFrame,
    weather: DataFrame,
    regions: DataFrame,
    mentions: DataFrame,
    seen: str = "ingestion_ts",
    tie: str = "fetched_at_utc",
    window_days: int = 7,
    settings: RiskSettings = RiskSettings(),
) -> DataFrame:
    """Risk index and level of every priced row, as known at the end of its day.

    Equal to ``risk_index`` run on each day with the prices, weather records and articles up to it.
    ``mentions`` has (komoditas, date, n_articles, total_score), one row per day. A commodity without
    weather or news so far has 0 there.
    """
    prices = daily_price_signal(daily)
    moves = (
        prices.select(KEY, DAY, F.lit(True).alias("_priced"))
        .unionByName(weather_steps(weather, regions, seen, tie, settings.heavy_rain_mm), allowMissingColumns=True)
        .unionByName(
            mentions.select(KEY, F.col("date").alias(DAY), F.col("n_articles").alias("_n"), F.col("total_score").alias("_t")),
            allowMissingColumns=True,
        )
        .filter(F.col(DAY).isNotNull())
        .groupBy(KEY, DAY)
        .agg(F.max("_priced").alias("_priced"), *[F.sum(c).alias(c) for c in ("_score", "_weight", "_n", "_t")])
        .withColumn("_day", F.unix_date(DAY))
    )
    by_day = Window.partitionBy(KEY).orderBy("_day")
    so_far = by_day.rowsBetween(Window.unboundedPreceding, 0)
    lately = by_day.rangeBetween(-2 * window_days, 0)
    known = moves.select(
        KEY, DAY, "_priced",
        F.try_divide(F.sum("_score").over(so_far) / 10000.0, F.sum("_weight").over(so_far) / 10000.0).alias("_wx"),
        F.coalesce("_n", F.lit(0)).alias("_today"),
        # At most 2 * window + 1 counts, oldest first
        F.slice(F.reverse(F.collect_list("_n").over(lately)), 1, window_days).alias("_counts"),
        rnd(F.try_divide(F.sum("_t").over(lately), F.sum("_n").over(lately)), 2).alias("_mean"),
    ).filter("_priced")
    total = F.aggregate("_counts", F.lit(0).cast("long"), lambda a, x: a + x)
    paced = known.withColumn("_avg", F.try_divide(total, F.size("_counts")))
    speed = F.when(F.col("_avg") > 0, rnd(F.col("_today") / F.col("_avg"), 2)).otherwise(0.0)
    signals = paced.withColumns({"_speed": speed, "_mean": F.coalesce("_mean", F.lit(0.0))}).select(
        KEY, DAY,
        F.coalesce(rnd("_wx", 2), F.lit(0.0)).alias("weather_signal"),
        news_score("_speed", "_mean").alias("news_signal"),
    )
    return fused(prices.join(signals, [KEY, DAY]), settings)


def level_counts(levels: DataFrame) -> DataFrame:
    """Number of commodities in total and per level."""
    return levels.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col("level") == n).alias(n.lower()) for n in ("KRITIS", "SIAGA", "WASPADA", "AMAN")],
    )


def high_risk(levels: DataFrame) -> DataFrame:
    """Commodities above the lowest level, highest index first, with their rank.

    One row per commodity comes in, so ranking them in one task is cheap.
    """
    risky = levels.filter(F.col("level").isin("WASPADA", "SIAGA", "KRITIS"))
    order = Window.orderBy(F.col("risk_index").desc(), KEY)
    return risky.select(KEY, "level", "risk_index", F.row_number().over(order).alias("rank"))
