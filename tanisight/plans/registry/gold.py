"""Daily aggregates, joins and the feature store."""

from __future__ import annotations

from pyspark.sql import functions as F

from tanisight.operators import clean, gold
from tanisight.plans import layers, standins
from tanisight.plans.standins import INDICATORS, TYPES
from tanisight.plans.views_sql import TYPE_LIST, eavg, esum, rnd, sql, view

DAY = gold.DAY


def _join_macro(spark, sf):
    pivot = gold.macro_pivot(layers.silver_macro(spark, sf), INDICATORS)
    return layers.daily(spark, sf).join(pivot, DAY, "left")


def _join_fx(spark, sf):
    return gold.feature_store(layers.daily(spark, sf), fx=layers.silver_kurs(spark, sf))


def _join_weather(spark, sf):
    return gold.feature_store(layers.daily(spark, sf), weather=layers.silver_weather(spark, sf), reuse=False)


def _join_news(spark, sf):
    return gold.feature_store(layers.daily(spark, sf), news=layers.silver_news(spark, sf), reuse=False)


def _ffill_macro(spark, sf):
    return gold.feature_store(
        layers.daily(spark, sf), macro=layers.silver_macro(spark, sf), indicators=INDICATORS
    )


PERIOD_MEASURES = ["produksi_ton", "harga_konsumen"]


def _macro_by_period(spark, sf):
    """Orders as batch records: a month or a whole year, a province each, one in seven about no commodity."""
    slot = F.col("o_custkey") % (len(TYPES) + 1)
    names = F.array(*[F.lit(t) for t in TYPES])
    records = standins.table(spark, sf, "orders").select(
        F.col("o_orderstatus").alias("source"), F.col("o_orderpriority").alias("provinsi"),
        F.get(names, slot.cast("int")).alias("komoditas"), F.year("o_orderdate").alias("tahun"),
        F.when(F.col("o_orderkey") % 2 == 0, F.month("o_orderdate")).alias("bulan"),
        *[F.col("o_totalprice").alias(m) for m in PERIOD_MEASURES], F.col("o_orderdate").alias("fetched_at_utc"), "o_orderkey",
    )
    return clean.macro_by_period(records, PERIOD_MEASURES, ["harga_konsumen"], ["fetched_at_utc", "o_orderkey"])


def _macro_in_force(spark, sf):
    return gold.feature_store(layers.daily(spark, sf), macro=_macro_by_period(spark, sf), indicators=PERIOD_MEASURES)


QUERIES = {
    "daily_prices": layers.daily,
    "daily_fx": lambda s, d: gold.daily_fx(layers.silver_kurs(s, d)),
    "daily_weather": lambda s, d: gold.daily_weather(layers.silver_weather(s, d)),
    "daily_news": lambda s, d: gold.daily_news(layers.silver_news(s, d)),
    "news_velocity": lambda s, d: gold.news_velocity(gold.daily_news(layers.silver_news(s, d))),
    "macro_pivot": lambda s, d: gold.macro_pivot(layers.silver_macro(s, d), INDICATORS),
    "price_summary": lambda s, d: gold.price_summary(layers.daily(s, d)),
    "join_macro": _join_macro,
    "join_fx_ffill": _join_fx,
    "join_weather": _join_weather,
    "join_news": _join_news,
    "ffill_macro": _ffill_macro,
    "gold_feature_store": layers.feature_store,
    "macro_by_period": _macro_by_period,
    "macro_in_force": _macro_in_force,
}

view("macro_period", f"""
SELECT komoditas, indicator, date_parsed, arg_min(value, source) AS value
FROM (WITH newest AS (
        SELECT * FROM (SELECT o_orderstatus AS source, o_orderpriority AS provinsi, o_totalprice, o_orderdate, o_orderkey,
                 [{TYPE_LIST}][CAST(o_custkey % {len(TYPES) + 1} AS INT) + 1] AS komoditas,
                 CAST(date_trunc(CASE WHEN o_orderkey % 2 = 0 THEN 'month' ELSE 'year' END, o_orderdate) AS DATE) AS date_parsed
               FROM orders)
        QUALIFY row_number() OVER (PARTITION BY source, provinsi, komoditas, date_parsed
                                   ORDER BY o_orderdate DESC, o_orderkey DESC, o_totalprice DESC) = 1)
      SELECT source, komoditas, date_parsed, 'produksi_ton' AS indicator, {esum('o_totalprice')} AS value
      FROM newest GROUP BY 1, 2, 3
      UNION ALL SELECT source, komoditas, date_parsed, 'harga_konsumen', {rnd(eavg('o_totalprice'), 4)}
      FROM newest GROUP BY 1, 2, 3)
GROUP BY 1, 2, 3""")

_joins = "\n".join(
    f"""ASOF LEFT JOIN (SELECT * FROM macro_period WHERE indicator = '{m}' AND komoditas IS NOT NULL) a{i}
        ON daily.komoditas = a{i}.komoditas AND daily.date_parsed >= a{i}.date_parsed
    ASOF LEFT JOIN (SELECT * FROM macro_period WHERE indicator = '{m}' AND komoditas IS NULL) b{i}
        ON daily.date_parsed >= b{i}.date_parsed"""
    for i, m in enumerate(PERIOD_MEASURES)
)

SQL = {
    "daily_prices": sql("SELECT * FROM daily", "daily"),
    "daily_fx": sql("SELECT * FROM daily_fx", "daily_fx"),
    "daily_weather": sql("SELECT * FROM daily_weather", "daily_weather"),
    "daily_news": sql("SELECT * FROM daily_news", "daily_news"),
    "news_velocity": sql("SELECT * FROM news_velocity", "news_velocity"),
    "macro_pivot": sql("SELECT * FROM macro_pivot", "macro_pivot"),
    "price_summary": sql(
        """SELECT komoditas, count(DISTINCT date_parsed) AS n_days, min(avg_price) AS min_price,
        (floor(CAST(sum(CAST(avg_price AS DECIMAL(18,2))) AS DOUBLE) / count(avg_price) * 100 + 0.5) / 100)
            AS mean_price,
        max(avg_price) AS max_price FROM daily GROUP BY 1""", "daily"),
    "join_macro": sql("SELECT * FROM daily LEFT JOIN macro_pivot USING (date_parsed)", "daily", "macro_pivot"),
    "join_fx_ffill": sql(
        "SELECT daily.*, kurs_usd_idr FROM daily LEFT JOIN spine USING (date_parsed)", "daily", "spine"),
    "join_weather": sql(
        """SELECT daily.*, coalesce(precipitation_sum, 0.0) AS precipitation_sum,
        coalesce(temperature_max, 0.0) AS temperature_max
        FROM daily LEFT JOIN daily_weather USING (date_parsed)""", "daily", "daily_weather"),
    "join_news": sql(
        """SELECT daily.*, coalesce(news_score, 0.0) AS news_score, coalesce(news_velocity, 0.0) AS news_velocity
        FROM daily LEFT JOIN news_velocity USING (date_parsed)""", "daily", "news_velocity"),
    "ffill_macro": sql(
        f"SELECT daily.*, {', '.join(INDICATORS)} FROM daily LEFT JOIN spine USING (date_parsed)",
        "daily", "spine"),
    "gold_feature_store": sql("SELECT * FROM gold", "gold"),
    "macro_by_period": sql("SELECT * FROM macro_period", "macro_period"),
    "macro_in_force": sql(
        f"""SELECT daily.*, {', '.join(f'coalesce(a{i}.value, b{i}.value) AS {m}' for i, m in enumerate(PERIOD_MEASURES))}
        FROM daily {_joins}""", "daily", "macro_period"),
}
