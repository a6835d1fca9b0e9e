"""Serving views: prices, levels, forecasts and histories as one row per commodity or day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tanisight.dims import SEVERITY
from tanisight.functions.numeric import clamp, rnd
from tanisight.functions.text import title_label
from tanisight.operators.dedup import top_rows

KEY, DAY, PRICE = "komoditas", "date_parsed", "avg_price"


def capped_change(change: Column, limit: float = 10.0) -> Column:
    """Predicted change limited to +-``limit`` percent; missing counts as 0."""
    return rnd(clamp(F.coalesce(change, F.lit(0.0)), -limit, limit), 2)


def capped_forecast(forecast: DataFrame, real: DataFrame) -> DataFrame:
    """Real price where known, and the forecast it implies with the capped change."""
    joined = forecast.join(real.select(KEY, F.col("price").alias("_real")), KEY, "left")
    price = F.coalesce(F.when(F.col("_real") != 0, F.col("_real")), F.col("current_price"))
    return (
        joined.withColumns({"price": price, "change_pct": capped_change(F.col("predicted_change_pct"))})
        .withColumn(
            "capped_7d",
            F.when(F.col("price") != 0, rnd(F.col("price") * (1 + F.col("change_pct") / 100), 0)).otherwise(
                F.col("forecast_7d")
            ),
        )
        .drop("_real")
    )


def newest_rows(store: DataFrame) -> DataFrame:
    """Newest row of each commodity."""
    return top_rows(store, [KEY], [F.col(DAY).desc()], 1).drop("_rank")


def current_prices(capped: DataFrame, store: DataFrame) -> DataFrame:
    """Forecast prices, then commodities missing there with their newest stored price."""
    known = capped.select(KEY, "price", F.col("capped_7d").alias("forecast_7d"), "change_pct")
    missing = newest_rows(store).join(known.select(KEY), KEY, "left_anti")
    return known.unionByName(missing.select(KEY, F.col(PRICE).alias("price")), allowMissingColumns=True)


def fused_level(risk: Column, alert: Column, change: Column) -> Column:
    """The more severe of risk and alert level, overridden by the capped change."""
    order = F.create_map(*[F.lit(x) for kv in SEVERITY.items() for x in kv])
    raised = F.when(
        F.coalesce(order[alert], F.lit(0)) > F.coalesce(order[risk], F.lit(0)), alert
    ).otherwise(risk)
    return (
        F.when(change > 7, "KRITIS")
        .when(change > 5, "SIAGA")
        .when(change > 3, "WASPADA")
        .when(change <= 0, "AMAN")
        .otherwise(raised)
    )


def direction_counts(changes: DataFrame) -> DataFrame:
    """How many go up (> 1 %), down (< -1 %) or stay."""
    c = F.col("change_pct")
    return changes.agg(
        F.count_if(c > 1).alias("naik"),
        F.count_if(c < -1).alias("turun"),
        F.count_if(F.coalesce(c.between(-1, 1), F.lit(True))).alias("stabil"),
    )


def forecast_timeline(forecast: DataFrame, as_of: str, days: int = 14) -> DataFrame:
    """Straight line from today to the 7-day forecast and on to the 14-day one."""
    steps = forecast.select(
        KEY, "current_price", "forecast_7d", "forecast_14d", F.explode(F.sequence(F.lit(1), F.lit(days))).alias("step")
    )
    i = F.col("step")
    line = F.when(
        i <= 7, F.col("current_price") + (F.col("forecast_7d") - F.col("current_price")) * (i / 7.0)
    ).otherwise(F.col("forecast_7d") + (F.col("forecast_14d") - F.col("forecast_7d")) * ((i - 7) / 7.0))
    return steps.select(
        KEY,
        F.date_add(F.lit(as_of).cast("date"), i).alias("date"),
        rnd(line, 0).alias("predicted_price"),
        F.concat(F.lit("H+"), i.cast("string")).alias("day_label"),
    )


def prediction_view(
    commodities: DataFrame,
    capped: DataFrame,
    risk: DataFrame,
    magnitude: DataFrame | None = None,
    timing: DataFrame | None = None,
    features: DataFrame | None = None,
) -> DataFrame:
    """Forecast, size of move, timing, confidence and triggers per commodity.

    ``magnitude``: rpkg_p10, rpkg_p90, spike_probability; ``timing``: predicted_window;
    ``features``: top_features.
    """
    view = commodities.select(KEY).join(
        capped.select(KEY, "price", "capped_7d", "change_pct", "current_price", "forecast_14d", "model_mape"),
        KEY,
        "left",
    ).join(risk.select(KEY, "level"), KEY, "left")
    for extra in (magnitude, timing, features):
        if extra is not None:
            view = view.join(extra, KEY, "left")
    slope = (F.col("forecast_14d") - F.col("current_price")) / 7
    names = F.col("top_features") if features is not None else F.array().cast("array<string>")
    triggers = F.concat(
        F.transform(F.coalesce(names, F.array().cast("array<string>")), title_label),
        F.when(
            F.col("level").isin("KRITIS", "SIAGA"), F.array(F.concat(F.lit("Risk Level: "), "level"))
        ).otherwise(F.array().cast("array<string>")),
    )
    columns = {
        "forecast_price_14d": F.when(slope != 0, rnd(F.col("forecast_14d") + slope * 7, 0)),
        "confidence": F.when(
            F.col("model_mape") != 0, rnd(100 - F.least("model_mape", F.lit(50.0)), 1)
        ),
        "triggers": F.array_join(triggers, ", "),
    }
    if magnitude is not None:
        columns["magnitude_confidence"] = rnd(F.coalesce("spike_probability", F.lit(0.0)) * 100, 0)
    return view.withColumns(columns).drop("current_price", "forecast_14d", "model_mape", "level")


def commodity_view(
    commodities: DataFrame, capped: DataFrame, risk: DataFrame, model: DataFrame
) -> DataFrame:
    """Detail page of a commodity: price, forecast, risk and model error."""
    return (
        commodities.join(capped.select(KEY, "price", "forecast_7d", "predicted_change_pct"), KEY, "left")
        .join(risk.select(KEY, "risk_index", "level"), KEY, "left")
        .join(model, KEY, "left")
    )


def region_risk(regions: DataFrame, risk: DataFrame) -> DataFrame:
    """Regions with the risk of their commodity; 0 and AMAN where unknown."""
    return regions.join(risk.select(KEY, "risk_index", F.col("level").alias("risk_level")), KEY, "left").fillna(
        {"risk_index": 0.0, "risk_level": "AMAN"}
    )


def last_rows(store: DataFrame, n: int = 200) -> DataFrame:
    """The last ``n`` rows of the table by day."""
    return store.orderBy(F.col(DAY).desc(), F.col(KEY)).limit(n)


def history(store: DataFrame, n: int = 30) -> DataFrame:
    """Last ``n`` prices of each commodity."""
    return top_rows(store, [KEY], [F.col(DAY).desc()], n).select(KEY, DAY, PRICE, F.col("_rank").alias("age"))


def fx_history(store: DataFrame, n: int = 60) -> DataFrame:
    """Last ``n`` days with a known exchange rate, oldest first."""
    rate = F.col("kurs_usd_idr")
    per_day = store.filter(rate.isNotNull() & ~F.isnan(rate) & (rate != 0)).groupBy(DAY).agg(
        F.max(rate).alias("rate")
    )
    newest = per_day.orderBy(F.col(DAY).desc()).limit(n)
    return newest.select(DAY, rnd("rate", 2).alias("rate")).orderBy(DAY)


def fx_latest(store: DataFrame) -> DataFrame:
    """Newest known exchange rate and its day."""
    rate = F.col("kurs_usd_idr")
    known = store.filter(rate.isNotNull() & ~F.isnan(rate) & (rate != 0))
    return known.agg(rnd(F.max_by("kurs_usd_idr", DAY), 2).alias("rate"), F.max(DAY).alias("date"))


def export_status(found: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Which expected outputs hold rows, and whether all do. ``found`` has (name, n_rows)."""
    names = found.sparkSession.createDataFrame([(n,) for n in expected], "name string")
    status = names.join(found, "name", "left").select(
        "name", F.coalesce(F.col("n_rows") > 0, F.lit(False)).alias("present")
    )
    ready = status.agg(F.bool_and("present").alias("present")).select(F.lit("all_ready").alias("name"), "present")
    return status.unionByName(ready)
