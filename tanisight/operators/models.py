"""Forecast, size-of-move and timing models.

Training rows are daily: at most one per commodity and calendar day. All models of a kind, one per commodity and
fold or quantile, are fitted side by side in one Spark stage (boosting); errors, the choice of a fold's model
and importances are aggregates over its output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tanisight.dims import WINDOW_LABELS
from tanisight.operators.boosting import Pinball, Settings, Softmax, Squared, boost, importances
from tanisight.operators.dedup import top_rows
from tanisight.operators.features import (
    DAY, KEY, MATRICES, PRICE, class_weights, feature_matrix, scoring_rows, time_folds,
)
from tanisight.session import materialize

QUANTILES = {"p10": 0.1, "p50": 0.5, "p90": 0.9}

# Names of the timing features as triggers
TRIGGERS = {
    "price_momentum_3d": "momentum harga 3 hari",
    "price_momentum_7d": "momentum harga 7 hari",
    "price_momentum_14d": "momentum harga 14 hari",
    "price_ma_7d": "rata-rata harga 7 hari",
    "price_ma_14d": "rata-rata harga 14 hari",
    "price_std_7d": "volatilitas harga 7 hari",
    "price_std_14d": "volatilitas harga 14 hari",
    "precip_roll7": "curah hujan sentra produksi",
    "precip_anomaly": "anomali curah hujan",
    "temp_roll7": "suhu sentra produksi",
    "news_score": "intensitas berita pangan",
    "news_velocity": "kecepatan penyebaran berita",
    "month": "faktor musiman (bulan)",
    "is_ramadan_season": "musim Ramadan/Lebaran",
    "is_yearend": "akhir tahun/Natal",
}


def _with_newest(rows: DataFrame, newest: DataFrame, **columns) -> DataFrame:
    """Rows and, with role `new`, the newest row of each commodity; both with the columns."""
    new = newest.withColumns({"role": F.lit("new"), **columns})
    return rows.unionByName(new, allowMissingColumns=True)


def fold_predictions(store: DataFrame, kind: str, loss, settings: Settings, splits: int = 3, strict_reference: bool = False) -> DataFrame:
    """Predictions of each fold's model for the fold's test rows and for the newest row."""
    _, features, target = MATRICES[kind]
    folds = time_folds(feature_matrix(store, kind), splits)
    every = F.explode(F.array(*[F.lit(k) for k in range(splits)]))
    rows = _with_newest(folds, scoring_rows(store, kind, strict_reference), fold=every)
    return boost(rows, [KEY, "fold"], features, target, loss, settings)


def forecast(
    store: DataFrame, kind: str = "7d", trees: int = 200, splits: int = 3, strict_reference: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(forecast and errors, feature importance) per commodity.

    The fold model with the lowest RMSE scores the newest row.
    """
    features = MATRICES[kind][1]
    scored = materialize(fold_predictions(store, kind, Squared(), Settings(trees=trees), splits, strict_reference))
    hat = F.col("predicted")[0]
    error = F.col("target") - hat
    tested = scored.filter("role = 'test'").groupBy(KEY, "fold").agg(
        (F.avg(F.when(F.col("target") != 0, F.abs(error / F.col("target")))) * 100).alias("mape"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
    )
    errors = tested.groupBy(KEY).agg(
        F.avg("mape").alias("mape_avg"), F.stddev_pop("mape").alias("mape_std"), F.avg("rmse").alias("rmse_avg"),
        F.min_by("fold", F.struct("rmse", "fold")).alias("fold"),
    )
    best = scored.filter("role = 'new'").join(errors, [KEY, "fold"])
    now = scoring_rows(store, kind, strict_reference).select(KEY, PRICE)
    known = feature_matrix(store, kind).groupBy(KEY).agg(F.count(F.lit(1)).alias("training_samples"))
    joined = best.withColumn("hat", hat).join(now, KEY).join(known, KEY)
    forecasts = joined.select(
        KEY,
        F.round(PRICE, 0).alias("current_price"),
        F.round("hat", 0).alias("forecast"),
        F.round(F.try_divide(F.col("hat") - F.col(PRICE), F.col(PRICE)) * 100, 2).alias("change_pct"),
        F.round("mape_avg", 2).alias("mape_avg"),
        F.round("mape_std", 2).alias("mape_std"),
        F.round("rmse_avg", 0).alias("rmse_avg"),
        "training_samples",
    )
    chosen = scored.filter("row = 0").join(errors.select(KEY, "fold"), [KEY, "fold"], "left_semi")
    return forecasts, importances(chosen, [KEY], features)


def forecast_table(store: DataFrame, trees: int = 200) -> DataFrame:
    """Seven- and fourteen-row forecasts, changes, and the interval forecast +- RMSE."""
    week, _ = forecast(store, "7d_calendar", trees)
    fortnight, _ = forecast(store, "14d", trees)
    later = fortnight.select(KEY, F.col("forecast").alias("forecast_14d"))
    joined = week.join(later, KEY, "left").withColumns(
        {"forecast_7d": F.col("forecast"), "forecast_14d": F.coalesce("forecast_14d", "forecast")}
    )
    now = F.col("current_price")
    return joined.select(
        KEY, "current_price", "forecast_7d", "forecast_14d",
        F.round(F.try_divide(F.col("forecast_7d") - now, now) * 100, 2).alias("predicted_change_pct"),
        F.round(F.try_divide(F.col("forecast_14d") - now, now) * 100, 2).alias("predicted_change_pct_14d"),
        F.round(F.col("forecast_7d") - F.col("rmse_avg"), 0).alias("confidence_lower"),
        F.round(F.col("forecast_7d") + F.col("rmse_avg"), 0).alias("confidence_upper"),
        F.col("mape_avg").alias("model_mape"), "rmse_avg",
    )


def ranked_importance(importance: DataFrame, k: int | None = None) -> DataFrame:
    """Features of each model by importance, all or the first ``k``."""
    rounded = importance.withColumn("importance", F.round("importance", 6))
    ranked = top_rows(rounded, [KEY], [F.col("importance").desc(), F.col("feature")], k)
    return ranked.withColumnRenamed("_rank", "rank")


def magnitude(store: DataFrame, trees: int = 150) -> DataFrame:
    """10/50/90 % quantiles of the seven-row move, in rupiah and percent, by quantile loss on all known moves.

    Each quantile is a model of its own; the three values of a row are put in rising order.
    """
    _, features, target = MATRICES["magnitude"]
    known = feature_matrix(store, "magnitude")
    moves = F.explode(F.array(
        F.struct(F.lit("rpkg").alias("unit"), F.col(target).cast("double").alias("move")),
        F.struct(F.lit("pct").alias("unit"), F.col("target_change_pct").cast("double").alias("move"))))
    levels = F.explode(F.array(*[F.lit(q) for q in QUANTILES.values()]))
    rows = known.withColumns({"role": F.lit("train"), "m": moves}).select("*", "m.unit", "m.move").drop("m")
    new = scoring_rows(store, "magnitude").withColumns({"role": F.lit("new"), "unit": F.explode(F.array(F.lit("rpkg"), F.lit("pct")))})
    both = rows.unionByName(new, allowMissingColumns=True).withColumn("level", levels)
    scored = boost(both, [KEY, "unit", "level"], features, "move", lambda key: Pinball(key[2]), Settings(trees=trees, rows=1.0, columns=1.0))
    sorted_ = scored.groupBy(KEY, "unit").agg(F.array_sort(F.collect_list(F.col("predicted")[0])).alias("q"))
    wide = sorted_.groupBy(KEY).agg(*[
        F.max(F.when(F.col("unit") == unit, F.round(F.col("q")[i], places))).alias(f"{unit}_{name}")
        for unit, places in (("rpkg", 0), ("pct", 2)) for i, name in enumerate(QUANTILES)])
    return wide


def timing(store: DataFrame, trees: int = 200) -> DataFrame:
    """Window of the next spike per commodity, with the probability of each window."""
    _, features, target = MATRICES["timing"]
    matrix = feature_matrix(store, "timing")
    weights = class_weights(matrix).select(KEY, target, "weight")
    rows = _with_newest(matrix.join(weights, [KEY, target]).withColumn("role", F.lit("train")), scoring_rows(store, "timing"))
    scored = materialize(boost(rows, [KEY], features, target, Softmax(len(WINDOW_LABELS)), Settings(trees=trees), "weight"))
    labels = F.array(*[F.lit(WINDOW_LABELS[c]) for c in range(len(WINDOW_LABELS))])
    p = F.col("predicted")
    best = F.array_max(p)
    top = top_rows(importances(scored, [KEY], features), [KEY], [F.col("importance").desc(), F.col("feature")], 3)
    names = F.coalesce(F.create_map(*[F.lit(x) for kv in TRIGGERS.items() for x in kv])[F.col("feature")], F.col("feature"))
    triggers = top.groupBy(KEY).agg(F.array_sort(F.collect_list(F.struct("_rank", names.alias("name")))).alias("t")).select(
        KEY, F.array_join(F.col("t.name"), ", ").alias("key_triggers"))
    return scored.select(
        KEY,
        F.element_at(labels, F.array_position(p, best).cast("int")).alias("predicted_window"),
        *[F.round(p[c], 3).alias(f"p_window_{c}") for c in range(len(WINDOW_LABELS))],
        F.round(best, 3).alias("confidence"),
    ).join(triggers, KEY)
