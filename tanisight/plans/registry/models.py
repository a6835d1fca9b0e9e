"""Fitted models. No SQL can refit them; `model_properties` states what must hold of them.

All fit the operators' own numbers of trees.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tanisight.dims import FEATURES_7D
from tanisight.operators import evaluate, models
from tanisight.plans import layers
from tanisight.plans.registry import features  # noqa: F401  (its views of the matrices)
from tanisight.plans.views_sql import sql
from tanisight.session import materialize


def _store(spark, sf):
    return materialize(layers.model_input(spark, sf))


def _forecast(spark, sf):
    return models.forecast(_store(spark, sf), "7d")


def _comparison(spark, sf):
    store = _store(spark, sf)
    model, _ = models.forecast(store, "7d")
    return evaluate.model_vs_baseline(model, evaluate.naive_backtest(store))


FITTED = {
    "forecast_7d": lambda s, d: _forecast(s, d)[0],
    "forecast_7_14": lambda s, d: models.forecast_table(_store(s, d)),
    "feature_importance": lambda s, d: models.ranked_importance(_forecast(s, d)[1]),
    "top_features": lambda s, d: models.ranked_importance(_forecast(s, d)[1], 3),
    "model_vs_baseline": _comparison,
    "magnitude_quantiles": lambda s, d: models.magnitude(_store(s, d)),
    "timing_windows": lambda s, d: models.timing(_store(s, d)),
}



def _properties(spark, sf):
    """What must hold of the fitted models, next to what they were fitted on."""
    store = _store(spark, sf)
    forecast, importance = models.forecast(store, "7d")
    ranks = models.ranked_importance(importance).groupBy("komoditas").agg(
        F.count(F.lit(1)).alias("n_features"), F.max("rank").cast("long").alias("last_rank"), F.round(F.sum("importance"), 3).alias("importance_total"))
    moves = models.magnitude(store).select("komoditas", *[
        ((F.col(f"{u}_p10") <= F.col(f"{u}_p50")) & (F.col(f"{u}_p50") <= F.col(f"{u}_p90"))).alias(f"{u}_ordered") for u in ("rpkg", "pct")])
    p = [F.col(f"p_window_{c}") for c in range(4)]
    windows = models.timing(store).select(
        "komoditas", (F.abs(sum(p[1:], p[0]) - 1) < 0.003).alias("windows_add_up"), (F.col("confidence") == F.greatest(*p)).alias("most_likely_window"))
    return forecast.select("komoditas", "current_price", "training_samples").join(ranks, "komoditas").join(moves, "komoditas").join(windows, "komoditas")


QUERIES = FITTED | {"model_properties": _properties}

SQL: dict[str, str] = {
    "model_properties": sql(f"""
        SELECT komoditas, current_price, training_samples, CAST({len(FEATURES_7D)} AS BIGINT) AS n_features,
               CAST({len(FEATURES_7D)} AS BIGINT) AS last_rank, 1.0::DOUBLE AS importance_total, true AS rpkg_ordered, true AS pct_ordered,
               true AS windows_add_up, true AS most_likely_window
        FROM (SELECT komoditas, count(*) AS training_samples FROM matrix_7d GROUP BY 1)
        JOIN (SELECT komoditas, round(arg_max(avg_price, date_parsed), 0) AS current_price FROM daily GROUP BY 1) USING (komoditas)""",
        "matrix_7d", "daily"),
}
