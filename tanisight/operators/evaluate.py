"""Baseline back-test, lead time of alerts, and the evaluation report."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tanisight.functions.numeric import exact_avg, fixed_sum, rnd, scaled
from tanisight.operators.features import DAY, KEY, PRICE, by_day, change, clean_series


def naive_backtest(daily: DataFrame, horizon: int = 7, min_rows: int = 30) -> DataFrame:
    """Error of "the price of ``horizon`` rows ago": MAPE, RMSE and directional accuracy."""
    series = clean_series(daily, min_rows).withColumns(
        {"_hat": F.lag(PRICE, horizon).over(by_day()), "_prev": F.lag(PRICE, 1).over(by_day()),
         "_i": F.row_number().over(by_day())}
    )
    rows = series.filter(F.col("_i") > horizon).withColumns(
        {
            "_ape": F.when(F.col(PRICE) != 0, F.abs((F.col(PRICE) - F.col("_hat")) / F.col(PRICE))),
            "_err": scaled(PRICE) - scaled("_hat"),
            "_hit": F.when(
                F.col("_i") > horizon + 1,
                F.signum(F.col(PRICE) - F.col("_prev")) == F.signum(F.col("_hat") - F.col("_prev")),
            ),
        }
    )
    squares = F.sum((F.col("_err") * F.col("_err")).cast("decimal(26,0)")).cast("double")
    return rows.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("n_samples"),
        rnd(F.try_divide(fixed_sum("_ape"), F.count("_ape")) * 100, 2).alias("baseline_mape"),
        rnd(F.sqrt(squares / F.count(F.lit(1))) / 100, 0).alias("baseline_rmse"),
        rnd(F.try_divide(F.count_if("_hit"), F.count("_hit")) * 100, 1).alias("baseline_da"),
    )


def evaluation_summary(report: DataFrame) -> DataFrame:
    """Mean baseline error over the commodities."""
    return report.agg(
        rnd(exact_avg("baseline_mape"), 2).alias("avg_baseline_mape"),
        F.count(F.lit(1)).alias("komoditas_count"),
    )


def spike_and_alert_days(
    daily: DataFrame, daily_risk: DataFrame, spike_pct: float = 10.0, risk_at: float = 60.0, horizon: int = 7
) -> tuple[DataFrame, DataFrame]:
    """(spikes, alerts): days whose price rose by ``spike_pct`` or more over ``horizon`` rows, and days
    whose risk index is ``risk_at`` or more."""
    moves = clean_series(daily, horizon + 1).withColumn("_move", change(horizon))
    return (
        moves.filter(F.col("_move") >= spike_pct).select(KEY, DAY),
        daily_risk.filter(F.col("risk_index") >= risk_at).select(KEY, DAY).distinct(),
    )


def lead_times(spikes: DataFrame, alerts: DataFrame, max_days: int = 30) -> DataFrame:
    """For every spike day the latest alert strictly before it, if 1..``max_days`` days apart.

    Both inputs have (komoditas, date_parsed). An as-of join as one running pass: spikes and
    alerts in one series, spikes before alerts on equal days.
    """
    events = spikes.select(KEY, DAY, F.lit(0).alias("_kind")).unionByName(
        alerts.select(KEY, DAY, F.lit(1).alias("_kind"))
    )
    before = (
        Window.partitionBy(KEY).orderBy(DAY, "_kind").rowsBetween(Window.unboundedPreceding, -1)
    )
    alert = F.last(F.when(F.col("_kind") == 1, F.col(DAY)), ignorenulls=True).over(before)
    paired = events.withColumn("alert_date", alert).filter(F.col("_kind") == 0)
    return (
        paired.withColumn("lead_days", F.datediff(DAY, "alert_date"))
        .filter(F.col("lead_days").between(1, max_days))
        .select(KEY, F.col(DAY).alias("spike_date"), "alert_date", "lead_days")
    )


def lead_time_stats(pairs: DataFrame, commodities: DataFrame) -> DataFrame:
    """Mean, shortest and longest lead and number of events; null and 0 where there are none."""
    stats = pairs.groupBy(KEY).agg(
        rnd(F.sum("lead_days") / F.count("lead_days"), 1).alias("avg_lead_days"),
        F.min("lead_days").alias("min_lead_days"),
        F.max("lead_days").alias("max_lead_days"),
        F.count(F.lit(1)).alias("events"),
    )
    return commodities.select(KEY).join(stats, KEY, "left").fillna(0, subset=["events"])


def model_vs_baseline(model: DataFrame, baseline: DataFrame) -> DataFrame:
    """Model error next to the baseline's, the improvement and whether the model wins."""
    joined = baseline.join(model.select(KEY, "mape_avg", "rmse_avg"), KEY, "left")
    better = F.col("baseline_mape") - F.coalesce("mape_avg", "baseline_mape")
    return joined.withColumns(
        {
            "improvement_vs_baseline_mape": rnd(better, 2),
            "model_wins": F.coalesce(F.col("mape_avg") < F.col("baseline_mape"), F.lit(False)),
        }
    )


def evaluation_view(
    commodities: DataFrame, baseline: DataFrame, model: DataFrame, risk: DataFrame, importance: DataFrame
) -> DataFrame:
    """One row per commodity: baseline and model error, current risk, top features."""
    return (
        commodities.join(baseline.select(KEY, "n_samples", "baseline_mape", "baseline_da"), KEY, "left")
        .join(model.select(KEY, F.col("mape_avg").alias("model_mape")), KEY, "left")
        .join(risk.select(KEY, F.col("risk_index").alias("current_risk_index")), KEY, "left")
        .join(importance, KEY, "left")
    )
