"""Time-series features, folds, back-test and lead time."""

from __future__ import annotations

from pyspark.sql import functions as F

from tanisight.dims import FEATURES_14D, FEATURES_7D, FEATURES_MAGNITUDE, FEATURES_TIMING
from tanisight.functions.numeric import rnd as r
from tanisight.operators import evaluate, features as ft, gold
from tanisight.plans import layers
from tanisight.plans.views_sql import pct, rnd, sql, view

KEY, DAY, PRICE = ft.KEY, ft.DAY, ft.PRICE


def _cols(columns, digits=4, base=layers.daily):
    """Query that adds columns to a daily series and returns them rounded."""

    def run(spark, sf):
        made = columns()
        df = base(spark, sf).withColumns(made)
        return df.select(KEY, DAY, *[r(F.col(c).cast("double"), digits).alias(c) for c in made])

    return run


def _weather_rolls():
    return {
        "precip_roll7": ft.roll7("precipitation_sum"),
        "temp_roll7": ft.roll7("temperature_max"),
        "precip_roll7_filled": F.coalesce(ft.roll7("precipitation_sum"), F.lit(0.0)),
        "temp_roll7_filled": F.coalesce(ft.roll7("temperature_max"), F.lit(30.0)),
    }


def _anomaly():
    return {"precip_anomaly": F.col("precipitation_sum") - F.coalesce(ft.roll7("precipitation_sum"), F.lit(0.0))}


def _matrix(kind):
    def run(spark, sf):
        m = ft.feature_matrix(layers.model_input(spark, sf), kind)
        keep = {KEY, DAY, "target_class"}
        return m.select(*[F.col(c) if c in keep else r(F.col(c).cast("double"), 4).alias(c) for c in m.columns])

    return run


def _flags(spark, sf):
    return ft.spike_flags(layers.daily(spark, sf))


def _folds(spark, sf):
    return ft.time_folds(layers.daily(spark, sf).select(KEY, DAY))


QUERIES = {
    "feat_lags": _cols(lambda: ft.lags([1, 3, 7, 14, 30])),
    "feat_rolling": _cols(lambda: ft.rolling([7, 14, 30], [7, 14, 30])),
    "feat_pct_change": _cols(lambda: ft.changes([3, 7, 14, 30])),
    "feat_weather_roll": _cols(_weather_rolls, base=layers.daily_with_weather),
    "precip_anomaly": _cols(_anomaly, base=layers.daily_with_weather),
    "volatility_cv": _cols(lambda: {"coeff_var_14d": ft.variation()}),
    "targets_forward": _cols(lambda: ft.targets()),
    "feat_calendar": _cols(lambda: ft.calendar()),
    "spike_flags": lambda s, d: _flags(s, d).withColumn("price_pct_7d", r("price_pct_7d", 4)),
    "days_to_spike": lambda s, d: ft.days_to_spike(_flags(s, d)).select(KEY, DAY, "days_to_spike", "target_class"),
    "shock_dates": lambda s, d: ft.shocks(layers.daily(s, d)).withColumn("move", r("move", 4)),
    "live_price_change": lambda s, d: ft.live_change(layers.daily(s, d)),
    "min_history": lambda s, d: ft.history_gate(layers.daily(s, d), 2460),
    "feature_matrix_7d": _matrix("7d"),
    "feature_matrix_14d": _matrix("14d"),
    "feature_matrix_magnitude": _matrix("magnitude"),
    "feature_matrix_timing": _matrix("timing"),
    "ts_folds": _folds,
    "class_weights": lambda s, d: ft.class_weights(ft.feature_matrix(layers.model_input(s, d), "timing"))
    .withColumn("weight", r("weight", 4)),
    "spike_stats": lambda s, d: ft.spike_stats(ft.feature_matrix(layers.model_input(s, d), "magnitude")),
    "magnitude_empirical": lambda s, d: ft.move_quantiles(ft.feature_matrix(layers.model_input(s, d), "magnitude")),
    "naive_backtest": lambda s, d: evaluate.naive_backtest(layers.daily(s, d)),
    "evaluation_summary": lambda s, d: evaluate.evaluation_summary(evaluate.naive_backtest(layers.daily(s, d))),
}

# --- the same in SQL ----------------------------------------------------------------------
_ORDER = "PARTITION BY komoditas ORDER BY date_parsed"


def _lag(n):
    return f"lag(avg_price, {n}) OVER (w0)"


def _frame(n):
    return f"OVER ({_ORDER} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def _ma(n, c="cents", unit=100):
    return f"CASE WHEN count({c}) {_frame(n)} = {n} THEN CAST(sum({c}) {_frame(n)} AS DOUBLE) / {n * unit}.0 END"


def _std(n):
    f = _frame(n)
    gap = f"(count(cents) {f} * sum(cents * cents) {f} - sum(cents) {f} * sum(cents) {f})"
    return f"CASE WHEN count(cents) {f} = {n} THEN sqrt(CAST({gap} AS DOUBLE) / {n * (n - 1)}.0) / 100.0 END"


def _pct(n):
    return pct("avg_price", f"lag(avg_price, {n}) OVER (w0)")


def _lead_sql(n):
    return f"lead(avg_price, {n}) OVER (w0)"


_lags_sql = {f"price_lag_{n}d": _lag(n) for n in (1, 3, 7, 14, 30)}
_roll_sql = {f"price_ma_{n}d": _ma(n) for n in (7, 14, 30)} | {f"price_std_{n}d": _std(n) for n in (7, 14, 30)}
_pct_sql = {f"price_pct_{n}d": _pct(n) for n in (3, 7, 14, 30)}
_targets_sql = {
    "target_price_7d": _lead_sql(7), "target_price_14d": _lead_sql(14),
    "target_change_rpkg": f"{_lead_sql(7)} - avg_price", "target_change_pct": pct(_lead_sql(7), "avg_price"),
}
_cal_sql = {
    "trend_idx": "CAST(row_number() OVER (w0) - 1 AS DOUBLE)",
    "day_of_week": "CAST(isodow(date_parsed) - 1 AS DOUBLE)",
    "month": "CAST(month(date_parsed) AS DOUBLE)",
    "is_ramadan_season": "CASE WHEN month(date_parsed) IN (3, 4) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END",
    "is_yearend": "CASE WHEN month(date_parsed) IN (12, 1) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END",
}
_rain7, _temp7 = _ma(7, "rain", 10), _ma(7, "temp", 10)
_roll7_sql = {"precip_roll7": _rain7, "temp_roll7": _temp7}
_cv_sql = f"coalesce(({_std(14)}) / ({_ma(14)}) * 100, 0.0)"

view("model_input", """
SELECT daily.*, CAST(round(avg_price * 100) AS BIGINT) AS cents,
       coalesce(precipitation_sum, 0.0) AS precipitation_sum, coalesce(temperature_max, 0.0) AS temperature_max,
       CAST(round(coalesce(precipitation_sum, 0.0) * 10) AS BIGINT) AS rain,
       CAST(round(coalesce(temperature_max, 0.0) * 10) AS BIGINT) AS temp,
       coalesce(news_score, 0.0) AS news_score, coalesce(news_velocity, 0.0) AS news_velocity
FROM daily LEFT JOIN daily_weather USING (date_parsed) LEFT JOIN news_velocity USING (date_parsed)""",
     "daily", "daily_weather", "news_velocity")


def _select(columns: dict, source="series", digits=4):
    cols = ", ".join(f"{rnd(e, digits)} AS {n}" for n, e in columns.items())
    return sql(f"SELECT komoditas, date_parsed, {cols} FROM {source} WINDOW w0 AS ({_ORDER})", source)


view("moves", f"""
SELECT *, {_pct(7)} AS p7, {_pct(3)} AS p3, abs(avg_price - {_lag(1)}) / {_lag(1)} AS move
FROM series WINDOW w0 AS ({_ORDER})""", "series")
view("flagged", """
SELECT *, coalesce(abs(p7) > 5, false) AS is_spike, coalesce(p7 >= 10, false) AS is_rise FROM moves""", "moves")
view("next_spike", """
SELECT *, CASE WHEN days_to_spike <= 7 THEN 0 WHEN days_to_spike <= 14 THEN 1
               WHEN days_to_spike <= 30 THEN 2 ELSE 3 END AS target_class
FROM (SELECT *, CAST(coalesce(min(CASE WHEN is_spike THEN date_parsed END) OVER (
        PARTITION BY komoditas ORDER BY date_parsed ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)
        - date_parsed, 999) AS INT) AS days_to_spike FROM flagged)""", "flagged")

_f7 = {k: v for k, v in (_lags_sql | _roll_sql | _pct_sql | _roll7_sql).items() if k in FEATURES_7D}
_f14 = _f7 | {k: v for k, v in _cal_sql.items() if k in FEATURES_14D}
_fmag = {k: v for k, v in (_lags_sql | _roll_sql | _pct_sql | _cal_sql).items() if k in FEATURES_MAGNITUDE} | {
    "coeff_var_14d": _cv_sql,
    "precip_roll7": f"coalesce({_rain7}, 0.0)", "temp_roll7": f"coalesce({_temp7}, 30.0)",
}
_ftime = {k: v for k, v in (_roll_sql | _cal_sql).items() if k in FEATURES_TIMING} | {
    f"price_momentum_{n}d": _pct(n) for n in (3, 7, 14)
} | {
    "precip_roll7": f"coalesce({_rain7}, 0.0)", "temp_roll7": f"coalesce({_temp7}, 30.0)",
    "precip_anomaly": f"coalesce(precipitation_sum - coalesce({_rain7}, 0.0), 0.0)",
}


def _matrix_view(name, features, extra, target, joined=""):
    cols = ", ".join(f"{e} AS {n}" for n, e in (features | extra).items())
    known = " AND ".join(f"{c} IS NOT NULL" for c in [*features, target])
    view(name, f"""
SELECT * FROM (SELECT komoditas, date_parsed, avg_price, news_score, news_velocity, {cols}
               FROM model_input WINDOW w0 AS ({_ORDER})) {joined} WHERE {known}""",
         "model_input", *(["next_spike"] if joined else []))


_matrix_view("matrix_7d", _f7, {"target_price_7d": _lead_sql(7)}, "target_price_7d")
_matrix_view("matrix_14d", _f14, {"target_price_14d": _lead_sql(14)}, "target_price_14d")
_matrix_view("matrix_magnitude", _fmag,
             {k: v for k, v in _targets_sql.items() if "change" in k}, "target_change_rpkg")
_matrix_view("matrix_timing", _ftime, {}, "target_class",
             "JOIN (SELECT komoditas, date_parsed, target_class FROM next_spike) USING (komoditas, date_parsed)")


def _matrix_sql(kind, columns, target, extra=()):
    cols = ", ".join(f"{rnd(f'CAST({c} AS DOUBLE)', 4)} AS {c}" for c in [PRICE, *columns, *extra])
    last = target if target == "target_class" else f"{rnd(target, 4)} AS {target}"
    return sql(f"SELECT komoditas, date_parsed, {cols}, {last} FROM matrix_{kind}", f"matrix_{kind}")


def _quantile(c, q):
    return rnd(f"quantile_cont({c}, {q})", 2)


SQL = {
    "feat_lags": _select(_lags_sql),
    "feat_rolling": _select(_roll_sql),
    "feat_pct_change": _select(_pct_sql),
    "feat_weather_roll": _select(
        _roll7_sql | {"precip_roll7_filled": f"coalesce({_rain7}, 0.0)", "temp_roll7_filled": f"coalesce({_temp7}, 30.0)"},
        "model_input"),
    "precip_anomaly": _select({"precip_anomaly": f"precipitation_sum - coalesce({_rain7}, 0.0)"}, "model_input"),
    "volatility_cv": _select({"coeff_var_14d": _cv_sql}),
    "targets_forward": _select(_targets_sql),
    "feat_calendar": _select(_cal_sql),
    "spike_flags": sql(
        f"SELECT komoditas, date_parsed, avg_price, {rnd('p7', 4)} AS price_pct_7d, is_spike, is_rise FROM flagged",
        "flagged"),
    "days_to_spike": sql("SELECT komoditas, date_parsed, days_to_spike, target_class FROM next_spike", "next_spike"),
    "shock_dates": sql(
        f"SELECT komoditas, date_parsed, {rnd('move', 4)} AS move FROM moves WHERE move > 0.15", "moves"),
    "live_price_change": sql(f"""
        SELECT komoditas, price,
          CASE WHEN coalesce(other, before) > 0 THEN
            {rnd('(price - coalesce(other, before)) / coalesce(other, before) * 100')} END AS change_1d,
          CASE WHEN back > 0 THEN {rnd('(price - back) / back * 100')} END AS change_7d
        FROM (SELECT komoditas, max(now) AS price,
                max_by(avg_price, date_parsed) FILTER (avg_price > 0 AND avg_price <> now) AS other,
                max(avg_price) FILTER (rn = 2) AS before,
                CASE WHEN count(*) >= 7 THEN max(avg_price) FILTER (rn = 7) ELSE min_by(avg_price, date_parsed) END
                    AS back
              FROM (SELECT *, row_number() OVER (PARTITION BY komoditas ORDER BY date_parsed DESC) AS rn,
                      first_value(avg_price) OVER (PARTITION BY komoditas ORDER BY date_parsed DESC) AS now
                    FROM daily) GROUP BY 1)""", "daily"),
    "min_history": sql(
        "SELECT komoditas, count(*) AS n_rows, count(*) >= 2460 AS enough FROM daily GROUP BY 1", "daily"),
    "feature_matrix_7d": _matrix_sql("7d", FEATURES_7D, "target_price_7d"),
    "feature_matrix_14d": _matrix_sql("14d", FEATURES_14D, "target_price_14d"),
    "feature_matrix_magnitude": _matrix_sql(
        "magnitude", FEATURES_MAGNITUDE, "target_change_rpkg", ["target_change_pct"]),
    "feature_matrix_timing": _matrix_sql("timing", FEATURES_TIMING, "target_class"),
    "ts_folds": sql("""
        SELECT komoditas, date_parsed, CAST(fold AS INT) AS fold,
               CASE WHEN i < n - (3 - fold) * t THEN 'train' ELSE 'test' END AS role
        FROM (SELECT *, row_number() OVER (PARTITION BY komoditas ORDER BY date_parsed) - 1 AS i,
                     count(*) OVER (PARTITION BY komoditas) AS n,
                     count(*) OVER (PARTITION BY komoditas) // 4 AS t FROM daily),
             (SELECT unnest([0, 1, 2]) AS fold)
        WHERE i < n - (2 - fold) * t""", "daily"),
    "class_weights": sql(f"""
        SELECT komoditas, target_class, n_class,
          {rnd('CAST(sum(n_class) OVER (PARTITION BY komoditas) AS DOUBLE) / (count(*) OVER (PARTITION BY komoditas) * n_class)', 4)} AS weight
        FROM (SELECT komoditas, target_class, count(*) AS n_class FROM matrix_timing GROUP BY 1, 2)""",
                         "matrix_timing"),
    "spike_stats": sql(f"""
        SELECT komoditas, count_if(abs(target_change_pct) > 5)::BIGINT AS n_spikes,
          {rnd('count_if(abs(target_change_pct) > 5)::DOUBLE / count(*)', 3)} AS spike_probability,
          {rnd('max(abs(target_change_pct))', 1)} AS max_spike_pct
        FROM matrix_magnitude GROUP BY 1""", "matrix_magnitude"),
    "magnitude_empirical": sql(
        "SELECT komoditas, " + ", ".join(
            f"{_quantile(c, q)} AS {s}_{n}"
            for c, s in (("target_change_rpkg", "rpkg"), ("target_change_pct", "pct"))
            for q, n in ((0.1, "p10"), (0.5, "p50"), (0.9, "p90"))
        ) + " FROM matrix_magnitude GROUP BY 1", "matrix_magnitude"),
}

view("backtest", f"""
SELECT komoditas, count(*) AS n_samples,
  {rnd("(CAST(sum(CAST(floor(ape * 100000000.0::DOUBLE + 0.5) AS BIGINT)) AS DOUBLE) / 100000000.0::DOUBLE) / count(ape) * 100")}
      AS baseline_mape,
  {rnd('sqrt(CAST(sum(err * err) AS DOUBLE) / count(*)) / 100', 0)} AS baseline_rmse,
  {rnd('count_if(hit)::DOUBLE / count(hit) * 100', 1)} AS baseline_da
FROM (SELECT *, CASE WHEN avg_price <> 0 THEN abs((avg_price - hat) / avg_price) END AS ape, cents - hat_cents AS err,
             CASE WHEN i > 8 THEN sign(avg_price - prev) = sign(hat - prev) END AS hit
      FROM (SELECT *, lag(avg_price, 7) OVER (w0) AS hat, lag(cents, 7) OVER (w0) AS hat_cents,
                   lag(avg_price, 1) OVER (w0) AS prev, row_number() OVER (w0) AS i
            FROM series WINDOW w0 AS ({_ORDER})) WHERE i > 7) GROUP BY 1""", "series")
SQL |= {
    "naive_backtest": sql("SELECT * FROM backtest", "backtest"),
    "evaluation_summary": sql(
        "SELECT (floor(CAST(sum(CAST(baseline_mape AS DECIMAL(18,2))) AS DOUBLE) / count(*) * 100 + 0.5) / 100)"
        " AS avg_baseline_mape, count(*) AS komoditas_count FROM backtest", "backtest"),
}
