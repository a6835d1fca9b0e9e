"""Risk, alerts, views and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tanisight.dims import AlertSettings, RiskSettings
from tanisight.functions.numeric import clamp, rnd as r
from tanisight.operators import alerts, evaluate, features as ft, gold, reports, risk, views
from tanisight.plans import layers, standins
from tanisight.plans.layers import AS_OF
from tanisight.plans.registry import features as _features  # noqa: F401  (defines SQL views used here)
from tanisight.plans.registry import news as _news  # noqa: F401
from tanisight.plans.standins import TYPES
from tanisight.session import materialize
from tanisight.plans.views_sql import clamp as clamp_sql, esum, pct, rnd, sql, view

KEY, DAY = "komoditas", "date_parsed"


# The given tables are calm, so some queries use lower marks than the defaults.
LOW_ALERTS = AlertSettings(risk_warning=35.0, risk_high=45.0, risk_critical=55.0)
LOW_LEVELS = RiskSettings(levels={"KRITIS": 70.0, "SIAGA": 50.0, "WASPADA": 30.0})
FAST_AT = 1.0


def _price_signal(spark, sf):
    return risk.price_signal(layers.daily(spark, sf), layers.commodities(spark))


def _weather_signal(spark, sf):
    return risk.weather_signal(
        layers.latest_weather(spark, sf), standins.regions(spark, sf), layers.commodities(spark)
    )


def _news_signal(spark, sf):
    return risk.news_signal(layers.velocity(spark, sf), layers.commodities(spark))


def _weighted(spark, sf):
    parts = standins.table(spark, sf, "lineitem")
    mean = risk.weighted_mean(F.col("l_quantity"), F.col("l_discount"))
    return parts.groupBy("l_returnflag").agg(r(mean, 4).alias("weighted_quantity"))


def _clamped(spark, sf):
    d = layers.daily(spark, sf).withColumn("p7", ft.change(7))
    return d.select(KEY, DAY, r(clamp("p7", -10, 10), 4).alias("clamped"))


def _alert_rows(spark, sf):
    rows = layers.daily_risk(spark, sf)
    return rows.withColumn("level", alerts.alert_level(F.col("risk_index"), F.col("p14")))


def _due(spark, sf):
    prices = layers.series(spark, sf)
    return alerts.due_alerts(
        layers.commodities(spark), layers.risk_index(spark, sf, prices), layers.forecast(prices),
        layers.top_phrases(spark, sf), LOW_ALERTS,
    )


def _messages(spark, sf):
    records = alerts.alert_records(_due(spark, sf), F.lit(f"{AS_OF} 06:00:00").cast("timestamp"))
    return records.select("id", KEY, "label", "level", "risk_index", "message", "date_label")


def _daily_alerts(spark, sf):
    rows = _alert_rows(spark, sf).filter(F.col("level").isNotNull())
    stamped = rows.select(KEY, "level", F.col(DAY).cast("timestamp").alias("ts"))
    return alerts.cooldown(stamped, hours=72, tie="level")


def _cooldown(spark, sf):
    return alerts.cooldown(standins.alerts(spark, sf)).select("event_id", KEY, "suppressed")


def _escalation(spark, sf):
    return alerts.escalations(layers.daily_risk(spark, sf))


def _capped(spark, sf, prices=None):
    prices = layers.series(spark, sf) if prices is None else prices
    return views.capped_forecast(layers.forecast(prices), layers.real_prices(spark, sf))


def _current(spark, sf):
    prices = layers.series(spark, sf)
    return views.current_prices(_capped(spark, sf, prices), prices)


def _fused(spark, sf):
    rows = _alert_rows(spark, sf).withColumn("alert", F.col("level"))
    chg = r(clamp("p3", -10, 10), 2)
    return rows.select(
        KEY, DAY, views.fused_level(risk.risk_level(F.col("risk_index")), F.col("alert"), chg).alias("level")
    )


def _prediction(spark, sf):
    prices = layers.series(spark, sf)
    matrix = materialize(ft.feature_matrix(prices, "magnitude").select(KEY, "target_change_rpkg", "target_change_pct"))
    magnitude = ft.move_quantiles(matrix).join(ft.spike_stats(matrix), KEY).select(
        KEY, "rpkg_p10", "rpkg_p90", "spike_probability"
    )
    return views.prediction_view(
        layers.commodities(spark), _capped(spark, sf, prices), layers.risk_index(spark, sf, prices), magnitude
    )


def _directions(spark, sf):
    d = layers.moves(spark, sf)
    return views.direction_counts(d.select(clamp("p3", -10, 10).alias("change_pct")))


def _report(spark, sf):
    prices = layers.series(spark, sf)
    speed = materialize(layers.velocity(spark, sf))
    return reports.report_lines(
        layers.risk_index(spark, sf, prices, speed), layers.forecast(prices), speed, layers.commodities(spark), AS_OF,
        FAST_AT,
    )


def _ranked(spark, sf):
    levels = layers.risk_index(spark, sf)
    return risk.high_risk(levels.withColumn("level", risk.risk_level(F.col("risk_index"), LOW_LEVELS)))


def _lead(spark, sf):
    prices = layers.series(spark, sf)
    return evaluate.lead_times(*evaluate.spike_and_alert_days(prices, layers.daily_risk(spark, sf, prices)))


def _model(prices):
    """Model errors of the views: those of a forecast over 14 rows."""
    naive = evaluate.naive_backtest(prices, horizon=14)
    return naive.select(KEY, F.col("baseline_mape").alias("mape_avg"), F.col("baseline_rmse").alias("rmse_avg"))


def _commodity_view(spark, sf):
    prices = layers.series(spark, sf)
    return views.commodity_view(
        layers.commodities(spark).select(KEY, "label"), _capped(spark, sf, prices),
        layers.risk_index(spark, sf, prices), _model(prices).select(KEY, "mape_avg"),
    )


def _evaluation_view(spark, sf):
    prices = layers.series(spark, sf)
    baseline = materialize(evaluate.naive_backtest(prices))
    model = materialize(_model(prices))
    wins = evaluate.model_vs_baseline(model, baseline).select(
        KEY, "improvement_vs_baseline_mape", "model_wins"
    )
    return evaluate.evaluation_view(
        layers.commodities(spark).select(KEY, "label"), baseline, model,
        layers.risk_index(spark, sf, prices), wins,
    )


def _status(spark, sf):
    names = ["orders", "events", "documents"]
    found = None
    for n in names:
        rows = standins.table(spark, sf, n).limit(1).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("name"), "n_rows")
        found = rows if found is None else found.unionByName(rows)
    return views.export_status(found, [*names, "recommendations"])


def _fx_store(spark, sf):
    return gold.feature_store(layers.daily(spark, sf), fx=layers.silver_kurs(spark, sf))


QUERIES = {
    "price_signal": _price_signal,
    "latest_per_region": lambda s, d: layers.latest_weather(s, d).select("sentra", "event_id", "current.*"),
    "weather_signal": _weather_signal,
    "news_signal": _news_signal,
    "weighted_mean": _weighted,
    "clamp": _clamped,
    "risk_index": layers.risk_index,
    "risk_level": lambda s, d: layers.daily_risk(s, d).select(KEY, DAY, "risk_index", "level"),
    "level_counts": lambda s, d: risk.level_counts(layers.daily_risk(s, d)),
    "high_risk": _ranked,
    "alert_level": lambda s, d: _alert_rows(s, d).select(KEY, DAY, "level"),
    "alert_message": _messages,
    "alert_cooldown": _cooldown,
    "alert_summary": lambda s, d: alerts.alert_summary(_daily_alerts(s, d)),
    "alert_suppressed": lambda s, d: alerts.suppressed_list(_daily_alerts(s, d)),
    "alert_escalation": _escalation,
    "forecast_timeline": lambda s, d: views.forecast_timeline(layers.forecast(layers.series(s, d)), AS_OF),
    "capped_forecast": lambda s, d: _capped(s, d).select(KEY, "price", "change_pct", "capped_7d"),
    "current_prices": _current,
    "fused_level": _fused,
    "direction_counts": _directions,
    "prediction_view": _prediction,
    "commodity_view": _commodity_view,
    "evaluation_view": _evaluation_view,
    "sentra_risk_map": lambda s, d: views.region_risk(
        standins.regions(s, d), layers.risk_index(s, d)),
    "daily_risk_index": lambda s, d: layers.daily_risk(s, d).select(
        KEY, DAY, "price_signal", "weather_signal", "news_signal", "risk_index", "level"),
    "asof_lead_time": _lead,
    "lead_time_stats": lambda s, d: evaluate.lead_time_stats(_lead(s, d), layers.commodities(s)),
    "last_n_rows": lambda s, d: views.last_rows(layers.daily(s, d), 200),
    "history_30": lambda s, d: views.history(layers.daily(s, d)),
    "fx_history_60": lambda s, d: views.fx_history(_fx_store(s, d)),
    "fx_latest": lambda s, d: views.fx_latest(_fx_store(s, d)),
    "situation_report": _report,
    "recommendations": lambda s, d: reports.recommendations(_ranked(s, d), layers.commodities(s)),
    "export_status": _status,
}

# --- the same in SQL ----------------------------------------------------------------------
_KOM = f"(SELECT unnest([{', '.join(chr(39) + t + chr(39) for t in TYPES)}]) AS komoditas)"
view("dim", f"""
SELECT komoditas, upper(substr(komoditas, 1, 1)) || lower(substr(komoditas, 2)) AS label,
       CAST(list_position([{', '.join(chr(39) + t + chr(39) for t in TYPES)}], komoditas) - 1 AS INT) AS position
FROM {_KOM}""")
_mom = "CASE WHEN week IS NOT NULL THEN (now - week) / week * 100 ELSE 0.0 END"
_z = "CASE WHEN gap > 0 THEN (n * CAST(now_cents AS DOUBLE) - total) / sqrt(gap) ELSE 0.0 END"
view("price_signal", f"""
SELECT dim.komoditas, coalesce({rnd(f"0.6 * {clamp_sql('((m + 20) / 40 * 100)', 0, 100)} + 0.4 * {clamp_sql('((z + 2) / 4 * 100)', 0, 100)}")}, 50.0) AS price_signal
FROM dim LEFT JOIN (SELECT komoditas, {_mom} AS m, {_z} AS z FROM (
  SELECT komoditas, max(avg_price) FILTER (rn = 1) AS now, max(cents) FILTER (rn = 1) AS now_cents,
         max(avg_price) FILTER (rn = 7) AS week, count(*) AS n, CAST(sum(cents) AS DOUBLE) AS total,
         CAST(count(*) * sum(cents * cents) - sum(cents) * sum(cents) AS DOUBLE) AS gap
  FROM (SELECT *, row_number() OVER (PARTITION BY komoditas ORDER BY date_parsed DESC) AS rn FROM series
        WHERE avg_price <> 0) WHERE rn <= 30 GROUP BY 1)) USING (komoditas)""", "dim", "series")
view("latest_wx", """
SELECT * FROM s_wx QUALIFY row_number() OVER (PARTITION BY sentra ORDER BY seen_at DESC, event_id) = 1""", "s_wx")
_wx_score = """least(CASE WHEN coalesce(precipitation, 0) > 50 THEN 50.0 ELSE 0.0 END
         + CASE WHEN weather_code >= 80 THEN 40.0 WHEN weather_code >= 60 THEN 20.0 ELSE 0.0 END
         + CASE WHEN temperature_2m >= 35 THEN 15.0 WHEN temperature_2m <= 15 THEN 10.0 ELSE 0.0 END, 100.0)::DOUBLE"""
view("weather_signal", f"""
SELECT dim.komoditas, coalesce(v, 0.0) AS weather_signal FROM dim LEFT JOIN (
  SELECT komoditas, {rnd(esum('score * bobot', 4) + ' / ' + esum('bobot', 4))} AS v
  FROM s_sentra JOIN (SELECT sentra, {_wx_score} AS score FROM latest_wx) ON nama = sentra GROUP BY 1) USING (komoditas)""",
     "dim", "s_sentra", "latest_wx")
view("news_signal", f"""
SELECT komoditas, {rnd("0.6::DOUBLE * least(100.0, velocity / 3 * 100) + 0.4::DOUBLE * least(100.0, avg_score / 15 * 100)")}
       AS news_signal FROM velocity""", "velocity")


def _level(x, s=RiskSettings()):
    return "CASE " + " ".join(f"WHEN {x} >= {v} THEN '{n}'" for n, v in s.levels.items()) + f" ELSE '{s.lowest}' END"


view("risk", f"""
SELECT *, {_level('risk_index')} AS level FROM (
  SELECT *, {rnd('0.5::DOUBLE * price_signal + 0.25::DOUBLE * weather_signal + 0.25::DOUBLE * news_signal')} AS risk_index
  FROM price_signal JOIN weather_signal USING (komoditas) JOIN news_signal USING (komoditas))""",
     "price_signal", "weather_signal", "news_signal")


def _chg(n):
    return pct("avg_price", f"lag(avg_price, {n}) OVER (w0)")


# Signals as of each day: frames for prices, as-of joins for weather, a range join for news
view("price_daily", f"""
SELECT *, {rnd(f"0.6 * {clamp_sql('((m + 20) / 40 * 100)', 0, 100)} + 0.4 * {clamp_sql('((z + 2) / 4 * 100)', 0, 100)}")} AS price_signal
FROM (SELECT *, {_mom} AS m, {_z} AS z FROM (
  SELECT komoditas, date_parsed, avg_price AS now, cents AS now_cents, lag(avg_price, 6) OVER w0 AS week,
         count(*) OVER f AS n, CAST(sum(cents) OVER f AS DOUBLE) AS total,
         CAST((count(*) OVER f) * (sum(cents * cents) OVER f) - (sum(cents) OVER f) * (sum(cents) OVER f) AS DOUBLE) AS gap,
         {_chg(3)} AS p3, {_chg(7)} AS p7, {_chg(14)} AS p14
  FROM series WINDOW w0 AS (PARTITION BY komoditas ORDER BY date_parsed),
    f AS (PARTITION BY komoditas ORDER BY date_parsed ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)))""", "series")
view("wx_day", f"""
SELECT sentra, date_parsed, {_wx_score} AS score FROM s_wx
QUALIFY row_number() OVER (PARTITION BY sentra, date_parsed ORDER BY seen_at DESC, event_id) = 1""", "s_wx")
view("weather_daily", f"""
SELECT x.komoditas, x.date_parsed, {rnd(esum('score * bobot', 4) + ' / ' + esum('bobot', 4))} AS weather_signal
FROM (SELECT d.komoditas, d.date_parsed, nama, bobot FROM daily d JOIN s_sentra s ON s.komoditas = d.komoditas) x
ASOF JOIN wx_day w ON x.nama = w.sentra AND x.date_parsed >= w.date_parsed GROUP BY 1, 2""", "daily", "s_sentra", "wx_day")
view("news_daily", f"""
SELECT komoditas, date_parsed,
       {rnd("0.6::DOUBLE * least(100.0, velocity / 3 * 100) + 0.4::DOUBLE * least(100.0, avg_score / 15 * 100)")} AS news_signal
FROM (SELECT komoditas, date_parsed, avg_score,
             CASE WHEN a > 0 THEN {rnd('coalesce(today, 0) / a')} ELSE 0.0 END AS velocity
  FROM (SELECT komoditas, date_parsed, CAST(sum(n_articles) FILTER (date = date_parsed) AS BIGINT) AS today,
          CAST(sum(n_articles) FILTER (rn <= 7) AS DOUBLE) / count(*) FILTER (rn <= 7) AS a,
          {rnd('CAST(sum(total_score) AS DOUBLE) / sum(n_articles)')} AS avg_score
    FROM (SELECT d.komoditas, d.date_parsed, m.date, n_articles, total_score,
                 row_number() OVER (PARTITION BY d.komoditas, d.date_parsed ORDER BY m.date DESC) AS rn
          FROM daily d JOIN mentions m ON m.komoditas = d.komoditas
               AND m.date BETWEEN d.date_parsed - 14 AND d.date_parsed) GROUP BY 1, 2))""", "daily", "mentions")
view("daily_risk", f"""
SELECT *, {_level('risk_index')} AS level FROM (
  SELECT *, {rnd('0.5::DOUBLE * price_signal + 0.25::DOUBLE * weather_signal + 0.25::DOUBLE * news_signal')} AS risk_index
  FROM (SELECT p.komoditas, p.date_parsed, p3, p7, p14, price_signal, coalesce(weather_signal, 0.0) AS weather_signal,
               coalesce(news_signal, 0.0) AS news_signal
        FROM price_daily p LEFT JOIN weather_daily USING (komoditas, date_parsed)
             LEFT JOIN news_daily USING (komoditas, date_parsed)))""", "price_daily", "weather_daily", "news_daily")
view("leads", """
SELECT m.komoditas, m.date_parsed AS spike_date, a.date_parsed AS alert_date,
       CAST(m.date_parsed - a.date_parsed AS INT) AS lead_days
FROM (SELECT * FROM moves WHERE p7 >= 10) m ASOF JOIN (SELECT * FROM daily_risk WHERE risk_index >= 60) a
     ON a.komoditas = m.komoditas AND m.date_parsed > a.date_parsed
WHERE m.date_parsed - a.date_parsed <= 30""", "moves", "daily_risk")


def _alert(ri, ch, s=AlertSettings()):
    base = (f"CASE WHEN {ri} >= {s.risk_critical} THEN 'KRITIS' WHEN {ri} >= {s.risk_high} THEN 'SIAGA' "
            f"WHEN {ri} >= {s.risk_warning} THEN 'WASPADA' END")
    return (f"CASE WHEN {ch} >= 20 THEN 'KRITIS' WHEN {ch} >= 10 AND ({base}) IS NULL THEN 'WASPADA' ELSE {base} END")


view("alert_rows", f"""
SELECT komoditas, date_parsed, p3, risk_index, level AS risk_level, {_alert('risk_index', 'p14')} AS level
FROM daily_risk""", "daily_risk")
view("forecast", f"""
SELECT komoditas, current_price, forecast_7d, forecast_14d,
       {rnd('(forecast_7d - current_price) / current_price * 100')} AS predicted_change_pct,
       {rnd('(forecast_14d - current_price) / current_price * 100')} AS predicted_change_pct_14d,
       forecast_7d - baseline_rmse AS confidence_lower, forecast_7d + baseline_rmse AS confidence_upper,
       baseline_mape AS model_mape
FROM (SELECT komoditas, {rnd('max(avg_price) FILTER (rn = 1)', 0)} AS current_price,
        {rnd("CAST(sum(CAST(avg_price AS DECIMAL(18,2))) FILTER (rn <= 7) AS DOUBLE) / count(*) FILTER (rn <= 7)", 0)} AS forecast_7d,
        {rnd("CAST(sum(CAST(avg_price AS DECIMAL(18,2))) AS DOUBLE) / count(*)", 0)} AS forecast_14d
      FROM (SELECT *, row_number() OVER (PARTITION BY komoditas ORDER BY date_parsed DESC) AS rn FROM daily)
      WHERE rn <= 14 GROUP BY 1) JOIN backtest USING (komoditas)""", "daily", "backtest")
view("real_price", """
SELECT komoditas, price_idr_per_kg AS price FROM silver_prices WHERE source = 'ASIA'
QUALIFY row_number() OVER (PARTITION BY komoditas ORDER BY date_parsed DESC) = 1""", "silver_prices")
view("capped", f"""
SELECT *, CASE WHEN price <> 0 THEN {rnd('price * (1 + change_pct / 100)', 0)} ELSE forecast_7d END AS capped_7d
FROM (SELECT forecast.*, coalesce(CASE WHEN price > 0 THEN price END, current_price) AS price,
             {rnd(clamp_sql('coalesce(predicted_change_pct, 0.0)', -10, 10))} AS change_pct
      FROM forecast LEFT JOIN real_price USING (komoditas))""", "forecast", "real_price")


def _cool(source, gap, tie):
    """Sent alerts by following the chain of next alerts at least ``gap`` later."""
    return f"""
WITH RECURSIVE t AS (SELECT komoditas, ts, min({tie}) AS first_id FROM ({source}) GROUP BY 1, 2),
nxt AS (SELECT *, min(ts) OVER (PARTITION BY komoditas ORDER BY ts
        RANGE BETWEEN INTERVAL {gap} HOUR FOLLOWING AND UNBOUNDED FOLLOWING) AS later FROM t),
sent AS (SELECT komoditas, min(ts) AS ts FROM t GROUP BY 1
         UNION ALL SELECT s.komoditas, n.later FROM sent s JOIN nxt n ON n.komoditas = s.komoditas AND n.ts = s.ts
         WHERE n.later IS NOT NULL)
SELECT x.*, (t.first_id IS NULL) AS suppressed FROM ({source}) x
LEFT JOIN (SELECT t.* FROM t JOIN sent USING (komoditas, ts)) t
  ON t.komoditas = x.komoditas AND t.ts = x.ts AND t.first_id = x.{tie}"""


view("cooled", _cool(
    "SELECT event_id, 'K' || (user_id % 10) AS komoditas, ts FROM events WHERE event_type = 'error'", 12, "event_id"))
view("cooled_daily", _cool(
    "SELECT komoditas, level, CAST(date_parsed AS TIMESTAMP) AS ts FROM alert_rows WHERE level IS NOT NULL", 72, "level"),
     "alert_rows")
_rupiah = "'Rp' || format('{{:,}}', CAST({} AS BIGINT))"


def _rp(x):
    return _rupiah.format(rnd(x, 0))


view("phrase_lists", "SELECT komoditas, list(phrase ORDER BY rank) AS top_signals FROM phrases GROUP BY 1", "phrases")
view("due", f"""
SELECT * FROM (SELECT *, {_alert('risk_index', 'change', LOW_ALERTS)} AS level FROM (
  SELECT dim.komoditas, label, risk_index, current_price, forecast_7d,
         predicted_change_pct AS change, top_signals
  FROM dim LEFT JOIN risk USING (komoditas) LEFT JOIN forecast USING (komoditas)
       LEFT JOIN phrase_lists USING (komoditas))) WHERE level IS NOT NULL""", "dim", "risk", "forecast", "phrase_lists")
view("ranked", f"""
SELECT komoditas, {_level('risk_index', LOW_LEVELS)} AS level, risk_index,
       CAST(row_number() OVER (ORDER BY risk_index DESC, komoditas) AS INT) AS rank
FROM risk WHERE risk_index >= {LOW_LEVELS.levels['WASPADA']}""", "risk")
view("model", """SELECT komoditas, baseline_mape AS mape_avg FROM backtest14""", "backtest14")
view("backtest14", f"""
SELECT komoditas,
  {rnd("(CAST(sum(CAST(floor(ape * 100000000.0::DOUBLE + 0.5) AS BIGINT)) AS DOUBLE) / 100000000.0::DOUBLE) / count(ape) * 100")}
      AS baseline_mape
FROM (SELECT *, CASE WHEN avg_price <> 0 THEN abs((avg_price - hat) / avg_price) END AS ape
      FROM (SELECT *, lag(avg_price, 14) OVER w0 AS hat, row_number() OVER w0 AS i FROM series
            WINDOW w0 AS (PARTITION BY komoditas ORDER BY date_parsed)) WHERE i > 14) GROUP BY 1""", "series")

_msg = f"""'[' || level || '] ' || label || ' — Indeks Risiko: ' || printf('%.1f', {rnd('risk_index', 1)}) || '/100'"""
_report_date = "strftime(DATE '" + AS_OF + "', '%d %B %Y')"

SQL = {
    "price_signal": sql("SELECT * FROM price_signal", "price_signal"),
    "latest_per_region": sql(
        "SELECT sentra, event_id, precipitation, weather_code, temperature_2m FROM latest_wx", "latest_wx"),
    "weather_signal": sql("SELECT * FROM weather_signal", "weather_signal"),
    "news_signal": sql("SELECT * FROM news_signal", "news_signal"),
    "weighted_mean": f"""SELECT l_returnflag, {rnd(esum('l_quantity * l_discount', 4) + ' / ' + esum('l_discount', 4), 4)}
        AS weighted_quantity FROM lineitem GROUP BY 1""",
    "clamp": sql(f"SELECT komoditas, date_parsed, {rnd(clamp_sql('p7', -10, 10), 4)} AS clamped FROM moves", "moves"),
    "risk_index": sql("SELECT * FROM risk", "risk"),
    "risk_level": sql("SELECT komoditas, date_parsed, risk_index, level FROM daily_risk", "daily_risk"),
    "level_counts": sql(
        "SELECT count(*) AS total, " + ", ".join(
            f"CAST(count_if(level = '{n}') AS BIGINT) AS {n.lower()}" for n in ("KRITIS", "SIAGA", "WASPADA", "AMAN")
        ) + " FROM daily_risk", "daily_risk"),
    "high_risk": sql("SELECT * FROM ranked", "ranked"),
    "alert_level": sql("SELECT komoditas, date_parsed, level FROM alert_rows", "alert_rows"),
    "alert_message": sql(f"""
        SELECT komoditas || '_' || strftime(DATE '{AS_OF}', '%Y%m%d') || '060000' AS id, komoditas, label, level, risk_index,
          concat_ws(' | ', {_msg},
            'Perubahan harga 7 hari: ' || printf('%+.1f', {rnd('change', 1)}) || '% (' ||
              CASE WHEN change > 0 THEN 'naik' ELSE 'turun' END || ')',
            'Proyeksi H+7: ' || {_rp('current_price')} || ' → ' || {_rp('forecast_7d')},
            CASE WHEN len(top_signals) > 0 THEN 'Sinyal dominan: ' || array_to_string(top_signals[1:3], ', ') END,
            'Rekomendasi: ' || CASE level
              WHEN 'KRITIS' THEN 'Segera lakukan koordinasi operasi pasar dan cek stok Bulog.'
              WHEN 'SIAGA' THEN 'Persiapkan cadangan distribusi dan pantau harga pasar harian.'
              ELSE 'Tingkatkan monitoring dan siapkan rencana intervensi.' END) AS message,
          {_report_date} AS date_label FROM due""", "due"),
    "alert_cooldown": sql("SELECT event_id, komoditas, suppressed FROM cooled", "cooled"),
    "alert_summary": sql(
        "SELECT CAST(count_if(NOT suppressed) AS BIGINT) AS total_alerts, "
        "CAST(count_if(suppressed) AS BIGINT) AS total_suppressed, " + ", ".join(
            f"CAST(count_if(NOT suppressed AND level = '{n}') AS BIGINT) AS {n.lower()}"
            for n in ("KRITIS", "SIAGA", "WASPADA")) + " FROM cooled_daily", "cooled_daily"),
    "alert_suppressed": sql(
        "SELECT komoditas, count(*) AS n_suppressed FROM cooled_daily WHERE suppressed GROUP BY 1", "cooled_daily"),
    "alert_escalation": sql("""
        SELECT komoditas, min(date_parsed) AS first_day, max(date_parsed) AS last_day, count(*) AS n_runs
        FROM (SELECT *, i - row_number() OVER (PARTITION BY komoditas ORDER BY date_parsed) AS island
              FROM (SELECT *, row_number() OVER (PARTITION BY komoditas ORDER BY date_parsed) AS i FROM daily_risk)
              WHERE level IN ('SIAGA', 'KRITIS')) GROUP BY komoditas, island HAVING count(*) >= 3""", "daily_risk"),
    "forecast_timeline": sql(f"""
        SELECT komoditas, DATE '{AS_OF}' + CAST(i AS INT) AS date, 'H+' || i AS day_label,
          {rnd('CASE WHEN i <= 7 THEN current_price + (forecast_7d - current_price) * (i / 7.0::DOUBLE) '
               'ELSE forecast_7d + (forecast_14d - forecast_7d) * ((i - 7) / 7.0::DOUBLE) END', 0)} AS predicted_price
        FROM forecast, (SELECT unnest(range(1, 15)) AS i)""", "forecast"),
    "capped_forecast": sql("SELECT komoditas, price, change_pct, capped_7d FROM capped", "capped"),
    "current_prices": sql("""
        SELECT komoditas, price, capped_7d AS forecast_7d, change_pct FROM capped
        UNION ALL SELECT komoditas, max_by(avg_price, date_parsed), NULL, NULL FROM daily
        WHERE komoditas NOT IN (SELECT komoditas FROM capped) GROUP BY 1""", "capped", "daily"),
    "fused_level": sql(f"""
        SELECT komoditas, date_parsed, CASE WHEN c > 7 THEN 'KRITIS' WHEN c > 5 THEN 'SIAGA' WHEN c > 3 THEN 'WASPADA'
          WHEN c <= 0 THEN 'AMAN'
          WHEN coalesce(list_position(o, level), 0) > list_position(o, risk_level) THEN level ELSE risk_level END AS level
        FROM (SELECT *, ['AMAN', 'WASPADA', 'SIAGA', 'KRITIS'] AS o, {rnd(clamp_sql('p3', -10, 10))} AS c FROM alert_rows)""",
        "alert_rows"),
    "direction_counts": sql("""
        SELECT CAST(count_if(p3 > 1) AS BIGINT) AS naik, CAST(count_if(p3 < -1) AS BIGINT) AS turun,
               CAST(count_if(coalesce(p3 BETWEEN -1 AND 1, true)) AS BIGINT) AS stabil FROM moves""", "moves"),
    "prediction_view": sql(f"""
        SELECT komoditas, price, capped_7d, change_pct,
          CASE WHEN forecast_14d <> current_price THEN
            {rnd('forecast_14d + (forecast_14d - current_price) / 7 * 7', 0)} END AS forecast_price_14d,
          CASE WHEN model_mape <> 0 THEN {rnd('100 - least(model_mape, 50.0)', 1)} END AS confidence,
          CASE WHEN level IN ('KRITIS', 'SIAGA') THEN 'Risk Level: ' || level ELSE '' END AS triggers,
          rpkg_p10, rpkg_p90, spike_probability, {rnd('coalesce(spike_probability, 0.0) * 100', 0)} AS magnitude_confidence
        FROM dim JOIN capped USING (komoditas) JOIN risk USING (komoditas) LEFT JOIN (
          SELECT komoditas, {rnd('quantile_cont(target_change_rpkg, 0.1)')} AS rpkg_p10,
            {rnd('quantile_cont(target_change_rpkg, 0.9)')} AS rpkg_p90,
            {rnd('count_if(abs(target_change_pct) > 5)::DOUBLE / count(*)', 3)} AS spike_probability
          FROM matrix_magnitude GROUP BY 1) USING (komoditas)""".replace("SELECT komoditas, price", "SELECT dim.komoditas, price"),
        "dim", "capped", "risk", "matrix_magnitude"),
    "commodity_view": sql("""
        SELECT dim.komoditas, label, price, forecast_7d, predicted_change_pct, risk_index, level, mape_avg
        FROM dim LEFT JOIN capped USING (komoditas) LEFT JOIN risk USING (komoditas) LEFT JOIN model USING (komoditas)""",
        "dim", "capped", "risk", "backtest14", "model"),
    "evaluation_view": sql(f"""
        SELECT dim.komoditas, label, n_samples, baseline_mape, baseline_da, mape_avg AS model_mape,
          risk_index AS current_risk_index, {rnd('baseline_mape - mape_avg')} AS improvement_vs_baseline_mape,
          mape_avg < baseline_mape AS model_wins
        FROM dim JOIN backtest USING (komoditas) JOIN model USING (komoditas) JOIN risk USING (komoditas)""",
        "dim", "backtest", "backtest14", "model", "risk"),
    "sentra_risk_map": sql("""
        SELECT s.*, coalesce(risk_index, 0.0) AS risk_index, coalesce(level, 'AMAN') AS risk_level
        FROM s_sentra s LEFT JOIN risk USING (komoditas)""",
        "s_sentra", "risk"),
    "daily_risk_index": sql("""
        SELECT komoditas, date_parsed, price_signal, weather_signal, news_signal, risk_index, level FROM daily_risk""",
        "daily_risk"),
    "asof_lead_time": sql("SELECT * FROM leads", "leads"),
    "lead_time_stats": sql(f"""
        SELECT dim.komoditas, {rnd('CAST(sum(lead_days) AS DOUBLE) / count(lead_days)', 1)} AS avg_lead_days,
          min(lead_days) AS min_lead_days, max(lead_days) AS max_lead_days, count(lead_days) AS events
        FROM dim LEFT JOIN leads USING (komoditas) GROUP BY 1""", "dim", "leads"),
    "last_n_rows": sql("SELECT * FROM daily ORDER BY date_parsed DESC, komoditas LIMIT 200", "daily"),
    "history_30": sql("""
        SELECT * FROM (SELECT komoditas, date_parsed, avg_price,
          CAST(row_number() OVER (PARTITION BY komoditas ORDER BY date_parsed DESC) AS INT) AS age FROM daily)
        WHERE age <= 30""", "daily"),
    "fx_history_60": sql(f"""
        SELECT date_parsed, {rnd('kurs_usd_idr')} AS rate FROM spine WHERE kurs_usd_idr <> 0
        ORDER BY date_parsed DESC LIMIT 60""", "spine"),
    "fx_latest": sql(f"""
        SELECT {rnd('max_by(kurs_usd_idr, date_parsed)')} AS rate, max(date_parsed) AS date
        FROM spine WHERE kurs_usd_idr <> 0""", "spine"),
    "situation_report": sql(f"""
        SELECT 0 AS section, 1 AS position, '{reports.TITLE}' AS line
        UNION ALL SELECT 0, 2, 'Tanggal analisis: ' || {_report_date}
        UNION ALL SELECT 0, 3, '' UNION ALL SELECT 1, 0, '{reports.RISK_HEADING}'
        UNION ALL SELECT 3, 0, '' UNION ALL SELECT 4, 0, '{reports.FORECAST_HEADING}'
        UNION ALL SELECT 2, position, '• ' || label || ': ' || printf('%.1f', {rnd('risk_index', 1)}) || '/100 [' || level ||
          '] (harga=' || printf('%.1f', {rnd('price_signal', 1)}) || ', cuaca=' || printf('%.1f', {rnd('weather_signal', 1)}) ||
          ', berita=' || printf('%.1f', {rnd('news_signal', 1)}) || ')' FROM dim JOIN risk USING (komoditas)
        UNION ALL SELECT 5, position, '• ' || label || ': ' || {_rp('current_price')} || ' ' ||
          CASE WHEN predicted_change_pct > 0 THEN '↑' WHEN predicted_change_pct < 0 THEN '↓' ELSE '→' END || ' ' ||
          {_rp('forecast_7d')} || ' (' || printf('%+.1f', {rnd('predicted_change_pct', 1)}) || '%)'
          FROM dim JOIN forecast USING (komoditas)
        UNION ALL SELECT 6, p, l FROM (SELECT unnest([0, 1]) AS p, unnest(['', '{reports.NEWS_HEADING.format(f"{FAST_AT:g}")}']) AS l)
          WHERE EXISTS (SELECT 1 FROM velocity WHERE velocity >= {FAST_AT})
        UNION ALL SELECT 7, position, '• ' || label || ': velocity=' || printf('%.1f', {rnd('velocity', 1)}) ||
          'x rata-rata 7 hari' FROM dim JOIN velocity USING (komoditas) WHERE velocity >= {FAST_AT}""",
        "dim", "risk", "forecast", "velocity"),
    "recommendations": sql("""
        SELECT audience, CASE WHEN urgent IS NULL AND watch IS NULL THEN calm ELSE
          concat_ws(chr(10), head, replace(urgent_text, '{}', urgent), replace(watch_text, '{}', watch), closing) END AS text
        FROM (SELECT string_agg(label, ', ' ORDER BY rank) FILTER (level IN ('KRITIS', 'SIAGA')) AS urgent,
                     string_agg(label, ', ' ORDER BY rank) FILTER (level = 'WASPADA') AS watch
              FROM ranked JOIN dim USING (komoditas)),
             (VALUES """ + ", ".join(
        "(" + ", ".join("'" + x + "'" for x in (
            a, reports.CALM[a], reports.HEAD[a], reports.URGENT[a], reports.WATCH[a], reports.CLOSING[a])) + ")"
        for a in ("government", "umkm")) + ") AS t(audience, calm, head, urgent_text, watch_text, closing)",
        "ranked", "dim"),
    "export_status": """
        WITH p AS (SELECT 'orders' AS name, count(*) > 0 AS present FROM orders
          UNION ALL SELECT 'events', count(*) > 0 FROM events UNION ALL SELECT 'documents', count(*) > 0 FROM documents
          UNION ALL SELECT 'recommendations', false)
        SELECT * FROM p UNION ALL SELECT 'all_ready', bool_and(present) FROM p""",
}
