"""The layers over native data, one function per layer.

Each reads the tables of the layer before and writes its own below ``lake``, so a step can be
repeated alone and a lost executor costs at most one layer.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tanisight import dims, schemas
from tanisight.functions.numeric import exact_avg, rnd
from tanisight.operators import alerts, clean, dedup, evaluate, features, gold, models, news, reports, risk, views
from tanisight.session import materialize
from tanisight.sources import daytable, jsonl, snapshots, tables
from tanisight.streaming import ingest

PRICE_FEEDS = ["price_bapanas", "price_pihps", "price_siskaperbapo"]
# Order of records with equal keys: by time of arrival, then by value
TIES = {
    "weather": ["fetched_at_utc", "ingestion_ts"],
    "news": ["fetched_at_utc", "ingestion_ts", "title"],
    "kurs": ["fetched_at_utc", "ingestion_ts", "kurs_tengah"],
    "price": ["fetched_at_utc", "ingestion_ts", "price_idr_per_kg", "price"],
}

RISK_DAILY = "komoditas string, date_parsed date, risk_index double"
SIGNALS = (
    "article_id string, source string, title string, komoditas_matched array<string>, "
    "gangguan_signals map<string,int>, sentra_matched array<string>, signal_score int, sentiment string"
)
ARTICLES = "article_id string, version long"
LAST_PRICES = "komoditas string, price_idr_per_kg double, run date"
# Rates of USD/IDR outside are errors of a source
RATE_RANGE = (10_000.0, 25_000.0)
FORECAST = (
    "komoditas string, current_price double, forecast_7d double, predicted_change_pct double, "
    "model_mape double, rmse_avg double"
)


def _table(spark: SparkSession, lake: str, layer: str, name: str, ddl: str) -> DataFrame:
    return tables.read_table(spark, f"{lake}/{layer}/{name}", schemas.schema(spark, ddl))


def run_bronze(spark: SparkSession, landing: Mapping[str, Sequence[str]], lake: str) -> None:
    """Raw JSON lines to bronze. ``landing`` gives the folders of each stream, the preferred copy
    last. Lines that do not parse go to the quarantine."""
    for stream, folders in landing.items():
        ddl = (schemas.STREAMS | schemas.BATCHES)[stream]
        scans = [jsonl.scan(spark, folder, schemas.schema(spark, ddl)) for folder in folders]
        records = [rows for rows, _ in scans]
        if stream in schemas.STREAMS:
            key = _merge_key(stream)
            rows = dedup.merge_copies(records, key, TIES[key])
        else:
            rows = clean.union_sources(records)
        tables.write_table(
            tables.stamp(tables.bronze(rows, stream)), f"{lake}/bronze/{stream}", "overwrite",
            source=clean.union_sources(records),
        )
        tables.write_table(
            clean.union_sources([bad for _, bad in scans]), f"{lake}/quarantine/{stream}", "overwrite"
        )


def _merge_key(stream: str) -> str:
    return stream if stream in dedup.STREAM_KEYS else "price"


def run_bronze_stream(
    spark: SparkSession, lines: DataFrame, lake: str, stream: str, trigger: dict = ingest.EVERY_10S
) -> StreamingQuery:
    """Streamed JSON lines (``value``) into bronze: each batch is merged by business key into the days it touches.
    Silver reads these records together with those of ``run_bronze``."""
    decoded = ingest.decode(lines, schemas.schema(spark, schemas.STREAMS[stream]))
    key = _merge_key(stream)
    return ingest.merge_to(decoded, f"{lake}/bronze_stream/{stream}", key, TIES[key], trigger)


def _bronze(spark: SparkSession, lake: str, name: str) -> DataFrame:
    """Bronze records of a stream: landed ones and, if its stream runs, streamed ones, one per business key."""
    ddl = (schemas.STREAMS | schemas.BATCHES)[name]
    landed = _table(spark, lake, "bronze", name, ddl)
    folder = f"{lake}/bronze_stream/{name}"
    if name not in schemas.STREAMS or not daytable.newest(spark, f"{folder}/data"):
        return landed
    wanted = schemas.schema(spark, ddl)
    streamed = ingest.read_merged(spark, folder, wanted).drop("date")
    key = _merge_key(name)
    return dedup.merge_copies([landed.select(*wanted.names).unionByName(streamed)], key, TIES[key])


def _feed_prices(spark: SparkSession, raw: DataFrame, commodities: Sequence[str]) -> DataFrame:
    """Silver prices of one feed; older feeds call the columns commodity and price. The first that is positive counts."""
    rows = raw.withColumns(
        {
            "komoditas": F.coalesce("komoditas", "commodity"),
            "price_idr_per_kg": clean.first_positive(["price_idr_per_kg", "price"]),
            "data_source": F.coalesce("data_source", "source"),
        }
    )
    grades = dims.pair_table(spark, dims.GRADES, "name", "canonical")
    return clean.silver_prices(clean.map_exact(rows, "komoditas", grades), commodities, TIES["price"])


def run_silver(
    spark: SparkSession, lake: str, commodities: Sequence[str] = tuple(dims.LABELS)
) -> None:
    """Bronze to clean, typed, de-duplicated silver tables."""

    def raw(name: str) -> DataFrame:
        return _bronze(spark, lake, name)

    def write(df: DataFrame, name: str, *streams: str) -> None:
        source = clean.union_sources([raw(s).select("source") for s in streams])
        tables.write_table(df, f"{lake}/silver/{name}", "overwrite", source)

    feeds = [_feed_prices(spark, raw(feed), commodities) for feed in PRICE_FEEDS]
    write(clean.union_sources(feeds), "silver_prices", *PRICE_FEEDS)
    rates, odd = clean.usable_rates(raw("kurs"), *RATE_RANGE)
    write(clean.silver_kurs(rates, TIES["kurs"]), "silver_kurs", "kurs")
    tables.write_table(odd, f"{lake}/quarantine/kurs_range", "overwrite")
    write(clean.silver_news(raw("news"), TIES["news"]), "silver_news", "news")
    write(clean.silver_weather(raw("weather"), TIES["weather"]), "silver_weather", "weather")
    grades = dims.pair_table(spark, dims.GRADES, "name", "canonical")
    macro = []
    for batch, measures in schemas.MEASURES.items():
        rows = raw(batch)
        named = clean.map_exact(rows, "komoditas", grades) if "komoditas" in rows.columns else rows
        macro.append(clean.macro_by_period(named, measures, schemas.AVERAGED))
    write(clean.union_sources(macro), "silver_macro", *schemas.MEASURES)


def run_gold(spark: SparkSession, lake: str, as_of: str) -> DataFrame:
    """Silver to the feature store, saved as a new version of the gold table and exported."""

    def silver(name: str, ddl: str) -> DataFrame:
        return _table(spark, lake, "silver", name, ddl)

    prices = silver("silver_prices", "source string, komoditas string, price_idr_per_kg double, date_parsed date")
    macro = silver("silver_macro", "komoditas string, indicator string, date_parsed date, value double")
    kurs = silver("silver_kurs", "source string, date_parsed date, kurs_tengah double")
    weather = silver("silver_weather", schemas.WEATHER + ", date_parsed date")
    articles = silver("silver_news", schemas.NEWS + ", date_parsed date")
    store = gold.feature_store(
        gold.daily_prices(prices), macro, [m for ms in schemas.MEASURES.values() for m in ms], kurs, weather, articles
    )
    path = f"{lake}/gold/feature_store"
    snapshots.save_version(tables.stamp(store, "_gold_created_at"), path, as_of, "OVERWRITE")
    saved = snapshots.read_version(spark, path)
    jsonl.export_json(saved, f"{lake}/export/feature_store")
    jsonl.export_json(tables.price_history(saved), f"{lake}/export/price_history")
    return saved


def _signals(spark: SparkSession, lake: str) -> DataFrame:
    """Signals of the silver articles, by day. Only articles that came, changed or went since the last call are
    looked at again, and only their days are written; the log of articles done is written last."""
    articles = _table(spark, lake, "silver", "silver_news", schemas.NEWS + ", date_parsed date")
    path, log = f"{lake}/export/nlp_signals", f"{lake}/state/articles"
    rows, done = schemas.schema(spark, SIGNALS), schemas.schema(spark, ARTICLES)
    now = articles.select("article_id", F.xxhash64(*TIES["news"]).alias("version"), F.col("date_parsed").alias("date"))
    seen = daytable.read(spark, log, done)
    same = (
        F.col("n.article_id").eqNullSafe(F.col("s.article_id")) & (F.col("n.version") == F.col("s.version"))
        & F.col("n.date").eqNullSafe(F.col("s.date"))
    )
    came = now.alias("n").join(seen.alias("s"), same, "left_anti").withColumn("there", F.lit(True))
    went = seen.alias("s").join(now.alias("n"), same, "left_anti").withColumn("there", F.lit(False))
    changed = materialize(came.unionByName(went))
    days = [r[0] for r in changed.select("date").distinct().collect()]
    if days:
        batch = daytable.next_batch(spark, log)
        ids = changed.select("article_id").distinct().alias("c")

        def of_changed(table: DataFrame, keys: DataFrame, how: str) -> DataFrame:
            return table.alias("t").join(keys, F.col("t.article_id").eqNullSafe(F.col("c.article_id")), how)

        fresh = of_changed(articles, changed.filter("there").select("article_id").alias("c"), "left_semi")
        found = news.extract_signals(fresh, dims.NEWS)
        daytable.replace(
            spark, path, batch, days, rows, lambda old: of_changed(old, ids, "left_anti").unionByName(found.select(*old.columns))
        )
        of_day = changed.select("date").distinct().alias("d")
        on_day = F.col("n.date").eqNullSafe(F.col("d.date"))
        daytable.replace(spark, log, batch, days, done, lambda old: now.alias("n").join(of_day, on_day, "left_semi"))
        daytable.compact(spark, path)
        daytable.compact(spark, log)
    return daytable.read(spark, path, rows)


def run_news(spark: SparkSession, lake: str, as_of: str) -> tuple[DataFrame, DataFrame]:
    """(signals, velocity per commodity) from the silver articles."""
    signals = _signals(spark, lake)
    return signals, news.keyword_velocity(signals, dims.commodity_table(spark), as_of)


def run_risk(spark: SparkSession, lake: str, as_of: str) -> DataFrame:
    """Risk index per commodity from the feature store, bronze weather and news velocity. It is also
    kept by day, as the series that lead times are taken from."""
    dim = dims.commodity_table(spark)
    store = snapshots.read_version(spark, f"{lake}/gold/feature_store")
    weather = _bronze(spark, lake, "weather")
    latest = risk.latest_per_region(weather, "ingestion_ts", "fetched_at_utc")
    _, velocity = run_news(spark, lake, as_of)
    index = risk.risk_index(
        risk.price_signal(store, dim),
        risk.weather_signal(latest, dims.region_table(spark), dim),
        risk.news_signal(velocity, dim),
    )
    index.write.mode("overwrite").parquet(f"{lake}/export/risk_index")
    done = spark.read.parquet(f"{lake}/export/risk_index").select("komoditas", F.lit(as_of[:10]).cast("date").alias("date_parsed"), "risk_index")
    done.write.mode("overwrite").parquet(f"{lake}/export/risk_daily/run={as_of[:10]}")
    return spark.read.parquet(f"{lake}/export/risk_index")


def run_risk_history(spark: SparkSession, lake: str) -> DataFrame:
    """Risk index of every commodity and day of the feature store, as known on that day. Lead times are
    taken from it and from the days that ``run_risk`` was run for."""
    store = snapshots.read_version(spark, f"{lake}/gold/feature_store").select("komoditas", "date_parsed", "avg_price")
    weather = _bronze(spark, lake, "weather")
    index = risk.daily_risk_index(
        store, weather.withColumn("date_parsed", clean.record_date(weather)), dims.region_table(spark),
        news.mentions_daily(_signals(spark, lake)),
    )
    index.write.mode("overwrite").parquet(f"{lake}/export/risk_history")
    return spark.read.parquet(f"{lake}/export/risk_history")


def run_forecast(spark: SparkSession, lake: str, trees: int = 200) -> DataFrame:
    """Forecast table of all commodities with enough history."""
    store = snapshots.read_version(spark, f"{lake}/gold/feature_store")
    models.forecast_table(store, trees).write.mode("overwrite").parquet(f"{lake}/export/price_forecast")
    return spark.read.parquet(f"{lake}/export/price_forecast")


def run_magnitude(spark: SparkSession, lake: str, trees: int = 150) -> DataFrame:
    """Quantiles of the price move per commodity."""
    store = snapshots.read_version(spark, f"{lake}/gold/feature_store")
    models.magnitude(store, trees).write.mode("overwrite").parquet(f"{lake}/export/magnitude")
    return spark.read.parquet(f"{lake}/export/magnitude")


def run_timing(spark: SparkSession, lake: str, trees: int = 200) -> DataFrame:
    """Window of the next spike per commodity."""
    store = snapshots.read_version(spark, f"{lake}/gold/feature_store")
    models.timing(store, trees).write.mode("overwrite").parquet(f"{lake}/export/timing")
    return spark.read.parquet(f"{lake}/export/timing")


def run_importance(spark: SparkSession, lake: str, trees: int = 200) -> DataFrame:
    """Features of the seven-row forecast by gain, ranked per commodity."""
    store = snapshots.read_version(spark, f"{lake}/gold/feature_store")
    _, gains = models.forecast(store, "7d", trees)
    models.ranked_importance(gains).write.mode("overwrite").parquet(f"{lake}/export/feature_importance")
    return spark.read.parquet(f"{lake}/export/feature_importance")


def _export(spark: SparkSession, lake: str, name: str, ddl: str) -> DataFrame:
    """An exported table with the columns of the DDL; empty while its step has not run."""
    wanted = schemas.schema(spark, ddl)
    return tables.read_table(spark, f"{lake}/export/{name}", wanted).select(*wanted.names)


def _forecasts(spark: SparkSession, lake: str, more: str = "") -> DataFrame:
    return _export(spark, lake, "price_forecast", FORECAST + more)


def _top_features(spark: SparkSession, lake: str, k: int = 3) -> DataFrame:
    """The first ``k`` features of each commodity as one array in rank order."""
    ranked = _export(spark, lake, "feature_importance", "komoditas string, feature string, rank int").filter(F.col("rank") <= k)
    ordered = F.array_sort(F.collect_list(F.struct("rank", "feature")))
    return ranked.groupBy("komoditas").agg(ordered["feature"].alias("top_features"))


def run_prediction_view(
    spark: SparkSession, lake: str, commodities: Sequence[str] = tuple(dims.LABELS), real_feed: str = "price_pihps"
) -> DataFrame:
    """Prediction page of all commodities: the fitted forecast put on the newest price of ``real_feed``, size
    and window of the next move, triggers. Parts whose step has not run are null."""
    bronze = _bronze(spark, lake, real_feed)
    live = clean.latest_positive(
        _feed_prices(spark, bronze, commodities).filter(F.col("date_parsed").isNotNull()), ["komoditas"], ["date_parsed"],
        "price_idr_per_kg",
    ).withColumnRenamed("price_idr_per_kg", "price")
    store = snapshots.read_version(spark, f"{lake}/gold/feature_store")
    spikes = features.spike_stats(features.feature_matrix(store, "magnitude")).select("komoditas", "spike_probability")
    size = _export(spark, lake, "magnitude", "komoditas string, rpkg_p10 double, rpkg_p90 double").join(spikes, "komoditas", "full")
    view = views.prediction_view(
        dims.commodity_table(spark),
        views.capped_forecast(_forecasts(spark, lake, ", forecast_14d double"), live),
        _export(spark, lake, "risk_index", "komoditas string, level string"),
        size, _export(spark, lake, "timing", "komoditas string, predicted_window string"), _top_features(spark, lake),
    )
    view.write.mode("overwrite").parquet(f"{lake}/export/prediction_view")
    return spark.read.parquet(f"{lake}/export/prediction_view")


def run_evaluation_view(spark: SparkSession, lake: str) -> DataFrame:
    """Evaluation page: baseline and model error, current risk index and the features that count most."""
    store = snapshots.read_version(spark, f"{lake}/gold/feature_store")
    errors = _forecasts(spark, lake).select("komoditas", F.col("model_mape").alias("mape_avg"))
    view = evaluate.evaluation_view(
        dims.commodity_table(spark), evaluate.naive_backtest(store), errors,
        _export(spark, lake, "risk_index", "komoditas string, risk_index double"), _top_features(spark, lake),
    )
    view.write.mode("overwrite").parquet(f"{lake}/export/evaluation_view")
    return spark.read.parquet(f"{lake}/export/evaluation_view")


def run_evaluation(spark: SparkSession, lake: str) -> DataFrame:
    """Error of the forecast next to the baseline's (without a forecast, the baseline alone), and the lead
    time of the risk indexes kept by ``run_risk_history`` and ``run_risk``."""
    store = snapshots.read_version(spark, f"{lake}/gold/feature_store")
    errors = _forecasts(spark, lake).select("komoditas", F.col("model_mape").alias("mape_avg"), "rmse_avg")
    report = evaluate.model_vs_baseline(errors, evaluate.naive_backtest(store))
    kept = schemas.schema(spark, RISK_DAILY)
    indexes = clean.union_sources(
        [tables.read_table(spark, f"{lake}/export/{name}", kept).select(*kept.names) for name in ("risk_history", "risk_daily")]
    )
    leads = evaluate.lead_times(*evaluate.spike_and_alert_days(store, indexes))
    report = report.join(evaluate.lead_time_stats(leads, report), "komoditas")
    report.write.mode("overwrite").parquet(f"{lake}/export/evaluation")
    return spark.read.parquet(f"{lake}/export/evaluation")


def run_report(spark: SparkSession, lake: str, as_of: str) -> DataFrame:
    """The situation report as one text, from the risk index, the forecast and news velocity."""
    order = spark.createDataFrame([(k, i) for i, k in enumerate(dims.LABELS)], "komoditas string, position int")
    _, velocity = run_news(spark, lake, as_of)
    lines = reports.report_lines(
        spark.read.parquet(f"{lake}/export/risk_index"), _forecasts(spark, lake), velocity,
        dims.commodity_table(spark).join(order, "komoditas"), as_of,
    )
    reports.report_text(lines).write.mode("overwrite").parquet(f"{lake}/export/report")
    return spark.read.parquet(f"{lake}/export/report")


def run_alerts(
    spark: SparkSession, lake: str, as_of: str, settings: dims.AlertSettings = dims.AlertSettings()
) -> DataFrame:
    """Alerts of this run; those within the cooldown of the last one sent are marked suppressed.
    Sent alerts go to the alert log, one folder per run. It is the state of later runs: a run reads
    the alerts sent before it only, so it can be repeated."""
    signals, _ = run_news(spark, lake, as_of[:10])
    risk_index = spark.read.parquet(f"{lake}/export/risk_index")
    forecast = _forecasts(spark, lake)
    phrases = news.phrase_lists(news.top_phrases(signals, as_of[:10]))
    due = alerts.due_alerts(dims.commodity_table(spark), risk_index, forecast, phrases, settings)
    now = F.lit(as_of).cast("timestamp")
    records = alerts.alert_records(due, now).withColumn("ts", now)
    log = f"{lake}/export/alerts"
    sent = tables.read_table(spark, log, schemas.schema(spark, "komoditas string, ts timestamp"))
    seed = sent.filter(F.col("ts") < now).groupBy("komoditas").agg(F.max("ts").alias("ts"))
    checked = alerts.cooldown(records, settings.cooldown_hours, "id", seed)
    run = f"run={as_of.replace(' ', 'T').replace(':', '')}"
    path = f"{lake}/export/alert_runs/{run}"
    checked.write.mode("overwrite").parquet(path)
    result = spark.read.parquet(path)
    result.filter(~F.col("suppressed")).write.mode("overwrite").parquet(f"{log}/{run}")
    return result


def run_reference_prices(
    spark: SparkSession, lake: str, as_of: str, primary: str = "price_pihps", secondary: str = "price_bapanas",
    commodities: Sequence[str] = tuple(dims.LABELS),
) -> DataFrame:
    """Price of every commodity on a day with its origin: the primary feed, else the secondary, else the last price
    that a run before this day saw. A run can be repeated."""
    day = F.lit(as_of[:10]).cast("date")

    def feed(name: str) -> DataFrame:
        rows = _feed_prices(spark, _bronze(spark, lake, name), commodities).filter(F.col("date_parsed") == day)
        priced = rows.filter(F.col("price_idr_per_kg") > 0)
        return priced.groupBy("komoditas", "date_parsed").agg(rnd(exact_avg("price_idr_per_kg"), 2).alias("price_idr_per_kg"))

    keys = ("komoditas", "date_parsed", "price_idr_per_kg")
    spine = dims.commodity_table(spark).select("komoditas", day.alias("date_parsed"))
    state = tables.read_table(spark, f"{lake}/state/last_prices", schemas.schema(spark, LAST_PRICES))
    last = state.filter(F.col("run") < day).groupBy("komoditas").agg(F.max_by("price_idr_per_kg", "run").alias("price_idr_per_kg"))
    path = f"{lake}/export/reference_prices/run={as_of[:10]}"
    clean.source_precedence(spine, feed(primary), feed(secondary), *keys, last).write.mode("overwrite").parquet(path)
    filled = spark.read.parquet(path)
    clean.last_values(filled, *keys).write.mode("overwrite").parquet(f"{lake}/state/last_prices/run={as_of[:10]}")
    return filled


def run_recommendations(spark: SparkSession, lake: str) -> DataFrame:
    """Recommendation texts per audience."""
    levels = spark.read.parquet(f"{lake}/export/risk_index")
    return reports.recommendations(risk.high_risk(levels), dims.commodity_table(spark))
