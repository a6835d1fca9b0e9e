"""Raw JSON lines through all layers, with native records."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from tanisight.plans import lakehouse
from tanisight.sources import snapshots
from tests.conftest import rows

END = dt.date(2026, 6, 23)
DAYS = [END - dt.timedelta(days=59 - i) for i in range(60)]


def write(root, stream, records, extra=""):
    for day in {r["fetched_at_utc"][:10] for r in records}:
        folder = root / stream / day
        folder.mkdir(parents=True, exist_ok=True)
        mine = [json.dumps(r) for r in records if r["fetched_at_utc"][:10] == day]
        (folder / "batch_1.jsonl").write_text("\n".join(mine) + "\n\n" + extra)
    return str(root / stream)


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("landing")
    out = str(tmp_path_factory.mktemp("lake"))
    rng = random.Random(2)

    def ts(day):
        return {"fetched_at_utc": f"{day}T06:00:00+00:00", "ingestion_ts": f"{day}T06:00:00+00:00"}

    landing = {}
    for feed in lakehouse.PRICE_FEEDS:
        records = []
        for k, base in (("beras", 13000), ("cabai_keriting", 50000)):
            for i, day in enumerate(DAYS):
                price = base + 100 * i + rng.randint(-200, 200)
                name = ("commodity", "price") if feed == "price_pihps" else ("komoditas", "price_idr_per_kg")
                records.append({"source": feed, name[0]: k, name[1]: price, **ts(day)})
        records.append({"source": feed, "komoditas": "jagung", "price_idr_per_kg": 1, **ts(END)})
        landing[feed] = [write(root, feed, records, extra='{"rusak\n')]
    landing["weather"] = [write(root, "weather", [
        {"source": "w", "sentra": s, "current": {"precipitation": 80.0 if s == "karawang" else 0.0, "weather_code": 80, "temperature_2m": 30.0},
         "daily": {"precipitation_sum": 12.0, "temperature_2m_max": 31.0}, **ts(d)} for s in ("karawang", "brebes") for d in DAYS[-10:]])]
    landing["kurs"] = [write(root, "kurs", [
        {"source": "bi", "pair": "USD/IDR", "kurs_tengah": 16000.0 + i, **ts(d)} for i, d in enumerate(DAYS[::3])] + [
        {"source": "er", "pair": "USD/IDR", "kurs_jual": 17000.0, **ts(DAYS[1])},
        {"source": "er", "pair": "USD/IDR", "kurs_tengah": 1.0, **ts(DAYS[2])}])]
    landing["news"] = [write(root, "news", [
        {"source": "n", "article_id": f"x{i}", "title": "Harga beras naik", "summary": "gagal panen di karawang", "relevance_score": 9, **ts(d)}
        for i, d in enumerate(DAYS[-5:])])]
    landing["batch_produksi"] = [write(root, "batch_produksi", [
        {"source": "bps", "komoditas": "beras", "tahun": 2026, "bulan": 5, "produksi_ton": 5.0, "luas_panen_ha": 2.0, **ts(DAYS[5])}])]
    odd = {"source": "odd", "komoditas": "gula_pasir", "ingestion_ts": f"{DAYS[0]}T01:00:00+07:00"}
    folder = root / "odd"
    folder.mkdir()
    (folder / "batch_2.jsonl").write_text("\n".join(json.dumps(r) for r in (
        odd | {"price_idr_per_kg": "13500"}, odd | {"source": "none", "price_idr_per_kg": "n/a", "unit": ["kg"]})))
    landing["price_pihps"].append(str(folder))
    live = {"source": "live", "sentra": "live", "lat": "-6.3", "komoditas": "beras", **ts(END),
            "current": {"time": "x", "precipitation": 1, "relative_humidity_2m": 81.0, "weather_code": "3"},
            "daily": {"time": ["2026-06-23", "2026-06-24"], "precipitation_sum": [12.0, 40.0], "temperature_2m_max": [31, 33]}}
    landing["weather"].append(write(root, "live", [live, live | {"sentra": "mute", "current": "n/a", "daily": None}]))
    lakehouse.run_bronze(spark, landing, out)
    lakehouse.run_silver(spark, out)
    lakehouse.run_gold(spark, out, f"{END} 07:00:00")
    return out


def test_bronze_and_silver(spark, lake):
    bronze = spark.read.parquet(f"{lake}/bronze/price_pihps")
    assert rows(bronze.select("_source_layer", "_stream_name").distinct()) == [("bronze", "price_pihps")]
    assert spark.read.parquet(f"{lake}/quarantine/price_pihps").count() == len(DAYS)
    silver = spark.read.parquet(f"{lake}/silver/silver_prices")
    assert silver.filter("komoditas <> 'gula_pasir'").count() == 3 * 2 * len(DAYS)
    assert "jagung" not in {r[0] for r in silver.select("komoditas").distinct().collect()}


def test_odd_fields_stay(spark, lake):
    silver = spark.read.parquet(f"{lake}/silver/silver_prices").filter("komoditas = 'gula_pasir'")
    assert rows(silver, "source", "price_idr_per_kg", "date_parsed") in (
        [("odd", 13500.0, DAYS[0])], [("none", None, DAYS[0])])  # copies are merged by commodity and day
    weather = {r["sentra"]: r for r in spark.read.parquet(f"{lake}/silver/silver_weather").filter(f"date_parsed = '{END}'").collect()}
    live = weather["live"]
    assert (live["lat"], live["komoditas"], live["current"]["relative_humidity_2m"], live["current"]["weather_code"]) == (-6.3, ["beras"], 81, 3)
    assert (live["daily"]["precipitation_sum"], live["daily"]["temperature_2m_max"]) == ([12.0, 40.0], [31.0, 33.0])
    assert weather["mute"]["current"]["precipitation"] is None and weather["mute"]["daily"] is None
    assert weather["brebes"]["daily"]["precipitation_sum"] == [12.0]


def test_gold(spark, lake):
    store = snapshots.read_version(spark, f"{lake}/gold/feature_store").filter("komoditas <> 'gula_pasir'")
    assert store.count() == 2 * len(DAYS)
    assert rows(store.select("n_sources").distinct()) == [(3,)]
    assert store.filter(F.col("kurs_usd_idr").isNull()).count() == 0
    grown = store.filter(F.col("produksi_ton") == 5.0)  # of May 2026, and of rice only
    assert rows(grown, "komoditas", "date_parsed") == sorted((("beras", d) for d in DAYS if d >= dt.date(2026, 5, 1)), key=repr)
    assert rows(spark.read.parquet(f"{lake}/quarantine/kurs_range"), "kurs_tengah") == [(1.0,)]
    assert rows(spark.read.parquet(f"{lake}/silver/silver_kurs").filter("kurs_jual is not null"), "kurs_tengah", "kurs_beli") == [
        (round(17000 * 0.9985, 2), round(17000 * 0.997, 2))]
    last = store.filter((F.col("date_parsed") == str(END)) & (F.col("komoditas") == "beras")).first()
    assert (last["precipitation_sum"], last["temperature_max"], last["news_score"]) == (12.0, 31.0, 9.0)
    assert rows(snapshots.history(spark, f"{lake}/gold/feature_store"), "version", "n_rows") == [(0, 121)]
    assert spark.read.json(f"{lake}/export/price_history").count() in (2, 3)


def test_risk_alerts_and_recommendations(spark, lake):
    index = {r["komoditas"]: r for r in lakehouse.run_risk(spark, lake, str(END)).collect()}
    assert len(index) == 10
    assert index["beras"]["weather_signal"] == 90.0 and index["gula_pasir"]["news_signal"] == 0.0
    assert index["beras"]["news_signal"] > 0 and index["gula_pasir"]["price_signal"] == 50.0
    from tanisight.dims import AlertSettings
    low = AlertSettings(risk_warning=30.0, risk_high=40.0)
    first = lakehouse.run_alerts(spark, lake, f"{END} 07:00:00", low)
    assert "beras" in {r["komoditas"] for r in first.filter("not suppressed").collect()}
    sent = rows(first, "id", "suppressed")
    assert rows(lakehouse.run_alerts(spark, lake, f"{END} 07:00:00", low), "id", "suppressed") == sent
    again = lakehouse.run_alerts(spark, lake, f"{END} 12:00:00", low)
    assert again.count() > 0 and again.filter("not suppressed").count() == 0
    later = lakehouse.run_alerts(spark, lake, f"{END} 19:00:00", low)
    assert later.filter("suppressed").count() == 0
    assert {r["audience"] for r in lakehouse.run_recommendations(spark, lake).collect()} == {"government", "umkm"}


def test_evaluation_and_report(spark, lake):
    lakehouse.run_risk(spark, lake, str(END))
    alone = {r["komoditas"]: r for r in lakehouse.run_evaluation(spark, lake).collect()}
    assert {"beras", "cabai_keriting"} == set(alone)
    assert alone["beras"]["mape_avg"] is None and not alone["beras"]["model_wins"]
    spark.createDataFrame([("beras", 19000.0, 20000.0, 5.3, 0.01, 3.0)], lakehouse.FORECAST).write.parquet(f"{lake}/export/price_forecast")
    both = {r["komoditas"]: r for r in lakehouse.run_evaluation(spark, lake).collect()}
    assert both["beras"]["model_wins"] and not both["cabai_keriting"]["model_wins"]
    lines = lakehouse.run_report(spark, lake, str(END)).first()["report"].split("\n")
    assert sum("/100 [" in line for line in lines) == 10
    assert [line for line in lines if "20.000" in line or "20,000" in line]


def test_evaluation_has_lead_times_of_daily_risk(spark, lake):
    lakehouse.run_risk(spark, lake, str(END))
    assert all(r["events"] == 0 for r in lakehouse.run_evaluation(spark, lake).collect())
    kept = spark.read.parquet(f"{lake}/export/risk_daily").filter(F.col("date_parsed") == str(END))
    assert rows(kept, "komoditas", "risk_index") == rows(spark.read.parquet(f"{lake}/export/risk_index"), "komoditas", "risk_index")


def test_risk_history_ends_in_the_index_of_the_last_day(spark, lake):
    names = ["komoditas", "price_signal", "weather_signal", "news_signal", "risk_index", "level"]
    index = lakehouse.run_risk(spark, lake, str(END))
    history = lakehouse.run_risk_history(spark, lake)
    last = history.filter(F.col("date_parsed") == str(END))
    assert rows(last, *names) == rows(index.join(last.select("komoditas"), "komoditas"), *names) and last.count() == 2
    priced = snapshots.read_version(spark, f"{lake}/gold/feature_store").filter("avg_price > 0 and date_parsed is not null")
    assert rows(history, "komoditas", "date_parsed") == rows(priced, "komoditas", "date_parsed")
    assert lakehouse.run_evaluation(spark, lake).count() == 2


def test_views_over_the_lake(spark, lake):
    lakehouse.run_risk(spark, lake, str(END))
    lakehouse.run_forecast(spark, lake, trees=2)
    before = {r["komoditas"]: r for r in lakehouse.run_prediction_view(spark, lake).collect()}
    assert len(before) == 10 and before["beras"]["predicted_window"] is None and before["beras"]["rpkg_p10"] is None
    top = lakehouse.run_importance(spark, lake, trees=2)
    lakehouse.run_magnitude(spark, lake, trees=2)
    lakehouse.run_timing(spark, lake, trees=2)
    names = [r["feature"] for r in top.filter("komoditas = 'beras' and rank <= 3").orderBy("rank").collect()]
    view = {r["komoditas"]: r for r in lakehouse.run_prediction_view(spark, lake).collect()}
    beras = view["beras"]
    assert beras["predicted_window"] is not None and beras["rpkg_p10"] <= beras["rpkg_p90"]
    assert list(beras["top_features"]) == names and len(beras["triggers"].split(", ")) >= 3
    live = lakehouse._feed_prices(spark, spark.read.parquet(f"{lake}/bronze/price_pihps"), ["beras"])
    newest = live.orderBy(F.col("date_parsed").desc()).first()["price_idr_per_kg"]
    assert beras["price"] == newest and abs(beras["change_pct"]) <= 10
    assert beras["capped_7d"] == pytest.approx(newest * (1 + beras["change_pct"] / 100), abs=1)
    page = {r["komoditas"]: r for r in lakehouse.run_evaluation_view(spark, lake).collect()}
    assert len(page) == 10 and list(page["beras"]["top_features"]) == names
    assert page["beras"]["model_mape"] is not None and page["beras"]["baseline_mape"] is not None
    assert page["gula_pasir"]["top_features"] is None and page["gula_pasir"]["current_risk_index"] is not None


def _jsonl(folder, name, records):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in records) + "\n")


def _price(day, price, hour=6, **more):
    return {"source": "s", "komoditas": "beras", "price_idr_per_kg": price, "fetched_at_utc": f"{day}T0{hour}:00:00", **more}


def test_a_stream_feeds_silver_like_landed_files(spark, tmp_path):
    """Two runs of the stream with late and repeated records; the same lines landed as files give the same silver."""
    out, landed = str(tmp_path / "lake"), str(tmp_path / "landed")
    first = [_price("2026-06-20", 13000), _price("2026-06-21", 13100), "{rusak", _price("2026-06-21", 13150, hour=9)]
    second = [_price("2026-06-20", 12000, hour=1), _price("2026-06-22", 13300), _price("2026-06-21", 13100)]
    folder = tmp_path / "in"
    for name, records in (("a.jsonl", first), ("b.jsonl", second)):
        _jsonl(folder, name, records)
        lines = spark.readStream.option("maxFilesPerTrigger", 1).text(str(folder))
        lakehouse.run_bronze_stream(spark, lines, out, "price_pihps", {"availableNow": True}).awaitTermination()
    merged = f"{out}/bronze_stream/price_pihps"
    assert rows(spark.read.parquet(f"{merged}/quarantine"), "raw") == [("{rusak",)]
    lakehouse.run_silver(spark, out)
    lakehouse.run_bronze(spark, {"price_pihps": [str(folder)]}, landed)
    lakehouse.run_silver(spark, landed)
    names = ["source", "komoditas", "price_idr_per_kg", "date_parsed"]
    got = rows(spark.read.parquet(f"{out}/silver/silver_prices"), *names)
    assert got == rows(spark.read.parquet(f"{landed}/silver/silver_prices"), *names)
    assert [r[2] for r in got] == [13000.0, 13150.0, 13300.0]


def test_news_are_cleaned_once(spark, tmp_path, monkeypatch):
    """Ten more articles: ten are looked at. A changed and a withdrawn one replace what was kept."""
    out = str(tmp_path / "lake")
    looked = []
    extract = lakehouse.news.extract_signals
    monkeypatch.setattr(lakehouse.news, "extract_signals", lambda a, *w, **k: (looked.append(a.count()), extract(a, *w, **k))[1])

    def article(i, title="Harga beras naik", day=None):
        return {"source": "n", "article_id": f"x{i}", "title": title, "summary": "gagal panen di karawang",
                "fetched_at_utc": f"{day or DAYS[-1 - i % 9]}T06:00:00"}

    def run(name, records):
        folder = tmp_path / name
        _jsonl(folder, "n.jsonl", records)
        lakehouse.run_bronze(spark, {"news": [str(folder)]}, out)
        lakehouse.run_silver(spark, out)
        signals, velocity = lakehouse.run_news(spark, out, str(END))
        fresh = extract(spark.read.parquet(f"{out}/silver/silver_news"), lakehouse.dims.NEWS)
        assert rows(signals, "article_id", "date", "signal_score") == rows(fresh, "article_id", "date", "signal_score")
        return velocity

    some = [article(i) for i in range(20)]
    run("a", some)
    more = some + [article(i) for i in range(20, 30)]
    run("b", more)
    run("c", more)
    assert looked == [20, 10]
    last = [article(0, "Harga gula pasir naik", DAYS[-3])] + [article(1, "Berita lain") | {"summary": ""}] + more[3:]
    run("d", last)
    assert looked == [20, 10, 2]


def test_reference_prices_remember_earlier_runs(spark, tmp_path):
    out = str(tmp_path / "lake")
    _jsonl(tmp_path / "a", "p.jsonl", [_price("2026-06-20", 13000), _price("2026-06-21", 0)])
    _jsonl(tmp_path / "b", "p.jsonl", [_price("2026-06-20", 12000), _price("2026-06-21", 12500), _price("2026-06-20", 50000, komoditas="cabai_keriting")])
    lakehouse.run_bronze(spark, {"price_pihps": [str(tmp_path / "a")], "price_bapanas": [str(tmp_path / "b")]}, out)

    def run(day):
        filled = lakehouse.run_reference_prices(spark, out, day)
        assert filled.count() == 10
        return {k: (p, o) for k, p, o in rows(filled, "komoditas", "price_idr_per_kg", "origin") if o != "missing"}

    assert run("2026-06-19") == {}
    assert run("2026-06-20") == {"beras": (13000.0, "primary"), "cabai_keriting": (50000.0, "secondary")}
    want = {"beras": (12500.0, "secondary"), "cabai_keriting": (50000.0, "last_known")}
    assert run("2026-06-21") == want and run("2026-06-21") == want
    assert run("2026-06-25") == {"beras": (12500.0, "last_known"), "cabai_keriting": (50000.0, "last_known")}
