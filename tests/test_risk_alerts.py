import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tanisight import dims
from tanisight.operators import alerts, news, reports, risk, views
from tanisight.streaming import ingest
from tests.conftest import rows

DAY = dt.date(2026, 6, 23)


def days_back(i):
    return DAY - dt.timedelta(days=i)


@pytest.fixture(scope="module")
def beras(spark):
    return spark.createDataFrame([("beras", "Beras")], "komoditas string, label string")


def price_signal(spark, beras, prices):
    data = [("beras", days_back(len(prices) - i), float(p)) for i, p in enumerate(prices)]
    df = spark.createDataFrame(data, "komoditas string, date_parsed date, avg_price double")
    return risk.price_signal(df, beras).first()["price_signal"]


def test_price_signal(spark, beras):
    assert price_signal(spark, beras, []) == 50.0
    assert price_signal(spark, beras, [10000] * 35) == 50.0
    assert price_signal(spark, beras, range(8000, 8000 + 35 * 200, 200)) > 50.0
    rng = random.Random(42)
    assert 0 <= price_signal(spark, beras, [rng.randint(5000, 200000) for _ in range(40)]) <= 100


def weather_signal(spark, beras, records):
    df = spark.createDataFrame(
        records, "sentra string, current struct<precipitation: double, weather_code: int, temperature_2m: double>, "
        "ingestion_ts string, id int")
    regions = spark.createDataFrame([("beras", "karawang", 1.0)], "komoditas string, nama string, bobot double")
    latest = risk.latest_per_region(df, "ingestion_ts", "id")
    return risk.weather_signal(latest, regions, beras).first()["weather_signal"]


@pytest.mark.parametrize("region,current,expected", [
    ("karawang", (80.0, 80, 30.0), 90.0),
    ("karawang", (999.0, 99, 45.0), 100.0),
    ("karawang", (0.0, 0, 28.0), 0.0),
    ("karawang", (None, 61, 12.0), 30.0),
    ("xyz", (100.0, 99, 40.0), 0.0),
])
def test_weather_signal(spark, beras, region, current, expected):
    assert weather_signal(spark, beras, [(region, current, "2026-06-23T10:00:00", 1)]) == expected


def test_newest_weather_counts(spark, beras):
    records = [("karawang", (80.0, 0, 28.0), "2026-06-22", 1), ("karawang", (0.0, 0, 28.0), "2026-06-23", 2)]
    assert weather_signal(spark, beras, records) == 0.0


@pytest.mark.parametrize("velocity,score,expected", [(4.0, 12.0, 92.0), (0.5, 1.0, 12.67), (999.0, 999.0, 100.0)])
def test_news_signal(spark, beras, velocity, score, expected):
    df = spark.createDataFrame([("beras", velocity, score)], "komoditas string, velocity double, avg_score double")
    assert risk.news_signal(df, beras).first()["news_signal"] == expected
    assert risk.news_signal(df.limit(0), beras).first()["news_signal"] == 0.0


def test_risk_levels(spark):
    values = [39.9, 40.0, 59.9, 60.0, 79.9, 80.0, 100.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(risk.risk_level(F.col("v"))).collect()] == [
        "AMAN", "WASPADA", "WASPADA", "SIAGA", "SIAGA", "KRITIS", "KRITIS"]


def article(spark, title, summary):
    df = spark.createDataFrame([("1", "s", title, summary, DAY)],
                               "article_id string, source string, title string, summary string, date_parsed date")
    return news.extract_signals(df, dims.NEWS).collect()


def test_signals_of_native_articles(spark):
    assert article(spark, "Pertandingan sepak bola nasional", "Tim nasional menang 3-0 dalam laga persahabatan.") == []
    hit = article(spark, "Harga beras naik tajam akibat kekeringan di sentra produksi Karawang",
                  "Petani di Karawang melaporkan gagal panen akibat el nino yang berkepanjangan.")[0]
    assert hit["komoditas_matched"] == ["beras"] and hit["sentra_matched"] == ["karawang"]
    assert hit["gangguan_signals"] == {"gagal panen": 3, "kekeringan": 3, "el nino": 3}
    assert hit["signal_score"] == 3 + 9 + 2
    spike = article(spark, "Harga cabai rawit melonjak Rp50.000 akibat kelangkaan",
                    "Pasokan cabai rawit langka karena banjir di Brebes.")[0]
    assert spike["sentiment"] == "bullish"


def test_velocity(spark):
    ddl = "article_id int, komoditas_matched array<string>, date date, signal_score int, gangguan_signals map<string,int>"
    data = [(i, ["beras"], days_back(i), 5, {"banjir": 3}) for i in (1, 2, 3)]
    signals = spark.createDataFrame(data, ddl)
    dim = dims.commodity_table(spark)
    got = {r["komoditas"]: r for r in news.keyword_velocity(signals, dim, str(DAY)).collect()}
    assert len(got) == 10
    assert tuple(got["beras"])[1:] == (0, 1.0, 0.0, 5.0)
    assert tuple(got["gula_pasir"])[1:] == (0, 0.0, 0.0, 0.0)
    assert rows(news.top_phrases(signals, str(DAY)), "komoditas", "phrase", "n", "rank") == [("beras", "banjir", 3, 1)]


@pytest.mark.parametrize("ri,change,expected", [
    (65.0, None, "WASPADA"), (70.0, None, "SIAGA"), (80.0, None, "KRITIS"), (0.0, None, None),
    (0.0, 10.0, "WASPADA"), (0.0, 20.0, "KRITIS"), (65.0, 15.0, "WASPADA"), (75.0, 25.0, "KRITIS"), (0.0, -30.0, None),
])
def test_alert_level(spark, ri, change, expected):
    df = spark.createDataFrame([(ri, change)], "r double, c double")
    assert df.select(alerts.alert_level(F.col("r"), F.col("c"))).first()[0] == expected


def test_alert_message(spark, beras):
    due = beras.withColumns({
        "level": F.lit("SIAGA"), "risk_index": F.lit(72.5), "price_change_pct_7d": F.lit(8.25),
        "current_price": F.lit(13500.0), "forecast_7d": F.lit(14614.0),
        "top_signals": F.array(F.lit("banjir"), F.lit("hama"), F.lit("puso"), F.lit("rob")),
    })
    row = alerts.alert_records(due, F.lit("2026-06-23 06:00:00").cast("timestamp")).first()
    assert row["id"] == "beras_20260623060000" and row["date_label"] == "23 June 2026"
    assert row["message"] == (
        "[SIAGA] Beras — Indeks Risiko: 72.5/100 | Perubahan harga 7 hari: +8.3% (naik) | "
        "Proyeksi H+7: Rp13,500 → Rp14,614 | Sinyal dominan: banjir, hama, puso | "
        "Rekomendasi: Persiapkan cadangan distribusi dan pantau harga pasar harian.")
    bare = due.withColumns({"price_change_pct_7d": F.lit(None).cast("double"), "current_price": F.lit(None).cast("double"),
                            "top_signals": F.lit(None).cast("array<string>")})
    assert alerts.alert_records(bare, F.current_timestamp()).first()["message"].count(" | ") == 1


# --- cooldown -----------------------------------------------------------------------------
T0 = dt.datetime(2026, 1, 1)


def stream_of_alerts(spark, events):
    data = [(k, T0 + dt.timedelta(hours=h), i) for i, (k, h) in enumerate(events)]
    return spark.createDataFrame(data, "komoditas string, ts timestamp, event_id long")


def plain_cooldown(events, hours=12, last=None):
    last = dict(last or {})
    sent = set()
    for i, (k, h) in sorted(enumerate(events), key=lambda e: (e[1][0], e[1][1], e[0])):
        if k not in last or h - last[k] >= hours:
            sent.add(i)
            last[k] = h
    return sent, last


def sent_ids(df):
    return {r["event_id"] for r in df.filter(~F.col("suppressed")).collect()}


def test_cooldown_of_the_fixture(spark):
    events = [("a", h) for h in (0, 3, 11, 12, 13, 30, 41, 42)]
    got = alerts.cooldown(stream_of_alerts(spark, events))
    assert got.count() == len(events)
    assert {events[i][1] for i in sent_ids(got)} == {0, 12, 30, 42}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_cooldown_matches_a_plain_loop_over_many_blocks(spark, seed):
    """One hot commodity over several blocks, a sparse one with empty blocks, equal times."""
    rng = random.Random(seed)
    events = [("hot", round(rng.uniform(0, 4000), 1 + seed % 2)) for _ in range(3000)]
    events += [("sparse", rng.choice([5, 900, 901, 912.5, 3900])) for _ in range(20)]
    events += [("grid", 12 * i) for i in range(200)] + [("grid", 12 * i + 0.5) for i in range(200)]
    got = alerts.cooldown(stream_of_alerts(spark, events))
    assert sent_ids(got) == plain_cooldown(events)[0]


def test_cooldown_seed(spark):
    events = [("a", 5), ("a", 11.5), ("b", 1)]
    seed = spark.createDataFrame([("a", T0 - dt.timedelta(hours=1))], "komoditas string, ts timestamp")
    assert sent_ids(alerts.cooldown(stream_of_alerts(spark, events), seed=seed)) == {1, 2}


def test_stream_cooldown_carries_state_between_batches(spark, tmp_path):
    rng = random.Random(9)
    events = sorted(((rng.choice("ab"), round(rng.uniform(0, 300), 2)) for _ in range(200)), key=lambda e: e[1])
    df = stream_of_alerts(spark, events)
    folder = str(tmp_path / "in")
    for i in range(4):
        df.filter((F.col("event_id") >= 50 * i) & (F.col("event_id") < 50 * (i + 1))).coalesce(1).write.mode(
            "append").parquet(folder)
    source = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    out = str(tmp_path / "out")
    ingest.drain(ingest.cooldown_to(source, out, trigger=ingest.DRAIN))
    result = spark.read.parquet(f"{out}/data")
    assert result.select("_batch").distinct().count() == 4
    assert sent_ids(result) == plain_cooldown(events)[0]


def test_escalations(spark):
    levels = ["SIAGA", "KRITIS", "SIAGA", "AMAN", "KRITIS", "SIAGA"]
    df = spark.createDataFrame([("a", days_back(6 - i), x) for i, x in enumerate(levels)],
                               "komoditas string, date_parsed date, level string")
    assert rows(alerts.escalations(df), "komoditas", "n_runs") == [("a", 3)]


# --- views and reports --------------------------------------------------------------------
@pytest.mark.parametrize("r,a,c,expected", [
    ("AMAN", "SIAGA", None, "SIAGA"), ("KRITIS", "WASPADA", 2.0, "KRITIS"), ("AMAN", None, 8.0, "KRITIS"),
    ("AMAN", None, 6.0, "SIAGA"), ("AMAN", None, 4.0, "WASPADA"), ("KRITIS", "KRITIS", 0.0, "AMAN"),
])
def test_fused_level(spark, r, a, c, expected):
    df = spark.createDataFrame([(r, a, c)], "r string, a string, c double")
    assert df.select(views.fused_level(F.col("r"), F.col("a"), F.col("c"))).first()[0] == expected


def test_timeline_ends_at_the_forecasts(spark):
    df = spark.createDataFrame([("beras", 100.0, 170.0, 100.0)],
                               "komoditas string, current_price double, forecast_7d double, forecast_14d double")
    got = {r["day_label"]: (str(r["date"]), r["predicted_price"]) for r in views.forecast_timeline(df, "2026-06-23").collect()}
    assert len(got) == 14
    assert got["H+1"] == ("2026-06-24", 110.0) and got["H+7"][1] == 170.0 and got["H+14"][1] == 100.0


def test_recommendations(spark):
    labels = dims.commodity_table(spark)
    ddl = "komoditas string, level string, risk_index double"
    levels = spark.createDataFrame([("beras", "WASPADA", 45.0), ("gula_pasir", "KRITIS", 90.0), ("telur_ayam", "SIAGA", 70.0)], ddl)
    got = dict(rows(reports.recommendations(risk.high_risk(levels), labels)))
    assert "PRIORITAS TINGGI: Gula Pasir, Telur Ayam menunjukkan" in got["government"]
    assert "[WASPADA] Beras: Pantau" in got["umkm"]
    calm = dict(rows(reports.recommendations(risk.high_risk(levels.limit(0)), labels)))
    assert calm == reports.CALM


def test_keyed_state_holds_back_late_and_repeated_alerts(spark, tmp_path):
    """Each batch is a restart of the stream. A late alert meets the last one sent, not its own time."""
    rng = random.Random(4)
    parts = [[(rng.choice("abc"), round(rng.uniform(60 * i, 60 * i + 90), 1)) for _ in range(60)] for i in range(3)]
    parts[1] += parts[0][:10]
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    last, want, n = {}, set(), 0
    for part in parts:
        df = stream_of_alerts(spark, part).withColumn("event_id", F.col("event_id") + n)
        odd = spark.createDataFrame([(None, T0, -1), ("a", None, -2)], df.schema)
        df.unionByName(odd).write.mode("append").parquet(folder)
        sent, last = plain_cooldown(part, last=last)
        want |= {i + n for i in sent}
        n += len(part)
        source = spark.readStream.schema(df.schema).parquet(folder)
        ingest.drain(ingest.append_to(ingest.cooldown_state(source), out, ingest.DRAIN))
    result = spark.read.parquet(f"{out}/data")
    assert result.count() == n + 6 and sent_ids(result) == want | {-1, -2}


def test_cooldown_without_key_or_time_and_with_repeated_rows(spark):
    t = dt.datetime(2026, 1, 1, 6)
    df = spark.createDataFrame(
        [("a", t, 1), ("a", t, 1), ("a", t, 2), (None, t, 3), ("a", None, 4), ("b", t, None), ("b", t, None)],
        "komoditas string, ts timestamp, event_id long")
    got = [(r[0], r[1], r[2]) for r in alerts.cooldown(df, block=2, slots=3).select("komoditas", "event_id", "suppressed").collect()]
    assert sorted(got, key=str) == sorted([
        ("a", 1, False), ("a", 1, True), ("a", 2, True), (None, 3, False), ("a", 4, False), ("b", None, False), ("b", None, True)], key=str)
