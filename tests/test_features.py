import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tanisight.operators import evaluate, features as ft
from tests.conftest import rows

START = dt.date(2025, 1, 1)


def series(n=120, seed=5, names=("a", "b"), gaps=True):
    rng = random.Random(seed)
    out = []
    for k in names:
        price, day = 10000.0, START
        for _ in range(n):
            price = round(max(1000, price * (1 + rng.gauss(0, 0.04))), 2)
            out.append((k, day, price))
            day += dt.timedelta(days=rng.choice([1, 1, 2]) if gaps else 1)
    return pd.DataFrame(out, columns=["komoditas", "date_parsed", "avg_price"])


@pytest.fixture(scope="module")
def daily(spark):
    pdf = series()
    return pdf, spark.createDataFrame(pdf)


def test_features_match_pandas(daily):
    pdf, df = daily
    got = df.withColumns(
        ft.lags([1, 7, 30]) | ft.rolling([7], [14]) | ft.changes([3, 30]) | ft.targets() | {"cv": ft.variation()}
    ).toPandas().sort_values(["komoditas", "date_parsed"]).reset_index(drop=True)
    parts = []
    for _, g in pdf.groupby("komoditas", sort=True):
        p = g["avg_price"]
        parts.append(pd.DataFrame({
            "price_lag_1d": p.shift(1), "price_lag_7d": p.shift(7), "price_lag_30d": p.shift(30),
            "price_ma_7d": p.rolling(7).mean(), "price_std_14d": p.rolling(14).std(),
            "price_pct_3d": p.pct_change(3) * 100, "price_pct_30d": p.pct_change(30) * 100,
            "target_price_14d": p.shift(-14), "target_change_pct": (p.shift(-7) / p - 1) * 100,
            "cv": (p.rolling(14).std() / p.rolling(14).mean() * 100).fillna(0),
        }))
    want = pd.concat(parts).reset_index(drop=True)
    for c in want.columns:
        pd.testing.assert_series_equal(got[c], want[c], check_names=False, rtol=1e-9)


def test_days_to_spike_matches_a_plain_search(daily):
    pdf, df = daily
    got = {(r["komoditas"], r["date_parsed"]): (r["days_to_spike"], r["target_class"])
           for r in ft.days_to_spike(ft.spike_flags(df)).collect()}
    for k, g in pdf.groupby("komoditas"):
        spikes = g.loc[(g["avg_price"].pct_change(7) * 100).abs() > 5, "date_parsed"].tolist()
        for day in g["date_parsed"]:
            later = [s for s in spikes if s > day]
            days = (later[0] - day).days if later else 999
            assert got[(k, day)] == (days, 0 if days <= 7 else 1 if days <= 14 else 2 if days <= 30 else 3)


def test_lead_times_match_a_plain_search(spark):
    rng = random.Random(1)
    days = [START + dt.timedelta(days=i) for i in range(200)]
    spikes = [(k, d) for k in "ab" for d in days if rng.random() < 0.2]
    alerts = [(k, d) for k in "ab" for d in days if rng.random() < 0.05]
    ddl = "komoditas string, date_parsed date"
    got = rows(evaluate.lead_times(spark.createDataFrame(spikes, ddl), spark.createDataFrame(alerts, ddl)))
    want = []
    for k, s in spikes:
        before = [d for kk, d in alerts if kk == k and d < s]
        if before and 1 <= (s - max(before)).days <= 30:
            want.append((k, s, max(before), (s - max(before)).days))
    assert got == sorted(want, key=repr)


def test_naive_backtest_matches_numpy(daily):
    pdf, df = daily
    got = {r["komoditas"]: r for r in evaluate.naive_backtest(df).collect()}
    for k, g in pdf.groupby("komoditas"):
        p = g["avg_price"].to_numpy()
        y, hat = p[7:], p[:-7]
        assert got[k]["n_samples"] == len(y)
        assert got[k]["baseline_mape"] == pytest.approx(np.mean(np.abs((y - hat) / y)) * 100, abs=0.0051)
        assert got[k]["baseline_rmse"] == pytest.approx(np.sqrt(np.mean((y - hat) ** 2)), abs=0.51)
        da = np.mean(np.sign(np.diff(y)) == np.sign(hat[1:] - y[:-1])) * 100
        assert got[k]["baseline_da"] == pytest.approx(da, abs=0.051)


def test_folds_expand_and_never_look_ahead(daily):
    _, df = daily
    folds = ft.time_folds(df)
    for r in folds.groupBy("komoditas", "fold").agg(
        F.max(F.when(F.col("role") == "train", F.col("date_parsed"))).alias("train_end"),
        F.min(F.when(F.col("role") == "test", F.col("date_parsed"))).alias("test_start"),
        F.count_if(F.col("role") == "train").alias("n_train"), F.count_if(F.col("role") == "test").alias("n_test"),
    ).collect():
        assert r["train_end"] < r["test_start"]
        assert (r["n_train"], r["n_test"]) == (30 * (r["fold"] + 1), 30)


def test_short_series_are_dropped_and_optional_columns_default(spark):
    pdf = pd.concat([series(60, names=("long",)), series(20, names=("short",))])
    matrix = ft.feature_matrix(spark.createDataFrame(pdf), "timing")
    assert {r[0] for r in matrix.select("komoditas").distinct().collect()} == {"long"}
    assert rows(matrix.select("temp_roll7", "news_score").distinct()) == [(30.0, 0.0)]
    gate = dict(rows(ft.history_gate(spark.createDataFrame(pdf), 37), "komoditas", "enough"))
    assert gate == {"long": True, "short": False}


def test_scoring_row_is_the_newest_unless_strict(spark):
    pdf = series(80, names=("a",), gaps=False)
    df = spark.createDataFrame(pdf)
    last = pdf["date_parsed"].max()
    assert ft.scoring_rows(df, "7d").first()["date_parsed"] == last
    assert ft.scoring_rows(df, "7d", strict_reference=True).first()["date_parsed"] == last - dt.timedelta(days=7)


def test_live_change(spark):
    def change(prices):
        data = [("a", START + dt.timedelta(days=i), float(p)) for i, p in enumerate(prices)]
        df = spark.createDataFrame(data, "komoditas string, date_parsed date, avg_price double")
        return tuple(ft.live_change(df).first())[1:]

    assert change([100, 110, 110]) == (110.0, 10.0, 10.0)          # last different price; first row
    assert change([100, 100]) == (100.0, 0.0, 0.0)                 # all equal: row before
    assert change([100, 200, 1, 1, 1, 1, 1, 50]) == (50.0, 4900.0, -75.0)
    assert change([100]) == (100.0, None, None)


def test_spikes_from_ten_percent_and_alerts_by_risk(spark):
    days = [START + dt.timedelta(days=i) for i in range(14)]
    prices = [100.0] * 10 + [110.0, 109.0, 125.0, 100.0]  # rises over 7 rows: 10, 9, 25 and 0 percent
    daily = spark.createDataFrame([("a", d, p) for d, p in zip(days, prices)], "komoditas string, date_parsed date, avg_price double")
    index = spark.createDataFrame(
        [("a", days[5], 60.0), ("a", days[8], 59.9), ("a", days[11], 81.0), ("a", days[12], 90.0)],
        "komoditas string, date_parsed date, risk_index double")
    spikes, alerts = evaluate.spike_and_alert_days(daily, index)
    assert rows(spikes) == [("a", days[10]), ("a", days[12])]
    assert rows(alerts) == sorted([("a", days[5]), ("a", days[11]), ("a", days[12])], key=repr)
    assert rows(evaluate.lead_times(spikes, alerts)) == [("a", days[10], days[5], 5), ("a", days[12], days[11], 1)]
