import pytest
from pyspark.sql import functions as F

from tanisight.operators import evaluate, models
from tests.conftest import rows
from tests.test_features import series


@pytest.fixture(scope="module")
def store(spark):
    return spark.createDataFrame(series(150, seed=11, names=("a", "b"), gaps=False))


def test_forecast(spark, store):
    forecast, importance = models.forecast(store, "7d", trees=2)
    got = {r["komoditas"]: r for r in forecast.collect()}
    last = {r["komoditas"]: r["p"] for r in store.groupBy("komoditas").agg(F.max_by("avg_price", "date_parsed").alias("p")).collect()}
    assert set(got) == {"a", "b"}
    for k, r in got.items():
        assert r["current_price"] == round(last[k], 0)          # the newest row is scored
        assert r["forecast"] > 0 and r["mape_avg"] > 0 and r["rmse_avg"] > 0
        assert r["training_samples"] == 150 - 30 - 7            # full windows and a known target
    ranked = models.ranked_importance(importance, 3).collect()
    assert len(ranked) == 6 and all(0 <= r["importance"] <= 1 for r in ranked)
    versus = evaluate.model_vs_baseline(forecast, evaluate.naive_backtest(store)).collect()
    assert {r["komoditas"] for r in versus} == {"a", "b"}
    assert all(r["model_wins"] == (r["mape_avg"] < r["baseline_mape"]) for r in versus)


def test_forecast_table(spark, store):
    for r in models.forecast_table(store.filter("komoditas = 'a'"), trees=1).collect():
        assert r["confidence_lower"] <= r["forecast_7d"] <= r["confidence_upper"]
        assert r["forecast_14d"] is not None


def test_magnitude_quantiles_are_ordered(spark, store):
    for r in models.magnitude(store, trees=1).collect():
        assert r["rpkg_p10"] <= r["rpkg_p50"] <= r["rpkg_p90"]
        assert r["pct_p10"] <= r["pct_p50"] <= r["pct_p90"]


def test_timing_probabilities(spark, store):
    got = models.timing(store, trees=5).collect()
    assert len(got) == 2
    for r in got:
        p = [r[f"p_window_{i}"] for i in range(4)]
        assert sum(p) == pytest.approx(1.0, abs=0.003) and r["confidence"] == max(p)
        assert len(r["key_triggers"].split(", ")) == 3
    assert rows(store.select("komoditas").distinct()) == [("a",), ("b",)]


def test_registered_queries_fit_the_full_number_of_trees(spark, monkeypatch):
    from tanisight.plans.registry import models as registry

    class Stop(Exception):
        pass

    def boosted(rows, by, features, target, loss, settings, weight=None):
        raise Stop(settings.trees)

    monkeypatch.setattr(registry, "_store", lambda spark, sf: spark.createDataFrame(series(150, seed=11, names=("a",), gaps=False)))
    monkeypatch.setattr(models, "boost", boosted)
    for name, query in registry.FITTED.items():
        with pytest.raises(Stop) as seen:
            query(spark, "")
        assert seen.value.args == (150 if name == "magnitude_quantiles" else 200,), name
