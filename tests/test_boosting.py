"""Boosting against plain loops and known answers."""

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from tanisight.operators import models
from tanisight.operators.boosting import BINS, Pinball, Settings, Softmax, Squared, boost, cuts_of, descend, fit_predict, grow
from tests.test_features import series

ONE = np.ones


def test_first_split_is_the_best_of_all():
    r = np.random.default_rng(1)
    x, g, h = r.normal(size=(60, 3)).round(1), r.normal(size=60), ONE(60)
    codes = np.column_stack([np.searchsorted(cuts_of(c), c, "left") for c in x.T])
    split_input, split_bin, gained, _ = grow(codes, g, h, np.arange(3), Settings(depth=1))

    def gain(left):
        return sum(g[m].sum() ** 2 / (m.sum() + 1) for m in (left, ~left)) - g.sum() ** 2 / 61

    best = max(gain(x[:, f] <= v) for f in range(3) for v in np.unique(x[:, f])[:-1])
    left = codes[:, split_input[0]] <= split_bin[0]
    assert gain(left) == pytest.approx(best) == pytest.approx(gained.sum())
    assert (descend(codes, split_input, split_bin, 1) == ~left).all()


def test_squared_error_learns_steps():
    x = np.linspace(0, 1, 400)[:, None]
    y = np.where(x[:, 0] > 0.5, 10.0, -10.0)
    got, gains = fit_predict(np.hstack([x, np.zeros_like(x)]), y, ONE(400), np.array([[0.1, 0], [0.9, 0]]), Squared(), Settings(trees=200, columns=1.0))
    assert got[:, 0] == pytest.approx([-10, 10], abs=0.2) and gains.tolist() == [1.0, 0.0]
    constant, gains = fit_predict(np.zeros((5, 2)), np.arange(5.0), ONE(5), np.zeros((1, 2)), Squared(), Settings(trees=3, rows=1.0))
    assert constant[0, 0] == pytest.approx(2) and gains.tolist() == [0, 0]


def test_many_values_make_bounded_bins():
    assert len(cuts_of(np.arange(100_000.0))) <= BINS - 1
    assert cuts_of(np.array([1.0, 3.0, 3.0])).tolist() == [2.0] and len(cuts_of(np.array([7.0]))) == 0


@pytest.mark.parametrize("level", [0.1, 0.5, 0.9])
def test_quantiles_cover_their_share(level):
    r = np.random.default_rng(2)
    x = r.uniform(size=(3000, 2))
    y = x[:, 0] * 10 + r.exponential(1 + 3 * x[:, 0])
    got, _ = fit_predict(x[:2000], y[:2000], ONE(2000), x[2000:], Pinball(level), Settings(trees=150, rows=1.0, columns=1.0))
    assert np.mean(y[2000:] <= got[:, 0]) == pytest.approx(level, abs=0.05)


def test_softmax_adds_up_and_leaves_absent_classes_out():
    x = np.linspace(0, 1, 300)[:, None]
    y = np.where(x[:, 0] < 0.3, 0, np.where(x[:, 0] < 0.6, 1, 3)).astype(float)
    got, _ = fit_predict(x, y, ONE(300), np.array([[0.1], [0.45], [0.9]]), Softmax(4), Settings(trees=60, columns=1.0))
    assert got.sum(1) == pytest.approx(1) and (got[:, 2] == 0).all()
    assert got.argmax(1).tolist() == [0, 1, 3] and got.max(1).min() > 0.8


def test_groups_are_models_of_their_own_and_repeatable(spark):
    rows = [(k, "train" if i < 80 else "test", i, float(i % 9), float((i % 9) * (1 if k == "a" else -1))) for k in "ab" for i in range(90)]
    rows += [("c", "test", 1, 1.0, 1.0)]  # nothing to learn from
    table = spark.createDataFrame(rows, "k string, role string, i int, x double, y double").withColumn("date_parsed", F.date_add(F.lit("2024-01-01").cast("date"), F.col("i")))
    fit = lambda t: {(r.k, r.row): r.predicted[0] for r in boost(t, ["k"], ["x"], "y", Squared(), Settings(trees=150)).collect()}
    got = fit(table)
    assert set(got) == {(k, i) for k in "ab" for i in range(10)}
    assert all(abs(v - (80 + i) % 9 * (1 if k == "a" else -1)) < 0.3 for (k, i), v in got.items())
    assert fit(table.repartition(5)) == got
    assert boost(table.limit(0), ["k"], ["x"], "y", Squared()).count() == 0


def test_errors_are_near_those_of_mllib(spark):
    store = spark.createDataFrame(series(260, seed=4, names=("a",), gaps=False))
    scored = models.fold_predictions(store, "7d", Squared(), Settings())
    own = scored.filter("role = 'test' and fold = 2").agg(F.sqrt(F.avg((F.col("target") - F.col("predicted")[0]) ** 2))).first()[0]
    from tanisight.operators.features import FEATURES_7D, feature_matrix, time_folds

    part = VectorAssembler(inputCols=FEATURES_7D, outputCol="x").transform(time_folds(feature_matrix(store, "7d"), 3).filter("fold = 2")).cache()
    other = GBTRegressor(featuresCol="x", labelCol="target_price_7d", maxIter=20, maxDepth=4, stepSize=0.3, seed=1).fit(part.filter("role = 'train'"))
    theirs = RegressionEvaluator(labelCol="target_price_7d", metricName="rmse").evaluate(other.transform(part.filter("role = 'test'")))
    assert own < 1.3 * theirs


def test_walk_forward_coverage_is_near_80_percent(spark):
    """Moves without a trend: what lies between the 10 and 90 % quantiles of models that have not seen it."""
    r = np.random.default_rng(8)
    rows = [("a", i, float(r.normal()), float(r.normal())) for i in range(1200)]
    table = spark.createDataFrame(rows, "komoditas string, i int, x double, y double").withColumn("date_parsed", F.date_add(F.lit("2020-01-01").cast("date"), F.col("i")))
    folds = models.time_folds(table, 3).withColumn("level", F.explode(F.array(F.lit(0.1), F.lit(0.9))))
    scored = boost(folds, ["komoditas", "fold", "level"], ["x"], "y", lambda key: Pinball(key[2]), Settings(trees=60, rows=1.0, columns=1.0))
    wide = scored.groupBy("fold", "row").agg(F.min(F.col("predicted")[0]).alias("low"), F.max(F.col("predicted")[0]).alias("high"), F.first("target").alias("y"))
    assert wide.agg(F.avg(F.col("y").between(F.col("low"), F.col("high")).cast("int"))).first()[0] == pytest.approx(0.8, abs=0.07)
