"""Gradient boosting over histograms for many small series at once.

Each group of rows, such as a commodity and a fold, is one model. Groups are dealt over the cluster and fitted
where they land; a group is a daily series, so its size is bounded by the calendar. Inputs are binned
once; every level of a tree adds up gradients by node, input and bin, and takes the split of largest gain.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 256


class Squared:
    """Squared error: predictions are means."""

    outputs = 1

    def start(self, y, weight):
        return np.array([np.average(y, weights=weight)])

    def slopes(self, y, margin, weight):
        return (margin[:, 0] - y)[:, None] * weight[:, None], weight[:, None]

    def leaf(self, rest, default):
        return default

    def result(self, margin):
        return margin


class Pinball(Squared):
    """Quantile loss: the slope is a sign, and a leaf holds the quantile of what is left in it."""

    def __init__(self, level: float):
        self.level = level

    def start(self, y, weight):
        return np.array([np.quantile(y, self.level)])

    def slopes(self, y, margin, weight):
        return np.where(margin[:, 0] >= y, 1 - self.level, -self.level)[:, None] * weight[:, None], weight[:, None]

    def leaf(self, rest, default):
        return float(np.quantile(rest, self.level))


class Softmax(Squared):
    """Class probabilities; one tree per class and round. Classes that do not occur get probability 0."""

    def __init__(self, classes: int):
        self.outputs = classes

    def start(self, y, weight):
        here = np.bincount(y.astype(int), minlength=self.outputs) > 0
        return np.where(here, 0.0, -np.inf)

    def result(self, margin):
        raised = np.exp(margin - margin.max(1, keepdims=True))
        return raised / raised.sum(1, keepdims=True)

    def slopes(self, y, margin, weight):
        p = self.result(margin)
        hit = np.arange(self.outputs)[None, :] == y.astype(int)[:, None]
        return (p - hit) * weight[:, None], np.maximum(2 * p * (1 - p), 1e-16) * weight[:, None]


@dataclass(frozen=True)
class Settings:
    trees: int = 200
    depth: int = 4
    rate: float = 0.05
    rows: float = 0.8
    columns: float = 0.8
    shrink: float = 1.0  # added to a leaf's sum of second derivatives
    least: float = 1.0  # a side's least sum of second derivatives
    seed: int = 42


def cuts_of(column: np.ndarray) -> np.ndarray:
    """Places between the values, at most BINS - 1."""
    values = np.unique(column)
    if len(values) > BINS:
        values = np.unique(np.quantile(column, np.linspace(0, 1, BINS), method="nearest"))
    return (values[1:] + values[:-1]) / 2


def grow(codes: np.ndarray, g: np.ndarray, h: np.ndarray, used: np.ndarray, s: Settings):
    """Input and bin of each split, and the gains by input. A node without a split sends all rows left."""
    width, n_nodes = len(used), 2**s.depth - 1
    split_input, split_bin = np.zeros(n_nodes, np.int64), np.full(n_nodes, BINS, np.int64)
    gained, times = np.zeros(codes.shape[1]), np.zeros(codes.shape[1])
    node, first = np.zeros(len(g), np.int64), 0
    own = codes[:, used].astype(np.int64) + np.arange(width) * BINS
    for level in range(s.depth):
        nodes = 2**level
        cells = (own + (node * (width * BINS))[:, None]).ravel()
        size = nodes * width * BINS
        left_g, left_h = (np.bincount(cells, np.repeat(x, width), size).reshape(nodes, width, BINS).cumsum(2) for x in (g, h))
        all_g, all_h = left_g[:, :, -1:], left_h[:, :, -1:]
        right_g, right_h = all_g - left_g, all_h - left_h
        gain = left_g**2 / (left_h + s.shrink) + right_g**2 / (right_h + s.shrink) - all_g**2 / (all_h + s.shrink)
        gain[(left_h < s.least) | (right_h < s.least)] = -np.inf
        flat = gain.reshape(nodes, -1)
        best = flat.argmax(1)
        value = flat[np.arange(nodes), best]
        for k in np.flatnonzero(value > 1e-9):
            at = used[best[k] // BINS]
            split_input[first + k], split_bin[first + k] = at, best[k] % BINS
            gained[at] += value[k]
            times[at] += 1
        node = 2 * node + (codes[np.arange(len(node)), split_input[first + node]] > split_bin[first + node])
        first += nodes
    return split_input, split_bin, gained, times


def descend(codes: np.ndarray, split_input: np.ndarray, split_bin: np.ndarray, depth: int) -> np.ndarray:
    """The leaf of each row."""
    node, first = np.zeros(len(codes), np.int64), 0
    for level in range(depth):
        at = first + node
        node = 2 * node + (codes[np.arange(len(node)), split_input[at]] > split_bin[at])
        first += 2**level
    return node


def fit_predict(x: np.ndarray, y: np.ndarray, weight: np.ndarray, others: np.ndarray, loss: Squared, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """(predictions for `others`, mean gain per split by input, adding up to 1)."""
    cuts = [cuts_of(column) for column in x.T]
    codes, codes_others = (np.column_stack([np.searchsorted(c, column, "left") for c, column in zip(cuts, m.T, strict=True)]).astype(np.int16) for m in (x, others))
    random = np.random.default_rng(s.seed)
    start = loss.start(y, weight)
    margin, far = np.tile(start, (len(y), 1)), np.tile(start, (len(others), 1))
    gained, times = np.zeros(x.shape[1]), np.zeros(x.shape[1])
    width = max(1, int(s.columns * x.shape[1]))
    for _ in range(s.trees):
        slope, curve = loss.slopes(y, margin, weight)
        for k in np.flatnonzero(np.isfinite(start)):
            chosen = random.random(len(y)) < s.rows if s.rows < 1 else np.ones(len(y), bool)
            if not chosen.any():
                chosen[:] = True
            used = np.sort(random.permutation(x.shape[1])[:width])
            g, h = slope[:, k], curve[:, k]
            split_input, split_bin, gain, n = grow(codes[chosen], g[chosen], h[chosen], used, s)
            gained, times = gained + gain, times + n
            leaf = descend(codes, split_input, split_bin, s.depth)
            size = 2**s.depth
            value = -np.bincount(leaf[chosen], g[chosen], size) / (np.bincount(leaf[chosen], h[chosen], size) + s.shrink)
            for at in np.unique(leaf[chosen]):
                value[at] = loss.leaf((y - margin[:, k])[chosen & (leaf == at)], value[at])
            margin[:, k] += s.rate * value[leaf]
            far[:, k] += s.rate * value[descend(codes_others, split_input, split_bin, s.depth)]
    mean = np.divide(gained, times, out=np.zeros_like(gained), where=times > 0)
    return loss.result(far), mean / mean.sum() if mean.sum() > 0 else mean


def boost(rows: DataFrame, by: Sequence[str], features: Sequence[str], target: str, loss, settings: Settings = Settings(), weight: str | None = None) -> DataFrame:
    """Fit one model per group on its rows of role `train` and predict all others.

    Gives `by`, row, role, the target, predicted (array: one value, or a probability per class) and gains (array:
    importance of each input, adding up to 1). `row` numbers a group's predicted rows by role and day.
    A group without training rows gives none. loss: a loss, or a function from the group's key to it.
    """
    keys = list(by)
    kinds = dict(rows.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in keys) + ", row long, role string, date_parsed date, target double, predicted array<double>, gains array<double>"

    def fit(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["role", "date_parsed"], kind="stable")
        train, rest = part[part["role"] == "train"], part[part["role"] != "train"].reset_index(drop=True)
        if train.empty or rest.empty:
            none = part.head(0)
            return none[[*keys, "role", "date_parsed"]].assign(
                row=np.zeros(0, np.int64), target=np.zeros(0), predicted=pd.Series(dtype=object), gains=pd.Series(dtype=object))
        w = train[weight].to_numpy(float) if weight else np.ones(len(train))
        own = loss(key) if callable(loss) else loss
        got, gains = fit_predict(train[list(features)].to_numpy(float), train[target].to_numpy(float), w, rest[list(features)].to_numpy(float), own, settings)
        return pd.DataFrame({
            **{c: [k] * len(rest) for c, k in zip(keys, key, strict=True)}, "row": range(len(rest)), "role": rest["role"], "date_parsed": rest["date_parsed"],
            "target": rest[target].astype(float), "predicted": got.tolist(), "gains": [gains.tolist()] * len(rest)})

    wanted = rows.select(*dict.fromkeys([*keys, "role", "date_parsed", *features, target, *([weight] if weight else [])]))
    # A fixed number of partitions: the rows are few, and Spark would else fit all models in one task
    spread = wanted.repartition(max(2, rows.sparkSession.sparkContext.defaultParallelism), *keys)
    return spread.groupBy(*keys).applyInPandas(fit, schema)


def importances(scored: DataFrame, by: Sequence[str], features: Sequence[str]) -> DataFrame:
    """One row per group and input, from the gains of its first predicted row."""
    names = F.array(*[F.lit(f) for f in features])
    pairs = F.explode(F.arrays_zip(names.alias("feature"), F.col("gains").alias("importance"))).alias("p")
    return scored.filter("row = 0").select(*by, pairs).select(*by, "p.feature", "p.importance")
