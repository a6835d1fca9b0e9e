"""Factorization machine: combinations of words, margins, and edge cases."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tanisight.llm import toxicity
from tanisight.session import ship_package

FILLER = [f"plain{i}" for i in range(300)]


def texts_of(shares, n=2000, seed=1):
    """(text, toxic) with neither, one, the other or both of two words; toxic only with both."""
    r = random.Random(seed)
    out = []
    for _ in range(n):
        kind = r.choices(range(4), shares)[0]
        words = r.choices(FILLER, k=r.randrange(20, 80)) + ["wretch"] * (kind in (1, 3)) + ["northerner"] * (kind in (2, 3))
        r.shuffle(words)
        out.append((" ".join(words).encode(), int(kind == 3)))
    return out


def fitted(pairs, bits=14):
    sample = toxicity.Sample(bits)
    for k in range(0, len(pairs), 700):
        sample.add([t for t, _ in pairs[k : k + 700]], [x for _, x in pairs[k : k + 700]])
    sample.close()
    machine = toxicity.Machine(bits)
    machine.fit(sample)
    return machine


@pytest.mark.parametrize("shares", [(1, 1, 1, 1), (3, 3, 3, 1)])
def test_two_words_that_are_toxic_only_together(shares):
    machine = fitted(texts_of(shares))
    fresh = texts_of(shares, 800, seed=2)
    scores, toxic = machine.scores([t for t, _ in fresh]), np.array([x for _, x in fresh]) == 1
    assert (scores[toxic] >= 0.7).mean() > 0.98 and (scores[~toxic] >= 0.7).mean() < 0.02
    one = machine.scores([b"a wretch here", b"a northerner here", b"wretch and northerner", b"nothing"])
    assert one[2] >= 0.7 and max(one[0], one[1], one[3]) < 0.7


def test_margins_equal_a_double_loop():
    r = np.random.default_rng(3)
    machine = toxicity.Machine(12)
    machine.bias, machine.weights[:] = 0.3, r.normal(size=1 << 12)
    machine.vectors[:] = r.normal(size=machine.vectors.shape)
    machine.weights[0], machine.vectors[0] = 0, 0
    texts = [b"one two three fourteen", b"", b"longer words appearing here, repeated repeated", b"x"]
    terms, words, offsets = toxicity.word_sets(texts, 12)
    got, _ = machine.margins(terms, words, offsets)
    for i in range(len(texts)):
        slots = [s for w in words[offsets[i] : offsets[i + 1]] for s in terms[w] if s]
        wanted = machine.bias + sum(machine.weights[s] for s in slots) + sum(float(machine.vectors[a] @ machine.vectors[b]) for a, b in itertools.combinations(slots, 2))
        assert got[i] == pytest.approx(wanted, rel=1e-4)


def test_counts_do_not_depend_on_slices():
    pairs = texts_of((3, 3, 3, 1), 500)
    whole, small = toxicity.Sample(12), toxicity.Sample(12)
    whole.add(*zip(*pairs, strict=True))
    for t, x in pairs:
        small.add([t], [x])
    for s in (whole, small):
        s.close()
        s.machine = toxicity.Machine(12)
        s.machine.select(s, 3, 12)
    assert (whole.machine.active == small.machine.active).all() and whole.machine.active.any()
    assert list(small.parts(40))[-1][1] == 500 and len(list(small.parts(40))) > 100


def test_edge_rows(spark):
    ship_package(spark)
    pairs = texts_of((3, 3, 3, 1), 600)
    rows = [(i, t.decode(), 0.5, "x") for i, (t, _) in enumerate(pairs)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double, slots string")
    labels = spark.createDataFrame([(i, x, 0) for i, (_, x) in enumerate(pairs)] + [(0, None, 0)], "doc_id long, toxic int, quality int")
    machine = toxicity.train(spark, docs, labels, F.lit(True), max_rows=150)
    odd = [(1, None), (2, ""), (3, " \n"), (4, "wretch northerner"), (4, "wretch northerner"), (None, "plain1 " * 200_000 + "wretch northerner"), (5, "plain1")]
    table = spark.createDataFrame([(i, t, 9, 9) for i, t in odd], "doc_id long, text string, score int, toxic int")
    got = [(r.doc_id, r.score) for r in toxicity.score(spark, table, machine).collect()]
    assert len(got) == len(odd) and got[0][1] == got[1][1] == got[2][1] == got[6][1] < 0.7
    assert got[3] == got[4] and got[3][1] >= 0.7 and got[5][1] >= 0.7
    assert toxicity.score(spark, table.limit(0), machine).count() == 0
    assert toxicity.train(spark, docs, labels.limit(0), F.lit(True)) is None
    assert toxicity.train(spark, docs.limit(0), labels, F.lit(True)) is None
