"""Importance resampling against plain loops."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from tanisight.llm import resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}
ODD = [None, "", " ?! ", "One", "one two", "ÀB é_x日本 [a]b\x00c 9", "z" * 200 + " " + "y" * 90 + " tail", "trailing word ", "  q"]


def feature_buckets(text, buckets=10000):
    w = WORD.findall((text or "").translate(LOWER))
    return w, [zlib.crc32(x.encode()) % buckets for x in w + [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)]]


def brute(docs, target, percent=25, least=20, buckets=10000):
    count = lambda texts: collections.Counter(b for t in texts for b in feature_buckets(t, buckets)[1])
    s, t = count(x for _, x in docs), count(target)
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * (s_all + buckets) / ((s[b] + 1.0) * (t_all + buckets)))) for b in range(buckets)]
    out = []
    for doc, text in docs:
        w, found = feature_buckets(text, buckets)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out.append([doc, len(w), len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0]))
    for k, r in enumerate(able[: percent * len(able) // 100]):
        r[5] = k + 1
    return sorted(map(tuple, out), key=repr)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def corpus():
    random.seed(5)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(random.choices(words[: random.choice([20, 60])], k=random.randrange(5, 60))) for _ in range(240)]
    return list(enumerate(ODD + texts)), [" ".join(random.choices(words[:20], k=30)) for _ in range(40)] + [None, ""]


@pytest.mark.parametrize("accuracy", [1000, 10, 2])  # the last two make wide brackets or all scores
def test_equals_brute_force(spark, corpus, accuracy):
    docs, target = corpus
    table = spark.createDataFrame([(i, t, 0, "r") for i, t in docs], "doc_id long, text string, score long, rank string").repartition(5)
    aim = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    assert rows(resampling.draw(spark, table, aim, accuracy=accuracy)) == brute(docs, target)


def test_ties_repeated_rows_and_nulls(spark):
    text = " ".join(f"t{i}" for i in range(25))
    docs = [(3, text)] * 5 + [(4, text), (None, text), (None, None)]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    aim = spark.createDataFrame([(1, "t1 t2")], "item_id long, text string")
    assert rows(resampling.draw(spark, table, aim, percent=60)) == brute(docs, ["t1 t2"], 60)
    assert rows(resampling.draw(spark, table, aim.limit(0), percent=60)) == brute(docs, [], 60)
    assert resampling.draw(spark, table.limit(0), aim).count() == 0
    assert all(r.rank is None for r in resampling.draw(spark, table, aim, percent=1).collect())


def test_a_bracket_that_misses_is_widened(spark, monkeypatch):
    scores = spark.range(1000).selectExpr("id as doc_id", "id * 3 as score")
    real = resampling.F.percentile_approx
    calls = []

    def wrong(column, shares, accuracy):
        calls.append(shares)
        return real(column, [0.0, 0.01], accuracy) if len(calls) < 3 else real(column, shares, accuracy)

    monkeypatch.setattr(resampling.F, "percentile_approx", wrong)
    assert resampling.cutoff(scores, 25) == (250, 2250)
    assert len(calls) >= 3


def test_crc_of_joined_strings():
    shifts, r = resampling.Shifts(), random.Random(1)
    pairs = [(r.randbytes(r.randrange(0, 40)), r.randbytes(r.randrange(0, 64))) for _ in range(300)]
    left, right = (np.array([zlib.crc32(p[k]) for p in pairs], np.uint32) for k in (0, 1))
    sizes = np.array([len(b) for _, b in pairs])
    assert shifts.join(left, right, sizes).tolist() == [zlib.crc32(a + b) for a, b in pairs]
