"""Near duplicates and the similarity join on families of near copies, against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from tanisight.llm import jaccardjoin, neardup

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def sets_of(rows, size):
    out = {}
    for i, text in rows:
        w = WORDS.findall((text or "").encode().lower())
        out[i] = {tuple(w[j : j + size]) for j in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()
    return out


def brute(rows, size, percent):
    sets = sets_of(rows, size)
    where, label = {}, {i: i for i in sets}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, s in sets.items():
        for g in s:
            where.setdefault(g, []).append(i)
    for a in sets:
        for b in {b for g in sets[a] for b in where[g] if b < a}:
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                label[y] = x
    return {i: (len(sets[i]), root(i)) for i in sets}


def family(n, words=120, changes=(1,), seed=1, name="f", chain=False):
    """Copies of one text, each with other words in place of some; chain: some are copies of copies."""
    r = random.Random(f"{seed}{name}")
    base = [f"{name}{i}" for i in range(words)]
    out = []
    for k in range(n):
        w = list(r.choice(out).split() if chain and out and k % 2 else base)
        for c in range(r.choice(changes)):
            w[r.randrange(words)] = f"{name}x{k}y{c}"
        out.append(" ".join(w))
    return out


def numbered(texts, seed=3):
    ids = random.Random(seed).sample(range(10 * len(texts)), len(texts))
    return list(zip(ids, texts, strict=True))


CASES = {
    "one word each": lambda: family(300),
    "one to six words": lambda: family(260, changes=(1, 2, 3, 4, 5, 6), name="g"),
    "copies of copies": lambda: family(200, changes=(1, 2, 3), name="h", chain=True),
    "short texts": lambda: family(80, words=12, changes=(1,), name="s") + ["one", "one two", "ONE two", "one two three", "a b c d", "a  b c d"],
    "families with a common line": lambda: [" ".join(f"line{i}" for i in range(30)) + " " + t for k in range(12) for t in family(8, 40, (1, 2), name=f"k{k}z")],
}


@pytest.mark.parametrize(("case", "percent"), [("one word each", 85), ("one to six words", 80), ("copies of copies", 85), ("short texts", 85), ("families with a common line", 85)])
def test_join_equals_brute_force(spark, case, percent):
    rows = numbered(CASES[case]())
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccardjoin.join_documents(spark, docs, percent).collect()}
    assert got == brute(rows, 4, percent)


@pytest.mark.parametrize(("case", "percent"), [("one word each", 80), ("one to six words", 85), ("copies of copies", 80)])
def test_near_copies_equal_brute_force(spark, case, percent):
    rows = numbered(CASES[case]())
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.link_copies(spark, docs, percent).collect()}
    assert got == brute(rows, 5, percent)


@pytest.mark.parametrize("run", [neardup.link_copies, jaccardjoin.join_documents])
def test_pairs_grow_with_the_rows(spark, run, monkeypatch):
    """Copies with one other word each: most pairs lie just under the threshold, and none is looked at twice over."""
    looked, of = [], neardup.Links.of

    def counted(self, pairs, few=False):
        looked[-1] += pairs.distinct().count()
        return of(self, pairs, few)

    monkeypatch.setattr(neardup.Links, "of", counted)
    for n in (250, 500):
        looked.append(0)
        docs = spark.createDataFrame(numbered(family(n)), "doc_id long, text string").repartition(4)
        run(spark, docs).count()
    assert looked[1] <= 2.5 * looked[0] + 100


def test_edge_cases_of_the_join(spark):
    same = " ".join(f"w{i}" for i in range(50))
    long = " ".join(f"v{i % 89}x{i}" for i in range(9000))
    rows = [(5, None), (6, ""), (7, " \n"), (8, same), (3, same.upper()), (9, same + " extra"), (1, long), (2, long + " tail"), (10, "one"), (4, "ONE"), (11, "one two")]
    docs = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in rows], "doc_id long, text string, node long, n_shingles long, bucket long").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccardjoin.join_documents(spark, docs).collect()}
    assert got == brute(rows, 4, 85) and got[8][1] == got[9][1] == 3 and got[10][1] == 4
    again = spark.createDataFrame([(7, same), (7, same), (None, same), (2, same), (9, "other words of a row here"), (9, same)], "doc_id long, text string")
    found = sorted((r.doc_id or -1, r.component_id) for r in jaccardjoin.join_documents(spark, again).collect())
    assert found == [(-1, None), (2, 2), (7, 2), (7, 2), (9, 2), (9, 9)]
    assert jaccardjoin.join_documents(spark, docs.limit(0)).count() == 0


def test_pairs_over_the_threshold_share_m_shingles_of_their_prefixes():
    r = np.random.default_rng(4)
    counts = r.integers(1, 50, 1 << jaccardjoin.TABLE)
    for percent in (80, 85):
        for _ in range(200):
            n, gone = int(r.integers(1, 300)), 0
            base = np.unique(r.integers(1, 1 << 62, n).astype(np.uint64))
            other = np.unique(np.concatenate([base[int(r.integers(0, max(1, len(base) // 8))) :], r.integers(1, 1 << 62, int(r.integers(0, max(1, n // 10)))).astype(np.uint64)]))
            both = np.intersect1d(base, other).size
            if 100 * both < percent * np.union1d(base, other).size:
                continue
            for m in (1, 2, 3, 8, len(base)):
                if m <= min(jaccardjoin.need(len(x), percent) for x in (base, other)):
                    first = [jaccardjoin.ordered(x, counts)[0][: len(x) - jaccardjoin.need(len(x), percent) + m] for x in (base, other)]
                    assert np.intersect1d(*first).size >= m
                    gone += 1


def test_prefixes_grow_where_lists_are_long():
    rare, common, mixed = np.full(100, 3), np.full(100, 4000), np.r_[np.full(25, 3), np.full(75, 4000)]
    assert jaccardjoin.matches(mixed, 85, 10) == jaccardjoin.least_matches(100) == 10
    assert jaccardjoin.matches(common, 85, 10) >= jaccardjoin.matches(rare, 85, 10) >= 10
    assert [jaccardjoin.matches(np.full(n, 9), 85, 10) for n in (1, 2, 5)] == [1, 1, 1]


def test_shared_shingles_equal_brute_force(spark):
    r = random.Random(2)
    sets = {i: sorted(set(r.sample(range(1, 90), 12)) | ({7} if i % 3 else set())) for i in range(60)}
    sets[99] = [500, 501]
    table = spark.createDataFrame([(i, bytearray(np.array(s, np.uint64).tobytes())) for i, s in sets.items()], "node long, shingles binary").repartition(5)
    wanted = {i: sum(any(x in sets[j] for j in sets if j != i) for x in s) for i, s in sets.items()}
    for size in (1 << 24, 64):
        got = {r.node: r.n_shared for r in neardup.shared_shingles(table, size).collect()}
        assert got == {i: n for i, n in wanted.items() if n}
