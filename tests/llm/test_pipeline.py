"""The stages of the pipeline and the run as a whole, against plain loops."""

from __future__ import annotations

import re

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tanisight.llm import substrings, toxicity
from tanisight.llm.encoding import open_tokenizer
from tanisight.llm.queries import held
from tests.llm.test_closeness import brute

SF = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(SF + "/documents.parquet")


def plain_run(spark, docs):
    """What each stage keeps, as (doc_id, text), from the model's scores on."""
    machine = toxicity.train(spark, docs, spark.read.parquet(SF + "/labels.parquet"), ~held(toxicity.fold(F.col("doc_id")), 1))
    scores = {r.doc_id: r.score for r in toxicity.score(spark, docs, machine).collect()}
    rows = [(r.doc_id, r.text or "") for r in docs.collect() if scores[r.doc_id] < 0.7]
    yield rows
    last = {}
    for i, t in rows:
        key = "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
        last[key] = max(i, last.get(key, i))
    rows = [(i, t) for i, t in rows if i in set(last.values())]
    yield rows
    found = brute(rows, 5, 80)
    rows = [(i, t) for i, t in rows if found[i][1] == i]
    yield rows
    words = {i: WORDS.findall(t) for i, t in rows}
    first = {}
    for i in sorted(words):
        for j in range(len(words[i]) - 12):
            first.setdefault(tuple(words[i][j : j + 13]), i)
    cut = []
    for i, t in rows:
        w = words[i]
        gone = {k for j in range(len(w) - 12) if first[tuple(w[j : j + 13])] < i for k in range(j, j + 13)}
        text = " ".join(x for k, x in enumerate(w) if k not in gone) if gone else t
        cut += [(i, text)] if text or not gone else []
    yield cut


def test_run_equals_plain_loops(spark, docs):
    wanted = list(plain_run(spark, docs))
    table = docs
    for (_, stage), rows in zip(corpus_pipeline.STAGES[:-1], wanted, strict=True):
        table = stage(spark, table, SF)
        assert table.columns == docs.columns
        table = table.checkpoint()
        assert sorted((r.doc_id, r.text or "") for r in table.collect()) == sorted(rows)
    library = open_tokenizer(corpus_pipeline.BYTE_BPE)
    tokens = {i: len(library.encode(t, add_special_tokens=False).ids) + 1 for i, t in wanted[-1]}
    pieces = corpus_pipeline.run(spark, SF).collect()
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append((p.start, p.length))
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length))
        assert p.doc_tokens == tokens[p.doc_id]
    assert set(by_doc) == set(tokens)
    for spans, total in [(by_doc[i], n) for i, n in tokens.items()] + [(s, None) for s in by_sequence.values()]:
        spans.sort()
        assert [a for a, _ in spans] == np.cumsum([0] + [n for _, n in spans[:-1]]).tolist()
        assert sum(n for _, n in spans) == total if total else sum(n for _, n in spans) <= 2048


def test_toxic_documents_go_and_clean_ones_stay(spark, docs):
    labels = spark.read.parquet(SF + "/labels.parquet")
    kept = corpus_pipeline.drop_toxic(spark, docs, SF)
    rows = kept.select("doc_id").join(labels, "doc_id").groupBy("toxic").count().collect()
    before = {r.toxic: r["count"] for r in docs.join(labels, "doc_id").groupBy("toxic").count().collect()}
    after = {r.toxic: r["count"] for r in rows}
    assert after[0] >= 0.95 * before[0] and after.get(1, 0) <= 0.4 * before[1]


def test_odd_rows_and_clashing_columns(spark):
    words = " ".join(f"w{i}" for i in range(40))
    rows = [(1, None), (2, ""), (3, words), (4, "start " + words + " end"), (None, words + " null id"), (5, "one"), (5, "one")]
    names = ["id", "cut", "row", "_id", "_row", "kept", "rows", "n_removed", "score", "component_id"]
    odd = spark.createDataFrame([(i, t, *range(len(names))) for i, t in rows], "doc_id long, text string, " + ", ".join(f"{n} int" for n in names))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd, SF)
        assert out.columns == odd.columns and out.count() > 0
        assert stage(spark, odd.limit(0), SF).count() == 0
    cut = {r.doc_id: r.text for r in corpus_pipeline.cut_passages(spark, odd, SF).collect()}
    assert cut[3] == words and cut[4] == "start end" and cut[1] is None and cut[2] == ""
    assert corpus_pipeline.STAGES[-1][1](spark, odd, SF).select("doc_id").count() == len(rows)


def test_passages_are_cut_without_sending_texts_twice(spark):
    """Besides the judgement, the rows are shuffled once, with the runs of words they lose."""
    texts = {i: f"start{i} " + " ".join(f"w{k}" for k in range(20)) for i in range(4)}
    docs = spark.createDataFrame([(i, t, "x") for i, t in texts.items()] + [(7, None, "y"), (None, texts[0], "z")], "doc_id long, text string, source string")
    found = substrings.repeats(spark, docs)
    assert "text" not in found.columns
    runs = {r.row: np.frombuffer(r.cuts, np.int32).tolist() for r in found.collect()}
    keys = {r.doc_id: r.key for r in docs.select("doc_id", substrings.row_key(docs).alias("key")).collect()}
    assert runs == {keys[i]: [1, 21] for i in (1, 2, 3)}
    cut = corpus_pipeline.cut_passages(spark, docs, "")
    assert sorted(map(tuple, cut.collect()), key=str) == sorted([(0, texts[0], "x"), *[(i, f"start{i}", "x") for i in (1, 2, 3)], (7, None, "y"), (None, texts[0], "z")], key=str)
    sent = [x for x in cut._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in x]
    assert len(sent) == 1 and "LeftOuter" in sent[0]


def test_runs_of_removed_words():
    mark, place = [5, 5, 9, 5, 5, 9], [3, 2, 0, 30, 15, 13]
    rows = pa.RecordBatch.from_pylist([{"part": 0, "marks": np.array(mark, np.int64).tobytes(), "places": np.array(place, np.int32).tobytes()}])
    got = {r["row"]: np.frombuffer(r["cuts"], np.int32).tolist() for b in substrings.cuts_met(13)([rows]) for r in b.to_pylist()}
    assert got == {5: [2, 28, 30, 43], 9: [0, 26]}
    assert substrings.cut_words(b" a b\tc d  e", np.array([1, 2, 3, 4], np.int32).tobytes()) == b"a c e"
