"""Corpus operators against brute force, the library and edge cases."""

from __future__ import annotations

import collections
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tanisight.llm import bpe, exact, language, licenses, neardup, packing, quality, substrings, tokenfiles, toxicity
from tanisight.llm.encoding import ByteEncoder, WordEncoder, open_tokenizer
from tanisight.session import ship_package

BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")
WORDS = rb"[^\x20\x09-\x0D]+"
PASSAGE = " ".join(f"shared{i}" for i in range(40))
LONG = " ".join(f"w{i % 97}x{i}" for i in range(9000))
TEXTS = [
    None, "", " ", "one", "one two three four", "a " * 40, PASSAGE, PASSAGE.upper(), "start here " + PASSAGE + " and end",
    PASSAGE + " extra", LONG, LONG + " tail", "line one.\nline one.\nAll rights reserved.\n\n x", "it's  odd\t\ttext \n\n here",
    "日本 語 123 <|endoftext|> é ²", "\x1ca b\x1f c", "same text", "Same Text", "same text",
]
SCHEMA = "doc_id long, text string, kept boolean, n_words long, part long"


@pytest.fixture(scope="module")
def docs(spark):
    ship_package(spark)
    rows = [(i, t, False, -1, 5) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def data(text):
    return (text or "").encode()


def test_encoders_equal_the_library():
    odd = [t or "" for t in TEXTS] + [" lead", "trail ", "\nq w\n", "a" * 3000, "abab" * 300, "ΑΣ ς İI", "a\u0085b c"]
    for path, kind in ((BYTE, ByteEncoder), (WORD, WordEncoder), (BYTE, bpe.PrefixCoder)):
        library, own = open_tokenizer(path), kind(path)
        for text, ids in zip(odd, own.encode([t.encode() for t in odd]), strict=True):
            assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_prefix_coder_decodes_and_digests(spark, docs, empty):
    library = open_tokenizer(BYTE)
    for r in bpe.encode_decode(docs, BYTE).collect():
        ids = library.encode(TEXTS[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.encode_decode(empty, BYTE).count() == 0


def test_packing_covers_each_id_once(spark, docs, empty):
    library = open_tokenizer(BYTE)
    rows = packing.pack(docs, BYTE, size=64, with_ids=True).collect()
    by_doc, by_window = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_window[r.sequence_id].append(r)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
    for doc, text in enumerate(TEXTS):
        pieces = sorted(by_doc[doc], key=lambda r: r.start)
        ids = [i for r in pieces for i in r.ids]
        assert ids == [*library.encode(text or "", add_special_tokens=False).ids, 1]
        assert [r.start for r in pieces] == list(np.cumsum([0] + [r.length for r in pieces[:-1]]))
    partial = 0
    for pieces in by_window.values():
        pieces.sort(key=lambda r: r.offset)
        assert [r.offset for r in pieces] == list(np.cumsum([0] + [r.length for r in pieces[:-1]]))
        used = sum(r.length for r in pieces)
        assert used <= 64 and pieces[0].padded_length in (64, used)
        partial += used < 64
    assert partial <= 3  # one per task
    assert packing.pack(empty, BYTE).count() == 0


def test_sum_of_squares_choice_is_the_smallest():
    windows, random = packing.Windows(32, 0), np.random.default_rng(3)
    for step in range(300):
        s = int(random.integers(1, 32))

        def squares(level):
            counts = windows.counts.copy()
            if level:
                counts[level] -= 1
            if level + s < 32:
                counts[level + s] += 1
            return int((counts[1:32] ** 2).sum())

        options = [h for h in range(0, 33 - s) if h == 0 or windows.counts[h]]
        assert squares(windows.level_for(s)) == min(map(squares, options))
        list(windows.place(step, 0, b"\0" * 4 * s, s))


def test_token_files_round_trip(spark, docs, empty):
    library = open_tokenizer(WORD)
    rows = sorted(tokenfiles.saved(spark, docs, WORD, length=16, rows=4).collect(), key=lambda r: r.doc_id)
    start = 0
    for r, text in zip(rows, TEXTS, strict=True):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert tokenfiles.saved(spark, empty, WORD).count() == 0


def test_near_copies_equal_brute_force(spark, docs, empty):
    sets = {}
    for i, text in enumerate(TEXTS):
        w = re.findall(WORDS, data(text).lower())
        sets[i] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    label = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= 85 * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.link_copies(spark, docs).collect()}
    assert got == {i: (len(sets[i]), label[i], label[i] == i) for i in sets}
    assert neardup.link_copies(spark, empty).count() == 0


def test_passages_equal_brute_force(spark, docs, empty):
    words = {i: re.findall(WORDS, data(t)) for i, t in enumerate(TEXTS)}
    first = {}
    for i, w in words.items():
        for j in range(len(w) - 12):
            first.setdefault(tuple(w[j : j + 13]), i)
    got = {r.doc_id: r for r in substrings.remove_repeats(spark, docs, with_text=True).collect()}
    for i, w in words.items():
        gone = {k for j in range(len(w) - 12) if first[tuple(w[j : j + 13])] < i for k in range(j, j + 13)}
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        assert (got[i].n_words, got[i].n_removed, got[i].kept_sha256) == (len(w), len(gone), hashlib.sha256(kept).hexdigest())
        assert got[i].text_kept == (kept.decode() if gone else None)
    assert substrings.remove_repeats(spark, empty).count() == 0


def test_exact_copies_and_splitting_directory(spark, docs, empty):
    groups = collections.defaultdict(list)
    for i, t in enumerate(TEXTS):
        groups[data(t).lower()].append(i)
    for capacity in (None, 100):  # the second splits buckets
        got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact.deduplicate(spark, docs, capacity).collect()}
        assert got == {i: (max(g), len(g), i == max(g), hashlib.sha256(t).hexdigest()) for t, g in groups.items() for i in g}
    again = spark.createDataFrame([(7, "x"), (7, "X"), (None, "x"), (3, "y")], "doc_id long, text string")
    assert sorted((r.doc_id or -1, r.kept) for r in exact.deduplicate(spark, again).collect()) == [(-1, False), (3, True), (7, False), (7, True)]
    assert exact.deduplicate(spark, empty).count() == 0


def test_directory_doubles():
    d = exact.Directory({0: 10, 1: 10, 8: 90, 9: 5}, 4, 30)
    assert d.depth == 4 and len(d.slots()) == 16
    assert all(load <= 30 or bits == 4 for (bits, _), load in d.buckets.items())


def test_quality_counts_equal_brute_force(spark, docs, empty):
    got = {r.doc_id: r for r in quality.clean(docs).collect()}
    for i, text in enumerate(TEXTS):
        text = text or ""
        w = re.findall(WORDS.decode(), text)
        windows = collections.Counter(tuple(w[j : j + 8]) for j in range(len(w) - 7))
        covered = {k for j in range(len(w) - 7) if windows[tuple(w[j : j + 8])] > 1 for k in range(j, j + 8)}
        lines = [x for x in text.split("\n") if re.search(WORDS.decode(), x)]
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))
        assert r.base_failed == (len(w) < 20 or 100 * len(covered) > 30 * len(w))
    assert quality.clean(empty).count() == 0


def test_quality_drops_navigation_and_boilerplate_lines(spark):
    text = "Home | News | About | Contact\nThis line is a proper sentence that stays, word for word, as it is written here.\nAll rights reserved."
    r = quality.clean(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert r.text_clean.startswith("This line") and "|" not in r.text_clean and r.kept


def test_language_of_held_out_rows(spark):
    ship_package(spark)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = F.coalesce(language.fold(F.col("doc_id"), 4) == 2, F.lit(False))
    found = language.identify(spark, docs, language.train(spark, docs, ~out)).join(docs, "doc_id").filter(out)
    right = found.filter("lang_pred = lang").count()
    assert right >= 0.97 * found.count()
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 !?")], "doc_id long, text string")
    assert [r.lang_pred for r in language.identify(spark, odd, language.Trees([])).collect()] == ["und"] * 3


def test_code_lengths_follow_the_escape_rule():
    g, n = np.unique(language.grams([b"abab"])[0], return_counts=True)
    trees = language.Trees([("x", g, n)])
    seen = trees.total_bits([b"ab"])[0, 0]  # a after the start: 1 of 1 + 1; b after a: 1 of 1 + 1
    assert seen == pytest.approx(2.0)
    escaped = trees.total_bits([b"z"])[0, 0]  # escapes from four contexts, then 8 bits
    assert escaped == pytest.approx(8 + 3 * 1 + np.log2((4 + 2) / 2))


def test_toxicity_on_held_out_rows(spark):
    ship_package(spark)
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(folder + "/documents.parquet"), spark.read.parquet(folder + "/labels.parquet")
    out = F.coalesce(toxicity.fold(F.col("doc_id")) == 1, F.lit(False))
    machine = toxicity.train(spark, docs, labels, ~out)
    rows = toxicity.score(spark, docs, machine).join(labels, "doc_id").filter(out).select("score", "toxic").collect()
    bad, good = [r.score for r in rows if r.toxic == 1], [r.score for r in rows if r.toxic == 0]
    ranks = np.mean([[x > y for y in good] for x in bad])
    assert ranks > 0.85 and np.mean([s >= 0.7 for s in good]) < 0.05
    assert all(r.score == 0 for r in toxicity.score(spark, docs.limit(3), None).collect())


def test_licences_and_inheritance(spark):
    rows = [
        (1, "a/LICENSE", "Released under the MIT License."), (2, "a/b/x.txt", "nothing here"), (3, "a/b/y.txt", "Licensed under CC BY-NC 4.0.\ntext"),
        (4, "a/b/c/LICENSE-2", "Licensed under the Apache License, Version 2.0."), (5, "a/b/c/d/z", None), (6, "q/r", ""), (7, None, "plain"),
    ]
    files = spark.createDataFrame(rows, "doc_id long, path string, text string")
    got = {r.doc_id: (r.license, r.origin, r.license_dir) for r in licenses.scan(spark, files).collect()}
    assert got[1] == ("MIT", "own", None) and got[2] == ("MIT", "inherited", "a")
    assert got[3] == ("CC-BY-NC-4.0", "own", None) and got[5] == ("Apache-2.0", "inherited", "a/b/c")
    assert got[6] == got[7] == (None, None, None)
    assert licenses.scan(spark, files.limit(0)).count() == 0


def test_pipeline_stages_keep_columns_and_take_effect(spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(folder + "/documents.parquet")
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == columns
        docs = docs.checkpoint()
    texts = [r.text.lower() for r in docs.collect()]
    assert len(texts) == len(set(texts)) and docs.count() > 0


def test_near_copies_stage_takes_pairs_from_80_percent(spark):
    import corpus_pipeline

    texts = []
    for k in range(30):
        words = [f"d{k}w{i}" for i in range(204)]  # 200 shingles
        swapped = 1 + k % 5  # each takes 5 of them: 0.951, 0.905, 0.860, 0.818, 0.778
        texts += [" ".join(words), " ".join(f"d{k}x{i}" if i % 40 == 20 and i < 40 * swapped else w for i, w in enumerate(words))]
    sets = [{tuple(w[j : j + 5]) for j in range(len(w) - 4)} for w in (t.split() for t in texts)]
    same = [len(sets[i] & sets[i + 1]) / len(sets[i] | sets[i + 1]) for i in range(0, 60, 2)]
    assert sum(0.8 <= s < 0.85 for s in same) == sum(s < 0.8 for s in same) == 6
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for percent in (80, 85):
        wanted = [True if i % 2 == 0 else same[i // 2] < percent / 100 for i in range(60)]
        assert {r.doc_id: r.kept for r in neardup.link_copies(spark, docs, percent).collect()} == dict(enumerate(wanted))
    stage = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()}
    assert stage == {i for i in range(60) if i % 2 == 0 or same[i // 2] < 0.8}


def test_bands_and_signatures_follow_the_threshold():
    assert (neardup.rows_per_band(85), neardup.least_shared(85)) == (5, 65)
    assert (neardup.rows_per_band(80), neardup.least_shared(80)) == (4, 57)
    assert all((1 - (p / 100) ** (r := neardup.rows_per_band(p))) ** (100 // r) < 1e-5 for p in range(40, 100))


def test_passages_of_rows_that_share_a_doc_id(spark):
    import corpus_pipeline

    clean, other = " ".join(f"clean{i}" for i in range(60)), " ".join(f"other{i}" for i in range(30))
    rows = [
        (1, PASSAGE), (1, other),
        (2, "start here " + PASSAGE + " and end"), (2, clean),  # one of two rows loses words
        (3, "a b " + PASSAGE), (3, other + " c"), (3, other + " c"),  # all lose words, two are equal
        (4, PASSAGE), (4, clean + " d"),  # nothing is left of one; the other repeats row 2
        (5, "two of " + clean[:200].rsplit(" ", 1)[0] + " in"), (5, " ".join(f"new{i}" for i in range(40))),
        (6, " ".join(f"new{i}" for i in range(40, 80))), (6, " ".join(f"new{i}" for i in range(40, 80)) + " longer"),  # shared by one id only
    ]
    docs = spark.createDataFrame([(i, t, len(t)) for i, t in rows], "doc_id long, text string, n_chars long").repartition(3)
    first = {}
    for i, t in rows:
        w = t.split()
        for j in range(len(w) - 12):
            first[tuple(w[j : j + 13])] = min(i, first.get(tuple(w[j : j + 13]), i))
    wanted, counts = [], []
    for i, t in rows:
        w = t.split()
        gone = {k for j in range(len(w) - 12) if first[tuple(w[j : j + 13])] < i for k in range(j, j + 13)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        counts.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
        wanted += [(i, kept, len(kept))] if kept else []
    assert sorted(map(tuple, substrings.remove_repeats(spark, docs).collect())) == sorted(counts)
    assert sorted(map(tuple, corpus_pipeline.cut_passages(spark, docs, "").collect())) == sorted(wanted)


def test_passage_of_an_id_with_rows_in_several_slices(spark):
    rows = [(1, PASSAGE + " a"), (0, PASSAGE + " b"), (1, "x y " + PASSAGE), (9, "z")]  # two slices; in the first, id 1 comes before id 0
    docs = spark.createDataFrame(spark.sparkContext.parallelize(rows, 2), "doc_id long, text string")
    got = sorted((r.doc_id, r.n_words, r.n_removed) for r in substrings.remove_repeats(spark, docs).collect())
    assert got == [(0, 41, 0), (1, 41, 40), (1, 42, 40), (9, 1, 0)]


def test_two_readings_in_different_orders_find_all_passages(spark, monkeypatch):
    monkeypatch.setattr(substrings, "SLICE", 3)
    texts = {i: f"start{i} {PASSAGE}" for i in range(10)}
    lengths = {i: len(t.split()) for i, t in texts.items()}
    flags = {"docs": np.concatenate([[i] * n for i, n in lengths.items()]).astype(np.int64), "places": np.concatenate([np.arange(n) for n in lengths.values()]).astype(np.int32)}
    names = [f.split()[0] for f in substrings.PLACES.split(", ")]

    def reading(order, windows_only):
        rows = [{"part": 0, "kind": substrings.PLACE} | {k: v.tobytes() for k, v in flags.items()}]
        rows += [{"part": 0, "kind": substrings.TEXT, "doc_id": i, "text": texts[i].encode(), "row": i} for i in order]
        df = spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], substrings.PLACES)
        return list(substrings.windows_sent(1, 13, {}, windows_only)(substrings.by_part(df).toArrow().to_batches()))

    removed = list(substrings.windows_met(1)(reading([3, 8, 1, 6, 0, 9, 4, 2, 7, 5], True))) + reading(range(10), False)
    found = set()
    for row in (r for batch in removed for r in batch.to_pylist() if r["kind"] == substrings.PLACE):
        found |= set(zip(np.frombuffer(row["marks"], np.int64).tolist(), np.frombuffer(row["places"], np.int32).tolist(), strict=True))
    assert found == {(i, k) for i in range(1, 10) for k in range(1, lengths[i] - 12)}


def test_passages_of_texts_that_are_no_valid_utf8(spark):
    raw = [b"\xff " + PASSAGE.encode(), PASSAGE.encode() + b" \xc3", b"\xed\xa0\x80 " * 13]
    docs = spark.createDataFrame(list(enumerate(raw)), "doc_id long, text binary").select("doc_id", F.expr("cast(text AS string)").alias("text"))
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substrings.remove_repeats(spark, docs).collect()}
    assert got == {i: (len(t.split()), gone, hashlib.sha256(b" ".join(kept)).hexdigest())
                   for i, (t, gone, kept) in enumerate([(raw[0], 0, raw[0].split()), (raw[1], 40, [b"\xc3"]), (raw[2], 0, raw[2].split())])}
