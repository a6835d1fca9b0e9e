"""Removal of word passages that an earlier document holds too.

A passage of `width` words that starts in several documents would be a node that deep in the suffix
tree of all documents. No suffix is sent and no tree is built: only the smallest doc_id of such a
passage matters, so hashes of whole windows are sorted in groups. A group is chosen by a prefix of the
window: one word for most, more for frequent ones, up to the whole passage.

Most windows are unique and never sent. Each window of `width` words has an anchor, the
run of `ANCHOR` words of smallest hash in it; equal windows have equal anchors. Anchors that occur in
one document only rule their windows out. Within a slice of documents equal anchors and windows meet
before they are shuffled, so a passage in a third of all documents costs a row per slice.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tanisight.llm.common import (
    as_bytes, by_value, dealt, gram_hashes, group_of, grouped, id_and_text, packed, rows_of, runs_min, signed, slices, small_slices,
    starts_of, word_hashes,
)
from tanisight.session import materialize, ship_package

ANCHOR = 7
PREFIXES = (1, 2, 4)
SLICE = 4000  # documents whose equal anchors and windows meet before they are shuffled
HASHED = 2 << 20  # bytes of text that are hashed at a time
PLACES = "part long, kind long, doc_id long, text binary, hashes binary, docs binary, places binary, marks binary, n_words long, sha string, row long"
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"
CUTS = "row long, cuts binary"
TEXT, PLACE, DONE, WINDOW = 1, 0, 2, 3  # kinds of rows
REST, WINDOWS, ALL_WINDOWS = range(3)  # what windows_sent sends


def row_key(docs: DataFrame):
    """Tells rows apart that share a doc_id: equal only for equal texts."""
    return F.xxhash64(docs["doc_id"].cast("long"), docs["text"].cast("binary"))


class Passages:
    """Anchors and windows of some documents."""

    def __init__(self, ids: np.ndarray, texts: list[bytes], width: int):
        self.ids, self.width = ids, width
        self.hashes, self.offsets = word_hashes(texts)
        self.starts, self.doc = starts_of(self.offsets, width)
        self.anchors = gram_hashes(self.hashes, ANCHOR)
        reach = width - ANCHOR + 1
        least = self.anchors[self.starts] if len(self.starts) else np.zeros(0, np.uint64)
        for j in range(1, reach):
            least = np.minimum(least, self.anchors[self.starts + j])
        self.least, self.reach = least, reach

    def places(self) -> np.ndarray:
        """Where some window has its anchor."""
        chosen = np.zeros(len(self.anchors), bool)
        for j in range(self.reach):
            at = self.starts + j
            chosen[at[self.anchors[at] == self.least]] = True
        return np.flatnonzero(chosen)

    def repeated(self, flagged: np.ndarray) -> np.ndarray:
        """Numbers of the windows whose anchor is flagged (a flag per place)."""
        some = np.zeros(len(self.starts), bool)
        for j in range(self.reach):
            at = self.starts + j
            some |= (self.anchors[at] == self.least) & flagged[at]
        return np.flatnonzero(some)

    def doc_of(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets, places, "right") - 1


def doc_part(ids: np.ndarray, groups: int) -> np.ndarray:
    """The same as PART in Spark."""
    return (ids ^ (ids >> 15)) % groups


def slice_ids(batch) -> np.ndarray:
    return np.array(batch.column("doc_id").to_pylist(), np.int64)


def anchors_of(batch, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, doc_id and place of each anchor, by doc_id."""
    found = []
    for part in small_slices([batch], SLICE, HASHED):
        p = Passages(slice_ids(part), as_bytes(part), width)
        at = p.places()
        doc = p.doc_of(at)
        found.append((p.anchors[at], p.ids[doc], (at - p.offsets[doc]).astype(np.int32)))
    values, ids, places = map(np.concatenate, zip(*found, strict=True))
    order = np.argsort(ids, kind="stable")
    return values[order], ids[order], places[order]


def anchors_sent(groups: int, width: int):
    """Anchors by group; of those in several documents of a slice the first of the smallest doc_id, and all by document."""

    def run(batches):
        for batch in slices(batches, SLICE):
            values, ids, places = anchors_of(batch, width)
            if not len(values):
                continue
            order, begins = by_value(values)
            low, high, run_of = runs_min(ids[order], begins)
            shared = np.zeros(len(values), bool)
            shared[order] = (high > low)[run_of]
            first = np.zeros(len(values), bool)
            first[order[begins]] = True
            yield from dealt(doc_part(ids[shared], groups) + groups, PLACES, PLACE, docs=ids[shared], places=places[shared])
            sent = ~shared | first
            yield from dealt(group_of(values[sent], groups), PLACES, PLACE, hashes=values[sent], docs=ids[sent], places=places[sent])

    return run


def anchors_met(groups: int):
    """Per group of anchors: the places of those in two documents at least, dealt by document."""

    def run(batches):
        for part, rows in grouped(batches):
            docs, places = packed(rows, "docs", np.int64), packed(rows, "places", np.int32)
            if part < groups:
                order, begins = by_value(packed(rows, "hashes", np.uint64))
                low, high, run_of = runs_min(docs[order], begins)
                order = order[(high > low)[run_of]]
                docs, places = docs[order], places[order]
            yield from dealt(doc_part(docs, groups), PLACES, PLACE, docs=docs, places=places)

    return run


def windows_sent(groups: int, width: int, frequent: dict[int, np.ndarray], what: int):
    """Texts meet the flagged places of their anchors.

    Documents without a window that may be repeated are done. The others go on as texts, and, in a
    second reading of the same shuffle, their windows by group; of equal windows of the slice only
    those of the smallest doc_id are sent, the others are known to be removed. Both readings must see
    the same slices: one sends what the other does not hold for removed. With ALL_WINDOWS one reading
    sends both, and no text.
    """

    def run(batches):
        docs = places = order = None
        part = None
        waiting: list[tuple[int, bytes, int]] = []

        def hashed():
            """The waiting documents, some at a time, and the numbers of their windows that may be repeated."""
            ends = np.cumsum([len(t) for _, t, _ in waiting])
            for some in np.split(np.arange(len(waiting)), np.flatnonzero(np.diff(ends // HASHED)) + 1):
                rows = waiting[some[0] : some[-1] + 1]
                p = Passages(np.array([d for d, _, _ in rows], np.int64), [t for _, t, _ in rows], width)
                flagged = np.zeros(len(p.anchors), bool)
                first, last = np.searchsorted(docs, p.ids, "left").tolist(), np.searchsorted(docs, p.ids, "right").tolist()
                for i, (a, b) in enumerate(zip(first, last, strict=True)):
                    at = places[a:b] + p.offsets[i]
                    flagged[at[at < min(p.offsets[i + 1], len(flagged))]] = True
                yield rows, p, p.repeated(flagged)

        def flush():
            found = []
            for rows, p, windows in hashed():
                marks = np.array([m for _, _, m in rows], np.int64)
                if what == REST:
                    some = np.zeros(len(rows), bool)
                    some[p.doc[windows]] = True
                    calm, rest = np.flatnonzero(~some), np.flatnonzero(some)
                    if len(calm):
                        yield rows_of(PLACES, kind=[DONE] * len(calm), part=doc_part(p.ids[calm], groups).tolist(), doc_id=p.ids[calm].tolist(), n_words=np.diff(p.offsets)[calm].tolist(),
                                      sha=[hashlib.sha256(b" ".join(rows[i][1].split())).hexdigest() for i in calm], row=marks[calm].tolist())
                    if len(rest):
                        yield rows_of(PLACES, kind=[TEXT] * len(rest), part=doc_part(p.ids[rest], groups).tolist(), doc_id=p.ids[rest].tolist(), text=[rows[i][1] for i in rest], row=marks[rest].tolist())
                if not len(windows):
                    continue
                at, doc = p.starts[windows], p.doc[windows]
                values = gram_hashes(p.hashes, width)[at]
                keys = prefix_keys(p, at, frequent, values) if what != REST else values
                found.append((values, keys, p.ids[doc], (at - p.offsets[doc]).astype(np.int32), marks[doc]))
            if not found:
                return
            values, keys, own, place, mark = map(np.concatenate, zip(*found, strict=True))
            rank, begins = by_value(values)
            low, _, run_of = runs_min(own[rank], begins)
            later = np.zeros(len(values), bool)
            later[rank] = own[rank] > low[run_of]
            if what != WINDOWS:
                past = groups * (what == ALL_WINDOWS)  # parts past the groups are known already
                yield from dealt(doc_part(own[later], groups) + past, PLACES, PLACE, marks=mark[later], places=place[later])
            if what == REST:
                return
            yield from dealt(group_of(keys[~later], groups), PLACES, WINDOW, hashes=values[~later], docs=own[~later], places=place[~later], marks=mark[~later])

        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                for row in batch.slice(at, SLICE).to_pylist():
                    if row["part"] != part:
                        if waiting:
                            yield from flush()
                        part, waiting, blobs = row["part"], [], []
                        docs, places = np.zeros(0, np.int64), np.zeros(0, np.int32)
                    if row["kind"] == PLACE:
                        blobs.append(row)
                        continue
                    if blobs:
                        docs, places = packed(blobs, "docs", np.int64), packed(blobs, "places", np.int32)
                        order = np.argsort(docs, kind="stable")
                        docs, places, blobs = docs[order], places[order], []
                    waiting.append((row["doc_id"], row["text"] or b"", row["row"]))
                    if len(waiting) >= SLICE:
                        yield from flush()
                        waiting = []
        if waiting:
            yield from flush()

    return run


def prefix_keys(p: Passages, at: np.ndarray, frequent: dict[int, np.ndarray], windows: np.ndarray) -> np.ndarray:
    """Hash of the shortest prefix of each window that is not frequent; the window itself if all are."""
    keys = windows.copy()
    todo = np.arange(len(at))
    for k in PREFIXES:
        own = gram_hashes(p.hashes, k)[at[todo]]
        common = np.isin(own, frequent.get(k, np.zeros(0, np.uint64)))
        keys[todo[~common]] = own[~common]
        todo = todo[common]
    return keys


def frequent_prefixes(docs: DataFrame, width: int, share: float, sample: int) -> dict[int, np.ndarray]:
    """Prefixes that start more than `share` of the windows of about `sample` documents.

    At most 1 / share per length. They only decide how suffixes are grouped, not what is found.
    """
    n = docs.count()
    rate = min(1.0, sample / max(n, 1))
    some = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(rate * (1 << 20)) + 1)

    def count(batches):
        for batch in small_slices(batches, SLICE, HASHED):
            p = Passages(slice_ids(batch), as_bytes(batch), width)
            for k in PREFIXES:
                found, counts = np.unique(gram_hashes(p.hashes, k)[p.starts], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([k] * len(found)), pa.array(signed(found)), pa.array(counts)], ["k", "h", "n"])

    counts = materialize(some.mapInArrow(count, "k long, h long, n long").groupBy("k", "h").agg(F.sum("n").alias("n")))
    totals = {r.k: r.n for r in counts.groupBy("k").agg(F.sum("n").alias("n")).collect()}
    often = F.lit(False)
    for k, n in totals.items():
        often = often | ((F.col("k") == k) & (F.col("n") > n * share))
    rows = counts.filter(often).collect()
    return {k: np.array(sorted(r.h for r in rows if r.k == k), np.int64).view(np.uint64) for k in PREFIXES}


def windows_met(groups: int):
    """Per subtree: windows that start in a document with a smaller doc_id too, dealt by document."""

    def run(batches):
        for part, rows in grouped(batches):
            if part >= groups:
                yield rows_of(PLACES, part=[part - groups], kind=[PLACE], marks=[b"".join(r["marks"] for r in rows)], places=[b"".join(r["places"] for r in rows)])
                continue
            order, begins = by_value(packed(rows, "hashes", np.uint64))
            docs, places, marks = packed(rows, "docs", np.int64)[order], packed(rows, "places", np.int32)[order], packed(rows, "marks", np.int64)[order]
            low, _, run_of = runs_min(docs, begins)
            later = docs > low[run_of]
            yield from dealt(doc_part(docs[later], groups), PLACES, PLACE, marks=marks[later], places=places[later])

    return run


def cut_out(width: int, with_text: bool):
    """Texts meet the places of their removed windows, each row its own."""

    def run(batches):
        part, blobs = None, []
        marks, places = np.zeros(0, np.int64), np.zeros(0, np.int32)
        for batch in slices(batches, SLICE):
            out = []
            for row in batch.to_pylist():
                if row["part"] != part:
                    part, blobs = row["part"], []
                    marks, places = np.zeros(0, np.int64), np.zeros(0, np.int32)
                if row["kind"] == PLACE:
                    blobs.append(row)
                    continue
                if row["kind"] == DONE:
                    out.append((row["doc_id"], row["n_words"], 0, row["sha"], None, row["row"]))
                    continue
                if blobs:
                    marks, places = packed(blobs, "marks", np.int64), packed(blobs, "places", np.int32)
                    order = np.argsort(marks, kind="stable")
                    marks, places, blobs = marks[order], places[order], []
                words = (row["text"] or b"").split()
                a, b = np.searchsorted(marks, row["row"], "left"), np.searchsorted(marks, row["row"], "right")
                steps = np.zeros(len(words) + 1, np.int64)
                at = places[a:b]
                at = at[at + width <= len(words)]
                np.add.at(steps, at, 1)
                np.add.at(steps, at + width, -1)
                stay = np.cumsum(steps[:-1]) == 0
                kept = b" ".join(words[i] for i in np.flatnonzero(stay)) if not stay.all() else b" ".join(words)
                out.append((row["doc_id"], len(words), int((~stay).sum()), hashlib.sha256(kept).hexdigest(), None if stay.all() else kept.decode("utf-8", "replace"), row["row"]))
            if out:
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()][: 6 if with_text else 4]
                columns = [pa.array(c, kind) for c, kind in zip(zip(*out, strict=True), kinds, strict=False)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_removed", "kept_sha256", "text_kept", "row"][: len(columns)])

    return run


def by_part(df: DataFrame) -> DataFrame:
    """Rows by part and kind. Documents are in one order, so that both readings in windows_sent make the same slices,
    in whatever order a shuffle is fetched."""
    return df.repartition("part").sortWithinPartitions("part", "kind", "doc_id", "row")


def cuts_met(width: int):
    """The removed windows of each row as runs of words: begin and end of each."""

    def run(batches):
        for _, rows in grouped(batches):
            marks, places = packed(rows, "marks", np.int64), packed(rows, "places", np.int32)
            order = np.lexsort((places, marks))
            marks, places = marks[order], places[order]
            fresh = np.append(True, marks[1:] != marks[:-1])[: len(marks)]
            opens = np.flatnonzero(fresh | np.append(True, places[1:] > places[:-1] + width)[: len(marks)])
            closes = np.append(opens[1:], len(marks))[: len(opens)] - 1
            runs = np.stack([places[opens], places[closes] + width], 1).astype(np.int32)
            begins = np.flatnonzero(fresh[opens])
            ends = np.append(begins[1:], len(opens))
            yield pa.RecordBatch.from_arrays(
                [pa.array(marks[opens[begins]]), pa.array([runs[a:b].tobytes() for a, b in zip(begins, ends, strict=False)], pa.binary())], ["row", "cuts"])

    return run


def cut_words(text: bytes, cuts: bytes) -> bytes:
    """The words outside the runs, joined by one space."""
    words, kept, at = text.split(), [], 0
    for a, b in np.frombuffer(cuts, np.int32).reshape(-1, 2).tolist():
        kept += words[at:a]
        at = b
    return b" ".join(kept + words[at:])


def met_texts(known: DataFrame, groups: int, width: int) -> DataFrame:
    """Texts by part, after the places of their anchors that occur in several documents."""
    anchors = known.mapInArrow(anchors_sent(groups, width), PLACES)
    flagged = by_part(anchors).mapInArrow(anchors_met(groups), PLACES)
    texts = known.select(
        F.pmod(F.col("doc_id").bitwiseXOR(F.shiftright("doc_id", 15)), F.lit(groups)).alias("part"),
        F.lit(TEXT).cast("long").alias("kind"), "doc_id", F.col("text").cast("binary").alias("text"),
        *[F.lit(None).cast("binary").alias(c) for c in ("hashes", "docs", "places", "marks")],
        F.lit(None).cast("long").alias("n_words"), F.lit(None).cast("string").alias("sha"), row_key(known).alias("row"))
    return by_part(texts.union(flagged))


def repeats(spark: SparkSession, docs: DataFrame, width: int = 13, share: float = 0.002, sample: int = 2000) -> DataFrame:
    """row (the row_key) and cuts (runs of words, for cut_words) of the rows from which remove_repeats takes words.

    No text is sent on to be cut: whoever holds the rows joins them with their runs.
    """
    ship_package(spark)
    groups = int(spark.conf.get("spark.sql.shuffle.partitions"))
    known = id_and_text(docs).filter("doc_id is not null")
    frequent = frequent_prefixes(known, width, share, sample)
    windows = met_texts(known, groups, width).mapInArrow(windows_sent(groups, width, frequent, ALL_WINDOWS), PLACES)
    return by_part(by_part(windows).mapInArrow(windows_met(groups), PLACES)).mapInArrow(cuts_met(width), CUTS)


def remove_repeats(spark: SparkSession, docs: DataFrame, width: int = 13, with_text: bool = False, share: float = 0.002, sample: int = 2000) -> DataFrame:
    """Per document: n_words, n_removed and the digest of the words that stay.

    A word goes if a window of `width` words that covers it also starts in a document with a smaller
    doc_id; windows are judged on the input. Words are runs of other than ASCII white space.
    with_text adds text_kept, the staying words with one space between; it is null where nothing
    goes; and row, the row_key of the row.

    Null and empty text, or fewer words than `width`: nothing goes. Rows that repeat a doc_id are one
    document for the judgement, and each loses its own places. Null doc_ids are left out of it: nothing goes. An empty table gives
    no rows.
    """
    ship_package(spark)
    groups = int(spark.conf.get("spark.sql.shuffle.partitions"))
    known = id_and_text(docs).filter("doc_id is not null")
    frequent = frequent_prefixes(known, width, share, sample)
    met = met_texts(known, groups, width)
    windows = met.mapInArrow(windows_sent(groups, width, frequent, WINDOWS), PLACES)
    rest = met.mapInArrow(windows_sent(groups, width, frequent, REST), PLACES)
    removed = by_part(windows).mapInArrow(windows_met(groups), PLACES)
    schema = RESULT + ", text_kept string, row long" * with_text
    cut = by_part(rest.union(removed)).mapInArrow(cut_out(width, with_text), schema)
    nothing = [F.lit(0).cast("long").alias("n_removed"), "sha", *[F.lit(None).cast("string").alias("text_kept"), F.lit(None).cast("long").alias("row")] * with_text]
    nameless = id_and_text(docs).filter("doc_id is null").mapInArrow(untouched, "doc_id long, n_words long, sha string").select("doc_id", "n_words", *nothing)
    return cut.union(nameless)


def untouched(batches):
    for batch in small_slices(batches, SLICE, HASHED):
        words = [t.split() for t in as_bytes(batch)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").cast(pa.int64()), pa.array(list(map(len, words)), pa.int64()), pa.array([hashlib.sha256(b" ".join(w)).hexdigest() for w in words])],
            ["doc_id", "n_words", "sha"])
