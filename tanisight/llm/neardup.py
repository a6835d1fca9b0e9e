"""Near duplicates by min-max hashing of word shingles, with links confirmed on whole sets.

Each permutation of the shingle hashes gives two values of a set, its minimum and its maximum, so a
signature of 2 K values takes K evaluations. Rows of the signature form bands; sets that agree in a
band meet in a bucket. Documents of equal sets are one node. Links are sought in steps, so that no
bucket emits all its pairs: each member with the bucket's smallest node; then, where a bucket still
holds nodes of different components, a node with fewer than `percent` of its shingles in any other
such node cannot link at all, and the rest is joined by its differences from a centre (closeness).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tanisight.llm import closeness
from tanisight.llm.common import (
    as_bytes, by_value, dealt, gram_hashes, group_of, grouped, id_and_text, mix, packed, runs_min, signed, slices, small_slices, starts_of, word_hashes,
    written,
)
from tanisight.session import materialize, scratch_path, ship_package

SHINGLE = 5
PERMUTATIONS = 50
MISSED = 1e-5  # of the pairs at the threshold, the share that may agree in no band
PACKED = "part long, kind long, hashes binary, docs binary"
SHINGLES = "node long, shingles binary"
SETS = "doc_id long, n_shingles long, s1 long, s2 long, bands array<long>, signature binary"


def rows_per_band(percent: int) -> int:
    """The most values a band can have so that all bands miss a pair at the threshold with a probability under MISSED."""
    size, p = 2 * PERMUTATIONS, percent / 100
    return max((r for r in range(1, size + 1) if size % r == 0 and (1 - p**r) ** (size // r) < MISSED), default=1)


def least_shared(percent: int) -> int:
    """Equal values of two signatures, below which a pair at the threshold would be 5.6 standard deviations off."""
    size, p = 2 * PERMUTATIONS, percent / 100
    return max(0, int(size * p - 5.6 * (size * p * (1 - p)) ** 0.5))


def multipliers() -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(20240229)
    return random.integers(0, 1 << 63, PERMUTATIONS).astype(np.uint64) * np.uint64(2) + np.uint64(1), random.integers(0, 1 << 63, PERMUTATIONS).astype(np.uint64)


def shingle_sets(texts: list[bytes], size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text of fewer words is one shingle."""
    hashes, offsets = word_hashes(texts, lower=True)
    at, doc = starts_of(offsets, size)
    grams = gram_hashes(hashes, size)[at] if len(at) else np.zeros(0, np.uint64)
    ends = np.searchsorted(doc, np.arange(len(texts) + 1))
    out = []
    for i, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)):
        if b > a:
            out.append(np.unique(grams[a:b]))
            continue
        words = hashes[offsets[i] : offsets[i + 1]]
        digest = hashlib.blake2b(words.tobytes(), digest_size=8).digest()
        out.append(np.frombuffer(digest, np.uint64) if len(words) else np.zeros(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Minimum and maximum of each non-empty set under each permutation, one row per set."""
    a, b = multipliers()
    values = np.concatenate(sets)
    begins = np.append(0, np.cumsum([len(s) for s in sets[:-1]])).astype(np.int64)
    out = np.empty((2 * PERMUTATIONS, len(sets)), np.uint64)
    for k in range(PERMUTATIONS):
        moved = values * a[k] + b[k]
        out[2 * k] = np.minimum.reduceat(moved, begins)
        out[2 * k + 1] = np.maximum.reduceat(moved, begins)
    return out.T


def describe(rows: int):
    """Size, identity, bands and signature of each document's set; copies in a slice carry no bands. rows: values per band."""

    def run(batches):
        numbers = np.arange(2 * PERMUTATIONS // rows, dtype=np.uint64)
        for batch in small_slices(batches):
            docs = batch.column("doc_id").to_pylist()
            sets = shingle_sets(as_bytes(batch))
            identity = [(int(signed(mix(s).sum(keepdims=True))[0]), int(signed(mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(keepdims=True))[0])) if len(s) else (0, 0) for s in sets]
            first: dict = {}
            for i, doc in enumerate(docs):
                if len(sets[i]) and doc is not None and (identity[i] not in first or doc < docs[first[identity[i]]]):
                    first[identity[i]] = i
            bands: list = [None] * len(docs)
            marks: list = [None] * len(docs)
            if chosen := sorted(first.values()):
                signs = signatures([sets[i] for i in chosen])
                keys = numbers[None, :].repeat(len(chosen), 0)
                for r in range(rows):
                    keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) ^ signs[:, r::rows])
                for i, key, sign in zip(chosen, keys, signs, strict=True):
                    bands[i], marks[i] = signed(key), (mix(sign) >> np.uint64(48)).astype(np.uint16).tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array([x for x, _ in identity], pa.int64()),
                 pa.array([x for _, x in identity], pa.int64()), pa.array(bands, pa.list_(pa.int64())), pa.array(marks, pa.binary())],
                ["doc_id", "n_shingles", "s1", "s2", "bands", "signature"])

    return run


def whole_sets(size: int):
    def run(batches):
        for batch in small_slices(batches):
            sets = shingle_sets(as_bytes(batch), size)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], ["node", "shingles"])

    return run


def alike(least: int):
    """Pairs whose signatures share enough values to be looked at."""

    def run(batches):
        for batch in batches:
            a = [np.frombuffer(x, np.uint16) for x in batch.column("sign_a").to_pylist()]
            b = [np.frombuffer(x, np.uint16) for x in batch.column("sign_b").to_pylist()]
            same = np.array([int((x == y).sum()) for x, y in zip(a, b, strict=True)], np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(same)], ["a", "b", "n"]).filter(pa.array(same >= least))

    return run


def confirm(percent: int):
    def run(batches):
        for batch in slices(batches, 500):
            keep = []
            for x, y in zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = np.intersect1d(x, y, assume_unique=True).size
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


class Links:
    """Confirms candidate pairs of nodes on their whole sets.

    nodes: node, n_shingles, signature. check: which pairs of signatures are worth it (a, b, n: how alike).
    sets: from the ids (doc_id) of the nodes in question to their shingles.
    """

    def __init__(self, nodes: DataFrame, percent: int, check, sets):
        self.nodes, self.percent, self.check, self.sets = nodes, percent, check, sets

    def of(self, pairs: DataFrame, few: bool = False) -> DataFrame:
        """few: of each a's candidates, only the smallest and the likeliest."""
        sizes = self.nodes.select("node", "n_shingles", "signature")
        a, b = (sizes.select(F.col("node").alias(x), F.col("n_shingles").alias("n_" + x), F.col("signature").alias("sign_" + x)) for x in "ab")
        fits = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * self.percent
        near = pairs.distinct().join(a, "a").join(b, "b").filter(fits)
        near = near.select("a", "b", "sign_a", "sign_b").mapInArrow(self.check, "a long, b long, n long")
        if few:
            best = near.groupBy("a").agg(F.array_distinct(F.array(F.min("b"), F.max_by("b", F.struct("n", "b")))).alias("b"))
            near = best.select("a", F.explode("b").alias("b"))
        near = written(near.select("a", "b"), "near")
        sets = self.sets(written(near.select(F.col("a").alias("doc_id")).union(near.select("b")).distinct(), "wanted"))
        a, b = (sets.select(F.col("node").alias(x), F.col("shingles").alias("set_" + x)) for x in "ab")
        return written(near.join(a, "a").join(b, "b").mapInArrow(confirm(self.percent), "a long, b long").distinct(), "links")


def sets_from(docs: DataFrame, size: int = SHINGLE):
    """Makes the sets of the wanted ids again from the texts."""

    def make(wanted: DataFrame) -> DataFrame:
        return written(docs.join(wanted, "doc_id", "left_semi").mapInArrow(whole_sets(size), SHINGLES), "sets")

    return make


def shared_shingles(sets: DataFrame, group_bytes: int = 16 << 20) -> DataFrame:
    """node, n_shared: how many of its shingles another of the nodes holds too. Nodes with none are left out.

    Shingles are dealt to groups of about group_bytes. A shingle that several nodes of a task's slice hold is
    counted there and sent on once, so a common one sends a row per slice.
    """
    total = sets.agg(F.sum(F.octet_length("shingles"))).first()[0] or 0
    groups = max(1, -(-2 * total // group_bytes))

    def send(batches):
        for batch in slices(batches, 2000):
            own = [np.frombuffer(x, np.uint64) for x in batch.column("shingles").to_pylist()]
            hashes = np.concatenate(own)
            ids = np.repeat(batch.column("node").to_numpy(), [len(x) for x in own])
            order, begins = by_value(hashes)
            hashes, ids = hashes[order], ids[order]
            low, high, run_of = runs_min(ids, begins)
            here = (high > low)[run_of]
            found, n = np.unique(ids[here], return_counts=True)
            yield from dealt(group_of(found, groups), PACKED, 1, hashes=n.astype(np.uint64), docs=found)
            stands = begins[high > low]  # the first of those counted here stands for all of them
            yield from dealt(group_of(hashes[stands], groups), PACKED, 2, hashes=hashes[stands], docs=ids[stands])
            yield from dealt(group_of(hashes[~here], groups), PACKED, 0, hashes=hashes[~here], docs=ids[~here])

    def meet(batches):
        for _, rows in grouped(batches):
            sent, stands, done = ([r for r in rows if r["kind"] == k] for k in (0, 2, 1))
            hashes, docs = packed(sent + stands, "hashes", np.uint64), packed(sent + stands, "docs", np.int64)
            if len(hashes):
                open_ = np.arange(len(hashes)) < len(packed(sent, "docs", np.int64))  # not counted yet
                order, begins = by_value(hashes)
                docs, open_ = docs[order], open_[order]
                low, high, run_of = runs_min(docs, begins)
                met = ((high > low) | ~np.logical_and.reduceat(open_, begins))[run_of]
                found, n = np.unique(docs[met & open_], return_counts=True)
                yield from dealt(group_of(found, groups), PACKED, 1, hashes=n.astype(np.uint64), docs=found)
            if done:
                docs = packed(done, "docs", np.int64)
                yield from dealt(group_of(docs, groups), PACKED, 1, hashes=packed(done, "hashes", np.uint64), docs=docs)

    def add(batches):
        for _, rows in grouped(batches):
            found, where = np.unique(packed(rows, "docs", np.int64), return_inverse=True)
            total = np.bincount(where, packed(rows, "hashes", np.uint64).astype(np.float64), len(found))
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total.astype(np.int64))], ["node", "n_shared"])

    own = sets
    for step in (send, meet):
        own = own.mapInArrow(step, PACKED).repartition("part").sortWithinPartitions("part")
    return own.mapInArrow(add, "node long, n_shared long")


def components(links: DataFrame) -> DataFrame:
    """node, component: the smallest node that links lead to. Only nodes with links.

    Each round takes the smallest label around a node and then that label's own label.
    """
    ends = links.select(F.explode(F.array("a", "b")).alias("node"), F.array("a", "b").alias("of"))
    both = materialize(ends.select("node", F.explode("of").alias("other")).distinct())  # with a loop at each node
    labels = both.groupBy("node").agg(F.min("other").alias("label"))
    while True:
        labels = materialize(labels)
        seen = both.join(labels.withColumnRenamed("node", "other"), "other").groupBy("node").agg(
            F.min("label").alias("near"), F.max(F.when(F.col("node") == F.col("other"), F.col("label"))).alias("old"))
        jump = labels.select(F.col("node").alias("near"), F.col("label").alias("far"))
        after = materialize(seen.join(jump, "near").select("node", "old", F.col("far").alias("label")))
        if after.filter("label < old").isEmpty():
            return after.select("node", F.col("label").alias("component"))
        labels = after.select("node", "label")


def rest_of_links(links: Links, members: DataFrame, nodes: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(edges, labels) with all links between members of a bucket, given those found so far.

    Of the nodes in buckets of several components, those stay that share enough shingles with others of them.
    """
    labels = components(edges)
    left = written(apart(members, labels), "apart")
    if left.isEmpty():
        return edges, labels
    sets = links.sets(written(left.select(F.col("node").alias("doc_id")).distinct(), "ids"))
    shared = shared_shingles(sets).join(nodes.select("node", "n_shingles"), "node")
    able = shared.filter(F.col("n_shared") * 100 >= F.col("n_shingles") * links.percent).select("node").distinct()
    left = written(apart(left.select("node", "bucket").join(able, "node"), labels).select("bucket", "node"), "apart")
    if left.isEmpty():
        return edges, labels
    links.sets = lambda wanted: sets.join(wanted.withColumnRenamed("doc_id", "node"), "node", "left_semi")
    return closeness.resolve(links, left, sets, edges, labels, components)


def link_copies(spark: SparkSession, docs: DataFrame, percent: int = 85) -> DataFrame:
    """Per document: n_shingles, component_id (smallest doc_id that links lead to) and kept.

    A-Z are lower-cased; words are runs of other than ASCII white space; a set holds the distinct
    5-word shingles, or the whole sequence of fewer words. Documents are linked when
    100 * intersection >= percent * union. Null and empty text: an empty set, linked with nothing.
    Null doc_id: linked with nothing, kept, component null. Rows that repeat a doc_id are one node.
    An empty table gives no rows.
    """
    ship_package(spark)
    folder = scratch_path(spark, "sets")
    id_and_text(docs).mapInArrow(describe(rows_per_band(percent)), SETS).write.parquet(folder)
    sets = spark.read.schema(SETS).parquet(folder)
    linked = sets.filter("n_shingles > 0 and doc_id is not null")
    classes = linked.groupBy("s1", "s2").agg(F.min("doc_id").alias("node"))
    bearers = linked.filter("bands is not null").groupBy("s1", "s2").agg(
        F.min_by(F.struct("doc_id", "n_shingles", "bands", "signature"), "doc_id").alias("x"))
    nodes = materialize(bearers.select(F.col("x.doc_id").alias("node"), "x.n_shingles", "x.bands", "x.signature"))
    members = nodes.select("node", F.explode("bands").alias("bucket"))
    full = members.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").select("bucket")
    members = materialize(members.join(full, "bucket"))
    remake = sets_from(id_and_text(docs).filter("doc_id is not null"))
    links = Links(nodes, percent, alike(least_shared(percent)), remake)
    edges = links.of(leaders(members, F.col("node")), few=True)
    edges, labels = rest_of_links(links, members.select("node", "bucket"), nodes, edges)
    whole = classes.join(labels, "node", "left").select("s1", "s2", F.coalesce("component", "node").alias("component"))
    some = linked.select("doc_id", "n_shingles", "s1", "s2").join(whole, ["s1", "s2"]).select("doc_id", "n_shingles", "component")
    none = sets.filter("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component"))
    return some.union(none).select(
        "doc_id", "n_shingles", F.col("component").alias("component_id"), F.coalesce(F.col("doc_id") == F.col("component"), F.lit(True)).alias("kept"))


def apart(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members, with their components, of the buckets that hold several components."""
    own = members.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    span = own.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return own.join(span.filter("low < high").select("bucket"), "bucket")


def leaders(members: DataFrame, order) -> DataFrame:
    """Pairs of every bucket member with the bucket's first node in the order."""
    first = members.groupBy("bucket").agg(F.min_by("node", order).alias("first"))
    return members.join(first, "bucket").filter("node <> first").select(F.col("node").alias("a"), F.col("first").alias("b"))
