"""Similarity join of word shingle sets with adaptive multi-match prefixes.

All shingles stand in one order, rare ones first (by a table of counts over all documents, then by hash). Two
sets of at least `percent` Jaccard similarity share so much that among the first |x| - need + m shingles of
either at least m are common, for any m. Each document lengthens its prefix (a larger m) as long as the
estimated cost of its candidates falls: longer prefixes are read, but fewer documents share m of their
shingles. A document of whose prefix too few shingles occur in any other prefix has no partner. Others meet at
the shingles of their prefixes; a pair is confirmed on whole sets only if the prefixes share as many shingles
as the smaller m of both.

Documents of equal sets are one node. The answer asks for connected documents, so the nodes of a long list are
first joined with its most central one, and what is left apart by differences from a centre (closeness).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tanisight.llm.common import (
    as_bytes, by_value, dealt, group_of, grouped, id_and_text, mix, packed, runs_min, signed, small_slices, written,
)
from tanisight.llm.neardup import Links, leaders, rest_of_links, sets_from, shingle_sets
from tanisight.session import ship_package

SHINGLE = 4
TABLE = 20  # bits of a shingle's place in the table of counts
PIECE = 1024  # counts in a row on their way to the driver
DESCRIBED = "doc_id long, n_shingles long, s1 long, s2 long, piece int, counts binary"
LISTED = "bucket long, s1 long"
PACKED = "part long, kind long, hashes binary, docs binary"
NODES = "node long, n_shingles long, signature binary"


def identity(shingles: np.ndarray) -> tuple[int, int]:
    """Two sums that tell sets apart; 0, 0 of an empty one."""
    return tuple(int(signed(mix(shingles ^ np.uint64(salt)).sum(keepdims=True))[0]) if len(shingles) else 0 for salt in (0, 0x5851F42D4C957F2D))


def need(n, percent: int):
    """Shingles that a set of n shares at least with any set that it is linked with."""
    return -(-percent * n // 100)


def place(hashes: np.ndarray) -> np.ndarray:
    return (mix(hashes) >> np.uint64(64 - TABLE)).astype(np.int64)


def describe(batches):
    """Size and identity of each document's set; at a task's end the counts of its shingles, in pieces."""
    counts = np.zeros(1 << TABLE, np.int64)
    for batch in small_slices(batches):
        sets = shingle_sets(as_bytes(batch), SHINGLE)
        counts += np.bincount(place(np.concatenate(sets)), minlength=len(counts))
        s1, s2 = zip(*map(identity, sets), strict=True)
        n = batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").cast(pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()),
             pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], ["doc_id", "n_shingles", "s1", "s2", "piece", "counts"])
    rows = counts.reshape(-1, PIECE)
    some = np.flatnonzero(rows.any(1))
    yield pa.RecordBatch.from_arrays(
        [*[pa.nulls(len(some), pa.int64()) for _ in range(4)], pa.array(some.astype(np.int32)), pa.array([rows[k].tobytes() for k in some], pa.binary())],
        ["doc_id", "n_shingles", "s1", "s2", "piece", "counts"])


def shingle_counts(described: DataFrame) -> np.ndarray:
    """The table of counts over all documents; its size does not depend on the data."""

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, data in zip(batch.column("piece").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                total[k] = total.get(k, 0) + np.frombuffer(data, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], ["piece", "counts"])

    out = np.zeros(1 << TABLE, np.int32)
    pieces = described.filter("piece is not null").select("piece", "counts").repartition("piece")
    for row in pieces.mapInArrow(add, "piece int, counts binary").toLocalIterator():
        out[row.piece * PIECE : (row.piece + 1) * PIECE] = np.minimum(np.frombuffer(row.counts, np.int64), 2**31 - 1)
    return out


def ordered(shingles: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shingles, rare ones first, and their counts."""
    held = counts[place(shingles)]
    order = np.lexsort((shingles, held))
    return shingles[order], held[order]


def least_matches(n: int) -> int:
    """No set of n has a smaller m."""
    return max(1, n // 10)


def matches(held: np.ndarray, percent: int, noise: float) -> int:
    """The m of least estimated cost, from the counts of a set's shingles in order.

    Reading a prefix costs the lengths of its lists, and a row each. A candidate that shares m shingles stands in
    m of the lists, so there are at most as many candidates as their lengths over m; each costs a comparison.
    """
    n, least = len(held), need(len(held), percent)
    read = np.cumsum(np.maximum(held - noise, 0) + 1)
    best, m = None, least_matches(n)
    while m <= least:
        total = float(read[n - least + m - 1])
        cost = total + total / m * (1 + n / 16)
        if best is not None and cost >= best[0]:
            break
        best, m = (cost, m), 2 * m
    return best[1]


def prefix(shingles: np.ndarray, counts: np.ndarray, percent: int, noise: float) -> tuple[int, np.ndarray, np.ndarray]:
    """m of a set, the shingles of its prefix and their counts."""
    some, held = ordered(shingles, counts)
    m = matches(held, percent, noise)
    size = len(some) - need(len(some), percent) + m
    return m, some[:size], held[:size]


def list_nodes(table, percent: int, noise: float, hot: float, groups: int):
    """Shingles of the prefixes, dealt to groups; those held by very many documents go straight to the lists (kind 1)."""

    def run(batches):
        counts = table.value
        for batch in small_slices(batches, 1000):
            seen, hashes, ids, often = set(), [], [], []
            for s in shingle_sets(as_bytes(batch), SHINGLE):
                own = identity(s)[0]
                if len(s) and own not in seen:
                    seen.add(own)
                    _, some, held = prefix(s, counts, percent, noise)
                    hashes.append(some)
                    often.append(held >= hot)
                    ids.append(np.full(len(some), own, np.int64))
            if hashes:
                hashes, ids, often = np.concatenate(hashes), np.concatenate(ids), np.concatenate(often)
                for kind, chosen in ((0, ~often), (1, often)):
                    yield from dealt(group_of(hashes[chosen], groups), PACKED, kind, hashes=hashes[chosen], docs=ids[chosen])

    return run


def meet(batches):
    """(shingle, set) of the shingles that several sets hold in their prefixes."""
    for _, rows in grouped(batches):
        sent, sure = ([r for r in rows if r["kind"] == k] for k in (0, 1))
        order, begins = by_value(packed(sent, "hashes", np.uint64))
        if len(order):
            hashes, ids = packed(sent, "hashes", np.uint64)[order], packed(sent, "docs", np.int64)[order]
            low, high, run_of = runs_min(ids, begins)
            met = (high > low)[run_of]
            yield pa.RecordBatch.from_arrays([pa.array(signed(hashes[met])), pa.array(ids[met])], ["bucket", "s1"])
        for r in sure:
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(r["hashes"], np.int64)), pa.array(np.frombuffer(r["docs"], np.int64))], ["bucket", "s1"])


def describe_nodes(table, percent: int, noise: float):
    """Size of each node's set, and its prefix (sorted, with m before it)."""

    def run(batches):
        for batch in small_slices(batches):
            sets = [s for s in shingle_sets(as_bytes(batch), SHINGLE)]
            signs = [None] * len(sets)
            for i, s in enumerate(sets):
                if len(s):
                    m, some, _ = prefix(s, table.value, percent, noise)
                    signs[i] = m.to_bytes(8, "little") + np.sort(some).tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(signs, pa.binary())],
                ["node", "n_shingles", "signature"])

    return run


def share_enough(batches):
    """Pairs whose prefixes share as many shingles as the smaller m; n: the share of the shorter prefix, in thousandths."""
    for batch in batches:
        a = [np.frombuffer(x, np.uint64) for x in batch.column("sign_a").to_pylist()]
        b = [np.frombuffer(x, np.uint64) for x in batch.column("sign_b").to_pylist()]
        same = np.array([np.intersect1d(x[1:], y[1:], assume_unique=True).size for x, y in zip(a, b, strict=True)], np.int64)
        least = np.array([min(int(x[0]), int(y[0])) for x, y in zip(a, b, strict=True)], np.int64)
        shorter = np.array([min(len(x), len(y)) - 1 for x, y in zip(a, b, strict=True)], np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(1000 * same // np.maximum(shorter, 1))], ["a", "b", "n"]).filter(
            pa.array(same >= least))


def join_documents(spark: SparkSession, docs: DataFrame, percent: int = 85, group_bytes: int = 16 << 20) -> DataFrame:
    """Per row: doc_id, n_shingles and component_id, the smallest doc_id that links lead to (itself without any).

    A-Z are lower-cased; words are runs of other than ASCII white space; a set holds the distinct 4-word
    shingles, or the whole sequence of fewer words. Rows are linked when 100 * intersection >= percent * union.
    Null and empty text: an empty set, linked with nothing. Null doc_id: linked with nothing, component null.
    Rows that repeat a doc_id are one node. An empty table gives no rows. Shingles are compared as 64-bit hashes.
    """
    ship_package(spark)
    texts = id_and_text(docs)
    described = written(texts.mapInArrow(describe, DESCRIBED), "described")
    counts = shingle_counts(described)
    table = spark.sparkContext.broadcast(counts)
    rows = described.filter("piece is null").select("doc_id", "n_shingles", "s1", "s2")
    linked = rows.filter("n_shingles > 0 and doc_id is not null")
    classes = written(linked.groupBy("s1", "s2").agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("n_shingles")), "classes")
    mean = float(counts.mean(dtype=np.float64))
    noise, hot = mean + 4 * mean**0.5, 2 * mean + 100_000
    total = classes.agg(F.sum(F.col("n_shingles") * (110 - percent) / 100 + 1)).first()[0] or 0
    groups = int(16 * total / group_bytes) + 1
    named = texts.filter("doc_id is not null")
    dealt_out = named.mapInArrow(list_nodes(table, percent, noise, hot, groups), PACKED).repartition("part").sortWithinPartitions("part")
    lists = written(dealt_out.mapInArrow(meet, LISTED).distinct(), "lists")
    fewest = F.greatest(F.floor(F.ceil(F.col("n_shingles") * percent / 100) / 10), F.lit(1))  # the least m of any set that can be linked
    able = lists.groupBy("s1").agg(F.count("*").alias("met")).join(classes, "s1").filter(F.col("met") >= fewest).select("s1", "node")
    members = lists.join(able, "s1").select("bucket", "node")
    sizes = members.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
    members = written(members.join(sizes, "bucket"), "members")
    remake = sets_from(named, SHINGLE)
    ids = written(members.select(F.col("node").alias("doc_id")).distinct(), "ids")
    nodes = written(named.join(ids, "doc_id", "left_semi").mapInArrow(describe_nodes(table, percent, noise), NODES).filter("n_shingles > 0"), "nodes")
    company = members.groupBy("node").agg(F.sum("size").alias("company"))
    links = Links(nodes, percent, share_enough, remake)
    edges = links.of(leaders(members.join(company, "node"), F.struct(-F.col("company"), "node")), few=True)
    edges, labels = rest_of_links(links, members.select("node", "bucket"), nodes, edges)
    whole = classes.join(labels, "node", "left").select("s1", "s2", F.coalesce("component", "node").alias("component"))
    some = linked.join(whole, ["s1", "s2"]).select("doc_id", "n_shingles", F.col("component").alias("component_id"))
    none = rows.filter("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return some.union(none)
