"""Links among nodes that meet in large buckets, without looking at all their pairs.

Buckets with the same most central node form a family. A family's centre C is the set of shingles that more
than half of its members hold; a member X is sent as its difference d(X) from C. For two members the sets
differ in |d(X)| + |d(Y)| - 2 |d(X) and d(Y)| shingles, so with

    f(X) = (100 + p) |d(X)| - (100 - p) |X|     (p: percent of shared shingles from which sets are linked)

X and Y are linked exactly when f(X) + f(Y) <= 2 (100 + p) |d(X) and d(Y)|. The member A of smallest f is
hence linked with every member with f <= -f(A), without a comparison; any other link needs common elements
of the differences, at least so many that both meet at one of their first elements in a common order (prefix
filtering): what a member has beyond the centre comes before what it lacks, as it is rarer.
What most members share is in no difference, so the lists of nodes by element are short where buckets are
long. Each list is joined with its first nodes before its remaining pairs of different components are taken.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tanisight.llm.common import slices, written

MARK = 16  # 64-bit words of parity
FEW = 8  # members of a family whose pairs are taken as they are, at most 28
MEASURED = "family long, node long, part long, n long, nd long, f long, d array<long>, mark array<long>"


def families(members: DataFrame) -> DataFrame:
    """(family, node) without repeats: a bucket's family is its node with the most company in all its buckets."""
    sizes = members.groupBy("bucket").agg(F.count("*").alias("n"))
    company = members.join(sizes, "bucket").groupBy("node").agg(F.sum("n").alias("w"))
    heads = members.join(company, "node").groupBy("bucket").agg(F.max_by("node", F.struct("w", -F.col("node"))).alias("family"))
    return members.join(heads, "bucket").select("family", "node").distinct()


def each_shingle(batches):
    for part in slices(batches, 500):
        sets = [np.frombuffer(x, np.int64) for x in part.column("shingles").to_pylist()]
        families = np.repeat(part.column("family").to_numpy(), [len(s) for s in sets])
        yield pa.RecordBatch.from_arrays([pa.array(families), pa.array(np.concatenate(sets))], ["family", "shingle"])


def measure(percent: int):
    """Difference from the centre (additions, then what is missing), f, and the difference's parity over 64 MARK places."""

    def run(batches):
        for part in slices(batches, 500):
            sets = [np.frombuffer(x, np.int64) for x in part.column("shingles").to_pylist()]
            ends = np.cumsum(part.column("centre").value_lengths().fill_null(0).to_numpy())
            centres = np.split(part.column("centre").flatten().to_numpy(), ends[:-1])
            diffs = [np.concatenate([np.setdiff1d(s, c, True), np.setdiff1d(np.sort(c), s, True)]) for s, c in zip(sets, centres, strict=True)]
            n, nd = np.array([len(s) for s in sets], np.int64), np.array([len(d) for d in diffs], np.int64)
            marks = []
            for d in diffs:
                odd = np.bincount((d.view(np.uint64) >> np.uint64(20)).astype(np.int64) % (64 * MARK), minlength=64 * MARK) & 1
                marks.append(np.packbits(odd.astype(np.uint8)).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [part.column("family"), part.column("node"), part.column("part"), pa.array(n), pa.array(nd),
                 pa.array((100 + percent) * nd - (100 - percent) * n), pa.array(diffs, pa.list_(pa.int64())), pa.array(marks, pa.list_(pa.int64()))],
                ["family", "node", "part", "n", "nd", "f", "d", "mark"])

    return run


def centres(own: DataFrame) -> DataFrame:
    """family, centre: the shingles that more than half of its members hold; at most twice a mean set."""
    counts = own.mapInArrow(each_shingle, "family long, shingle long").groupBy("family", "shingle").agg(F.count("*").alias("holders"))
    sizes = own.groupBy("family").agg(F.count("*").alias("members"))
    most = counts.join(sizes, "family").filter("2 * holders > members")
    return most.groupBy("family").agg(F.collect_list("shingle").alias("centre"))


def differ_little(a: str, b: str, percent: int) -> Column:
    """Sizes and parities allow a link: the parities differ in at most as many places as the sets in shingles."""
    n = F.col("n" + a) + F.col("n" + b)
    places = sum((F.bit_count(F.col("mark" + a)[k].bitwiseXOR(F.col("mark" + b)[k])) for k in range(MARK)), F.lit(0))
    fits = F.least("n" + a, "n" + b) * 100 >= F.greatest("n" + a, "n" + b) * percent
    return fits & (places * (100 + percent) <= n * (100 - percent))


def lists_of(measured: DataFrame, low: DataFrame, percent: int) -> DataFrame:
    """family, element, node, component, n, f, mark: the nodes by the first elements of their differences.

    measured holds the components. A node that must share k elements with any node it is not yet joined to is
    listed under all but the last k - 1. Elements that only one component holds take no part.
    """
    twice = 2 * (100 + percent)
    within = F.floor(F.col("n") * (100 - percent) / percent)  # the most shingles in which a linked set differs
    apart = F.greatest(F.ceil((F.col("f") + F.col("m")) / twice), F.col("nd") - within, F.lit(1))
    joined = F.greatest(F.ceil((F.col("f") - F.col("m") + 1) / twice), F.lit(1))  # a partner has f > -m
    wide = measured.join(low.select("family", "m"), "family").withColumn("k", F.when(F.col("f") > -F.col("m"), apart).otherwise(joined))
    first = F.slice("d", F.lit(1), F.greatest(F.col("nd") - F.col("k") + 1, F.lit(0)).cast("int"))
    elements = written(wide.select("family", "node", "part", "component", "n", "f", F.explode(first).alias("element")), "elements")
    lists = still_apart(elements.select("family", "element", "node", "part", "component", "n", "f"), "family", "element")
    return lists.join(measured.select("family", "node", "part", "mark"), ["family", "node", "part"]).drop("part")


def different(table: DataFrame, keys: list[str], percent: int) -> DataFrame:
    """Pairs of nodes of different components that share the keys, if sizes and parities allow a link."""
    x, y = (table.select(*keys, *[F.col(c).alias(c + k) for c in ("node", "component", "n", "mark")]) for k in "ab")
    pairs = x.join(y, keys).filter("nodea < nodeb and componenta <> componentb").filter(differ_little("a", "b", percent))
    return pairs.select(F.col("nodea").alias("a"), F.col("nodeb").alias("b"))


def labelled(table: DataFrame, labels: DataFrame) -> DataFrame:
    return table.drop("component").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))


def still_apart(table: DataFrame, *keys: str) -> DataFrame:
    """Rows of the groups that hold several components."""
    span = table.groupBy(*keys).agg(F.min("component").alias("one"), F.max("component").alias("other"))
    return table.join(span.filter("one < other").select(*keys), list(keys))


def resolve(links, members: DataFrame, sets: DataFrame, edges: DataFrame, labels: DataFrame, components):
    """(edges, labels) with every link between members that share a bucket and lie in different components.

    members: bucket, node. sets: node, shingles of the members; a node may have several, each by itself.
    links.of confirms pairs on whole sets.
    """
    percent = links.percent
    own = written(families(members).join(sets, "node").withColumn("part", F.xxhash64("shingles")), "families")
    measured = written(own.join(centres(own), "family", "left").mapInArrow(measure(percent), MEASURED), "measured")
    low = written(measured.groupBy("family").agg(F.count("*").alias("members"), F.min("f").alias("m"), F.min_by("node", F.struct("f", "node")).alias("first")), "low")
    sure = measured.join(low, "family").filter("f <= -m and node <> first").select(F.col("node").alias("a"), F.col("first").alias("b"))

    def add(found: DataFrame, edges: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
        if found.isEmpty():
            return edges, labels
        edges = written(edges.union(found), "edges")
        return edges, components(edges)

    edges, labels = add(sure, edges, labels)
    several = written(still_apart(labelled(measured, labels), "family").join(low.select("family", "members"), "family"), "several")
    few = several.filter((F.col("members") > 2) & (F.col("members") <= FEW))  # of two, the centre is what both hold: nothing else is common
    edges, labels = add(links.of(different(few, ["family"], percent)), edges, labels)
    lists = written(lists_of(several.filter(F.col("members") > FEW), low, percent), "lists")
    for order in (F.struct("f", "node"), F.struct(F.xxhash64("node"), "node")):
        if lists.isEmpty():
            return edges, labels
        head = lists.groupBy("family", "element").agg(F.min_by(F.struct("node", "component", "n", "mark"), order).alias("h"))
        pairs = lists.join(head, ["family", "element"]).filter("component <> h.component")
        pairs = pairs.select("node", F.col("n").alias("na"), F.col("mark").alias("marka"), F.col("h.node").alias("head"), F.col("h.n").alias("nb"), F.col("h.mark").alias("markb"))
        found = links.of(pairs.filter(differ_little("a", "b", percent)).select(F.col("node").alias("a"), F.col("head").alias("b")))
        before = labels
        edges, labels = add(found, edges, labels)
        if labels is not before:
            lists = written(still_apart(labelled(lists, labels), "family", "element"), "lists")
    return add(links.of(different(lists, ["family", "element"], percent)), edges, labels)
