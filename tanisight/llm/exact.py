"""Exact duplicates through an extendible-hash index on shared files.

The index has entries, one per distinct text of an input batch, in buckets by the leading bits of a
64-bit key, and a directory that maps 2 ** depth slots to buckets. It grows by doubling: while a
bucket holds more bytes than its capacity, it splits in two, and the directory doubles when that
bucket was told apart by as many bits as the directory uses. Only bucket sizes per slot, at most
2 ** max_depth numbers, reach the driver. Each owner task reads whole buckets in key order, chains
entries of one key and compares their bytes.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tanisight.llm.common import as_bytes, id_and_text
from tanisight.session import scratch_path

ENTRIES = "key long, size long, text binary, members array<long>, sha string"
CHAINED = "key long, link long, members array<long>, sha string"


def key_of(data: bytes) -> int:
    value = xxhash.xxh3_64_intdigest(data)
    return value - (1 << 64) if value >> 63 else value


def entries(docs: DataFrame) -> DataFrame:
    """One row per distinct normalised text (A-Z lower-cased) of each batch, with its doc_ids.

    Copies meet here before anything is shuffled: a group with a third of all rows leaves a task as
    a row per batch.
    """

    def run(batches):
        for batch in batches:
            groups: dict[bytes, list] = {}
            for doc, data in zip(batch.column("doc_id").to_pylist(), as_bytes(batch), strict=True):
                groups.setdefault(data.lower(), []).append(doc)
            texts = list(groups)
            for at in range(0, len(texts), 1000):
                part = texts[at : at + 1000]
                yield pa.RecordBatch.from_arrays([
                    pa.array([key_of(t) for t in part], pa.int64()),
                    pa.array([len(t) for t in part], pa.int64()),
                    pa.array(part, pa.binary()),
                    pa.array([groups[t] for t in part], pa.list_(pa.int64())),
                    pa.array([hashlib.sha256(t).hexdigest() for t in part]),
                ], ["key", "size", "text", "members", "sha"])

    return id_and_text(docs).mapInArrow(run, ENTRIES)


class Directory:
    """Slots of the leading `depth` bits -> bucket."""

    def __init__(self, sizes: dict[int, int], max_depth: int, capacity: int):
        """sizes: bytes per slot of max_depth bits."""
        self.depth = 0
        self.buckets: dict[tuple[int, int], int] = {(0, 0): sum(sizes.values())}  # (bits, value) -> bytes
        full = [(0, 0)] if self.buckets[0, 0] > capacity else []
        while full:
            bits, value = full.pop()
            if bits == max_depth:
                continue  # the bucket stays large; its owner reads it in key order, entry by entry
            del self.buckets[bits, value]
            self.depth = max(self.depth, bits + 1)  # doubling
            for half in (value * 2, value * 2 + 1):
                shift = max_depth - bits - 1
                load = sum(sizes.get(s, 0) for s in range(half << shift, (half + 1) << shift))
                self.buckets[bits + 1, half] = load
                if load > capacity:
                    full.append((bits + 1, half))

    def slots(self) -> list[int]:
        numbers = [0] * (1 << self.depth)
        for number, (bits, value) in enumerate(sorted(self.buckets, key=lambda b: b[1] / (1 << b[0]))):
            span = 1 << (self.depth - bits)
            numbers[value * span : (value + 1) * span] = [number] * span
        return numbers


def slot(depth: int):
    return F.expr(f"shiftrightunsigned(key, {64 - depth})") if depth else F.lit(0).cast("long")


def build(spark: SparkSession, docs: DataFrame, folder: str, capacity: int | None = None, max_depth: int = 16) -> DataFrame:
    """Write the entries below `folder` and give them with their bucket.

    capacity: bytes of a bucket; by default a quarter of a shuffle partition's share, 16 MB at most.
    """
    entries(docs).write.parquet(folder)
    index = spark.read.schema(ENTRIES).parquet(folder)
    loads = index.groupBy(slot(max_depth).alias("slot")).agg(F.sum(F.col("size") + 64).alias("bytes")).collect()
    if capacity is None:
        share = sum(r.bytes for r in loads) // (4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
        capacity = min(16 << 20, max(64 << 10, share))
    directory = Directory({r.slot: r.bytes for r in loads}, max_depth, capacity)
    numbers = F.array(*[F.lit(n) for n in directory.slots()])
    return index.withColumn("bucket", F.get(numbers, slot(directory.depth).cast("int")))


def chained(index: DataFrame) -> DataFrame:
    """Owner tasks: entries of equal key and equal bytes get the same link number."""

    def run(batches):
        key, texts = None, []
        for batch in batches:
            links = []
            for k, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if k != key:
                    key, texts = k, []
                if text not in texts:
                    texts.append(text)
                links.append(texts.index(text))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(links, pa.int64()), batch.column("members"), batch.column("sha")],
                ["key", "link", "members", "sha"])

    owners = index.select("bucket", "key", "text", "members", "sha").repartition("bucket").sortWithinPartitions("bucket", "key")
    return owners.drop("bucket").mapInArrow(run, CHAINED)


def deduplicate(spark: SparkSession, docs: DataFrame, capacity: int | None = None, max_depth: int = 16) -> DataFrame:
    """Per document: keep_id, group_size, kept and text_sha256 of the normalised text.

    Texts are equal when identical after lower-casing A-Z; null is empty. Of equal texts the row with
    the largest doc_id stays (null is the smallest); of rows that repeat that doc_id too, one.
    An empty table gives no rows.
    """
    found = chained(build(spark, docs, scratch_path(spark, "index"), capacity, max_depth))
    group = Window.partitionBy("key", "link")
    found = found.withColumn("members", F.sort_array("members", asc=False))
    found = found.withColumn("top", F.get("members", F.lit(0)))
    found = (
        found.withColumn("keep_id", F.max("top").over(group))
        .withColumn("group_size", F.sum(F.size("members")).over(group))
        .withColumn("first", F.row_number().over(group.orderBy(F.desc_nulls_last("top"))) == 1)
    )
    rows = found.select("keep_id", "group_size", "first", "sha", F.posexplode("members").alias("place", "doc_id"))
    return rows.select(
        "doc_id", "keep_id", "group_size", (F.col("first") & (F.col("place") == 0)).alias("kept"),
        F.col("sha").alias("text_sha256"))
