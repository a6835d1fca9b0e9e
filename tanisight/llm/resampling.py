"""Importance resampling towards a target: texts that look like the target are drawn more often.

Words and pairs of neighbours are hashed into buckets; a bucket's gain is the logarithm of its share in the
target over its share in the corpus. A document's weight is the mean gain of its features, added up over
arrays. Gumbel noise from a digest of the id turns weights into scores, and the highest scores are drawn: a
quantile sketch brackets the cutoff, exact counts outside the bracket prove or widen it, and only the scores
inside are sorted.
"""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tanisight.llm.common import as_bytes, small_slices
from tanisight.session import scratch_path, ship_package

#: Bytes of words: digits, a-z (A-Z are lower-cased) and all bytes beyond ASCII. Others become spaces.
FOLD = bytes(b if b >= 128 or chr(b).isalnum() and not chr(b).isupper() else b + 32 if chr(b).isupper() else 32 for b in range(256))
POLYNOMIAL = 0xEDB88320
SCORED = "doc_id long, n_words long, n_features long, weight long, score long"


def zero_byte_table() -> np.ndarray:
    """What a byte of zeros does to the register of crc32, by the register's last byte."""
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = np.where(out & 1, (out >> np.uint32(1)) ^ np.uint32(POLYNOMIAL), out >> np.uint32(1))
    return out


class Shifts:
    """crc32 of joined strings from those of the parts: crc(ab) = shift(crc(a), len(b)) ^ crc(b).

    The shift is linear, so four tables of 256 entries, one per byte of the register, hold it for a length.
    """

    LONGEST = 64

    def __init__(self):
        step = zero_byte_table()
        tables = np.empty((self.LONGEST + 1, 4, 256), np.uint32)
        tables[0] = np.arange(256, dtype=np.uint32)[None, :] << (np.arange(4, dtype=np.uint32) * np.uint32(8))[:, None]
        for n in range(1, self.LONGEST + 1):
            tables[n] = step[tables[n - 1] & np.uint32(255)] ^ (tables[n - 1] >> np.uint32(8))
        self.tables = tables.reshape(-1)

    def join(self, left: np.ndarray, right: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """crc32 of pairs from both parts' and the right part's size."""
        out = right.copy()
        at = np.minimum(sizes, self.LONGEST).astype(np.int64) * 1024
        for k in range(4):
            out ^= self.tables[at + k * 256 + ((left >> np.uint32(8 * k)) & np.uint32(255))]
        return out


def features(texts: list[bytes], buckets: int, shifts: Shifts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buckets of all words, then of all pairs of neighbours; the document of each; words per document)."""
    folded = pa.array([t.translate(FOLD) for t in texts], pa.large_binary()).cast(pa.large_string())
    split = pc.ascii_split_whitespace(folded)
    coded = split.flatten().dictionary_encode()
    words = [w.encode() for w in coded.dictionary.to_pylist()]
    index = coded.indices.to_numpy()
    doc = np.repeat(np.arange(len(texts)), np.diff(split.offsets.to_numpy()))
    if b"" in words:  # white space at an end of a text
        some = index != words.index(b"")
        index, doc = index[some], doc[some]
    alone = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
    behind = np.fromiter((zlib.crc32(b" " + w) for w in words), np.uint32, len(words))
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    pair = np.flatnonzero(doc[1:] == doc[:-1])
    left, right = index[pair], index[pair + 1]
    both = shifts.join(alone[left], behind[right], sizes[right])
    for k in np.flatnonzero(sizes[right] > Shifts.LONGEST):
        both[k] = zlib.crc32(words[left[k]] + b" " + words[right[k]])
    hashes = np.concatenate([alone[index], both])
    return (hashes % np.uint32(buckets)).astype(np.int64), np.concatenate([doc, doc[pair]]), np.bincount(doc, minlength=len(texts))


def bucket_counts(table: DataFrame, buckets: int) -> np.ndarray:
    """Features of all texts by bucket. Each task adds up its own texts; `buckets` sums reach the driver."""

    def run(batches):
        shifts, total = Shifts(), np.zeros(buckets, np.int64)
        for batch in small_slices(batches):
            found, _, _ = features(as_bytes(batch), buckets, shifts)
            total += np.bincount(found, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for row in table.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row.bucket] = row.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B)))) of each of B buckets."""
    buckets, s_all, t_all = float(len(source)), float(source.sum()), float(target.sum())
    return np.array([
        math.floor(1000 * math.log((t + 1) * (s_all + buckets) / ((s + 1) * (t_all + buckets))))
        for s, t in zip(source.astype(float).tolist(), target.astype(float).tolist(), strict=True)], np.int64)


def noise(seed: int, doc_id: int | None) -> int:
    """Gumbel noise in thousandths, from the id's digest."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def score(docs: DataFrame, gain: np.ndarray, seed: int = 7) -> DataFrame:
    """Per row: doc_id, n_words, n_features, weight (floored mean gain; 0 without features) and score."""
    held = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches):
        gain, shifts = held.value, Shifts()
        for batch in small_slices(batches):
            ids = batch.column("doc_id").to_pylist()
            found, doc, words = features(as_bytes(batch), len(gain), shifts)
            count = np.bincount(doc, minlength=len(ids))
            order = np.argsort(doc, kind="stable")
            ends = np.append(0, np.cumsum(gain[found[order]]))[np.append(0, np.cumsum(count))]
            weight = np.diff(ends) // np.maximum(count, 1)
            total = weight + np.array([noise(seed, i) for i in ids], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *map(pa.array, (words, count, weight, total))],
                                             ["doc_id", "n_words", "n_features", "weight", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, SCORED)


def cutoff(able: DataFrame, percent: int, accuracy: int = 1000) -> tuple[int, int | None]:
    """(how many rows are drawn: `percent` of them, rounded down; the score of the last one, None if none is).

    A sketch of the scores gives a bracket around the cutoff. The exact number of scores above it and in it
    shows whether the cutoff lies inside; if not, the bracket is widened, at last to all scores. Only the
    scores inside are sorted, each with its number of rows.
    """
    n = able.count()
    wanted = percent * n // 100
    if not wanted:
        return 0, None
    share, slack = 1 - wanted / n, 2 / accuracy
    while True:
        sketch = F.percentile_approx("score", [max(0.0, share - slack), min(1.0, share + slack)], accuracy)
        ends = able.agg(sketch.alias("q"), F.min("score").alias("low"), F.max("score").alias("high")).first()
        low, high = (ends.low, ends.high) if slack >= 1 else ends.q
        above, inside = able.agg(F.count_if(F.col("score") > high), F.count_if(F.col("score").between(low, high))).first()
        if above < wanted <= above + inside:
            break
        slack *= 4
    by_score = able.filter(F.col("score").between(low, high)).groupBy("score").agg(F.count("*").alias("n"))
    upto = by_score.withColumn("upto", F.sum("n").over(Window.orderBy(F.col("score").desc())) + above)
    return wanted, upto.filter(F.col("upto") >= wanted).agg(F.max("score")).first()[0]


def draw(spark: SparkSession, docs: DataFrame, target: DataFrame, percent: int = 25, least_words: int = 20,
         buckets: int = 10000, seed: int = 7, accuracy: int = 1000) -> DataFrame:
    """Per row of docs: doc_id, n_words, n_features, weight, score and rank (1 for the first drawn; null if not drawn).

    Of the rows with at least `least_words` words, `percent` are drawn, by falling score, then rising doc_id
    (null last). Null text: no words, weight 0, never drawn unless least_words is 0. A null doc_id counts as empty
    in the digest. Rows that repeat a doc_id and a text are drawn side by side. Without a target every bucket's
    share is compared with an even one. An empty table gives no rows.
    """
    ship_package(spark)
    gain = gains(bucket_counts(docs, buckets), bucket_counts(target, buckets))
    path = scratch_path(spark, "scores")
    score(docs, gain, seed).write.parquet(path)
    scored = spark.read.schema(SCORED).parquet(path)
    able = F.col("n_words") >= least_words
    wanted, last = cutoff(scored.filter(able), percent, accuracy)
    if last is None:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    high = able & (F.col("score") >= last)
    first = scored.filter(high)
    # Scores are whole numbers and the noise spreads them: few values, each with a small share of the rows.
    sizes = first.groupBy("score").agg(F.count("*").alias("n"))
    before = sizes.select("score", (F.sum("n").over(Window.orderBy(F.col("score").desc())) - F.col("n")).alias("before"))
    within = F.row_number().over(Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last()))
    ranked = first.withColumn("within", within.cast("long")).join(before, "score").withColumn("rank", F.col("before") + F.col("within"))
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank"))).select(*scored.columns, "rank")
    return ranked.union(scored.filter(~high).withColumn("rank", F.lit(None).cast("long")))
