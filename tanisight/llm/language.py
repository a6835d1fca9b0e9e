"""Language identification by prediction by partial matching over bytes.

For each language a context tree of variable order (0 to `order` bytes) holds how often each byte
followed each context in the training texts; then it is frozen. The code length of a byte is taken
from the longest context in which it occurred; each longer context, seen but without this byte, adds
the code length of an escape, whose probability is distinct / (total + distinct) there. Below order
0 all bytes are equally likely. The language with the shortest code for the whole text wins.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tanisight.llm.common import as_bytes, slices

UNKNOWN = "und"
ORDER = 3  # a context and its byte make up one 32-bit number
BLOCK = 2_000_000
SCHEMA = "doc_id long, lang_pred string, score double, bits double"
COUNTS = "lang string, gram long, n long"


def fold(doc_id: Column, of: int) -> Column:
    """crc32 of the id as text, modulo `of`."""
    return F.crc32(doc_id.cast("string").cast("binary")) % of


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For each byte of the lower-cased (A-Z) texts, itself and the three before it; document offsets.

    Bytes before a text are 0.
    """
    offsets = np.append(0, np.cumsum([len(t) for t in texts]))
    data = np.frombuffer(b"".join(texts).lower(), np.uint8)
    codes = data.astype(np.uint32)
    for back in (1, 2, 3):
        before = np.zeros(len(data), np.uint32)
        before[back:] = data[:-back] if len(data) > back else 0
        for place in range(back):  # the first bytes of a text have nothing before them
            at = offsets[:-1] + place
            before[at[at < offsets[1:]]] = 0
        codes |= before << np.uint32(8 * back)
    return codes, offsets


class Trees:
    """Frozen counts of all languages and the code lengths that follow from them."""

    SLOTS = 22

    def __init__(self, rows: list[tuple[str, np.ndarray, np.ndarray]]):
        """rows: language, its grams, their counts."""
        rows = sorted(rows, key=lambda r: r[0])
        self.langs = [lang for lang, _, _ in rows]
        self.levels = [[self._level(g, n, k) for k in range(ORDER + 1)] for _, g, n in rows]
        self.keys = np.unique(np.concatenate([g for _, g, _ in rows])) if rows else np.zeros(0, np.uint32)
        self.costs = self.lengths(self.keys)
        self.slot_key = np.zeros(1 << self.SLOTS, np.uint32)
        self.slot_at = np.full(1 << self.SLOTS, -1, np.int32)
        slots = self.slots(self.keys)
        self.slot_at[slots] = np.arange(len(self.keys))  # of keys in one slot, one; the others are found by bisection
        held = self.slot_at >= 0
        self.slot_key[held] = self.keys[self.slot_at[held]]

    @staticmethod
    def _level(g: np.ndarray, n: np.ndarray, k: int):
        """Contexts of k bytes: symbol keys with counts, context keys with totals and distinct symbols."""
        symbols, where = np.unique(g & np.uint32(0xFFFFFFFF >> 8 * (3 - k)), return_inverse=True)
        counts = np.bincount(where, n, len(symbols))
        contexts, where, distinct = np.unique(symbols >> np.uint32(8), return_inverse=True, return_counts=True)
        return symbols, counts, contexts, np.bincount(where, counts, len(contexts)), distinct

    def slots(self, codes: np.ndarray) -> np.ndarray:
        return (codes * np.uint32(2654435769)) >> np.uint32(32 - self.SLOTS)

    def lengths(self, codes: np.ndarray) -> np.ndarray:
        """Bits of each code's last byte after the bytes before it, one row per language."""

        def find(keys, wanted, values):
            at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            return np.where(keys[at] == wanted, values[at], 0)

        out = np.full((len(self.langs), len(codes)), 8.0)
        for bits, levels in zip(out, self.levels, strict=True):
            for k, (symbols, counts, contexts, totals, distinct) in enumerate(levels):
                own = codes & np.uint32(0xFFFFFFFF >> 8 * (3 - k))
                seen = find(symbols, own, counts)
                total = find(contexts, own >> np.uint32(8), totals)
                kinds = find(contexts, own >> np.uint32(8), distinct)
                with np.errstate(divide="ignore", invalid="ignore"):
                    escaped = bits + np.where(total > 0, -np.log2(kinds / (total + kinds)), 0)
                    bits[:] = np.where(seen > 0, -np.log2(seen / (total + kinds)), escaped)
        return out

    def total_bits(self, texts: list[bytes]) -> np.ndarray:
        """Code length of each text in each language; in blocks, so a long text needs no more memory."""
        codes, offsets = grams(texts)
        sums = np.zeros((len(self.langs), len(texts)))
        costs = self.costs.astype(np.float32)
        for start in range(0, len(codes), BLOCK):
            block = codes[start : start + BLOCK]
            at = self.slot_at[slots := self.slots(block)]
            other = np.flatnonzero((self.slot_key[slots] != block) | (at < 0))
            first = np.searchsorted(offsets, start, "right") - 1
            last = np.searchsorted(offsets, start + len(block), "left")
            begins = np.maximum(offsets[first:last] - start, 0)
            docs = np.flatnonzero(np.diff(np.append(begins, len(block))) > 0)
            unseen, where = np.unique(block[other], return_inverse=True)
            extra = self.lengths(unseen)
            for lang in range(len(self.langs)):
                bits = costs[lang][at]
                bits[other] = extra[lang][where]
                sums[lang, first + docs] += np.add.reduceat(bits.astype(np.float64), begins[docs])
        return sums


def train(spark: SparkSession, docs: DataFrame, learn: Column, max_docs: int = 1500) -> Trees:
    """Count the grams of at most max_docs documents per language (those of smallest hash).

    Only rows where `learn` holds, with text and lang, are learned from. Counting is a Spark job;
    what reaches the driver is one number per language and distinct gram of the bounded sample.
    """
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    rows = docs.filter(learn & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang")
    chosen = rows.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= max_docs).select("doc_id").distinct()
    sample = docs.filter(learn & F.col("lang").isNotNull()).select("doc_id", "lang", "text").join(F.broadcast(chosen), "doc_id", "left_semi")

    def count(batches):
        for batch in slices(batches, 1000):
            by_lang: dict[str, list[bytes]] = {}
            for lang, data in zip(batch.column("lang").to_pylist(), as_bytes(batch), strict=True):
                by_lang.setdefault(lang, []).append(data)
            for lang, texts in by_lang.items():
                found, n = np.unique(grams(texts)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(found), pa.string()), pa.array(found.astype(np.int64)), pa.array(n)], ["lang", "gram", "n"])

    table = sample.mapInArrow(count, COUNTS).groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    langs = np.array(table.column("lang").to_pylist(), dtype=object)
    gram, n = (table.column(c).to_numpy() for c in ("gram", "n"))
    return Trees([(lang, gram[langs == lang].astype(np.uint32), n[langs == lang]) for lang in sorted(set(langs))])


def identify(spark: SparkSession, docs: DataFrame, trees: Trees) -> DataFrame:
    """Per document: lang_pred, score (probability of that language, all being equally likely
    before) and bits (its code length).

    Null text, a text without a letter, and any text when no language was learned: `und`, score 0.
    Equal code lengths take the language first in the alphabet. One pass without a shuffle, so
    sources and repeated rows change nothing; an empty table gives no rows.
    """
    model = spark.sparkContext.broadcast(trees)

    def run(batches):
        frozen = model.value
        for batch in slices(batches, 1000):
            texts, letters = as_bytes(batch), batch.column("has_letter").to_pylist()
            bits = frozen.total_bits(texts)
            names, scores, best_bits = [], [], []
            for column, letter in zip(bits.T, letters, strict=True):
                if not letter or not len(column):
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    best_bits.append(None)
                    continue
                best = int(np.argmin(column))
                names.append(frozen.langs[best])
                scores.append(float(1 / np.exp2(np.maximum(column[best] - column, -1000)).sum()))
                best_bits.append(float(column[best]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(names), pa.array(scores, pa.float64()), pa.array(best_bits, pa.float64())],
                ["doc_id", "lang_pred", "score", "bits"])

    rows = docs.select("doc_id", "text", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("has_letter"))
    return rows.mapInArrow(run, SCHEMA)
