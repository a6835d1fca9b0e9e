"""Toxicity by a factorization machine over hashed terms.

A document is the set of its words; a word stands for several terms, itself and its beginnings,
each hashed to a slot. Besides a weight, every slot has a short vector, and each pair of terms adds
the product of their vectors, so a pair such as an insult and the mention of a group counts beyond
the sum of its parts. Slots take part that are commoner in toxic training texts, alone or as a pair of words
that tells more than either of them; other ordinary words, however many, cannot move the score of a long text.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tanisight.llm.common import as_bytes, small_slices

PREFIXES = (4, 5, 6)
EDGES = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~«»“”„‘’…¡¿"
SCHEMA = "doc_id long, score double"


def word_sets(texts: list[bytes], bits: int, active: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Terms of each distinct word (a row each; slot 0 means none), the words' numbers document by
    document without repeats, and the documents' offsets. Only active slots count, if given."""
    lower = pc.utf8_lower(pa.array(texts, pa.large_binary()).cast(pa.large_string()))
    split = pc.ascii_split_whitespace(lower)
    coded = split.flatten().dictionary_encode()
    mask = (1 << bits) - 1
    slots: dict[str, int] = {}
    rows = []
    number = np.zeros(len(coded.dictionary), np.int64)
    for at, word in enumerate(coded.dictionary.to_pylist()):
        word = word.strip(EDGES)
        known = slots.get(word)
        if known is None:
            known = slots[word] = len(rows)
            rows.append([zlib.crc32(word.encode()) & mask, *(zlib.crc32(b"^%d" % k, zlib.crc32(word[:k].encode())) & mask if len(word) > k else 0 for k in PREFIXES)] if word else [0] * (1 + len(PREFIXES)))
        number[at] = known
    terms = np.array(rows, np.int64).reshape(-1, 1 + len(PREFIXES))
    if active is not None:
        terms = np.where(active[terms], terms, 0)
    word = number[coded.indices.to_numpy()]
    counts = np.diff(split.offsets.to_numpy())
    some = terms.any(1)[word]
    pairs = np.unique(np.repeat(np.arange(len(counts)), counts)[some] * (len(rows) + 1) + word[some])
    doc, word = np.divmod(pairs, len(rows) + 1)
    return terms, word, np.append(0, np.cumsum(np.bincount(doc, minlength=len(counts))))


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of the rows of each document; 0 where it has none."""
    out = np.zeros((len(offsets) - 1, values.shape[1]))
    some = np.flatnonzero(np.diff(offsets))
    if len(some):
        out[some] = np.add.reduceat(values, offsets[some], axis=0)
    return out


def telling(all_of, bad_of, n, n_bad) -> tuple[np.ndarray, np.ndarray]:
    """How many times commoner in the bad of n texts something is, and the chi-square of that."""
    share, other = bad_of / n_bad, (all_of - bad_of + 0.5) / np.maximum(1, n - n_bad)
    expected = all_of * (n_bad / np.maximum(n, 1))
    with np.errstate(divide="ignore", invalid="ignore"):
        chi = (bad_of - expected) ** 2 * n / (expected * (n - n_bad) * (1 - all_of / n + 1e-9))
    return share / other, np.nan_to_num(chi, nan=0.0)


class Sample:
    """Labelled texts as numbers: the terms of each word, and per document its distinct words.

    Texts are added in slices and not kept; a document takes four bytes per distinct word.
    """

    def __init__(self, bits: int):
        self.bits, self.labels, self.rows = bits, [], 0
        self._terms, self._words, self._counts = [], [], []

    def add(self, texts: list[bytes], labels) -> None:
        terms, words, offsets = word_sets(texts, self.bits)
        self._terms.append(terms.astype(np.int32))
        self._words.append((words + self.rows).astype(np.int32))
        self._counts.append(np.diff(offsets))
        self.rows += len(terms)
        self.labels += list(labels)

    def close(self) -> None:
        self.terms, self.words = np.concatenate(self._terms), np.concatenate(self._words)
        self.offsets = np.append(0, np.cumsum(np.concatenate(self._counts)))
        self.labels = np.array(self.labels)
        self._terms = self._words = self._counts = None

    def parts(self, most: int = 500_000):
        """(first document, last document + 1) of runs of at most so many words, or of one document."""
        start, n = 0, len(self.labels)
        while start < n:
            stop = max(start + 1, int(np.searchsorted(self.offsets, self.offsets[start] + most, "right")) - 1)
            yield start, min(stop, n)
            start = min(stop, n)

    def reduced(self, active: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Terms, words and offsets with active slots only."""
        terms = np.where(active[self.terms], self.terms, 0)
        some = terms.any(1)[self.words]
        return terms, self.words[some], np.append(0, np.cumsum(some))[self.offsets]


class Machine:
    """Bias, weights [slots] and vectors [slots, factors]; slot 0 stays zero."""

    def __init__(self, bits: int = 18, factors: int = 4, seed: int = 7):
        self.bits, self.bias = bits, 0.0
        self.weights = np.zeros(1 << bits, np.float32)
        self.vectors = (np.random.default_rng(seed).normal(0, 0.01, (1 << bits, factors))).astype(np.float32)
        self.vectors[0] = 0
        self.active = np.ones(1 << bits, bool)

    def margins(self, terms: np.ndarray, words: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        linear = self.weights[terms].sum(1, dtype=np.float64)
        vectors = self.vectors[terms]
        whole, squares = vectors.sum(1), (vectors.astype(np.float64) ** 2).sum((1, 2))
        per_word = np.column_stack([linear, squares, whole])
        total = sums(per_word[words], offsets)
        inner = total[:, 2:]
        return self.bias + total[:, 0] + 0.5 * ((inner**2).sum(1) - total[:, 1]), inner

    def scores(self, texts: list[bytes]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(*word_sets(texts, self.bits, self.active))[0], -700, 700)))

    def select(self, sample: Sample, lift: float, evidence: float, common: float = 0.05, screened: int = 1024) -> None:
        """Keep slots whose share of toxic texts is `lift` times that of the others, with a chi-square of `evidence`,
        and both words of pairs that do so together. Pairs are looked at among the `screened` words that most
        toxic texts hold; one counts if a share `common` of the toxic texts holds it and, among the texts that hold
        the more telling of its words, the other is commoner in toxic ones."""
        bad = sample.labels == 1
        n, n_bad = len(bad), max(1, int(bad.sum()))
        slots = 1 << self.bits
        all_of, bad_of = np.zeros(slots), np.zeros(slots)
        for start, stop in sample.parts():
            counts = np.diff(sample.offsets[start : stop + 1])
            doc = np.repeat(np.arange(start, stop), counts * sample.terms.shape[1])
            seen = np.unique(doc << self.bits | sample.terms[sample.words[sample.offsets[start] : sample.offsets[stop]]].ravel())
            held = seen & (slots - 1)
            all_of += np.bincount(held, minlength=slots)
            bad_of += np.bincount(held[bad[seen >> self.bits]], minlength=slots)
        ratio, chi = telling(all_of, bad_of, n, n_bad)
        self.active = (ratio >= lift) & (chi >= evidence)
        self.active[self.pairs(sample, ratio, bad_of, lift, evidence, common, screened)] = True
        self.active[0] = False
        self.vectors[~self.active] = 0

    @staticmethod
    def pairs(sample: Sample, ratio: np.ndarray, bad_of: np.ndarray, lift: float, evidence: float, common: float, screened: int) -> np.ndarray:
        """Slots of the words of telling pairs."""
        bad = sample.labels == 1
        n, n_bad = len(bad), max(1, int(bad.sum()))
        own = np.unique(sample.terms[:, 0])
        own = own[(own > 0) & (bad_of[own] >= max(20, common * n_bad))]
        own = np.sort(own[np.argsort(-bad_of[own], kind="stable")[:screened]])
        if len(own) < 2:
            return np.zeros(0, np.int64)
        place = np.full(len(bad_of), -1, np.int32)
        place[own] = np.arange(len(own))
        both_all, both_bad = np.zeros((len(own), len(own)), np.float32), np.zeros((len(own), len(own)), np.float32)
        for start, stop in sample.parts():
            words = sample.words[sample.offsets[start] : sample.offsets[stop]]
            at = place[sample.terms[words, 0]]
            doc = np.repeat(np.arange(stop - start), np.diff(sample.offsets[start : stop + 1]))
            for low in range(0, stop - start, 2000):
                rows = min(2000, stop - start - low)
                mine = (at >= 0) & (doc >= low) & (doc < low + rows)
                held = np.zeros((rows, len(own)), np.float32)
                held[doc[mine] - low, at[mine]] = 1
                both_all += held.T @ held
                held = held[bad[start + low : start + low + rows]]
                both_bad += held.T @ held
        together, chi = telling(both_all, both_bad, n, n_bad)
        stronger = ratio[own][:, None] >= ratio[own][None, :]
        one_all, one_bad = (np.where(stronger, np.diag(x)[:, None], np.diag(x)[None, :]) for x in (both_all, both_bad))
        beyond, more = telling(both_all, both_bad, one_all, np.maximum(one_bad, 1))
        found = (both_bad >= max(20, common * n_bad)) & (together >= lift) & (chi >= evidence) & (beyond >= 2) & (more >= evidence)
        np.fill_diagonal(found, False)
        return own[found.any(1)]

    def fit(self, sample: Sample, epochs: int = 30, batch: int = 128, rate: float = 0.3, l1: float = 1e-5, lift: float = 3, evidence: float = 12, seed: int = 7) -> None:
        """Adaptive gradient steps on the logistic loss; both classes weigh the same. After each step the
        weights of the slots it touched shrink by l1."""
        self.select(sample, lift, evidence)
        terms, words, offsets = sample.reduced(self.active)
        labels = sample.labels
        random = np.random.default_rng(seed)
        share = np.array([max(1, (labels == k).sum()) for k in (0, 1)])
        weight = (len(labels) / (2 * share))[labels]
        grown, grown_vectors, grown_bias = np.full(len(self.weights), 1e-6), np.full(self.vectors.shape, 1e-6), 1e-6
        for _ in range(epochs):
            order = random.permutation(len(labels))
            for start in range(0, len(order), batch):
                rows = order[start : start + batch]
                counts = offsets[rows + 1] - offsets[rows]
                ends = np.append(0, np.cumsum(counts))
                own = words[np.repeat(offsets[rows] - ends[:-1], counts) + np.arange(ends[-1])]
                margin, inner = self.margins(terms[own], np.arange(len(own)), ends)
                slope = weight[rows] * (1 / (1 + np.exp(-np.clip(margin, -50, 50))) - labels[rows]) / len(rows)
                flat = terms[own].ravel()
                each = np.repeat(np.repeat(slope, counts), terms.shape[1])
                slots, where = np.unique(flat, return_inverse=True)
                step = np.bincount(where, each, len(slots))
                grown[slots] += step**2
                size = rate / np.sqrt(grown[slots])
                moved = self.weights[slots] - size * step
                self.weights[slots] = np.sign(moved) * np.maximum(np.abs(moved) - size * l1, 0)
                around = np.repeat(np.repeat(inner, counts, axis=0), terms.shape[1], axis=0) - self.vectors[flat]
                for f in range(self.vectors.shape[1]):
                    step = np.bincount(where, each * around[:, f], len(slots))
                    grown_vectors[slots, f] += step**2
                    size = 0.2 * rate / np.sqrt(grown_vectors[slots, f])
                    moved = self.vectors[slots, f] - size * step
                    self.vectors[slots, f] = np.sign(moved) * np.maximum(np.abs(moved) - size * l1, 0)
                self.weights[0], self.vectors[0] = 0, 0
                grown_bias += slope.sum() ** 2
                self.bias -= rate * slope.sum() / np.sqrt(grown_bias)


def fold(doc_id: Column, of: int = 3) -> Column:
    """crc32 of the id as text, modulo `of`."""
    return F.crc32(doc_id.cast("string").cast("binary")) % of


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, learn: Column, max_rows: int = 6000, bits: int = 18) -> Machine | None:
    """Fit on at most max_rows labelled rows of each class (those of smallest hash), in one task.

    The sample is bounded by the parameter, whatever the size of the tables; texts become word numbers as they
    arrive. Ties of hash go to the smaller doc_id. Null texts count as empty. None without labels.
    """
    known = labels.filter(learn & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    sizes = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    early = F.lit(False)  # half as many rows again as are wanted, by hash, so that few are ranked
    for kind, n in sizes.items():
        last = 2**63 - 1 if n <= 2 * max_rows else int(1.5 * max_rows / n * 2**64) - 2**63
        early = early | ((F.col("toxic") == kind) & (F.xxhash64("doc_id") <= last))
    order = Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = known.filter(early).withColumn("r", F.row_number().over(order)).filter(F.col("r") <= max_rows).drop("r")
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "text")

    def fit(batches):
        sample = Sample(bits)
        for batch in small_slices(batches, 2000, 8 << 20):
            sample.add(as_bytes(batch), batch.column("toxic").to_pylist())
        if not sample.labels:
            return
        sample.close()
        machine = Machine(bits)
        machine.fit(sample)
        touched = np.flatnonzero(machine.active)
        yield pa.RecordBatch.from_pydict({
            "bias": [machine.bias], "slots": [touched.astype("<i8").tobytes()],
            "weights": [machine.weights[touched].tobytes()], "vectors": [machine.vectors[touched].tobytes()]})

    rows = sample.mapInArrow(fit, "bias double, slots binary, weights binary, vectors binary").collect()
    if not rows:
        return None
    machine = Machine(bits)
    slots = np.frombuffer(rows[0].slots, "<i8")
    machine.bias = rows[0].bias
    machine.vectors[:] = 0
    machine.active[:] = False
    machine.active[slots] = True
    machine.weights[slots] = np.frombuffer(rows[0].weights, np.float32)
    machine.vectors[slots] = np.frombuffer(rows[0].vectors, np.float32).reshape(len(slots), machine.vectors.shape[1])
    return machine


def score(spark: SparkSession, docs: DataFrame, machine: Machine | None) -> DataFrame:
    """Per document its score, from its whole text alone.

    Null and empty text: the score of no terms. Without a machine every score is 0. Repeated rows
    are rows of their own; a long text is scored whole; other columns are not read. One pass without a
    shuffle; an empty table gives no rows.
    """
    model = spark.sparkContext.broadcast(machine)

    def run(batches):
        machine = model.value
        for batch in small_slices(batches, 2000):
            scores = machine.scores(as_bytes(batch)) if machine else np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(scores)], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
