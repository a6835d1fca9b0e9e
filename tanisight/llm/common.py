"""Helpers shared by the operators: Arrow columns, word hashes, shared files."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame

from tanisight.session import scratch_path

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def id_and_text(docs: DataFrame) -> DataFrame:
    """The two columns that the operators read; other columns cannot clash with theirs."""
    return docs.select("doc_id", "text")


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """The table written to the shared folder and read back. Unlike a checkpoint it has a known size, so that
    Spark broadcasts it where it is small."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def as_bytes(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """UTF-8 of a string column; null counts as empty."""
    return [x or b"" for x in batch.column(name).cast(pa.binary()).to_pylist()]


def slices(batches, rows: int = 512):
    """Arrow batches in small slices, so that Python objects of few rows exist at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def small_slices(batches, rows: int = 500, size: int = 4 << 20, name: str = "text"):
    """Arrow batches in slices of at most so many rows and bytes of text; a longer text is a slice of its own."""
    for batch in batches:
        ends = np.append(0, np.cumsum(pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy(zero_copy_only=False)))
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(ends, ends[start] + size, "right")) - 1
            stop = min(max(stop, start + 1), start + rows, batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


def word_hashes(texts: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words (runs of other than ASCII white space) in a row, and the offset of
    each document (one more than documents). lower: A-Z are lower-cased first. Texts may be no valid UTF-8."""
    values = pa.array(texts, pa.large_binary()).cast(pa.large_string(), safe=False)
    split = pc.ascii_split_whitespace(pc.ascii_lower(values) if lower else values)
    coded = split.flatten().dictionary_encode()
    words = coded.dictionary.cast(pa.large_binary()).to_pylist()
    index, offsets = coded.indices.to_numpy(), split.offsets.to_numpy()
    if b"" in words:  # white space at an end of a text
        some = index != words.index(b"")
        offsets = np.append(0, np.cumsum(some))[offsets]
        index = index[some]
    table = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    return table[index], offsets


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k consecutive values; runs cross documents, callers mask those."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power, span, out, width, factor = hashes, 1, None, 0, int(MULTIPLIER)
    while True:
        if k & span:  # append the power block to what is built so far
            if out is None:
                out, width = power, span
            else:
                out = out[: len(hashes) - width - span + 1] * np.uint64(factor) + power[width : len(hashes) - span + 1]
                width += span
        if width == k:
            return mix(out[:n])
        power = power[: len(hashes) - 2 * span + 1] * np.uint64(factor) + power[span:]
        factor, span = factor * factor % (1 << 64), span * 2


def starts_of(offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """For runs of k words that lie within a document: their global start, and their document's number."""
    counts = np.maximum(np.diff(offsets) - k + 1, 0)
    doc = np.repeat(np.arange(len(counts)), counts)
    first = np.repeat(offsets[:-1] - (np.cumsum(counts) - counts), counts)
    return first + np.arange(len(doc)), doc


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def rows_of(schema: str, **columns) -> pa.RecordBatch:
    """A batch with the named columns; the others are null."""
    kinds = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    n = max(len(c) for c in columns.values())
    fields = [f.strip().split(" ") for f in schema.split(",")]
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[name], kinds[kind]) if name in columns else pa.nulls(n, kinds[kind]) for name, kind in fields],
        [name for name, _ in fields])


def group_of(values: np.ndarray, groups: int) -> np.ndarray:
    return (mix(values.astype(np.uint64)) % np.uint64(groups)).astype(np.int64)


def dealt(parts: np.ndarray, schema: str, kind: int, **columns: np.ndarray):
    """Rows of packed columns, one per part."""
    order = np.argsort(parts, kind="stable")
    sorted_parts = parts[order]
    cuts = np.flatnonzero(np.append(True, sorted_parts[1:] != sorted_parts[:-1])) if len(order) else np.zeros(0, np.int64)
    ends = np.append(cuts[1:], len(order))
    if not len(cuts):
        return
    packed = {name: [c[a:b].tobytes() for a, b in zip(cuts, ends, strict=True)] for name, c in ((k, v[order]) for k, v in columns.items())}
    yield rows_of(schema, part=sorted_parts[cuts].tolist(), kind=[kind] * len(cuts), **packed)


def by_value(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by value (stable) and where each run of equal values begins in it."""
    order = np.argsort(values, kind="stable")
    ranked = values[order]
    return order, np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1])) if len(order) else np.zeros(0, np.int64)


def runs_min(values: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Smallest and largest value of each run, and each element's run."""
    sizes = np.diff(np.append(begins, len(values)))
    return np.minimum.reduceat(values, begins), np.maximum.reduceat(values, begins), np.repeat(np.arange(len(begins)), sizes)


def grouped(batches):
    """(part, rows) of a partition sorted by part."""
    part, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if row["part"] != part:
                if rows:
                    yield part, rows
                part, rows = row["part"], []
            rows.append(row)
    if rows:
        yield part, rows


def packed(rows: list[dict], name: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(r[name] for r in rows if r[name] is not None), kind)
