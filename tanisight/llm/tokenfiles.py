"""Token ids as Arrow files of equal-length sequences.

Each task owns a range of doc_id and writes two files of the Arrow file format, whose batches can
be mapped and read at random without copying:

- ``part-N.ids.arrow``: ``ids`` fixed_size_list<uint16 or uint32>[length] and ``mask``
  fixed_size_list<bool>[length]. Documents follow each other without gaps; the mask is false on
  the padding of the file's last sequence. All batches but the last have the same number of rows,
  so position p lies in batch p // (rows * length).
- ``part-N.docs.arrow``: doc_id, start (position in the file) and n_tokens of each document.

A file is written under a name of its own and then renamed, so a task that runs again, or twice at
once, leaves the same whole file.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tanisight.llm.common import as_bytes, id_and_text, slices
from tanisight.llm.encoding import WordEncoder, encoder
from tanisight.session import scratch_path

MANIFEST = "part long, folder string, n_docs long, n_tokens long"
SPANS = "part long, doc_id long, start_in_part long, n_tokens long, ids_crc32 long"


class SequenceWriter:
    """Appends ids to equal-length sequences; a batch is written as soon as it is full."""

    def __init__(self, sink, length: int, rows: int, kind):
        self.length, self.block, self.kind = length, length * rows, np.dtype(kind)
        self.schema = pa.schema([
            ("ids", pa.list_(pa.field("item", pa.from_numpy_dtype(self.kind), False), length)),
            ("mask", pa.list_(pa.field("item", pa.bool_(), False), length)),
        ], {"length": str(length), "rows": str(rows)})
        self.writer = pa.ipc.new_file(sink, self.schema)
        self.waiting: list[np.ndarray] = []
        self.count = 0

    def append(self, ids: np.ndarray) -> None:
        self.waiting.append(ids)
        self.count += len(ids)
        if self.count >= self.block:
            data = np.concatenate(self.waiting)
            whole = len(data) // self.block * self.block
            for at in range(0, whole, self.block):
                self._write(data[at : at + self.block], self.block)
            self.waiting, self.count = [data[whole:]], len(data) - whole

    def _write(self, data: np.ndarray, used: int) -> None:
        mask = np.arange(len(data)) < used
        self.writer.write_batch(pa.RecordBatch.from_arrays([
            pa.FixedSizeListArray.from_arrays(pa.array(data), type=self.schema.field("ids").type),
            pa.FixedSizeListArray.from_arrays(pa.array(mask), type=self.schema.field("mask").type),
        ], schema=self.schema))

    def close(self) -> None:
        if self.count:
            data = np.zeros(-(-self.count // self.length) * self.length, self.kind)
            data[: self.count] = np.concatenate(self.waiting)
            self._write(data, self.count)
        self.writer.close()


class Sequences:
    """Random access to one file; a local file is mapped, so slices are views of it."""

    def __init__(self, folder: str, part: int):
        files, path = pafs.FileSystem.from_uri(folder)
        name = f"{path}/part-{part:06d}"
        self.source = pa.memory_map(f"{name}.ids.arrow") if isinstance(files, pafs.LocalFileSystem) else files.open_input_file(f"{name}.ids.arrow")
        self.reader = pa.ipc.open_file(self.source)
        meta = self.reader.schema.metadata
        self.block = int(meta[b"length"]) * int(meta[b"rows"])
        with files.open_input_file(f"{name}.docs.arrow") as f:
            self.docs = pa.ipc.open_file(f).read_all()
        self._at, self._view = -1, np.zeros(0, np.uint16)

    def batch(self, k: int) -> np.ndarray:
        if k != self._at:
            self._at = k
            self._view = self.reader.get_batch(k).column("ids").flatten().to_numpy(zero_copy_only=True)
        return self._view

    def ids(self, start: int, count: int) -> np.ndarray:
        found = []
        while count:
            k, offset = divmod(start, self.block)
            view = self.batch(k)[offset : offset + count]
            found.append(view)
            start, count = start + len(view), count - len(view)
        return found[0] if len(found) == 1 else np.concatenate(found) if found else np.zeros(0, np.uint16)

    def close(self) -> None:
        self._view = np.zeros(0, np.uint16)
        self.source.close()


def write(docs: DataFrame, folder: str, path: str, length: int = 2048, end_id: int = 2, rows: int = 64) -> DataFrame:
    """Write the files below `folder`, ids in ascending doc_id order over all files; one row per file.

    Documents are dealt by ranges of doc_id and sorted within; text, not ids, is shuffled, since
    ids would be made twice (Spark samples the rows to choose the ranges). Rows with one doc_id
    are ordered by text. Null doc_id comes first; null text is empty and has the end id alone.
    """

    def run(batches):
        found = encoder(path, WordEncoder)
        kind = np.uint16 if len(found.is_final) <= 1 << 16 else np.uint32
        part = TaskContext.get().partitionId()
        files, base = pafs.FileSystem.from_uri(folder)
        files.create_dir(base, recursive=True)
        name, own = f"{base}/part-{part:06d}", uuid.uuid4().hex
        writer, spans, total = None, [], 0
        for batch in slices(batches, 4000):
            if writer is None:
                sink = files.open_output_stream(f"{name}.ids.{own}")
                writer = SequenceWriter(sink, length, rows, kind)
            for doc, data in zip(batch.column("doc_id").to_pylist(), found.encode(as_bytes(batch)), strict=True):
                ids = np.append(data, end_id).astype(kind)
                writer.append(ids)
                spans.append((doc, total, len(ids)))
                total += len(ids)
        if writer is None:
            return
        writer.close()
        sink.close()
        table = pa.table([pa.array(c, pa.int64()) for c in zip(*spans, strict=True)], ["doc_id", "start", "n_tokens"])
        with files.open_output_stream(f"{name}.docs.{own}") as f, pa.ipc.new_file(f, table.schema) as out:
            out.write_table(table)
        for kind_of in ("ids", "docs"):
            files.move(f"{name}.{kind_of}.{own}", f"{name}.{kind_of}.arrow")
        yield pa.RecordBatch.from_pydict({"part": [part], "folder": [folder], "n_docs": [len(spans)], "n_tokens": [total]})

    ordered = id_and_text(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return ordered.mapInArrow(run, MANIFEST)


def read(manifest: DataFrame) -> DataFrame:
    """Per document: its part, place and the CRC-32 of its ids, from the files alone."""

    def run(batches):
        for batch in batches:
            for part, folder in zip(batch.column("part").to_pylist(), batch.column("folder").to_pylist(), strict=True):
                file = Sequences(folder, part)
                for spans in file.docs.to_batches(10_000):
                    where = zip(spans.column("start").to_pylist(), spans.column("n_tokens").to_pylist(), strict=True)
                    sums = [zlib.crc32(file.ids(a, n).astype("<u4").tobytes()) for a, n in where]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([part] * spans.num_rows, pa.int64()), spans.column("doc_id"), spans.column("start"),
                        spans.column("n_tokens"), pa.array(sums, pa.int64()),
                    ], ["part", "doc_id", "start_in_part", "n_tokens", "ids_crc32"])
                file.close()

    tasks = max(1, min(manifest.count(), 10_000))  # a fixed number: the manifest is so small that Spark would read all files in one task
    return manifest.select("part", "folder").repartition(tasks, "part").mapInArrow(run, SPANS)


def saved(spark: SparkSession, docs: DataFrame, path: str, **options) -> DataFrame:
    """Write all documents and read them back: doc_id, start, n_tokens, ids_crc32, part.

    Only one row per file (its number of tokens) is brought together to place the files behind each
    other. An empty table gives no files and no rows.
    """
    folder = scratch_path(spark, "tokens")
    listing = folder + "/manifest"
    write(docs, folder + "/files", path, **options).write.parquet(listing)
    manifest = spark.read.schema(MANIFEST).parquet(listing)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = manifest.select("part", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))
    return read(manifest).join(bases, "part").select(
        "doc_id", (F.col("base") + F.col("start_in_part")).alias("start"), "n_tokens", "ids_crc32", "part")
