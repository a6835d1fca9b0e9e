"""Sum-of-squares online packing of documents into windows of a fixed number of tokens."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tanisight.llm.common import as_bytes, id_and_text, small_slices
from tanisight.llm.encoding import ByteEncoder, encoder

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long, padded_length long")
WORD = 4  # bytes of an id


class Windows:
    """Partially filled windows of one task, by fill level.

    counts[h] is the number of open windows with h tokens. An item of s tokens goes to the level
    whose choice leaves the smallest sum of counts[h] ** 2 over partial levels; a window that
    becomes full is closed. Ties take the fullest result.

    At the end, and whenever more than max_open windows are open, the emptiest windows are poured
    into the fullest by cutting their documents, so at most one window stays partial.
    """

    def __init__(self, size: int, first_id: int, max_open: int = 4096):
        self.size, self.next_id, self.max_open = size, first_id, max_open
        self.counts = np.zeros(size + 1, np.int64)
        self.levels: list[list[list]] = [[] for _ in range(size + 1)]
        self.open = 0

    def level_for(self, s: int) -> int:
        room = self.size - s
        before, after = self.counts[: room + 1], self.counts[s:].copy()
        after[-1] = 0  # a full window no longer counts
        change = 2 * (after - before) + 2
        change[-1] -= 1
        change[0] -= 1  # an empty window doesn't count before
        change[1:][before[1:] == 0] = np.iinfo(np.int64).max
        return room - int(np.argmin(change[::-1]))

    def place(self, doc, start: int, ids: bytes, total: int) -> Iterator[tuple]:
        s = len(ids) // WORD
        level = self.level_for(s)
        if level:
            window = self.levels[level].pop()
            self.counts[level] -= 1
            self.open -= 1
        else:
            window = []
        window.append((doc, start, ids, total))
        if level + s == self.size:
            yield from self.closed(window)
            return
        self.levels[level + s].append(window)
        self.counts[level + s] += 1
        self.open += 1
        if self.open > self.max_open:
            yield from self.poured(final=False)

    def closed(self, window: list) -> Iterator[tuple]:
        offset, sequence = 0, self.next_id
        self.next_id += 1
        used = sum(len(p[2]) for p in window) // WORD
        width = used if used & (used - 1) == 0 else self.size  # a power of two needs no padding
        for doc, start, ids, total in window:
            n = len(ids) // WORD
            yield doc, start, n, zlib.crc32(ids), total, sequence, offset, width, ids
            offset += n

    def poured(self, final: bool) -> Iterator[tuple]:
        windows = [(h, w) for h in range(self.size - 1, 0, -1) for w in self.levels[h]]
        self.levels = [[] for _ in range(self.size + 1)]
        self.counts[:] = 0
        self.open = 0
        at, last = 0, len(windows) - 1
        while at <= last:
            fill, window = windows[at]
            while fill < self.size and at < last:
                low, source = windows[last]
                doc, start, ids, total = source.pop()
                n = min(self.size - fill, len(ids) // WORD)
                window.append((doc, start, ids[: n * WORD], total))
                if n * WORD < len(ids):
                    source.append((doc, start + n, ids[n * WORD :], total))
                fill, low = fill + n, low - n
                windows[last] = (low, source)
                last -= not source
            if fill == self.size or final:
                yield from self.closed(window)
            else:
                self.levels[fill].append(window)
                self.counts[fill] += 1
                self.open += 1
            at += 1


def pack(docs: DataFrame, path: str, size: int = 2048, end_id: int = 1, with_ids: bool = False) -> DataFrame:
    """Pieces of documents in windows of at most `size` tokens.

    A document's ids are those of the tokenizers library plus end_id. Full windows are cut off its
    front; the rest is placed by the sum-of-squares rule among the task's open windows. Tokens are
    made and placed in one pass over the scan: no shuffle, no key, so no source or copy group can
    overload a task. Sequence ids carry the task's number, so a task that runs again gives the same.

    Null and empty text: the end token alone. Null or repeated doc_id: each row is its own document.
    An empty table gives no rows. with_ids adds the ids of the piece as array<int>.
    """

    def run(batches):
        found, rows = encoder(path, ByteEncoder), []
        windows = Windows(size, TaskContext.get().partitionId() << 33)
        end = end_id.to_bytes(WORD, "little")
        block = size * WORD
        for batch in small_slices(batches, 4000):
            for doc, ids in zip(batch.column("doc_id").to_pylist(), found.encode(as_bytes(batch)), strict=True):
                ids = ids.tobytes() + end
                total = len(ids) // WORD
                cut = len(ids) // block * block
                for at in range(0, cut, block):
                    rows.extend(windows.closed([(doc, at // WORD, ids[at : at + block], total)]))
                if cut < len(ids):
                    rows.extend(windows.place(doc, cut // WORD, ids[cut:], total))
            if len(rows) > 2000:
                yield table(rows)
                rows = []
        rows.extend(windows.poured(final=True))
        if rows:
            yield table(rows)

    names = SCHEMA.replace(",", " ").split()[::2]

    def table(rows):
        *columns, ids = zip(*rows, strict=True)
        arrays = [pa.array(c, pa.int64()) for c in columns]
        if with_ids:
            return pa.RecordBatch.from_arrays([*arrays, pa.array([np.frombuffer(x, "<i4") for x in ids], pa.list_(pa.int32()))], [*names, "ids"])
        return pa.RecordBatch.from_arrays(arrays, names)

    return id_and_text(docs).mapInArrow(run, SCHEMA + ", ids array<int>" * with_ids)
