"""Fill-in-middle: texts cut in three and put together with the middle last.

One match of the regex library covers the whole text as a run of units; the library keeps every
repetition of a captured group, so the number of units and both cuts come from the list of the ends
of that group. Spark puts the output together and takes it apart again.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tanisight.llm.common import small_slices
from tanisight.session import ship_package

UNITS = regex.compile(r"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+)*+")  # possessive: nothing is given back
MARKS = ("<P>", "<S>", "<M>")
CUTS = "doc_id long, text string, n long, form string, prefix_chars long, middle_chars long"


def numbers(seed: int, doc_id: int | None) -> list[int]:
    """The first four groups of eight digits of the id's digest."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[k : k + 8], 16) for k in (0, 8, 16, 24)]


def cut(doc_id: int | None, text: str, seed: int, rate: int, spm_rate: int) -> tuple[int, str, int | None, int | None]:
    """Units, form, and the characters of prefix and middle (None in a plain text)."""
    ends = UNITS.fullmatch(text).ends(1)
    n = len(ends)
    first, second, chosen, kind = numbers(seed, doc_id)
    if not n or chosen % 100 >= rate or any(m in text for m in MARKS):
        return n, "plain", None, None
    low, high = sorted((first % (n + 1), second % (n + 1)))
    begin, end = (ends[k - 1] if k else 0 for k in (low, high))
    return n, "spm" if kind % 100 < spm_rate else "psm", begin, end - begin


def assemble() -> Column:
    """The output of the columns text, form, prefix_chars and middle_chars."""
    begin, size = F.col("prefix_chars").cast("int"), F.col("middle_chars").cast("int")
    prefix, middle = F.substring("text", F.lit(1), begin), F.substring("text", begin + 1, size)
    suffix = F.substring("text", begin + size + 1, F.char_length("text"))
    return (F.when(F.col("form") == "psm", F.concat(F.lit("<P>"), prefix, F.lit("<S>"), suffix, F.lit("<M>"), middle))
            .when(F.col("form") == "spm", F.concat(F.lit("<S>"), suffix, F.lit("<P>"), prefix, F.lit("<M>"), middle))
            .otherwise(F.col("text")))


def restore(output: Column, form: Column) -> Column:
    """The text, from output and form alone. A transformed text holds each mark once: its own text has none,
    and no mark can arise across a seam, since each begins with < and ends with >."""
    second = F.when(form == "psm", F.lit("<S>")).otherwise(F.lit("<P>"))
    body = F.substring(output, F.lit(4), F.char_length(output))
    one = F.when(form == "psm", F.substring_index(body, "<S>", 1)).otherwise(F.substring_index(body, "<P>", 1))
    rest = F.substring(body, F.char_length(one) + F.char_length(second) + 1, F.char_length(body))
    two = F.substring_index(rest, "<M>", 1)
    middle = F.substring(rest, F.char_length(two) + 4, F.char_length(rest))
    return F.when(form == "psm", F.concat(one, middle, two)).when(form == "spm", F.concat(two, middle, one)).otherwise(output)


def transform(docs: DataFrame, seed: int = 42, rate: int = 50, spm_rate: int = 80) -> DataFrame:
    """Per row: doc_id, text (null: empty), n units, form, prefix_chars, middle_chars and output.

    Draws come from the digest of `seed:doc_id`, so rows that repeat a doc_id are drawn alike and each is cut by
    its own text; a null doc_id counts as empty in the digest. Empty texts and texts with a mark are plain. Other
    columns are left out, an empty table gives no rows, and there is no shuffle.
    """
    ship_package(docs.sparkSession)

    def run(batches):
        for batch in small_slices(batches):
            ids = batch.column("doc_id").to_pylist()
            texts = [t or "" for t in batch.column("text").to_pylist()]
            found = [cut(i, t, seed, rate, spm_rate) for i, t in zip(ids, texts, strict=True)]
            n, form, prefix, middle = zip(*found, strict=True) if found else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(texts, pa.string()), pa.array(n, pa.int64()), pa.array(form, pa.string()),
                 pa.array(prefix, pa.int64()), pa.array(middle, pa.int64())],
                ["doc_id", "text", "n", "form", "prefix_chars", "middle_chars"])

    return docs.select("doc_id", "text").mapInArrow(run, CUTS).withColumn("output", assemble())
