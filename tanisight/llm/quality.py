"""Line-first cleaning in SQL expressions: lines are judged one by one, then what is left of a document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]"
BLANKS = " \t\n\x0b\f\r"
WINDOW = 8

#: Line rules.
SYMBOL_RUN = r"[#*$%&!]{2,}"
SEPARATOR = r"[|»›•]"
TERMINAL = r"""[.!?…:;。！？]["'”’»)\]]*[\x20\x09-\x0D]*$"""
BOILERPLATE = (
    r"(?i)all rights reserved|privacy policy|cookie|terms of (use|service)|lorem ipsum|javascript"
    r"|click here|subscribe|sign (in|up)|log ?in"
)


def bound(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed once per row: the optimiser does not copy them into later lambdas."""
    names = [c for c in df.columns if c not in columns]
    fresh = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select(*names, F.inline(F.array(fresh)))


def split_words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE + "+"))


def line_fails(line: Column, words: Column, min_words: int) -> Column:
    """Punctuation: many symbol runs, or a short line without an end mark. Navigation: separators
    between few words. Boilerplate: a short line with a stock phrase."""
    symbols = F.size(F.regexp_extract_all(line, F.lit(SYMBOL_RUN), F.lit(0)))
    separators = F.size(F.regexp_extract_all(line, F.lit(SEPARATOR), F.lit(0)))
    return (
        (symbols * 10 > words * 3)
        | ((words < min_words) & ~line.rlike(TERMINAL))
        | ((separators >= 3) & (separators * 5 >= words))
        | ((words <= 25) & line.rlike(BOILERPLATE))
    )


def clean(docs: DataFrame, max_lost: int = 50, min_words: int = 5) -> DataFrame:
    """Per document: counts, base_failed, kept, and text_clean without the lines that fail.

    Words are runs of other than ASCII white space; lines are split at ``\\n``. base_failed: fewer
    than 20 words, or over 30 % of them in 8-word windows that occur twice in the text. kept: not
    base_failed, and the failing lines hold at most max_lost percent of the words.

    Null and empty text: no words, base_failed. Rows are judged one by one, without a shuffle, so
    repeated rows and hot sources change nothing; an empty table gives no rows.
    """
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t"))
    d = bound(d, words=split_words(F.col("t")), lines=F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    d = bound(
        d, n_words=F.size("words").cast("long"), hashes=F.transform("words", lambda w: F.xxhash64(w)),
        word_chars=F.char_length(F.regexp_replace("t", SPACE + "+", "")).cast("long"),
        n_symbols=(F.char_length("t") - F.char_length(F.regexp_replace("t", r"[#*$%&|<>]+", ""))).cast("long"),
        n_dup_lines=(F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        judged=F.transform("lines", judge(min_words)),
    ).drop("words", "lines")
    d = with_repeats(d)
    lost = F.aggregate("judged", F.lit(0).cast("long"), lambda s, x: s + F.when(x.fails, x.words).otherwise(0))
    failed = (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)
    d = bound(d, base_failed=failed, n_lost_words=lost)
    left = F.array_join(F.transform(F.filter("judged", lambda x: ~x.fails), lambda x: x.line), "\n")
    return d.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.col("n_lost_words") * 100 <= F.col("n_words") * max_lost)).alias("kept"),
        "n_lost_words", left.alias("text_clean"))


def judge(min_words: int):
    def one(line: Column) -> Column:
        words = F.size(split_words(line)).cast("long")
        return F.struct(line.alias("line"), words.alias("words"), line_fails(line, words, min_words).alias("fails"))

    return one


def with_repeats(d: DataFrame) -> DataFrame:
    """n_repeat_words from `hashes`: words in windows of 8 that occur at least twice in the row.

    Most texts repeat no window: the hashes are then distinct and nothing is sorted. Otherwise the
    windows are sorted by hash; equal neighbours give the places, and each covers up to its next.
    """
    windows = F.when(
        F.col("n_words") > WINDOW,
        F.transform(F.sequence(F.lit(1), F.col("n_words").cast("int") - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("hashes", i, WINDOW))),
    ).otherwise(F.array().cast("array<bigint>"))
    d = bound(d, windows=windows).drop("hashes")
    placed = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    nothing = F.array().cast("array<struct<h:bigint,i:int>>")
    d = bound(d, placed=F.when(F.size(F.array_distinct("windows")) < F.size("windows"), placed).otherwise(nothing)).drop("windows")

    def twice(x: Column, k: Column) -> Column:
        return F.coalesce(x.h == F.get("placed", k - 1).h, F.lit(False)) | F.coalesce(x.h == F.get("placed", k + 1).h, F.lit(False))

    d = bound(d, places=F.sort_array(F.transform(F.filter("placed", twice), lambda x: x.i))).drop("placed")
    covered = F.transform("places", lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get("places", k + 1) - p, F.lit(WINDOW))))
    return bound(d, n_repeat_words=F.aggregate(covered, F.lit(0).cast("long"), lambda s, x: s + x)).drop("places")
