"""Text cleaning and dictionary matching, all as built-in expressions.

A match list is an array of ``when(contains(text, word), word)``. The cleaned text is added with
``pin`` before it is matched, so it is computed once per row however many words the dictionary
has and whatever filters follow.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The characters that count as white space (Unicode White_Space plus the four
# information separators). Printable ASCII is ruled out first: one check for nearly all text.
_SPACES = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WHITE_SPACE = f"[[^!-~]&&[{_SPACES}]]"
SPACE_CHARS = "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + (
    "\u2028\u2029\u202f\u205f\u3000"
)
TAG = r"<[^>]+>"
# A run of white space that is not already one blank.
LONG_GAP = f" {WHITE_SPACE}+|[[^ -~]&&[{_SPACES}]]{WHITE_SPACE}*"


def pin(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column that later steps may use many times.

    A plain ``withColumn`` is not enough: a filter on something derived from it is pushed below
    it, and the optimizer then repeats the whole expression once per use inside the filter.
    Filters are not pushed through a generator, so a one-element explode keeps the value.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def clean_text(x: Column) -> Column:
    """Tags to blanks, lower case, runs of white space to one blank, trimmed."""
    no_tags = F.regexp_replace(F.coalesce(x, F.lit("")), TAG, " ")
    return F.trim(F.regexp_replace(F.lower(no_tags), LONG_GAP, " "))


def strip_tags(x: Column) -> Column:
    """Tags removed, white space cut at both ends only."""
    no_tags = F.regexp_replace(F.coalesce(x, F.lit("")), TAG, "")
    return F.btrim(no_tags, F.lit(SPACE_CHARS))


def join_title(title: Column, summary: Column) -> Column:
    return F.concat_ws("  ", title, summary)


def article_id(url: Column) -> Column:
    """First 16 hex digits of the SHA-1 of the address, null without one."""
    return F.when(url != "", F.substring(F.sha1(url.cast("binary")), 1, 16))


def _hit(text: Column, word: str, whole_words: bool) -> Column:
    if whole_words:
        return text.rlike(r"(?<![\p{L}\p{N}])\Q" + word + r"\E(?![\p{L}\p{N}])")
    return F.contains(text, F.lit(word))


def any_word(text: Column, words: Sequence[str], whole_words: bool = False) -> Column:
    """Whether one of the words occurs; stops at the first."""
    return reduce(Column.__or__, [_hit(text, w, whole_words) for w in words])


def matched_words(text: Column, words: Sequence[str], whole_words: bool = False) -> Column:
    """Sorted distinct words that occur in the (lower-case) text as plain substrings."""
    hits = [F.when(_hit(text, w, whole_words), F.lit(w)) for w in sorted(set(words))]
    return F.array_compact(F.array(*hits)) if hits else F.array().cast("array<string>")


def matched_topics(text: Column, topics: Mapping[str, Sequence[str]], whole_words: bool = False) -> Column:
    """Names of the topics with at least one word in the text, in dictionary order."""
    hits = [
        F.when(any_word(text, words, whole_words), F.lit(name))
        for name, words in topics.items()
    ]
    return F.array_compact(F.array(*hits))


def matched_weights(text: Column, weights: Mapping[str, int], whole_words: bool = False) -> Column:
    """Map of the phrases that occur to their weights."""
    entries = [
        F.when(_hit(text, phrase, whole_words), F.struct(F.lit(phrase).alias("key"), F.lit(weight).alias("value")))
        for phrase, weight in weights.items()
    ]
    return F.map_from_entries(F.array_compact(F.array(*entries)))


def count_hits(text: Column, words: Sequence[str]) -> Column:
    """How many of the words occur."""
    return reduce(Column.__add__, [F.contains(text, F.lit(w)).cast("int") for w in words])


def title_label(x: Column) -> Column:
    """``a_b`` to ``A B``."""
    return F.initcap(F.regexp_replace(x, "_", " "))


def rupiah(x: Column) -> Column:
    """Amount without decimals and with thousands separators, e.g. ``Rp12,500``."""
    return F.concat(F.lit("Rp"), F.format_number(x, 0))


def signed_one(x: Column) -> Column:
    """One decimal with its sign, e.g. ``+3.5``; null stays null (a bare format prints text)."""
    return F.when(x.isNotNull(), F.format_string("%+.1f", x))


def one_decimal(x: Column) -> Column:
    return F.when(x.isNotNull(), F.format_string("%.1f", x))
