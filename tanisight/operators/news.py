"""News: accepted feed entries, article signals, mention counts and their velocity."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tanisight.dims import FeedDictionary, NewsDictionary
from tanisight.functions import text as tx
from tanisight.functions.numeric import rnd
from tanisight.operators.dedup import top_rows


def feed_articles(entries: DataFrame, words: FeedDictionary) -> DataFrame:
    """Feed entries (source, url, title, summary, published) that name a commodity, scored
    3 per commodity word, 1 per supply word, 2 per region."""
    stripped = entries.withColumns(
        {"title": tx.strip_tags(F.col("title")), "summary": tx.strip_tags(F.col("summary"))}
    )
    lowered = tx.pin(stripped, "_text", F.lower(tx.join_title(F.col("title"), F.col("summary"))))
    matched = lowered.filter(tx.any_word(F.col("_text"), words.commodities)).withColumns(
        {
            "komoditas_matched": tx.matched_words(F.col("_text"), words.commodities),
            "supply_keywords": tx.matched_words(F.col("_text"), words.supply),
            "sentra_matched": tx.matched_words(F.col("_text"), words.regions),
        }
    )
    score = (
        3 * F.size("komoditas_matched") + F.size("supply_keywords") + 2 * F.size("sentra_matched")
    )
    return matched.withColumns(
        {
            "article_id": tx.article_id(F.col("url")),
            "summary": F.substring("summary", 1, 500),
            "relevance_score": score,
        }
    ).drop("_text")


def article_text(articles: DataFrame) -> DataFrame:
    """Articles with their cleaned title and summary in ``full_text``."""
    return tx.pin(
        articles,
        "full_text",
        tx.join_title(tx.clean_text(F.col("title")), tx.clean_text(F.col("summary"))),
    )


def sentiment(up: Column, down: Column) -> Column:
    return F.when(up > down, "bullish").when(down > up, "bearish").otherwise("neutral")


def extract_signals(
    articles: DataFrame, words: NewsDictionary, day: str = "date_parsed", whole_words: bool = False
) -> DataFrame:
    """Signal per article that names a commodity: what it names, its score and its direction."""
    full = F.col("full_text")
    matched = (
        article_text(articles)
        .filter(tx.any_word(full, [w for ws in words.topics.values() for w in ws], whole_words))
        .withColumns(
            {
                "komoditas_matched": tx.matched_topics(full, words.topics, whole_words),
                "gangguan_signals": tx.matched_weights(full, words.disruptions, whole_words),
                "sentra_matched": tx.matched_words(full, words.regions, whole_words),
                "_up": tx.count_hits(full, words.bullish),
                "_down": tx.count_hits(full, words.bearish),
            }
        )
    )
    weights = F.aggregate(F.map_values("gangguan_signals"), F.lit(0), lambda a, b: a + b)
    score = 3 * F.size("komoditas_matched") + weights + 2 * F.size("sentra_matched")
    return matched.select(
        "article_id",
        "source",
        F.substring("title", 1, 200).alias("title"),
        F.col(day).alias("date"),
        "komoditas_matched",
        "gangguan_signals",
        "sentra_matched",
        score.alias("signal_score"),
        sentiment(F.col("_up"), F.col("_down")).alias("sentiment"),
    )


def keyword_pairs(articles: DataFrame, words: Sequence[str]) -> DataFrame:
    """One row per article and word that occurs in it."""
    found = article_text(articles).withColumn("_words", tx.matched_words(F.col("full_text"), words))
    return found.select("article_id", F.explode("_words").alias("word"))


def mentions_daily(signals: DataFrame) -> DataFrame:
    """Articles and total score per commodity and day."""
    return (
        signals.select("date", "signal_score", F.explode("komoditas_matched").alias("komoditas"))
        .groupBy("komoditas", "date")
        .agg(F.count(F.lit(1)).alias("n_articles"), F.sum("signal_score").alias("total_score"))
    )


def _recent(df: DataFrame, as_of: str, window_days: int) -> DataFrame:
    today = F.lit(as_of).cast("date")
    return df.filter((F.col("date") >= F.date_sub(today, 2 * window_days)) & (F.col("date") <= today))


def keyword_velocity(
    signals: DataFrame, commodities: DataFrame, as_of: str, window_days: int = 7
) -> DataFrame:
    """Articles of the day over the mean of the last days that have any, per commodity.

    Articles are counted per day first; ranking days touches at most 2 * window + 1 rows each.
    """
    daily = mentions_daily(_recent(signals, as_of, window_days))
    newest = Window.partitionBy("komoditas").orderBy(F.col("date").desc())
    ranked = daily.withColumn("_rank", F.row_number().over(newest))
    recent = F.col("_rank") <= window_days
    stats = ranked.groupBy("komoditas").agg(
        F.sum(F.when(F.col("date") == F.lit(as_of).cast("date"), F.col("n_articles"))).alias("today_count"),
        (F.sum(F.when(recent, F.col("n_articles"))) / F.count_if(recent)).alias("_avg"),
        rnd(F.sum("total_score") / F.sum("n_articles"), 2).alias("avg_score"),
    )
    filled = commodities.select("komoditas").join(stats, "komoditas", "left").fillna(
        0, subset=["today_count", "_avg", "avg_score"]
    )
    return filled.select(
        "komoditas",
        "today_count",
        rnd("_avg", 2).alias("recent_avg"),
        F.when(F.col("_avg") > 0, rnd(F.col("today_count") / F.col("_avg"), 2)).otherwise(0.0).alias("velocity"),
        "avg_score",
    )


def top_phrases(signals: DataFrame, as_of: str, k: int = 5, window_days: int = 7) -> DataFrame:
    """The ``k`` most frequent disruption phrases per commodity, ties by phrase."""
    counts = (
        _recent(signals, as_of, window_days)
        .select(F.explode("komoditas_matched").alias("komoditas"), "gangguan_signals")
        .select("komoditas", F.explode(F.map_keys("gangguan_signals")).alias("phrase"))
        .groupBy("komoditas", "phrase")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return top_rows(counts, ["komoditas"], [F.col("n").desc(), F.col("phrase")], k).withColumnRenamed(
        "_rank", "rank"
    )


def phrase_lists(top: DataFrame) -> DataFrame:
    """Top phrases per commodity as one array in rank order (at most k entries)."""
    ordered = F.array_sort(F.collect_list(F.struct("rank", "phrase")))
    return top.groupBy("komoditas").agg(F.transform(ordered, lambda x: x["phrase"]).alias("top_signals"))


def recent_signals(signals: DataFrame, n: int = 50) -> DataFrame:
    """The newest ``n`` signals."""
    return signals.orderBy(F.col("date").desc(), F.col("article_id").desc()).limit(n)


def search(articles: DataFrame, keyword: str) -> DataFrame:
    """Articles whose title, summary or source contain the keyword, ignoring case."""
    haystack = F.lower(F.concat_ws(" ", "title", "summary", "source"))
    return articles.filter(F.contains(haystack, F.lit(keyword.lower())))


def new_articles(articles: DataFrame, seen: DataFrame) -> DataFrame:
    """Articles whose id was not seen before. No cap on what is remembered."""
    return articles.join(seen.select("article_id"), "article_id", "left_anti")


def whole_dictionary(words: NewsDictionary) -> list[str]:
    topics = reduce(lambda a, b: a + b, words.topics.values(), [])
    return sorted({*topics, *words.disruptions, *words.regions})
