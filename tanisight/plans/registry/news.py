"""Text functions and news operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tanisight.functions import text as tx
from tanisight.functions.temporal import iso_date
from tanisight.operators import clean, news
from tanisight.plans import layers, standins
from tanisight.plans.layers import AS_OF
from tanisight.plans.standins import TEST_FEED, TEST_NEWS, TYPES
from tanisight.plans.views_sql import WS, clean as clean_sql, count_of, hits, rnd, sql, strip, view


def _strip_html(spark, sf):
    pages = standins.table(spark, sf, "pages")
    return pages.select(
        "page_id",
        tx.clean_text(F.col("html")).alias("clean_text"),
        tx.strip_tags(F.col("html")).alias("stripped_text"),
    )


def _article_id(spark, sf):
    return standins.table(spark, sf, "pages").select("page_id", tx.article_id(F.col("url")).alias("article_id"))


def _normalize(spark, sf):
    a = standins.articles(spark, sf)
    return a.select(
        "article_id",
        F.substring("title", 1, 200).alias("title"),
        F.substring(tx.strip_tags(F.col("summary")), 1, 500).alias("summary"),
        F.substring(F.col("ingestion_ts").cast("string"), 1, 10).alias("date"),
    )


def _feed(spark, sf):
    a = standins.articles(spark, sf)
    entries = a.withColumns({"url": F.col("article_id").cast("string")}).withColumnRenamed("article_id", "doc_id")
    return news.feed_articles(entries, TEST_FEED)


def _keyword_arrays(spark, sf):
    names = ("komoditas_matched", "supply_keywords", "sentra_matched")
    return _feed(spark, sf).select("doc_id", *[F.array_join(c, ",").alias(c) for c in names])


def _signal_score(spark, sf):
    s = layers.signals(spark, sf)
    return s.select(
        "article_id", "date", "signal_score",
        F.array_join("komoditas_matched", ",").alias("komoditas"),
        F.array_join(F.array_sort(F.map_keys("gangguan_signals")), ",").alias("phrases"),
        F.array_join("sentra_matched", ",").alias("regions"),
    )


def _dates(spark, sf):
    orders = standins.table(spark, sf, "orders")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    kind = F.col("o_orderkey") % 5
    text = (
        F.when(kind == 0, day)
        .when(kind == 1, F.concat(day, F.lit("T07:30:00Z")))
        .when(kind == 2, F.concat(day, F.lit("T23:59:59.125")))
        .when(kind == 3, F.lit("12:30:15"))
        .otherwise(F.lit("bukan tanggal"))
    )
    return orders.select(text.alias("raw"))


def _iso_date(spark, sf):
    return _dates(spark, sf).groupBy(iso_date("raw").alias("day")).agg(F.count(F.lit(1)).alias("n"))


def _json(spark, sf):
    events = standins.table(spark, sf, "events")
    broken = F.when(F.col("event_id") % 7 == 0, F.substring("props", 1, 4)).otherwise(F.col("props"))
    return events.select("event_id", F.from_json(broken, "k int")["k"].alias("k"))


def _names(spark, sf):
    part = standins.table(spark, sf, "part")
    return part.select(
        F.when(F.col("p_size") % 2 == 0, F.lower("p_type"))
        .otherwise(F.concat(F.lit("  "), F.col("p_type"), F.lit(" "))).alias("name")
    )


def _normalized(spark, sf):
    aliases = spark.createDataFrame(
        [("economy", "ECONOMY"), ("large", "LARGE"), ("medium", "MEDIUM")], "name string, canonical string"
    )
    known = spark.createDataFrame([("promo",), ("small",)], "komoditas string")
    return clean.normalize_names(_names(spark, sf), "name", aliases, known, "komoditas")


def _lookup(spark, sf):
    wanted = _normalized(spark, sf).select(F.upper("komoditas").alias("komoditas")).distinct()
    return wanted.join(standins.regions(spark, sf), "komoditas")


def _sentra_flat(spark, sf):
    nested = standins.regions(spark, sf).groupBy("komoditas").agg(
        F.collect_list(F.struct("nama", "provinsi", "lat", "lon", "bobot")).alias("sentra")
    )
    return nested.select("komoditas", F.inline("sentra"))


def _seen(spark, sf):
    return standins.articles(spark, sf).filter(F.col("article_id") % 3 == 0)


QUERIES = {
    "strip_html": _strip_html,
    "article_id": _article_id,
    "article_normalize": _normalize,
    "keyword_arrays": _keyword_arrays,
    "keyword_match": lambda s, d: news.keyword_pairs(standins.articles(s, d), news.whole_dictionary(TEST_NEWS)),
    "relevance_score": lambda s, d: _feed(s, d).select("doc_id", "relevance_score"),
    "signal_score": _signal_score,
    "news_sentiment": lambda s, d: layers.signals(s, d).select("article_id", "sentiment"),
    "iso_date": _iso_date,
    "date_parse_audit": lambda s, d: clean.date_parse_audit(
        _dates(s, d), "raw", {"date_only": "yyyy-MM-dd", "utc": "yyyy-MM-dd'T'HH:mm:ssX"}),
    "json_extract": _json,
    "normalize_alias": lambda s, d: _normalized(s, d).groupBy("name", "komoditas").agg(F.count(F.lit(1)).alias("n")),
    "sentra_lookup": _lookup,
    "sentra_flat": _sentra_flat,
    "distinct_regions": lambda s, d: standins.regions(s, d).select("nama").distinct(),
    "news_search": lambda s, d: news.search(standins.articles(s, d), "RETION").select("article_id", "source"),
    "new_articles_anti": lambda s, d: news.new_articles(standins.articles(s, d), _seen(s, d)).select(
        "article_id", "source"),
    "mentions_daily": lambda s, d: news.mentions_daily(layers.signals(s, d)),
    "keyword_velocity": lambda s, d: layers.velocity(s, d),
    "top_phrases": lambda s, d: news.top_phrases(layers.signals(s, d), AS_OF),
    "recent_signals": lambda s, d: news.recent_signals(layers.signals(s, d)).select(
        "article_id", "date", "title", "signal_score", "sentiment"),
}

_all_words = news.whole_dictionary(TEST_NEWS)
_names_sql = "CASE WHEN p_size % 2 = 0 THEN lower(p_type) ELSE '  ' || p_type || ' ' END"
_canon_sql = """CASE WHEN k IN ('economy', 'large', 'medium') THEN upper(k) WHEN k IN ('promo', 'small') THEN k END"""
view("names", f"""
SELECT name, {_canon_sql} AS komoditas FROM (SELECT {_names_sql} AS name, lower(trim({_names_sql})) AS k FROM part)""")
view("raw_dates", """
SELECT CASE o_orderkey % 5 WHEN 0 THEN d WHEN 1 THEN d || 'T07:30:00Z' WHEN 2 THEN d || 'T23:59:59.125'
       WHEN 3 THEN '12:30:15' ELSE 'bukan tanggal' END AS raw, o_orderkey % 5 AS kind
FROM (SELECT *, strftime(o_orderdate, '%Y-%m-%d') AS d FROM orders)""")
view("feed", f"""
SELECT article_id AS doc_id, {hits('t', TEST_FEED.commodities)} AS k, {hits('t', TEST_FEED.supply)} AS s,
       {hits('t', TEST_FEED.regions)} AS r FROM feed_text""", "feed_text")
view("mentions", """
SELECT komoditas, date_parsed AS date, count(*) AS n_articles, CAST(sum(signal_score) AS BIGINT) AS total_score
FROM (SELECT *, unnest(topics) AS komoditas FROM signals) GROUP BY 1, 2""", "signals")
_window = f"date BETWEEN DATE '{AS_OF}' - 14 AND DATE '{AS_OF}'"
_type_rows = f"(SELECT unnest([{', '.join(chr(39) + t + chr(39) for t in TYPES)}]) AS komoditas)"
view("velocity", f"""
SELECT k.komoditas, coalesce(today_count, 0) AS today_count, {rnd('coalesce(a, 0)')} AS recent_avg,
       CASE WHEN a > 0 THEN {rnd('coalesce(today_count, 0) / a')} ELSE 0.0 END AS velocity,
       coalesce(avg_score, 0.0) AS avg_score
FROM {_type_rows} k LEFT JOIN (
  SELECT komoditas, CAST(sum(n_articles) FILTER (date = DATE '{AS_OF}') AS BIGINT) AS today_count,
         CAST(sum(n_articles) FILTER (rn <= 7) AS DOUBLE) / count(*) FILTER (rn <= 7) AS a,
         {rnd('CAST(sum(total_score) AS DOUBLE) / sum(n_articles)')} AS avg_score
  FROM (SELECT *, row_number() OVER (PARTITION BY komoditas ORDER BY date DESC) AS rn FROM mentions WHERE {_window})
  GROUP BY 1) USING (komoditas)""", "mentions")
view("phrases", f"""
SELECT * FROM (SELECT komoditas, phrase, count(*) AS n,
         CAST(row_number() OVER (PARTITION BY komoditas ORDER BY count(*) DESC, phrase) AS INT) AS rank
  FROM (SELECT komoditas, unnest(list_transform(phrases, lambda x: x.p)) AS phrase
        FROM (SELECT *, unnest(topics) AS komoditas, date_parsed AS date FROM signals) WHERE {_window})
  GROUP BY 1, 2) WHERE rank <= 5""", "signals")

SQL = {
    "strip_html": f"SELECT page_id, {clean_sql('html')} AS clean_text, {strip('html')} AS stripped_text FROM pages",
    "article_id": "SELECT page_id, CASE WHEN url <> '' THEN substr(sha1(url), 1, 16) END AS article_id FROM pages",
    "article_normalize": sql(
        f"""SELECT article_id, substr(title, 1, 200) AS title, substr({strip('summary')}, 1, 500) AS summary,
        CAST(date_parsed AS VARCHAR) AS date FROM s_news""", "s_news"),
    "keyword_arrays": sql(
        """SELECT doc_id, array_to_string(k, ',') AS komoditas_matched, array_to_string(s, ',') AS supply_keywords,
        array_to_string(r, ',') AS sentra_matched FROM feed WHERE len(k) > 0""", "feed"),
    "keyword_match": sql(
        f"SELECT article_id, unnest({hits('full_text', _all_words)}) AS word FROM news_text", "news_text"),
    "relevance_score": sql(
        "SELECT doc_id, CAST(3 * len(k) + len(s) + 2 * len(r) AS INT) AS relevance_score FROM feed WHERE len(k) > 0",
        "feed"),
    "signal_score": sql(
        """SELECT article_id, date_parsed AS date, signal_score, array_to_string(topics, ',') AS komoditas,
        array_to_string(list_sort(list_transform(phrases, lambda x: x.p)), ',') AS phrases,
        array_to_string(regions, ',') AS regions FROM signals""", "signals"),
    "news_sentiment": sql("SELECT article_id, sentiment FROM signals", "signals"),
    "iso_date": sql(
        "SELECT CASE WHEN kind < 3 THEN CAST(substr(raw, 1, 10) AS DATE) END AS day, count(*) AS n "
        "FROM raw_dates GROUP BY 1", "raw_dates"),
    "date_parse_audit": sql(
        """SELECT count(*) AS n_rows, m AS parse_mode,
        CAST(count_if(CASE m WHEN 'iso8601' THEN kind >= 3 WHEN 'date_only' THEN kind <> 0 ELSE kind <> 1 END) AS BIGINT)
            AS n_unparsed
        FROM raw_dates, (SELECT unnest(['iso8601', 'date_only', 'utc']) AS m) GROUP BY m""", "raw_dates"),
    "json_extract": """SELECT event_id, CASE WHEN json_valid(p) THEN CAST(json_extract(p, '$.k') AS INT) END AS k
        FROM (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN substr(props, 1, 4) ELSE props END AS p FROM events)""",
    "normalize_alias": sql("SELECT name, komoditas, count(*) AS n FROM names GROUP BY 1, 2", "names"),
    "sentra_lookup": sql(
        "SELECT s.* FROM (SELECT DISTINCT upper(komoditas) AS komoditas FROM names) JOIN s_sentra s USING (komoditas)",
        "names", "s_sentra"),
    "sentra_flat": sql("SELECT * FROM s_sentra", "s_sentra"),
    "distinct_regions": sql("SELECT DISTINCT nama FROM s_sentra", "s_sentra"),
    "news_search": sql(
        "SELECT article_id, source FROM s_news WHERE contains(lower(concat_ws(' ', title, summary, source)), 'retion')",
        "s_news"),
    "new_articles_anti": sql("SELECT article_id, source FROM s_news WHERE article_id % 3 <> 0", "s_news"),
    "mentions_daily": sql("SELECT * FROM mentions", "mentions"),
    "keyword_velocity": sql("SELECT * FROM velocity", "velocity"),
    "top_phrases": sql("SELECT * FROM phrases", "phrases"),
    "recent_signals": sql(
        """SELECT article_id, date_parsed AS date, title, signal_score, sentiment FROM signals
        ORDER BY date_parsed DESC, article_id DESC LIMIT 50""", "signals"),
}
