"""The same stand-ins and layers as plain SQL, for checking results in a second engine.

``sql(body, *names)`` puts the named common table expressions (and what they need) in front of
a query. Text only; nothing here is run by Spark.
"""

from __future__ import annotations

from tanisight.plans.standins import INDICATORS, PRICE_TIE, TEST_FEED, TEST_NEWS, TYPES

_VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {}


def view(name: str, body: str, *needs: str) -> None:
    _VIEWS[name] = (body, needs)


def sql(body: str, *names: str) -> str:
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for need in _VIEWS[name][1]:
            visit(need)
        ordered.append(name)

    for name in names:
        visit(name)
    ctes = ",\n".join(f"{n} AS MATERIALIZED ({_VIEWS[n][0]})" for n in ordered)
    return f"WITH {ctes}\n{body}" if ordered else body


def rnd(x: str, digits: int = 2) -> str:
    f = f"{10**digits}.0::DOUBLE"
    return f"(floor(({x}) * {f} + 0.5) / {f})"


def esum(x: str, scale: int = 2) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(18,{scale}))) AS DOUBLE)"


def eavg(x: str, scale: int = 2) -> str:
    return f"({esum(x, scale)} / count({x}))"


def clamp(x: str, low: float, high: float) -> str:
    return f"(CASE WHEN {x} IS NOT NULL THEN least(greatest({x}, {low}::DOUBLE), {high}::DOUBLE) END)"


def pct(new: str, old: str) -> str:
    return f"(CASE WHEN {old} <> 0 THEN ({new} / {old} - 1) * 100 END)"


WS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def clean(x: str) -> str:
    return (
        f"trim(regexp_replace(lower(regexp_replace(coalesce({x}, ''), '<[^>]+>', ' ', 'g')), "
        f"'{WS}+', ' ', 'g'), ' ')"
    )


def strip(x: str) -> str:
    return (
        f"regexp_replace(regexp_replace(coalesce({x}, ''), '<[^>]+>', '', 'g'), "
        f"'^{WS}+|{WS}+$', '', 'g')"
    )


def hits(text: str, words: list[str]) -> str:
    """Sorted list of the words that occur."""
    items = ", ".join(f"CASE WHEN contains({text}, '{w}') THEN '{w}' END" for w in sorted(set(words)))
    return f"list_filter([{items}], lambda x: x IS NOT NULL)"


def count_of(text: str, words: list[str]) -> str:
    return "(" + " + ".join(f"CAST(contains({text}, '{w}') AS INT)" for w in words) + ")"


def topics(text: str, names: dict[str, list[str]]) -> str:
    items = ", ".join(
        f"CASE WHEN {' OR '.join(f'contains({text}, {chr(39)}{w}{chr(39)})' for w in ws)} THEN '{n}' END"
        for n, ws in names.items()
    )
    return f"list_filter([{items}], lambda x: x IS NOT NULL)"


TYPE_LIST = ", ".join(f"'{t}'" for t in TYPES)
LINE_ORDER = ", ".join(PRICE_TIE)

view("s_price", """
SELECT r_name AS source, p_type AS commodity, l_extendedprice AS price,
       CAST(l_shipdate AS DATE) AS day, lineitem.*
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
     JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")

view("silver_prices", f"""
SELECT source, source AS data_source, commodity AS komoditas, price AS price_idr_per_kg, day AS date_parsed
FROM s_price QUALIFY row_number() OVER (PARTITION BY source, commodity, day ORDER BY {LINE_ORDER}) = 1""",
     "s_price")

view("daily", f"""
SELECT date_parsed, komoditas, {rnd(eavg('price_idr_per_kg'))} AS avg_price,
       count(DISTINCT source) AS n_sources
FROM silver_prices GROUP BY 1, 2""", "silver_prices")

view("series", """
SELECT date_parsed, komoditas, avg_price, CAST(round(avg_price * 100) AS BIGINT) AS cents FROM daily""", "daily")

view("silver_kurs", """
SELECT o_orderstatus AS source, CAST(o_orderdate AS DATE) AS date_parsed, o_totalprice AS kurs_tengah,
       'USD/IDR' AS pair
FROM orders
QUALIFY row_number() OVER (PARTITION BY o_orderstatus, CAST(o_orderdate AS DATE) ORDER BY o_orderkey, o_custkey) = 1""")

view("daily_fx", f"SELECT date_parsed, {eavg('kurs_tengah')} AS kurs_usd_idr FROM silver_kurs GROUP BY 1",
     "silver_kurs")

view("s_wx", """
SELECT 'S' || (user_id % 25) AS sentra, value AS precipitation,
       CAST(json_extract(props, '$.k') AS INT) AS weather_code, CAST(user_id % 45 AS DOUBLE) AS temperature_2m,
       CAST(CAST(ts AS DATE) - INTERVAL 26 YEAR AS DATE) AS date_parsed, ts AS seen_at, event_id
FROM events""")

view("silver_weather", """
SELECT * FROM s_wx QUALIFY row_number() OVER (PARTITION BY sentra, date_parsed ORDER BY seen_at, event_id) = 1""",
     "s_wx")

view("daily_weather", f"""
SELECT date_parsed, {rnd(eavg('precipitation'), 1)} AS precipitation_sum,
       {rnd(eavg('temperature_2m'), 1)} AS temperature_max
FROM silver_weather GROUP BY 1""", "silver_weather")

view("s_news", """
SELECT doc_id AS article_id, source, substr(text, 1, 200) AS title, text AS summary,
       DATE '1998-01-01' + CAST(doc_id % 365 AS INT) AS date_parsed
FROM documents""")

view("feed_text", f"""
SELECT article_id, source, date_parsed, lower({strip('title')} || '  ' || {strip('summary')}) AS t FROM s_news""",
     "s_news")

view("scored_news", f"""
SELECT article_id, source, date_parsed,
       3 * {count_of('t', TEST_FEED.commodities)} + {count_of('t', TEST_FEED.supply)}
       + 2 * {count_of('t', TEST_FEED.regions)} AS relevance_score
FROM feed_text""", "feed_text")

view("daily_news", f"""
SELECT date_parsed, {rnd(eavg('coalesce(relevance_score, 0)', 4))} AS news_score, count(*) AS article_count
FROM scored_news GROUP BY 1""", "scored_news")

view("news_velocity", f"""
SELECT date_parsed, news_score, article_count, {rnd('article_count / m')} AS news_velocity
FROM (SELECT *, CAST(sum(article_count) OVER w AS DOUBLE) / count(*) OVER w AS m FROM daily_news
      WINDOW w AS (ORDER BY date_parsed ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))""", "daily_news")

view("silver_macro", f"""
SELECT o_orderstatus AS source, 'ind_' || substr(o_orderpriority, 1, 1) AS indicator,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS date_parsed, {esum('o_totalprice')} AS value
FROM orders GROUP BY 1, 2, 3""")

_pivot_cols = ",\n".join(
    f"max(CASE WHEN indicator = '{i}' THEN value END) AS {i}" for i in INDICATORS
)
view("macro_pivot", f"""
SELECT date_parsed, {_pivot_cols}
FROM (SELECT * FROM silver_macro
      QUALIFY row_number() OVER (PARTITION BY indicator, date_parsed ORDER BY source) = 1) GROUP BY 1""",
     "silver_macro")

_fill = ",\n".join(
    f"last_value({c} IGNORE NULLS) OVER w AS {c}" for c in [*INDICATORS, "kurs_usd_idr"]
)
view("spine", f"""
SELECT date_parsed, {_fill}
FROM (SELECT DISTINCT date_parsed FROM daily) LEFT JOIN macro_pivot USING (date_parsed)
     LEFT JOIN daily_fx USING (date_parsed)
WINDOW w AS (ORDER BY date_parsed ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
     "daily", "macro_pivot", "daily_fx")

view("gold", """
SELECT daily.*, spine.* EXCLUDE (date_parsed),
       coalesce(precipitation_sum, 0.0) AS precipitation_sum, coalesce(temperature_max, 0.0) AS temperature_max,
       coalesce(news_score, 0.0) AS news_score, coalesce(news_velocity, 0.0) AS news_velocity
FROM daily LEFT JOIN spine USING (date_parsed) LEFT JOIN daily_weather USING (date_parsed)
     LEFT JOIN (SELECT date_parsed, news_score, news_velocity FROM news_velocity) USING (date_parsed)""",
     "daily", "spine", "daily_weather", "news_velocity")

view("s_sentra", f"""
SELECT komoditas, nama, provinsi, lat, lon,
       CASE WHEN total <> 0 THEN {rnd('balance / total', 4)} END AS bobot
FROM (SELECT *, {esum('balance')} OVER (PARTITION BY komoditas) AS total FROM (
        SELECT [{TYPE_LIST}][CAST(s_suppkey % {len(TYPES)} AS INT) + 1] AS komoditas,
               'S' || s_nationkey AS nama, n_name AS provinsi, CAST(s_nationkey AS DOUBLE) AS lat,
               CAST(s_nationkey + 100 AS DOUBLE) AS lon, {esum('greatest(s_acctbal, 0.0)')} AS balance
        FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2, 3, 4, 5))""".replace(
    f"{esum('balance')} OVER (PARTITION BY komoditas)",
    "CAST(sum(CAST(balance AS DECIMAL(18,2))) OVER (PARTITION BY komoditas) AS DOUBLE)"))

_full = "full_text"
view("news_text", f"SELECT *, {clean('title')} || '  ' || {clean('summary')} AS full_text FROM s_news", "s_news")

_phr = ", ".join(
    f"CASE WHEN contains({_full}, '{p}') THEN {{'p': '{p}', 'w': {w}}} END" for p, w in TEST_NEWS.disruptions.items()
)
view("signals", f"""
SELECT article_id, source, substr(title, 1, 200) AS title, date_parsed, topics, phrases, regions,
       CAST(3 * len(topics) + coalesce(list_sum(list_transform(phrases, lambda x: x.w)), 0)
            + 2 * len(regions) AS INT) AS signal_score,
       CASE WHEN up > down THEN 'bullish' WHEN down > up THEN 'bearish' ELSE 'neutral' END AS sentiment
FROM (SELECT *, {topics(_full, TEST_NEWS.topics)} AS topics,
             list_filter([{_phr}], lambda x: x IS NOT NULL) AS phrases,
             {hits(_full, TEST_NEWS.regions)} AS regions,
             {count_of(_full, TEST_NEWS.bullish)} AS up, {count_of(_full, TEST_NEWS.bearish)} AS down
      FROM news_text) WHERE len(topics) > 0""", "news_text")
