"""Cleaning, de-duplication, precedence and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tanisight.functions.numeric import ratio, rnd as r, safe_double
from tanisight.operators import clean, dedup
from tanisight.plans import layers, standins
from tanisight.plans.standins import PRICE_TIE, TYPES
from tanisight.plans.views_sql import rnd, sql, view

KEY, DAY = "komoditas", "date_parsed"
KNOWN = ["ECONOMY", "LARGE", "PROMO"]
CUT = "1998-01-01"


def _line(spark, sf):
    return standins.table(spark, sf, "lineitem")


def _bronze_merge(spark, sf):
    """Remote copy: all orders. Local copy: those that are not open, with one column more."""
    orders = standins.table(spark, sf, "orders")

    def copy(rows):
        return rows.select(
            F.lit("USD/IDR").alias("pair"), F.col("o_totalprice").alias("kurs_tengah"),
            F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("fetched_at_utc"), "o_orderkey",
        )

    local = copy(orders.filter(F.col("o_orderstatus") != "O")).withColumn("data_source", F.lit("local"))
    return dedup.merge_copies([copy(orders), local], "kurs", ["fetched_at_utc", "o_orderkey"])


def _keep_last(spark, sf):
    raw = standins.prices(spark, sf).withColumn("_date", F.to_date("fetched_at_utc"))
    last = dedup.keep_last(raw, ["commodity", "_date"], PRICE_TIE)
    return last.select("commodity", F.col("_date").alias("day"), "price")


def _keep_first(spark, sf):
    return layers.silver_prices(spark, sf).select("source", KEY, DAY, "price_idr_per_kg")


def _dedup_news(spark, sf):
    """Articles by the id of their text: copies share it."""
    docs = standins.table(spark, sf, "documents")
    ids = docs.select(
        F.substring(F.sha1(F.col("text").cast("binary")), 1, 16).alias("article_id"), "doc_id", "source",
        F.lit("1998-01-01").alias("ingestion_ts"),
    )
    return clean.silver_news(ids, ["doc_id"]).select("article_id", "doc_id", "source")


def _safe_cast(spark, sf):
    text = F.when(F.col("o_orderkey") % 11 == 0, "n/a").otherwise(F.col("o_totalprice").cast("string"))
    raw = standins.table(spark, sf, "orders").select("o_orderkey", text.alias("raw"))
    return raw.select("o_orderkey", safe_double("raw").alias("price"))


def _normalize_case(spark, sf):
    grades = spark.createDataFrame(
        [("SMALL", "RETAIL"), ("MEDIUM", "RETAIL"), ("LARGE", "BULK")], "name string, canonical string"
    )
    parts = standins.table(spark, sf, "part").select("p_type")
    return clean.map_exact(parts, "p_type", grades).groupBy("p_type").agg(F.count(F.lit(1)).alias("n"))


def _latest_positive(spark, sf):
    """Prices shifted so that some are negative; null for high discounts."""
    line = _line(spark, sf).select(
        "l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice",
        F.when(F.col("l_discount") < 0.08, F.round(F.col("l_extendedprice") - 30000, 2)).alias("price"),
    )
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]
    return clean.latest_positive(line, ["l_suppkey"], order, "price")


def _first_positive(spark, sf):
    line = _line(spark, sf)
    fields = [
        F.col("l_discount") - 0.05,
        F.when(F.col("l_linenumber") > 3, F.lit("kosong")).otherwise((F.col("l_quantity") - 25).cast("string")),
        F.col("l_tax") - 0.02,
        F.col("l_extendedprice"),
    ]
    return line.select("l_orderkey", "l_partkey", "l_linenumber", r(clean.first_positive(fields), 4).alias("price"))


def _precedence(spark, sf):
    prices = layers.silver_prices(spark, sf)
    spine = prices.select(KEY, DAY).distinct()
    primary = prices.filter(F.col("source") == "ASIA")
    secondary = prices.filter(F.col("source") == "EUROPE")
    return clean.source_precedence(spine, primary, secondary, KEY, DAY, "price_idr_per_kg")


def _precedence_runs(spark, sf):
    """Days before 1998 in a first run, the others in a second one that sees of the first only its last values."""
    prices = layers.silver_prices(spark, sf)

    def run(rows, last=None):
        primary, secondary = (rows.filter(F.col("source") == s) for s in ("ASIA", "EUROPE"))
        spine = rows.select(KEY, DAY).distinct()
        return clean.source_precedence(spine, primary, secondary, KEY, DAY, "price_idr_per_kg", last)

    first = run(prices.filter(F.col(DAY) < CUT))
    return run(prices.filter(F.col(DAY) >= CUT), clean.last_values(first, KEY, DAY, "price_idr_per_kg"))


def _sanity(spark, sf):
    orders = standins.table(spark, sf, "orders").withColumn("rate", F.col("o_totalprice") / 10)
    kept, rejects = clean.sanity_split(orders, "rate", 10000, 25000)
    return clean.union_sources(
        [df.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n")).withColumn("kept", F.lit(flag))
         for df, flag in ((kept, True), (rejects, False))]
    )


def _fx_quotes(spark, sf):
    orders = standins.table(spark, sf, "orders")
    return orders.select("o_orderkey", *[c.alias(n) for n, c in clean.fx_quotes(F.col("o_totalprice")).items()])


def _ratios(spark, sf):
    line = _line(spark, sf)
    return line.select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_suppkey", "l_extendedprice",
        ratio("l_quantity", "l_tax", 2).alias("yield"),
        ratio("l_discount", "l_tax", 1, percent=True).alias("utilisation"),
    )


def _macro_unpivot(spark, sf):
    parts = standins.table(spark, sf, "part")
    return clean.macro_unpivot(parts, ["p_partkey"], ["p_size", "p_retailprice"])


def _union(spark, sf):
    """Three feeds of different shape: legacy names, canonical names, one column more."""
    raw = standins.prices(spark, sf)
    kind = F.col("l_linenumber") % 3
    legacy = raw.filter(kind == 0)
    canonical = raw.filter(kind == 1).withColumnsRenamed({"commodity": "komoditas", "price": "price_idr_per_kg"})
    labelled = raw.filter(kind == 2).withColumn("data_source", F.concat(F.lit("api-"), "source"))
    feeds = [clean.silver_prices(f, TYPES, PRICE_TIE) for f in (legacy, canonical, labelled)]
    return clean.union_sources(feeds)


QUERIES = {
    "silver_prices": lambda s, d: clean.silver_prices(standins.prices(s, d), TYPES, PRICE_TIE, dedup=False)
    .groupBy("source", "data_source", KEY, DAY)
    .agg(F.count(F.lit(1)).alias("n"), F.max("price_idr_per_kg").alias("max_price")),
    "canonical_filter": lambda s, d: clean.canonical_filter(layers.daily(s, d), KNOWN),
    "bronze_merge": _bronze_merge,
    "dedup_keep_last": _keep_last,
    "dedup_keep_first": _keep_first,
    "dedup_news": _dedup_news,
    "dedup_kurs": lambda s, d: layers.silver_kurs(s, d),
    "dedup_weather": lambda s, d: layers.silver_weather(s, d).select("sentra", DAY, "event_id"),
    "safe_cast": _safe_cast,
    "normalize_case": _normalize_case,
    "latest_positive": _latest_positive,
    "first_positive_field": _first_positive,
    "source_precedence": _precedence,
    "source_precedence_runs": _precedence_runs,
    "source_hit_counts": lambda s, d: clean.source_hits(_precedence(s, d)),
    "sanity_range": _sanity,
    "fx_quotes": _fx_quotes,
    "ratio_guarded": _ratios,
    "silver_macro": layers.silver_macro,
    "macro_unpivot": _macro_unpivot,
    "union_sources": _union,
}

_tie = ", ".join(PRICE_TIE)
_tie_desc = ", ".join(f"{c} DESC" for c in PRICE_TIE)
view("precedence", """
SELECT komoditas, date_parsed, coalesce(p, s, last) AS price_idr_per_kg,
       CASE WHEN p IS NOT NULL THEN 'primary' WHEN s IS NOT NULL THEN 'secondary'
            WHEN last IS NOT NULL THEN 'last_known' ELSE 'missing' END AS origin
FROM (SELECT *, last_value(coalesce(p, s) IGNORE NULLS) OVER (PARTITION BY komoditas ORDER BY date_parsed
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last
      FROM (SELECT komoditas, date_parsed, max(price_idr_per_kg) FILTER (source = 'ASIA') AS p,
                   max(price_idr_per_kg) FILTER (source = 'EUROPE') AS s FROM silver_prices GROUP BY 1, 2))""",
     "silver_prices")

SQL = {
    "silver_prices": sql("""
        SELECT source, source AS data_source, commodity AS komoditas, day AS date_parsed, count(*) AS n,
               max(price) AS max_price FROM s_price GROUP BY 1, 2, 3, 4""", "s_price"),
    "canonical_filter": sql("SELECT * FROM daily WHERE komoditas IN ('ECONOMY', 'LARGE', 'PROMO')", "daily"),
    "bronze_merge": """
        SELECT 'USD/IDR' AS pair, o_totalprice AS kurs_tengah,
               strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS fetched_at_utc, o_orderkey,
               CASE WHEN c = 1 THEN 'local' END AS data_source
        FROM (SELECT 0 AS c, * FROM orders UNION ALL SELECT 1, * FROM orders WHERE o_orderstatus <> 'O')
        QUALIFY row_number() OVER (PARTITION BY CAST(o_orderdate AS DATE)
                                   ORDER BY c DESC, o_orderdate DESC, o_orderkey DESC) = 1""",
    "dedup_keep_last": sql(f"""
        SELECT commodity, day, price FROM s_price
        QUALIFY row_number() OVER (PARTITION BY commodity, day ORDER BY {_tie_desc}) = 1""", "s_price"),
    "dedup_keep_first": sql(
        "SELECT source, komoditas, date_parsed, price_idr_per_kg FROM silver_prices", "silver_prices"),
    "dedup_news": """SELECT substr(sha1(text), 1, 16) AS article_id, doc_id, source FROM documents
        QUALIFY row_number() OVER (PARTITION BY sha1(text) ORDER BY doc_id) = 1""",
    "dedup_kurs": sql("SELECT * FROM silver_kurs", "silver_kurs"),
    "dedup_weather": sql("SELECT sentra, date_parsed, event_id FROM silver_weather", "silver_weather"),
    "safe_cast": """SELECT o_orderkey, TRY_CAST(CASE WHEN o_orderkey % 11 = 0 THEN 'n/a'
        ELSE CAST(o_totalprice AS VARCHAR) END AS DOUBLE) AS price FROM orders""",
    "normalize_case": """SELECT CASE WHEN p_type IN ('SMALL', 'MEDIUM') THEN 'RETAIL' WHEN p_type = 'LARGE' THEN 'BULK'
        ELSE p_type END AS p_type, count(*) AS n FROM part GROUP BY 1""",
    "latest_positive": """
        SELECT l_suppkey, price FROM (SELECT l_suppkey,
            CASE WHEN l_discount < 0.08 THEN round(l_extendedprice - 30000, 2) END AS price FROM lineitem
          QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate DESC, l_orderkey DESC,
            l_linenumber DESC, l_partkey DESC, l_extendedprice DESC) = 1) WHERE price > 0""",
    "first_positive_field": f"""
        SELECT l_orderkey, l_partkey, l_linenumber, {rnd('''CASE WHEN l_discount - 0.05::DOUBLE > 0 THEN l_discount - 0.05::DOUBLE
          WHEN l_linenumber <= 3 AND l_quantity - 25 > 0 THEN l_quantity - 25
          WHEN l_tax - 0.02::DOUBLE > 0 THEN l_tax - 0.02::DOUBLE
          WHEN l_extendedprice > 0 THEN l_extendedprice END''', 4)} AS price FROM lineitem""",
    "source_precedence": sql("SELECT * FROM precedence", "precedence"),
    "source_precedence_runs": sql(f"SELECT * FROM precedence WHERE date_parsed >= DATE '{CUT}'", "precedence"),
    "source_hit_counts": sql("SELECT origin, count(*) AS hits FROM precedence GROUP BY 1", "precedence"),
    "sanity_range": """SELECT o_orderstatus, count(*) AS n,
          o_totalprice / 10 > 10000 AND o_totalprice / 10 < 25000 AS kept FROM orders GROUP BY 1, 3""",
    "fx_quotes": f"""SELECT o_orderkey, {rnd('o_totalprice')} AS kurs_jual,
        {rnd('o_totalprice * 0.997::DOUBLE')} AS kurs_beli, {rnd('o_totalprice * 0.9985::DOUBLE')} AS kurs_tengah
        FROM orders""",
    "ratio_guarded": f"""SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey, l_extendedprice,
        CASE WHEN l_tax > 0 THEN {rnd('l_quantity / l_tax')} ELSE 0.0 END AS yield,
        CASE WHEN l_tax > 0 THEN {rnd('l_discount / l_tax * 100', 1)} ELSE 0.0 END AS utilisation FROM lineitem""",
    "silver_macro": sql("SELECT * FROM silver_macro", "silver_macro"),
    "macro_unpivot": """SELECT p_partkey, 'p_size' AS indicator, CAST(p_size AS DOUBLE) AS value FROM part
        UNION ALL SELECT p_partkey, 'p_retailprice', p_retailprice FROM part""",
    "union_sources": sql(f"""
        SELECT source, CASE WHEN l_linenumber % 3 = 2 THEN 'api-' || source ELSE source END AS data_source,
               commodity AS komoditas, price AS price_idr_per_kg, day AS date_parsed FROM s_price
        QUALIFY row_number() OVER (PARTITION BY l_linenumber % 3, source, commodity, day ORDER BY {_tie}) = 1""",
        "s_price"),
}
