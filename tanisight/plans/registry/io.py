"""Sources, sinks, versions and streams. Each query writes below the shared folder and reads back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tanisight.plans import layers, standins
from tanisight.session import scratch_path
from tanisight.sources import jsonl, snapshots, tables
from tanisight.streaming import ingest
from tanisight.plans.registry import risk as _risk  # noqa: F401  (defines SQL views used here)
from tanisight.plans.views_sql import sql, view

_EVENT = "event_id long, user_id long, value double, k int, fetched_at_utc string"


def _schema(spark, ddl=_EVENT):
    return spark.createDataFrame([], ddl).schema


def _event_json(events):
    return F.to_json(
        F.struct(
            "event_id", "user_id", "value", F.from_json("props", "k int")["k"].alias("k"),
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("fetched_at_utc"),
        )
    )


def _lines(events):
    """Each event as JSON, some of them followed by a broken and a blank line."""
    text = _event_json(events)
    broken = F.when(F.col("event_id") % 50 == 0, F.substring(text, 1, 20))
    blank = F.when(F.col("event_id") % 70 == 0, F.lit("   "))
    return events.select("event_type", F.explode(F.array_compact(F.array(text, broken, blank))).alias("value"))


def _write_lines(spark, sf):
    path = scratch_path(spark, "jsonl")
    _lines(standins.table(spark, sf, "events")).write.partitionBy("event_type").text(path)
    return path


def _scan(spark, sf):
    return jsonl.scan(spark, _write_lines(spark, sf), _schema(spark))[0]


def _scan_rejects(spark, sf):
    return jsonl.scan(spark, _write_lines(spark, sf), _schema(spark))[1].groupBy("raw").agg(
        F.count(F.lit(1)).alias("n")
    )


def _partitioned(spark, sf):
    path = scratch_path(spark, "partitioned")
    ts = F.when(F.col("event_id") % 97 != 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    events = standins.table(spark, sf, "events").select("event_id", "value", ts.alias("fetched_at_utc"))
    jsonl.write_partitioned(events, path, "fetched_at_utc")
    back = spark.read.schema("event_id long, value double, date string").json(path)
    return back.groupBy("date").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"))


def _append_merge(spark, sf):
    path = scratch_path(spark, "append")
    orders = standins.table(spark, sf, "orders")
    status = F.col("o_orderstatus")
    tables.write_table(orders.filter(status == "F").select("o_orderkey", "o_totalprice"), path, "overwrite")
    tables.write_table(
        orders.filter(status != "F").select("o_orderkey", "o_totalprice", "o_orderpriority"), path
    )
    tables.write_table(orders.filter(status == "none").select("o_orderkey"), path)
    return tables.read_table(spark, path)


def _versions(spark, sf):
    path = scratch_path(spark, "versions")
    orders = standins.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    snapshots.save_version(orders.filter(F.col("o_orderstatus") == "F"), path, "2026-01-01 00:00:00", "CREATE")
    snapshots.save_version(orders.filter(F.col("o_orderstatus") != "P"), path, "2026-01-02 00:00:00")
    snapshots.save_version(orders, path, "2026-01-03 00:00:00", "OVERWRITE")
    return path


def _history(spark, sf):
    h = snapshots.history(spark, _versions(spark, sf))
    return h.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))


def _export(spark, sf):
    path = scratch_path(spark, "export")
    daily = layers.daily(spark, sf)
    jsonl.export_json(daily, path)
    return spark.read.schema(daily.schema).json(path)


def _price_history(spark, sf):
    nested = tables.price_history(layers.daily(spark, sf))
    return nested.select("komoditas", F.posexplode("history")).select("komoditas", "pos", "col.date", "col.price")


def _bronze(spark, sf):
    rows = tables.bronze(standins.kurs(spark, sf), "kurs")
    return rows.groupBy("_source_layer", "_stream_name", "source").agg(F.count(F.lit(1)).alias("n"))


def _validate(spark, sf):
    raw = standins.prices(spark, sf).withColumn("day", F.to_date("fetched_at_utc"))
    return tables.validate_layers(
        {
            "bronze": (raw, ["source", "commodity", "day"]),
            "silver": (layers.silver_prices(spark, sf), ["source", "komoditas", "date_parsed"]),
            "gold": (layers.daily(spark, sf), ["komoditas", "date_parsed"]),
        }
    )


def _manifest(spark, sf):
    prices = standins.prices(spark, sf)
    kurs = standins.kurs(spark, sf)
    weather = standins.weather(spark, sf)
    return tables.ingest_manifest(
        {
            "prices": prices.select(F.col("commodity").alias("key"), F.to_date("fetched_at_utc").alias("date")),
            "kurs": kurs.select(F.col("source").alias("key"), F.to_date("fetched_at_utc").alias("date")),
            "weather": weather.select(F.col("sentra").alias("key"), F.col("ingestion_ts").alias("date")),
        }
    )


# --- streams ------------------------------------------------------------------------------


def stream_of(spark, sf, name):
    """A given table as a file stream."""
    schema = standins.table(spark, sf, name).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{sf}/{name}.parque[t]")


def _messages(spark, sf):
    """Events as messages (topic, value, timestamp); one in 50 is followed by a broken one."""
    events = stream_of(spark, sf, "events")
    text = _event_json(events)
    broken = F.when(F.col("event_id") % 50 == 0, F.substring(text, 1, 20))
    return events.select(
        F.col("event_type").alias("topic"), F.explode(F.array_compact(F.array(text, broken))).alias("value"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def _stream_decode(spark, sf):
    folder = scratch_path(spark, "stream-decode")
    decoded = ingest.decode(_messages(spark, sf), _schema(spark))
    ingest.drain(ingest.append_to(jsonl.good(decoded, "topic"), folder, ingest.DRAIN))
    return spark.read.parquet(f"{folder}/data")


def _stream_bronze(spark, sf):
    folder = scratch_path(spark, "stream-bronze")
    decoded = ingest.decode(_messages(spark, sf), _schema(spark))
    records = jsonl.good(decoded, "topic", "timestamp")
    ingest.drain(ingest.to_bronze(records, folder, "timestamp", ingest.DRAIN))
    back = spark.read.parquet(f"{folder}/data")
    return back.groupBy("topic", F.col("date").cast("date").alias("date")).agg(F.count(F.lit(1)).alias("n"))


def _stream_quarantine(spark, sf):
    folder = scratch_path(spark, "stream-quarantine")
    ingest.drain(ingest.split_bad(ingest.decode(_messages(spark, sf), _schema(spark)), folder, ingest.DRAIN))
    good = spark.read.parquet(f"{folder}/good").groupBy("topic").agg(F.count(F.lit(1)).alias("n"))
    bad = spark.read.parquet(f"{folder}/quarantine").groupBy("topic").agg(F.count(F.lit(1)).alias("n"))
    return good.withColumn("kind", F.lit("good")).unionByName(bad.withColumn("kind", F.lit("quarantine")))


def _stream_dedup(spark, sf):
    """Documents as articles, by the id of their text; the day is within one year."""
    docs = stream_of(spark, sf, "documents")
    day = F.date_add(F.lit("1998-01-01").cast("date"), (F.col("doc_id") % 365).cast("int"))
    articles = docs.select(
        F.substring(F.sha1(F.col("text").cast("binary")), 1, 16).alias("article_id"),
        day.cast("timestamp").alias("ts"),
    )
    folder = scratch_path(spark, "stream-dedup")
    unique = ingest.drop_repeated(articles, "article_id", "ts", "400 days").select("article_id")
    ingest.drain(ingest.append_to(unique, folder, ingest.DRAIN))
    return spark.read.parquet(f"{folder}/data")


def _stream_counts(spark, sf):
    events = stream_of(spark, sf, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    folder = scratch_path(spark, "stream-counts")
    ingest.drain(ingest.upsert_to(ingest.daily_counts(events, "ts", "event_type"), folder, ingest.DRAIN))
    return ingest.read_upserts(spark, folder, ["day", "event_type"], "n")


def _stream_cooldown(spark, sf):
    events = stream_of(spark, sf, "events").filter(F.col("event_type") == "error")
    alerts = events.select(
        F.concat(F.lit("K"), (F.col("user_id") % 10).cast("string")).alias("komoditas"),
        F.col("ts").cast("timestamp").alias("ts"), "event_id",
    )
    folder = scratch_path(spark, "stream-cooldown")
    ingest.drain(ingest.cooldown_to(alerts, folder, trigger=ingest.DRAIN))
    return spark.read.parquet(f"{folder}/data").select("event_id", "komoditas", "suppressed")


def _in_parts(spark, rows, part, sink):
    """Rows in four parts, one after the other; the stream is stopped after each and goes on from its checkpoint."""
    parts, landing = scratch_path(spark, "parts"), scratch_path(spark, "landing")
    rows.withColumn("_part", part.cast("int")).write.partitionBy("_part").parquet(parts)
    for k in range(4):
        of_part = spark.read.parquet(parts).filter(F.col("_part") == k).select(*rows.columns)
        of_part.write.mode("append").parquet(landing)
        ingest.drain(sink(spark.readStream.schema(rows.schema).parquet(landing)))


def _stream_merge(spark, sf):
    """Weather records as JSON lines; every part holds records of all days."""
    events = standins.table(spark, sf, "events")
    text = F.to_json(
        F.struct(
            F.concat(F.lit("S"), (F.col("user_id") % 25).cast("string")).alias("sentra"),
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("fetched_at_utc"), "event_id", "value",
        )
    )
    schema = _schema(spark, "sentra string, fetched_at_utc string, event_id long, value double")
    folder = scratch_path(spark, "stream-merge")
    tie = ["fetched_at_utc", "event_id", "value"]
    _in_parts(
        spark, events.select("event_id", text.alias("value")), F.col("event_id") % 4,
        lambda lines: ingest.merge_to(ingest.decode(lines.select("value"), schema), folder, "weather", tie, ingest.DRAIN),
    )
    return ingest.read_merged(spark, folder, schema).select("sentra", "date", "event_id", "value")


def _stream_news_velocity(spark, sf):
    """Every part holds articles of all days, so each later one corrects days that were done."""
    scored = standins.scored_articles(spark, sf)
    articles = scored.select("article_id", F.col("ingestion_ts").alias("date_parsed"), "relevance_score")
    folder = scratch_path(spark, "stream-news")
    _in_parts(
        spark, articles, F.col("article_id") % 4, lambda rows: ingest.news_counts_to(rows, folder, ingest.DRAIN)
    )
    return ingest.read_news_velocity(spark, folder)


def _stream_cooldown_state(spark, sf):
    """Alerts by eight days of the month each; what was sent last is kept in the state store."""
    folder = scratch_path(spark, "stream-cooldown-state")
    _in_parts(
        spark, standins.alerts(spark, sf), F.floor((F.dayofmonth("ts") - 1) / 8),
        lambda rows: ingest.append_to(ingest.cooldown_state(rows), folder, ingest.DRAIN),
    )
    return spark.read.parquet(f"{folder}/data").select("event_id", "komoditas", "suppressed")


QUERIES = {
    "scan_jsonl": _scan,
    "scan_jsonl_rejects": _scan_rejects,
    "write_partitioned": _partitioned,
    "append_schema_merge": _append_merge,
    "version_as_of": lambda s, d: snapshots.read_version(s, _versions(s, d), 1),
    "table_history": _history,
    "bronze_metadata": _bronze,
    "export_json_roundtrip": _export,
    "price_history": _price_history,
    "ingest_manifest": _manifest,
    "validate_layers": _validate,
    "stream_decode": _stream_decode,
    "stream_to_bronze": _stream_bronze,
    "stream_quarantine": _stream_quarantine,
    "stream_dedup": _stream_dedup,
    "stream_daily_counts": _stream_counts,
    "stream_alert_cooldown": _stream_cooldown,
    "stream_merge_bronze": _stream_merge,
    "stream_news_velocity": _stream_news_velocity,
    "stream_cooldown_state": _stream_cooldown_state,
}

_ROW = """event_id, user_id, value, CAST(json_extract(props, '$.k') AS INT) AS k,
        strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS fetched_at_utc"""

view("landed", """
SELECT 'prices' AS stream, commodity AS key, day AS date FROM s_price
UNION ALL SELECT 'kurs', o_orderstatus, CAST(o_orderdate AS DATE) FROM orders
UNION ALL SELECT 'weather', sentra, date_parsed FROM s_wx""", "s_price", "s_wx")

SQL = {
    "scan_jsonl": f"SELECT {_ROW} FROM events",
    "scan_jsonl_rejects": """SELECT raw, count(*) AS n
        FROM (SELECT substr('{"event_id":' || event_id || ',"user_id":' || user_id || ',"value":', 1, 20) AS raw
              FROM events WHERE event_id % 50 = 0) GROUP BY 1""",
    "write_partitioned": """SELECT CASE WHEN event_id % 97 <> 0 THEN strftime(ts, '%Y-%m-%d') ELSE '1970-01-01' END AS date,
        count(*) AS n, min(event_id) AS first_id FROM events GROUP BY 1""",
    "append_schema_merge": """SELECT o_orderkey, o_totalprice, CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END
        AS o_orderpriority FROM orders""",
    "version_as_of": "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus <> 'P'",
    "table_history": """
        SELECT CAST(0 AS BIGINT) AS version, '2026-01-01 00:00:00' AS timestamp, 'CREATE' AS operation, count(*) AS n_rows
        FROM orders WHERE o_orderstatus = 'F'
        UNION ALL SELECT 1, '2026-01-02 00:00:00', 'WRITE', count(*) FROM orders WHERE o_orderstatus <> 'P'
        UNION ALL SELECT 2, '2026-01-03 00:00:00', 'OVERWRITE', count(*) FROM orders""",
    "bronze_metadata": """SELECT 'bronze' AS _source_layer, 'kurs' AS _stream_name, o_orderstatus AS source, count(*) AS n
        FROM orders GROUP BY 3""",
    "export_json_roundtrip": sql("SELECT * FROM daily", "daily"),
    "price_history": sql("""
        SELECT komoditas, CAST(row_number() OVER (PARTITION BY komoditas ORDER BY date_parsed) - 1 AS INT) AS pos,
               date_parsed AS date, avg_price AS price FROM daily""", "daily"),
    "ingest_manifest": sql("""
        SELECT stream, key, count(*) AS records, min(date) AS first_date, max(date) AS last_date,
               count(DISTINCT date) AS n_days FROM landed GROUP BY 1, 2
        UNION ALL SELECT 'TOTAL', '', count(*), min(date), max(date), count(DISTINCT date) FROM landed""", "landed"),
    "validate_layers": sql("""
        SELECT 'bronze' AS layer, count(*) AS n_rows, CAST(0 AS BIGINT) AS null_keys,
               count(*) - count(DISTINCT (source, commodity, day)) AS dup_keys FROM s_price
        UNION ALL SELECT 'silver', count(*), 0, count(*) - count(DISTINCT (source, komoditas, date_parsed)) FROM silver_prices
        UNION ALL SELECT 'gold', count(*), 0, count(*) - count(DISTINCT (komoditas, date_parsed)) FROM daily""",
        "s_price", "silver_prices", "daily"),
    "stream_decode": f"SELECT event_type AS topic, {_ROW} FROM events",
    "stream_to_bronze": "SELECT event_type AS topic, CAST(ts AS DATE) AS date, count(*) AS n FROM events GROUP BY 1, 2",
    "stream_quarantine": """SELECT event_type AS topic, count(*) AS n, 'good' AS kind FROM events GROUP BY 1
        UNION ALL SELECT event_type, count(*), 'quarantine' FROM events WHERE event_id % 50 = 0 GROUP BY 1""",
    "stream_dedup": "SELECT DISTINCT substr(sha1(text), 1, 16) AS article_id FROM documents",
    "stream_daily_counts": "SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2",
    "stream_alert_cooldown": sql("SELECT event_id, komoditas, suppressed FROM cooled", "cooled"),
    "stream_merge_bronze": """SELECT 'S' || (user_id % 25) AS sentra, CAST(ts AS DATE) AS date, event_id, value FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id % 25, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC, value DESC) = 1""",
    "stream_news_velocity": sql("SELECT * FROM news_velocity", "news_velocity"),
    "stream_cooldown_state": sql("SELECT event_id, komoditas, suppressed FROM cooled", "cooled"),
}
