"""Streams: source, decoding, bronze and quarantine sinks, merge by key, duplicates, daily counts, cooldown.

Sinks take a ``trigger``: ``{"processingTime": "10 seconds"}`` for the running service,
``{"availableNow": True}`` to drain what is there and stop.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from tanisight.functions.numeric import rnd
from tanisight.operators import dedup, gold
from tanisight.operators.alerts import BLOCK, KEY, SLOTS, cooldown
from tanisight.sources import daytable, jsonl

DRAIN = {"availableNow": True}
EVERY_10S = {"processingTime": "10 seconds"}


def kafka_source(
    spark: SparkSession, servers: str, topics: Sequence[str], max_offsets: int = 100_000
) -> DataFrame:
    """Messages (topic, value, timestamp) of several topics from the earliest offset."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", max_offsets)
        .load()
    )
    return raw.select("topic", F.col("value").cast("string").alias("value"), "timestamp")


def decode(messages: DataFrame, schema: StructType) -> DataFrame:
    """Messages with their typed ``record``; ``_corrupt`` marks the ones that do not parse."""
    return jsonl.decode(messages, schema)


def _start(stream: DataFrame, folder: str, trigger: dict, **options: str):
    writer = stream.writeStream.option("checkpointLocation", f"{folder}/_checkpoint").trigger(**trigger)
    for key, value in options.items():
        writer = writer.option(key, value)
    return writer


def to_bronze(records: DataFrame, folder: str, timestamp: str, trigger: dict = EVERY_10S) -> StreamingQuery:
    """Append records below topic and day. The file sink and its checkpoint write each message
    exactly once."""
    dated = records.withColumn("date", F.to_date(timestamp))
    return (
        _start(dated, folder, trigger, path=f"{folder}/data")
        .format("parquet").partitionBy("topic", "date").outputMode("append").start()
    )


def split_bad(decoded: DataFrame, folder: str, trigger: dict = EVERY_10S) -> StreamingQuery:
    """Good records and rejects to two folders. A batch overwrites its own part, so a retry
    leaves no duplicates."""

    def write(batch: DataFrame, epoch: int) -> None:
        batch.persist()
        for name, part in (("good", jsonl.good(batch, "topic")), ("quarantine", jsonl.rejected(batch, "topic"))):
            part.write.mode("overwrite").parquet(f"{folder}/{name}/_batch={epoch}")
        batch.unpersist()

    return _start(decoded, folder, trigger).foreachBatch(write).start()


def merge_to(
    decoded: DataFrame, folder: str, stream: str, tie: Sequence[str], trigger: dict = EVERY_10S
) -> StreamingQuery:
    """Merge records into a table by day below ``folder/data``: the last one per business key of ``stream`` stays,
    in the order of ``tie``, whichever batch brought it. Text that does not parse goes to ``folder/quarantine``.

    A batch rewrites the days of its records only. The checkpoint numbers the batches; it lies in the same folder.
    """
    schema = decoded.schema["record"].dataType

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        jsonl.rejected(batch).write.mode("overwrite").parquet(f"{folder}/quarantine/_batch={epoch}")
        rows = jsonl.good(batch)
        days = [r[0] for r in rows.select(dedup.stream_date(rows).try_cast("date")).distinct().collect()]

        def merged(old: DataFrame) -> DataFrame:
            kept = dedup.merge_copies([old.drop("date").unionByName(rows)], stream, tie)
            return kept.withColumn("date", dedup.stream_date(rows).try_cast("date"))

        daytable.replace(spark, f"{folder}/data", epoch, days, schema, merged)
        daytable.compact(spark, f"{folder}/data")
        batch.unpersist()

    return _start(decoded, folder, trigger).foreachBatch(write).start()


def read_merged(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """Records of a table that ``merge_to`` fills, with their ``date``."""
    return daytable.read(spark, f"{folder}/data", schema)


def drop_repeated(stream: DataFrame, key: str, timestamp: str, delay: str) -> DataFrame:
    """First message per key; keys are forgotten once the watermark has passed them."""
    return stream.withWatermark(timestamp, delay).dropDuplicatesWithinWatermark([key])


def append_to(stream: DataFrame, folder: str, trigger: dict = EVERY_10S) -> StreamingQuery:
    return (
        _start(stream, folder, trigger, path=f"{folder}/data").format("parquet").outputMode("append").start()
    )


def daily_counts(stream: DataFrame, timestamp: str, key: str, delay: str = "1 day") -> DataFrame:
    """Messages per day and key; rows later than the watermark are dropped."""
    return (
        stream.withWatermark(timestamp, delay)
        .groupBy(F.window(timestamp, "1 day").alias("w"), F.col(key))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.to_date("w.start").alias("day"), key, "n")
    )


def upsert_to(counts: DataFrame, folder: str, trigger: dict = EVERY_10S) -> StreamingQuery:
    """Write the changed counts of each batch as its own part."""

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/data/_batch={epoch}")

    return _start(counts, folder, trigger).outputMode("update").foreachBatch(write).start()


def read_upserts(spark: SparkSession, folder: str, keys: Sequence[str], value: str) -> DataFrame:
    """The newest count of each key."""
    return spark.read.parquet(f"{folder}/data").groupBy(*keys).agg(F.max_by(value, "_batch").alias(value))


_NEWS_PARTS = "date_parsed date, total decimal(28,4), n long"


def news_counts_to(articles: DataFrame, folder: str, trigger: dict = EVERY_10S) -> StreamingQuery:
    """Articles (date_parsed, relevance_score) as running sums per day, kept by month. No row is too late: it
    corrects its day. A repeated batch adds nothing twice, because it starts from the sums before it."""

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        score = F.coalesce(F.col("relevance_score").cast("double"), F.lit(0.0)).cast("decimal(18,4)")
        parts = batch.groupBy("date_parsed").agg(F.sum(score).alias("total"), F.count(F.lit(1)).alias("n"))
        parts = parts.withColumn("date", F.trunc("date_parsed", "month").cast("date")).persist()
        months = [r[0] for r in parts.select("date").distinct().collect()]

        def added(old: DataFrame) -> DataFrame:
            sums = old.unionByName(parts.withColumn("total", F.col("total").cast("decimal(28,4)")))
            total = F.sum("total").cast("decimal(28,4)").alias("total")
            return sums.groupBy("date", "date_parsed").agg(total, F.sum("n").alias("n"))

        schema = spark.createDataFrame([], _NEWS_PARTS).schema
        daytable.replace(spark, f"{folder}/data", epoch, months, schema, added)
        daytable.compact(spark, f"{folder}/data")
        parts.unpersist()

    return _start(articles, folder, trigger).foreachBatch(write).start()


def read_news_velocity(spark: SparkSession, folder: str) -> DataFrame:
    """Score, articles and velocity per day, as ``gold.news_velocity`` of all articles so far."""
    parts = daytable.read(spark, f"{folder}/data", spark.createDataFrame([], _NEWS_PARTS).schema)
    mean = F.col("total").cast("double") / F.col("n")
    return gold.news_velocity(parts.select("date_parsed", rnd(mean, 2).alias("news_score"), F.col("n").alias("article_count")))


def _sent_since(pdf: pd.DataFrame, gap: int, tie: str, last: int | None) -> tuple[np.ndarray, int | None]:
    """Which alerts of one commodity are sent after ``last`` (microseconds), and the last one sent."""
    sent = np.zeros(len(pdf), dtype=bool)
    known = np.flatnonzero(pdf["ts"].notna().to_numpy())
    part = pdf.iloc[known]
    order = known[np.lexsort((pd.factorize(part[tie], sort=True)[0], part["ts"].to_numpy()))]
    us = pdf["ts"].to_numpy().astype("datetime64[us]").astype(np.int64)[order]
    at = 0 if last is None else int(np.searchsorted(us, last + gap))
    while at < len(us):
        sent[order[at]] = True
        last = int(us[at])
        at = int(np.searchsorted(us, last + gap))
    return sent, last


def cooldown_state(alerts: DataFrame, hours: int = 12, tie: str = "event_id") -> DataFrame:
    """Streamed alerts with ``suppressed``, decided one commodity at a time from keyed state.

    The state store keeps the last alert sent per commodity. Of equal times the smallest tie key is sent; an alert
    older than the cooldown after the last one sent is held back, so late and repeated ones are; an alert without
    commodity or time never is. State is one number per commodity and has no timer: a late alert of a forgotten
    commodity would be sent twice. A worker holds one commodity's alerts of one batch, which the source's limit per
    trigger bounds; ``cooldown_to`` splits a commodity too.
    """
    gap = hours * 3_600_000_000
    names = alerts.columns

    def decide(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(frames), ignore_index=True)
        if key[0] is None:
            yield pdf[names].assign(suppressed=False)
            return
        sent, last = _sent_since(pdf, gap, tie, state.get[0] if state.exists else None)
        if last is not None:
            state.update((last,))
        yield pdf[names].assign(suppressed=~sent & pdf["ts"].notna().to_numpy())

    out = StructType(list(alerts.schema.fields)).add("suppressed", "boolean")
    return alerts.groupBy(KEY).applyInPandasWithState(decide, out, "sent long", "append", GroupStateTimeout.NoTimeout)


def cooldown_to(
    alerts: DataFrame, folder: str, hours: int = 12, tie: str = "event_id", trigger: dict = EVERY_10S,
    slots: int = SLOTS, block: int = BLOCK,
) -> StreamingQuery:
    """Alerts with ``suppressed``; the last alert sent per commodity is carried between batches.

    Each batch runs the same distributed operator as batch data, seeded with the state that the
    previous batch wrote to the shared folder. State and output of a batch are overwritten by a
    retry, so they stay consistent after a failure.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        # Every batch writes its state, so after the first a missing one is an error
        seed = spark.read.parquet(f"{folder}/state/_batch={epoch - 1}") if epoch > 0 else None
        cooldown(batch, hours, tie, seed, slots, block).write.mode("overwrite").parquet(f"{folder}/data/_batch={epoch}")
        done = spark.read.parquet(f"{folder}/data/_batch={epoch}")
        last = done.filter(~F.col("suppressed") & F.col(KEY).isNotNull() & F.col("ts").isNotNull()).select(KEY, "ts")
        if seed is not None:
            last = last.unionByName(seed)
        last.groupBy(KEY).agg(F.max("ts").alias("ts")).write.mode("overwrite").parquet(
            f"{folder}/state/_batch={epoch}"
        )

    return _start(alerts, folder, trigger).foreachBatch(write).start()


def drain(query: StreamingQuery) -> None:
    """Wait until a run-once query has processed everything; its errors are raised here."""
    query.awaitTermination()
