"""Alert level, message, run summary, cooldown and escalation."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tanisight.dims import ACTIONS, AlertSettings
from tanisight.functions.numeric import rnd
from tanisight.functions.text import one_decimal, rupiah, signed_one

KEY = "komoditas"


def alert_level(risk: Column, change: Column, s: AlertSettings = AlertSettings()) -> Column:
    """Level by risk index, raised by the predicted change; null when no alert is due."""
    by_risk = (
        F.when(risk >= s.risk_critical, "KRITIS")
        .when((risk >= s.risk_warning) & (risk >= s.risk_high), "SIAGA")
        .when(risk >= s.risk_warning, "WASPADA")
    )
    return (
        F.when(change >= s.change_critical, "KRITIS")
        .when((change >= s.change_warning) & by_risk.isNull(), "WASPADA")
        .otherwise(by_risk)
    )


def due_alerts(
    commodities: DataFrame,
    risk: DataFrame,
    forecast: DataFrame,
    phrases: DataFrame,
    settings: AlertSettings = AlertSettings(),
) -> DataFrame:
    """Commodities with an alert due: risk, forecast and dominant phrases joined."""
    joined = (
        commodities.join(risk.select(KEY, "risk_index"), KEY, "left")
        .join(
            forecast.select(
                KEY, "current_price", "forecast_7d", F.col("predicted_change_pct").alias("price_change_pct_7d")
            ),
            KEY,
            "left",
        )
        .join(phrases.select(KEY, "top_signals"), KEY, "left")
        .fillna(0.0, subset=["risk_index"])
    )
    if settings.commodities is not None:
        joined = joined.filter(F.col(KEY).isin(list(settings.commodities)))
    level = alert_level(F.col("risk_index"), F.col("price_change_pct_7d"), settings)
    return joined.withColumn("level", level).filter(F.col("level").isNotNull())


def alert_records(due: DataFrame, as_of: Column) -> DataFrame:
    """Alerts with id, message and date label; parts without data are left out of the message."""
    change = F.col("price_change_pct_7d")
    action = F.create_map(*[F.lit(x) for kv in ACTIONS.items() for x in kv])
    message = F.concat_ws(
        " | ",
        F.concat(
            F.lit("["), "level", F.lit("] "), "label", F.lit(" — Indeks Risiko: "),
            one_decimal(rnd("risk_index", 1)), F.lit("/100"),
        ),
        F.concat(
            F.lit("Perubahan harga 7 hari: "), signed_one(rnd(change, 1)), F.lit("% ("),
            F.when(change > 0, "naik").otherwise("turun"), F.lit(")"),
        ),
        F.when(
            (F.col("current_price") != 0) & (F.col("forecast_7d") != 0),
            F.concat(
                F.lit("Proyeksi H+7: "), rupiah(rnd("current_price", 0)), F.lit(" → "), rupiah(rnd("forecast_7d", 0))
            ),
        ),
        F.when(
            F.size("top_signals") > 0,
            F.concat(F.lit("Sinyal dominan: "), F.array_join(F.slice("top_signals", 1, 3), ", ")),
        ),
        F.concat(F.lit("Rekomendasi: "), F.coalesce(action[F.col("level")], F.lit(""))),
    )
    return due.withColumns(
        {
            "id": F.concat_ws("_", KEY, F.date_format(as_of, "yyyyMMddHHmmss")),
            "message": message,
            "date_label": F.date_format(as_of, "dd MMMM yyyy"),
        }
    )


def alert_summary(alerts: DataFrame) -> DataFrame:
    """Alerts sent per level, and how many were held back. Input has ``level``, ``suppressed``."""
    sent = ~F.col("suppressed")
    return alerts.agg(
        F.count_if(sent).alias("total_alerts"),
        F.count_if(F.col("suppressed")).alias("total_suppressed"),
        *[
            F.count_if(sent & (F.col("level") == n)).alias(n.lower())
            for n in ("KRITIS", "SIAGA", "WASPADA")
        ],
    )


def suppressed_list(alerts: DataFrame) -> DataFrame:
    """Commodities with alerts held back, and how many."""
    return alerts.filter("suppressed").groupBy(KEY).agg(F.count(F.lit(1)).alias("n_suppressed"))


# --- cooldown -----------------------------------------------------------------------------
# An alert is sent when the last *sent* one of its commodity is at least the cooldown old, so
# each decision depends on the one before. To keep one busy commodity off a single task, its
# time line is cut into blocks of ``block`` cooldowns. Inside a block the only unknown is the first
# alert sent, which lies in the block's first cooldown (or is the first one after it). Per block
# we work out, for each such start, the last alert sent in the block; chaining these short
# tables over the blocks gives every block its true start, and the blocks are then resolved in
# parallel. Alerts of one commodity with equal times are merged first (map-side), so a group
# holds distinct times of 8 days (with the defaults), not alerts. A group covers all commodities of a slot, which
# the helpers handle in one pass.

BLOCK = 16
SLOTS = 64


class _Times:
    """Distinct times of one block, sorted by commodity and time."""

    def __init__(self, pdf: pd.DataFrame, gap: int, block: int):
        codes, self.names = pd.factorize(pdf[KEY])
        self.begin = int(pdf["block"].iloc[0]) * gap * block
        rel = pdf["us"].to_numpy() - self.begin
        self.order = np.lexsort((rel, codes))
        self.code, self.rel = codes[self.order].astype(np.int64), rel[self.order]
        self.bits = int(gap * (block + 2)).bit_length()
        self.rank = (self.code << self.bits) + self.rel
        self.size = len(self.rank)
        after, found = self.first(self.code, self.rel + gap)
        self.next = np.where(found, after, -1)

    def first(self, code: np.ndarray, rel: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Position of a commodity's first time at or after ``rel``, and whether there is one."""
        at = np.searchsorted(self.rank, (code << self.bits) + rel, side="left")
        found = (at < self.size) & (self.code[np.minimum(at, self.size - 1)] == code)
        return at, found


def _block_ends(gap: int, block: int):
    def ends(pdf: pd.DataFrame) -> pd.DataFrame:
        t = _Times(pdf, gap, block)
        hop = np.where(t.next >= 0, t.next, np.arange(t.size))
        while not np.array_equal(hop, hop[hop]):
            hop = hop[hop]
        all_codes = np.arange(len(t.names), dtype=np.int64)
        limit, _ = t.first(all_codes, np.full(len(all_codes), gap))
        start = np.flatnonzero(np.arange(t.size) <= limit[t.code])
        code, last = t.code[start], t.rel[hop[start]]
        # Neighbouring starts usually end in the same alert: keep one row per run of equal ends.
        keep = np.append((code[1:] != code[:-1]) | (last[1:] != last[:-1]), True)
        return pd.DataFrame(
            {
                "slot": pdf["slot"].iloc[0],
                KEY: t.names[code[keep]],
                "block": pdf["block"].iloc[0],
                "upto": t.rel[start[keep]] + t.begin,
                "last": last[keep] + t.begin,
            }
        )

    return ends


def _block_starts(gap: int):
    def starts(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([KEY, "block", "upto"])
        out: list[tuple] = []
        name = block = earliest = None
        placed = True
        for key, b, upto, last, seed in zip(pdf[KEY], pdf["block"], pdf["upto"], pdf["last"], pdf["seed"]):
            if key != name:
                name, block = key, None
                earliest = np.iinfo(np.int64).min if pd.isna(seed) else int(seed) + gap
            if b != block:
                block, placed = b, False
                out.append((name, block, earliest))
            if not placed and upto >= earliest:
                earliest, placed = last + gap, True
        table = pd.DataFrame(out, columns=[KEY, "block", "earliest"])
        table.insert(0, "slot", pdf["slot"].iloc[0])
        return table

    return starts


def _block_sent(gap: int, block: int):
    def sent(pdf: pd.DataFrame, starts: pd.DataFrame) -> pd.DataFrame:
        if pdf.empty:
            return pdf[[KEY, "us", "first_id"]]
        t = _Times(pdf, gap, block)
        earliest = dict(zip(starts[KEY], starts["earliest"]))
        begin = np.array([max(earliest[n] - t.begin, 0) for n in t.names], dtype=np.int64)
        begin = np.minimum(begin, gap * (block + 1))
        at, found = t.first(np.arange(len(t.names), dtype=np.int64), begin)
        at, picked = at[found], []
        while len(at):
            picked.append(at)
            at = t.next[at]
            at = at[at >= 0]
        rows = np.concatenate(picked) if picked else np.array([], dtype=np.int64)
        return pdf.iloc[t.order[rows]][[KEY, "us", "first_id"]]

    return sent


def cooldown(
    alerts: DataFrame, hours: int = 12, tie: str = "event_id", seed: DataFrame | None = None, slots: int = SLOTS,
    block: int = BLOCK,
) -> DataFrame:
    """Alerts (komoditas, ts, tie key, ...) with ``suppressed``. ``seed`` holds (komoditas, ts) of
    the last alert sent before these. ``slots`` spreads the commodities over tasks, ``block`` is the
    length of a group in cooldowns.

    Of alerts with equal commodity and time the one with the smallest tie key can be sent; of rows
    equal in the tie key too, one. An alert without commodity or time belongs to no series and is
    never held back.
    """
    gap = hours * 3_600_000_000
    us = F.unix_micros("ts")
    tie_type = alerts.schema[tie].dataType.simpleString()
    in_series = F.col(KEY).isNotNull() & F.col("ts").isNotNull()
    times = (
        alerts.filter(in_series).groupBy(KEY, us.alias("us"))
        .agg(F.min(tie).alias("first_id"))
        .withColumns(
            {"slot": F.pmod(F.hash(KEY), F.lit(slots)), "block": F.floor(F.col("us") / (gap * block))}
        )
    )
    # Both uses group the same table the same way, so Spark shuffles it once and reuses it.
    groups = times.groupBy("slot", "block")
    ends = groups.applyInPandas(_block_ends(gap, block), f"slot int, {KEY} string, block long, upto long, last long")
    if seed is None:
        ends = ends.withColumn("seed", F.lit(None).cast("long"))
    else:
        ends = ends.join(seed.select(KEY, us.alias("seed")), KEY, "left")
    starts = ends.groupBy("slot").applyInPandas(
        _block_starts(gap), f"slot int, {KEY} string, block long, earliest long"
    )
    sent = (
        groups.cogroup(starts.groupBy("slot", "block"))
        .applyInPandas(_block_sent(gap, block), f"{KEY} string, us long, first_id {tie_type}")
        .select(F.col(KEY).alias("_key"), F.col("us").alias("_at"), F.col("first_id").alias("_id"))
    )
    rows = alerts.withColumn("_us", us)
    match = (F.col(KEY) == F.col("_key")) & (F.col("_us") == F.col("_at")) & F.col(tie).eqNullSafe(F.col("_id"))
    plain = [f.name for f in alerts.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    again = F.row_number().over(Window.partitionBy(KEY, "_us", tie).orderBy(F.xxhash64(*plain)))
    return (
        rows.join(sent, match, "left")
        .withColumn("_again", again)
        .withColumn("suppressed", in_series & (F.col("_key").isNull() | (F.col("_again") > 1)))
        .drop("_us", "_key", "_at", "_id", "_again")
    )


def escalations(levels: DataFrame, day: str = "date_parsed", runs: int = 3) -> DataFrame:
    """Stretches of at least ``runs`` consecutive rows at SIAGA or KRITIS."""
    w = Window.partitionBy(KEY).orderBy(day)
    numbered = levels.withColumn("_i", F.row_number().over(w)).filter(F.col("level").isin("SIAGA", "KRITIS"))
    island = numbered.withColumn("_island", F.col("_i") - F.row_number().over(w))
    return (
        island.groupBy(KEY, "_island")
        .agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.count(F.lit(1)).alias("n_runs"))
        .filter(F.col("n_runs") >= runs)
        .drop("_island")
    )
