"""Time-series features per commodity.

All frames count rows of the daily series, never calendar days. Columns that share an order are
added in one ``withColumns``, so Spark sorts each series once. The series holds at most one row
per calendar day, so a commodity's window stays small whatever the size of the raw feeds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tanisight.dims import FEATURES_14D, FEATURES_7D, FEATURES_MAGNITUDE, FEATURES_TIMING
from tanisight.functions.numeric import frame, frame_mean, frame_std, pct_change

KEY, DAY, PRICE = "komoditas", "date_parsed", "avg_price"
NO_SPIKE = 999


def by_day():
    return Window.partitionBy(KEY).orderBy(DAY)


def lags(rows: Sequence[int]) -> dict[str, Column]:
    return {f"price_lag_{n}d": F.lag(PRICE, n).over(by_day()) for n in rows}


def rolling(means: Sequence[int], stds: Sequence[int]) -> dict[str, Column]:
    out = {f"price_ma_{n}d": frame_mean(PRICE, frame(KEY, DAY, n), n) for n in means}
    return out | {f"price_std_{n}d": frame_std(PRICE, frame(KEY, DAY, n), n) for n in stds}


def change(rows: int) -> Column:
    """Change in percent against the price ``rows`` rows earlier."""
    return pct_change(PRICE, F.lag(PRICE, rows).over(by_day()))


def changes(rows: Sequence[int], prefix: str = "price_pct") -> dict[str, Column]:
    return {f"{prefix}_{n}d": change(n) for n in rows}


def roll7(column: str) -> Column:
    """Seven-row mean of a weather column (one decimal)."""
    return frame_mean(column, frame(KEY, DAY, 7), 7, scale=1)


def variation(rows: int = 14) -> Column:
    """Coefficient of variation in percent, 0 until the window is full."""
    w = frame(KEY, DAY, rows)
    return F.coalesce(F.try_divide(frame_std(PRICE, w, rows), frame_mean(PRICE, w, rows)) * 100, F.lit(0.0))


def forward(rows: int) -> Column:
    return F.lead(PRICE, rows).over(by_day())


def targets(horizons: Sequence[int] = (7, 14)) -> dict[str, Column]:
    """Later prices, and absolute and relative change over seven rows."""
    return {f"target_price_{h}d": forward(h) for h in horizons} | {
        "target_change_rpkg": forward(7) - F.col(PRICE),
        "target_change_pct": pct_change(forward(7), PRICE),
    }


def calendar() -> dict[str, Column]:
    month = F.month(DAY)
    return {
        "trend_idx": (F.row_number().over(by_day()) - 1).cast("double"),
        "day_of_week": F.weekday(DAY),
        "month": month,
        "is_ramadan_season": month.isin(3, 4).cast("double"),
        "is_yearend": month.isin(12, 1).cast("double"),
    }


def clean_series(df: DataFrame, min_rows: int = 0) -> DataFrame:
    """Rows with day and price, of commodities that have enough of them."""
    rows = df.dropna(subset=[DAY, PRICE])
    if not min_rows:
        return rows
    n = F.count(F.lit(1)).over(Window.partitionBy(KEY))
    return rows.withColumn("_n", n).filter(F.col("_n") >= min_rows).drop("_n")


def history_gate(df: DataFrame, min_rows: int) -> DataFrame:
    """Rows per commodity and whether they are enough to train on."""
    return (
        df.dropna(subset=[DAY, PRICE])
        .groupBy(KEY)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .withColumn("enough", F.col("n_rows") >= min_rows)
    )


def _optional(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.lit(0.0) for c in columns if c not in df.columns})


def shocks(df: DataFrame, threshold: float = 0.15) -> DataFrame:
    """Days whose price moved by more than ``threshold`` against the row before."""
    before = F.lag(PRICE, 1).over(by_day())
    move = F.try_divide(F.abs(F.col(PRICE) - before), before)
    return df.select(KEY, DAY, move.alias("move")).filter(F.col("move") > threshold)


def spike_flags(df: DataFrame, either: float = 5.0, rise: float = 10.0) -> DataFrame:
    """Seven-row change, spike in either direction, and rise used in evaluation."""
    return df.withColumn("price_pct_7d", change(7)).select(
        KEY, DAY, PRICE, "price_pct_7d",
        F.coalesce(F.abs("price_pct_7d") > either, F.lit(False)).alias("is_spike"),
        F.coalesce(F.col("price_pct_7d") >= rise, F.lit(False)).alias("is_rise"),
    )


def days_to_spike(flagged: DataFrame) -> DataFrame:
    """Days to the next spike after each row and its class.

    Newest first, the next spike is the last one seen so far: one running pass per series.
    """
    newest_first = (
        Window.partitionBy(KEY).orderBy(F.col(DAY).desc()).rowsBetween(Window.unboundedPreceding, -1)
    )
    nearest = F.last(F.when(F.col("is_spike"), F.col(DAY)), ignorenulls=True).over(newest_first)
    days = F.coalesce(F.datediff(nearest, DAY), F.lit(NO_SPIKE))
    return flagged.withColumn("days_to_spike", days).withColumn(
        "target_class",
        F.when(F.col("days_to_spike") <= 7, 0)
        .when(F.col("days_to_spike") <= 14, 1)
        .when(F.col("days_to_spike") <= 30, 2)
        .otherwise(3),
    )


def features_7d(store: DataFrame) -> DataFrame:
    """Inputs of the 7-row forecast, before incomplete rows are dropped."""
    df = _optional(
        clean_series(store, 30), ["precipitation_sum", "temperature_max", "news_score", "news_velocity"]
    )
    return df.withColumns(
        lags([1, 3, 7, 14, 30])
        | rolling([7, 14, 30], [7, 14, 30])
        | changes([7, 30])
        | {"precip_roll7": roll7("precipitation_sum"), "temp_roll7": roll7("temperature_max")}
        | {"target_price_7d": forward(7)}
    )


def features_14d(store: DataFrame, horizon: int = 14) -> DataFrame:
    """Inputs of the longer forecast: as above plus calendar features."""
    wanted = {k: v for k, v in calendar().items() if k in FEATURES_14D}
    return features_7d(store).withColumns(wanted | {f"target_price_{horizon}d": forward(horizon)})


def features_magnitude(store: DataFrame) -> DataFrame:
    """Inputs of the size-of-move estimate."""
    df = _optional(clean_series(store, 30), ["precipitation_sum", "news_score", "news_velocity"])
    temp = roll7("temperature_max") if "temperature_max" in df.columns else F.lit(None).cast("double")
    move = targets([])
    return df.withColumns(
        lags([1, 3, 7, 14])
        | rolling([7, 14, 30], [7, 14])
        | changes([7, 30])
        | {
            "coeff_var_14d": variation(),
            "precip_roll7": F.coalesce(roll7("precipitation_sum"), F.lit(0.0)),
            "temp_roll7": F.coalesce(temp, F.lit(30.0)),
            "month": F.month(DAY),
        }
        | move
    )


def features_timing(store: DataFrame) -> DataFrame:
    """Inputs and class of the next-spike window."""
    df = _optional(clean_series(store, 30), ["precipitation_sum", "news_score", "news_velocity"])
    temp = roll7("temperature_max") if "temperature_max" in df.columns else F.lit(None).cast("double")
    seasons = {k: v for k, v in calendar().items() if k in FEATURES_TIMING}
    wide = df.withColumns(
        changes([3, 7, 14], "price_momentum")
        | rolling([7, 14], [7, 14])
        | {
            "precip_roll7": F.coalesce(roll7("precipitation_sum"), F.lit(0.0)),
            "temp_roll7": F.coalesce(temp, F.lit(30.0)),
        }
        | seasons
    ).withColumns(
        {
            "precip_anomaly": F.coalesce(F.col("precipitation_sum") - F.col("precip_roll7"), F.lit(0.0)),
            "is_spike": F.coalesce(F.abs("price_momentum_7d") > 5.0, F.lit(False)),
        }
    )
    return days_to_spike(wide)


MATRICES = {
    "7d": (features_7d, FEATURES_7D, "target_price_7d"),
    "7d_calendar": (features_14d, FEATURES_14D, "target_price_7d"),
    "14d": (features_14d, FEATURES_14D, "target_price_14d"),
    "magnitude": (features_magnitude, FEATURES_MAGNITUDE, "target_change_rpkg"),
    "timing": (features_timing, FEATURES_TIMING, "target_class"),
}


def feature_matrix(store: DataFrame, kind: str) -> DataFrame:
    """Training rows: every input and the target known."""
    build, columns, target = MATRICES[kind]
    extra = ["target_change_pct"] if kind == "magnitude" else []
    rows = build(store).dropna(subset=[*columns, target])
    return rows.select(KEY, DAY, PRICE, *columns, target, *extra)


def scoring_rows(store: DataFrame, kind: str, strict_reference: bool = False) -> DataFrame:
    """Newest row per commodity with all inputs known; ``strict_reference`` takes the newest one
    whose target is known too, which is as many rows old as the horizon."""
    build, columns, target = MATRICES[kind]
    rows = build(store).dropna(subset=[*columns, target] if strict_reference else columns)
    w = Window.partitionBy(KEY).orderBy(F.col(DAY).desc())
    newest = rows.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") == 1)
    return newest.select(KEY, DAY, PRICE, *columns)


def time_folds(df: DataFrame, splits: int = 3) -> DataFrame:
    """Expanding folds per commodity: each fold tests the next quarter and trains on all before."""
    w = Window.partitionBy(KEY)
    numbered = df.withColumns(
        {"_i": F.row_number().over(by_day()) - 1, "_n": F.count(F.lit(1)).over(w)}
    ).withColumn("_size", F.floor(F.col("_n") / (splits + 1)))
    folds = numbered.withColumn("fold", F.explode(F.array(*[F.lit(k) for k in range(splits)])))
    start = F.col("_n") - (F.lit(splits) - F.col("fold")) * F.col("_size")
    placed = folds.withColumn(
        "role",
        F.when(F.col("_i") < start, "train").when(F.col("_i") < start + F.col("_size"), "test"),
    )
    return placed.filter(F.col("role").isNotNull()).drop("_i", "_n", "_size")


def class_weights(matrix: DataFrame) -> DataFrame:
    """Weight of each class present: n / (classes * rows of the class)."""
    per_class = matrix.groupBy(KEY, "target_class").agg(F.count(F.lit(1)).alias("n_class"))
    w = Window.partitionBy(KEY)
    return per_class.withColumn(
        "weight",
        F.sum("n_class").over(w) / (F.count(F.lit(1)).over(w) * F.col("n_class")),
    )


def spike_stats(matrix: DataFrame, threshold: float = 5.0) -> DataFrame:
    """Share and number of spikes and the largest move per commodity."""
    size = F.abs("target_change_pct")
    n = F.count_if(size > threshold)
    return matrix.groupBy(KEY).agg(
        n.alias("n_spikes"),
        (F.floor(n / F.count(F.lit(1)) * 1000 + 0.5) / 1000).alias("spike_probability"),
        (F.floor(F.max(size) * 10 + 0.5) / 10).alias("max_spike_pct"),
    )


def move_quantiles(matrix: DataFrame) -> DataFrame:
    """Empirical 10/50/90 % quantiles of the seven-row move, absolute and in percent."""
    aggs = []
    for column, short in (("target_change_rpkg", "rpkg"), ("target_change_pct", "pct")):
        for q, name in ((0.1, "p10"), (0.5, "p50"), (0.9, "p90")):
            value = F.percentile(column, q)
            aggs.append((F.floor(value * 100 + 0.5) / 100).alias(f"{short}_{name}"))
    return matrix.groupBy(KEY).agg(*aggs)


def live_change(df: DataFrame) -> DataFrame:
    """Latest price, change against the last different price (else the row before) and against
    seven rows back (else the first row)."""
    newest = Window.partitionBy(KEY).orderBy(F.col(DAY).desc())
    latest = F.first(PRICE).over(newest.rowsBetween(Window.unboundedPreceding, 0))
    ranked = df.withColumns({"_rank": F.row_number().over(newest), "_now": latest})
    moved = (F.col(PRICE) > 0) & (F.col(PRICE) != F.col("_now"))
    picked = ranked.groupBy(KEY).agg(
        F.max("_now").alias("price"),
        F.max_by(F.when(moved, F.col(PRICE)), F.when(moved, F.col(DAY))).alias("_other"),
        F.max(F.when(F.col("_rank") == 2, F.col(PRICE))).alias("_before"),
        F.max(F.when(F.col("_rank") == 7, F.col(PRICE))).alias("_seventh"),
        F.max_by(PRICE, "_rank").alias("_first"),
        F.count(F.lit(1)).alias("_n"),
    )

    def rounded(old: Column) -> Column:
        value = (F.col("price") - old) / old * 100
        return F.when((old > 0) & (F.col("price") != 0), F.floor(value * 100 + 0.5) / 100)

    back7 = F.when(F.col("_n") >= 7, F.col("_seventh")).when(F.col("_n") >= 2, F.col("_first"))
    return picked.select(
        KEY,
        "price",
        rounded(F.coalesce("_other", "_before")).alias("change_1d"),
        rounded(back7).alias("change_7d"),
    )
