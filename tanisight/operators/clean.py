"""Raw records to typed, canonical, de-duplicated silver tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tanisight.functions.numeric import exact_avg, exact_sum, rnd, safe_double
from tanisight.functions.temporal import day_of, iso_date
from tanisight.operators.dedup import keep_first, keep_last

TIMESTAMPS = ("fetched_at_utc", "ingestion_ts")
# Columns that split a country into parts with a record each
PARTS = ("provinsi", "negara_asal", "jenis_pupuk")


def first_present(df: DataFrame, names: Sequence[str]) -> str | None:
    """First of the names that is a column of the table."""
    return next((n for n in names if n in df.columns), None)


def resolve(df: DataFrame, spec: Mapping[str, Sequence[str]], keep: Sequence[str] = ()) -> DataFrame:
    """Canonical columns from the first candidate each table has; null when it has none."""
    picked = []
    for target, names in spec.items():
        name = first_present(df, names)
        picked.append((F.col(name) if name else F.lit(None).cast("string")).alias(target))
    return df.select(*picked, *keep)


def record_date(df: DataFrame) -> Column:
    """Date of a raw record from its first timestamp that holds one; 1970-01-01 when the table has
    no timestamp column."""
    days = [day_of(df, name) for name in TIMESTAMPS if name in df.columns]
    return F.coalesce(*days) if days else F.to_date(F.lit("1970-01-01"))


def canonical_filter(df: DataFrame, commodities: Sequence[str], column: str = "komoditas") -> DataFrame:
    """Rows of known commodities only."""
    return df.filter(F.col(column).isin(list(commodities)))


def silver_prices(
    raw: DataFrame, commodities: Sequence[str], tie: Sequence[str], dedup: bool = True
) -> DataFrame:
    """One price feed: canonical names, numeric price, known commodities, first row per
    (source, komoditas, day)."""
    dated = raw.withColumn("_date", record_date(raw))
    spec = {
        "source": ["source"],
        "data_source": ["data_source", "source"],
        "komoditas": ["komoditas", "commodity"],
        "price_idr_per_kg": ["price_idr_per_kg", "price"],
        "date_parsed": ["_date"],
    }
    extra = [c for c in tie if c not in spec]
    resolved = resolve(dated, spec, keep=extra).withColumn("price_idr_per_kg", safe_double("price_idr_per_kg"))
    known = canonical_filter(resolved, commodities).filter(F.col("date_parsed").isNotNull())
    if dedup:
        known = keep_first(known, ["date_parsed", "komoditas", "source"], tie)
    return known.drop(*extra)


def silver_kurs(raw: DataFrame, tie: Sequence[str]) -> DataFrame:
    """Exchange rates, first row per (source, day)."""
    dated = raw.withColumn("date_parsed", record_date(raw)).filter(F.col("date_parsed").isNotNull())
    quotes = [c for c in ("kurs_jual", "kurs_beli", "kurs_tengah", "pair", "data_source") if c in raw.columns]
    return keep_first(dated, ["date_parsed", "source"], tie).select("source", "date_parsed", *quotes)


def silver_news(raw: DataFrame, tie: Sequence[str]) -> DataFrame:
    """Articles, first row per article_id."""
    dated = raw.withColumn("date_parsed", record_date(raw))
    return keep_first(dated, ["article_id"], tie)


def silver_weather(raw: DataFrame, tie: Sequence[str]) -> DataFrame:
    """Weather, first row per (region, day); nested fields stay typed."""
    dated = raw.withColumn("date_parsed", record_date(raw))
    return keep_first(dated, ["date_parsed", "sentra"], tie)


def silver_macro(raw: DataFrame, tie: Sequence[str] = ("value",)) -> DataFrame | None:
    """Indicators as (source, indicator, date_parsed, value); None when a column is missing."""
    if "date" in raw.columns:
        date = day_of(raw, "date")
    elif "year" in raw.columns:
        date = F.make_date(F.col("year").cast("int"), F.lit(1), F.lit(1))
    else:
        date = record_date(raw)
    value = first_present(raw, ["value", "close_price"])
    if value is None or not {"source", "indicator"} <= set(raw.columns):
        return None
    rows = raw.select(
        "source", "indicator", date.alias("date_parsed"), safe_double(value).alias("value"),
        *[c for c in tie if c != "value"],
    ).filter(F.col("date_parsed").isNotNull())
    first = keep_first(rows, ["date_parsed", "indicator", "source"], list(tie))
    return first.select("source", "indicator", "date_parsed", "value")


def union_sources(tables: Sequence[DataFrame]) -> DataFrame:
    """Union by name; columns that a table lacks become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def macro_unpivot(wide: DataFrame, ids: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Wide batch records to one row per indicator."""
    doubles = wide.select(*ids, *[F.col(m).cast("double").alias(m) for m in measures])
    return doubles.unpivot(list(ids), list(measures), "indicator", "value")


def period_start(df: DataFrame) -> Column:
    """First day of what a batch record is about: its day, else its month, else its year; a record that names none
    (or an impossible one) is about the day it arrived."""
    starts = [day_of(df, "tanggal")] if "tanggal" in df.columns else []
    if "tahun" in df.columns:
        month = F.coalesce(F.col("bulan"), F.lit(1)) if "bulan" in df.columns else F.lit(1)
        starts.append(F.concat_ws("-", F.col("tahun").cast("string"), month.cast("string"), F.lit("1")).try_cast("date"))
    return F.coalesce(*starts, record_date(df))


def macro_by_period(
    raw: DataFrame, measures: Sequence[str], averaged: Sequence[str] = (), tie: Sequence[str] = TIMESTAMPS
) -> DataFrame:
    """Batch records as (komoditas, indicator, date_parsed, value), one row per commodity, indicator and period.

    The newest record (``tie``, then values) per source, commodity, part of the country and period counts. Parts are
    added up, or averaged for the ``averaged`` measures. Of several sources the first by name counts. A record
    without commodity is about all of them: ``komoditas`` is null.
    """
    parts = [c for c in PARTS if c in raw.columns]
    komoditas = F.col("komoditas") if "komoditas" in raw.columns else F.lit(None).cast("string")
    dated = raw.withColumns(
        {"date_parsed": period_start(raw), "komoditas": komoditas, "source": F.coalesce("source", F.lit(""))}
    ).filter(F.col("date_parsed").isNotNull())
    keys = ["date_parsed", "komoditas", *parts, "source"]
    newest = keep_last(dated, keys, [*[c for c in tie if c in raw.columns], *measures])
    groups = newest.groupBy("komoditas", "date_parsed", "source")
    rolled = groups.agg(
        *[rnd(exact_avg(m, 4), 4).alias(m) if m in averaged else exact_sum(m, 4).alias(m) for m in measures]
    )
    long = macro_unpivot(rolled, ["komoditas", "date_parsed", "source"], measures).filter(F.col("value").isNotNull())
    first = long.groupBy("komoditas", "indicator", "date_parsed").agg(F.min_by("value", "source").alias("value"))
    return first


def map_exact(df: DataFrame, column: str, table: DataFrame) -> DataFrame:
    """Replace a value by its entry in a (name, canonical) table; others stay."""
    return (
        df.join(table.withColumnRenamed("name", column), column, "left")
        .withColumn(column, F.coalesce("canonical", F.col(column)))
        .drop("canonical")
    )


def normalize_names(df: DataFrame, column: str, aliases: DataFrame, known: DataFrame, out: str) -> DataFrame:
    """Lower-case trimmed name to its canonical form: by alias, else itself if known, else null.

    ``aliases`` is (name, canonical), ``known`` has one column ``komoditas``.
    """
    table = aliases.withColumn("_own", F.lit(0)).unionByName(
        known.select(F.col("komoditas").alias("name"), F.col("komoditas").alias("canonical")).withColumn(
            "_own", F.lit(1)
        )
    )
    table = keep_first(table, ["name"], ["_own", "canonical"]).select(
        F.col("name").alias("_key"), F.col("canonical").alias(out)
    )
    return df.withColumn("_key", F.lower(F.trim(column))).join(table, "_key", "left").drop("_key")


def latest_positive(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """Last value of each series, only where it is known and positive."""
    last = df.groupBy(*keys).agg(F.max_by(F.col(value), F.struct(*order)).alias(value))
    return last.filter(F.col(value) > 0)


def first_positive(fields: Sequence[Column | str]) -> Column:
    """First field that is a number above 0."""
    numbers = [safe_double(f) for f in fields]
    return F.coalesce(*[F.when(n > 0, n) for n in numbers])


def source_precedence(
    spine: DataFrame, primary: DataFrame, secondary: DataFrame, series: str, date: str, value: str,
    last: DataFrame | None = None,
) -> DataFrame:
    """Value per (series, date): primary source, else secondary, else the last one carried
    forward; ``origin`` says which. One row per key in each input. ``last`` holds (series, value) that
    earlier runs saw last (``last_values``); it is carried into this run."""
    keys = [series, date]
    joined = spine.join(primary.select(*keys, F.col(value).alias("_p")), keys, "left").join(
        secondary.select(*keys, F.col(value).alias("_s")), keys, "left"
    )
    seen = joined.withColumn("_seen", F.coalesce("_p", "_s"))
    w = Window.partitionBy(series).orderBy(date).rowsBetween(Window.unboundedPreceding, -1)
    carried = seen.withColumn("_carried", F.last("_seen", ignorenulls=True).over(w))
    if last is not None:
        before = last.select(series, F.col(value).alias("_before"))
        carried = carried.join(before, series, "left").withColumn("_carried", F.coalesce("_carried", "_before"))
    origin = (
        F.when(F.col("_p").isNotNull(), "primary")
        .when(F.col("_s").isNotNull(), "secondary")
        .when(F.col("_carried").isNotNull(), "last_known")
        .otherwise("missing")
    )
    return carried.select(*keys, F.coalesce("_seen", "_carried").alias(value), origin.alias("origin"))


def last_values(filled: DataFrame, series: str, date: str, value: str, last: DataFrame | None = None) -> DataFrame:
    """The last value of each series that came from a source in this run, else what earlier runs saw last."""
    real = filled.filter(F.col("origin").isin("primary", "secondary")).select(series, F.col(date).alias("_at"), value)
    if last is not None:
        real = real.unionByName(last.select(series, F.lit(None).cast("date").alias("_at"), value))
    return real.groupBy(series).agg(F.max_by(value, F.struct(F.col("_at").isNotNull(), "_at")).alias(value))


def source_hits(filled: DataFrame) -> DataFrame:
    """How many values came from each origin."""
    return filled.groupBy("origin").agg(F.count(F.lit(1)).alias("hits"))


def sanity_split(df: DataFrame, column: str, low: float, high: float) -> tuple[DataFrame, DataFrame]:
    """Rows strictly inside (low, high), and the rejects (null included)."""
    inside = (F.col(column) > low) & (F.col(column) < high)
    return df.filter(inside), df.filter(~F.coalesce(inside, F.lit(False)))


def fx_quotes(rate: Column) -> dict[str, Column]:
    """Sell, buy and mid quotes of a rate."""
    return {
        "kurs_jual": rnd(rate, 2),
        "kurs_beli": rnd(rate * 0.997, 2),
        "kurs_tengah": rnd(rate * 0.9985, 2),
    }


def usable_rates(raw: DataFrame, low: float, high: float) -> tuple[DataFrame, DataFrame]:
    """(rates, rejects): records whose middle rate, or selling rate where there is none, lies strictly within the
    range. Quotes that a record lacks are derived from its selling rate."""
    rated = raw.withColumn("_rate", F.coalesce("kurs_tengah", "kurs_jual"))
    inside, outside = sanity_split(rated, "_rate", low, high)
    derived = {n: F.coalesce(F.col(n), q) for n, q in fx_quotes(F.col("kurs_jual")).items()}
    return inside.withColumns(derived).drop("_rate"), outside.drop("_rate")


def date_parse_audit(df: DataFrame, column: str, formats: Mapping[str, str]) -> DataFrame:
    """Rows, and rows whose text is no date under each format, as one row per format."""
    checks = {"iso8601": iso_date(column)} | {
        name: F.try_to_timestamp(F.col(column), F.lit(fmt)) for name, fmt in formats.items()
    }
    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(F.col(column).isNotNull() & parsed.isNull()).alias(n) for n, parsed in checks.items()],
    )
    return counts.unpivot(["n_rows"], list(checks), "parse_mode", "n_unparsed")
