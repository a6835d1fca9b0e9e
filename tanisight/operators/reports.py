"""Situation report and rule-based recommendations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tanisight.functions.numeric import rnd
from tanisight.functions.text import one_decimal, rupiah, signed_one

KEY = "komoditas"

# Headings of the situation report
TITLE = "=== RINGKASAN KONDISI PANGAN TERKINI ==="
RISK_HEADING = "--- Indeks Risiko Lonjakan Harga ---"
FORECAST_HEADING = "--- Prediksi Harga 7 Hari ke Depan ---"
NEWS_HEADING = "--- Sinyal Berita Signifikan (velocity ≥ {}×) ---"

# Recommendation texts per audience. {} takes the list of commodities.
CALM = {
    "government": (
        "Kondisi harga pangan saat ini dalam batas aman. "
        "Disarankan untuk tetap memantau perkembangan cuaca di sentra produksi "
        "dan melakukan pembaruan data stok Bulog secara rutin."
    ),
    "umkm": (
        "Harga bahan baku relatif stabil minggu ini. "
        "Pertahankan level stok normal dan manfaatkan momentum ini "
        "untuk membangun buffer stok kecil sebagai antisipasi."
    ),
}
HEAD = {
    "government": "**Rekomendasi untuk TPID/Bapanas:**",
    "umkm": "**Saran untuk Pedagang & UMKM Kuliner:**",
}
URGENT = {
    "government": (
        "[!] PRIORITAS TINGGI: {} menunjukkan sinyal risiko "
        "kritis. Rekomendasikan koordinasi operasi pasar dalam 3-5 hari ke depan."
    ),
    "umkm": (
        "[KRITIS] Pertimbangkan stok tambahan {} untuk 7-10 hari "
        "ke depan sebelum harga melonjak lebih tinggi."
    ),
}
WATCH = {
    "government": (
        "- Monitor: {} memasuki zona waspada. "
        "Siapkan distribusi stok cadangan dan koordinasi dengan distributor daerah."
    ),
    "umkm": (
        "[WASPADA] {}: Pantau harga pasar harian dan mulai "
        "kalkulasi ulang HPP menu yang menggunakan bahan ini."
    ),
}
CLOSING = {
    "government": (
        "- Aktifkan sistem monitoring harga harian di pasar induk utama "
        "dan pantau laporan cuaca sentra produksi selama 7 hari ke depan."
    ),
    "umkm": (
        "- Pertimbangkan menu alternatif atau ukuran porsi yang lebih fleksibel "
        "sebagai strategi buffer terhadap kenaikan harga bahan baku."
    ),
}


def _section(df: DataFrame, section: int, line: Column) -> DataFrame:
    return df.select(F.lit(section).alias("section"), "position", line.alias("line"))


def report_lines(
    risk: DataFrame, forecast: DataFrame, velocity: DataFrame, commodities: DataFrame, as_of: str,
    fast_at: float = 2.0,
) -> DataFrame:
    """Lines of the situation report as rows (section, position, line).

    ``commodities`` has (komoditas, label, position). The tables hold one row per commodity. News of a
    velocity of ``fast_at`` or more have a section.
    """
    spark = risk.sparkSession
    named = commodities.select(KEY, "label", "position")
    fixed = spark.createDataFrame(
        [(0, 1, TITLE), (0, 3, ""), (1, 0, RISK_HEADING), (3, 0, ""), (4, 0, FORECAST_HEADING)],
        "section int, position int, line string",
    )
    day = spark.range(1).select(
        F.lit(0).alias("section"), F.lit(2).alias("position"),
        F.concat(F.lit("Tanggal analisis: "), F.date_format(F.lit(as_of).cast("date"), "dd MMMM yyyy")).alias("line"),
    )
    risk_line = F.concat(
        F.lit("• "), "label", F.lit(": "), one_decimal(rnd("risk_index", 1)), F.lit("/100 ["), "level",
        F.lit("] (harga="), one_decimal(rnd("price_signal", 1)),
        F.lit(", cuaca="), one_decimal(rnd("weather_signal", 1)),
        F.lit(", berita="), one_decimal(rnd("news_signal", 1)), F.lit(")"),
    )
    change = F.col("predicted_change_pct")
    arrow = F.when(change > 0, "↑").when(change < 0, "↓").otherwise("→")
    forecast_line = F.concat(
        F.lit("• "), "label", F.lit(": "), rupiah(rnd("current_price", 0)), F.lit(" "), arrow, F.lit(" "),
        rupiah(rnd("forecast_7d", 0)), F.lit(" ("), signed_one(rnd(change, 1)), F.lit("%)"),
    )
    news_line = F.concat(
        F.lit("• "), "label", F.lit(": velocity="), one_decimal(rnd("velocity", 1)), F.lit("x rata-rata 7 hari")
    )
    fast = velocity.filter(F.col("velocity") >= fast_at)
    heading = fast.limit(1).select(
        F.explode(F.array(F.struct(F.lit(0), F.lit("")), F.struct(F.lit(1), F.lit(NEWS_HEADING.format(f"{fast_at:g}"))))).alias("h")
    ).select(F.lit(6).alias("section"), F.col("h.col1").alias("position"), F.col("h.col2").alias("line"))
    parts = [
        day,
        _section(named.join(risk, KEY), 2, risk_line),
        _section(named.join(forecast, KEY), 5, forecast_line),
        heading,
        _section(named.join(fast, KEY), 7, news_line),
    ]
    lines = fixed
    for part in parts:
        lines = lines.unionByName(part)
    return lines


def report_text(lines: DataFrame) -> DataFrame:
    """The report as one text; it has a few lines per commodity."""
    ordered = F.array_sort(F.collect_list(F.struct("section", "position", "line")))
    return lines.agg(F.array_join(F.transform(ordered, lambda x: x["line"]), "\n").alias("report"))


def recommendations(high_risk: DataFrame, labels: DataFrame) -> DataFrame:
    """Text per audience from the commodities at risk (komoditas, level, rank)."""
    named = high_risk.join(labels.select(KEY, "label"), KEY, "left").withColumn(
        "label", F.coalesce("label", KEY)
    )

    def listed(condition: Column) -> Column:
        ordered = F.array_sort(F.collect_list(F.when(condition, F.struct("rank", "label"))))
        return F.array_join(F.transform(ordered, lambda x: x["label"]), ", ")

    lists = named.agg(
        listed(F.col("level").isin("KRITIS", "SIAGA")).alias("urgent"),
        listed(F.col("level") == "WASPADA").alias("watch"),
    )

    def filled(template: str, column: str) -> Column:
        before, after = template.split("{}")
        return F.when(F.col(column) != "", F.concat(F.lit(before), F.col(column), F.lit(after)))

    def text(audience: str) -> Column:
        advice = F.concat_ws(
            "\n",
            F.lit(HEAD[audience]), filled(URGENT[audience], "urgent"), filled(WATCH[audience], "watch"),
            F.lit(CLOSING[audience]),
        )
        calm = (F.col("urgent") == "") & (F.col("watch") == "")
        return F.when(calm, CALM[audience]).otherwise(advice)

    entries = [F.struct(F.lit(a).alias("audience"), text(a).alias("text")) for a in ("government", "umkm")]
    return lists.select(F.inline(F.array(*entries)))
