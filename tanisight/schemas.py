"""Schemas of the raw streams as DDL. Nested fields stay typed."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

_STAMPS = "fetched_at_utc string, ingestion_ts string"

PRICE = (
    "source string, data_source string, komoditas string, commodity string, level_harga string, "
    "provinsi string, price_idr_per_kg double, price double, currency string, unit string, "
    f"country string, {_STAMPS}"
)
# The live weather service returns a forecast: one array element per day, today first. Records with
# a single value per field are read as arrays of one.
WEATHER = (
    "source string, sentra string, lat double, lon double, komoditas array<string>, "
    "current struct<temperature_2m: double, relative_humidity_2m: int, precipitation: double, "
    "rain: double, wind_speed_10m: double, weather_code: int>, "
    "daily struct<time: array<string>, temperature_2m_max: array<double>, temperature_2m_min: array<double>, "
    "precipitation_sum: array<double>, rain_sum: array<double>, wind_speed_10m_max: array<double>>, "
    f"{_STAMPS}"
)
NEWS = (
    "source string, article_id string, url string, title string, summary string, published string, "
    "komoditas_matched array<string>, supply_keywords array<string>, sentra_matched array<string>, "
    f"relevance_score int, {_STAMPS}"
)
KURS = (
    "source string, data_source string, pair string, kurs_jual double, kurs_beli double, "
    f"kurs_tengah double, currency string, country string, {_STAMPS}"
)
PRODUKSI = (
    "source string, data_source string, komoditas string, tahun int, bulan int, produksi_ton double, "
    f"luas_panen_ha double, produktivitas_ton_per_ha double, provinsi string, country string, {_STAMPS}"
)
IMPOR_EKSPOR = (
    "source string, data_source string, komoditas string, bulan int, tahun int, impor_ton double, "
    f"impor_usd double, ekspor_ton double, ekspor_usd double, negara_asal string, country string, {_STAMPS}"
)
STOK_BULOG = (
    "source string, data_source string, komoditas string, stok_ton double, kapasitas_gudang_ton double, "
    f"utilisasi_pct double, provinsi string, tanggal string, country string, {_STAMPS}"
)
HARGA_PUPUK = (
    "source string, data_source string, jenis_pupuk string, harga_subsidi_per_kg double, "
    f"harga_nonsubsidi_per_kg double, ketersediaan_pct double, provinsi string, country string, {_STAMPS}"
)
SP2KP = (
    "source string, data_source string, komoditas string, harga_konsumen double, harga_grosir double, "
    f"pasar string, kota string, provinsi string, country string, {_STAMPS}"
)

STREAMS = {
    "price_bapanas": PRICE, "price_pihps": PRICE, "price_siskaperbapo": PRICE,
    "weather": WEATHER, "news": NEWS, "kurs": KURS,
}
BATCHES = {
    "batch_produksi": PRODUKSI, "batch_imporekspor": IMPOR_EKSPOR, "batch_bulog_stok": STOK_BULOG,
    "batch_pupuk_harga": HARGA_PUPUK, "batch_sp2kp": SP2KP,
}
# Measures of each batch stream that become macro indicators
MEASURES = {
    "batch_produksi": ["produksi_ton", "luas_panen_ha", "produktivitas_ton_per_ha"],
    "batch_imporekspor": ["impor_ton", "impor_usd", "ekspor_ton", "ekspor_usd"],
    "batch_bulog_stok": ["stok_ton", "kapasitas_gudang_ton", "utilisasi_pct"],
    "batch_pupuk_harga": ["harga_subsidi_per_kg", "harga_nonsubsidi_per_kg", "ketersediaan_pct"],
}

# Of these, the parts of a country are averaged; the others are added up
AVERAGED = [
    "produktivitas_ton_per_ha", "utilisasi_pct", "harga_subsidi_per_kg", "harga_nonsubsidi_per_kg", "ketersediaan_pct",
]


def schema(spark: SparkSession, ddl: str) -> StructType:
    return spark.createDataFrame([], ddl).schema
