"""Dictionaries and thresholds as data.

Every operator takes these as parameters; the values here are the defaults for Indonesian
food prices. Tables of regions and aliases become small DataFrames.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

# --- Fixed values: commodities and their display names -------------------------------------
LABELS = {
    "beras": "Beras",
    "cabai_rawit_merah": "Cabai Rawit Merah",
    "cabai_keriting": "Cabai Merah Keriting",
    "bawang_merah": "Bawang Merah",
    "bawang_putih": "Bawang Putih",
    "gula_pasir": "Gula Pasir",
    "minyak_goreng": "Minyak Goreng",
    "daging_ayam": "Daging Ayam",
    "telur_ayam": "Telur Ayam",
    "daging_sapi": "Daging Sapi",
}

# --- Fixed values: other spellings of a commodity ------------------------------------------
ALIASES = {
    "cabai": "cabai_rawit_merah",
    "cabe": "cabai_rawit_merah",
    "rawit": "cabai_rawit_merah",
    "cabai rawit": "cabai_rawit_merah",
    "cabai rawit merah": "cabai_rawit_merah",
    "cabai keriting": "cabai_keriting",
    "cabai merah keriting": "cabai_keriting",
    "bawang": "bawang_merah",
    "bawang merah": "bawang_merah",
    "bawang putih": "bawang_putih",
    "beras": "beras",
    "padi": "beras",
    "gabah": "beras",
    "gula pasir": "gula_pasir",
    "gula": "gula_pasir",
    "minyak goreng": "minyak_goreng",
    "minyak": "minyak_goreng",
    "daging ayam": "daging_ayam",
    "ayam": "daging_ayam",
    "telur ayam": "telur_ayam",
    "telur": "telur_ayam",
    "daging sapi": "daging_sapi",
    "sapi": "daging_sapi",
}

# --- Fixed values: rice grades that count as rice in the raw price feeds -------------------
GRADES = {
    "beras_kualitas_bawah": "beras",
    "beras_kualitas_medium": "beras",
    "beras_kualitas_super": "beras",
}

# --- Fixed values: producing regions -------------------------------------------------------
# komoditas, nama, provinsi, lat, lon, bobot (weights add up to 1 per commodity)
REGIONS = """
beras,karawang,Jawa Barat,-6.305,107.305,0.35
beras,cianjur,Jawa Barat,-6.817,107.142,0.20
beras,banyuwangi,Jawa Timur,-8.219,114.369,0.15
beras,indramayu,Jawa Barat,-6.329,108.323,0.20
beras,sragen,Jawa Tengah,-7.424,111.030,0.10
cabai_rawit_merah,brebes,Jawa Tengah,-6.872,109.046,0.30
cabai_rawit_merah,temanggung,Jawa Tengah,-7.308,110.162,0.25
cabai_rawit_merah,blitar,Jawa Timur,-8.097,112.163,0.20
cabai_rawit_merah,probolinggo,Jawa Timur,-7.754,113.215,0.15
cabai_rawit_merah,magelang,Jawa Tengah,-7.475,110.218,0.10
cabai_keriting,brebes,Jawa Tengah,-6.872,109.046,0.35
cabai_keriting,wonosobo,Jawa Tengah,-7.360,109.900,0.25
cabai_keriting,batu,Jawa Timur,-7.868,112.528,0.20
cabai_keriting,garut,Jawa Barat,-7.211,107.906,0.20
bawang_merah,brebes,Jawa Tengah,-6.872,109.046,0.40
bawang_merah,magelang,Jawa Tengah,-7.475,110.218,0.25
bawang_merah,nganjuk,Jawa Timur,-7.604,111.900,0.20
bawang_merah,solok,Sumatra Barat,-0.798,100.652,0.15
bawang_putih,temanggung,Jawa Tengah,-7.308,110.162,0.30
bawang_putih,wonosobo,Jawa Tengah,-7.360,109.900,0.25
bawang_putih,tegal,Jawa Tengah,-6.869,109.127,0.25
bawang_putih,solok,Sumatra Barat,-0.798,100.652,0.20
gula_pasir,kediri,Jawa Timur,-7.816,112.011,0.35
gula_pasir,malang,Jawa Timur,-7.978,112.634,0.30
gula_pasir,lampung,Lampung,-5.450,105.267,0.35
minyak_goreng,riau,Riau,0.508,101.448,0.40
minyak_goreng,kalbar,Kalimantan Barat,-0.026,109.342,0.30
minyak_goreng,sumut,Sumatera Utara,2.116,99.545,0.30
daging_ayam,bogor,Jawa Barat,-6.597,106.806,0.35
daging_ayam,blitar,Jawa Timur,-8.097,112.163,0.35
daging_ayam,semarang,Jawa Tengah,-6.966,110.420,0.30
telur_ayam,blitar,Jawa Timur,-8.097,112.163,0.40
telur_ayam,bandung,Jawa Barat,-6.905,107.614,0.30
telur_ayam,semarang,Jawa Tengah,-6.966,110.420,0.30
daging_sapi,sumbawa,NTB,-8.488,117.395,0.35
daging_sapi,kupang,NTT,-10.179,123.607,0.30
daging_sapi,tuban,Jawa Timur,-6.899,112.049,0.35
"""


@dataclass(frozen=True)
class NewsDictionary:
    """Words that tie an article to commodities, disruptions, regions and a price direction."""

    topics: dict[str, list[str]]
    disruptions: dict[str, int]
    regions: list[str]
    bullish: list[str]
    bearish: list[str]


@dataclass(frozen=True)
class FeedDictionary:
    """Words used when a raw feed entry is accepted and scored."""

    commodities: list[str]
    supply: list[str]
    regions: list[str]


# --- Fixed values: words of the news signal ------------------------------------------------
NEWS = NewsDictionary(
    topics={
        "beras": ["beras", "padi", "gabah", "beras medium", "beras premium"],
        "cabai_rawit_merah": ["cabai rawit", "cabe rawit", "rawit merah", "cabai rawit merah"],
        "cabai_keriting": ["cabai keriting", "cabe keriting", "cabai merah keriting"],
        "bawang_merah": ["bawang merah"],
        "bawang_putih": ["bawang putih"],
        "gula_pasir": ["gula pasir", "gula", "gula kristal"],
        "minyak_goreng": ["minyak goreng", "migor", "minyak sawit"],
        "daging_ayam": ["daging ayam", "ayam broiler", "ayam ras", "ayam potong"],
        "telur_ayam": ["telur ayam", "telur", "telor"],
        "daging_sapi": ["daging sapi", "sapi", "beef"],
    },
    disruptions={
        "gagal panen": 3, "puso": 3, "kekeringan": 3, "banjir": 3, "banjir bandang": 3,
        "angin kencang": 3, "el nino": 3, "la nina": 3, "rob": 2, "hama": 2, "wereng": 2,
        "organisme pengganggu": 2, "kelangkaan": 2, "stok menipis": 2, "pasokan terganggu": 2,
        "ekspor dibatasi": 2, "impor tertunda": 2, "karantina": 2, "operasi pasar": 1,
        "bulog": 1, "bapanas": 1, "lonjakan harga": 2, "harga naik": 1, "harga melonjak": 2,
        "mahal": 1, "langka": 2,
    },
    regions=[
        "brebes", "karawang", "magelang", "cianjur", "probolinggo", "temanggung", "wonosobo",
        "nganjuk", "indramayu", "sragen", "blitar", "garut", "batu", "solok", "tegal",
    ],
    bullish=[
        "harga naik", "lonjakan", "melonjak", "mahal", "kelangkaan", "gagal panen",
        "kekeringan", "banjir", "hama", "langka",
    ],
    bearish=["harga turun", "melimpah", "surplus", "panen raya", "stok cukup", "operasi pasar berhasil"],
)

# --- Fixed values: words of the feed filter ------------------------------------------------
FEED = FeedDictionary(
    commodities=[
        "beras", "padi", "gabah", "cabai", "cabe", "rawit", "keriting",
        "bawang merah", "bawang putih", "bawang",
    ],
    supply=[
        "harga", "lonjakan", "kenaikan", "naik", "turun", "panen", "gagal panen", "produksi",
        "stok", "pasokan", "impor", "ekspor", "subsidi", "bulog", "bapanas", "pihps", "kementan",
        "el nino", "la nina", "hujan", "kekeringan", "banjir", "inflasi", "pangan",
    ],
    regions=["brebes", "karawang", "magelang", "cianjur", "probolinggo"],
)


@dataclass(frozen=True)
class RiskSettings:
    """Weights and thresholds of the risk index."""

    price_weight: float = 0.50
    weather_weight: float = 0.25
    news_weight: float = 0.25
    heavy_rain_mm: float = 50.0
    levels: dict[str, float] = field(
        default_factory=lambda: {"KRITIS": 80.0, "SIAGA": 60.0, "WASPADA": 40.0}
    )
    lowest: str = "AMAN"


@dataclass(frozen=True)
class AlertSettings:
    """Thresholds of the alert level; ``commodities`` limits alerts to a list."""

    risk_warning: float = 60.0
    risk_high: float = 70.0
    risk_critical: float = 80.0
    change_warning: float = 10.0
    change_critical: float = 20.0
    cooldown_hours: int = 12
    commodities: tuple[str, ...] | None = None


# Severity order, actions per level
SEVERITY = {"AMAN": 0, "WASPADA": 1, "SIAGA": 2, "KRITIS": 3}
ACTIONS = {
    "KRITIS": "Segera lakukan koordinasi operasi pasar dan cek stok Bulog.",
    "SIAGA": "Persiapkan cadangan distribusi dan pantau harga pasar harian.",
    "WASPADA": "Tingkatkan monitoring dan siapkan rencana intervensi.",
}

# Columns of the model inputs
FEATURES_7D = [
    "price_lag_1d", "price_lag_3d", "price_lag_7d", "price_lag_14d", "price_lag_30d",
    "price_ma_7d", "price_ma_14d", "price_ma_30d",
    "price_std_7d", "price_std_14d", "price_std_30d",
    "price_pct_7d", "price_pct_30d",
    "precip_roll7", "temp_roll7", "news_score", "news_velocity",
]
FEATURES_14D = [
    "price_lag_1d", "price_lag_3d", "price_lag_7d", "price_lag_14d", "price_lag_30d",
    "price_ma_7d", "price_ma_14d", "price_ma_30d",
    "price_std_7d", "price_std_14d", "price_std_30d",
    "price_pct_7d", "price_pct_30d",
    "day_of_week", "month", "trend_idx",
    "precip_roll7", "temp_roll7", "news_score", "news_velocity",
]
FEATURES_MAGNITUDE = [
    "price_lag_1d", "price_lag_3d", "price_lag_7d", "price_lag_14d",
    "price_ma_7d", "price_ma_14d", "price_ma_30d", "price_std_7d", "price_std_14d",
    "price_pct_7d", "price_pct_30d", "precip_roll7", "temp_roll7",
    "news_score", "news_velocity", "coeff_var_14d", "month",
]
FEATURES_TIMING = [
    "price_momentum_3d", "price_momentum_7d", "price_momentum_14d",
    "price_ma_7d", "price_ma_14d", "price_std_7d", "price_std_14d",
    "precip_roll7", "precip_anomaly", "temp_roll7", "news_score", "news_velocity",
    "month", "is_ramadan_season", "is_yearend",
]
WINDOW_LABELS = {0: "1-7 hari", 1: "8-14 hari", 2: "15-30 hari", 3: ">30 hari / tidak ada"}


def region_table(spark: SparkSession) -> DataFrame:
    """Producing regions: komoditas, nama, provinsi, lat, lon, bobot."""
    rows = [line.split(",") for line in REGIONS.strip().splitlines()]
    return spark.createDataFrame(
        [(k, n, p, float(lat), float(lon), float(w)) for k, n, p, lat, lon, w in rows],
        "komoditas string, nama string, provinsi string, lat double, lon double, bobot double",
    )


def pair_table(spark: SparkSession, pairs: dict[str, str], key: str, value: str) -> DataFrame:
    """A dictionary as a two-column table."""
    return spark.createDataFrame(list(pairs.items()), f"{key} string, {value} string")


def commodity_table(spark: SparkSession, labels: dict[str, str] = LABELS) -> DataFrame:
    """All commodities with their labels."""
    return pair_table(spark, labels, "komoditas", "label")
