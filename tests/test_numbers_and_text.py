import math
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tanisight.dims import FEED, NEWS
from tanisight.functions import numeric, temporal, text
from tests.conftest import plan_of, rows


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("value,digits", [(0.125, 2), (2.675, 2), (18966.225, 2), (-1.25, 1), (2.0, 0), (1e9 + 0.005, 2)])
def test_rnd_is_half_up_by_formula(spark, value, digits):
    expected = math.floor(value * 10.0**digits + 0.5) / 10.0**digits
    assert one(spark, numeric.rnd(F.lit(value), digits)) == expected
    assert one(spark, numeric.rnd(F.lit(0.125), 2)) == 0.13


def test_clamp_keeps_null(spark):
    assert one(spark, numeric.clamp(F.lit(None).cast("double"), 0, 100)) is None
    assert one(spark, numeric.clamp(F.lit(-3.0), 0, 100)) == 0.0
    assert one(spark, numeric.clamp(F.lit(130.0), 0, 100)) == 100.0


def test_safe_double(spark):
    df = spark.createDataFrame([("12.5",), ("n/a",), ("NaN",), (None,)], "v string")
    assert [r[0] for r in df.select(numeric.safe_double("v")).collect()] == [12.5, None, None, None]


def test_pct_change_of_zero_is_null(spark):
    assert one(spark, numeric.pct_change(F.lit(5.0), F.lit(0.0))) is None


def test_frames_match_pandas_and_flat_series_have_no_spread(spark):
    import random
    rng = random.Random(7)
    prices = [round(rng.uniform(5000, 90000), 2) for _ in range(60)] + [12345.67] * 40
    pdf = pd.DataFrame({"komoditas": "a", "date_parsed": range(100), "p": prices})
    df = spark.createDataFrame(pdf)
    for n in (7, 14, 30):
        w = numeric.frame("komoditas", "date_parsed", n)
        got = df.select("date_parsed", numeric.frame_mean("p", w, n).alias("m"), numeric.frame_std("p", w, n).alias("s"))
        got = got.orderBy("date_parsed").toPandas()
        pd.testing.assert_series_equal(got["m"], pdf["p"].rolling(n).mean(), check_names=False, rtol=1e-9)
        pd.testing.assert_series_equal(got["s"], pdf["p"].rolling(n).std(), check_names=False, rtol=1e-6, atol=1e-5)
    assert got["s"].iloc[-1] == 0.0


def test_iso_date(spark):
    values = ["2026-06-20", "2026-06-20T10:00:00+00:00", "2026-06-20T10:00:00.123Z", "2026-06-20T03:00:00+07:00", "20260620",
              "20260620T101500Z", "12:30:15", "T07:00", "20261320", "x", "", None]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [str(r[0]) for r in df.select(temporal.iso_date("v")).collect()]
    assert got == ["2026-06-20"] * 6 + ["None"] * 6


def test_white_space_set_matches_python(spark):
    space = [chr(c) for c in range(0x3100) if re.fullmatch(r"\s", chr(c))]
    assert set(text.SPACE_CHARS) == set(space)
    samples = [f"a{c}b{c}{c} c " for c in space] + [f"{c}x{c}" for c in space] + ["a  b", " a b ", "a b"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(samples)], "i int, s string").orderBy("i")
    got = df.select(text.clean_text(F.col("s")), text.strip_tags(F.col("s"))).collect()
    assert [g[0] for g in got] == [re.sub(r"\s+", " ", s.lower()).strip() for s in samples]
    assert [g[1] for g in got] == [s.strip() for s in samples]


def test_strip_html(spark):
    html = "<p>Harga <b>Beras</b>\n\n naik</p>"
    assert one(spark, text.clean_text(F.lit(html))) == "harga beras naik"
    assert one(spark, text.strip_tags(F.lit("<p> Harga<br/>naik </p>"))) == "Harganaik"
    assert one(spark, text.clean_text(F.lit(None).cast("string"))) == ""


def test_article_id(spark):
    assert one(spark, text.article_id(F.lit("abc"))) == "a9993e364706816a"
    assert one(spark, text.article_id(F.lit(""))) is None


def test_matches_are_plain_substrings_unless_whole_words(spark):
    assert one(spark, text.matched_words(F.lit("masa kebatuan rob"), ["batu", "rob"])) == ["batu", "rob"]
    assert one(spark, text.matched_words(F.lit("masa kebatuan rob"), ["batu", "rob"], whole_words=True)) == ["rob"]


def test_weights_and_topics(spark):
    t = F.lit("banjir bandang merendam sawah padi")
    assert one(spark, text.matched_weights(t, NEWS.disruptions)) == {"banjir": 3, "banjir bandang": 3}
    assert one(spark, text.matched_topics(t, NEWS.topics)) == ["beras"]
    assert one(spark, text.matched_words(F.lit("cabai rawit naik"), FEED.commodities)) == ["cabai", "rawit"]


def test_pinned_text_is_computed_once(spark):
    df = spark.createDataFrame([("<b>A</b> que",)], "t string")
    pinned = text.pin(df, "c", text.clean_text(F.col("t")))
    found = pinned.filter(text.any_word(F.col("c"), ["que", "retion", "onhe"])).filter(F.contains("c", F.lit("a")))
    assert rows(found, "c") == [("a que",)]
    assert plan_of(found).count("regexp_replace") == 2


def test_formats(spark):
    assert one(spark, text.rupiah(F.lit(12500.0))) == "Rp12,500"
    assert one(spark, text.signed_one(F.lit(3.5))) == "+3.5"
    assert one(spark, text.title_label(F.lit("price_lag_7d"))) == "Price Lag 7d"
    assert not math.isnan(one(spark, numeric.ratio(F.lit(1.0), F.lit(3.0), 2)))
    assert one(spark, numeric.ratio(F.lit(1.0), F.lit(0.0), 2)) == 0.0
