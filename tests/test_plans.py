"""What the plans must look like to hold at scale."""

import re

import pytest

from tanisight.plans import layers, standins
from tanisight.plans.registry import cleaning, features, gold, news, risk
from tests.conftest import plan_of

LAZY = {n: q for m in (cleaning, gold, features, news, risk) for n, q in m.QUERIES.items()}


@pytest.fixture(scope="module")
def plans(spark, sf):
    return {n: plan_of(q(spark, sf)) for n, q in LAZY.items()}


def test_no_cross_joins(plans):
    bad = [n for n, p in plans.items() if "CartesianProduct" in p or "BroadcastNestedLoopJoin" in p]
    assert bad == []


def test_no_python_outside_the_cooldown(plans):
    bad = [n for n, p in plans.items() if re.search(r"Python|Pandas|InPandas", p)]
    assert sorted(bad) == ["alert_cooldown", "alert_summary", "alert_suppressed"]


def test_ranked_groups_are_pruned_before_the_shuffle(plans):
    for name in ("daily_prices", "dedup_keep_last", "dedup_news", "latest_per_region", "history_30",
                 "price_signal", "top_phrases", "bronze_merge"):
        assert re.search(r"WindowGroupLimit .*Partial", plans[name]), name


def test_scans_read_only_what_is_needed(plans):
    scan = next(x for x in plans["daily_prices"].splitlines() if "FileScan parquet" in x and "lineitem" in x)
    columns = set(re.findall(r"(l_\w+)#", scan.split("]")[0]))
    assert columns == {"l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"}
    assert "IsNotNull(l_shipdate)" in scan
    kurs = next(x for x in plans["dedup_kurs"].splitlines() if "FileScan" in x)
    assert set(re.findall(r"(o_\w+)#", kurs.split("]")[0])) == {"o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"}


def test_top_n_does_not_sort_everything(plans):
    assert "TakeOrderedAndProject" in plans["last_n_rows"]
    assert "TakeOrderedAndProject" in plans["recent_signals"]


def test_the_feature_store_scans_prices_once(spark, sf):
    text = plan_of(layers.feature_store(spark, sf))
    assert "lineitem" not in text and text.count("Scan ExistingRDD") == 2


def test_windows_of_one_series_share_a_sort(spark, sf):
    text = plan_of(features.QUERIES["feat_rolling"](spark, sf))
    by_series = [x for x in text.splitlines() if re.search(r"Sort \[komoditas#\d+ ASC NULLS FIRST, date_parsed", x)]
    assert len(by_series) == 1


def test_recent_news_filter_reaches_below_the_text_work(spark, sf):
    text = plan_of(layers.velocity(spark, sf))
    work = text.index("Generate explode(array(concat_ws")
    assert "date_add(1998-01-01" in text[work:].split("FileScan")[0]
    assert standins.TYPES
