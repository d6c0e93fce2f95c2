"""What the plans must look like to hold at scale."""

import re

import pytest
from helpers import ticks_frame
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tickloom.config import SignalSettings
from tickloom.operators import detect, health
from tickloom.plans import reports

FOLDER = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["tick_signals", "signal_alerts", "leg_prices", "gap_alerts", "supplier_signals", "outlier_flags"])
def test_one_shuffle(spark, name):
    plan = plan_of(entry.queries()[name](spark, FOLDER))
    assert len(re.findall(r"Exchange (hash|range|round|single)", plan, re.IGNORECASE)) == 1
    # One sequence of legs, checked to fit a task, is one partition; nothing else is.
    assert "SinglePartition" not in plan or name in ("leg_prices", "gap_alerts")


def test_queries_never_pair_rows_freely(spark):
    for name, build in entry.queries().items():
        if not name.endswith("_stream") and name not in entry.LLM_QUERIES:
            plan = plan_of(build(spark, FOLDER))
            assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name


def test_scans_read_only_what_they_need(spark):
    plan = plan_of(entry.queries()["supplier_latest_prices"](spark, FOLDER))
    assert "l_tax" not in plan and "l_discount" not in plan
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = plan_of(entry.queries()["price_history"](spark, FOLDER))
    assert re.search(r"PushedFilters: \[.*EqualTo\(event_type,click\)", plan) and "TakeOrderedAndProject" in plan


def test_top_of_each_key_is_cut_before_the_shuffle(spark):
    ticks = ticks_frame(spark, [(i, "s", i + 1) for i in range(9)])
    assert "WindowGroupLimit" in plan_of(detect.last_prices(detect.ordered_ticks(ticks), 5))
    assert "partial_max_by" in plan_of(reports.latest_prices(ticks))
    assert "partial_max" in plan_of(health.last_ticks(ticks))


@pytest.mark.parametrize("partitions", [1, 4, 64])
def test_results_do_not_depend_on_partitions(spark, partitions):
    ticks = ticks_frame(spark, [(i * 3, "ab"[i % 2], 100 + (i * i * 37) % 11) for i in range(200)])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        for rows_per_slice in (10**6, 20):
            fired = detect.signal_alerts(ticks.repartition(partitions), SignalSettings(1.0, 3, 30), rows_per_slice=rows_per_slice)
            row = fired.agg(F.count(F.lit(1)), F.sum(F.xxhash64("tick_id", "alert_type", "message") % 1000)).first()
            want = test_results_do_not_depend_on_partitions.__dict__.setdefault("first", tuple(row))
            assert tuple(row) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
