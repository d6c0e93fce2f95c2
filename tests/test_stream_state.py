"""State of streams: the outlier filter's keyed memory, and the alert job's buckets."""

import os
import random
import tempfile

import pytest
from helpers import START, TICK_DDL, at, ticks_frame
from pyspark.sql import functions as F
from test_detect import SETTINGS, random_ticks

from tickloom import schemas
from tickloom.config import OutlierSettings
from tickloom.operators import clean
from tickloom.operators import state as states
from tickloom.plans import reports
from tickloom.plans.lineage import cut_lineage
from tickloom.sinks import buckets
from tickloom.sources import tables
from tickloom.streaming import alert_job, outliers

ONCE = {"availableNow": True}
BANDS = OutlierSettings(10.0, {"a": 5.0})


def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def wandering(seed, count):
    rng = random.Random(seed)
    price = {}
    rows = []
    for n in range(count):
        s = rng.choice("abcd")
        price[s] = price.get(s, 100.0) * rng.choice([0.8, 0.97, 1.02, 1.3])
        rows.append((n, s, rng.choice([price[s], price[s], price[s], 0.0, None])))
    return rows


def flagged(df):
    return sorted((r.event_time, r.symbol, r.price, r.accepted) for r in df.collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_outlier_stream_equals_one_batch(spark, seed):
    rows, place = wandering(seed, 240), folder()
    whole = ticks_frame(spark, rows)

    def start(trigger):
        stream = tables.parquet_stream(spark, f"{place}/in", schemas.TICKS)
        return outliers.start_outliers(stream, f"{place}/out", f"{place}/c", BANDS, trigger)

    query = None
    for n in range(4):
        part = whole.filter((F.col("event_time") >= at(60 * n)) & (F.col("event_time") < at(60 * n + 60)))
        part.coalesce(1).write.mode("append").parquet(f"{place}/in")
        if n < 2:
            query = query or start({"processingTime": "0 seconds"})
            query.processAllAvailable()
            if n == 1:
                query.stop()
        else:
            start(ONCE).awaitTermination()
    want = clean.outlier_flags(whole, BANDS)
    assert flagged(spark.read.parquet(f"{place}/out")) == flagged(want)
    memory = {(r.symbol, r.price) for r in outliers.accepted_prices(spark, f"{place}/c").collect()}
    assert memory == {(r.symbol, r.price) for r in clean.last_accepted(want).collect()}


def test_outlier_memory_passes_between_batch_and_stream(spark):
    rows, place = wandering(3, 200), folder()
    first, second = ticks_frame(spark, rows[:100]), ticks_frame(spark, rows).filter(F.col("event_time") >= at(100))
    before = clean.last_accepted(clean.outlier_flags(first, BANDS))
    second.write.parquet(f"{place}/in")
    stream = tables.parquet_stream(spark, f"{place}/in", schemas.TICKS)
    outliers.start_outliers(stream, f"{place}/out", f"{place}/c", BANDS, ONCE, last_accepted=before).awaitTermination()
    whole = clean.outlier_flags(ticks_frame(spark, rows), BANDS)
    assert flagged(spark.read.parquet(f"{place}/out")) == flagged(whole.filter(F.col("event_time") >= at(100)))
    after = clean.last_accepted(clean.outlier_flags(second, BANDS, last_accepted=before), before=before)
    assert {tuple(r) for r in after.collect()} == {tuple(r) for r in clean.last_accepted(whole).collect()}
    # A symbol of which nothing was accepted since keeps its price.
    none = clean.outlier_flags(ticks_frame(spark, []), BANDS)
    assert {tuple(r) for r in clean.last_accepted(none, before=before).collect()} == {tuple(r) for r in before.collect()}


def files(root):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(root) for f in names if f.startswith("part-")}


def test_untouched_buckets_keep_their_files(spark):
    root = folder()
    write = alert_job.alert_writer(root, SETTINGS, now=START, state_buckets=16)
    symbols = [f"s{k}" for k in range(40)]
    write(ticks_frame(spark, [(n, s, 100 + n) for n, s in enumerate(symbols)]), 0)
    before = files(f"{root}/state")
    write(ticks_frame(spark, [(100, "s7", 500.0)]), 1)
    after = files(f"{root}/state")
    gone = set(before) - set(after)
    assert not gone and all(after[f] == before[f] for f in before)
    new = {f.rpartition("bucket=")[2].partition("/")[0] for f in set(after) - set(before)}
    assert 1 <= len(new) <= 2  # that of the symbol, and that of the job
    state = {r.state_key: r.state_value for r in alert_job.state_before(spark, f"{root}/state", 2, count=16).collect()}
    assert state["s7__last_price"] == "500.0" and len([k for k in state if k.endswith("__last_price")]) == 40
    # A retry of a batch starts from what was before it, and versions nobody needs go.
    write(ticks_frame(spark, [(100, "s7", 700.0)]), 1)
    write(ticks_frame(spark, [(200, "s7", 900.0)]), 2)
    state = {r.state_key: r.state_value for r in alert_job.state_before(spark, f"{root}/state", 2, count=16).collect()}
    assert state["s7__last_price"] == "700.0"
    held = [part for part in buckets._parts(spark, f"{root}/state", 16) if str(part.bucket) in new]
    assert sorted({part.version for part in held}) == [1, 2]
    with pytest.raises(ValueError, match="16 buckets"):
        alert_job.state_before(spark, f"{root}/state", 2, count=8)


@pytest.mark.parametrize("rows_per_slice", [20, 2_000_000])
def test_observed_counts_equal_a_second_look(spark, rows_per_slice):
    rows = [(n * 7, s, p) for n, (_, s, p) in enumerate(random_ticks(21, 300))]
    ticks = ticks_frame(spark, rows)
    newest = None
    state = tables.empty(spark, schemas.STATE)
    # The second batch holds ticks of the first again, one without a time, and one without a price.
    odd = spark.createDataFrame([(900, "XAU/USD", 1.0, "test", None), (901, "USD/EGP", None, "test", at(3000))], TICK_DDL)
    early, none = ticks.filter("tick_id < 160"), ticks.limit(0)
    for batch in (early, ticks.filter("tick_id >= 150").unionByName(odd), none):
        result = alert_job.alert_batch(batch, state, SETTINGS, now=START, rows_per_slice=rows_per_slice)
        lower = F.lit(START if newest is None else newest) - F.make_dt_interval(hours=F.lit(1 if newest is None else 0))
        want = reports.batch_counts(batch, result.alerts, F.col("event_time") > lower)
        assert result.stats.dtypes == [(f.name, f.dataType.simpleString()) for f in alert_job.BATCH_STATS]
        got = result.stats.first()
        assert tuple(got) == tuple(want.first())
        plan = result.stats._jdf.queryExecution().optimizedPlan().toString()
        assert "LogicalRDD" not in plan and "Join" not in plan and "Union" not in plan and "Aggregate" not in plan
        newest = got.high_water or newest
        state = cut_lineage(result.state)
    assert want.first().late_ticks == 0 and result.alerts.count() == 0


def test_owner_of_keys(spark):
    keys = {
        "XAU/EGP_LOCAL__SPIKE_UP__alert_time": "XAU/EGP_LOCAL",
        "a__b__UPTREND__alert_time": "a__b",
        "a_b__last_price": "a_b",
        "x__price_history": "x",
        "GAP__leg__x": "",
        "GAP__last_alert_time": "",
        "ALERTS__last_processed": "",
    }
    rows = spark.createDataFrame([(k,) for k in keys], "k string").withColumn("o", states.owner_of(F.col("k"))).collect()
    assert {r.k: r.o for r in rows} == keys


def test_unfinished_version_is_not_seen(spark):
    path = folder()
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    buckets.write_buckets(rows, path, F.col("k"), 4, 0)
    buckets.write_buckets(rows.withColumn("v", F.col("v") * 10), path, F.col("k"), 4, 1)
    os.rename(f"{path}/buckets=4/version=1/_SUCCESS", f"{path}/buckets=4/version=1/_started")
    assert {tuple(r) for r in buckets.read_buckets(spark, path, rows.schema, 4).collect()} == {("a", 1), ("b", 2)}
    assert buckets.read_buckets(spark, folder(), rows.schema, 4).count() == 0
