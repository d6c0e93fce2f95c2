from datetime import datetime, timezone

import pytest
from helpers import START, at, ticks_frame
from pyspark.sql import functions as F

from tickloom import schemas
from tickloom.config import HealthSettings, Settings
from tickloom.operators import health
from tickloom.plans.health_cycle import health_cycle
from tickloom.plans.lineage import cut_lineage
from tickloom.sources.tables import empty

FEEDS = HealthSettings(max_silence_seconds={"a": 600, "b": 300, "c": 60})


def statuses(df):
    return {r.name: r.status for r in df.collect()}


@pytest.mark.parametrize(
    "age, want",
    [(299.9, "OK"), (300, "WARN"), (599.9, "WARN"), (600, "DEAD"), (0, "OK")],
)
def test_feed_limits(spark, age, want):
    feeds = health.expected_feeds(spark, HealthSettings(max_silence_seconds={"a": 600}))
    last = spark.createDataFrame([("a", START)], "symbol string, last_seen timestamp")
    row = health.feed_checks(feeds, last, at(age)).first()
    assert (row.name, row.status, row.value) == ("feed:a", want, float(age))
    whole = int(age)
    assert row.message == {
        "OK": f"a — OK ({whole}s ago)",
        "WARN": f"a — last tick {whole}s ago (warn>300s)",
        "DEAD": f"a — no data for {whole}s (max=600s)",
    }[want]


@pytest.mark.parametrize(
    "lag, status, message",
    [
        (149.9, "OK", "Bronze→Silver lag = 149s ✓"),
        (150.0, "WARN", "Bronze→Silver lag = 150s (warn>150s)"),
        (299.0, "WARN", "Bronze→Silver lag = 299s (warn>150s)"),
        (300.0, "DEAD", "Bronze→Silver lag = 300s (max=300s)"),
        (None, "WARN", "Could not compute Bronze→Silver lag (missing data?)"),
        (-0.5, "OK", "Bronze→Silver lag = 0s ✓"),
    ],
)
def test_lag_limits(spark, lag, status, message):
    row = health.lag_check(spark.createDataFrame([(lag,)], "lag_seconds double")).first()
    assert (row.name, row.status, row.message, row.value) == ("pipeline:lag", status, message, lag)


def test_missing_feed_empty_tables_and_extra_symbols(spark):
    none = empty(spark, schemas.SILVER)
    report = health.health_report(none, none, START, FEEDS)
    assert statuses(report) == {"feed:a": "DEAD", "feed:b": "DEAD", "feed:c": "DEAD", "pipeline:lag": "WARN"}
    assert report.filter("name = 'feed:a'").first().message == "a — never received any data"
    ticks = ticks_frame(spark, [(0, "a", 1), (0, "other", 1)])
    assert statuses(health.health_report(ticks, ticks, at(1), FEEDS))["feed:a"] == "OK"
    assert {r.layer: r.row_count for r in health.row_counts({"bronze": ticks, "silver": none, "gold": None}).collect()} == {
        "bronze": 2, "silver": 0, "gold": 0,
    }


def checks(spark, *pairs):
    rows = [(i, n, s, "m", None) for i, (n, s) in enumerate(pairs)]
    return spark.createDataFrame(rows, "position int, name string, status string, message string, value double")


@pytest.mark.parametrize(
    "pairs, want",
    [
        ([], (True, False, "OK")),
        ([("a", "OK")], (True, False, "OK")),
        ([("a", "OK"), ("b", "WARN")], (False, False, "WARN")),
        ([("a", "WARN"), ("b", "DEAD")], (False, True, "DEAD")),
    ],
)
def test_summary(spark, pairs, want):
    assert tuple(health.report_summary(checks(spark, *pairs)).first()) == want


@pytest.mark.parametrize(
    "before, now, want",
    [
        ("OK", "WARN", [("x", "newly_bad")]),
        ("WARN", "DEAD", []),
        ("DEAD", "OK", [("x", "recovered")]),
        (None, "DEAD", [("x", "newly_bad")]),
        (None, "OK", []),
    ],
)
def test_changes(spark, before, now, want):
    previous = checks(spark, *([("x", before)] if before else []))
    got = health.status_changes(checks(spark, ("x", now)), previous)
    assert [tuple(r) for r in got.collect()] == want
    assert health.should_notify(checks(spark, ("x", now)), previous).first().notify == bool(want)


@pytest.mark.parametrize("rows_per_slice", [1000, 3])
def test_changes_over_a_log(spark, rows_per_slice):
    states = ["OK", "WARN", "DEAD", "OK", "OK", "DEAD", "WARN", "OK"] * 5
    log = spark.createDataFrame([(at(i), "x", s) for i, s in enumerate(states)], "report_time timestamp, name string, status string")
    got = health.status_history_changes(log, rows_per_slice).orderBy("report_time").collect()
    want, bad = [], False
    for i, s in enumerate(states):
        if (s != "OK") != bad:
            bad = not bad
            want.append((at(i).replace(tzinfo=None), "newly_bad" if bad else "recovered"))
    assert [(r.report_time, r.change) for r in got] == want


def utc(*parts):
    return datetime(*parts, tzinfo=timezone.utc)


def test_heartbeats_in_winter_and_summer(spark):
    times = [
        utc(2024, 1, 5, 6, 59, 59), utc(2024, 1, 5, 7, 0, 0), utc(2024, 1, 5, 7, 59, 59), utc(2024, 1, 5, 8, 0, 0),
        utc(2024, 7, 5, 5, 59, 59), utc(2024, 7, 5, 6, 30, 0), utc(2024, 7, 5, 7, 0, 0),
    ]
    log = spark.createDataFrame([(t,) for t in times], "report_time timestamp")
    got = health.heartbeats(log).orderBy("local_date").collect()
    assert [(str(r.local_date), r.sent_at) for r in got] == [
        ("2024-01-05", datetime(2024, 1, 5, 7)), ("2024-07-05", datetime(2024, 7, 5, 6, 30)),
    ]
    assert got[1].text.endswith("🕐 `2024-07-05 09:30:00 (Cairo)`")
    sent = spark.createDataFrame([(got[0].local_date,)], "local_date date")
    assert health.heartbeats(log, sent=sent).count() == 1


def test_cycle(spark):
    ticks = ticks_frame(spark, [(0, "a", 1), (100, "b", 1)])
    settings = Settings(health=FEEDS)
    first = health_cycle(ticks, ticks, None, now=at(130), settings=settings)
    assert statuses(first.checks) == {"feed:a": "OK", "feed:b": "OK", "feed:c": "DEAD", "pipeline:lag": "OK"}
    assert first.summary.first().worst_status == "DEAD"
    text = first.message.first().text.split("\n")
    assert text[0] == "🔴 *Pipeline Health* — `2024-01-01 02:02:10 (Cairo)`" and text[1] == ""
    assert text[2] == "✅ *a*: a — OK (130s ago)" and text[5] == "✅ *lag*: Bronze→Silver lag = 0s ✓"
    lines = [r.text for r in first.log_lines.orderBy("line").collect()]
    assert lines[0] == "[2024-01-01 02:02:10] STATUS=DEAD" and len(lines) == 5
    assert first.heartbeat.count() == 0
    # Nothing changed since: no message.
    again = health_cycle(ticks, ticks, None, cut_lineage(first.checks), at(140), settings)
    assert again.message.count() == 0 and again.changes.count() == 0
    assert {r.layer: r.row_count for r in first.row_counts.collect()} == {"bronze": 2, "silver": 2, "gold": 0}
    assert health.layer_lag(ticks, ticks.filter(F.col("symbol") == "a")).first().lag_seconds == 100.0


def test_rounds_are_stored_and_compared(spark, tmp_path):
    """OK, bad, still bad, recovered: a message for each change, one heartbeat a day, every line logged."""
    from tickloom.plans import health_job

    root = str(tmp_path)
    rows = [(0, "a", 1.0), (600_000, "a", 1.0)]
    settings = Settings(health=HealthSettings(max_silence_seconds={"a": 600}, heartbeat_hour=at(0).hour), display_zone="UTC")
    ages = [60, 2_000, 3_000, 600_030]
    for number, age in enumerate(ages):
        ticks = ticks_frame(spark, [r for r in rows if r[0] <= age])
        for _ in range(2 if number == 1 else 1):  # a round may be run again
            health_job.health_round(ticks, ticks, root, number, at(age), settings)
    status = {r["round"]: r.status for r in health_job.reports(spark, root).filter("name = 'feed:a'").collect()}
    assert status[0] == "OK" and status[1] != "OK" and status[2] != "OK" and status[3] == "OK"
    assert sorted(r["round"] for r in health_job.messages(spark, root).collect()) == [1, 3]
    log = health_job.log_lines(spark, root)
    assert {r["round"]: r.n for r in log.groupBy("round").agg(F.count("*").alias("n")).collect()} == dict.fromkeys(range(4), 3)
    dates = [r.local_date for r in health_job.heartbeats_sent(spark, root).collect()]
    assert len(dates) == len(set(dates)) >= 1
