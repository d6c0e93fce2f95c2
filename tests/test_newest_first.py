"""Reports that read little: the newest days first, counts out of footers."""

import tempfile

import pytest
from helpers import at, ticks_frame

from tickloom import schemas
from tickloom.operators import health
from tickloom.sinks.tables import append_parquet
from tickloom.sources import tables
from tickloom.streaming import ingest

DAY = 86_400


@pytest.fixture(scope="module")
def by_day(spark):
    path = tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/silver"
    rows = [(DAY * d + 5, "a", 1.0) for d in range(12)] + [(DAY * 4, "b", 2.0), (DAY * 4 + 9, "b", 2.0), (30, "c", 3.0)]
    append_parquet(ticks_frame(spark, rows), path, "event_time")
    return tables.parquet_rows(spark, path, schemas.TICKS)


def days_looked_at(monkeypatch):
    seen = []
    of_days = health.of_days

    def watched(rows, time, first, last):
        found = of_days(rows, time, first, last)
        # The files of the plan, after pruning.
        days = {r[0] for r in found.select("event_date").distinct().collect()}
        assert "PartitionFilters: [isnotnull(event_date" in found._jdf.queryExecution().executedPlan().toString()
        seen.append(sorted(d.day for d in days))
        return found

    monkeypatch.setattr(health, "of_days", watched)
    return seen


def test_newest_days_first(spark, by_day, monkeypatch):
    seen = days_looked_at(monkeypatch)
    got = health.newest_first(by_day, ["a"])
    assert [tuple(r) for r in got.collect()] == [("a", at(DAY * 11 + 5).replace(tzinfo=None))]
    assert seen == [[12]]
    seen.clear()
    got = {r.symbol: r.last_seen for r in health.newest_first(by_day, ["a", "b", "never"]).collect()}
    want = {r.symbol: r.last_seen for r in health.last_ticks(by_day).collect()}
    assert got == {s: want[s] for s in "ab"}
    assert seen == [[12], [10, 11], [6, 7, 8, 9], [1, 2, 3, 4, 5]]


def test_lag_reads_the_newest_day(spark, by_day, monkeypatch):
    seen = days_looked_at(monkeypatch)
    behind = by_day.filter("symbol <> 'a'")
    assert health.layer_lag(by_day, by_day).first()[0] == 0
    assert seen == [[12], [12]]
    # A filtered table may have nothing on its newest day.
    assert health.layer_lag(by_day, behind).first()[0] == DAY * 7 - 4


def test_report_is_the_same_by_day(spark, by_day):
    plain = by_day.drop("event_date")
    now = at(DAY * 12)
    settings = health.HealthSettings(max_silence_seconds={"a": 10**6, "b": 600, "never": 5})
    assert health.health_report(by_day, by_day, now, settings).collect() == health.health_report(plain, plain, now, settings).collect()


def test_counts_come_from_footers(spark, by_day):
    path = tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/t"
    ticks_frame(spark, [(i, "a", 1.0) for i in range(50)]).repartition(3).write.parquet(path)
    counts = health.table_row_counts(spark, {"bronze": path, "gold": None})
    assert {tuple(r) for r in counts.collect()} == {("bronze", 50), ("gold", 0)}
    assert "PushedAggregation: [COUNT(*)]" in counts._jdf.queryExecution().executedPlan().toString()
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""


def test_missing_source_files_are_told_from_other_failures():
    assert ingest.source_files_gone(RuntimeError("[FAILED_READ_FILE.FILE_NOT_EXIST] ..."))
    assert not ingest.source_files_gone(RuntimeError("out of memory"))
