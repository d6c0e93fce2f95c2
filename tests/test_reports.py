import random

import duckdb
import pytest
from helpers import at, ticks_frame
from pyspark.sql import functions as F

from tickloom import schemas
from tickloom.config import Settings, settings_from_env
from tickloom.functions.text import number_list_text, number_text
from tickloom.plans import reports
from tickloom.operators.alerts import no_alerts
from tickloom.sources.tables import empty

NOW = at(86400)


def alert_frame(spark, rows):
    """rows: (seconds, type, amount)"""
    return spark.createDataFrame(
        [(f"id{i:03d}", "s", kind, "LOW", "m", 1.0, None, amount, at(t), {"expected_local": "1.0"}) for i, (t, kind, amount) in enumerate(rows)],
        schemas.ALERTS,
    )


def test_reports_on_empty_tables(spark):
    alerts, silver = no_alerts(spark), empty(spark, schemas.SILVER)
    assert reports.recent_alerts(alerts, NOW).count() == 0
    assert reports.alert_counts_by_type(alerts, NOW).count() == 0
    assert reports.alerts_timeseries(alerts, NOW).count() == 0
    assert reports.gap_history(alerts, NOW).count() == 0
    assert reports.price_history(silver, "a", NOW).count() == 0
    assert reports.latest_prices(silver).count() == 0 and reports.latest_prices(silver, "a").count() == 0
    assert reports.feed_ages(silver, NOW).count() == 0
    assert reports.recent_alert_count(alerts, NOW).first()["count"] == 0
    assert tuple(reports.batch_counts(silver, alerts).first()) == (0, 0, None, 0)


@pytest.mark.parametrize(
    "call",
    [
        lambda a, s: reports.recent_alerts(a, NOW, hours=0),
        lambda a, s: reports.recent_alerts(a, NOW, hours=721),
        lambda a, s: reports.recent_alerts(a, NOW, limit=5001),
        lambda a, s: reports.alert_counts_by_type(a, NOW, hours=0),
        lambda a, s: reports.alerts_timeseries(a, NOW, bucket_minutes=1441),
        lambda a, s: reports.gap_history(a, NOW, limit=0),
        lambda a, s: reports.price_history(s, "a", NOW, limit=20001),
    ],
)
def test_arguments_are_checked(spark, call):
    with pytest.raises(ValueError):
        call(no_alerts(spark), empty(spark, schemas.SILVER))


def test_windows_of_time_are_inclusive(spark):
    alerts = alert_frame(spark, [(-1, "GOLD_GAP", 80.0), (0, "GOLD_GAP", 90.0), (86400, "SPIKE_UP", None)])
    assert [r.alert_id for r in reports.recent_alerts(alerts, NOW, hours=24).collect()] == ["id002", "id001"]
    assert [r.gap_egp for r in reports.gap_history(alerts, NOW, hours=24).collect()] == [90.0]
    row = reports.gap_history(alerts, NOW, hours=48).first()
    assert (row.gap_egp, row.expected, row.actual) == (80.0, "1.0", None)
    assert reports.recent_alert_count(alerts, NOW, minutes=1440).first()["count"] == 2
    silver = ticks_frame(spark, [(0, "a", 1), (10, "a", 2), (20, "a", 3), (30, "b", 4)])
    # In time order and then limited: the oldest rows of the range.
    assert [r.price for r in reports.price_history(silver, "a", NOW, limit=2).collect()] == [1.0, 2.0]
    assert {r.symbol: r.price for r in reports.latest_prices(silver).collect()} == {"a": 3.0, "b": 4.0}
    assert [r.price for r in reports.latest_prices(silver, "a").collect()] == [3.0]
    assert reports.latest_prices(silver, "none").count() == 0


@pytest.mark.parametrize("minutes", [1, 7, 30, 50, 1440])
def test_buckets(spark, minutes):
    rng = random.Random(minutes)
    rows = [(rng.randrange(0, 86400), rng.choice(["SPIKE_UP", "UPTREND"]), None) for _ in range(200)]
    got = reports.alerts_timeseries(alert_frame(spark, rows), NOW, bucket_minutes=minutes).collect()
    con = duckdb.connect()
    con.execute("CREATE TABLE a (t TIMESTAMP, k VARCHAR)")
    con.executemany("INSERT INTO a VALUES (?, ?)", [(at(t).replace(tzinfo=None), k) for t, k, _ in rows])
    want = con.execute(
        f"SELECT time_bucket(INTERVAL '{minutes} minutes', t), k, count(*) FROM a GROUP BY 1, 2 ORDER BY 1, 2"
    ).fetchall()
    assert [(r.time, r.alert_type, r["count"]) for r in got] == want


def test_numbers_as_text(spark):
    rng = random.Random(5)
    values = [0.0, 1.0, 0.1, 4400.0, 0.613, 1e7, 12345678.9, 123456789012345.6, 1e15, 1e16, 2.5e17, 0.001, 0.00012, 1e-5, 2.5e-7, -3.25, -1e8, float("inf"), 1e100]
    values += [round(rng.uniform(0, 10**rng.randint(0, 9)), 2) for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r.t for r in df.select(number_text("x").alias("t")).collect()]
    assert got == [str(v) for v in values]
    assert spark.range(1).select(F.array(F.lit(1.0), F.lit(2.5)).alias("xs")).select(number_list_text("xs")).first()[0] == "[1.0, 2.5]"


def test_settings_from_the_environment():
    got = settings_from_env({"SPIKE_THRESHOLD": "0.7", "TREND_COUNT": "4", "HEALTH_MAX_SILENCE_LOCAL": "120", "KAFKA_TOPIC": "t"})
    assert got.signals.spike_threshold_pct == 0.7 and got.signals.trend_count == 4
    assert got.health.max_silence_seconds["XAU/EGP_LOCAL"] == 120 and got.kafka.topic == "t"
    assert settings_from_env({}) == Settings()
