import tempfile

import pytest
from helpers import START, at, ticks_frame
from pyspark.sql import functions as F
from test_detect import SETTINGS, random_ticks

from tickloom import schemas
from tickloom.config import KafkaSettings
from tickloom.operators.alerts import detect_alerts
from tickloom.operators.clean import valid_ticks
from tickloom.sinks.tables import append_parquet
from tickloom.sources import kafka, quotes, tables
from tickloom.streaming import alert_job, ingest

ONCE = {"availableNow": True}
TIE = ("symbol", "price")


def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def clear_order(rows):
    """No two ticks at one time: batches may be cut anywhere."""
    return [(n * 7 + t % 7, s, p) for n, (t, s, p) in enumerate(rows)]


def write_batches(spark, rows, count, path):
    """Silver files in event-time order, one per batch."""
    size = -(-len(rows) // count)
    for n in range(0, len(rows), size):
        part = ticks_frame(spark, rows[n : n + size]).drop("tick_id")
        part = part.withColumns({"ingestion_time": F.col("event_time"), "processed_at": F.col("event_time")})
        part.coalesce(1).write.mode("append").parquet(path)


def ids(df):
    return sorted((r.alert_id, r.message, r.created_at) for r in df.select("alert_id", "message", "created_at").collect())


@pytest.mark.parametrize("batches, stops", [(3, True)])
def test_alert_stream_equals_one_batch(spark, batches, stops):
    rows = clear_order(random_ticks(11, 400))
    path, root, check = folder(), folder(), folder()
    write_batches(spark, rows, batches, f"{path}/silver")
    stream = tables.parquet_stream(spark, f"{path}/silver", schemas.SILVER, files_per_batch=1)
    runs = 2 if stops else 1
    for _ in range(runs):
        query = alert_job.start_alerts(stream, root, check, SETTINGS, ONCE, now=START)
        if stops and _ == 0:
            query.processAllAvailable()
        query.awaitTermination()
    got = tables.parquet_rows(spark, f"{root}/alerts", schemas.ALERTS)
    want = detect_alerts(ticks_frame(spark, rows), SETTINGS, tie=TIE)
    assert ids(got) == ids(want) and got.count() > 30
    outbox = tables.parquet_rows(spark, f"{root}/outbox", schemas.OUTBOX)
    assert outbox.count() == got.count()
    stats = tables.parquet_rows(spark, f"{root}/batch_stats", alert_job.BATCH_STATS).agg(
        F.sum("ticks"), F.sum("alerts"), F.sum("late_ticks"), F.max("high_water")
    ).first()
    # The look-back keeps everything after START - 1 h, so no tick is late.
    assert tuple(stats)[:3] == (400, got.count(), 0)


def test_batches_continue_replay_and_drop_late_ticks(spark):
    rows = clear_order(random_ticks(12, 300))
    root = folder()
    write = alert_job.alert_writer(root, SETTINGS, now=START)
    first, second = ticks_frame(spark, rows[:150]), ticks_frame(spark, rows[150:])
    late = ticks_frame(spark, [(10, "XAU/USD", 9999.0)])
    write(first, 0)
    write(second.unionByName(late), 1)
    once = ids(tables.parquet_rows(spark, f"{root}/alerts", schemas.ALERTS))
    # The same batch again, as after a crash before its commit: nothing changes.
    write(second.unionByName(late), 1)
    again = ids(tables.parquet_rows(spark, f"{root}/alerts", schemas.ALERTS))
    want = ids(detect_alerts(ticks_frame(spark, rows), SETTINGS, tie=TIE))
    assert once == again == want
    stats = tables.parquet_rows(spark, f"{root}/batch_stats", alert_job.BATCH_STATS).orderBy("high_water").collect()
    assert [r.late_ticks for r in stats] == [0, 1]
    state = {r.state_key: r.state_value for r in alert_job.state_before(spark, f"{root}/state", 2).collect()}
    assert state["XAU/USD__last_price"] == repr([p for t, s, p in rows if s == "XAU/USD" and p is not None][-1])
    assert any(k.endswith("__alert_time") for k in state) and "GAP__last_alert_time" in state
    # A batch in slices gives the same as well.
    small = folder()
    cut = alert_job.alert_writer(small, SETTINGS, now=START, rows_per_slice=25)
    cut(first, 0)
    cut(second, 1)
    assert ids(tables.parquet_rows(spark, f"{small}/alerts", schemas.ALERTS)) == want


def test_first_run_looks_back_only_some_hours(spark):
    rows = [(0, "s", 10), (60, "s", 20), (7200, "s", 20), (7260, "s", 40)]
    result = alert_job.alert_batch(ticks_frame(spark, rows), tables.empty(spark, schemas.STATE), now=at(7300))
    assert [r.created_at for r in result.alerts.collect()] == [at(7260).replace(tzinfo=None)]


def wire(spark, rows):
    return quotes.to_wire(ticks_frame(spark, rows))


def test_bronze_and_silver(spark):
    place = folder()
    good = [(0, "a", 1.0), (1, "a", 2.0), (1, "a", 2.0), (1, "a", 3.0), (2, "b", 0.0), (3, "b", -1.0), (4, "b", None)]
    bad = spark.createDataFrame(
        [("no json",), ('{"symbol": "c", "price": "7", "timestamp": "2024-01-01T00:00:00+00:00"}',), ('{"symbol": "n", "price": 4.5, "timestamp": "soon"}',)],
        "value string",
    )
    wire(spark, good).unionByName(bad.select(F.col("value").cast("binary").alias("value"))).write.parquet(f"{place}/wire")
    records = spark.readStream.schema("value binary").parquet(f"{place}/wire")
    ingest.start_bronze(records, f"{place}/bronze", f"{place}/c1", trigger=ONCE, files=1).awaitTermination()
    bronze = tables.parquet_rows(spark, f"{place}/bronze", schemas.BRONZE)
    assert bronze.count() == 10 and bronze.filter("ingestion_time is not null").count() == 10
    assert bronze.filter("symbol is null and price is null").count() == 1
    assert [(r.symbol, r.price) for r in bronze.filter("symbol = 'c'").collect()] == [("c", None)]
    stream = tables.parquet_stream(spark, f"{place}/bronze", schemas.BRONZE)
    ingest.start_silver(stream, f"{place}/silver", f"{place}/c2", trigger=ONCE).awaitTermination()
    silver = tables.parquet_rows(spark, f"{place}/silver", schemas.SILVER)
    # An unknown time passes, once; price 0, negative or missing does not.
    assert sorted((r.symbol, r.price, r.event_time is None) for r in silver.collect()) == [
        ("a", 1.0, False), ("a", 2.0, False), ("a", 3.0, False), ("n", 4.5, True),
    ]
    # Its checkpoint lost, silver starts over and writes nothing twice.
    again = ingest.start_silver_again(
        stream, lambda: tables.parquet_rows(spark, f"{place}/silver", schemas.SILVER).withColumn("run", F.lit("first")),
        f"{place}/silver-2", f"{place}/c3", ONCE,
    )
    again.awaitTermination()
    assert tables.parquet_rows(spark, f"{place}/silver-2", schemas.SILVER).count() == 0


def test_watermark_drops_ticks_behind_it(spark):
    place = folder()
    batches = [
        [(0, "a", 1.0), (1000, "a", 2.0)],
        [(1001, "a", 3.0)],
        # 1000 s - 5 min = 700 s: later than that stays, earlier is late; copies never count.
        [(701, "a", 4.0), (699, "a", 5.0), (1000, "a", 2.0), (1002, "a", 6.0)],
    ]
    for n, rows in enumerate(batches):
        ticks = ticks_frame(spark, rows).drop("tick_id").withColumn("ingestion_time", F.col("event_time"))
        ticks.coalesce(1).write.parquet(f"{place}/bronze/part={n}")
    stream = tables.parquet_stream(spark, f"{place}/bronze", schemas.BRONZE, files_per_batch=1)
    ingest.start_silver(stream, f"{place}/silver", f"{place}/c", trigger=ONCE).awaitTermination()
    got = tables.parquet_rows(spark, f"{place}/silver", schemas.SILVER).collect()
    assert sorted(r.price for r in got) == [1.0, 2.0, 3.0, 4.0, 6.0]


def test_recovery_takes_a_fresh_checkpoint(spark):
    seen = []

    class Ended:
        isActive = False

        def __init__(self, error):
            self.error = error

        def awaitTermination(self):
            if self.error:
                raise RuntimeError(self.error)

    def start(errors):
        def begin(place):
            seen.append(place)
            return Ended(errors[len(seen) - 1])

        return begin

    expired = "snapshot was expired or removed"
    assert ingest.run_with_recovery(start([expired, None]), "/c", ingest.snapshot_expired) == 2
    assert seen == ["/c", "/c-attempt-2"]
    seen.clear()
    with pytest.raises(RuntimeError):
        ingest.run_with_recovery(start([expired] * 3), "/c", ingest.snapshot_expired)
    assert len(seen) == 3
    seen.clear()
    with pytest.raises(RuntimeError):
        ingest.run_with_recovery(start(["other"]), "/c", ingest.snapshot_expired)
    assert len(seen) == 1


def test_connector_options():
    settings = KafkaSettings("host:1", "topic")
    source = kafka.kafka_source_options(settings)
    assert source["subscribe"] == "topic" and source["startingOffsets"] == "latest"
    assert source["kafka.bootstrap.servers"] == "host:1" and source["failOnDataLoss"] == "false"
    assert kafka.kafka_sink_options(settings)["topic"] == "topic"
    assert set(tables.ICEBERG_STREAM_OPTIONS.values()) == {"true"}


def test_append_by_day_prunes(spark):
    place = folder()
    append_parquet(ticks_frame(spark, [(0, "a", 1.0), (90000, "a", 2.0)]), f"{place}/t", "event_time")
    append_parquet(ticks_frame(spark, [(180000, "a", 3.0)]), f"{place}/t", "event_time")
    rows = tables.parquet_rows(spark, f"{place}/t", schemas.TICKS)
    late = tables.time_range(rows, "event_time", F.lit(at(90000)).cast("timestamp"))
    assert sorted(r.price for r in late.collect()) == [2.0, 3.0]
    plan = late._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert valid_ticks(late).count() == 2
