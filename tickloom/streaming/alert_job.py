"""Incremental alerting: silver rows in, alerts and the detectors' state out, batch by batch.

Every micro-batch runs the batch detectors, seeded with the state the batches before it left. All
that a batch writes is keyed by its id and replaces what an earlier try of the same batch wrote, so
a restart neither loses nor doubles alerts. The state lies in buckets by symbol: a batch reads and
rewrites those of its own symbols. What a batch had is observed while its rows pass: the counts take
no look of their own at ticks or alerts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tickloom import schemas
from tickloom.config import Settings
from tickloom.operators import state as states
from tickloom.operators.alerts import gap_alert_rows, signal_alert_rows
from tickloom.operators.detect import fired_signals, last_prices, ordered_ticks, usable, worded
from tickloom.operators.gap import fired_gaps, last_legs, leg_ticks
from tickloom.operators.slices import ROWS_PER_SLICE
from tickloom.plans.lineage import cut_lineage
from tickloom.sinks.buckets import BUCKET, bucket_of, read_buckets, write_buckets
from tickloom.sinks.messages import outbox_rows
from tickloom.sinks.tables import replace_part, upsert
from tickloom.sources.tables import time_range

# A bucket holds the state of a few thousand of a million symbols.
STATE_BUCKETS = 256

BATCH_STATS = T.StructType(
    [
        T.StructField("ticks", T.LongType()),
        T.StructField("alerts", T.LongType()),
        T.StructField("high_water", T.TimestampType()),
        T.StructField("late_ticks", T.LongType()),
    ]
)


@dataclass(frozen=True)
class BatchResult:
    alerts: DataFrame
    state: DataFrame
    stats: DataFrame


def observed_ticks(ticks: DataFrame, fresh: Column) -> dict[str, int | None]:
    """Fresh and late ticks and the newest fresh time (microseconds) of a batch, from one pass over it.

    Observed in the tasks that end the pass, which count once however often a lost one runs again; a
    pass over a persisted batch is also the one that fills the cache.
    """
    new = F.coalesce(fresh, F.lit(False))
    seen = Observation()
    watched = ticks.observe(
        seen,
        F.count_if(new).alias("ticks"),
        F.count_if(~new).alias("late_ticks"),
        F.unix_micros(F.max(F.when(new, F.col("event_time")))).alias("high_water"),
    )
    watched.write.format("noop").mode("overwrite").save()
    return seen.get


def stats_row(spark: SparkSession, ticks: dict[str, int | None], alerts: dict[str, int | None]) -> DataFrame:
    """What was observed of a batch, as the one row that :func:`reports.batch_counts` would give."""
    # Nothing is observed of a plan that Spark finds empty.
    return spark.range(1).select(
        F.lit(ticks.get("ticks") or 0).cast("long").alias("ticks"),
        F.lit(alerts.get("alerts") or 0).cast("long").alias("alerts"),
        F.timestamp_micros(F.lit(ticks.get("high_water")).cast("long")).alias("high_water"),
        F.lit(ticks.get("late_ticks") or 0).cast("long").alias("late_ticks"),
    )


def alert_batch(
    ticks: DataFrame,
    state: DataFrame,
    settings: Settings = Settings(),
    clock: str = "event_time",
    tie: tuple[str, ...] = ("symbol", "price"),
    now=None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> BatchResult:
    """Alerts, next state and counts of one batch, given the state before it.

    Ticks at or before the newest time already processed are late and left out for good, but
    counted. On a fresh start only the last hours before ``now`` are looked at.
    """
    # The state of the detectors' position is one row: it reaches the driver as a literal, which
    # also lets the scan skip older days.
    seen = states.processed_until(state).first()
    if seen is not None:
        lower = F.lit(seen[0]).cast("timestamp")
    else:
        lower = (F.current_timestamp() if now is None else F.lit(now).cast("timestamp")) - F.make_dt_interval(
            hours=F.lit(settings.alert_job.lookback_hours)
        )
    fresh = time_range(ticks, "event_time", lower, strict=True)
    had = observed_ticks(ticks, F.col("event_time") > lower)

    history = states.history_or_last_price(state)
    seeds = states.last_alert_state(state, settings.gap)

    sliced = ordered_ticks(fresh, clock, tie, history, rows_per_slice)
    fired = worded(fired_signals(sliced, settings.signals, clock, seeds), settings.signals)
    legs = leg_ticks(fresh, settings.gap, clock, tie, states.leg_state(state), rows_per_slice)
    gaps = fired_gaps(legs, settings.gap, clock, seeds)

    # Alerts feed the table, the outbox and the state: computed once, and counted while they are stored.
    raised = Observation()
    alerts = cut_lineage(
        signal_alert_rows(fired, clock, tie, settings.severity)
        .unionByName(gap_alert_rows(gaps, clock, tie, settings.severity))
        .observe(raised, F.count(F.lit(1)).alias("alerts"))
    )
    counts = stats_row(ticks.sparkSession, had, raised.get)
    entries = (
        states.price_entries(last_prices(sliced, settings.signals.trend_count))
        .unionByName(states.leg_entries(last_legs(legs, clock)))
        .unionByName(states.alert_entries(alerts))
        .unionByName(states.processed_entry(counts))
        .withColumn("updated_at", F.current_timestamp())
    )
    return BatchResult(alerts, upsert(state, entries), counts)


def state_before(
    spark: SparkSession, path: str, batch_id: int, buckets: Iterable[int] | None = None, count: int = STATE_BUCKETS
) -> DataFrame:
    """The state as the batches before ``batch_id`` left it, or some of its buckets; empty on a fresh start."""
    return read_buckets(spark, path, schemas.STATE, count, before=batch_id, buckets=buckets)


def touched_buckets(ticks: DataFrame, clock: str = "event_time", count: int = STATE_BUCKETS) -> list[int]:
    """Buckets with the state of the symbols of ``ticks`` and of the job: as many numbers as buckets at most."""
    owners = usable(ticks, clock).select(bucket_of(F.col("symbol"), count).alias(BUCKET))
    job = ticks.sparkSession.range(1).select(bucket_of(F.lit(states.JOB), count).alias(BUCKET))
    return sorted(r[0] for r in owners.unionByName(job).distinct().collect())


def alert_writer(
    root: str,
    settings: Settings = Settings(),
    clock: str = "event_time",
    tie: tuple[str, ...] = ("symbol", "price"),
    now: datetime | None = None,
    outbox: bool = True,
    rows_per_slice: int = ROWS_PER_SLICE,
    state_buckets: int = STATE_BUCKETS,
) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function: tables ``alerts``, ``outbox``, ``batch_stats``, ``state`` under ``root``.

    The state goes last: a batch that fails before it starts over from the same state.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # Read once from the source; lost pieces are computed again.
        batch = batch.persist()
        try:
            write_batch(spark, batch, batch_id)
        finally:
            batch.unpersist()

    def write_batch(spark: SparkSession, batch: DataFrame, batch_id: int) -> None:
        buckets = touched_buckets(batch, clock, state_buckets)
        before = state_before(spark, f"{root}/state", batch_id, buckets, state_buckets)
        result = alert_batch(batch, before, settings, clock, tie, now, rows_per_slice)
        part = f"batch_id={batch_id}"
        replace_part(result.alerts, f"{root}/alerts", part, "created_at")
        if outbox:
            replace_part(outbox_rows(result.alerts, zone=settings.display_zone), f"{root}/outbox", part)
        replace_part(result.stats, f"{root}/batch_stats", part)
        write_buckets(result.state, f"{root}/state", states.owner_of(F.col("state_key")), state_buckets, batch_id)

    return write


def start_alerts(
    silver: DataFrame,
    root: str,
    checkpoint: str,
    settings: Settings = Settings(),
    trigger: dict | None = None,
    **options,
) -> StreamingQuery:
    """Start the job on a silver stream."""
    trigger = trigger or {"processingTime": f"{settings.alert_job.poll_interval_seconds} seconds"}
    return (
        silver.writeStream.foreachBatch(alert_writer(root, settings, **options))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
