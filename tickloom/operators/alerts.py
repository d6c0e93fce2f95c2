"""Alert rows: one shape for every detector."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom import schemas
from tickloom.config import Settings, SeveritySettings
from tickloom.functions import fixed
from tickloom.functions.measures import alert_id, severity
from tickloom.functions.text import number_text
from tickloom.operators.detect import signal_alerts
from tickloom.operators.gap import gap_alerts
from tickloom.operators.slices import ROWS_PER_SLICE


def _rows(
    fired: DataFrame,
    price: Column,
    percent: Column,
    amount: Column,
    extra: Column,
    clock: str,
    tie: Sequence[str],
    bands: SeveritySettings,
) -> DataFrame:
    parts = ["symbol", "alert_type", F.unix_micros(F.col(clock)).cast("string")]
    return fired.select(
        alert_id(*parts, *[F.col(c).cast("string") for c in tie]).alias("alert_id"),
        "symbol",
        "alert_type",
        severity(F.col("alert_type"), amount, bands).alias("severity"),
        "message",
        price.cast("double").alias("current_price"),
        percent.cast("double").alias("change_percent"),
        amount.cast("double").alias("change_amount"),
        F.col(clock).alias("created_at"),
        extra.alias("extra_data"),
    )


def signal_alert_rows(
    fired: DataFrame,
    clock: str = "event_time",
    tie: Sequence[str] = ("tick_id",),
    bands: SeveritySettings = SeveritySettings(),
) -> DataFrame:
    """Spikes carry the previous price, trends the prices of the run; neither has an amount."""
    is_spike = F.col("alert_type").isin(fixed.SPIKE_UP, fixed.SPIKE_DOWN)
    extra = F.when(is_spike, F.create_map(F.lit("previous_price"), F.col("previous_price"))).otherwise(
        F.create_map(F.lit("prices"), F.col("prices"))
    )
    none = F.lit(None).cast("double")
    return _rows(fired, F.col("price"), F.col("change_percent"), none, extra, clock, tie, bands)


def gap_alert_rows(
    fired: DataFrame,
    clock: str = "event_time",
    tie: Sequence[str] = ("tick_id",),
    bands: SeveritySettings = SeveritySettings(),
) -> DataFrame:
    extra = F.create_map(
        F.lit("global_gold"),
        number_text("global_price"),
        F.lit("usd_egp"),
        number_text("rate_price"),
        F.lit("expected_local"),
        number_text("round(expected, 2)"),
        F.lit("actual_local"),
        number_text("local_price"),
        F.lit("global_age_sec"),
        F.col("global_age_sec").cast("string"),
        F.lit("local_age_sec"),
        F.col("local_age_sec").cast("string"),
    )
    return _rows(fired, F.col("local_price"), F.lit(0.0), F.col("gap"), extra, clock, tie, bands)


def detect_alerts(
    ticks: DataFrame,
    settings: Settings = Settings(),
    clock: str = "event_time",
    tie: Sequence[str] = ("tick_id",),
    history: DataFrame | None = None,
    legs: DataFrame | None = None,
    last_alerts: DataFrame | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Alerts of all detectors over ``ticks``, with the state of an earlier batch if given."""
    signals = signal_alerts(ticks, settings.signals, clock, tie, history, last_alerts, rows_per_slice)
    gaps = gap_alerts(ticks, settings.gap, clock, tie, legs, last_alerts, rows_per_slice)
    return signal_alert_rows(signals, clock, tie, settings.severity).unionByName(
        gap_alert_rows(gaps, clock, tie, settings.severity)
    )


def no_alerts(spark) -> DataFrame:
    return spark.createDataFrame([], schemas.ALERTS)
