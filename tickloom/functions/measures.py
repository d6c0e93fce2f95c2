"""Numeric and time expressions shared by the operators."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickloom.config import GapSettings, SeveritySettings
from tickloom.functions import fixed


def micros(ts: Column | str) -> Column:
    """An instant as BIGINT microseconds: exact differences, no float time."""
    return F.unix_micros(F.col(ts) if isinstance(ts, str) else ts)


def seconds_between(earlier: Column, later: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1_000_000.0)


def instant(now: datetime | str | Column | None) -> Column:
    """The reference time of a report: explicit for replays, the current time otherwise."""
    if now is None:
        return F.current_timestamp()
    if isinstance(now, Column):
        return now
    return F.lit(now).cast("timestamp")


def percent_change(current: Column, baseline: Column) -> Column:
    """Absolute change in percent; 0 without a usable baseline."""
    return F.when(F.coalesce(baseline, F.lit(0.0)) == 0, F.lit(0.0)).otherwise(
        F.abs((current - baseline) / baseline * 100)
    )


def expected_local(global_price: Column, rate: Column, settings: GapSettings) -> Column:
    """Local price per gram implied by the global ounce price and the exchange rate."""
    return global_price * rate * settings.purity / settings.grams_per_ounce


def severity(alert_type: Column, amount: Column, settings: SeveritySettings = SeveritySettings()) -> Column:
    """Band of the absolute amount; alerts without an amount are low."""
    is_gap = alert_type == fixed.GOLD_GAP
    high = F.when(is_gap, settings.gap_high).otherwise(settings.move_high)
    medium = F.when(is_gap, settings.gap_medium).otherwise(settings.move_medium)
    return F.when(amount >= high, fixed.HIGH).when(amount >= medium, fixed.MEDIUM).otherwise(fixed.LOW)


def alert_id(*parts: Column | str) -> Column:
    """A replay-safe id: the same alert always gets the same one."""
    return F.sha2(F.concat_ws("|", *parts), 256)
