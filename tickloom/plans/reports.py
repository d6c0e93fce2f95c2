"""Reports over the alert and price tables. Arguments are checked before a plan is built."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions import fixed
from tickloom.functions.measures import instant, seconds_between
from tickloom.operators.health import last_ticks
from tickloom.sources.tables import time_range

# Buckets count from this Monday, 2000-01-03, in seconds since 1970.
BUCKET_ORIGIN_SECONDS = 946_857_600


def _within(name: str, value: int, low: int, high: int) -> int:
    if not low <= value <= high:
        raise ValueError(f"{name} must be between {low} and {high}, got {value}")
    return value


def _since(now, hours: int) -> Column:
    return instant(now) - F.make_dt_interval(hours=F.lit(_within("hours", hours, 1, 720)))


def recent_alerts(alerts: DataFrame, now=None, hours: int = 24, limit: int = 500) -> DataFrame:
    """Newest alerts of the last hours."""
    _within("limit", limit, 1, 5000)
    return (
        time_range(alerts, "created_at", _since(now, hours))
        .select(
            "alert_id",
            "symbol",
            "alert_type",
            "severity",
            "message",
            "current_price",
            "change_percent",
            "change_amount",
            "created_at",
            "extra_data",
        )
        .orderBy(F.col("created_at").desc(), "alert_id")
        .limit(limit)
    )


def all_alerts(alerts: DataFrame) -> DataFrame:
    """Every alert, newest first."""
    return alerts.orderBy(F.col("created_at").desc(), "alert_id")


def alert_counts_by_type(alerts: DataFrame, now=None, hours: int = 24) -> DataFrame:
    """Alerts per type and severity, most frequent first."""
    return (
        time_range(alerts, "created_at", _since(now, hours))
        .groupBy("alert_type", "severity")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.col("count").desc(), "alert_type", "severity")
    )


def alerts_timeseries(alerts: DataFrame, now=None, hours: int = 24, bucket_minutes: int = 30) -> DataFrame:
    """Alerts per time bucket and type, in time order."""
    seconds = _within("bucket_minutes", bucket_minutes, 1, 1440) * 60
    bucket = F.window("created_at", f"{seconds} seconds", startTime=f"{BUCKET_ORIGIN_SECONDS % seconds} seconds")
    return (
        time_range(alerts, "created_at", _since(now, hours))
        .groupBy(bucket.alias("bucket"), "alert_type")
        .agg(F.count(F.lit(1)).alias("count"))
        .select(F.col("bucket.start").alias("time"), "alert_type", "count")
        .orderBy("time", "alert_type")
    )


def recent_alert_count(alerts: DataFrame, now=None, minutes: int = 60) -> DataFrame:
    """How many alerts the last minutes had."""
    since = instant(now) - F.make_dt_interval(mins=F.lit(minutes))
    return time_range(alerts, "created_at", since).agg(F.count(F.lit(1)).alias("count"))


def gap_history(alerts: DataFrame, now=None, hours: int = 48, limit: int = 500) -> DataFrame:
    """Gap alerts of the last hours in time order, with the figures behind them; the first ``limit``."""
    _within("limit", limit, 1, 5000)
    extra = F.col("extra_data")
    return (
        time_range(alerts, "created_at", _since(now, hours))
        .filter(F.col("alert_type") == fixed.GOLD_GAP)
        .orderBy("created_at", "alert_id")
        .limit(limit)
        .select(
            "created_at",
            F.col("change_amount").alias("gap_egp"),
            "severity",
            extra["expected_local"].alias("expected"),
            extra["actual_local"].alias("actual"),
            extra["global_gold"].alias("global_gold"),
            extra["usd_egp"].alias("usd_egp"),
        )
    )


def price_history(silver: DataFrame, symbol: str, now=None, hours: int = 24, limit: int = 2000) -> DataFrame:
    """Prices of one symbol in the last hours in time order; the first (oldest) ``limit``."""
    _within("limit", limit, 1, 20000)
    return (
        time_range(silver, "event_time", _since(now, hours))
        .filter(F.col("symbol") == symbol)
        .select(F.col("event_time").alias("time"), "price")
        .orderBy("time", "price")
        .limit(limit)
    )


def latest_prices(silver: DataFrame, symbol: str | None = None, tie: str = "price") -> DataFrame:
    """Newest price of every symbol, or of one (no row if it has none)."""
    rows = silver if symbol is None else silver.filter(F.col("symbol") == symbol)
    newest = F.max_by(F.struct("price", "event_time"), F.struct("event_time", tie))
    return rows.groupBy("symbol").agg(newest.alias("_last")).select("symbol", "_last.price", "_last.event_time")


def feed_ages(silver: DataFrame, now=None) -> DataFrame:
    """Last tick of every symbol and its age in seconds."""
    return last_ticks(silver).withColumn("age_seconds", seconds_between(F.col("last_seen"), instant(now)))


def batch_counts(ticks: DataFrame, alerts: DataFrame, fresh: Column | None = None) -> DataFrame:
    """Ticks, alerts and newest event time of one batch, and how many ticks were not ``fresh``."""
    seen = F.coalesce(fresh, F.lit(False)) if fresh is not None else F.lit(True)
    zero = F.lit(0)
    return (
        ticks.select(seen.cast("int").alias("t"), (~seen).cast("int").alias("l"), zero.alias("a"), F.when(seen, F.col("event_time")).alias("at"))
        .unionByName(alerts.select(zero.alias("t"), zero.alias("l"), F.lit(1).alias("a"), F.lit(None).cast("timestamp").alias("at")))
        .agg(
            F.coalesce(F.sum("t"), zero).alias("ticks"),
            F.coalesce(F.sum("a"), zero).alias("alerts"),
            F.max("at").alias("high_water"),
            F.coalesce(F.sum("l"), zero).alias("late_ticks"),
        )
    )
