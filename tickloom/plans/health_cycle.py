"""One round of the health monitor as a set of DataFrames."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from tickloom import schemas
from tickloom.config import Settings
from tickloom.functions.measures import instant
from tickloom.operators import health
from tickloom.sinks.messages import health_log_rows
from tickloom.sources.tables import empty


@dataclass(frozen=True)
class HealthCycle:
    checks: DataFrame
    summary: DataFrame
    changes: DataFrame
    log_lines: DataFrame
    message: DataFrame
    heartbeat: DataFrame
    row_counts: DataFrame


def health_cycle(
    bronze: DataFrame,
    silver: DataFrame,
    gold: DataFrame | None,
    previous: DataFrame | None = None,
    now=None,
    settings: Settings = Settings(),
    heartbeats_sent: DataFrame | None = None,
) -> HealthCycle:
    """Gather, check, compare with the previous report, and word the messages.

    ``message`` is empty unless a check changed; ``heartbeat`` unless one is due.
    """
    spark, zone = silver.sparkSession, settings.display_zone
    at = instant(now)
    checks = health.health_report(bronze, silver, now, settings.health)
    before = previous if previous is not None else empty(spark, schemas.CHECKS)
    changes = health.status_changes(checks, before)
    report_times = spark.range(1).select(at.alias("report_time"))
    return HealthCycle(
        checks=checks,
        summary=health.report_summary(checks),
        changes=changes,
        log_lines=health_log_rows(checks, at, zone),
        message=health.health_message(checks, now, zone, changes),
        heartbeat=health.heartbeats(report_times, settings.health, zone, heartbeats_sent),
        row_counts=health.row_counts({"bronze": bronze, "silver": silver, "gold": gold}),
    )
