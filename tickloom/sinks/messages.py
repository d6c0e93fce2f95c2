"""Messages as tables: an outbox for alerts, a log for health reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.text import alert_text, local_time_text, status_mark
from tickloom.operators.health import worst_of


def outbox_rows(alerts: DataFrame, sent: DataFrame | None = None, zone: str = "Africa/Cairo") -> DataFrame:
    """One message per alert that has none yet; a sender reads the outbox."""
    if sent is not None:
        alerts = alerts.join(sent.select("alert_id"), "alert_id", "left_anti")
    return alerts.select("alert_id", "created_at", alert_text(zone).alias("text"))


def health_log_rows(checks: DataFrame, at, zone: str = "Africa/Cairo") -> DataFrame:
    """The lines of one report for the log: a head with the worst status, then one line per check.

    ``checks`` is a report: a handful of rows.
    """
    stamp = F.lit(at).cast("timestamp") if not hasattr(at, "alias") else at
    head = checks.agg(worst_of(F.col("status")).alias("worst")).select(
        F.lit(0).alias("line"),
        F.concat(F.lit("["), local_time_text(stamp, zone), F.lit("] STATUS="), F.coalesce("worst", F.lit("OK"))).alias("text"),
    )
    lines = checks.select(
        F.col("position").alias("line"),
        F.concat(F.lit("  "), status_mark(F.col("status")), F.lit(" "), F.col("message")).alias("text"),
    )
    return head.unionByName(lines).withColumn("generated_at", stamp)
