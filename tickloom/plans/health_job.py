"""The health monitor as a job: each round writes what it found and compares with the round before."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom import schemas
from tickloom.config import Settings
from tickloom.functions.measures import instant
from tickloom.operators import health
from tickloom.sinks.messages import health_log_rows
from tickloom.sinks.tables import replace_part
from tickloom.sources.tables import parquet_rows

_ROUND = T.StructField("round", T.IntegerType())
REPORTS = T.StructType([T.StructField("position", T.IntegerType()), *schemas.CHECKS.fields, _ROUND])
LOG = T.StructType(
    [T.StructField("line", T.IntegerType()), T.StructField("text", T.StringType()), T.StructField("generated_at", T.TimestampType()), _ROUND]
)
MESSAGES = T.StructType([T.StructField("text", T.StringType()), _ROUND])
SENT = T.StructType(
    [T.StructField("local_date", T.DateType()), T.StructField("sent_at", T.TimestampType()), T.StructField("text", T.StringType()), _ROUND]
)


def health_round(
    bronze: DataFrame, silver: DataFrame, root: str, number: int, now=None, settings: Settings = Settings()
) -> None:
    """Round ``number``: tables ``reports``, ``log``, ``outbox`` and ``heartbeats`` under ``root``.

    Every table has one part per round, so a round that is run again replaces itself. A report is
    read back before it is compared and worded: bronze and silver are looked at once.
    """
    spark, zone, part = silver.sparkSession, settings.display_zone, f"round={number}"
    at = instant(now)
    replace_part(health.health_report(bronze, silver, now, settings.health), f"{root}/reports", part)
    checks = reports(spark, root).filter(F.col("round") == number).drop("round")
    changes = health.status_changes(checks, report_before(spark, root, number))
    replace_part(health_log_rows(checks, at, zone), f"{root}/log", part)
    replace_part(health.health_message(checks, now, zone, changes), f"{root}/outbox", part)
    # Heartbeats of this round's earlier try do not count as sent.
    sent = parquet_rows(spark, f"{root}/heartbeats", SENT).filter(F.col("round") < number)
    times = spark.range(1).select(at.alias("report_time"))
    replace_part(health.heartbeats(times, settings.health, zone, sent), f"{root}/heartbeats", part)


def reports(spark: SparkSession, root: str) -> DataFrame:
    return parquet_rows(spark, f"{root}/reports", REPORTS)


def report_before(spark: SparkSession, root: str, number: int) -> DataFrame:
    """The report of the last round before ``number``; empty before the first."""
    earlier = reports(spark, root).filter(F.col("round") < number)
    last = earlier.agg(F.max("round")).first()[0]  # one row
    return earlier.filter(F.col("round") == F.lit(last)).drop("round")


def log_lines(spark: SparkSession, root: str) -> DataFrame:
    return parquet_rows(spark, f"{root}/log", LOG)


def messages(spark: SparkSession, root: str) -> DataFrame:
    return parquet_rows(spark, f"{root}/outbox", MESSAGES)


def heartbeats_sent(spark: SparkSession, root: str) -> DataFrame:
    return parquet_rows(spark, f"{root}/heartbeats", SENT)
