"""Declared schemas of every table; nothing is inferred at read time."""

from __future__ import annotations

from pyspark.sql import types as T

# The time on the wire is ISO-8601 text: parsed by the bronze transform, not by from_json.
WIRE = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("source", T.StringType()),
    ]
)

BRONZE = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("source", T.StringType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("ingestion_time", T.TimestampType()),
    ]
)

SILVER = T.StructType(BRONZE.fields + [T.StructField("processed_at", T.TimestampType())])

# Input of the batch operators. tick_id only breaks ties between equal times.
TICKS = T.StructType(
    [
        T.StructField("tick_id", T.LongType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("source", T.StringType()),
        T.StructField("event_time", T.TimestampType()),
    ]
)

ALERTS = T.StructType(
    [
        T.StructField("alert_id", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("alert_type", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("current_price", T.DoubleType()),
        T.StructField("change_percent", T.DoubleType()),
        T.StructField("change_amount", T.DoubleType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("extra_data", T.MapType(T.StringType(), T.StringType())),
    ]
)

STATE = T.StructType(
    [
        T.StructField("state_key", T.StringType(), False),
        T.StructField("state_value", T.StringType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

CHECKS = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)

OUTBOX = T.StructType(
    [
        T.StructField("alert_id", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("text", T.StringType()),
    ]
)

PAYLOADS = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("payload", T.StringType()),
        T.StructField("fetched_at", T.TimestampType()),
    ]
)
