"""Tumbling price bars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def price_bars(ticks: DataFrame, width: str = "30 seconds", watermark: str | None = None) -> DataFrame:
    """Average, highest and lowest price per symbol and window; with a watermark also on streams."""
    rows = ticks.withWatermark("event_time", watermark) if watermark else ticks
    return (
        rows.groupBy(F.window("event_time", width), "symbol")
        .agg(
            F.avg("price").alias("moving_avg"),
            F.max("price").alias("max_price"),
            F.min("price").alias("min_price"),
        )
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "symbol",
            "moving_avg",
            "max_price",
            "min_price",
        )
    )
