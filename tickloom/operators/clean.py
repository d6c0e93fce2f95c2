"""Cleaning ticks: filters, exact duplicates, rows already written, outliers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.config import OutlierSettings
from tickloom.operators.gate import PASSED, Band, gate
from tickloom.operators.slices import ROWS_PER_SLICE
from tickloom.sources.tables import time_range

# What makes two ticks the same one.
TICK_KEY = ("symbol", "event_time", "price")


def valid_ticks(ticks: DataFrame) -> DataFrame:
    """Positive price and a symbol. A null time passes; a null price does not."""
    return ticks.filter(F.col("price") > 0).filter(F.col("symbol").isNotNull())


def distinct_ticks(ticks: DataFrame) -> DataFrame:
    """One row per tick key, whichever; also the streaming form, behind a watermark."""
    return ticks.dropDuplicates(list(TICK_KEY))


def first_of_duplicates(ticks: DataFrame, order: Sequence[str] = ("tick_id",)) -> DataFrame:
    """One row per tick key, the first by ``order``: an aggregate, so copies combine before the shuffle."""
    rest = [c for c in ticks.columns if c not in TICK_KEY]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("_first")
    return ticks.groupBy(*TICK_KEY).agg(first).select(*TICK_KEY, "_first.*").select(*ticks.columns)


def without_written(ticks: DataFrame, written: DataFrame, since: Column | None = None) -> DataFrame:
    """Ticks not yet in ``written``, null-safe. ``since`` bounds the part of the table to look at:
    the earliest time the batch can hold. Rows without a time are always looked at."""
    if since is not None:
        written = time_range(written, "event_time", since, keep_null=True)
    key = written.select(*[F.col(c).alias(f"_{c}") for c in TICK_KEY])
    same = reduce(lambda a, b: a & b, [ticks[c].eqNullSafe(key[f"_{c}"]) for c in TICK_KEY])
    return ticks.join(key, same, "left_anti")


def outlier_flags(
    ticks: DataFrame,
    settings: OutlierSettings = OutlierSettings(),
    clock: str = "event_time",
    tie: Sequence[str] = ("tick_id",),
    last_accepted: DataFrame | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Every priced tick with ``accepted``: within the limit of the last accepted price of its symbol.

    Ticks without a price are never accepted and do not come back. ``last_accepted`` (symbol,
    price) continues an earlier batch.
    """
    limit: Column = F.lit(float(settings.threshold_pct))
    for symbol, pct in settings.per_symbol_pct.items():
        limit = F.when(F.col("symbol") == symbol, float(pct)).otherwise(limit)
    seeds = last_accepted
    if seeds is not None:
        seeds = seeds.select("symbol", F.lit(0).cast("bigint").alias("seed_t"), F.col("price").alias("seed_v"))
    flagged = gate(
        ticks.filter(F.col("price").isNotNull()),
        ["symbol"],
        [clock, *tie],
        Band(),
        v="price",
        limit=limit,
        seeds=seeds,
        keep_all=True,
        rows_per_slice=rows_per_slice,
    )
    return flagged.withColumnRenamed(PASSED, "accepted")


def without_outliers(ticks: DataFrame, settings: OutlierSettings = OutlierSettings(), **options) -> DataFrame:
    return outlier_flags(ticks, settings, **options).filter("accepted").drop("accepted")


def last_accepted(
    flagged: DataFrame, clock: str = "event_time", tie: Sequence[str] = ("tick_id",), before: DataFrame | None = None
) -> DataFrame:
    """(symbol, price): the last accepted price of every symbol, for the next batch or a stream.

    ``before`` holds those of earlier batches; symbols of which nothing was accepted since keep theirs.
    """
    newest = flagged.filter("accepted").groupBy("symbol").agg(F.max_by("price", F.struct(clock, *tie)).alias("price"))
    if before is None:
        return newest
    kept = before.select("symbol", "price").join(newest.select(F.col("symbol").alias("_new")), F.col("symbol").eqNullSafe(F.col("_new")), "left_anti")
    return kept.unionByName(newest)
