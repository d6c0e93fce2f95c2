"""The gap between a local price and the one two other feeds imply, as an as-of join of three legs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.config import GapSettings
from tickloom.functions import fixed
from tickloom.functions.measures import expected_local
from tickloom.functions.text import number_text
from tickloom.operators.detect import TURN, usable
from tickloom.operators.gate import Cooldown, gate
from tickloom.operators.slices import CARRIED, ROWS_PER_SLICE, SLICE, Sliced, last_known, slice_rows

_LEGS = ("global_leg", "rate_leg", "local_leg")


def leg_ticks(
    ticks: DataFrame,
    settings: GapSettings = GapSettings(),
    clock: str = "event_time",
    tie: Sequence[str] = ("tick_id",),
    legs: DataFrame | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> Sliced:
    """Ticks of the three legs as one sequence; other symbols are left out.

    ``legs`` (symbol, price, at) holds the last values of an earlier batch.
    """
    rows = (
        usable(ticks, clock)
        .filter(F.col("symbol").isin(*settings.legs))
        .select(*dict.fromkeys(["symbol", "price", clock, *tie]), F.lit(0).alias(TURN), F.lit(False).alias(CARRIED))
    )
    if legs is not None:
        rows = rows.unionByName(
            legs.select("symbol", "price", F.col("at").alias(clock), F.lit(-1).alias(TURN), F.lit(True).alias(CARRIED)),
            allowMissingColumns=True,
        )
    return slice_rows(rows, [], [TURN, clock, *tie], rows_per_slice)


def with_legs(sliced: Sliced, settings: GapSettings = GapSettings(), clock: str = "event_time") -> DataFrame:
    """Each leg tick with the last known price and time (microseconds) of all three legs."""
    value = F.struct(F.col("price"), F.unix_micros(F.col(clock)).alias("us"))
    known = last_known(
        sliced,
        {name: F.when(F.col("symbol") == leg, value) for name, leg in zip(_LEGS, settings.legs)},
    )
    return known.select(
        *[c for c in known.columns if c not in _LEGS],
        F.col("global_leg.price").alias("global_price"),
        F.col("rate_leg.price").alias("rate_price"),
        F.col("local_leg.price").alias("local_price"),
        F.col("global_leg.us").alias("global_us"),
        F.col("rate_leg.us").alias("rate_us"),
        F.col("local_leg.us").alias("local_us"),
    )


def with_gap(legs: DataFrame, settings: GapSettings = GapSettings(), clock: str = "event_time") -> DataFrame:
    """Expected price, gap and the age of both gold prices; ticks before all legs are known drop out."""
    us = F.unix_micros(F.col(clock))
    return (
        legs.filter(
            F.col("global_price").isNotNull() & F.col("rate_price").isNotNull() & F.col("local_price").isNotNull()
        )
        .withColumn("expected", expected_local(F.col("global_price"), F.col("rate_price"), settings))
        .withColumn("gap", F.round(F.abs(F.col("local_price") - F.col("expected")), 2))
        .withColumn("global_age_us", us - F.col("global_us"))
        .withColumn("local_age_us", us - F.col("local_us"))
    )


def fresh_legs(gaps: DataFrame, settings: GapSettings = GapSettings()) -> DataFrame:
    """Staleness guards: a price older than its limit (exactly at the limit still counts) gives no gap."""
    return gaps.filter(
        (F.col("global_age_us") <= int(settings.stale_global_seconds * 1_000_000))
        & (F.col("local_age_us") <= int(settings.stale_local_seconds * 1_000_000))
    )


def gap_candidates(
    gaps: DataFrame, settings: GapSettings = GapSettings(), order: Sequence[str] = ()
) -> DataFrame:
    """Gaps at or above the threshold, before the cooldown. Columns of ``order`` always stay."""
    spent = ("symbol", "price", "global_us", "rate_us", "local_us", "global_age_us", "local_age_us")
    return (
        fresh_legs(gaps, settings)
        .filter((F.col("gap") >= settings.threshold) & ~F.col(CARRIED))
        .withColumn("global_age_sec", F.floor(F.col("global_age_us") / 1_000_000).cast("bigint"))
        .withColumn("local_age_sec", F.floor(F.col("local_age_us") / 1_000_000).cast("bigint"))
        .drop(CARRIED, *[c for c in spent if c not in order])
    )


def fired_gaps(
    sliced: Sliced,
    settings: GapSettings = GapSettings(),
    clock: str = "event_time",
    last_alerts: DataFrame | None = None,
) -> DataFrame:
    """Gaps that fire: after the cooldown, or when the gap moved by ``min_change`` since the last one."""
    gaps = with_gap(with_legs(sliced, settings, clock), settings, clock)
    candidates = gap_candidates(gaps, settings, sliced.order)
    seed = None
    if last_alerts is not None:
        # One sequence, one row of state: it becomes a literal.
        seed = last_alerts.filter(F.col("alert_type") == fixed.GOLD_GAP).select("seed_t", "seed_v").first()
    # The expected price follows from the three legs: it is worked out again for the few that fire.
    fired = gate(
        candidates.withColumn("_one", F.lit(0)),
        ["_one"],
        sliced.order,
        Cooldown(settings.cooldown_seconds, at_exactly=True, min_change=settings.min_change),
        clock,
        "gap",
        seed=seed,
        returned=[c for c in candidates.columns if c not in (TURN, SLICE, "expected")],
        sliced=sliced,
    )
    return fired.withColumns(
        {
            "symbol": F.lit(settings.alert_symbol),
            "alert_type": F.lit(fixed.GOLD_GAP),
            "expected": expected_local(F.col("global_price"), F.col("rate_price"), settings),
            "message": F.concat(F.lit("Gold gap detected ("), number_text("gap"), F.lit(" EGP)")),
        }
    )


def gap_alerts(
    ticks: DataFrame,
    settings: GapSettings = GapSettings(),
    clock: str = "event_time",
    tie: Sequence[str] = ("tick_id",),
    legs: DataFrame | None = None,
    last_alerts: DataFrame | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Gap alerts that fire. ``legs`` and ``last_alerts`` continue an earlier batch."""
    return fired_gaps(leg_ticks(ticks, settings, clock, tie, legs, rows_per_slice), settings, clock, last_alerts)


def last_legs(sliced: Sliced, clock: str = "event_time") -> DataFrame:
    """Last price and time of each leg (symbol, price, at): the next batch's legs."""
    newest = F.struct(*sliced.order)
    return (
        sliced.rows.groupBy("symbol")
        .agg(F.max_by(F.struct("price", F.col(clock).alias("at")), newest).alias("_last"))
        .select("symbol", "_last.price", "_last.at")
    )
