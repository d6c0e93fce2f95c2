"""Spikes and trends: candidates from one window pass, then the cooldown."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.config import SignalSettings
from tickloom.functions import fixed
from tickloom.functions.measures import percent_change
from tickloom.functions.text import number_list_text, number_text
from tickloom.operators.gate import Cooldown, gate
from tickloom.operators.slices import CARRIED, ROWS_PER_SLICE, SLICE, Sliced, slice_rows, with_earlier_rows

# Order of remembered rows (negative) before the rows of a batch (0).
TURN = "_turn"


def usable(ticks: DataFrame, clock: str = "event_time") -> DataFrame:
    """Ticks a detector may look at: a null price neither alerts nor becomes a baseline."""
    return ticks.filter(F.col("price").isNotNull() & F.col("symbol").isNotNull() & F.col(clock).isNotNull())


def ordered_ticks(
    ticks: DataFrame,
    clock: str = "event_time",
    tie: Sequence[str] = ("tick_id",),
    history: DataFrame | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> Sliced:
    """Ticks keyed by symbol in clock order, behind the remembered ticks of earlier batches.

    ``history`` (symbol, price, back) lists the last prices of a symbol, ``back`` = 1 the newest.
    """
    rows = usable(ticks, clock).select(
        *dict.fromkeys(["symbol", "price", clock, *tie]), F.lit(0).alias(TURN), F.lit(False).alias(CARRIED)
    )
    if history is not None:
        rows = rows.unionByName(
            history.select("symbol", "price", (-F.col("back")).cast("int").alias(TURN), F.lit(True).alias(CARRIED)),
            allowMissingColumns=True,
        )
    return slice_rows(rows, ["symbol"], [TURN, clock, *tie], rows_per_slice)


def with_signals(sliced: Sliced, settings: SignalSettings = SignalSettings()) -> DataFrame:
    """Every tick with its previous price, change in percent, spike and trend (null if none).

    One window gives the earlier prices a trend needs; prices are never null here, so a missing
    one means the run is still too short.
    """
    n = settings.trend_count
    depth = max(1, n - 1)
    w = sliced.window()
    price = [F.col("price"), *[F.col(f"_price_{k}") for k in range(1, depth + 1)]]
    rows = with_earlier_rows(sliced, depth).withColumns(
        {f"_price_{k}": F.lag("price", k).over(w) for k in range(1, depth + 1)}
    )
    trend = F.lit(None).cast("string")
    if n >= 3:
        rising = reduce(lambda a, b: a & b, [price[k] > price[k + 1] for k in range(n - 1)])
        falling = reduce(lambda a, b: a & b, [price[k] < price[k + 1] for k in range(n - 1)])
        trend = F.when(rising, fixed.UPTREND).when(falling, fixed.DOWNTREND)
    is_spike = F.col("previous_price").isNotNull() & (F.col("change_percent") >= settings.spike_threshold_pct)
    direction = F.when(F.col("price") > F.col("previous_price"), fixed.SPIKE_UP).otherwise(fixed.SPIKE_DOWN)
    return (
        rows.filter(~F.col(CARRIED))
        .withColumn("previous_price", price[1])
        .withColumn("change_percent", F.round(percent_change(price[0], price[1]), 3))
        .withColumn("trend", trend)
        .withColumn("spike", F.when(is_spike, direction))
        .drop(CARRIED)
    )


def signal_candidates(signals: DataFrame) -> DataFrame:
    """One row per spike and per trend, before the cooldown."""
    return (
        signals.filter(F.col("spike").isNotNull() | F.col("trend").isNotNull())
        .withColumn("alert_type", F.explode(F.array_compact(F.array("spike", "trend"))))
        .drop("spike", "trend", "previous_price", "change_percent")
    )


def fired_signals(
    sliced: Sliced,
    settings: SignalSettings = SignalSettings(),
    clock: str = "event_time",
    last_alerts: DataFrame | None = None,
) -> DataFrame:
    """Candidates that fire: more than the cooldown after the last one fired, per symbol and type."""
    candidates = signal_candidates(with_signals(sliced, settings))
    return gate(
        candidates,
        ["symbol", "alert_type"],
        sliced.order,
        Cooldown(settings.cooldown_seconds),
        clock,
        seeds=last_alerts,
        returned=[c for c in candidates.columns if c not in (TURN, SLICE)],
        sliced=sliced,
    )


def worded(fired: DataFrame, settings: SignalSettings = SignalSettings()) -> DataFrame:
    """Figures and text of fired signals; candidates that stay silent cost none."""
    is_spike = F.col("alert_type").isin(fixed.SPIKE_UP, fixed.SPIKE_DOWN)
    earlier = [c for c in fired.columns if c.startswith("_price_")]
    change = F.round(percent_change(F.col("price"), F.col("_price_1")), 3)
    run = F.array(*[F.col(f"_price_{k}") for k in range(settings.trend_count - 1, 0, -1)], F.col("price"))
    moved = F.concat(F.lit("Price moved "), number_text("change_percent"), F.lit("%"))
    return (
        fired.withColumn("change_percent", F.when(is_spike, change))
        .withColumn("message", F.when(is_spike, moved).otherwise(F.concat(F.initcap("alert_type"), F.lit(" detected"))))
        .withColumn("previous_price", F.when(is_spike, number_text("_price_1")))
        .withColumn("_run", F.when(~is_spike, run))
        .withColumn("prices", number_list_text("_run"))
        .drop("_run", *earlier)
    )


def signal_alerts(
    ticks: DataFrame,
    settings: SignalSettings = SignalSettings(),
    clock: str = "event_time",
    tie: Sequence[str] = ("tick_id",),
    history: DataFrame | None = None,
    last_alerts: DataFrame | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Spikes and trends that fire. ``history`` and ``last_alerts`` continue an earlier batch."""
    sliced = ordered_ticks(ticks, clock, tie, history, rows_per_slice)
    return worded(fired_signals(sliced, settings, clock, last_alerts), settings)


def last_prices(sliced: Sliced, count: int) -> DataFrame:
    """The newest ``count`` prices of each symbol (symbol, price, back): the next batch's history."""
    newest = Window.partitionBy("symbol").orderBy(*[F.col(c).desc() for c in sliced.order])
    # A top-k per key: tasks forward at most `count` rows per symbol to the shuffle.
    return (
        sliced.rows.withColumn("back", F.row_number().over(newest))
        .filter(F.col("back") <= count)
        .select("symbol", "price", "back")
    )
