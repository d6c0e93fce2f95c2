"""Ordered work on keys of any size.

A rule that looks back along a key ("the previous price", "the last known leg") is a window
per key. A window runs in one task, so that is only right while no key is large. Here the size
is checked first. While every key fits one task, the key alone is the window partition. Beyond
that the rows are range-partitioned by (key, order) - even a single hot instant is split, because
the order ends in a tie-breaker - and written once to the checkpoint folder, so that places stay the
same for every later pass and retry. Consecutive rows of a partition make a *slice*: a task holds as
many slices as fit it, and their number never sets the number of tasks. Windows then run per slice,
and a small table with one entry per slice hands over what earlier slices know.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tickloom.operators.joins import shuffle_width
from tickloom.plans.lineage import cut_lineage

SLICE = "_slice"
CARRIED = "_carried"

# Narrow rows (order columns and a few doubles): one slice stays far below a task's memory.
ROWS_PER_SLICE = 2_000_000
# Where a row is stored, as monotonically_increasing_id tells it.
_PLACE, _PLACE_BITS = "_place", 33


@dataclass(frozen=True)
class Sliced:
    """Rows with a slice number, and how they are keyed and ordered."""

    rows: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    count: int
    # Keys with rows in several slices. Each border between slices splits one key at most, so there
    # are fewer of them than slices.
    spanning: DataFrame | None = None

    @property
    def split(self) -> bool:
        """Whether a key may continue from one slice into the next."""
        return self.count > 1

    def spanning_rows(self, rows: DataFrame) -> DataFrame:
        """Those of ``rows`` whose key spans slices."""
        if not self.keys:
            return rows
        named = self.spanning.select(*[F.col(k).alias(f"_key_{k}") for k in self.keys])
        same = reduce(lambda a, b: a & b, [rows[k].eqNullSafe(named[f"_key_{k}"]) for k in self.keys])
        return rows.join(F.broadcast(named), same, "left_semi")

    def window(self) -> WindowSpec:
        parts = [*self.keys, SLICE] if self.split else (list(self.keys) or [SLICE])
        return Window.partitionBy(*parts).orderBy(*self.order)


def slice_rows(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    rows_per_slice: int = ROWS_PER_SLICE,
) -> Sliced:
    """Give every row a slice."""
    largest, total = _sizes(rows, keys)
    if largest <= rows_per_slice:
        return Sliced(rows.withColumn(SLICE, F.lit(0)), tuple(keys), tuple(order), 1)
    width = shuffle_width(rows)
    # Twice as many as needed: range bounds come from a sample and are not exact.
    parts = max(width, math.ceil(2 * total / max(ROWS_PER_SLICE, rows_per_slice)))
    placed = cut_lineage(
        rows.repartitionByRange(parts, *keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn(_PLACE, F.monotonically_increasing_id())
    )
    # The id is the partition in its upper bits and the row's place there in the lower ones.
    part, at = F.shiftright(_PLACE, _PLACE_BITS), F.col(_PLACE).bitwiseAND((1 << _PLACE_BITS) - 1)
    per_part = placed.agg(F.max(at)).first()[0] // rows_per_slice + 1
    count = parts * per_part
    laid = placed.withColumn(SLICE, (part * per_part + F.floor(at / rows_per_slice)).cast("int")).drop(_PLACE)
    spanning = None
    if keys:
        spread = laid.groupBy(*keys).agg(F.min(SLICE).alias("_first"), F.max(SLICE).alias("_last"))
        spanning = cut_lineage(spread.filter(F.col("_first") < F.col("_last")).select(*keys))
    return Sliced(laid, tuple(keys), tuple(order), count, spanning)


def _sizes(rows: DataFrame, keys: Sequence[str]) -> tuple[int, int]:
    """Rows of the largest key and of all keys: one row reaches the driver."""
    per_key = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    largest, total = per_key.agg(F.max("n"), F.sum("n")).first()
    return largest or 0, total or 0


def with_earlier_rows(sliced: Sliced, depth: int) -> DataFrame:
    """The rows, plus in front of every slice the last ``depth`` rows its key had before it.

    The added rows have ``_carried`` set; windows see them, results must drop them.
    """
    rows = sliced.rows
    if CARRIED not in rows.columns:
        rows = rows.withColumn(CARRIED, F.lit(False))
    if not sliced.split:
        return rows
    keys = list(sliced.keys)
    columns = [c for c in rows.columns if c not in (*keys, SLICE)]
    newest_first = Window.partitionBy(*keys, SLICE).orderBy(*[F.col(c).desc() for c in sliced.order])
    # At most `depth` rows per (key, slice) leave a task: Spark limits the groups before the shuffle.
    tails = (
        sliced.spanning_rows(rows)
        .withColumn("_back", F.row_number().over(newest_first))
        .filter(F.col("_back") <= depth)
        .groupBy(*keys, SLICE)
        .agg(F.array_sort(F.collect_list(F.struct((-F.col("_back")).alias("_at"), *columns))).alias("_tail"))
    )
    # Every slice listed has a row, so `depth` of them always hold `depth` rows.
    earlier = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(-depth, -1)
    before = F.flatten(F.collect_list("_tail").over(earlier))
    carried = (
        tails.withColumn("_before", before)
        .withColumn("_before", F.slice("_before", F.greatest(F.size("_before") - depth + 1, F.lit(1)), depth))
        .select(*keys, SLICE, F.explode("_before").alias("_row"))
        .select(*keys, SLICE, *[F.col(f"_row.{c}").alias(c) for c in columns])
        .withColumn(CARRIED, F.lit(True))
    )
    return rows.unionByName(carried)


def last_known(sliced: Sliced, values: dict[str, Column]) -> DataFrame:
    """Add columns with the latest non-null value of each expression, up to the current row."""
    rows = sliced.rows
    to_here = sliced.window().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = {name: F.last(value, ignorenulls=True).over(to_here) for name, value in values.items()}
    if not sliced.split:
        return rows.withColumns(inside)
    keys = list(sliced.keys)
    place = F.struct(*sliced.order)
    per_slice = sliced.spanning_rows(rows).groupBy(*keys, SLICE).agg(
        *[F.max_by(v, F.when(v.isNotNull(), place)).alias(name) for name, v in values.items()]
    )
    # One entry per (key, slice), however many rows the slices hold.
    earlier = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    before = per_slice.select(
        *keys,
        SLICE,
        *[F.last(name, ignorenulls=True).over(earlier).alias(f"_before_{name}") for name in values],
    )
    # At most one key goes on into a slice: as many entries as slices, so they are broadcast.
    known = reduce(lambda a, b: a | b, [F.col(f"_before_{name}").isNotNull() for name in values])
    found = rows.withColumns(inside).join(F.broadcast(before.filter(known)), [*keys, SLICE], "left")
    return found.withColumns(
        {name: F.coalesce(name, f"_before_{name}") for name in values}
    ).drop(*[f"_before_{name}" for name in values])
