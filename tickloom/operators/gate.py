"""Rules where a row passes or not depending on the last row that passed.

Cooldowns ("fire again only after 300 s") and the outlier filter ("compare with the last accepted
price") share one shape: walk a key in order, remember the last row that passed, ask a predicate.
No window expresses it, because the memory depends on the answers. One Arrow scan per sorted
partition does, with a single remembered row per key.

Keys too large for one task are walked slice by slice, exactly and in parallel:

1. every slice summarises itself as its *openers* - the rows that could be the first to pass after
   some earlier row - each with the row that would pass last if the slice started there;
2. that tells each slice where it starts. Cooldowns, of which a dense key can have openers without
   number, follow the path from slice to slice by pointer doubling over tables
   (:mod:`tickloom.operators.successors`). Summaries of the outlier filter, which are short, are
   composed in groups, level by level, until one is left per key, and the last passed row is handed
   back down;
3. the scan runs on all slices at once, each from its own start.

Only summaries of keys that span slices travel, and the hand-over is one row per slice and key that
goes on into it. Arrow carries just the columns asked for.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import partial, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tickloom.operators.joins import shuffle_width
from tickloom.operators.slices import ROWS_PER_SLICE, SLICE, Sliced, slice_rows
from tickloom.operators.successors import path_exits, runs
from tickloom.plans.lineage import cut_lineage

PASSED = "_passed"
# A row that only tells a slice where it starts, in front of the slice's own.
TOLD = "_told"
FAN_IN = 16


@dataclass
class Walk:
    """Consecutive rows of one key: what a rule sees of a row is a time in microseconds, a value and
    a limit."""

    t: np.ndarray
    v: np.ndarray
    limit: np.ndarray

    def __len__(self) -> int:
        return len(self.t)

    def part(self, start: int, stop: int) -> Walk:
        return Walk(self.t[start:stop], self.v[start:stop], self.limit[start:stop])

    def row(self, i: int) -> tuple[int, float]:
        return int(self.t[i]), float(self.v[i])


@dataclass(frozen=True)
class Cooldown:
    """Pass when enough time went by since the last pass, or the value moved by ``min_change``."""

    seconds: float
    at_exactly: bool = False
    min_change: float | None = None

    def _over(self, rows: Walk, t) -> np.ndarray:
        elapsed, limit = rows.t - t, int(self.seconds * 1_000_000)
        return elapsed >= limit if self.at_exactly else elapsed > limit

    def first_over(self, rows: Walk, t):
        """Rows are in time order: the first one past the cooldown by binary search."""
        side = "left" if self.at_exactly else "right"
        return np.searchsorted(rows.t, t + int(self.seconds * 1_000_000), side=side)

    def passes(self, rows: Walk, t, v) -> np.ndarray:
        over = self._over(rows, t)
        return over if self.min_change is None else over | (np.abs(rows.v - v) >= self.min_change)

    def openers(self, rows: Walk) -> np.ndarray:
        # Earlier rows are no later than row 0, so the first row past the cooldown of row 0
        # passes after any of them: nothing behind it can be first.
        over = self._over(rows, rows.t[0])
        return np.arange(int(np.argmax(over)) + 1 if over.any() else len(rows))

    @property
    def time_only(self) -> bool:
        return self.min_change is None

    @property
    def at_once(self) -> bool:
        """Whether a row may pass right after one of the same time."""
        return self.at_exactly and self.seconds <= 0

    def must_stay(self, rows: Walk) -> np.ndarray:
        """Openers a change of value can make first: new highs and lows. Time reaches all others."""
        fresh = np.zeros(len(rows), dtype=bool)
        if not self.time_only:
            high, low = np.maximum.accumulate(rows.v), np.minimum.accumulate(rows.v)
            fresh[0] = True
            fresh[1:] = (rows.v[1:] > high[:-1]) | (rows.v[1:] < low[:-1])
        return fresh


def _new_lows(v: np.ndarray) -> np.ndarray:
    """The first row, those with a value below all before them, of values below zero those above all
    before them, and the first that is no number: with no upper end to a band, all that can be first."""
    up, down = np.where(v >= 0, v, np.inf), np.where(v < 0, v, -np.inf)
    lowest = np.minimum.accumulate(np.concatenate([[np.inf], up[:-1]]))
    highest = np.maximum.accumulate(np.concatenate([[-np.inf], down[:-1]]))
    odd = np.isnan(v)
    keep = (up < lowest) | (down > highest) | (odd & (np.cumsum(odd) == 1))
    keep[0] = True
    return np.flatnonzero(keep)


@dataclass(frozen=True)
class Band:
    """Pass while the value is within ``limit`` percent of the last value that passed."""

    time_only = False

    def must_stay(self, rows: Walk) -> np.ndarray:
        return np.ones(len(rows), dtype=bool)

    def passes(self, rows: Walk, t, v) -> np.ndarray:
        base = np.asarray(v, dtype=float)
        with np.errstate(divide="ignore", invalid="ignore"):
            moved = np.abs(rows.v - base) / base * 100
        # A zero base has no percentage: the next value is taken, as after no value at all.
        return (base == 0) | ~(moved > rows.limit)

    def openers(self, rows: Walk) -> np.ndarray:
        # A row can follow any base within its own band. Between the lowest and the highest value of
        # rows whose bands overlap, every base that suits a row suits one of them: only new highs
        # and lows of such a group can be first. Groups join when bands overlap beyond rounding.
        # With limits of 100 % and more a band has no upper end, and only new lows can be first. A
        # base that is missing, zero or negative takes any row, so the first one.
        share = rows.limit / 100
        if (share == 0).all():
            # Only the same value follows: the first of each.
            return np.unique([0, *np.unique(rows.v, return_index=True)[1]])
        if share[0] >= 1 and (share == share[0]).all():
            return _new_lows(rows.v)
        odd = np.isnan(rows.v)
        suits = odd | (share >= 1) | ((rows.v > 0) & (share >= 0))
        plain = (rows.v > 0) & (share < 1) & (share > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            low = np.where(plain, rows.v / (1 + share), 0.0)
            high = np.where(plain, rows.v / (1 - share), 0.0)
        beyond = 1 + 1e-9
        keep: list[int] = []
        groups: list[tuple[float, float, float, float, float]] = []
        at, step = 0, 64
        while at < len(rows):
            stop = min(at + step, len(rows))
            v, limit = rows.v[at:stop], rows.limit[at:stop]
            known = np.zeros(stop - at, dtype=bool)
            for least, most, _, _, reach in groups:
                known |= (v >= least) & (v <= most) & (limit <= reach)
            fresh = ~(known & plain[at:stop]) & suits[at:stop]
            fresh[0] |= at == 0
            if not fresh.any():
                at, step = stop, step * 2
                continue
            i = at + int(np.argmax(fresh))
            keep.append(i)
            if plain[i]:
                new, apart = (rows.v[i], rows.v[i], low[i], high[i], rows.limit[i]), []
                for other in groups:
                    if other[2] * beyond <= new[3] and new[2] * beyond <= other[3]:
                        new = (
                            min(new[0], other[0]),
                            max(new[1], other[1]),
                            min(new[2], other[2]),
                            max(new[3], other[3]),
                            min(new[4], other[4]),
                        )
                    else:
                        apart.append(other)
                groups = [*apart, new]
            at, step = i + 1, 64
        return np.asarray(keep)


def first_pass(rule, rows: Walk, start: int, last: tuple[int, float] | None) -> int:
    """Index of the first row from ``start`` on that passes after ``last``; the length if none."""
    if last is None:
        return min(start, len(rows))
    if rule.time_only:
        return max(start, int(rule.first_over(rows, last[0])))
    step = 32
    while start < len(rows):
        stop = min(start + step, len(rows))
        ok = rule.passes(rows.part(start, stop), *last)
        if ok.any():
            return start + int(np.argmax(ok))
        start, step = stop, step * 2
    return len(rows)


def failing_neighbours(rule, rows: Walk) -> np.ndarray:
    """Rows that fail against the row right before them: a streak of passes ends there."""
    ok = rule.passes(rows.part(1, len(rows)), rows.t[:-1], rows.v[:-1])
    return np.flatnonzero(~ok) + 1


def walk(rule, rows: Walk, last: tuple[int, float] | None) -> tuple[np.ndarray, tuple[int, float] | None]:
    """Which rows pass, and the last one that does."""
    passed = np.zeros(len(rows), dtype=bool)
    ends = failing_neighbours(rule, rows)
    at = first_pass(rule, rows, 0, last)
    while at < len(rows):
        k = int(np.searchsorted(ends, at, side="right"))
        end = int(ends[k]) if k < len(ends) else len(rows)
        passed[at:end] = True
        last = rows.row(end - 1)
        at = first_pass(rule, rows, end + 1, last)
    return passed, last


def exits(rule, rows: Walk, openers: np.ndarray) -> np.ndarray:
    """For each opener, the last row that passes if that opener is the first."""
    if rule.time_only and not rule.at_once:
        # Where each row leads, over and over, until nothing leads on.
        following = np.searchsorted(rows.t, rows.t + int(rule.seconds * 1_000_000), side="left" if rule.at_exactly else "right")
        last = np.where(following < len(rows), following, np.arange(len(rows)))
        while True:
            further = last[last]
            if np.array_equal(further, last):
                return last[openers]
            last = further
    ends = failing_neighbours(rule, rows)
    known: dict[int, int] = {}
    result = np.empty(len(openers), dtype=np.int64)
    for n, opener in enumerate(openers):
        at, trail = int(opener), []
        while True:
            k = int(np.searchsorted(ends, at, side="right"))
            end = (int(ends[k]) if k < len(ends) else len(rows)) - 1
            if end in known:
                exit_row = known[end]
                break
            trail.append(end)
            at = first_pass(rule, rows, end + 2, rows.row(end))
            if at >= len(rows):
                exit_row = end
                break
        for end in trail:
            known[end] = exit_row
        result[n] = exit_row
    return result


# --- summaries -------------------------------------------------------------------------------

# One row per opener: what it is, and (t, v) of the row that would pass last.
_SUMMARY = T.StructType(
    [
        T.StructField("_node", T.IntegerType()),
        T.StructField("_at", T.LongType()),
        T.StructField("_t", T.LongType()),
        T.StructField("_v", T.DoubleType()),
        T.StructField("_limit", T.DoubleType()),
        T.StructField("_exit_t", T.LongType()),
        T.StructField("_exit_v", T.DoubleType()),
        T.StructField("_seed_t", T.LongType()),
        T.StructField("_seed_v", T.DoubleType()),
    ]
)


def _distinct_ends(rule, rows: Walk, exit_t: np.ndarray, exit_v: np.ndarray) -> np.ndarray:
    """Openers to keep. One that only time makes first may go if the next one has the same end: what
    comes late enough for the one comes late enough for the other."""
    same = (exit_t[1:] == exit_t[:-1]) & (exit_v[1:] == exit_v[:-1])
    return np.flatnonzero(np.append(~same, True) | rule.must_stay(rows))


def _summary_frame(node: int, rows: Walk, exit_t, exit_v, seed_t, seed_v) -> pd.DataFrame:
    return pd.DataFrame(
        {
            "_node": np.full(len(rows), node, dtype=np.int32),
            "_at": np.arange(len(rows), dtype=np.int64),
            "_t": rows.t,
            "_v": rows.v,
            "_limit": rows.limit,
            "_exit_t": exit_t,
            "_exit_v": exit_v,
            "_seed_t": pd.array([seed_t] * len(rows), dtype="Int64"),
            "_seed_v": pd.array([seed_v] * len(rows), dtype="Float64"),
        }
    )


def _summarise_slice(rule, rows: Walk) -> tuple[Walk, np.ndarray, np.ndarray]:
    """The openers of a slice, and time and value of the row that would pass last after each."""
    openers = rule.openers(rows)
    ends = exits(rule, rows, openers)
    exit_t, exit_v = rows.t[ends], rows.v[ends]
    inside = Walk(rows.t[openers], rows.v[openers], rows.limit[openers])
    keep = _distinct_ends(rule, inside, exit_t, exit_v)
    return Walk(inside.t[keep], inside.v[keep], inside.limit[keep]), exit_t[keep], exit_v[keep]


def _parts(group: pd.DataFrame) -> list[tuple[int, Walk, np.ndarray, np.ndarray]]:
    """The summaries of neighbouring nodes, in order."""
    group = group.sort_values(["_node", "_at"])
    return [
        (
            int(node),
            Walk(one["_t"].to_numpy(), one["_v"].to_numpy(), one["_limit"].to_numpy()),
            one["_exit_t"].to_numpy(),
            one["_exit_v"].to_numpy(),
        )
        for node, one in group.groupby("_node", sort=True)
    ]


def _through(rule, part, last: tuple[int, float] | None) -> tuple[int, float] | None:
    """The last passed row after a node, given the one before it."""
    _, rows, exit_t, exit_v = part
    i = first_pass(rule, rows, 0, last)
    return last if i >= len(rows) else (int(exit_t[i]), float(exit_v[i]))


def _seed_of(group: pd.DataFrame) -> tuple[int, float] | None:
    seed_t = group["_seed_t"].iloc[0]
    return None if pd.isna(seed_t) else (int(seed_t), float(group["_seed_v"].iloc[0]))


def _compose(rule, fan_in: int, group: pd.DataFrame) -> pd.DataFrame:
    """One summary for a group of neighbouring nodes."""
    parts = _parts(group)
    exit_t, exit_v = [], []
    for n, (_, rows, own_t, own_v) in enumerate(parts):
        reached: dict[tuple[int, float], tuple[int, float]] = {}
        for t, v in zip(own_t.tolist(), own_v.tolist()):
            if (t, v) not in reached:
                reached[t, v] = reduce(lambda last, part: _through(rule, part, last), parts[n + 1 :], (t, v))
            end = reached[t, v]
            exit_t.append(end[0])
            exit_v.append(end[1])
    exit_t, exit_v = np.asarray(exit_t, dtype=np.int64), np.asarray(exit_v, dtype=float)
    rows = Walk(
        np.concatenate([p[1].t for p in parts]),
        np.concatenate([p[1].v for p in parts]),
        np.concatenate([p[1].limit for p in parts]),
    )
    openers = rule.openers(rows)
    opening = Walk(rows.t[openers], rows.v[openers], rows.limit[openers])
    keep = openers[_distinct_ends(rule, opening, exit_t[openers], exit_v[openers])]
    rows = Walk(rows.t[keep], rows.v[keep], rows.limit[keep])
    seed_t, seed_v = _seed_of(group) or (None, None)
    return _summary_frame(parts[0][0] // fan_in, rows, exit_t[keep], exit_v[keep], seed_t, seed_v)


def _hand_down(rule, group: pd.DataFrame) -> pd.DataFrame:
    """The last passed row before each node of a group, given the one before the group."""
    before_t = group["_before_t"].iloc[0]
    last = _seed_of(group) if pd.isna(before_t) else (int(before_t), float(group["_before_v"].iloc[0]))
    nodes, before = [], []
    for part in _parts(group):
        nodes.append(part[0])
        before.append(last)
        last = _through(rule, part, last)
    return pd.DataFrame(
        {
            "_node": np.asarray(nodes, dtype=np.int32),
            "_before_t": pd.array([b[0] if b else None for b in before], dtype="Int64"),
            "_before_v": pd.array([b[1] if b else None for b in before], dtype="Float64"),
        }
    )


# --- the operator ----------------------------------------------------------------------------


@dataclass(frozen=True)
class _Names:
    """Columns of the scanned batches: what makes a run, and what the rule sees."""

    run: tuple[str, ...]
    t: str | None
    v: str | None
    limit: str | None


def _numbers(batch: pa.RecordBatch, name: str | None, kind: pa.DataType, otherwise: np.ndarray) -> np.ndarray:
    if name is None:
        return otherwise
    return pc.fill_null(batch.column(name).cast(kind), 0).to_numpy(zero_copy_only=False)


def _walk_of(batch: pa.RecordBatch, names: _Names) -> Walk:
    zeros = np.zeros(batch.num_rows)
    return Walk(
        _numbers(batch, names.t, pa.int64(), zeros.astype(np.int64)),
        _numbers(batch, names.v, pa.float64(), zeros),
        _numbers(batch, names.limit, pa.float64(), zeros),
    )


def _pair(batch: pa.RecordBatch, i: int, t_name: str, v_name: str) -> tuple[int, float] | None:
    if t_name not in batch.schema.names:
        return None
    t = batch.column(t_name)[i].as_py()
    return None if t is None else (t, batch.column(v_name)[i].as_py())


def _scanner(rule, names: _Names, returned: Sequence[str], keep_all: bool):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, last = None, None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            rows = _walk_of(batch, names)
            passed = np.zeros(batch.num_rows, dtype=bool)
            told = batch.column(TOLD).to_numpy(zero_copy_only=False) if TOLD in batch.schema.names else passed.copy()
            for start, stop, key in runs(batch, names.run):
                if key != current:
                    current = key
                    last = _pair(batch, start, "_before_t", "_before_v")
                start += int(told[start])
                passed[start:stop], last = walk(rule, rows.part(start, stop), last)
            out, mask = batch.select(returned), pa.array(passed)
            yield out.append_column(PASSED, mask).filter(pa.array(~told)) if keep_all else out.filter(mask)

    return scan


def _summary_batch(summaries: Sequence[tuple], names: Sequence[str], target: pa.Schema) -> pa.RecordBatch:
    """Summaries of many slices, (key, seed, openers, exit_t, exit_v) each, as one batch."""
    keys, seeds, openers, exit_t, exit_v = zip(*summaries)
    sizes = np.array([len(rows) for rows in openers])
    each = pa.array(np.repeat(np.arange(len(sizes)), sizes))
    columns = {
        "_at": np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes),
        "_t": np.concatenate([rows.t for rows in openers]),
        "_v": np.concatenate([rows.v for rows in openers]),
        "_limit": np.concatenate([rows.limit for rows in openers]),
        "_exit_t": np.concatenate(exit_t),
        "_exit_v": np.concatenate(exit_v),
    }
    once = {name: [key[i] for key in keys] for i, name in enumerate(["_node", *names[1:]])}
    once |= {"_seed_t": [seed and seed[0] for seed in seeds], "_seed_v": [seed and seed[1] for seed in seeds]}
    arrays = [
        pa.array(columns[f.name], f.type) if f.name in columns else pa.array(once[f.name], f.type).take(each) for f in target
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=target)


def _summariser(rule, names: _Names, schema: T.StructType):
    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = to_arrow_schema(schema)
        held, ready, count = None, [], 0

        def finish() -> int:
            key, seed, pieces = held
            summary = _summarise_slice(rule, Walk(*(np.concatenate(column) for column in zip(*pieces))))
            ready.append((key, seed, *summary))
            return len(summary[0])

        for batch in batches:
            if batch.num_rows == 0:
                continue
            rows = _walk_of(batch, names)
            for start, stop, key in runs(batch, names.run):
                part = rows.part(start, stop)
                if held is None or held[0] != key:
                    if held is not None:
                        count += finish()
                    held = (key, _pair(batch, start, "_seed_t", "_seed_v"), [])
                held[2].append((part.t, part.v, part.limit))
            if count > 10_000:
                yield _summary_batch(ready, names.run, target)
                ready, count = [], 0
        if held is not None:
            finish()
            yield _summary_batch(ready, names.run, target)

    return summarise


def gate(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    rule,
    t: str | None = None,
    v: str | None = None,
    limit: Column | None = None,
    seeds: DataFrame | None = None,
    seed: tuple[int, float] | None = None,
    returned: Sequence[str] | None = None,
    keep_all: bool = False,
    rows_per_slice: int = ROWS_PER_SLICE,
    sliced: Sliced | None = None,
) -> DataFrame:
    """The rows that pass ``rule`` walking each key in order.

    At least one key is needed; use a constant column for a single sequence. ``t`` names a time or
    BIGINT column of microseconds, ``v`` a DOUBLE column, ``limit`` is a column the rule compares
    with. ``seeds`` (keys, seed_t, seed_v) holds the last passed row of an earlier batch per key,
    ``seed`` that of a single sequence.
    ``returned`` lists the columns wanted back, all by default; with ``keep_all`` every row comes
    back, with a boolean ``_passed``. ``sliced`` is the layout ``rows`` were computed from by windows
    over it, if they were: keyed by leading columns of ``keys`` and in the same order.
    """
    keys = list(keys)
    returned = list(returned or [c for c in rows.columns if c != SLICE])
    if limit is not None:
        rows = rows.withColumn("_limit", limit.cast("double"))
    if seeds is not None:
        named = seeds.select(
            *[F.col(k).alias(f"_key_{k}") for k in keys],
            F.col("seed_t").alias("_seed_t"),
            F.col("seed_v").alias("_seed_v"),
        )
        rows = rows.join(named, _same(rows, named, keys), "left").drop(*[f"_key_{k}" for k in keys])
    elif seed is not None:
        rows = rows.withColumns({"_seed_t": F.lit(seed[0]).cast("bigint"), "_seed_v": F.lit(float(seed[1]))})
    # Windows over whole keys of a layout have brought the rows of each together, and so those of
    # finer keys; only the join with seeds may have moved them again.
    together = sliced is not None and seeds is None and tuple(keys[: len(sliced.keys)]) == sliced.keys
    if sliced is None:
        sliced = slice_rows(rows, keys, order, rows_per_slice)
        rows = sliced.rows
    elif sliced.split:
        if seeds is not None:
            # That join may have scattered the rows of a slice: a scan needs them together.
            rows = rows.repartition(SLICE, *keys)
        # Seen more than once below: keep the rows, not the windows that made them.
        rows = cut_lineage(rows)
    if sliced.split:
        names = _Names((SLICE, *keys), t, v, None if limit is None else "_limit")
        rows = _with_starts(rows, sliced, keys, order, rule, names)
    else:
        names = _Names(tuple(keys), t, v, None if limit is None else "_limit")
        if not together:
            rows = rows.repartition(*keys)
        if "_seed_t" in rows.columns:
            rows = rows.withColumns({"_before_t": F.col("_seed_t"), "_before_v": F.col("_seed_v")})
    wanted = dict.fromkeys([*names.run, t, v, names.limit, "_before_t", "_before_v", TOLD, *returned])
    first = [F.col(TOLD).desc()] if sliced.split else []
    ready = rows.sortWithinPartitions(*names.run, *first, *order).select(*[c for c in wanted if c in rows.columns])
    schema = T.StructType([ready.schema[c] for c in returned])
    if keep_all:
        schema = schema.add(PASSED, T.BooleanType())
    return ready.mapInArrow(_scanner(rule, names, returned, keep_all), schema)


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str], *more: Column) -> Column:
    return reduce(lambda a, b: a & b, [*[left[k].eqNullSafe(right[f"_key_{k}"]) for k in keys], *more])


def _with_starts(
    rows: DataFrame, sliced: Sliced, keys: Sequence[str], order: Sequence[str], rule, names: _Names
) -> DataFrame:
    """Add, in front of each slice, the last passed row before it, for keys that go on into it."""
    key_fields = [rows.schema[k] for k in keys]
    schema = T.StructType([*key_fields, *_SUMMARY.fields])
    seen = [SLICE, *keys, names.t, names.v, names.limit, "_seed_t", "_seed_v"]
    narrow = (
        sliced.spanning_rows(rows)
        .sortWithinPartitions(SLICE, *keys, *order)
        .select(*[c for c in dict.fromkeys(seen) if c in rows.columns])
    )
    summaries = cut_lineage(narrow.mapInArrow(_summariser(rule, names, schema), schema))
    if isinstance(rule, Cooldown):
        starts = path_exits(summaries, keys, _bare_walk, rule, first_pass)
    else:
        starts = _composed_starts(summaries, sliced.count, keys, key_fields, rule, schema)
    # As many as slices, so they go to the slices like rows: neither the driver nor a task holds them all.
    handed = cut_lineage(starts.filter(F.col("_before_t").isNotNull())).select(
        *keys, F.col("_node").alias(SLICE), "_before_t", "_before_v", F.lit(True).alias(TOLD)
    )
    before = {c: F.col(c.replace("before", "seed")) if "_seed_t" in rows.columns else F.lit(None) for c in ("_before_t", "_before_v")}
    own = rows.withColumns({"_before_t": before["_before_t"].cast("bigint"), "_before_v": before["_before_v"].cast("double"), TOLD: F.lit(False)})
    return own.unionByName(handed, allowMissingColumns=True).repartition(shuffle_width(rows), SLICE, *keys)


def _bare_walk(t, v) -> Walk:
    return Walk(t, v, np.zeros(len(t)))


def _composed_starts(
    summaries: DataFrame, count: int, keys: Sequence[str], key_fields: Sequence[T.StructField], rule, schema: T.StructType
) -> DataFrame:
    """(keys, _node, _before_t, _before_v) by composing summaries up a tree and handing starts down it."""
    levels, fan_ins, width = [summaries], [], count
    while width > 1:
        # Long summaries are composed in smaller groups, down to pairs: a group stays within a task.
        longest = levels[-1].groupBy(*keys, "_node").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 1
        fan_in = max(2, min(FAN_IN, ROWS_PER_SLICE // longest))
        width = -(-width // fan_in)
        fan_ins.append(fan_in)
        composed = _by_parent(levels[-1], keys, fan_in).applyInPandas(
            _keyed(partial(_compose, rule, fan_in), keys, schema.names), schema
        )
        levels.append(cut_lineage(composed))
    # The top has one node per key and nothing before it.
    start_schema = T.StructType(
        [
            *key_fields,
            T.StructField("_node", T.IntegerType()),
            T.StructField("_before_t", T.LongType()),
            T.StructField("_before_v", T.DoubleType()),
        ]
    )
    starts = (
        levels[-1]
        .select(*keys, "_node")
        .distinct()
        .withColumns({"_before_t": F.lit(None).cast("bigint"), "_before_v": F.lit(None).cast("double")})
    )
    for level, fan_in in zip(reversed(levels[:-1]), reversed(fan_ins)):
        above = starts.select(
            *[F.col(k).alias(f"_key_{k}") for k in keys], F.col("_node").alias("_parent"), "_before_t", "_before_v"
        )
        inside = F.floor(level["_node"] / fan_in) == above["_parent"]
        joined = level.join(above, _same(level, above, keys, inside)).drop("_parent", *[f"_key_{k}" for k in keys])
        starts = _by_parent(joined, keys, fan_in).applyInPandas(
            _keyed(partial(_hand_down, rule), keys, start_schema.names), start_schema
        )
    return starts


def _by_parent(level: DataFrame, keys: Sequence[str], fan_in: int):
    parents = level.withColumn("_parent", F.floor(F.col("_node") / fan_in))
    return parents.repartition(shuffle_width(level), *keys, "_parent").groupBy(*keys, "_parent")


def _keyed(step, keys: Sequence[str], names: Sequence[str]):
    def apply(group: pd.DataFrame) -> pd.DataFrame:
        frame = step(group)
        for name in keys:
            frame[name] = group[name].iloc[0]
        return frame[list(names)]

    return apply
