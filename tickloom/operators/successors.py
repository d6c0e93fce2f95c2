"""Which row passes next, followed over slices: cooldowns of keys of any density.

After a row has passed, what passes next depends on that row alone: it is the first later one that the
rule lets through. So the rows that pass are a path along successors. Within a slice it is followed by a
task; a slice tells of its openers, the rows that can pass first after an earlier one, and where the
path leaves the slice from each. Between slices the path goes on from exit to exit:

1. each exit finds the slice that holds its successor by the bounds of its key's slices, a row per slice,
   and meets the openers of that slice there: both in portions of bounded size however many exits come;
2. the links, exit to exit, are joined with themselves: to the second next, the fourth, the eighth. What
   no link of a level leads to cannot be on the path that far, so levels shrink. It ends when the path
   from the start does, after as many rounds as the number of slices has binary digits;
3. down the levels again, the exits on the path are gathered: one per slice at most.

All exits and links are rows of tables; no group holds more than a slice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tickloom.operators.joins import lookup, shuffle_width
from tickloom.plans.lineage import cut_lineage

# Exits that meet the openers of a slice in one group.
PORTION = 200_000
_START = -1


def path_exits(
    summaries: DataFrame, keys: Sequence[str], walk_of: Callable, rule, first_pass: Callable, portion: int | None = None
) -> DataFrame:
    """(keys, _node, _before_t, _before_v): for every slice of ``summaries`` the last row that passed before it.

    ``summaries`` (keys, _node, _at, _t, _v, _limit, _exit_t, _exit_v, _seed_t, _seed_v) are stored.
    """
    portion = portion or PORTION
    exits = exit_nodes(summaries, keys)
    asked = cut_lineage(asked_slices(exits, summaries, keys, rule, walk_of, portion))
    found = met_openers(asked, summaries, keys, rule, walk_of, first_pass, portion)
    place = [*keys, "_node", "_exit_t", "_exit_v"]
    ends = exits.select(F.col("_id").alias("w"), *place)
    links = cut_lineage(found.join(ends, _null_safe(found, ends, keys, place), "inner").select("u", "w"))
    starts = exits.filter(F.col("_node") == _START).select(F.col("_id").alias("u"))
    passed = path_from(links, starts)
    on_path = exits.join(passed.select(F.col("u").alias("_id")), "_id", "left_semi")
    # A start without a seed stands for nothing having passed.
    states = on_path.filter(F.col("_exit_t").isNotNull()).select(
        *keys, "_node", F.col("_exit_t").alias("_before_t"), F.col("_exit_v").alias("_before_v")
    )
    slices = summaries.select(*keys, "_node").distinct()
    both = slices.withColumns({"_s": F.lit(None).cast("struct<t:bigint,v:double>"), "_turn": F.lit(0)}).unionByName(
        states.select(*keys, "_node", F.struct(F.col("_before_t").alias("t"), F.col("_before_v").alias("v")).alias("_s"), F.lit(1).alias("_turn"))
    )
    # Two entries per slice and key at most, whatever the slices hold.
    earlier = Window.partitionBy(*keys).orderBy("_node", "_turn").rowsBetween(Window.unboundedPreceding, -1)
    return (
        both.withColumn("_last", F.last("_s", ignorenulls=True).over(earlier))
        .filter((F.col("_turn") == 0) & F.col("_last").isNotNull())
        .select(*keys, "_node", F.col("_last.t").alias("_before_t"), F.col("_last.v").alias("_before_v"))
    )


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str]):
    same = [left[c].eqNullSafe(right[c]) if c in keys else left[c] == right[c] for c in columns]
    whole = same[0]
    for one in same[1:]:
        whole = whole & one
    return whole


def exit_nodes(summaries: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(_id, keys, _node, _exit_t, _exit_v): every way out of a slice, and the start of every key."""
    ends = summaries.select(*keys, "_node", "_exit_t", "_exit_v").distinct()
    starts = summaries.select(
        *keys, F.lit(_START).alias("_node"), F.col("_seed_t").alias("_exit_t"), F.col("_seed_v").alias("_exit_v")
    ).distinct()
    return cut_lineage(ends.unionByName(starts).withColumn("_id", F.monotonically_increasing_id()))


def asked_slices(exits: DataFrame, summaries: DataFrame, keys: Sequence[str], rule, walk_of: Callable, portion: int) -> DataFrame:
    """(u, keys, _node, t, v): the slice that holds the successor of each exit; exits without one are gone."""
    number = F.when(~F.isnan("_v"), F.col("_v"))
    bounds = summaries.groupBy(*keys, "_node").agg(F.max("_t").alias("t"), F.max(number).alias("high"), F.min(number).alias("low"))
    asks = exits.select(F.col("_id").alias("u"), *keys, "_node", F.col("_exit_t").alias("t"), F.col("_exit_v").alias("v"))
    dealt, copied = _dealt(asks, bounds, keys, portion)
    schema = T.StructType([asks.schema["u"], *[asks.schema[c] for c in (*keys, "_node", "t", "v")]])
    group = [*keys, "_part"]

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = to_arrow_schema(schema)
        for states, answers in _meetings(batches, group, ("_node", "t", "high", "low"), partial(first_slices, rule, walk_of), ("_node", "t", "v")):
            columns = [pa.array(answers, pa.int32()) if c == "_node" else states.column(c) for c in target.names]
            yield pa.RecordBatch.from_arrays(columns, schema=target).filter(pa.array(answers >= 0))

    return _sorted_meeting(copied, dealt, group, ["_node"]).mapInArrow(ask, schema)


def first_slices(rule, walk_of: Callable, table: Sequence[np.ndarray], after: np.ndarray, t: np.ndarray, v: np.ndarray, none: np.ndarray) -> np.ndarray:
    """Of each state the first slice behind slice ``after`` with a row that passes, or -1. What passes shows
    at a slice's last time and at its highest and lowest value; stretches of slices double up to the first
    that shows something, and are halved inside it, so that a long cooldown costs few steps."""
    nodes, last, high, low = table
    n = len(nodes)
    out = np.full(len(t), -1, np.int32)
    out[none] = nodes[0]
    at = np.searchsorted(nodes, after, side="right")
    stretches = [(high, low)]
    while (2 << (len(stretches) - 1)) <= n:
        half = 1 << (len(stretches) - 1)
        top, bottom = stretches[-1]
        stretches.append((np.fmax(top[:-half], top[half:]), np.fmin(bottom[:-half], bottom[half:])))

    def shows(where: np.ndarray, of: np.ndarray, level: int) -> np.ndarray:
        ends, (top, bottom) = last[where + (1 << level) - 1], stretches[level]
        return rule.passes(walk_of(ends, top[where]), t[of], v[of]) | rule.passes(walk_of(ends, bottom[where]), t[of], v[of])

    live = np.flatnonzero(~none & (at < n))
    # Up: past stretches of 1, 2, 4 ... slices that show nothing, as long as they fit.
    level, found = np.zeros(len(t), np.int64), []
    for k in range(len(stretches)):
        fits = at[live] + (1 << k) <= n
        short = live[~fits]
        level[short] = k
        found.append(short)
        live = live[fits]
        if not len(live):
            break
        ok = shows(at[live], live, k)
        level[live[ok]] = k
        found.append(live[ok])
        live = live[~ok]
        at[live] += 1 << k
    level[live] = len(stretches)
    live = np.concatenate([*found, live])
    # Down: what is looked for lies within the next 2 ** level slices, or nowhere.
    for k in range(len(stretches) - 1, -1, -1):
        some = live[(level[live] >= k) & (at[live] + (1 << k) <= n)]
        some = some[~shows(at[some], some, k)]
        at[some] += 1 << k
    hit = live[at[live] < n]
    out[hit] = nodes[at[hit]]
    return out


def _dealt(asked: DataFrame, table: DataFrame, group: Sequence[str], portion: int) -> tuple[DataFrame, DataFrame]:
    """Both with ``_part``: rows that ask one group are dealt to portions, and its entries are in each."""
    counts = asked.groupBy(*group).agg(F.ceil(F.count(F.lit(1)) / portion).cast("int").alias("_parts"))
    named = [F.col(c).alias(f"_group_{c}") for c in group]
    # Groups of more than one portion: no more than there are portions.
    large = F.broadcast(cut_lineage(counts.filter(F.col("_parts") > 1)).select(*named, "_parts"))
    dropped = [*[f"_group_{c}" for c in group], "_parts"]

    def with_parts(rows: DataFrame) -> DataFrame:
        same = reduce(lambda a, b: a & b, [rows[c].eqNullSafe(large[f"_group_{c}"]) for c in group])
        return rows.join(large, same, "left").withColumn("_parts", F.coalesce("_parts", F.lit(1)))

    dealt = with_parts(asked).withColumn("_part", F.pmod(F.xxhash64("u"), F.col("_parts")).cast("int")).drop(*dropped)
    copied = with_parts(table).withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop(*dropped)
    return dealt, copied


def _sorted_meeting(table: DataFrame, asked: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Entries and those that ask them in one sequence: of each group, first all entries in order."""
    rows = table.withColumn("_asks", F.lit(False)).unionByName(asked.withColumn("_asks", F.lit(True)), allowMissingColumns=True)
    # A number given is kept: by their bytes alone these small rows would be left to a few tasks.
    return rows.repartition(shuffle_width(rows), *group).sortWithinPartitions(*group, "_asks", *order)


def _meetings(
    batches: Iterator[pa.RecordBatch], group: Sequence[str], entry: Sequence[str], answer: Callable, state: Sequence[str]
) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Rows that ask, with ``answer(entries, *state, whether a state has no time)`` for each. The entries of
    a group are held while those that ask them pass; each that asks has some."""
    current, held, table = None, [], None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        asks = batch.column("_asks").to_numpy(zero_copy_only=False)
        none = batch.column("t").is_null().to_numpy(zero_copy_only=False)
        values = {c: _filled(batch.column(c)) for c in dict.fromkeys([*entry, *state])}
        answers = []
        for start, stop, key in runs(batch, group):
            if key != current:
                current, held = key, []
            middle = start + int(np.searchsorted(asks[start:stop], True))
            if middle > start:
                held.append([values[c][start:middle] for c in entry])
                table = None
            if middle < stop:
                table = table or [np.concatenate(c) for c in zip(*held)]
                answers.append(answer(table, *[values[c][middle:stop] for c in state], none[middle:stop]))
        if answers:
            yield batch.filter(pa.array(asks)), np.concatenate(answers)


def _filled(column: pa.Array) -> np.ndarray:
    """Values as numbers, missing ones as no number or zero."""
    return column.fill_null(float("nan") if pa.types.is_floating(column.type) else 0).to_numpy(zero_copy_only=False)


def runs(batch: pa.RecordBatch, names: Sequence[str]) -> list[tuple[int, int, tuple]]:
    """Stretches of equal keys in a sorted batch: (start, stop, key)."""
    changed = np.zeros(batch.num_rows, dtype=bool)
    changed[0] = True
    for name in names:
        codes = batch.column(name).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        changed[1:] |= codes[1:] != codes[:-1]
    starts = np.flatnonzero(changed)
    stops = np.append(starts[1:], batch.num_rows)
    keys = [batch.column(name).take(pa.array(starts)).to_pylist() for name in names]
    return list(zip(starts.tolist(), stops.tolist(), zip(*keys)))


def in_portions(asked: DataFrame, summaries: DataFrame, keys: Sequence[str], portion: int) -> tuple[DataFrame, DataFrame]:
    """Both with ``_part``: exits that ask one slice are dealt to portions, and its openers are in each."""
    return _dealt(asked, summaries, [*keys, "_node"], portion)


def met_openers(
    asked: DataFrame, summaries: DataFrame, keys: Sequence[str], rule, walk_of: Callable, first_pass: Callable, portion: int
) -> DataFrame:
    """(u, keys, _node, _exit_t, _exit_v): where the path leaves the next slice after each exit."""
    openers = summaries.select(*keys, "_node", "_at", F.col("_t").alias("t"), F.col("_v").alias("v"), "_exit_t", "_exit_v")
    dealt, copied = in_portions(asked, openers, keys, portion)
    schema = T.StructType([asked.schema["u"], *[summaries.schema[c] for c in (*keys, "_node", "_exit_t", "_exit_v")]])
    group = [*keys, "_node", "_part"]

    def ends(table: Sequence[np.ndarray], t: np.ndarray, v: np.ndarray, none: np.ndarray) -> np.ndarray:
        rows = walk_of(table[0], table[1])
        if rule.time_only:
            at = np.where(none, 0, rule.first_over(rows, t))
        else:
            at = [first_pass(rule, rows, 0, None if no else (x, y)) for x, y, no in zip(t.tolist(), v.tolist(), none.tolist())]
        # Every state that asks a slice finds an opener in it.
        return np.rec.fromarrays([table[2][at], table[3][at]], names="t,v")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = to_arrow_schema(schema)
        for states, found in _meetings(batches, group, ("t", "v", "_exit_t", "_exit_v"), ends, ("t", "v")):
            known = {"_exit_t": pa.array(found["t"]), "_exit_v": pa.array(found["v"])}
            yield pa.RecordBatch.from_arrays([known[c] if c in known else states.column(c) for c in target.names], schema=target)

    return _sorted_meeting(copied, dealt, group, ["_at"]).mapInArrow(meet, schema)


def path_from(links: DataFrame, starts: DataFrame) -> DataFrame:
    """(u): all nodes on the ways from ``starts`` along ``links`` (u, w), a successor per node at most."""
    levels = [links]
    while not levels[-1].join(starts, "u", "left_semi").isEmpty():
        level = levels[-1]
        beyond = level.select(F.col("u").alias("w"), F.col("w").alias("_far"))
        twice = cut_lineage(lookup(level, beyond, "w").select("u", F.col("_far").alias("w")))
        reached = twice.select(F.col("w").alias("u")).unionByName(starts).distinct()
        levels.append(cut_lineage(twice.join(reached, "u", "left_semi")))
    passed = starts
    for level in reversed(levels):
        # As many as the path has nodes, one per slice and key at most; both have one row per u.
        passed = cut_lineage(passed.unionByName(level.join(passed, "u", "left_semi").select(F.col("w").alias("u"))))
    return passed
