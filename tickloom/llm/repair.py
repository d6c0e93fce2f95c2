"""Repair of conversations: the cheapest edits that make the roles take turns, found as one integer.

Rows of a conversation are kept (K), given another role (R) or deleted (D), and empty turns inserted (I),
so that the initials of the roles read ``(s?(ua)+)?``. Every way through is a path in a graph without
cycles over (row, last initial). The weight of a path is one integer: its high digits are the cost, and
below them every edit has a digit of fixed width at its place, the letters in ASCII order from 1, zero
behind the last. So the smallest integer is the cheapest path and, of equally cheap ones, the one whose
letters come first. Long conversations are cut into blocks of rows, each of which gives the smallest
weight from any initial to any other; blocks are chained by the same rule. That is exact: parts end in
the letter of a row and hold as many of those as the block has rows, so none is the beginning of another
and order is settled where the parts differ.

Rows are range-partitioned by conversation and turn. All but the first and the last conversation of a
partition lie in it whole and are settled there in one pass. Of those that may go on in the next, each
partition gives its part as a table of four by four weights, the parts meet per conversation, and the
choice comes back to the rows: a conversation of any size is worked on in parallel. Only the digest of a
repaired text is made in one task per conversation, which reads it in order and holds a batch of it.

Defined cases: null roles and texts are one space, null turns come first, a null conversation is one
like any other; rows of equal turn stand by role and text, so repeated rows follow each other and all
but the first are duplicates; white space is that of ASCII; empty tables give no rows; very long texts
pass through whole; further columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tickloom.llm.common import type_of
from tickloom.plans.lineage import cut_lineage

SPACE = " \t\n\v\f\r"
#: Last initial so far: none, or that of a system, user or assistant turn.
NONE, SYSTEM, USER, ASSISTANT = range(4)
INITIAL = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
#: States that may follow, by any edit that can bring them about; conversations end without turns or in an answer.
NEXT = {NONE: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
ENDS = (NONE, ASSISTANT)
NAMES = {USER: "user", ASSISTANT: "assistant"}
COSTS = {"K": 0, "R": 2, "D": 3, "I": 2}
TRUNCATED_COST = 1
#: Digits in ASCII order; zero ends the letters.
DIGITS = {"D": 1, "I": 2, "K": 3, "R": 4}
LETTERS = {d: c for c, d in DIGITS.items()}
WIDTH = 3
#: Rows of a block, whose letters make one integer.
BLOCK_ROWS = 48

Best = tuple[int, str]


@dataclass(frozen=True)
class Turn:
    """What the costs depend on."""

    initial: str
    fault: str | None


def _inserted(states: dict[int, tuple[int, int]], room: int) -> dict[int, tuple[int, int]]:
    """``states`` (weight, letters so far) after any number of inserts; a third one leads nowhere new."""
    out = dict(states)
    for _ in range(2):
        for state, (weight, at) in list(out.items()):
            for after in NEXT[state]:
                if after in NAMES:
                    reached = weight + (COSTS["I"] << WIDTH * room) + (DIGITS["I"] << WIDTH * (room - 1 - at))
                    if after not in out or reached < out[after][0]:
                        out[after] = (reached, at + 1)
    return out


def _edits(turn: Turn, state: int) -> Iterator[tuple[str, int, int]]:
    """``letter, state after, cost`` of what can be done with a row."""
    yield "D", state, COSTS["D"]
    if turn.fault in ("blank", "duplicate"):
        return
    extra = TRUNCATED_COST if turn.fault == "truncated" else 0
    for after in NEXT[state]:
        if INITIAL.get(turn.initial) == after:
            yield "K", after, COSTS["K"] + extra
        if after in NAMES:
            yield "R", after, COSTS["R"] + extra


def _letters(weight: int, room: int) -> Best:
    digits = [weight >> WIDTH * (room - 1 - at) & (1 << WIDTH) - 1 for at in range(room)]
    return weight >> WIDTH * room, "".join(LETTERS[d] for d in digits if d)


def block_best(turns: list[Turn], begin: int, last: bool) -> dict[int, Best]:
    """Smallest cost and letters from state ``begin`` over the rows to every state, through the inserts
    at the end if these are the ``last`` rows."""
    room = 3 * len(turns) + 2
    states = {begin: (0, 0)}
    for turn in turns:
        out: dict[int, tuple[int, int]] = {}
        for state, (weight, at) in _inserted(states, room).items():
            for letter, after, cost in _edits(turn, state):
                reached = weight + (cost << WIDTH * room) + (DIGITS[letter] << WIDTH * (room - 1 - at))
                if after not in out or reached < out[after][0]:
                    out[after] = (reached, at + 1)
        states = out
    if last:
        states = _inserted(states, room)
    return {state: _letters(weight, room) for state, (weight, _) in states.items()}


def chained(tables: list[dict[int, dict[int, Best]]], begin: int) -> dict[int, tuple[int, list[str]]]:
    """Cost and letters by part of the best way from ``begin`` over consecutive tables to every state.

    Ways to two states differ within the part where they split, so their order is kept as a rank.
    """
    costs, ranks = {begin: 0}, {begin: 0}
    back: list[dict[int, int]] = []
    for table in tables:
        best: dict[int, tuple[int, int, str, int]] = {}
        for state, cost in costs.items():
            for after, (more, letters) in table.get(state, {}).items():
                way = (cost + more, ranks[state], letters, state)
                if after not in best or way < best[after]:
                    best[after] = way
        order = sorted(best, key=lambda s: best[s][1:3])
        costs, ranks = {s: w[0] for s, w in best.items()}, {s: order.index(s) for s in best}
        back.append({s: w[3] for s, w in best.items()})
    out = {}
    for end, cost in costs.items():
        state, parts = end, []
        for table, before in zip(reversed(tables), reversed(back)):
            parts.append(table[before[state]][state][1])
            state = before[state]
        out[end] = (cost, parts[::-1])
    return out


def part_table(turns: list[Turn], begins: tuple[int, ...], last: bool) -> dict[int, dict[int, Best]]:
    """Best ways over the rows of a part from each of ``begins``, block by block."""
    cuts = list(range(0, len(turns), BLOCK_ROWS)) or [0]
    out = {}
    blocks = [
        {s: block_best(turns[c : c + BLOCK_ROWS], s, last and c == cuts[-1]) for s in (begins if c == 0 else range(4))} for c in cuts
    ]
    for begin in begins:
        out[begin] = {s: (cost, "".join(parts)) for s, (cost, parts) in chained(blocks, begin).items()}
    return out


def cheapest(ways: dict[int, Best]) -> Best:
    return min(ways[s] for s in ENDS if s in ways)


def applied(letters: str, rows: list, state: int) -> Iterator[tuple[str, object, str | None]]:
    """``letter, row or None, role or None`` of each edit: what it does to which row. A kept row has its
    own role, a deleted one none."""
    at = 0
    for letter in letters:
        row = None
        if letter != "I":
            row, at = rows[at], at + 1
        if letter == "D":
            yield letter, row, None
            continue
        after = INITIAL[row[1][:1]] if letter == "K" else ASSISTANT if state == USER else USER
        yield letter, row, row[1] if letter == "K" else NAMES[after]
        state = after


def fault_of(text: str, seen: bool) -> str | None:
    """The first fault of a row."""
    shown = text.rstrip(SPACE)
    if not shown:
        return "blank"
    if seen:
        return "duplicate"
    return None if shown[-1] in ".!?" else "truncated"


def _mark(row) -> bytes:
    return hashlib.blake2b(f"{len(row[1])}:{row[1]}{row[2]}".encode(), digest_size=20).digest()


@dataclass
class Counts:
    """Sums over consecutive rows, and what is needed to join two stretches of them."""

    rows: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    turns: int = 0
    low: int | None = None
    high: int | None = None
    first: str | None = None
    last: str | None = None

    def add(self, turn: int | None, initial: str, fault: str | None) -> None:
        if self.last is not None and self.last + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.first, self.last = initial if self.first is None else self.first, initial
        self.rows += 1
        if fault:
            setattr(self, fault, getattr(self, fault) + 1)
        if turn is not None and turn != self.high:
            self.turns, self.low, self.high = self.turns + 1, turn if self.low is None else self.low, turn

    def join(self, other: Counts) -> None:
        if not other.rows:
            return
        if self.last is not None and self.last + other.first not in ("su", "ua", "au"):
            self.illegal += 1
        for name in ("rows", "blank", "duplicate", "truncated", "illegal", "turns"):
            setattr(self, name, getattr(self, name) + getattr(other, name))
        if other.low is not None:
            self.turns -= other.low == self.high
            self.low, self.high = other.low if self.low is None else self.low, other.high
        self.first, self.last = other.first if self.first is None else self.first, other.last

    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns


def _turns_of(rows: list, repeated: set[bytes]) -> tuple[list[Turn], Counts]:
    """Faults and counts of consecutive rows (turn, role, text); ``repeated`` marks what came before them."""
    turns, counts, seen = [], Counts(), set(repeated)
    for row in rows:
        mark = _mark(row)
        fault = fault_of(row[2], mark in seen)
        seen.add(mark)
        counts.add(row[0], row[1][:1], fault)
        turns.append(Turn(row[1][:1], fault))
    return turns, counts


# --- the operator ----------------------------------------------------------------------------

_COUNTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


@dataclass
class Repaired:
    """``edits``: conv_id, part, step, edit, turn, role, text, in order by part and step; role and text
    are null where a row is deleted, the turn where one is inserted. ``conversations``: conv_id, gaps,
    blank, duplicate, truncated, illegal, cost, audit."""

    edits: DataFrame
    conversations: DataFrame
    _whole: DataFrame = field(repr=False)
    _border: DataFrame = field(repr=False)
    _rest: DataFrame = field(repr=False)

    def digests(self) -> DataFrame:
        """``conversations`` with ``repaired_sha256``, the digest of the repaired ``role:text`` lines."""
        rest = self._rest.where(F.col("edit") != "D").select("conv_id", "part", "step", "role", "text")
        rest = rest.repartition("conv_id").sortWithinPartitions("conv_id", "part", "step")
        lines = rest.mapInArrow(_hashed, f"_conv {type_of(rest, 'conv_id')}, repaired_sha256 string")
        named = self._border.join(lines, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").drop("_conv")
        nothing = hashlib.sha256(b"").hexdigest()
        return self._whole.unionByName(named.fillna({"repaired_sha256": nothing}))


def _rows_by_conversation(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, int, list]]:
    """``conv_id, slice, rows (turn, role, text)`` of a sorted partition."""
    current = None
    rows: list = []
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "slice", "turn", "role", "text")]
        for conv, part, *row in zip(*columns):
            if current is None or current[0] != conv:
                if current is not None:
                    yield *current, rows
                current, rows = (conv, part), []
            rows.append(row)
    if current is not None:
        yield *current, rows


def _inner(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, int, list, bool]]:
    """Conversations of a sorted partition, and whether they begin or end it and so may go on elsewhere."""
    held, first = None, True
    for one in _rows_by_conversation(batches):
        if held is not None:
            yield *held, first
            first = False
        held = one
    if held is not None:
        yield *held, True


def _emitter(schema: T.StructType, size: int = 2000):
    arrow = to_arrow_schema(schema)

    def emit(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        held, weight = [], 0
        for row in rows:
            held.append(row)
            weight += 100 + sum(len(x) for x in row if isinstance(x, (str, bytes)))
            if len(held) >= size or weight > 4_000_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), arrow)], schema=arrow)
                held, weight = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), arrow)], schema=arrow)

    return emit


def _edit_rows(conv, part: int, rows: list, letters: str, state: int) -> Iterator[tuple]:
    for step, (letter, row, role) in enumerate(applied(letters, rows, state)):
        text = None if letter == "D" else "" if row is None else row[2]
        yield conv, part, step, letter, None if row is None else row[0], role, text


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    current, digest = None, None
    for batch in batches:
        out = []
        for conv, role, text in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "role", "text")]):
            line = f"{role}:{text}".encode()
            if current is None or current[0] != conv:
                if current is not None:
                    out.append((current[0], digest.hexdigest()))
                current, digest = (conv,), hashlib.sha256(line)
            else:
                digest.update(b"\n" + line)
        kind = batch.schema.field("conv_id").type
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], kind), pa.array([x[1] for x in out], pa.string())], ["_conv", "repaired_sha256"])
    if current is not None:
        yield pa.RecordBatch.from_arrays([pa.array([current[0]], kind), pa.array([digest.hexdigest()])], ["_conv", "repaired_sha256"])


def laid_out(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """``conv_id, turn, role, text, slice``: rows in order, range-partitioned, and stored that way."""
    text = [F.coalesce(df[c].cast("string"), F.lit(" ")) for c in (role_col, text_col)]
    rows = df.select(df[conv_col].alias("conv_id"), df[turn_col].cast("long").alias("turn"), text[0].alias("role"), text[1].alias("text"))
    order = ("conv_id", "turn", "role", "text")
    count = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.repartitionByRange(count, *order).sortWithinPartitions(*order).withColumn("slice", F.spark_partition_id())
    return cut_lineage(placed)


def repair(
    df: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> Repaired:
    """The edits of all conversations, and what was wrong with each."""
    laid = laid_out(df, conv_col, turn_col, role_col, text_col)
    conv = type_of(laid, "conv_id")
    edit_schema = T._parse_datatype_string(f"conv_id {conv}, part int, step long, edit string, turn long, role string, text string")
    whole_schema = T._parse_datatype_string(f"conv_id {conv}, {_COUNTS}, repaired_sha256 string")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for key, part, rows, open_ in _inner(batches):
            if not open_:
                turns, counts = _turns_of(rows, set())
                yield key, part, rows, counts, cheapest(part_table(turns, (NONE,), True)[NONE])

    def whole_edits(batches):
        emit = _emitter(edit_schema)
        yield from emit(row for key, part, rows, _, (_, letters) in whole(batches) for row in _edit_rows(key, part, rows, letters, NONE))

    def whole_counts(batches):
        def each():
            for key, _, rows, c, (cost, letters) in whole(batches):
                lines = "\n".join(f"{role}:{row[2] if row else ''}" for letter, row, role in applied(letters, rows, NONE) if letter != "D")
                yield key, c.gaps(), c.blank, c.duplicate, c.truncated, c.illegal, cost, letters, hashlib.sha256(lines.encode()).hexdigest()

        yield from _emitter(whole_schema)(each())

    settled = laid.mapInArrow(whole_counts, whole_schema)

    # Parts of conversations at the borders of partitions: two a partition at most.
    seen_schema = T._parse_datatype_string(f"conv_id {conv}, slice int, mark binary")

    def marks(batches):
        def each():
            for key, part, rows, open_ in _inner(batches):
                if open_:
                    yield from ((key, part, m) for m in dict.fromkeys(map(_mark, rows)))
        yield from _emitter(seen_schema)(each())

    seen = cut_lineage(laid.mapInArrow(marks, seen_schema))
    parts = seen.select("conv_id", "slice").distinct()
    # A mark meets itself once a partition at most, so no key is large here.
    firsts = seen.groupBy(F.col("conv_id").alias("_conv"), F.col("mark").alias("_mark")).agg(F.min("slice").alias("_first"))
    again = seen.join(
        firsts, seen["conv_id"].eqNullSafe(firsts["_conv"]) & (seen["mark"] == firsts["_mark"]) & (seen["slice"] > firsts["_first"])
    ).select("conv_id", "slice", "mark")
    named = parts.select(F.col("conv_id").alias("_conv"), F.col("slice").alias("_slice"))
    at_border = laid.join(
        F.broadcast(named), laid["conv_id"].eqNullSafe(named["_conv"]) & (laid["slice"] == named["_slice"]), "left_semi"
    )

    table_schema = T._parse_datatype_string(
        f"conv_id {conv}, slice int, counts array<long>, first string, last string, "
        "ways array<struct<begin: int, end: int, cost: long, letters: string>>"
    )

    def part_of(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return to_arrow_schema(table_schema).empty_table()
        (key, part, rows), = _rows_by_conversation(iter(left.sort_by([("order", "ascending")]).to_batches()))
        turns, c = _turns_of(rows, set(right.column("mark").to_pylist()))
        # Only the last part takes the inserts at the end; chaining adds them.
        ways = [
            {"begin": begin, "end": end, "cost": cost, "letters": letters}
            for begin, found in part_table(turns, (NONE, SYSTEM, USER, ASSISTANT), False).items()
            for end, (cost, letters) in found.items()
        ]
        counts = [c.rows, c.blank, c.duplicate, c.truncated, c.illegal, c.turns, c.low, c.high]
        row = [key, part, counts, c.first, c.last, ways]
        return pa.Table.from_arrays([pa.array([x], f.type) for x, f in zip(row, to_arrow_schema(table_schema))], schema=to_arrow_schema(table_schema))

    ordered = at_border.withColumn("order", F.monotonically_increasing_id())
    tables = cut_lineage(
        ordered.groupBy("conv_id", "slice").cogroup(again.groupBy("conv_id", "slice")).applyInArrow(part_of, table_schema)
    )

    chosen_schema = T._parse_datatype_string(f"conv_id {conv}, slice int, state int, letters string, {_COUNTS}")

    def choose(group: pa.Table) -> pa.Table:
        found = sorted(group.to_pylist(), key=lambda r: r["slice"])
        total = Counts()
        ways = []
        for r in found:
            total.join(Counts(*r["counts"], r["first"], r["last"]))
            table: dict[int, dict[int, Best]] = {}
            for w in r["ways"]:
                table.setdefault(w["begin"], {})[w["end"]] = (w["cost"], w["letters"])
            ways.append(table)
        ways.append({s: block_best([], s, True) for s in range(4)})
        ends = chained(ways, NONE)
        cost, parts = min((ends[s] for s in ENDS if s in ends), key=lambda x: (x[0], "".join(x[1])))
        state, out = NONE, []
        for r, table, letters in zip(found, ways, parts):
            out.append([r["conv_id"], r["slice"], state, letters])
            state = next(e for e, (_, x) in table[state].items() if x == letters)
        out[-1][3] += parts[-1]
        summary = [total.gaps(), total.blank, total.duplicate, total.truncated, total.illegal, cost, "".join(parts)]
        rows = [[*r, *(summary if i == 0 else [None] * len(summary))] for i, r in enumerate(out)]
        schema = to_arrow_schema(chosen_schema)
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    chosen = cut_lineage(tables.groupBy("conv_id").applyInArrow(choose, chosen_schema))

    def part_edits(left: pa.Table, right: pa.Table) -> pa.Table:
        schema = to_arrow_schema(edit_schema)
        if not left.num_rows:
            return schema.empty_table()
        (key, part, rows), = _rows_by_conversation(iter(left.sort_by([("order", "ascending")]).to_batches()))
        out = list(_edit_rows(key, part, rows, right.column("letters")[0].as_py(), right.column("state")[0].as_py()))
        return pa.Table.from_arrays([pa.array([r[k] for r in out], f.type) for k, f in enumerate(schema)], schema=schema)

    rest = ordered.groupBy("conv_id", "slice").cogroup(chosen.groupBy("conv_id", "slice")).applyInArrow(part_edits, edit_schema)
    border = chosen.where("cost is not null").drop("slice", "state", "letters")
    return Repaired(
        laid.mapInArrow(whole_edits, edit_schema).unionByName(rest),
        settled.drop("repaired_sha256").unionByName(border),
        settled,
        border,
        rest,
    )


# --- the query -------------------------------------------------------------------------------


def damaged(df: DataFrame) -> DataFrame:
    """Rows of conversations with faults that the checksum of ``conv_id:turn`` chooses."""
    name = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    key = F.concat(name[0], F.lit(":"), name[1])
    rows = df.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        (F.crc32(key.cast("binary")) % 20).alias("fault"),
    ).where("fault <> 0")
    fault = F.col("fault")
    text = F.when(fault == 1, "").when(fault == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(fault == 3, 2).otherwise(1)))
    return rows.select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("copy")
    ).drop("copy")


def repair_digests(df: DataFrame) -> DataFrame:
    """Per conversation of ``df``: faults after damage, cost and letters of the repair, digest of its lines."""
    found = repair(damaged(df)).digests()
    named = df.select(F.col("conv_id").alias("_conv")).distinct()
    every = named.join(found, F.col("_conv").eqNullSafe(F.col("conv_id")), "left").drop("conv_id")
    zeros = {c: 0 for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    filled = every.fillna(zeros | {"audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()})
    return filled.select(F.col("_conv").alias("conv_id"), *zeros, "audit", "repaired_sha256")
