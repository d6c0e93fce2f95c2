"""Substring deduplication by bytes: matching statistics against a run-length index.

Passages that recur are found and brought to the shards of documents where they occur (``passages``).
A shard builds a run-compressed Burrows-Wheeler transform of its passages, with text positions sampled
at the ends of runs, and streams its documents through it from right to left: the state is one row of
the transform with its text position and the length of the match. Where the next byte differs, the
match goes on from the nearer run of that byte, above or below, whichever shares more of the match.
Rows that agree on a whole passage form intervals, each with the smallest document in it, so a match of
full length is marked only if a document with a smaller id holds it.

Defined cases: a null text is empty; a null id is larger than every other and equal to other nulls, so
copies among null ids stay; rows of one id never remove bytes from each other; repeated rows come out
once each; texts below the length keep all their bytes; an empty table gives no rows. Ids are integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tickloom.llm.common import column, small_batches
from tickloom.llm.passages import NULL_FROM, Document, Symbols, from_rest, in_parts, recurring

LENGTH, GRAM = 50, 20
#: Longest stretch of one lane, and lanes that are streamed side by side.
LANE, SIDE_BY_SIDE = 512, 8_192
SCHEMA = "doc_id long, n_bytes long, n_removed long, starts array<int>, ends array<int>, kept binary, rest string"


def _codes(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8)


def _joined(data: bytes, begin: int, end: int) -> bytes:
    return data[begin:end]


def _words(symbols: np.ndarray) -> np.ndarray:
    """Seven symbols of 9 bits from each place on as one number that compares like them."""
    out = np.zeros(len(symbols), np.int64)
    padded = np.concatenate([symbols.astype(np.int64), np.zeros(7, np.int64)])
    for i in range(7):
        out = (out << 9) | padded[i : i + len(symbols)]
    return out


def suffix_array(symbols: np.ndarray, words: np.ndarray, length: int) -> tuple[np.ndarray, int, np.ndarray]:
    """Order of all suffixes, by seven symbols at once, then ties alone by doubling; and numbers that are
    equal for suffixes that begin with the same symbols, with how many those are: ``length`` at most."""
    n = len(symbols)
    order = np.argsort(words)
    in_order = words[order]
    new = np.concatenate([[True], in_order[1:] != in_order[:-1]])
    del in_order
    first = np.flatnonzero(new)
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[order] = np.repeat(first, np.diff(first, append=n))
    size = 7
    tied = _tied(new)
    alike, common = rank.copy(), size
    while len(tied):
        if common < size <= length:
            alike, common = rank.copy(), size
        at = order[tied]
        group = rank[at]
        after = rank[np.minimum(at + size, n)]
        sub = np.argsort(group * (n + 1) + after + 1)  # by group, then by what follows, as one number
        at, group, after = at[sub], group[sub], after[sub]
        order[tied] = at  # groups stay where they were: their ranks are places
        head = np.concatenate([[True], (group[1:] != group[:-1]) | (after[1:] != after[:-1])])
        rank[at] = tied[np.flatnonzero(head)][np.cumsum(head) - 1]
        tied = tied[_tied(head)]
        size *= 2
    return order, common, alike


def _tied(head: np.ndarray) -> np.ndarray:
    """Places in groups of more than one."""
    last = np.concatenate([head[1:], [True]])
    return np.flatnonzero(~(head & last))


class Heads:
    """Places among ``n``, one bit each, and how many there are up to any place: two look-ups and a count of bits."""

    def __init__(self, places: np.ndarray, n: int):
        marks = np.zeros((n + 64) // 64 * 64, np.uint8)
        marks[places] = 1
        self.bits = np.packbits(marks, bitorder="little").view("<u8")
        counts = np.bitwise_count(self.bits).astype(np.int64)
        self.before = np.cumsum(counts) - counts

    def upto(self, rows: np.ndarray) -> np.ndarray:
        """Number of places at most at each row."""
        word = rows >> 6
        return self.before[word] + np.bitwise_count(self.bits[word] << (63 - (rows & 63)).astype(np.uint64))


class RunIndex:
    """Run-compressed transform of passages with text positions at run ends."""

    def __init__(self, passages: list[tuple[int, bytes]], length: int):
        self.length = length
        texts = [np.frombuffer(t, np.uint8).astype(np.int16) + 1 for _, t in passages]
        gap = np.zeros(1, np.int16)
        self.text = np.concatenate([gap] + [x for t in texts for x in (t, gap)])
        owned = [1, *[len(t) + 1 for t in texts]]
        owners = np.array([NULL_FROM, *[who for who, _ in passages]], np.int64)
        del texts
        self.words = _words(self.text)
        order, common, alike = suffix_array(self.text, self.words, length)
        n = len(order)
        before = self.text[order - 1]  # of the first symbol, the last one: the transform is a circle
        head = np.concatenate([[True], before[1:] != before[:-1]])
        self.starts = np.flatnonzero(head)
        self.ends = np.append(self.starts[1:], n) - 1
        self.run_heads = Heads(self.starts, n)
        self.symbol = before[self.starts]
        self.first_at, self.last_at = order[self.starts], order[self.ends]
        # Rows of a symbol's runs go, in order, to the rows that begin with it.
        sizes = self.ends - self.starts + 1
        by_symbol = np.argsort(self.symbol, kind="stable")
        mapped = np.cumsum(sizes[by_symbol]) - sizes[by_symbol]
        self.maps_to = np.empty(len(sizes), np.int64)
        self.maps_to[by_symbol] = mapped
        self.runs_by_symbol = by_symbol
        counts = np.bincount(self.symbol, minlength=257)
        self.symbol_from = np.concatenate([[0], np.cumsum(counts)])
        # Key of a run: its symbol, then its place; a search finds the nearest run of a symbol.
        self.run_keys = self.symbol[by_symbol].astype(np.int64) * n + self.starts[by_symbol]
        self.n = n
        # Intervals of rows that agree on a whole passage, with the smallest document of each.
        self.words = np.append(self.words, np.zeros(length + 8, np.int64))
        gaps = np.flatnonzero(self.text == 0)
        self.until_gap = gaps[np.cumsum(self.text == 0) - (self.text == 0)] - np.arange(n)
        one, two = order[:-1], order[1:]
        if common <= length <= 2 * common:  # a passage is two overlapping parts of that size
            rest = length - common
            same = (alike[one] == alike[two]) & (alike[np.minimum(one + rest, n)] == alike[np.minimum(two + rest, n)])
            same &= self.until_gap[one] >= length
        else:
            same = self._shared(one, two, np.full(n - 1, length)) >= length
        opens = np.flatnonzero(np.concatenate([[True], ~same]))
        self.intervals, self.least = Heads(opens, n), np.minimum.reduceat(np.repeat(owners, owned)[order], opens)
        self.root = (0, int(order[0]))

    def _shared(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Equal symbols from two places on, none across a gap, counted up to ``most`` of each pair."""
        out, differ = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
        live = np.flatnonzero(most > 0)
        step = 0
        while len(live):
            here = self.words[a[live] + step] ^ self.words[b[live] + step]
            out[live], differ[live] = step, here
            step += 7
            live = live[(here == 0) & (most[live] > step)]
        for shift in range(0, 63, 9):  # symbols of the first words that differ; the first symbol is the highest
            out += differ < (1 << shift)
        return np.minimum(np.minimum(out, self.until_gap[a]), most)

    def statistics(self, lanes: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """For each lane (a row of symbols, 0 where it has none), the places where a passage begins that
        a smaller document than the lane's holds. Lanes go side by side, from right to left."""
        lengths = (lanes != 0).sum(axis=1)
        order = np.argsort(-lengths, kind="stable")  # those that still go on at a place come first
        going = np.searchsorted(-lengths[order], -np.arange(lanes.shape[1]), "left")
        columns = np.ascontiguousarray(lanes[order].T)
        ids = ids[order]
        rows = np.full(len(lanes), self.root[0], np.int64)
        ats = np.full(len(lanes), self.root[1], np.int64)
        sizes = np.zeros(len(lanes), np.int64)
        out = np.zeros(columns.shape, bool)
        for j in range(lanes.shape[1] - 1, -1, -1):
            k = going[j]
            if not k:
                continue
            row, at, size = rows[:k], ats[:k], sizes[:k]
            symbol = columns[j, :k].astype(np.int64)
            run = self.run_heads.upto(row) - 1
            other = np.flatnonzero(self.symbol[run] != symbol)
            if len(other):
                self._turn(other, symbol, row, at, size, run)
            known = size >= 0
            row[:] = np.where(known, self.maps_to[run] + row - self.starts[run], self.root[0])
            at[:] = np.where(known, at - 1, self.root[1])
            size[:] = np.where(known, np.minimum(size + 1, self.length), 0)
            full = np.flatnonzero(size >= self.length)
            if len(full):
                out[j, full] = self.least[self.intervals.upto(row[full]) - 1] < ids[full]
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return out.T[back]

    def _turn(self, other: np.ndarray, symbol: np.ndarray, row: np.ndarray, at: np.ndarray, size: np.ndarray, run: np.ndarray) -> None:
        """Moves lanes whose next symbol differs to the nearest run of it; size -1 where there is none."""
        c = symbol[other]
        low, high = self.symbol_from[c], self.symbol_from[c + 1]
        none = (low == high) | (c == 0)
        size[other[none]] = -1
        other, c, low, high = (x[~none] for x in (other, c, low, high))
        place = np.searchsorted(self.run_keys, c * self.n + row[other], "right")
        above, below = place - 1, place
        has_above, has_below = above >= low, below < high
        up = self.runs_by_symbol[np.where(has_above, above, below)]
        down = self.runs_by_symbol[np.where(has_below, below, above)]
        up_at, down_at = self.last_at[up], self.first_at[down]
        up_at, down_at = np.where(has_above, up_at, down_at), np.where(has_below, down_at, up_at)
        most = size[other]
        shared = self._shared(np.tile(at[other], 2), np.concatenate([up_at, down_at]), np.tile(most, 2))
        up_size, down_size = shared[: len(most)], shared[len(most) :]
        take_up = has_above & (~has_below | (up_size >= down_size))
        size[other] = np.where(take_up, up_size, down_size)
        at[other] = np.where(take_up, up_at, down_at)
        run[other] = np.where(take_up, up, down)
        row[other] = np.where(take_up, self.ends[up], self.starts[down])


def _cut(begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of one lane at most: where each begins and ends, and of which it is a part."""
    counts = -(-(ends - begins) // LANE)
    which = np.repeat(np.arange(len(begins)), counts)
    nth = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
    first = begins[which] + nth * LANE
    return first, np.minimum(first + LANE, ends[which]), which


def _lanes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of symbols cut into lanes that overlap by a passage, as wide as the longest needs: lanes,
    where each begins, and its stretch."""
    first, last, which = _cut(begins, ends)
    sizes = last - first + length - 1
    width = int(sizes.max(initial=0))
    padded = np.concatenate([data, np.zeros(width, data.dtype)])
    lanes = np.lib.stride_tricks.sliding_window_view(padded, width)[first]
    lanes[np.arange(width) >= sizes[:, None]] = 0
    return lanes, first, which


def _lane_groups(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The same lanes, a few of like length at a time: the many short stretches of short texts take about
    as much room as they have symbols, and no more than one group of lanes is there at once."""
    first, last, which = _cut(begins, ends)
    order = np.argsort(first - last, kind="stable")
    for begin in range(0, len(order), SIDE_BY_SIDE):
        some = order[begin : begin + SIDE_BY_SIDE]
        yield _lanes(data, first[some], last[some], length)[0], first[some], which[some]


def drop_repeated_bytes(
    df: DataFrame, *, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text", rest: Column | None = None,
    characters: bool = False,
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, starts, ends, kept, rest``: byte spans removed, and the bytes that stay,
    with ``characters`` as a string, without bytes of characters that were cut in two."""
    kind = Symbols(length, min(gram, length), _encoded, _codes, _joined)

    def locate(docs: list[Document], passages: list[tuple[int, bytes, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        raw = [x.text.encode("utf-8") for x in docs]
        owners: dict[bytes, int] = {}
        for owner, text, _ in passages:
            owners[text] = min(owner, owners.get(text, NULL_FROM))
        covered = _covered(kind, [x.doc_id for x in docs], raw, [(o, t) for t, o in owners.items()])
        rows = []
        for (doc_id, _, more), data, marks in zip(docs, raw, covered):
            if marks is None:
                rows.append((doc_id, len(data), 0, (), (), data.decode("utf-8") if characters else data, more))
                continue
            edges = np.flatnonzero(np.diff(np.concatenate([[0], marks.astype(np.int8), [0]])))
            kept = np.frombuffer(data, np.uint8)[~marks].tobytes()
            kept = kept.decode("utf-8", "ignore") if characters else kept
            rows.append((doc_id, len(data), int(marks.sum()), edges[::2], edges[1::2], kept, more))
        ids = pa.array([None if r[0] >= NULL_FROM else r[0] for r in rows], pa.int64())
        types = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.string() if characters else pa.binary(), pa.string()]
        columns = [pa.array([r[i + 1] for r in rows], t) for i, t in enumerate(types)]
        yield pa.RecordBatch.from_arrays([ids, *columns], ["doc_id", "n_bytes", "n_removed", "starts", "ends", "kept", "rest"])

    return recurring(df, kind, locate, SCHEMA.replace("kept binary", "kept string") if characters else SCHEMA, id_col=id_col, text_col=text_col, rest=rest)


def _encoded(text: str) -> bytes:
    return text.encode("utf-8")


def _covered(kind: Symbols, ids: list[int], raw: list[bytes], passages: list[tuple[int, bytes]]) -> list[np.ndarray | None]:
    """Per document the bytes to remove, or None where there are none."""
    out: list[np.ndarray | None] = [None] * len(raw)
    if not passages or not raw:
        return out
    # Only windows with an anchor that some passage has can match: the others are not streamed.
    anchors = [b.anchors()[1] for _, b in in_parts(kind, [_codes(t) for _, t in passages])]
    known = np.unique(np.concatenate(anchors))
    sizes = np.array([len(x) for x in raw], np.int64)
    starts = np.cumsum(sizes) - sizes
    parts = []
    for documents, batch in in_parts(kind, [_codes(x) for x in raw]):
        at, anchor = batch.anchors()
        at = at[known[np.minimum(np.searchsorted(known, anchor), len(known) - 1)] == anchor] if len(known) else at[:0]
        row = batch.document(at)
        place = at - batch.starts[row]
        parts.append((documents[row], np.maximum(place - kind.pad, 0), np.minimum(place, batch.sizes[row] - kind.length) + 1))
    which, begin, end = (np.concatenate(x) for x in zip(*parts))  # first places of windows
    fits = end > begin
    which, begin, end = which[fits], begin[fits] + starts[which[fits]], end[fits] + starts[which[fits]]
    if not len(begin):
        return out
    heads = np.flatnonzero(np.concatenate([[True], (begin[1:] > end[:-1]) | (which[1:] != which[:-1])]))
    begin, which, end = begin[heads], which[heads], np.append(end[heads[1:] - 1], end[-1])
    index = RunIndex(passages, kind.length)
    flat = np.frombuffer(b"".join(raw), np.uint8).astype(np.int16) + 1
    limit = np.array([min(i, NULL_FROM) for i in ids], np.int64)
    found = np.zeros(len(flat) + 1, bool)
    for lanes, first, part in _lane_groups(flat, begin, end, kind.length):
        hit, j = np.nonzero(index.statistics(lanes, limit[which[part]]))
        found[first[hit] + j + 1] = True
    upto = np.cumsum(found, dtype=np.int32)
    covered = np.concatenate([upto[1 : kind.length] > 0, upto[kind.length :] > upto[: len(upto) - kind.length]])
    for k in np.unique(which).tolist():
        marks = covered[starts[k] : starts[k] + sizes[k]]
        if marks.any():
            out[k] = marks
    return out


def without_repeats(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", n_chars_col: str = "n_chars") -> DataFrame:
    """``df`` with the bytes of repeated passages gone from its texts.

    Bytes of a character that a passage cut in two go with it. A row of whose text no word is left goes;
    rows that hold no repeated passage stay as they are, null and white texts too. ``n_chars_col``, where
    there is one, is counted anew in texts that change; all other columns keep their values.
    """
    columns = df.columns
    fields = [column(df, c).alias(str(i)) if c != text_col else column(df, c).isNull().alias(str(i)) for i, c in enumerate(columns)]
    found = drop_repeated_bytes(df, id_col=id_col, text_col=text_col, rest=F.struct(*fields), characters=True)
    left = found.where((F.col("n_removed") == 0) | F.col("kept").rlike(r"[^\x20\x09-\x0D]"))
    schema = df.schema
    text_at, chars_at = columns.index(text_col), columns.index(n_chars_col) if n_chars_col in columns else -1

    def restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = to_arrow_schema(schema)
        for batch in small_batches(batches, "kept"):
            rows = []
            for removed, kept, rest in zip(*[batch.column(c).to_pylist() for c in ("n_removed", "kept", "rest")]):
                row = list(from_rest(rest))
                row[text_at] = None if row[text_at] else kept
                if removed and chars_at >= 0:
                    row[chars_at] = len(kept)
                rows.append(row)
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(target)], schema=target)

    return left.select("n_removed", "kept", "rest").mapInArrow(restore, schema)


def byte_digests(df: DataFrame) -> DataFrame:
    found = drop_repeated_bytes(df)
    return found.select("doc_id", "n_bytes", "n_removed", F.size("starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
