"""Periodic runs in sequences of words: blocks meet their copies by exact convolution, seeds are extended.

A run is a stretch of words that repeats with its smallest period q for at least ``max(12, 2 q)`` words
and that no neighbouring word continues. The words of many documents stand in one sequence, with a word
of its own between two documents, so no run crosses documents. A run contains, among the words that come
again q words later, an aligned block of B words for the dyadic B with ``2 B - 1 <= q <= 4 B - 2``. For
every such block, the sum of squared differences to all windows that follow at those distances is one
convolution, done exactly by a number theoretic transform; where it is zero the block occurs again, and
the distance is a seed that is extended both ways by comparing words. Blocks with a word that does not
come again within reach, and blocks deep inside a run already known whose period is no longer than the
block, have nothing to find and are left out before the transform. Both tests lose nothing.

Defined cases: a null or empty text has no words and no runs; a null id is never given planted
repetitions; repeated rows are rows of their own; an empty table gives no rows; further columns are not
read, whatever their names. Memory is that of a few megabytes of text, or of one longer text: a text is
one row and is worked on whole. Ties for the greatest run go to the smaller start, then the period.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tickloom.llm.common import small_batches, texts_of, type_of

LEAST = 12
#: Prime with roots of unity of order 2^23, and a generator of its group.
PRIME, GENERATOR, ROOTS = 998_244_353, 3, 23
#: Numbers held in one transform: blocks beyond that are transformed in further rounds.
POINTS = 1 << 20


def _powers(size: int, inverse: bool) -> list[np.ndarray]:
    """Twiddle factors of each stage of a transform of ``size`` points."""
    out = []
    half = 1
    while half < size:
        root = pow(GENERATOR, (PRIME - 1) // (2 * half), PRIME)
        if inverse:
            root = pow(root, PRIME - 2, PRIME)
        powers = np.ones(half, np.uint64)
        done = 1
        while done < half:
            step = np.uint64(pow(root, done, PRIME))
            powers[done : 2 * done] = powers[:done] * step % PRIME
            done *= 2
        out.append(powers)
        half *= 2
    return out


def transform(rows: np.ndarray, inverse: bool = False) -> np.ndarray:
    """Number theoretic transform of each row (a power of two of residues); the inverse divides."""
    size = rows.shape[1]
    if size > 1 << ROOTS:
        raise ValueError(f"transforms have at most {1 << ROOTS} points")
    bits = size.bit_length() - 1
    order = np.arange(size)
    turned = np.zeros(size, np.int64)
    for _ in range(bits):
        turned, order = turned << 1 | order & 1, order >> 1
    x = rows[:, turned].astype(np.uint64)
    for powers in _powers(size, inverse):
        half = len(powers)
        pairs = x.reshape(len(x), -1, 2, half)
        odd = pairs[:, :, 1] * powers % PRIME
        even = pairs[:, :, 0].copy()
        pairs[:, :, 0] = (even + odd) % PRIME
        pairs[:, :, 1] = (even + np.uint64(PRIME) - odd) % PRIME
    if inverse:
        x = x * np.uint64(pow(size, PRIME - 2, PRIME)) % PRIME
    return x


def occurrences(words: np.ndarray, blocks: np.ndarray, width: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """``start, distance``: where blocks of ``width`` words come again ``low`` to ``high`` words later,
    as far as squared differences add up to zero modulo the prime. ``words`` are residues."""
    reach = high - low + 1
    size = 1
    while size < width + reach - 1:
        size *= 2
    squares = np.concatenate([[0], np.cumsum(words * words % PRIME, dtype=np.uint64)]).astype(np.uint64)
    found = []
    end = len(words)
    for begin in range(0, len(blocks), max(1, POINTS // size)):
        at = blocks[begin : begin + max(1, POINTS // size)]
        own = np.zeros((len(at), size), np.uint64)
        own[:, :width] = words[at[:, None] + np.arange(width)][:, ::-1]
        places = at[:, None] + low + np.arange(width + reach - 1)
        seen = np.zeros((len(at), size), np.uint64)
        seen[:, : width + reach - 1] = np.where(places < end, words[np.minimum(places, end - 1)], 0)
        crossed = transform(transform(own) * transform(seen) % PRIME, inverse=True)[:, width - 1 : width - 1 + reach]
        starts = at[:, None] + low + np.arange(reach)
        inside = starts + width <= end
        starts = np.minimum(starts, end - width)
        alike = (squares[at + width] - squares[at])[:, None] + (squares[starts + width] - squares[starts])
        zero = (alike + 2 * (np.uint64(PRIME) - crossed)) % PRIME == 0
        block, distance = np.nonzero(zero & inside)
        found.append((at[block], distance + low))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found))


def _matched(words: np.ndarray, a: int, b: int, step: int) -> int:
    """How many words from ``a`` on (``step`` 1) or before ``a`` (``step`` -1) equal those at ``b``; a < b."""
    count, chunk = 0, 16
    limit = len(words) - b if step > 0 else a
    while count < limit:
        chunk = min(chunk, limit - count)
        if step > 0:
            same = words[a + count : a + count + chunk] == words[b + count : b + count + chunk]
        else:
            same = (words[a - count - chunk : a - count] == words[b - count - chunk : b - count])[::-1]
        if not same.all():
            return count + int(np.argmin(same))
        count += chunk
        chunk *= 2
    return limit


class _Found:
    """Runs found so far, and for every word the one that reaches furthest to the right over it."""

    def __init__(self, n: int):
        self.runs: list[tuple[int, int, int]] = []
        self.reach = np.zeros(n, np.int64)
        self.period = np.ones(n, np.int64)

    def add(self, start: int, end: int, period: int) -> None:
        self.runs.append((start, end, period))
        part = slice(start, end)
        further = self.reach[part] < end
        self.reach[part][further] = end
        self.period[part][further] = period


def _scales(longest: int) -> Iterator[tuple[int, int, int]]:
    """``width, low, high``: block widths and the periods they find. Runs of periods under 6 are longer
    than two periods, so blocks of four words lie in them as well."""
    yield 4, 1, 14
    yield 2, 6, 6
    width = 8
    while 2 * width - 1 <= longest // 2:
        yield width, 2 * width - 1, 4 * width - 2
        width *= 2


def runs_of(words: np.ndarray, longest: int) -> list[tuple[int, int, int]]:
    """``start, end, period`` of all runs in a sequence of numbers whose equal numbers are equal words.
    No run is longer than ``longest``."""
    n = len(words)
    order = np.argsort(words, kind="stable")
    gap = np.full(n, n, np.int64)
    again = words[order[1:]] == words[order[:-1]]
    gap[order[:-1][again]] = np.diff(order)[again]
    # Most words of most texts do not come again soon: bound the gaps of each aligned block once a scale.
    residues = (words % PRIME).astype(np.uint64)
    found = _Found(n)
    worst, held = gap, 1
    todo = list(_scales(longest))
    seeds: list[tuple[int, np.ndarray, np.ndarray]] = []
    for k, (width, low, high) in enumerate(todo):
        blocks = np.arange(0, n - width + 1, width)
        if width >= held:
            step = width // held
            worst = worst[: len(worst) // step * step].reshape(-1, step).max(axis=1)
            held = width
            largest = worst
        else:  # the narrow blocks of period 6
            largest = gap[: len(gap) // width * width].reshape(-1, width).max(axis=1)
        live = blocks[largest[: len(blocks)] <= high]
        # Deep inside a run with a period up to the width: copies are whole periods away.
        inner = (found.reach[live] >= live + high + width) & (found.period[live] <= width)
        live = live[~inner]
        if len(live):
            at, distance = occurrences(residues, live, width, low, high)
            seeds.append((width, at, distance))
        if k == 0 and len(todo) > 1:  # periods up to 14 are extended together, the shorter first
            continue
        _extend(words, found, seeds)
        seeds = []
    _extend(words, found, seeds)
    return sorted(found.runs, key=lambda r: (r[0], r[2]))


def _extend(words: np.ndarray, found: _Found, seeds: list[tuple[int, np.ndarray, np.ndarray]]) -> None:
    if not seeds:
        return
    width = np.concatenate([np.full(len(a), w) for w, a, _ in seeds])
    at = np.concatenate([a for _, a, _ in seeds])
    distance = np.concatenate([d for _, _, d in seeds])
    order = np.lexsort((at, distance))
    width, at, distance = width[order], at[order], distance[order]
    firsts = np.flatnonzero(np.diff(distance, prepend=-1))
    for begin, stop in zip(firsts, [*firsts[1:], len(at)]):
        d = int(distance[begin])
        here, wide = at[begin:stop], width[begin:stop]
        # A seed inside a known run whose period divides the distance leads back to that run.
        known = (found.reach[here] >= here + wide + d) & (d % found.period[here] == 0)
        here, wide = here[~known], wide[~known]
        i = 0
        while i < len(here):
            a, w = int(here[i]), int(wide[i])
            i += 1
            if not np.array_equal(words[a : a + w], words[a + d : a + d + w]):
                continue
            start = a - _matched(words, a, a + d, -1)
            end = a + d + w + _matched(words, a + w, a + d + w, 1)
            whole = end - start >= max(LEAST, 2 * d)
            if whole and not (found.reach[start] >= end and found.period[start] < d):
                found.add(start, end, d)
            i = int(np.searchsorted(here, end - d))


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words of one document in ten, by its id, with its words from some place on repeated."""
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    cycle = words[a : a + p]
    return words[:a] + (cycle * (-(-(n - a) // p)))[: n - a]


def document_runs(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """``start, length, period`` of the runs of each list of words."""
    flat = pa.array([w for words in texts for w in [*words, b""]], pa.binary())
    sizes = np.array([len(words) + 1 for words in texts], np.int64)
    ends = np.cumsum(sizes)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not len(texts):
        return out
    encoded = flat.dictionary_encode()
    codes = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    # A number that no word has ends every document.
    codes[ends - 1] = len(encoded.dictionary) + np.arange(len(texts))
    longest = int(sizes.max()) - 1
    if longest < LEAST:
        return out
    found = runs_of(codes, longest)
    owners = np.searchsorted(ends, [s for s, _, _ in found], side="right")
    for (start, end, period), doc in zip(found, owners):
        out[doc].append((int(start - (ends[doc] - sizes[doc])), int(end - start), int(period)))
    return out


def periodic_runs(df: DataFrame, *, plant: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` per row: runs as (start, length, period) by start, then period,
    and the words left, space-joined, when each run keeps its first period. ``plant`` repeats words first."""
    docs = texts_of(df, id_col, text_col)
    schema = (
        f"doc_id {type_of(docs, 'doc_id')}, n_words long, "
        "runs array<struct<start: long, length: long, period: long>>, collapsed string"
    )
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            ids = batch.column("doc_id")
            texts = [t.encode("utf-8").split() for t in batch.column("text").to_pylist()]
            if plant:
                texts = [planted(words, i) for words, i in zip(texts, ids.to_pylist())]
            found = document_runs(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array([len(words) for words in texts], pa.int64()),
                    pa.array([[{"start": s, "length": n, "period": p} for s, n, p in runs] for runs in found], run_type),
                    pa.array([b" ".join(_collapsed(w, r)).decode("utf-8") for w, r in zip(texts, found)], pa.string()),
                ],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    return docs.mapInArrow(run, schema)


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    if not runs:
        return words
    dropped = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        dropped[start + period] += 1
        dropped[start + length] -= 1
    return [w for w, x in zip(words, np.cumsum(dropped)) if x == 0]


def run_digests(df: DataFrame) -> DataFrame:
    """Per document: number of runs, the greatest one, digests of all runs and of the words left."""
    from pyspark.sql import functions as F

    found = periodic_runs(df, plant=True)
    best = F.array_min(
        F.transform("runs", lambda r: F.struct((-r["length"]).alias("n"), r["start"].alias("start"), r["period"].alias("period")))
    )
    listed = F.array_join(
        F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"])), ""
    )
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        (-F.col("best.n")).alias("length"),
        F.col("best.period").alias("period"),
        F.expr("(1000 * -best.n) div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


__all__ = ["document_runs", "occurrences", "periodic_runs", "planted", "run_digests", "runs_of", "transform"]
