"""Nearest neighbours by inner product: a block matrix join with int8 tiles and exact answers.

Vectors are quantised to int8, and blocks of queries meet blocks of candidates. A tile's integer
products give every score with a bound on its error, so pairs that cannot be among the nearest are
dropped by proof; the others are computed in double precision from the original vectors. Heaps merge
the nearest of tiles. Work is queries times rows, in blocks; a task holds one block of queries and a
stated number of blocks of candidates. The result does not depend on block sizes.

Defined cases: rows with a null id, and vectors that are null, empty, zero or hold a null or
non-finite component, take no part; vectors of different lengths are not compared; rows of a query's
own id are no candidates for it; repeated rows (same id and vector) count once; ties go to the smaller
id; a query without candidates gives no rows, so an empty table gives none. Components may be as large or
as small as doubles are: bounds are worked out on vectors scaled by powers of two. A product beyond
doubles is infinite, and a sum of infinities of both signs counts as minus infinity. Columns other than
the two named are not read, whatever their names.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a block, and blocks of candidates and of queries that one task holds.
BLOCK_ROWS, CANDIDATE_BLOCKS, QUERY_BLOCKS = 2_048, 8, 2


def usable(vector: Column) -> Column:
    """Neither null, empty nor zero, and every component finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0)


def quantise(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows, their scales, and the length of what rounding took from each row."""
    scale = np.abs(vectors).max(axis=1) / 127.0
    scale[scale == 0] = np.finfo(np.float64).tiny
    small = np.clip(np.rint(vectors / scale[:, None]), -127, 127).astype(np.int8)
    return small, scale, np.linalg.norm(vectors - small * scale[:, None], axis=1)


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products: float32 holds sums of a thousand int8 products without rounding."""
    total = np.zeros((len(a), len(b)))
    for k in range(0, a.shape[1], 1000):
        total += a[:, k : k + 1000].astype(np.float32) @ b[:, k : k + 1000].astype(np.float32).T
    return total


class _Block:
    """Vectors of one block with their int8 form; scores are exact for float32 and float64 input."""

    def __init__(self, ids: bytes, vectors: bytes, size: int):
        self.ids = np.frombuffer(ids, np.int64)
        self.vectors = np.frombuffer(vectors, np.float64).reshape(-1, size)
        # Largest components between a half and one: squares neither overflow nor vanish.
        self.exponent = np.frexp(np.abs(self.vectors).max(axis=1))[1]
        scaled = np.ldexp(self.vectors, -self.exponent[:, None])
        self.small, self.scale, self.lost = quantise(scaled)
        self.norm = np.linalg.norm(scaled, axis=1)
        self.by_id = np.argsort(self.ids, kind="stable")
        first = np.flatnonzero(np.diff(self.ids[self.by_id], prepend=self.ids[self.by_id[:1]] - 1))
        self.first = first if len(first) < len(self.ids) else None  # of each id, if any is repeated


def tile_nearest(q: _Block, c: _Block, k: int, heaps: list[list[tuple[float, int]]]) -> None:
    """Puts into each query's heap, of at most ``k`` (score, -id), what this tile has for it."""
    guess = _product(q.small, c.small) * q.scale[:, None] * c.scale[None, :]
    # |qc - q'c'| <= |q - q'| |c| + |q'| |c - c'|, and a little for the rounding of doubles
    slack = q.lost[:, None] * c.norm[None, :] + (q.norm + q.lost)[:, None] * c.lost[None, :]
    slack += 1e-9 * (q.norm[:, None] * c.norm[None, :])
    own = q.ids[:, None] == c.ids[None, :]
    exponent = q.exponent[:, None] + c.exponent[None, :]
    least = q.vectors.shape[1] * np.finfo(np.float64).smallest_subnormal  # what rounding of tiny products may add
    with np.errstate(over="ignore"):
        low = np.where(own, -np.inf, np.ldexp(guess - slack, exponent) - least)
        high = np.ldexp(guess + slack, exponent) + least
    floor = np.full(len(q.ids), -np.inf)
    if c.first is not None:  # the heap holds an id once, and so the floor counts it once
        low = np.maximum.reduceat(low[:, c.by_id], c.first, axis=1)
    if low.shape[1] > k:
        floor = np.partition(low, low.shape[1] - k, axis=1)[:, low.shape[1] - k]
    floor = np.maximum(floor, [h[0][0] if len(h) == k else -np.inf for h in heaps])
    for i in range(len(q.ids)):
        at = np.flatnonzero(~(high[i] < floor[i]) & ~own[i])
        if not len(at):
            continue
        with np.errstate(over="ignore", invalid="ignore"):
            scores = np.cumsum(c.vectors[at] * q.vectors[i], axis=1)[:, -1]  # added up from left to right, in every tile alike
        scores[np.isnan(scores)] = -np.inf
        best = np.lexsort((c.ids[at], -scores))
        held, heap = {-x for _, x in heaps[i]}, heaps[i]
        taken = 0
        for j in best:
            entry = (float(scores[j]), -int(c.ids[at[j]]))
            if taken == k or len(heap) == k and entry <= heap[0]:
                break
            if -entry[1] in held:  # a repeated row
                continue
            held.add(-entry[1])
            taken += 1
            heapq.heappush(heap, entry) if len(heap) < k else heapq.heapreplace(heap, entry)


def _blocks(df: DataFrame, rows: int) -> DataFrame:
    """``size, block, ids, vectors``: blocks of vectors of one length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
            lists = batch.column("embedding")
            sizes = np.diff(lists.offsets.to_numpy()[: len(lists) + 1])
            flat = lists.values.to_numpy(zero_copy_only=False).astype(np.float64)
            starts = lists.offsets.to_numpy()[:-1]
            for size in np.unique(sizes):
                mine = np.flatnonzero(sizes == size)
                for begin in range(0, len(mine), rows):
                    part = mine[begin : begin + rows]
                    matrix = flat[starts[part][:, None] + np.arange(size)[None, :]]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "size": pa.array([int(size)], pa.int32()),
                            "ids": pa.array([ids[part].astype(np.int64).tobytes()], pa.binary()),
                            "vectors": pa.array([matrix.tobytes()], pa.binary()),
                        }
                    )

    return df.mapInArrow(run, "size int, ids binary, vectors binary")


def nearest(
    df: DataFrame, queries: Column, *, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows with the largest inner product for each row where ``queries`` holds."""
    rows = df.where(df[id_col].isNotNull() & usable(df[vector_col]))
    plain = lambda x: x.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("embedding"))
    candidates, asked = _blocks(plain(rows), block_rows), _blocks(plain(rows.where(queries)), block_rows)

    # A grid of groups: as many of each side as its number of blocks asks for, so each fits a task.
    n_queries = max(1, rows.where(queries).count())
    n_rows = max(1, rows.count())
    down = -(-n_queries // (block_rows * QUERY_BLOCKS))
    across = -(-n_rows // (block_rows * CANDIDATE_BLOCKS))
    spread = lambda x, n: F.pmod(F.xxhash64(x), F.lit(n)).cast("int")
    left = asked.withColumn("down", spread("ids", down)).withColumn("across", F.explode(F.sequence(F.lit(0), F.lit(across - 1))))
    right = candidates.withColumn("across", spread("ids", across)).withColumn("down", F.explode(F.sequence(F.lit(0), F.lit(down - 1))))

    def meet(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, list[tuple[float, int]]]] = []
        for x in q.itertuples():
            block = _Block(x.ids, x.vectors, x.size)
            heaps: list[list[tuple[float, int]]] = [[] for _ in block.ids]
            for y in c.itertuples():
                if y.size == x.size:
                    tile_nearest(block, _Block(y.ids, y.vectors, y.size), k, heaps)
            out += zip(block.ids.tolist(), heaps)
        return pd.DataFrame(
            {"query_id": [i for i, h in out if h], "scores": [[s for s, _ in h] for _, h in out if h], "ids": [[-i for _, i in h] for _, h in out if h]}
        )

    met = left.groupBy("down", "across").cogroup(right.groupBy("down", "across")).applyInPandas(
        meet, "query_id long, scores array<double>, ids array<long>"
    )

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows of a query follow each other; one heap at a time."""
        query, best = None, {}
        done: list[tuple[int, int, int, float]] = []

        def close() -> None:
            for rank, (i, s) in enumerate(heapq.nsmallest(k, best.items(), key=lambda x: (-x[1], x[0])), 1):
                done.append((query, rank, i, s))

        for frame in batches:
            for x in frame.itertuples():
                if x.query_id != query:
                    close()
                    query, best = x.query_id, {}
                for i, s in zip(x.ids, x.scores):
                    best[int(i)] = max(s, best.get(int(i), -np.inf))
                if len(best) > 8 * k:
                    best = dict(heapq.nsmallest(k, best.items(), key=lambda e: (-e[1], e[0])))
            yield pd.DataFrame(done, columns=["query_id", "rank", "vec_id", "score"])
            done.clear()
        close()
        yield pd.DataFrame(done, columns=["query_id", "rank", "vec_id", "score"])

    together = met.repartition("query_id").sortWithinPartitions("query_id")
    return together.mapInPandas(merge, "query_id long, rank int, vec_id long, score double")
