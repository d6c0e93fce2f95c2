"""Packing of documents into sequences of fixed length, shortest pack first over the length histogram.

Every document ends with a closing id and is cut into full pieces and one rest. Only the histogram of
lengths - at most one entry per possible length - comes to the driver; it places lengths longest first,
each into the pack with most room, updating how often each pattern of lengths occurs. Pieces of one
length are interchangeable, so a piece finds its place by its rank among those of its length. Ranks
come from counts per partition: a length that holds most rows is spread over all of them.

Defined cases: a null text is empty and its document is the closing id alone; repeated rows are packed
each by itself; an empty table gives no rows. Added tokens of a vocabulary file, if one is given, have
their ids wherever they stand in a text; without one their strings are ordinary text.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import process_cache, small_batches, texts_of, type_of
from tickloom.plans.lineage import cut_lineage


def _encoder(ranks_path: str, pattern: str):
    """The merges of the rank file in the library that is fastest on whole texts; ids are the same."""
    import base64

    import tiktoken

    with open(ranks_path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def added_tokens(vocabulary_path: str) -> dict[str, int]:
    """Ids of the strings that a tokenizers file has the library cut out of texts before merging."""
    with open(vocabulary_path, encoding="utf-8") as file:
        tokens = json.load(file)["added_tokens"]
    if odd := [t["content"] for t in tokens if t["lstrip"] or t["rstrip"] or t["single_word"]]:
        raise ValueError(f"added tokens that depend on what is beside them: {odd}")
    return {t["content"]: t["id"] for t in tokens}


def _ids_of(encoder, added: dict[str, int]) -> Callable[[str], np.ndarray]:
    """Ids of a text: those of added tokens, leftmost and longest first, and of the text between them."""
    plain = lambda text: encoder.encode_to_numpy(text, disallowed_special=()).astype("<u4")
    cut = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True))))

    def ids(text: str) -> np.ndarray:
        out, at = [], 0
        for m in cut.finditer(text) if added else ():
            out += [plain(text[at : m.start()]), np.array([added[m[0]]], "<u4")]
            at = m.end()
        return np.concatenate([*out, plain(text[at:])]) if at else plain(text)

    return ids


def pieces_of(
    df: DataFrame, ranks_path: str, pattern: str, *, vocabulary_path: str | None = None, capacity: int = 2048, end_id: int = 1,
    id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False,
) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens`` (and ``ids``) of every piece of every document."""
    docs = texts_of(df, id_col, text_col)
    added = added_tokens(vocabulary_path) if vocabulary_path else {}
    schema = f"doc_id {type_of(docs, 'doc_id')}, start long, length long, ids_crc32 long, doc_tokens long"
    schema += ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = process_cache(("packing", ranks_path, pattern), lambda: _encoder(ranks_path, pattern))
        ids_of, last = _ids_of(encoder, added), np.array([end_id], "<u4")
        for batch in small_batches(batches):
            at, start, length, crc, total, ids = [], [], [], [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                all_ids = np.concatenate([ids_of(text), last])
                for begin in range(0, len(all_ids), capacity):
                    piece = all_ids[begin : begin + capacity]
                    at.append(i)
                    start.append(begin)
                    length.append(len(piece))
                    crc.append(zlib.crc32(piece.tobytes()))
                    total.append(len(all_ids))
                    if with_ids:
                        ids.append(piece.astype(np.int32))
            columns = [batch.column("doc_id").take(pa.array(at, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, length, crc, total))]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(run, schema)


def plan_packs(histogram: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """``(count, {length: how often})`` patterns that hold every length as often as it occurs.

    Longest first; each goes into the emptiest pack that it fits. Work and result depend on the number
    of lengths, not on how often they occur.
    """
    open_packs: dict[int, list[tuple[int, dict[int, int]]]] = defaultdict(list)  # by room
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        room = capacity
        while left:
            while room >= length and not open_packs.get(room):
                room -= 1
            if room < length:  # new packs; the next of the same length find these the emptiest
                each = capacity // length
                for count, times in ((left // each, each), (1, left % each)):
                    if count and times:
                        open_packs[capacity - times * length].append((count, {length: times}))
                break
            count, pattern = open_packs[room].pop()
            used = min(count, left)
            if count > used:
                open_packs[room].append((count - used, pattern))
            open_packs[room - length].append((used, pattern | {length: pattern.get(length, 0) + 1}))
            left -= used
    return [pack for packs in open_packs.values() for pack in packs]


def _slots(packs: list[tuple[int, dict[int, int]]]) -> dict[int, np.ndarray]:
    """By length: rows of first rank, first sequence, offset, times in a pack."""
    out: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
    used: dict[int, int] = defaultdict(int)
    sequence = 0
    for count, pattern in packs:
        offset = 0
        for length, times in pattern.items():
            out[length].append((used[length], sequence, offset, times))
            used[length] += count * times
            offset += length * times
        sequence += count
    return {length: np.array(rows, np.int64) for length, rows in out.items()}


def pack(pieces: DataFrame, *, capacity: int = 2048) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; needs a column ``length`` from 1 to ``capacity``."""
    held = cut_lineage(pieces).withColumn("_part", F.spark_partition_id())
    counts = held.groupBy("length", "_part").count()
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    slots = _slots(plan_packs(histogram, capacity))

    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("length", "_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_first"))
    within = Window.partitionBy("length", "_part").orderBy("_order")
    ranked = held.withColumn("_order", F.monotonically_increasing_id()).withColumn("_at", F.row_number().over(within) - 1)

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        n, r = length.to_numpy(), rank.to_numpy()
        sequence, offset = np.empty(len(n), np.int64), np.empty(len(n), np.int64)
        for x in np.unique(n):
            mine = n == x
            rows = slots[int(x)]
            first, base, begin, times = rows[np.searchsorted(rows[:, 0], r[mine], "right") - 1].T
            sequence[mine] = base + (r[mine] - first) // times
            offset[mine] = begin + (r[mine] - first) % times * x
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    joined = ranked.join(firsts, ["length", "_part"]).withColumn("_place", place("length", F.col("_first") + F.col("_at")))
    return joined.select(*pieces.columns, "_place.sequence_id", "_place.offset")
