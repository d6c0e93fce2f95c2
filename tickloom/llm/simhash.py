"""Near-duplicates by SimHash: fingerprints at most two bits apart, found by meeting in the middle.

Two fingerprints within two bits of each other both lie within one bit of a third value. So every
distinct fingerprint emits the 65 values within one bit, these are sorted together, and fingerprints
that meet on a value are within two bits: at most 65 can, and a chain through them has all their links
up to connection, without a row per pair. Pairs are verified and deduplicated, and components grow by
alternating stars. Documents with equal fingerprints are one node from the start.

Defined cases: a null text has no words and fingerprint zero, linked like any other; a null id never
names a component unless all of its ids are null; repeated rows are documents with equal fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import column, small_batches, text_key, texts_of, type_of
from tickloom.plans.lineage import cut_lineage

SEED, BITS = 42, 64


def fingerprint(text: str, shingle: int = 3) -> int:
    """Bits set in over half the hashes of the shingles of a text's words; zero without words."""
    words = text.encode("utf-8").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate((len(w) + 1 for w in words), initial=0))
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        spans = [digest(joined, SEED)]
    else:
        spans = [digest(joined[a : b - 1], SEED) for a, b in zip(ends, ends[shingle:])]
    hashes = np.array(spans, np.uint64)
    count = np.zeros(BITS, np.int64)
    for begin in range(0, len(hashes), 100_000):
        part = hashes[begin : begin + 100_000].astype("<u8").view(np.uint8)
        count += np.unpackbits(part, bitorder="little").reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * count > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(
    df: DataFrame, *, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text", keyed: bool = False
) -> DataFrame:
    """``doc_id, fingerprint`` (as a signed long) of every row and, if asked for, ``key``: the text's hash."""
    docs = texts_of(df, id_col, text_col)
    if keyed:
        docs = docs.withColumn("key", F.xxhash64("text"))
    more = ["key"] * keyed

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            found = np.array([fingerprint(x, shingle) for x in batch.column("text").to_pylist()], np.uint64)
            columns = [batch.column("doc_id"), pa.array(found.view(np.int64)), *map(batch.column, more)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "fingerprint", *more])

    return docs.mapInArrow(run, f"doc_id {type_of(docs, 'doc_id')}, fingerprint long" + ", key long" * keyed)


def links(nodes: DataFrame, name: str = "fingerprint") -> DataFrame:
    """``a, b``: links that connect all distinct values of ``nodes`` at most two bits apart."""
    flips = F.array(F.lit(0).cast("long"), *[F.lit(1 << i if i < 63 else -(1 << 63)).cast("long") for i in range(BITS)])
    balls = nodes.select(F.col(name).alias("b"), F.explode(F.transform(flips, lambda x: x.bitwiseXOR(F.col(name)))).alias("value"))
    met = balls.withColumn("a", F.lag("b").over(Window.partitionBy("value").orderBy("b")))
    near = met.where(F.col("a").isNotNull() & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2))
    return near.select("a", "b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: the smallest node reachable from each node of ``edges`` (a, b).

    Large and small stars in turn until nothing changes; each round is two aggregations and joins, and
    is stored, so a lost executor costs no more than a round.
    """
    star = cut_lineage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    mark = _mark(star)
    while True:
        both = star.unionByName(star.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(down, "a")
            .select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.a", "e.b")
            .where("a <> b")
            .distinct()
        )
        star = cut_lineage(small)
        now = _mark(star)
        if now == mark:
            break
        mark = now
    return star.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _mark(star: DataFrame) -> tuple:
    """Count and hash sum of the links: equal only if a round changed nothing."""
    row = star.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def near_duplicates(
    df: DataFrame, *, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text", keyed: bool = False
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` (smallest id reachable over links) of every row and, if asked
    for, ``key``, the text's hash, and ``root``, the component's own name."""
    prints = cut_lineage(fingerprints(df, shingle=shingle, id_col=id_col, text_col=text_col, keyed=keyed))
    nodes = cut_lineage(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")))
    roots = components(links(nodes))
    rooted = nodes.join(roots, nodes["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "first_id", F.coalesce("root", "fingerprint").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = rooted.join(named, "root").select("fingerprint", "component_id", *["root"] * keyed)
    return prints.join(classes, "fingerprint").select("doc_id", "fingerprint", "component_id", *["key", "root"] * keyed)


def one_of_each(df: DataFrame, *, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with one document of each component, one with its smallest id. If rows of that id have several
    texts in the component, the one with the smallest fingerprint and hash stays; of rows of equal id and
    text the one whose other columns have the smallest hash. Rows without an id name no group and stay."""
    found = near_duplicates(df, shingle=shingle, id_col=id_col, text_col=text_col, keyed=True)
    first = (
        found.where(F.col("doc_id") == F.col("component_id"))
        .groupBy("root")
        .agg(F.min(F.struct("fingerprint", "key", "component_id")).alias("first"))
        .select(F.col("first.component_id").alias("_id"), F.col("first.key").alias("_key"))
    )
    row = F.struct(*[column(df, c) for c in df.columns])
    others = [column(df, c) for c in df.columns if c not in (id_col, text_col)]
    turn = F.xxhash64(F.to_json(F.struct(*others))) if others else F.lit(0)
    rows = df.select(row.alias("row"), column(df, id_col).alias("id"), text_key(df, text_col).alias("key"), turn.alias("turn"))
    named = rows.join(first, (F.col("id") == F.col("_id")) & (F.col("key") == F.col("_key")), "left_semi")
    one = named.groupBy("id", "key").agg(F.min_by("row", "turn").alias("row"))
    return one.select("row.*").unionByName(df.where(column(df, id_col).isNull()))


def hexadecimal(name: str = "fingerprint"):
    return F.lower(F.lpad(F.hex(F.col(name)), 16, "0"))
