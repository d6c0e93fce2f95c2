"""Exact deduplication as a stateful stream: one entry of keyed state per text, kept for good.

The stream reads the table's files in micro-batches. Its state, in RocksDB on the executors' disks with
changes stored under the checkpoint folder, is keyed by the digest of the normalised text and holds the
identifier of the row that stays, where its content lies (file and row number) and how many rows had that
text. Entries never expire, so a copy of any age is found, and a stream started again on its checkpoint
goes on. Copies are combined before the shuffle: a text in a third of all rows costs a task one record.

A digest only says which rows may be equal. All rows of one digest that came more than once are compared
byte by byte: each task compares its own and passes one copy of each text on, and those meet per digest.
Should different texts ever share a digest, their rows are divided by the texts themselves.

Texts are equal when they are identical after lower-casing A-Z. Defined cases: a null text is empty and
a null id is smaller than all ids; of equal texts with equal ids (repeated rows), the one later by file
and row number stays, so one row always does; an empty table, or no file, gives no rows; very long texts
are worked on one by one; further columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.llm.common import small_batches, type_of
from tickloom.plans.lineage import cut_lineage, ensure_checkpoint_dir

#: Bytes of input files of one micro-batch for each core of the cluster.
BATCH_BYTES_A_CORE = 64 << 20
#: Bytes of texts a task holds while it compares copies.
HELD_BYTES = 64 << 20
#: A class with a thousandth of all rows is handed to every task: there are a thousand at most.
HOT_SHARE = 1000

#: State on disk. Many small stores: batches store their changes, and files are not made larger than their content.
_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def sha256(text: bytes) -> bytes:
    return hashlib.sha256(text).digest()


def digested(
    docs: DataFrame, digest: Callable[[bytes], bytes] = sha256, *, id_col: str = "doc_id", text_col: str = "text", texts: bool = False
) -> DataFrame:
    """``doc_id, file, row, digest`` of every row and, if asked for, ``text``: the normalised bytes."""
    place = docs.metadataColumn("_metadata")
    rows = docs.select(
        docs[id_col].alias("doc_id"),
        place["file_path"].alias("file"),
        place["row_index"].alias("row"),
        F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"),
    )
    schema = f"doc_id {type_of(rows, 'doc_id')}, file string, row long, digest binary" + ", text binary" * texts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            lowered = pc.ascii_lower(batch.column("text")).cast(pa.binary())
            columns = [batch.column(c) for c in ("doc_id", "file", "row")]
            columns.append(pa.array([digest(x.as_buffer()) for x in lowered], pa.binary()))
            names = ["doc_id", "file", "row", "digest"]
            if texts:
                columns, names = [*columns, lowered], [*names, "text"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(run, schema)


def start(
    spark: SparkSession,
    path: str,
    state: str,
    digest: Callable[[bytes], bytes] = sha256,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    batch_bytes: int | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Stream Parquet files of ``path`` (a folder or a pattern) into the keyed state under ``state``.

    By default everything there is at the start is taken in, in several micro-batches, and the stream
    ends; another trigger lets it run on.
    """
    size = batch_bytes or BATCH_BYTES_A_CORE * spark.sparkContext.defaultParallelism
    stream = spark.readStream.schema(spark.read.parquet(path).schema).option("maxBytesPerTrigger", size).parquet(path)
    rows = digested(stream, digest, id_col=id_col, text_col=text_col)
    classes = rows.groupBy("digest").agg(F.max(F.struct("doc_id", "file", "row")).alias("held"), F.count(F.lit(1)).alias("size"))
    before = {name: spark.conf.get(name, None) for name in _STATE}
    for name, value in _STATE.items():
        spark.conf.set(name, value)
    try:
        # The state is the result: nothing else needs to be written.
        return (
            classes.writeStream.outputMode("update").format("noop").option("checkpointLocation", state)
            .trigger(**(trigger or {"availableNow": True})).start()
        )
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def classes_of(spark: SparkSession, state: str) -> DataFrame:
    """``digest, keep_id, keep_file, keep_row, size``: the entries of the state after its last batch."""
    entries = spark.read.format("statestore").load(state)
    return entries.select(
        F.col("key.digest").alias("digest"),
        F.col("value.max.doc_id").alias("keep_id"),
        F.col("value.max.file").alias("keep_file"),
        F.col("value.max.row").alias("keep_row"),
        F.col("value.count").alias("size"),
    )


def differing(rows: DataFrame) -> DataFrame:
    """``digest``: those that rows (digest, text) with different bytes share."""

    def first_copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One copy of each text in a stretch of the task's rows; of a digest with several, each of them."""
        held: dict[bytes, set[bytes]] = {}
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            flat = [(d, t) for d, texts in held.items() for t in texts]
            for begin in range(0, len(flat), 500):
                part = flat[begin : begin + 500]
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in part], pa.binary()) for k in (0, 1)], ["digest", "text"])

        for batch in batches:
            for d, t in zip(batch.column("digest").to_pylist(), batch.column("text").to_pylist()):
                texts = held.setdefault(d, set())
                if t not in texts:
                    texts.add(t)
                    size += len(t) + 200
                    if size > HELD_BYTES:
                        yield from out()
                        held.clear()
                        size = 0
        yield from out()

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by digest: each is compared with the first of its digest, which alone is held."""
        digest = text = told = None
        for batch in batches:
            found = []
            for d, t in zip(batch.column("digest").to_pylist(), batch.column("text").to_pylist()):
                if d != digest:
                    digest, text = d, t
                elif t != text and told != d:
                    told = d
                    found.append(d)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], ["digest"])

    copies = rows.select("digest", "text").mapInArrow(first_copies, "digest binary, text binary")
    return copies.repartition("digest").sortWithinPartitions("digest").mapInArrow(compared, "digest binary")


def with_class(rows: DataFrame, classes: DataFrame, total: int, key: str = "digest") -> DataFrame:
    """``rows`` with the columns of their class. Large classes come to the rows, rows of others to them."""
    large = classes.where(F.col("size") * HOT_SHARE >= total)
    near = rows.join(F.broadcast(large), key)
    far = rows.join(F.broadcast(large.select(key)), key, "left_anti").join(classes.where(F.col("size") * HOT_SHARE < total), key)
    return near.unionByName(far)


def deduplicate(
    spark: SparkSession,
    path: str,
    digest: Callable[[bytes], bytes] = sha256,
    *,
    state: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    batch_bytes: int | None = None,
) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, digest, file, row`` of every row under ``path``.

    ``state`` names the folder of the keyed state; files taken in by an earlier call are not streamed
    again. Without it the state is dropped when its entries have been read.
    """
    docs = spark.read.parquet(path)
    names = {"id_col": id_col, "text_col": text_col}
    ensure_checkpoint_dir(spark)
    place = state or f"{spark.sparkContext.getCheckpointDir()}/exact-{uuid.uuid4().hex}"
    rows = cut_lineage(digested(docs, digest, **names))
    if rows.isEmpty():
        classes, total = _no_classes(rows), 0
    else:
        start(spark, path, place, digest, batch_bytes=batch_bytes, **names).awaitTermination()
        classes = cut_lineage(classes_of(spark, place))
        total = classes.agg(F.sum("size")).first()[0]
        if state is None:
            _delete(spark, place)

    texts = digested(docs, digest, texts=True, **names).select("doc_id", "file", "row", "digest", "text")
    shared = cut_lineage(differing(texts))
    found = with_class(rows, classes, total)
    if not shared.isEmpty():
        apart = texts.join(shared, "digest")
        own = apart.groupBy("digest", "text").agg(F.max(F.struct("doc_id", "file", "row")).alias("held"), F.count(F.lit(1)).alias("size"))
        own = own.select("digest", "text", F.col("held.doc_id").alias("keep_id"), F.col("held.file").alias("keep_file"), F.col("held.row").alias("keep_row"), "size")
        found = found.join(shared, "digest", "left_anti").unionByName(apart.join(own, ["digest", "text"]).drop("text"))
    return found.select(
        "doc_id",
        "keep_id",
        F.col("size").alias("group_size"),
        ((F.col("file") == F.col("keep_file")) & (F.col("row") == F.col("keep_row"))).alias("kept"),
        "digest",
        "file",
        "row",
    )


def _no_classes(rows: DataFrame) -> DataFrame:
    return rows.select("digest", F.col("doc_id").alias("keep_id"), F.col("file").alias("keep_file"), F.col("row").alias("keep_row"), F.lit(0).cast("long").alias("size"))


def _delete(spark: SparkSession, folder: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def exact_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document: the id that stays, the size of its group, whether it stays, digest of the text."""
    return deduplicate(spark, path).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )
