"""Bronze and silver as streams: each a transform, and a starter that adds sink and checkpoint."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.operators.bars import price_bars
from tickloom.operators.clean import distinct_ticks, valid_ticks, without_written
from tickloom.sinks.tables import by_day, with_day
from tickloom.sources.quotes import parse_wire
from tickloom.sources.tables import DAY_OF


def keep_state_on_disk(spark: SparkSession) -> None:
    """Streaming state of the session's queries in RocksDB: dedup keys need not fit the heap."""
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )


def bronze_ticks(records: DataFrame, shift_zone: str | None = None) -> DataFrame:
    return parse_wire(records, shift_zone)


def silver_ticks(bronze: DataFrame, watermark: str = "5 minutes") -> DataFrame:
    """Valid ticks, each once as long as its copies come within the watermark."""
    return distinct_ticks(valid_ticks(bronze).withWatermark("event_time", watermark)).withColumn(
        "processed_at", F.current_timestamp()
    )


def bar_stream(silver: DataFrame, watermark: str = "1 minute") -> DataFrame:
    return price_bars(silver, watermark=watermark)


def _writer(rows: DataFrame, checkpoint: str, trigger: dict):
    return rows.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(**trigger)


EVERY_MINUTE = {"processingTime": "1 minute"}


def start_append(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    time: str = "event_time",
    trigger: dict = EVERY_MINUTE,
    files: int | None = None,
) -> StreamingQuery:
    """Append a stream to a Parquet folder by day.

    Rows of a day go to the same writer; ``files`` spreads each batch evenly over that many writers
    instead, for days that are too large for one.
    """
    dated = with_day(rows, time)
    dated = by_day(dated, time) if files is None else dated.repartition(files)
    return (
        _writer(dated, checkpoint, trigger)
        .format("parquet")
        .partitionBy(DAY_OF[time])
        .option("path", path)
        .start()
    )


def start_table(
    rows: DataFrame, table: str, checkpoint: str, provider: str = "iceberg", trigger: dict = EVERY_MINUTE
) -> StreamingQuery:
    """Append a stream to a catalog table."""
    return _writer(rows, checkpoint, trigger).format(provider).toTable(table)


def start_kafka(records: DataFrame, options: dict[str, str], checkpoint: str, trigger: dict = EVERY_MINUTE) -> StreamingQuery:
    """Append records (column ``value``) to a topic."""
    return _writer(records, checkpoint, trigger).format("kafka").options(**options).start()


def start_bronze(records: DataFrame, path: str, checkpoint: str, **options) -> StreamingQuery:
    return start_append(bronze_ticks(records), path, checkpoint, **options)


def start_silver(bronze: DataFrame, path: str, checkpoint: str, **options) -> StreamingQuery:
    keep_state_on_disk(bronze.sparkSession)
    return start_append(silver_ticks(bronze), path, checkpoint, **options)


def start_silver_again(
    bronze: DataFrame,
    written: Callable[[], DataFrame],
    path: str,
    checkpoint: str,
    trigger: dict = EVERY_MINUTE,
) -> StreamingQuery:
    """Silver after its checkpoint was given up: the dedup state is gone, the table is not.

    Rows already in the table are left out by a join with it, over the days of each batch. Every
    batch replaces its own folder, so a retry does not write twice.
    """
    run = checkpoint.rstrip("/").rpartition("/")[2]
    keep_state_on_disk(bronze.sparkSession)

    def write(batch: DataFrame, batch_id: int) -> None:
        # Behind a stateful operator: read twice, run once.
        batch = batch.persist()
        try:
            compare_and_write(batch, batch_id)
        finally:
            batch.unpersist()

    def compare_and_write(batch: DataFrame, batch_id: int) -> None:
        # One row: the earliest time in the batch bounds the part of the table to compare with.
        earliest = batch.agg(F.min("event_time")).first()[0]
        since = F.lit(earliest).cast("timestamp") if earliest is not None else None
        fresh = without_written(batch, written().filter(F.col("run") != f"{run}-{batch_id}"), since)
        target = f"{path}/run={run}-{batch_id}"
        with_day(fresh, "event_time").write.mode("overwrite").partitionBy(DAY_OF["event_time"]).parquet(target)

    return _writer(silver_ticks(bronze), checkpoint, trigger).foreachBatch(write).start()


def run_with_recovery(
    start: Callable[[str], StreamingQuery],
    checkpoint: str,
    is_recoverable: Callable[[Exception], bool],
    max_attempts: int = 3,
) -> int:
    """Run a query to its end; after a recoverable failure start over with a fresh checkpoint.

    The failed checkpoint is left where it is. Returns the number of attempts.
    """
    for attempt in range(1, max_attempts + 1):
        place = checkpoint if attempt == 1 else f"{checkpoint}-attempt-{attempt}"
        query = None
        try:
            query = start(place)
            query.awaitTermination()
            return attempt
        except Exception as error:
            if query is not None and query.isActive:
                query.stop()
            if attempt == max_attempts or not is_recoverable(error):
                raise
    return max_attempts


def snapshot_expired(error: Exception) -> bool:
    return "snapshot was expired or removed" in str(error)


def source_files_gone(error: Exception) -> bool:
    """Files a stream had planned to read are not there any more, as after a rewrite of its source."""
    return "FILE_NOT_EXIST" in str(error) or "FileNotFoundException" in str(error)
