"""Tables: declared schemas, empty instead of missing, date partitions found from time filters."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Tables on plain Parquet carry the day of their time column as partition column.
DAY_OF = {"event_time": "event_date", "created_at": "created_date"}


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def table_rows(spark: SparkSession, name: str) -> DataFrame:
    """A table of the session catalog."""
    return spark.read.table(name)


def parquet_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All Parquet files under ``path``, matched to ``schema`` by column name.

    Columns a file lacks are null; a missing or empty folder gives no rows. A day partition
    column, where the folder has one, stays available for pruning.
    """
    try:
        found = spark.read.option("recursiveFileLookup", "false").parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return empty(spark, schema)
        raise
    days = [day for day in DAY_OF.values() if day in found.columns and day not in schema.names]
    declared = T.StructType([*schema.fields, *[T.StructField(day, T.DateType()) for day in days]])
    return spark.read.schema(declared).parquet(path)


def parquet_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """A Parquet folder as a stream of the files added to it."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


# Appends only: snapshots that delete or overwrite are passed over instead of failing the stream.
ICEBERG_STREAM_OPTIONS = {
    "streaming-skip-delete-snapshots": "true",
    "streaming-skip-overwrite-snapshots": "true",
}


def iceberg_stream(spark: SparkSession, table: str) -> DataFrame:
    """An Iceberg table as a stream; needs the connector on the class path."""
    return spark.readStream.format("iceberg").options(**ICEBERG_STREAM_OPTIONS).load(table)


def time_range(
    rows: DataFrame,
    time: str,
    lower: Column | None = None,
    strict: bool = False,
    keep_null: bool = False,
) -> DataFrame:
    """Rows from ``lower`` on. With a day partition column, whole days before it are not read."""
    if lower is None:
        return rows
    after = F.col(time) > lower if strict else F.col(time) >= lower
    day = DAY_OF.get(time)
    if day in rows.columns:
        after = after & (F.col(day) >= F.to_date(lower))
    if keep_null:
        after = after | F.col(time).isNull()
    return rows.filter(after)


# --- metadata --------------------------------------------------------------------------------


def tables_in(spark: SparkSession, namespace: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {namespace}")


def table_details(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE EXTENDED {name}")


def snapshots_of(spark: SparkSession, name: str) -> DataFrame:
    """Snapshots of an Iceberg table; needs the connector."""
    return spark.read.table(f"{name}.snapshots")


def data_files(rows: DataFrame) -> DataFrame:
    """The files behind a file-based table, with size, time of change and row count."""
    meta = F.col("_metadata")
    return (
        rows.select(
            meta.getField("file_path").alias("file_path"),
            meta.getField("file_size").alias("file_size"),
            meta.getField("file_modification_time").alias("modified_at"),
        )
        .groupBy("file_path", "file_size", "modified_at")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def newest_rows(
    rows: DataFrame, time: str = "ingestion_time", limit: int = 50, tie: tuple[str, ...] = ("symbol", "price", "source")
) -> DataFrame:
    """The last rows by a time column: a top-k, not a sort of the table. Columns of ``tie`` order equal times."""
    return rows.orderBy(F.col(time).desc(), *[c for c in tie if c in rows.columns]).limit(limit)
