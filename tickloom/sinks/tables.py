"""Writing tables: creation, appends, versions, upserts."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.sources.tables import DAY_OF


def with_day(rows: DataFrame, time: str) -> DataFrame:
    """Add the partition column plain Parquet tables prune on."""
    return rows.withColumn(DAY_OF[time], F.to_date(time))


def create_table(
    spark: SparkSession, name: str, schema: T.StructType, time: str | None = None, provider: str = "parquet"
) -> None:
    """Create namespace and table unless they exist, partitioned by the day of ``time``.

    Iceberg partitions by a transform; Parquet by a derived column that writers fill with
    :func:`with_day`.
    """
    namespace = name.rpartition(".")[0]
    if namespace:
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace}")
    columns = [
        f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema.fields
    ]
    partition = ""
    if time and provider == "iceberg":
        partition = f"PARTITIONED BY (days({time}))"
    elif time:
        columns.append(f"`{DAY_OF[time]}` date")
        partition = f"PARTITIONED BY ({DAY_OF[time]})"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(columns)}) USING {provider} {partition}")


def append_table(rows: DataFrame, name: str) -> None:
    """Append to a catalog table, columns matched by name."""
    columns = rows.sparkSession.table(name).columns
    missing = [time for time, day in DAY_OF.items() if day in columns and day not in rows.columns and time in rows.columns]
    for time in missing:
        rows = with_day(rows, time)
    rows.select(*columns).write.insertInto(name)


def append_parquet(rows: DataFrame, path: str, time: str | None = None) -> None:
    """Append to a folder, one group of files per day."""
    if time is None:
        rows.write.mode("append").parquet(path)
    else:
        by_day(with_day(rows, time), time).write.mode("append").partitionBy(DAY_OF[time]).parquet(path)


def by_day(rows: DataFrame, time: str) -> DataFrame:
    """Few files per day without a single writer: Spark evens out partitions and splits large days."""
    return rows.hint("rebalance", DAY_OF[time])


def replace_part(rows: DataFrame, path: str, part: str, time: str | None = None) -> None:
    """Write one part (``name=value`` folder) of a table, replacing what an earlier try left there."""
    target = f"{path}/{part}"
    if time is None:
        rows.write.mode("overwrite").parquet(target)
    else:
        by_day(with_day(rows, time), time).write.mode("overwrite").partitionBy(DAY_OF[time]).parquet(target)


def delete_files(spark: SparkSession, paths: Sequence[str]) -> None:
    """Delete files a rewrite has replaced."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, False)


def latest_by_key(updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Of rows with the same key the one with the latest ``updated_at``."""
    rest = [c for c in updates.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct("updated_at", *[c for c in rest if c != "updated_at"]))
    return updates.groupBy(*keys).agg(last.alias("_last")).select(*keys, *[F.col(f"_last.{c}").alias(c) for c in rest])


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str] = ("state_key",)) -> DataFrame:
    """``target`` with the rows of ``updates`` in place of those with the same key.

    If ``updates`` has a key more than once, the row with the latest ``updated_at`` wins.
    """
    latest = latest_by_key(updates, keys).select(*target.columns)
    kept = target.join(latest.select(*keys), list(keys), "left_anti")
    return kept.unionByName(latest)


def merge_table(updates: DataFrame, name: str, keys: Sequence[str] = ("state_key",)) -> None:
    """Upsert into a table whose format supports MERGE; it fails on repeated keys, so the latest row wins here too."""
    # A view of its own for each call: two jobs of a session may merge at once.
    view = f"updates_{uuid.uuid4().hex}"
    latest_by_key(updates, keys).createOrReplaceTempView(view)
    same = " AND ".join(f"target.{k} = source.{k}" for k in keys)
    sets = ", ".join(f"target.{c} = source.{c}" for c in updates.columns if c not in keys)
    try:
        updates.sparkSession.sql(
            f"MERGE INTO {name} AS target USING {view} AS source ON {same} "
            f"WHEN MATCHED THEN UPDATE SET {sets} WHEN NOT MATCHED THEN INSERT *"
        )
    finally:
        updates.sparkSession.catalog.dropTempView(view)
