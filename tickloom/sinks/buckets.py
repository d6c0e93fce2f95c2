"""A key-value table in buckets, of which a batch rewrites only those it touches.

``{path}/buckets={count}/version={n}/bucket={k}`` holds the whole of bucket ``k`` as batch ``n`` left it.
Of each bucket the newest version counts; buckets that a batch does not touch keep the files they have.
A version is one write, so a repeated batch replaces all it wrote before, and it is seen when that write
has ended. What is listed is bounded by the number of buckets times two versions.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET = "bucket"


@dataclass(frozen=True)
class Part:
    version: int
    bucket: int
    path: str


def bucket_of(owner: Column, count: int) -> Column:
    return F.pmod(F.xxhash64(owner), F.lit(count)).cast("int")


def _system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    return jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def _found(spark: SparkSession, pattern: str) -> list[str]:
    system, place = _system(spark, pattern)
    return [status.getPath().toString() for status in system.globStatus(place(pattern)) or []]


def _value(path: str, name: str) -> int:
    return int(path.rpartition(f"{name}=")[2].partition("/")[0])


def _root(spark: SparkSession, path: str, count: int) -> str:
    other = [p for p in _found(spark, f"{path}/buckets=*") if _value(p, "buckets") != count]
    if other:
        raise ValueError(f"the table has {_value(other[0], 'buckets')} buckets, not {count}")
    return f"{path}/buckets={count}"


def _parts(spark: SparkSession, path: str, count: int) -> list[Part]:
    root = _root(spark, path, count)
    whole = {_value(p, "version") for p in _found(spark, f"{root}/version=*/_SUCCESS")}
    found = [Part(_value(p, "version"), _value(p, BUCKET), p) for p in _found(spark, f"{root}/version=*/{BUCKET}=*")]
    return [part for part in found if part.version in whole]


def newest_parts(spark: SparkSession, path: str, count: int, before: int | None = None) -> dict[int, Part]:
    """Of each bucket the newest version, or the newest one older than ``before``."""
    newest: dict[int, Part] = {}
    for part in _parts(spark, path, count):
        held = newest.get(part.bucket)
        if (before is None or part.version < before) and (held is None or part.version > held.version):
            newest[part.bucket] = part
    return newest


def read_buckets(
    spark: SparkSession, path: str, schema: T.StructType, count: int, before: int | None = None, buckets: Iterable[int] | None = None
) -> DataFrame:
    """Rows of all buckets, or of some; no rows where there is no table."""
    newest = newest_parts(spark, path, count, before)
    wanted = newest if buckets is None else set(buckets)
    paths = [part.path for bucket, part in sorted(newest.items()) if bucket in wanted]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def write_buckets(rows: DataFrame, path: str, owner: Column, count: int, version: int) -> None:
    """Write ``rows`` - whole buckets - as ``version``, one file a bucket, and drop what no retry needs."""
    spark = rows.sparkSession
    root = _root(spark, path, count)
    placed = rows.withColumn(BUCKET, bucket_of(owner, count)).repartition(BUCKET)
    placed.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{root}/version={version}")
    # The version before this one serves a retry of this batch; older ones have a successor.
    needed = newest_parts(spark, path, count, before=version)
    system, place = _system(spark, root)
    for part in _parts(spark, path, count):
        if part.bucket in needed and part.version < needed[part.bucket].version:
            system.delete(place(part.path), True)
