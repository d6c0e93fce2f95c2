"""Joins that stay even when a few keys have most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key with a thousandth of all rows is hot: there are a thousand of them at most.
HOT_SHARE = 1000


def lookup(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Inner join of ``rows`` with ``table``, which has one row per key.

    Entries of hot keys come to the rows, as a broadcast of a thousand entries at most; the rows of all
    other keys go to their entries, none of which gets more than a thousandth of the rows.
    """
    per_key = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = F.broadcast(per_key.agg(F.sum("_n").alias("_total")))
    hot = per_key.join(total, F.col("_n") * HOT_SHARE >= F.col("_total")).select(key)
    entries = table.join(F.broadcast(hot), key, "left_semi")
    near = rows.join(F.broadcast(entries), key)
    far = rows.join(F.broadcast(hot), key, "left_anti").join(table, key)
    return near.unionByName(far)


def shuffle_width(df: DataFrame) -> int:
    """Tasks of a shuffle as the session has it."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
