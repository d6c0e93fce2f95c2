"""Cutting lineage on storage every executor can reach."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder the cluster names; only a local session may pick its own."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if named:
        context.setCheckpointDir(named)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably, so later passes and retries read the same rows."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
