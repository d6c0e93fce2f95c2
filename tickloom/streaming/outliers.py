"""The outlier filter in front of a stream: the last accepted price of every symbol is keyed state.

Each micro-batch hands a symbol's ticks, in the order of the batch form, to the rule together with the
price that earlier batches left, and keeps the new one. The state is in RocksDB and survives restarts;
:func:`accepted_prices` reads it back, for reports or to go on in a batch job, and a batch's end can
start a stream. A symbol's ticks of one micro-batch are held by one task, so the trigger's limit on
files or bytes bounds its memory; what lies between batches is one row per symbol.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tickloom.config import OutlierSettings
from tickloom.operators.gate import Band, Walk, walk
from tickloom.streaming.ingest import EVERY_MINUTE, keep_state_on_disk

_STATE = "price double"


def outlier_stream(
    ticks: DataFrame,
    settings: OutlierSettings = OutlierSettings(),
    clock: str = "event_time",
    tie: Sequence[str] = ("tick_id",),
    last_accepted: DataFrame | None = None,
) -> DataFrame:
    """Every priced tick of a stream with ``accepted``, like :func:`clean.outlier_flags` on all batches.

    ``last_accepted`` (symbol, price) is where a symbol without state starts: a stream that takes over
    from a batch job. It joins as a static table.
    """
    rows = ticks.filter(F.col("price").isNotNull())
    columns = rows.columns
    if last_accepted is not None:
        known = last_accepted.select(F.col("symbol").alias("_known"), F.col("price").alias("_price"))
        rows = rows.join(known, F.col("symbol").eqNullSafe(F.col("_known")), "left").drop("_known")
    schema = T.StructType([*[rows.schema[c] for c in columns], T.StructField("accepted", T.BooleanType())])
    limits, usual = dict(settings.per_symbol_pct), float(settings.threshold_pct)
    order = [clock, *tie]

    def flag(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        group = pd.concat(list(parts), ignore_index=True).sort_values(order, kind="stable", na_position="first")
        last = None
        if state.exists:
            last = (0, state.get[0])
        elif "_price" in group and not pd.isna(group["_price"].iloc[0]):
            last = (0, float(group["_price"].iloc[0]))
        price = group["price"].to_numpy(dtype=float)
        limit = np.full(len(price), float(limits.get(key[0], usual)))
        passed, last = walk(Band(), Walk(np.zeros(len(price), np.int64), price, limit), last)
        if last is not None:
            state.update((last[1],))
        yield group[columns].assign(accepted=passed)

    return rows.groupBy("symbol").applyInPandasWithState(flag, schema, _STATE, "append", GroupStateTimeout.NoTimeout)


def start_outliers(
    ticks: DataFrame, path: str, checkpoint: str, settings: OutlierSettings = OutlierSettings(), trigger: dict = EVERY_MINUTE, **options
) -> StreamingQuery:
    """Append flagged ticks to a Parquet folder, each exactly once."""
    keep_state_on_disk(ticks.sparkSession)
    flagged = outlier_stream(ticks, settings, **options)
    writer = flagged.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(**trigger)
    return writer.format("parquet").option("path", path).start()


def accepted_prices(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(symbol, price): the last accepted price of every symbol after the last whole batch."""
    state = spark.read.format("statestore").load(checkpoint)
    return state.select(F.col("key.symbol").alias("symbol"), F.col("value.groupState.price").alias("price"))
