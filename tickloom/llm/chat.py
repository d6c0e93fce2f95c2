"""Dialogues from every participant's side.

For each participant a dialogue is written with that speaker as the assistant and all others as named
users; only what the assistant says is trained on. The result has one row per turn and side, with the
turn's place in the written dialogue, so the dialogue may have any length: places are running sums
over the parts of a range-sorted, stored table, with one total per dialogue and part handed on.
``dialogues`` joins the turns to one text per side.

Defined cases: a null text is empty; a null or blank speaker is "unknown"; a turn of a shared speaker
(``system``) is on every side and no participant; a dialogue with shared speakers alone gives no rows;
turns are ordered by number (null first), then speaker, then text, and repeated rows are turns of
their own; a null dialogue id is a dialogue. Marks of the format inside texts or names are broken up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.plans.lineage import cut_lineage

SHARED = ("system",)
END = "<|end|>\n"


def _plain(text: Column) -> Column:
    """Text in which no mark of the format can begin."""
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def perspectives(
    df: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", speaker_col: str = "role", text_col: str = "text",
    shared: tuple[str, ...] = SHARED,
) -> DataFrame:
    """``conv_id, side, place, speaker, rendered, start, end, train_start, train_end``.

    ``rendered`` is the turn's part of the text and ``start`` to ``end`` its characters there;
    ``train_start`` to ``train_end`` are those to train on, null for turns of others.
    """
    turns = df.select(
        df[conv_col].alias("conv_id"),
        df[turn_col].alias("turn"),
        F.coalesce(F.nullif(F.trim(df[speaker_col].cast("string")), F.lit("")), F.lit("unknown")).alias("speaker"),
        _plain(F.coalesce(df[text_col].cast("string"), F.lit(""))).alias("text"),
    )
    ordered = cut_lineage(turns.repartitionByRange("conv_id", "turn", "speaker", "text").sortWithinPartitions("conv_id", "turn", "speaker", "text"))
    ordered = ordered.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id())

    sides = (
        turns.where(~F.col("speaker").isin(*shared)).select("conv_id", F.col("speaker").alias("side")).distinct()
    )
    seen = ordered.join(sides.withColumnRenamed("conv_id", "side_conv"), F.col("conv_id").eqNullSafe(F.col("side_conv"))).drop("side_conv")
    own = F.col("speaker") == F.col("side")
    head = (
        F.when(F.col("speaker").isin(*shared), F.concat(F.lit("<|"), F.col("speaker"), F.lit("|>\n")))
        .when(own, F.lit("<|assistant|>\n"))
        .otherwise(F.concat(F.lit("<|user "), _plain(F.col("speaker")), F.lit("|>\n")))
    )
    written = seen.withColumn("own", own).withColumn("head", head).withColumn("rendered", F.concat("head", "text", F.lit(END)))
    written = written.withColumn("size", F.length("rendered").cast("long"))

    totals = written.groupBy("conv_id", "side", "part").agg(F.sum("size").alias("total"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv_id", "side").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = totals.select(
        F.col("conv_id").alias("c"), F.col("side").alias("s"), F.col("part").alias("p"),
        F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("first"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first_place"),
    )
    within = Window.partitionBy("conv_id", "side", "part").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    summed = written.withColumn("upto", F.sum("size").over(within)).withColumn("nth", F.count(F.lit(1)).over(within))
    both = summed.join(
        firsts, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("side") == F.col("s")) & (F.col("part") == F.col("p"))
    )
    end = F.col("first") + F.col("upto")
    trained = lambda x: F.when(F.col("own"), x)
    return both.select(
        "conv_id",
        "side",
        (F.col("first_place") + F.col("nth") - 1).cast("long").alias("place"),
        "speaker",
        "rendered",
        (end - F.col("size")).alias("start"),
        end.alias("end"),
        trained(end - F.col("size") + F.length("head")).alias("train_start"),
        trained(end).alias("train_end"),
    )


def dialogues(turns: DataFrame) -> DataFrame:
    """``conv_id, side, text, masks``: one text per side, for dialogues that fit a row."""
    grouped = turns.groupBy("conv_id", "side").agg(
        F.sort_array(F.collect_list(F.struct("place", "rendered", "train_start", "train_end"))).alias("turns")
    )
    return grouped.select(
        "conv_id",
        "side",
        F.array_join(F.transform("turns", lambda t: t["rendered"]), "").alias("text"),
        F.transform(
            F.filter("turns", lambda t: t["train_start"].isNotNull()),
            lambda t: F.struct(t["train_start"].alias("start"), t["train_end"].alias("end")),
        ).alias("masks"),
    )
