import pytest
from helpers import at, ticks_frame
from pyspark.sql import functions as F

from tickloom.config import OutlierSettings
from tickloom.operators import clean


@pytest.mark.parametrize(
    "rows, settings, want",
    [
        ([("x", 4000)], {}, "T"),
        ([("x", None)], {}, ""),
        ([("x", 4000), ("x", 4300)], {}, "TT"),
        ([("x", 4000), ("x", 4500), ("x", 4300)], {}, "TFT"),
        ([("x", 4000), ("y", 50), ("x", 4300), ("y", 60)], {}, "TTTF"),
        ([("x", 4000), ("x", 4400)], {}, "TT"),
        ([("x", 4000), ("x", 3500)], {}, "TF"),
        ([("x", 6000), ("x", 6400), ("x", 6200)], {"threshold_pct": 5.0}, "TFT"),
        ([("x", 4066.5), ("x", 4192.1)], {}, "TT"),
        ([("x", 6000), ("y", 6000), ("x", 6400), ("y", 6400)], {"per_symbol_pct": {"y": 5.0}}, "TTTF"),
        # After a zero anything is taken; a negative base never rejects.
        ([("x", 0), ("x", 5), ("x", 9)], {}, "TTF"),
        ([("x", -5), ("x", 100)], {}, "TT"),
    ],
)
def test_outliers(spark, rows, settings, want):
    ticks = ticks_frame(spark, [(i, s, p) for i, (s, p) in enumerate(rows)])
    got = clean.outlier_flags(ticks, OutlierSettings(**settings)).orderBy("tick_id").collect()
    assert "".join("T" if r.accepted else "F" for r in got) == want


def test_outliers_go_on_from_the_last_accepted_price(spark):
    last = spark.createDataFrame([("x", 4000.0)], "symbol string, price double")
    ticks = ticks_frame(spark, [(0, "x", 4500), (1, "x", 4100), (2, "y", 9)])
    got = clean.without_outliers(ticks, last_accepted=last)
    assert sorted(r.price for r in got.collect()) == [9.0, 4100.0]


def test_valid_ticks(spark):
    rows = [(0, "a", 1), (1, "a", 0), (2, "a", -1), (3, "a", None), (4, None, 1)]
    ticks = ticks_frame(spark, rows).withColumn("event_time", F.when(F.col("tick_id") > 0, F.col("event_time")))
    assert [r.tick_id for r in clean.valid_ticks(ticks).collect()] == [0]


def test_duplicates_and_rows_already_written(spark):
    rows = [(0, "a", 1), (0, "a", 1), (0, "a", 2), (1, "a", 1), (1, "a", 1)]
    ticks = ticks_frame(spark, rows)
    assert sorted(r.tick_id for r in clean.first_of_duplicates(ticks).collect()) == [0, 2, 3]
    assert clean.distinct_ticks(ticks).count() == 3
    unknown = ticks.withColumn("event_time", F.when(F.col("tick_id") < 4, F.col("event_time")))
    written = unknown.filter("tick_id in (0, 4)")
    # Null times are equal here; copies of a written tick go with it.
    assert sorted(r.tick_id for r in clean.without_written(unknown, written).collect()) == [2, 3]
    since = F.lit(at(1)).cast("timestamp")
    assert sorted(r.tick_id for r in clean.without_written(unknown, written, since).collect()) == [0, 1, 2, 3]


def test_hot_copies_combine_before_the_shuffle(spark):
    plan = clean.first_of_duplicates(ticks_frame(spark, [(0, "a", 1)]))._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan
