"""The layout of large keys: slices of few rows cost neither tasks nor rows at the driver."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from test_gate import band, cooldown, greedy, hot_rows
from tickloom.operators.gate import Band, Cooldown, gate
from tickloom.operators.slices import SLICE, slice_rows

SCHEMA = "key string, t long, id long, v double"


def test_slices_do_not_set_the_number_of_tasks(spark):
    rows = hot_rows(2000, 1, 2)
    sliced = slice_rows(spark.createDataFrame(rows, SCHEMA), ["key"], ["t", "id"], 10)
    assert sliced.rows.rdd.getNumPartitions() == 8
    laid = sliced.rows.collect()
    per_slice = {}
    for r in laid:
        per_slice.setdefault(r[SLICE], []).append((r.key, r.t, r.id, r.v))
    assert len(per_slice) >= 200 and max(map(len, per_slice.values())) <= 10
    assert max(per_slice) < sliced.count
    # Slices follow each other in order, and each is within one task.
    assert [row for s in sorted(per_slice) for row in sorted(per_slice[s])] == sorted(rows)
    tasks = sliced.rows.select(SLICE, F.spark_partition_id().alias("task")).distinct().collect()
    assert len(tasks) == len(per_slice)
    spans = {r.key for r in sliced.spanning.collect()}
    assert spans == {k for k, *_ in rows if len({s for s, own in per_slice.items() if any(o[0] == k for o in own)}) > 1}


@pytest.mark.parametrize(
    "rule, passes, pct",
    [(Cooldown(60), cooldown(60), 0.0), (Cooldown(600, True, 8.0), cooldown(600, True, 8.0), 0.0), (Band(), band(4.0), 4.0)],
)
def test_small_slices_send_the_driver_no_rows(spark, monkeypatch, rule, passes, pct):
    rows = hot_rows(1500, 7, 2)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    sent, collect = [0], type(df).collect

    def counted(self):
        found = collect(self)
        sent.append(len(found))
        return found

    monkeypatch.setattr(type(df), "collect", counted)
    got = gate(df, ["key"], ["t", "id"], rule, "t", "v", F.lit(pct), rows_per_slice=7)
    assert max(sent) <= 1
    monkeypatch.undo()
    assert got.rdd.getNumPartitions() <= 8
    assert {r.id for r in got.collect()} == greedy(rows, passes)


def test_slice_of_the_successor_equals_a_look_at_each():
    from tickloom.operators.gate import _bare_walk
    from tickloom.operators.successors import first_slices

    rng = np.random.default_rng(5)
    for n in (1, 2, 3, 7, 8, 33):
        nodes = np.cumsum(rng.integers(1, 4, n)).astype(np.int32)
        last = np.cumsum(rng.integers(0, 5, n)) * 1_000_000
        low = rng.integers(0, 20, n).astype(float)
        high = low + rng.integers(0, 6, n)
        high[rng.random(n) < 0.2] = np.nan
        low[np.isnan(high)] = np.nan
        after = rng.integers(-1, nodes[-1] + 2, 80)
        t, v, none = rng.integers(0, last[-1] + 1, 80), rng.integers(0, 25, 80).astype(float), rng.random(80) < 0.1
        after[none] = -1
        for rule in (Cooldown(9), Cooldown(40, True, 12.0), Cooldown(9, True, 20.0)):
            got = first_slices(rule, _bare_walk, (nodes, last, high, low), after, t, v, none)
            for i in range(80):
                want = int(nodes[0]) if none[i] else next(
                    (
                        int(nodes[j])
                        for j in range(n)
                        if nodes[j] > after[i]
                        and (rule.passes(_bare_walk(last[j : j + 1], high[j : j + 1]), t[i], v[i])[0]
                             or rule.passes(_bare_walk(last[j : j + 1], low[j : j + 1]), t[i], v[i])[0])
                    ),
                    -1,
                )
                assert got[i] == want
