"""The gate against a plain loop, whole and in slices of every size."""

import random

import pytest
from pyspark.sql import functions as F

from tickloom.operators.gate import Band, Cooldown, gate


def greedy(rows, passes):
    """rows: (key, t, id, v) in order per key -> ids that pass."""
    last, out = {}, set()
    for key, t, i, v in sorted(rows):
        if key not in last or passes(t, v, *last[key]):
            last[key] = (t, v)
            out.add(i)
    return out


def cooldown(seconds, at_exactly=False, min_change=None):
    def passes(t, v, last_t, last_v):
        elapsed = t - last_t
        over = elapsed >= seconds * 10**6 if at_exactly else elapsed > seconds * 10**6
        return over or (min_change is not None and abs(v - last_v) >= min_change)

    return passes


def band(pct):
    def passes(t, v, last_t, last_v):
        return last_v == 0 or not abs(v - last_v) / last_v * 100 > pct

    return passes


def hot_rows(n, seed, step):
    """One key holds most rows; times repeat; some values jump and stay away for a while."""
    rng = random.Random(seed)
    rows, t, v, away = [], 0, 100.0, 0
    for i in range(n):
        t += rng.choice([0, 0, 1, step, 40 * step if rng.random() < 0.01 else 1]) * 250_000
        v = max(1.0, v * (1 + rng.uniform(-0.03, 0.03)))
        if rng.random() < 0.01:
            away = rng.randint(1, 60)
        away = max(0, away - 1)
        key = "hot" if rng.random() < 0.7 else rng.choice("abcdefg")
        rows.append((key, t, i, round(v * (1.5 if away else 1.0), 2)))
    return rows


CASES = [
    (Cooldown(30), cooldown(30), 3),
    (Cooldown(600), cooldown(600), 1),
    (Cooldown(30, at_exactly=True), cooldown(30, True), 4),
    (Cooldown(600, at_exactly=True, min_change=8.0), cooldown(600, True, 8.0), 1),
    (Cooldown(10**6, at_exactly=True, min_change=25.0), cooldown(10**6, True, 25.0), 2),
    (Band(), band(5.0), 1),
    (Band(), band(2.0), 1),
    (Band(), band(150.0), 1),
    (Band(), band(100.0), 1),
    (Band(), band(0.0), 1),
]
LIMITS = {5: 5.0, 6: 2.0, 7: 150.0, 8: 100.0, 9: 0.0}


@pytest.mark.parametrize("case", range(len(CASES)))
@pytest.mark.parametrize("rows_per_slice", [10**6, 90])
def test_gate_equals_a_loop(spark, case, rows_per_slice):
    rule, passes, step = CASES[case]
    rows = hot_rows(1200, case, step)
    if case >= 7:  # few values, among them zero and some below it, and jumps beyond the limit
        rows = [(k, t, i, float([0, 1, 2, 3, 7, 20, 60, -1, -4][int(v * 100) % (9 if i % 5 == 0 else 7)])) for k, t, i, v in rows]
    pct = LIMITS.get(case, 0.0)
    df = spark.createDataFrame(rows, "key string, t long, id long, v double").repartition(5)
    got = gate(df, ["key"], ["t", "id"], rule, "t", "v", F.lit(pct), rows_per_slice=rows_per_slice)
    assert got.columns == ["key", "t", "id", "v"]
    assert {r.id for r in got.collect()} == greedy(rows, passes)


@pytest.mark.parametrize("case", [0, 1])
def test_dense_key(spark, case, monkeypatch):
    """Tens of thousands of candidates within a cooldown: nothing grows beyond a slice."""
    from tickloom.operators import successors

    rng = random.Random(case)
    t, rows = 0, []
    for i in range(30_000):
        # Three cooldowns of steady beats, a pause, and one more.
        t += 10 + rng.randrange(3) + (10**9 if i == 20_000 else 0)
        rows.append(("hot" if i % 50 else "cold", t * 1000, i, round(100 + rng.random() * (40 if i % 4000 == 0 else 10), 2)))
    seconds = 75.0
    rule, passes = [(Cooldown(seconds), cooldown(seconds)), (Cooldown(seconds, True, 20.0), cooldown(seconds, True, 20.0))][case]
    sizes = []
    dealt = successors.in_portions

    def watched(asked, summaries, keys, portion):
        found = dealt(asked, summaries, keys, portion)
        for df in found:
            sizes.append(df.groupBy(*keys, "_node", "_part").count().agg(F.max("count")).first()[0])
        return found

    monkeypatch.setattr(successors, "in_portions", watched)
    monkeypatch.setattr(successors, "PORTION", 600)
    df = spark.createDataFrame(rows, "key string, t long, id long, v double").repartition(5)
    got = gate(df, ["key"], ["t", "id"], rule, "t", "v", rows_per_slice=1500)
    want = greedy(rows, passes)
    assert {r.id for r in got.collect()} == want and len(want) > 5
    # Portions are dealt by hash, so they are even but for chance.
    assert len(sizes) == 2 and max(sizes) <= 1500


def test_summaries_stay_short(spark):
    """A steady value on a steady beat: the walk is known from few rows per slice."""
    import numpy as np

    from tickloom.operators.gate import Walk, _distinct_ends, exits

    t = np.arange(20000, dtype=np.int64) * 10**6
    rows = Walk(t, 100 + np.sin(t / 10**8), np.zeros(len(t)))
    for rule in (Cooldown(300), Cooldown(300, True, 50.0)):
        openers = rule.openers(rows)
        ends = exits(rule, rows, openers)
        inside = Walk(rows.t[openers], rows.v[openers], rows.limit[openers])
        assert len(_distinct_ends(rule, inside, rows.t[ends], rows.v[ends])) <= 302
    rows = Walk(t, 100 + np.sin(t / 10**8), np.full(len(t), 5.0))
    # Each opener widens the band, so it is a new high or low.
    high, low = np.maximum.accumulate(rows.v), np.minimum.accumulate(rows.v)
    records = 1 + int(((rows.v[1:] > high[:-1]) | (rows.v[1:] < low[:-1])).sum())
    assert len(Band().openers(rows)) <= records < len(rows) / 50


def test_wide_and_empty_bands_have_short_summaries(spark):
    import numpy as np

    from tickloom.operators.gate import Walk

    rng = np.random.default_rng(3)
    t = np.arange(20000, dtype=np.int64)
    rising = Walk(t, 100 + np.cumsum(rng.random(len(t))), np.full(len(t), 150.0))
    assert len(Band().openers(rising)) == 1
    steps = Walk(t, rng.integers(1, 150, len(t)).astype(float), np.zeros(len(t)))
    assert len(Band().openers(steps)) <= 150 < len(t) / 100
    wide = Walk(t, rng.lognormal(5, 1, len(t)), np.full(len(t), 150.0))
    assert len(Band().openers(wide)) < len(t) / 100


def test_openers_are_all_that_can_be_first(spark):
    import numpy as np

    from tickloom.operators.gate import Walk, first_pass

    rng = np.random.default_rng(4)
    for limit in (0.0, 3.0, 99.0, 100.0, 101.0, 150.0, 400.0):
        for _ in range(40):
            v = rng.choice([0.0, -1.0, -3.0, 1.0, 2.0, 2.5, 4.0, 9.0, 50.0, float("nan")], 12)
            rows = Walk(np.arange(12), v, np.full(12, limit))
            openers = set(Band().openers(rows).tolist())
            for base in [None, -2.0, 0.0, 0.4, 0.8, 1.0, 1.01, 1.6, 2.0, 2.6, 4.4, 20.0, 25.0, 60.0, 1e6]:
                first = first_pass(Band(), rows, 0, None if base is None else (0, base))
                assert first == 12 or first in openers, (limit, v, base)


def test_long_summaries_go_in_pairs(spark, monkeypatch):
    from tickloom.operators import gate as module

    monkeypatch.setattr(module, "ROWS_PER_SLICE", 10)
    rows = hot_rows(800, 3, 1)
    df = spark.createDataFrame(rows, "key string, t long, id long, v double")
    rule, passes, _ = CASES[3]
    got = gate(df, ["key"], ["t", "id"], rule, "t", "v", rows_per_slice=100)
    assert {r.id for r in got.collect()} == greedy(rows, passes)
