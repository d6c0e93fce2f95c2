import random

import pytest
from helpers import at, gap_loop, signal_loop, ticks_frame
from pyspark.sql import functions as F

from tickloom.config import GapSettings, Settings, SeveritySettings, SignalSettings
from tickloom.functions.measures import percent_change, severity
from tickloom.operators.alerts import detect_alerts
from tickloom.operators.detect import ordered_ticks, signal_alerts, with_signals
from tickloom.operators.gap import gap_alerts


def test_percent_change(spark):
    cases = [(110.0, 100.0, 10.0), (90.0, 100.0, 10.0), (100.0, 0.0, 0.0), (100.0, None, 0.0), (100.0, 100.0, 0.0)]
    df = spark.createDataFrame(cases, "c double, b double, want double")
    got = df.select(percent_change(F.col("c"), F.col("b")).alias("got"), "want").collect()
    assert all(abs(r.got - r.want) < 1e-9 for r in got)


@pytest.mark.parametrize(
    "prices, n, want",
    [
        ([1, 2, 3, 4, 5], 5, "UPTREND"),
        ([5, 4, 3, 2, 1], 5, "DOWNTREND"),
        ([1, 1, 1, 1, 1], 5, None),
        ([1, 3, 2, 4, 3], 5, None),
        ([1, 2], 2, None),
        ([1, 2, 3], 3, "UPTREND"),
        ([2, 3, 4, 5], 5, None),
    ],
)
def test_trend(spark, prices, n, want):
    ticks = ticks_frame(spark, [(i, "s", p) for i, p in enumerate(prices)])
    rows = with_signals(ordered_ticks(ticks), SignalSettings(trend_count=n)).orderBy("tick_id").collect()
    assert rows[-1].trend == want
    assert all(r.trend is None for r in rows[:-1])


def test_spike_and_cooldown_at_their_limits(spark):
    s = SignalSettings(spike_threshold_pct=0.5, cooldown_seconds=300)
    # 0.49 % no, 0.5 % yes; exactly the cooldown later is still suppressed, one second more fires.
    below = signal_alerts(ticks_frame(spark, [(0, "s", 10000), (1, "s", 10049)]), s)
    assert below.count() == 0
    rows = [(0, "s", 1000), (1, "s", 1005), (2, "s", 1000), (301, "s", 1010), (302, "s", 1000), (303, "s", 1010)]
    got = {(r.tick_id, r.alert_type, r.message) for r in signal_alerts(ticks_frame(spark, rows), s).collect()}
    assert got == {
        (1, "SPIKE_UP", "Price moved 0.5%"),
        (4, "SPIKE_DOWN", "Price moved 0.99%"),
        (5, "SPIKE_UP", "Price moved 1.0%"),
    }


def test_severity_bands(spark):
    cases = [
        ("SPIKE_UP", None, "LOW"), ("SPIKE_UP", 119.9, "LOW"), ("SPIKE_UP", 120.0, "MEDIUM"),
        ("SPIKE_UP", 199.9, "MEDIUM"), ("UPTREND", 200.0, "HIGH"), ("GOLD_GAP", 149.9, "LOW"),
        ("GOLD_GAP", 150.0, "MEDIUM"), ("GOLD_GAP", 299.9, "MEDIUM"), ("GOLD_GAP", 300.0, "HIGH"),
        ("GOLD_GAP", None, "LOW"),
    ]
    df = spark.createDataFrame(cases, "t string, a double, want string")
    got = df.select(severity(F.col("t"), F.col("a"), SeveritySettings()).alias("got"), "want").collect()
    assert all(r.got == r.want for r in got)


def feed(local, t=0):
    return [(t, "XAU/USD", 3000), (t + 1, "USD/EGP", 50), (t + 2, "XAU/EGP_LOCAL", local)]


@pytest.mark.parametrize(
    "rows, changes, want",
    [
        (feed(4220), {}, []),
        (feed(4400), {}, [2]),
        (feed(4400)[:2], {}, []),
        ([(0, "XAU/USD", None)], {}, []),
        (feed(4400) + [(400, "XAU/EGP_LOCAL", 4500)], {}, [2]),
        (feed(4400) + feed(4400, 60), {}, [2]),
        (feed(4400) + feed(4460, 60), {}, [2, 5]),
        (feed(4400) + feed(4410, 60), {}, [2]),
        (feed(4400) + [(252, "XAU/USD", 3000)], {}, [2]),
        (feed(4400), {"cooldown_seconds": 0}, [2]),
        # Exactly at the cooldown it fires again; one second before it does not.
        (feed(4400) + feed(4400, 3600), {}, [2, 5]),
        (feed(4400) + [(3598, "XAU/USD", 3000), (3599, "USD/EGP", 50), (3601, "XAU/EGP_LOCAL", 4400)], {}, [2]),
        # Ages exactly at their limits count as fresh.
        (feed(4400)[:2] + [(300, "XAU/EGP_LOCAL", 4400)], {}, [2]),
        (feed(4400)[:2] + [(301, "XAU/EGP_LOCAL", 4400)], {}, []),
        (feed(4400) + [(182, "XAU/USD", 3500)], {}, [2, 3]),
        (feed(4400) + [(183, "XAU/USD", 3500)], {}, [2]),
    ],
)
def test_gap_cases(spark, rows, changes, want):
    got = gap_alerts(ticks_frame(spark, rows), GapSettings(**changes)).orderBy("tick_id").collect()
    # While two legs of a feed move, the old third one stands: only alerts of whole feeds count.
    assert [r.tick_id for r in got] == want
    for r in got:
        assert r.global_age_sec is not None and r.local_age_sec is not None


def random_ticks(seed, n=900):
    rng = random.Random(seed)
    price = {"XAU/USD": 3000.0, "USD/EGP": 50.0, "XAU/EGP_LOCAL": 4300.0, "other": 10.0}
    rows, t = [], 0
    for _ in range(n):
        t += rng.choice([0, 1, 5, 20, 90])
        symbol = "XAU/USD" if rng.random() < 0.6 else rng.choice(list(price))
        price[symbol] = round(price[symbol] * (1 + rng.uniform(-0.012, 0.012)), 2)
        rows.append((t, symbol, None if rng.random() < 0.02 else price[symbol]))
    return rows


SETTINGS = Settings(signals=SignalSettings(0.6, 4, 60), gap=GapSettings(cooldown_seconds=600, stale_local_seconds=240))


@pytest.mark.parametrize("rows_per_slice", [10**6, 60])
def test_alerts_equal_a_loop(spark, rows_per_slice):
    rows = random_ticks(7)
    got = detect_alerts(ticks_frame(spark, rows), SETTINGS, rows_per_slice=rows_per_slice).collect()
    ordered = [(t, i, s, p) for i, (t, s, p) in enumerate(rows)]
    signals = signal_loop(ordered, SETTINGS.signals)
    gaps = gap_loop(ordered, SETTINGS.gap)
    assert len(signals) > 20 and len(gaps) > 5
    want = {(kind, at(rows[i][0]), rows[i][2]) for i, kind in signals}
    assert {(r.alert_type, r.created_at.astimezone(at(0).tzinfo), r.current_price) for r in got if r.alert_type != "GOLD_GAP"} == want
    assert sum(r.alert_type != "GOLD_GAP" for r in got) == len(signals)
    assert sorted(r.change_amount for r in got if r.alert_type == "GOLD_GAP") == sorted(gaps.values())
    assert len({r.alert_id for r in got}) == len(got)
