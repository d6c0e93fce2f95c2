"""Plain-Python versions of the rules, for comparison."""

from datetime import datetime, timedelta, timezone

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def at(seconds):
    return START + timedelta(seconds=seconds)


TICK_DDL = "tick_id long, symbol string, price double, source string, event_time timestamp"


def ticks_frame(spark, rows):
    """rows: (seconds, symbol, price)"""
    return spark.createDataFrame([(i, s, None if p is None else float(p), "test", at(t)) for i, (t, s, p) in enumerate(rows)], TICK_DDL)


def signal_loop(rows, settings):
    """rows: (t seconds, id, symbol, price) in order -> {(id, type)}"""
    last, buffer, fired, out = {}, {}, {}, set()

    def fire(symbol, kind, t, i):
        before = fired.get((symbol, kind))
        if before is None or t - before > settings.cooldown_seconds:
            fired[symbol, kind] = t
            out.add((i, kind))

    for t, i, symbol, price in rows:
        if price is None:
            continue
        prev = last.get(symbol)
        if prev is not None:
            pct = round(abs((price - prev) / prev * 100) if prev else 0.0, 3)
            if pct >= settings.spike_threshold_pct:
                fire(symbol, "SPIKE_UP" if price > prev else "SPIKE_DOWN", t, i)
        held = buffer.setdefault(symbol, [])
        held.append(price)
        del held[: -settings.trend_count]
        if len(held) == settings.trend_count >= 3:
            steps = [b - a for a, b in zip(held, held[1:])]
            if min(steps) > 0:
                fire(symbol, "UPTREND", t, i)
            elif max(steps) < 0:
                fire(symbol, "DOWNTREND", t, i)
        last[symbol] = price
    return out


def gap_loop(rows, g):
    """rows as above -> {id: gap} of fired gaps"""
    price, when, fired, out = {}, {}, None, {}
    for t, i, symbol, p in rows:
        if p is None or symbol not in g.legs:
            continue
        price[symbol], when[symbol] = p, t
        if len(price) < 3:
            continue
        if t - when[g.global_symbol] > g.stale_global_seconds or t - when[g.local_symbol] > g.stale_local_seconds:
            continue
        expected = price[g.global_symbol] * price[g.rate_symbol] * g.purity / g.grams_per_ounce
        gap = round(abs(price[g.local_symbol] - expected), 2)
        if gap < g.threshold:
            continue
        if fired and t - fired[0] < g.cooldown_seconds and abs(gap - fired[1]) < g.min_change:
            continue
        fired = (t, gap)
        out[i] = gap
    return out
