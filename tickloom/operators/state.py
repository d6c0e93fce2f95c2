"""Detector memory as a key-value table, and back.

The table has one row per key (state_key, state_value, updated_at) and every value is text. It is
never collected: it is decoded into small DataFrames that join the next batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.config import GapSettings
from tickloom.functions import fixed
from tickloom.functions.text import number_text

_ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"
_LEG_PREFIX = "GAP__leg__"
PROCESSED_KEY = "ALERTS__last_processed"
# Owner of the keys that belong to no symbol; symbols are not empty.
JOB = ""


def _iso(ts: Column) -> Column:
    return F.date_format(ts, _ISO)


def _entries(rows: DataFrame, key: Column, value: Column) -> DataFrame:
    return rows.select(key.alias("state_key"), value.alias("state_value"))


def owner_of(key: Column) -> Column:
    """What a key belongs to: its symbol, or one name for all keys of the job itself. All keys of a
    symbol share an owner, so that the state of a batch's symbols can be found without the rest."""
    of_job = F.startswith(key, F.lit("GAP__")) | F.startswith(key, F.lit("ALERTS__"))
    of_alert = F.endswith(key, F.lit(fixed.ALERT_TIME_SUFFIX))
    plain = F.regexp_replace(key, f"(?:{fixed.LAST_PRICE_SUFFIX}|{fixed.PRICE_HISTORY_SUFFIX})$", "")
    alerted = F.regexp_extract(key, rf"^(.*)__(.*){fixed.ALERT_TIME_SUFFIX}$", 1)
    return F.when(of_job, F.lit(JOB)).when(of_alert, alerted).otherwise(plain)


# --- decode ----------------------------------------------------------------------------------


def last_price_state(state: DataFrame) -> DataFrame:
    """(symbol, price) of the last price keys."""
    return state.filter(F.endswith("state_key", F.lit(fixed.LAST_PRICE_SUFFIX))).select(
        F.regexp_extract("state_key", f"^(.*){fixed.LAST_PRICE_SUFFIX}$", 1).alias("symbol"),
        F.col("state_value").try_cast("double").alias("price"),
    )


def price_history_state(state: DataFrame) -> DataFrame:
    """(symbol, price, back): the buffered prices, ``back`` = 1 the newest."""
    return (
        state.filter(F.endswith("state_key", F.lit(fixed.PRICE_HISTORY_SUFFIX)))
        .select(
            F.regexp_extract("state_key", f"^(.*){fixed.PRICE_HISTORY_SUFFIX}$", 1).alias("symbol"),
            F.posexplode(F.reverse(F.from_json("state_value", "array<double>"))).alias("_at", "price"),
        )
        .select("symbol", "price", (F.col("_at") + 1).alias("back"))
    )


def history_or_last_price(state: DataFrame) -> DataFrame:
    """The price history, and where a symbol has none, its last price alone."""
    history = price_history_state(state)
    alone = last_price_state(state).join(history.select("symbol"), "symbol", "left_anti")
    return history.unionByName(alone.withColumn("back", F.lit(1)))


def last_alert_state(state: DataFrame, settings: GapSettings = GapSettings()) -> DataFrame:
    """(symbol, alert_type, seed_t, seed_v): when each kind of alert last fired.

    The kind is the last part of the key: symbols may contain the separator's characters.
    """
    pattern = rf"^(.*)__(.*){fixed.ALERT_TIME_SUFFIX}$"
    timed = state.filter(F.endswith("state_key", F.lit(fixed.ALERT_TIME_SUFFIX))).select(
        F.regexp_extract("state_key", pattern, 1).alias("symbol"),
        F.regexp_extract("state_key", pattern, 2).alias("alert_type"),
        F.unix_micros(F.col("state_value").try_cast("timestamp")).alias("seed_t"),
        F.lit(0.0).alias("seed_v"),
    )
    amount = F.max(F.when(F.col("state_key") == fixed.GAP_AMOUNT_KEY, F.col("state_value"))).try_cast("double")
    at = F.max(F.when(F.col("state_key") == fixed.GAP_TIME_KEY, F.col("state_value"))).try_cast("timestamp")
    gap = (
        state.filter(F.col("state_key").isin(fixed.GAP_TIME_KEY, fixed.GAP_AMOUNT_KEY))
        .agg(
            F.unix_micros(at).alias("seed_t"),
            # An unknown last gap counts as infinitely far away.
            F.coalesce(amount, F.lit(float("inf"))).alias("seed_v"),
        )
        .filter(F.col("seed_t").isNotNull())
        .select(F.lit(settings.alert_symbol).alias("symbol"), F.lit(fixed.GOLD_GAP).alias("alert_type"), "seed_t", "seed_v")
    )
    return timed.unionByName(gap)


def leg_state(state: DataFrame) -> DataFrame:
    """(symbol, price, at): the last price and time of each gap leg."""
    value = F.from_json("state_value", "price double, at string")
    return state.filter(F.startswith("state_key", F.lit(_LEG_PREFIX))).select(
        F.substring("state_key", F.lit(len(_LEG_PREFIX) + 1), F.length("state_key")).alias("symbol"),
        value["price"].alias("price"),
        value["at"].try_cast("timestamp").alias("at"),
    )


def processed_until(state: DataFrame) -> DataFrame:
    """(at): the newest event time already processed; no row on a fresh start."""
    return state.filter(F.col("state_key") == PROCESSED_KEY).select(F.col("state_value").try_cast("timestamp").alias("at"))


# --- encode ----------------------------------------------------------------------------------


def price_entries(history: DataFrame) -> DataFrame:
    """Last price and history keys from (symbol, price, back)."""
    newest_last = F.transform(F.array_sort(F.collect_list(F.struct((-F.col("back")).alias("at"), "price"))), lambda r: r["price"])
    per_symbol = history.groupBy("symbol").agg(newest_last.alias("prices"))
    return _entries(
        per_symbol, F.concat("symbol", F.lit(fixed.LAST_PRICE_SUFFIX)), number_text("element_at(prices, -1)")
    ).unionByName(_entries(per_symbol, F.concat("symbol", F.lit(fixed.PRICE_HISTORY_SUFFIX)), F.to_json("prices")))


def alert_entries(alerts: DataFrame) -> DataFrame:
    """Alert time keys, and the time and amount of the last gap, from alert rows."""
    latest = alerts.groupBy("symbol", "alert_type").agg(
        F.max("created_at").alias("at"), F.max_by("change_amount", F.struct("created_at", "alert_id")).alias("amount")
    )
    is_gap = F.col("alert_type") == fixed.GOLD_GAP
    moves, gaps = latest.filter(~is_gap), latest.filter(is_gap)
    return (
        _entries(moves, F.concat("symbol", F.lit("__"), "alert_type", F.lit(fixed.ALERT_TIME_SUFFIX)), _iso(F.col("at")))
        .unionByName(_entries(gaps, F.lit(fixed.GAP_TIME_KEY), _iso(F.col("at"))))
        .unionByName(_entries(gaps, F.lit(fixed.GAP_AMOUNT_KEY), number_text("amount")))
    )


def leg_entries(legs: DataFrame) -> DataFrame:
    value = F.to_json(F.struct("price", _iso(F.col("at")).alias("at")))
    return _entries(legs, F.concat(F.lit(_LEG_PREFIX), "symbol"), value)


def processed_entry(high_water: DataFrame) -> DataFrame:
    """From the one-row (high_water)."""
    return _entries(
        high_water.filter(F.col("high_water").isNotNull()), F.lit(PROCESSED_KEY), _iso(F.col("high_water"))
    )
