import tempfile

import pytest
from helpers import START, at, ticks_frame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom import schemas
from tickloom.config import GapSettings
from tickloom.operators import state as states
from tickloom.sinks import messages
from tickloom.sinks import tables as sinks
from tickloom.sources import quotes, tables


def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def test_parquet_by_declared_name(spark):
    place = folder()
    assert tables.parquet_rows(spark, f"{place}/none", schemas.BRONZE).count() == 0
    assert tables.parquet_rows(spark, place, schemas.BRONZE).columns == schemas.BRONZE.names
    spark.createDataFrame([("a", 1.0)], "symbol string, price double").write.parquet(f"{place}/t/x")
    spark.createDataFrame([(2.0, "b", "s")], "price double, symbol string, source string").write.parquet(f"{place}/t/y")
    got = tables.parquet_rows(spark, f"{place}/t/*", schemas.BRONZE).orderBy("symbol").collect()
    assert [(r.symbol, r.price, r.source, r.event_time) for r in got] == [("a", 1.0, None, None), ("b", 2.0, "s", None)]
    files = tables.data_files(spark.read.parquet(f"{place}/t/x")).collect()
    assert sum(r.row_count for r in files) == 1 and all(r.file_size > 0 for r in files)


def test_catalog_tables(spark):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS lake LOCATION '{folder()}'")
    spark.sql("DROP TABLE IF EXISTS lake.ticks")
    for _ in range(2):
        sinks.create_table(spark, "lake.ticks", schemas.BRONZE, "event_time")
    ticks = ticks_frame(spark, [(0, "a", 1), (90000, "b", 2)]).withColumn("ingestion_time", F.col("event_time"))
    sinks.append_table(ticks.drop("tick_id"), "lake.ticks")
    rows = tables.table_rows(spark, "lake.ticks")
    assert {(r.symbol, str(r.event_date)) for r in rows.collect()} == {("a", "2024-01-01"), ("b", "2024-01-02")}
    assert "ticks" in [r.tableName for r in tables.tables_in(spark, "lake").collect()]
    assert "event_date" in [r.col_name for r in tables.table_details(spark, "lake.ticks").collect()]
    assert [r.symbol for r in tables.newest_rows(rows, limit=1).collect()] == ["b"]
    spark.sql("DROP TABLE lake.ticks")


def test_payloads(spark):
    rows = [
        ("USD/EGP", '{"rate": 48.5, "x": 1}'), ("XAU/USD", '{"price": 4066.5}'), ("XAU/USD", '{"price": null}'),
        ("XAU/USD", "<html>"), ("USD/EGP", None), ("USD/EGP", '{"rate": "49"}'),
    ]
    df = spark.createDataFrame([(s, p, START) for s, p in rows], schemas.PAYLOADS)
    got = [(r.symbol, r.price, r.source) for r in quotes.payload_ticks(df).collect()]
    assert got == [
        ("USD/EGP", 48.5, "fxapi"), ("XAU/USD", 4066.5, "gold_api"), ("XAU/USD", None, "fallback"),
        ("XAU/USD", None, "fallback"), ("USD/EGP", None, "fallback"), ("USD/EGP", 49.0, "fxapi"),
    ]


def table(*rows, attributes='class="local-cur"'):
    body = "".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in rows)
    return f"<html><body><table {attributes}>{body}</table></body></html>"


GRAM = "سعر 1 جرام عيار 21"


@pytest.mark.parametrize(
    "html, price, reason",
    [
        (table((GRAM, "6,550 جنيه")), 6550.0, None),
        (table((GRAM, "6550.75")), 6550.0, None),
        (table(("1 جرام عيار 24", "7,000"), ("x", "y", "z"), (GRAM, "6,550"), (GRAM, "1")), 6550.0, None),
        (table((GRAM, "soon"), (GRAM, "5")), 5.0, None),
        (table((GRAM, "9"), attributes="class='wide local-cur dark' id=t"), 9.0, None),
        (table((GRAM, "9"), attributes="CLASS=local-cur"), 9.0, None),
        (table((GRAM, "9"), attributes='class="local-currency"'), None, "table not found"),
        (table((GRAM, "9"), attributes=""), None, "table not found"),
        (table(("other", "9")), None, "row not found"),
        (table((f"<b>1 جرام</b>\n عيار <i>21</i>", " <span> 1,234 </span>&nbsp;جنيه")), 1234.0, None),
        ("<p>none</p>", None, "table not found"),
        (None, None, "table not found"),
    ],
)
def test_pages(spark, html, price, reason):
    df = spark.createDataFrame([("u", html, START)], "url string, html string, fetched_at timestamp")
    row = quotes.page_prices(df).first()
    assert (row.price, row.reason) == (price, reason)
    assert quotes.page_ticks(df).count() == (price is not None)


def test_state_keys_round_trip(spark):
    entries = [
        ("XAU/EGP_LOCAL__last_price", "6550.0"), ("XAU/EGP_LOCAL__price_history", "[6500.0, 6550.0]"),
        ("only__last_price", "3.5"),
        ("XAU/EGP_LOCAL__SPIKE_UP__alert_time", "2024-01-01T00:00:05+00:00"),
        ("a__b__UPTREND__alert_time", "2024-01-01T02:00:00.5+02:00"),
        ("GAP__last_alert_time", "2024-01-01T00:01:00+00:00"), ("GAP__last_gap_amount", "180.22"),
        ("GAP__leg__XAU/USD", '{"price": 3000.0, "at": "2024-01-01T00:00:01+00:00"}'),
        ("ALERTS__last_processed", "2024-01-01T00:02:00+00:00"),
    ]
    state = spark.createDataFrame([(k, v, START) for k, v in entries], schemas.STATE)
    us = 1704067200 * 10**6
    assert {tuple(r) for r in states.last_alert_state(state, GapSettings()).collect()} == {
        ("XAU/EGP_LOCAL", "SPIKE_UP", us + 5 * 10**6, 0.0), ("a__b", "UPTREND", us + 500000, 0.0),
        ("XAU_GAP", "GOLD_GAP", us + 60 * 10**6, 180.22),
    }
    assert {tuple(r) for r in states.history_or_last_price(state).collect()} == {
        ("XAU/EGP_LOCAL", 6550.0, 1), ("XAU/EGP_LOCAL", 6500.0, 2), ("only", 3.5, 1),
    }
    assert [tuple(r) for r in states.leg_state(state).collect()] == [("XAU/USD", 3000.0, at(1).replace(tzinfo=None))]
    assert states.processed_until(state).first()["at"] == at(120).replace(tzinfo=None)
    # An unknown last gap amount never suppresses.
    half = state.filter("state_key <> 'GAP__last_gap_amount'")
    assert states.last_alert_state(half).filter("symbol = 'XAU_GAP'").first().seed_v == float("inf")


def test_upsert(spark):
    target = spark.createDataFrame([("a", "1", at(0)), ("b", "2", at(0))], schemas.STATE)
    updates = spark.createDataFrame([("b", "3", at(1)), ("b", "4", at(2)), ("c", "5", at(1))], schemas.STATE)
    got = {r.state_key: (r.state_value, r.updated_at) for r in sinks.upsert(target, updates).collect()}
    assert got == {
        "a": ("1", at(0).replace(tzinfo=None)), "b": ("4", at(2).replace(tzinfo=None)), "c": ("5", at(1).replace(tzinfo=None)),
    }


def test_messages(spark):
    rows = [
        ("i1", "XAU/USD", "SPIKE_UP", "LOW", "Price moved 0.6%", 4066.5, 0.6, None, START, {"previous_price": "4042.0"}),
        ("i2", "XAU_GAP", "GOLD_GAP", "HIGH", "Gold gap", 1234567.891, 0.0, 300.0, datetime_summer(), {"expected_local": "1.5"}),
        ("i3", "s", "NEW", "ODD", "m", None, None, None, START, None),
    ]
    alerts = spark.createDataFrame(rows, schemas.ALERTS)
    text = {r.alert_id: r.text.split("\n") for r in messages.outbox_rows(alerts).collect()}
    assert text["i1"] == [
        "📈 *SPIKE_UP* 🟢", "🕐 `2024-01-01 02:00:00 (Cairo)`", "*Symbol:* `XAU/USD`", "*Message:* Price moved 0.6%",
        "*Price:* `4,066.50`", "*Previous:* `4042.0`",
    ]
    assert text["i2"] == [
        "🔔 *GOLD_GAP* 🔴", "🕐 `2024-07-01 03:00:00 (Cairo)`", "*Symbol:* `XAU_GAP`", "*Message:* Gold gap",
        "*Price:* `1,234,567.89`", "*Expected:*    `1.5 EGP`", "*Actual:*      `N/A EGP`", "*USD/EGP:*     `N/A`",
        "*Global Gold:* `N/A USD`",
    ]
    assert text["i3"] == ["⚠️ *NEW* ", "🕐 `2024-01-01 02:00:00 (Cairo)`", "*Symbol:* `s`", "*Message:* m"]
    sent = spark.createDataFrame([("i1",), ("i3",)], "alert_id string")
    assert [r.alert_id for r in messages.outbox_rows(alerts, sent).collect()] == ["i2"]


def datetime_summer():
    from datetime import datetime, timezone

    return datetime(2024, 7, 1, tzinfo=timezone.utc)


def test_schemas_hold_what_the_jobs_write():
    assert schemas.SILVER.names[:5] == schemas.BRONZE.names
    assert isinstance(schemas.ALERTS["extra_data"].dataType, T.MapType)
