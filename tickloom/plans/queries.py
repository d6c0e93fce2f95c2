"""The operators as named queries over the driver's tables.

``events`` serve as ticks (event type = symbol, value = price), ``lineitem`` as ticks of many
suppliers. Every query reads its tables whole.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom import schemas
from tickloom.config import GapSettings, HealthSettings, OutlierSettings, Settings, SignalSettings
from tickloom.functions.measures import severity
from tickloom.operators import alerts as alert_ops
from tickloom.operators import bars, clean, detect, gap, health
from tickloom.operators import state as states
from tickloom.plans import reports
from tickloom.plans.health_cycle import health_cycle
from tickloom.plans.lineage import cut_lineage, ensure_checkpoint_dir
from tickloom.sinks.messages import outbox_rows
from tickloom.sinks.tables import append_parquet, delete_files, upsert
from tickloom.sources import quotes, tables
from tickloom.streaming import alert_job, ingest, outliers

NOW = "2024-01-31 00:00:00"
RESTART_AT = "2024-01-16 00:00:00"

SETTINGS = Settings(
    signals=SignalSettings(spike_threshold_pct=50.0, trend_count=4, cooldown_seconds=3600),
    gap=GapSettings(
        global_symbol="click",
        rate_symbol="view",
        local_symbol="purchase",
        threshold=5.0,
        min_change=40.0,
        cooldown_seconds=10800,
        stale_global_seconds=7200,
        stale_local_seconds=7200,
    ),
    outliers=OutlierSettings(threshold_pct=90.0, per_symbol_pct={"click": 70.0}),
    health=HealthSettings(
        max_silence_seconds={"click": 172800, "view": 100000, "purchase": 3600, "refund": 600}, max_lag_seconds=300
    ),
)
SUPPLIER_SIGNALS = SignalSettings(spike_threshold_pct=40.0, trend_count=5, cooldown_seconds=86400 * 20)
SUPPLIER_TIE = ("order_key", "line_number", "part_key")


# --- views -----------------------------------------------------------------------------------


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ticks(spark: SparkSession, folder: str) -> DataFrame:
    """``events`` as ticks."""
    return _table(spark, folder, "events").select(
        F.col("event_id").alias("tick_id"),
        F.col("event_type").alias("symbol"),
        F.col("value").alias("price"),
        F.lit("events").alias("source"),
        F.col("ts").cast("timestamp").alias("event_time"),
    )


def silver(spark: SparkSession, folder: str) -> DataFrame:
    return clean.valid_ticks(ticks(spark, folder))


def supplier_ticks(spark: SparkSession, folder: str) -> DataFrame:
    """``lineitem`` as prices per supplier; days repeat, so ties matter."""
    return _table(spark, folder, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("symbol"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_shipdate").cast("timestamp").alias("event_time"),
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").alias("part_key"),
    )


def alerts(spark: SparkSession, folder: str) -> DataFrame:
    return alert_ops.detect_alerts(silver(spark, folder), SETTINGS)


def _plain(df: DataFrame) -> DataFrame:
    """Times without zone and maps as text, so that any engine compares equal."""
    changed = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, T.TimestampType):
            changed[field.name] = F.col(field.name).cast("timestamp_ntz")
        elif isinstance(field.dataType, T.MapType):
            pairs = F.transform(
                F.array_sort(F.map_entries(field.name)), lambda e: F.concat(e["key"], F.lit("="), e["value"])
            )
            changed[field.name] = F.array_join(pairs, ";")
    return df.withColumns(changed) if changed else df


# --- queries ---------------------------------------------------------------------------------

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = lambda spark, folder: _plain(build(spark, folder))
    return build


@query
def declared_scan(spark, folder):
    """Columns by name from a declared schema; one the files lack is null."""
    schema = T.StructType(
        [
            T.StructField("value", T.DoubleType()),
            T.StructField("event_id", T.LongType()),
            T.StructField("venue", T.StringType()),
        ]
    )
    return tables.parquet_rows(spark, f"{folder}/events.parquet", schema)


@query
def data_file_rows(spark, folder):
    return tables.data_files(_table(spark, folder, "events")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("row_count").alias("row_count")
    )


@query
def newest_ticks(spark, folder):
    return tables.newest_rows(ticks(spark, folder), "event_time", 50, ("tick_id",))


@query
def silver_preview(spark, folder):
    return silver(spark, folder).orderBy("event_time", "tick_id").limit(20)


@query
def wire_round_trip(spark, folder):
    """Ticks to JSON records and back."""
    return quotes.parse_wire(quotes.to_wire(ticks(spark, folder))).drop("ingestion_time")


@query
def wire_malformed(spark, folder):
    """Good records, JSON of another shape and plain text in one stream of records."""
    events = _table(spark, folder, "events")
    records = (
        quotes.to_wire(ticks(spark, folder))
        .unionByName(events.select(F.col("props").cast("binary").alias("value")))
        .unionByName(_table(spark, folder, "documents").select(F.concat(F.lit("{"), "text").cast("binary").alias("value")))
    )
    return (
        quotes.parse_wire(records)
        .groupBy("symbol")
        .agg(F.count(F.lit(1)).alias("records"), F.count("price").alias("prices"), F.count("event_time").alias("times"))
    )


@query
def quote_payloads(spark, folder):
    """API answers derived from events: two shapes, and broken ones."""
    events = _table(spark, folder, "events")
    number = F.col("value").cast("string")
    payloads = events.select(
        F.col("event_id").alias("tick_id"),
        F.when(F.col("event_type") == "click", "USD/EGP").otherwise("XAU/USD").alias("symbol"),
        F.when(F.col("event_type") == "click", F.concat(F.lit('{"rate": '), number, F.lit("}")))
        .when(F.col("event_type") == "error", F.concat(F.lit("<html>"), number))
        .when(F.col("event_type") == "view", F.concat(F.lit('{"price": "n/a '), number, F.lit('"}')))
        .otherwise(F.concat(F.lit('{"name": "Gold", "price": '), number, F.lit("}")))
        .alias("payload"),
        F.col("ts").cast("timestamp").alias("fetched_at"),
    )
    return quotes.payload_ticks(payloads)


@query
def page_prices(spark, folder):
    """The raw pages, which hold no price, and one quote page per part."""
    raw = _table(spark, folder, "pages").select(F.lit("page").alias("kind"), F.col("page_id").alias("id"), "html")
    money = F.format_number(F.col("p_retailprice") * 10, 2)
    quote = _table(spark, folder, "part").select(
        F.lit("part").alias("kind"),
        F.col("p_partkey").alias("id"),
        F.concat(
            F.lit("<html><table class='x'><tr><td>1 جرام 21</td><td>1</td></tr></table>\n<TABLE id=1 class=\"prices local-cur\"><tr><th>a</th></tr><tr><td>عيار 24 - 1 جرام</td><td>9,999</td></tr><tr><td>"),
            F.col("p_name"),
            F.lit("</td></tr><tr class=r><td> <b>1 جرام</b> عيار 21 </td>\n<td><span> "),
            money,
            F.lit(" </span>جنيه</td></tr></table></html>"),
        ).alias("html"),
    )
    return quotes.page_prices(raw.unionByName(quote))


@query
def valid_ticks(spark, folder):
    return clean.valid_ticks(ticks(spark, folder))


@query
def distinct_ticks(spark, folder):
    """All ticks twice, the second time under another id: the first of each pair stays."""
    once = silver(spark, folder)
    again = once.withColumn("tick_id", F.col("tick_id") + F.lit(10**12))
    return clean.first_of_duplicates(again.unionByName(once))


@query
def unwritten_ticks(spark, folder):
    """Ticks not yet in a table that stops at the restart time."""
    rows = silver(spark, folder)
    written = rows.filter(F.col("event_time") < F.lit(RESTART_AT).cast("timestamp"))
    return clean.without_written(rows, written)


@query
def ticks_after(spark, folder):
    return tables.time_range(ticks(spark, folder), "event_time", F.lit(RESTART_AT).cast("timestamp"), strict=True)


@query
def outlier_flags(spark, folder):
    return clean.outlier_flags(silver(spark, folder), SETTINGS.outliers)


@query
def supplier_outliers(spark, folder):
    rows = clean.without_outliers(supplier_ticks(spark, folder), OutlierSettings(threshold_pct=25.0), tie=SUPPLIER_TIE)
    return rows.groupBy("symbol").agg(F.count(F.lit(1)).alias("accepted"), F.round(F.sum("price"), 2).alias("price_sum"))


@query
def price_bars(spark, folder):
    return bars.price_bars(silver(spark, folder)).withColumn("moving_avg", F.round("moving_avg", 6))


@query
def tick_signals(spark, folder):
    """Previous price, change, spike and trend of every tick, before any cooldown."""
    rows = detect.with_signals(detect.ordered_ticks(silver(spark, folder)), SETTINGS.signals)
    return rows.select("tick_id", "symbol", "price", "previous_price", "change_percent", "spike", "trend")


@query
def signal_alerts(spark, folder):
    return detect.signal_alerts(silver(spark, folder), SETTINGS.signals)


@query
def supplier_signals(spark, folder):
    """Spikes and trends with cooldown over many symbols."""
    return detect.signal_alerts(supplier_ticks(spark, folder), SUPPLIER_SIGNALS, tie=SUPPLIER_TIE)


@query
def leg_prices(spark, folder):
    """As-of values of all three legs at every leg tick."""
    legs = gap.with_legs(gap.leg_ticks(silver(spark, folder), SETTINGS.gap), SETTINGS.gap)
    return legs.select(
        "tick_id", "symbol", "global_price", "rate_price", "local_price", "global_us", "rate_us", "local_us"
    )


@query
def gap_candidates(spark, folder):
    legs = gap.with_legs(gap.leg_ticks(silver(spark, folder), SETTINGS.gap), SETTINGS.gap)
    rows = gap.gap_candidates(gap.with_gap(legs, SETTINGS.gap), SETTINGS.gap)
    return rows.select("tick_id", F.round("expected", 4).alias("expected"), "gap", "global_age_sec", "local_age_sec")


@query
def gap_alerts(spark, folder):
    rows = gap.gap_alerts(silver(spark, folder), SETTINGS.gap)
    return rows.select("tick_id", "event_time", "gap", "message", "global_age_sec", "local_age_sec")


@query
def alert_rows(spark, folder):
    """All alerts as table rows."""
    return alerts(spark, folder)


@query
def alerts_after_restart(spark, folder):
    """Alerts of the second half of the ticks, from the stored state of the first half."""
    rows, cut = silver(spark, folder), F.lit(RESTART_AT).cast("timestamp")
    before, after = rows.filter(F.col("event_time") <= cut), rows.filter(F.col("event_time") > cut)
    fired = cut_lineage(alert_ops.detect_alerts(before, SETTINGS))
    state = cut_lineage(
        states.price_entries(detect.last_prices(detect.ordered_ticks(before), SETTINGS.signals.trend_count))
        .unionByName(states.alert_entries(fired))
        .unionByName(states.leg_entries(gap.last_legs(gap.leg_ticks(before, SETTINGS.gap))))
    )
    return alert_ops.detect_alerts(
        after,
        SETTINGS,
        history=states.history_or_last_price(state),
        legs=states.leg_state(state),
        last_alerts=states.last_alert_state(state, SETTINGS.gap),
    )


@query
def graded_orders(spark, folder):
    """Severity bands over order totals, as gaps and as moves."""
    kind = F.when(F.col("o_orderstatus") == "F", "GOLD_GAP").otherwise("SPIKE_UP")
    amount = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice") / 1000)
    return _table(spark, folder, "orders").select(
        "o_orderkey", kind.alias("alert_type"), severity(kind, amount, SETTINGS.severity).alias("severity")
    )


@query
def alert_messages(spark, folder):
    return outbox_rows(alerts(spark, folder), zone=SETTINGS.display_zone)


@query
def state_entries(spark, folder):
    """Last prices and price history of every symbol as state keys."""
    history = detect.last_prices(detect.ordered_ticks(silver(spark, folder)), SETTINGS.signals.trend_count)
    return states.price_entries(history)


@query
def state_seeds(spark, folder):
    """Alert times written as state keys and read back."""
    return states.last_alert_state(states.alert_entries(alerts(spark, folder)), SETTINGS.gap)


@query
def state_upsert(spark, folder):
    """State by order status and priority, updated by status and event type."""
    orders, events = _table(spark, folder, "orders"), _table(spark, folder, "events")

    def entry(rows, key, value):
        text = F.max(value).cast("string")
        return rows.groupBy(F.col(key).alias("state_key")).agg(text.alias("state_value"), F.max(F.col("_at").cast("timestamp")).alias("updated_at"))

    orders, events = orders.withColumn("_at", F.col("o_orderdate")), events.withColumn("_at", F.col("ts"))
    target = entry(orders, "o_orderpriority", "o_custkey").unionByName(entry(orders, "o_orderstatus", "o_custkey"))
    updates = entry(orders, "o_orderstatus", "o_orderkey").unionByName(entry(events, "event_type", "event_id"))
    return upsert(target, updates)


@query
def recent_alerts(spark, folder):
    return reports.recent_alerts(alerts(spark, folder), NOW, hours=240, limit=500)


@query
def all_alerts(spark, folder):
    return reports.all_alerts(alerts(spark, folder)).select("alert_id", "created_at", "alert_type")


@query
def alert_counts_by_type(spark, folder):
    return reports.alert_counts_by_type(alerts(spark, folder), NOW, hours=480)


@query
def alerts_timeseries(spark, folder):
    return reports.alerts_timeseries(alerts(spark, folder), NOW, hours=480, bucket_minutes=50)


@query
def recent_alert_count(spark, folder):
    return reports.recent_alert_count(alerts(spark, folder), NOW, minutes=1440)


@query
def gap_history(spark, folder):
    return reports.gap_history(alerts(spark, folder), NOW, hours=240, limit=400)


@query
def price_history(spark, folder):
    return reports.price_history(silver(spark, folder), "click", NOW, hours=480, limit=300)


@query
def latest_price(spark, folder):
    return reports.latest_prices(silver(spark, folder), "purchase", tie="tick_id")


@query
def latest_prices(spark, folder):
    return reports.latest_prices(silver(spark, folder), tie="tick_id")


@query
def supplier_latest_prices(spark, folder):
    rows = supplier_ticks(spark, folder).withColumn("tie", F.struct(*SUPPLIER_TIE, "price"))
    return reports.latest_prices(rows, tie="tie")


@query
def last_ticks(spark, folder):
    return health.last_ticks(silver(spark, folder))


@query
def feed_ages(spark, folder):
    return reports.feed_ages(silver(spark, folder), NOW)


def _clicks_behind(spark, folder):
    """A silver table that lags: only clicks have arrived."""
    return silver(spark, folder).filter(F.col("symbol") == "click")


@query
def layer_lag(spark, folder):
    return health.layer_lag(ticks(spark, folder), _clicks_behind(spark, folder))


@query
def row_counts(spark, folder):
    return health.row_counts(
        {"bronze": ticks(spark, folder), "silver": silver(spark, folder), "gold": None}
    )


@query
def table_row_counts(spark, folder):
    """Counts of whole tables out of their footers."""
    return health.table_row_counts(spark, {"events": f"{folder}/events.parquet", "lineitem": f"{folder}/lineitem.parquet", "gone": None})


@query
def last_ticks_by_day(spark, folder):
    """Last ticks of a table by day, from its newest day back: one feed stopped early, one never came."""
    place = _run_folder(spark, "silver")
    stopped = (F.col("symbol") != "view") | (F.col("event_time") < F.lit("2024-01-09").cast("timestamp"))
    append_parquet(silver(spark, folder).filter(stopped), f"{place}/silver", "event_time")
    rows = tables.parquet_rows(spark, f"{place}/silver", schemas.TICKS)
    return health.newest_first(rows, ["click", "view", "purchase", "never"])


@query
def batch_counts(spark, folder):
    return reports.batch_counts(silver(spark, folder), alerts(spark, folder)).drop("late_ticks")


def _report(spark, folder):
    return health.health_report(ticks(spark, folder), _clicks_behind(spark, folder), NOW, SETTINGS.health)


@query
def health_report(spark, folder):
    return _report(spark, folder)


@query
def report_summary(spark, folder):
    return health.report_summary(_report(spark, folder))


@query
def status_changes(spark, folder):
    """Changes from a report on all ticks to one where only clicks arrive."""
    before = health.health_report(ticks(spark, folder), silver(spark, folder), NOW, SETTINGS.health)
    return health.status_changes(_report(spark, folder), before)


@query
def order_status_changes(spark, folder):
    """Status history: each customer's orders as checks of a log of reports."""
    log = _table(spark, folder, "orders").groupBy(
        F.col("o_custkey").cast("string").alias("name"), F.col("o_orderdate").alias("report_time")
    ).agg(F.max(F.when(F.col("o_orderstatus") == "F", "WARN").when(F.col("o_orderstatus") == "O", "OK").otherwise("DEAD")).alias("status"))
    return health.status_history_changes(log)


@query
def health_message(spark, folder):
    return health.health_message(_report(spark, folder), NOW)


@query
def health_log(spark, folder):
    cycle = health_cycle(
        ticks(spark, folder), _clicks_behind(spark, folder), None, now=datetime.fromisoformat(NOW), settings=SETTINGS
    )
    return cycle.log_lines.select("line", "text")


@query
def heartbeats(spark, folder):
    """Every event time as the time of a report."""
    return health.heartbeats(ticks(spark, folder).select(F.col("event_time").alias("report_time")), SETTINGS.health)


# --- the layout of large keys ------------------------------------------------------------------

# Far below the rows of a key, so that every key is spread over slices.
SLICE_ROWS = 200


@query
def sliced_outlier_flags(spark, folder):
    return clean.outlier_flags(silver(spark, folder), SETTINGS.outliers, rows_per_slice=SLICE_ROWS)


@query
def sliced_gap_alerts(spark, folder):
    rows = gap.gap_alerts(silver(spark, folder), SETTINGS.gap, rows_per_slice=SLICE_ROWS)
    return rows.select("tick_id", "event_time", "gap", "message", "global_age_sec", "local_age_sec")


@query
def sliced_supplier_signals(spark, folder):
    return detect.signal_alerts(supplier_ticks(spark, folder), SUPPLIER_SIGNALS, tie=SUPPLIER_TIE, rows_per_slice=SLICE_ROWS)


# --- streams, run to the end of their input ----------------------------------------------------


def _run_folder(spark, name):
    """A fresh folder for a stream's output, where every executor can write."""
    ensure_checkpoint_dir(spark)
    root = spark.sparkContext.getCheckpointDir()
    return f"{root}/{name}-{uuid.uuid4()}"


ONCE = {"availableNow": True}


def _event_stream(spark, folder):
    schema = _table(spark, folder, "events").schema
    rows = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)
    return rows.select(
        F.col("event_type").alias("symbol"),
        F.col("value").alias("price"),
        F.lit("events").alias("source"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.col("ts").cast("timestamp").alias("ingestion_time"),
    )


@query
def bronze_silver_stream(spark, folder):
    """Wire records through both streaming jobs, every record sent twice."""
    place = _run_folder(spark, "ingest")
    rows = _event_stream(spark, folder).withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2))))
    ingest.start_bronze(quotes.to_wire(rows), f"{place}/bronze", f"{place}/c1", trigger=ONCE).awaitTermination()
    bronze = tables.parquet_stream(spark, f"{place}/bronze", schemas.BRONZE)
    ingest.start_silver(bronze, f"{place}/silver", f"{place}/c2", trigger=ONCE).awaitTermination()
    done = tables.parquet_rows(spark, f"{place}/silver", schemas.SILVER)
    return done.select("symbol", "price", "source", "event_time")


@query
def bar_stream(spark, folder):
    """Bars as a stream: windows the watermark has closed."""
    place = _run_folder(spark, "bars")
    closed = ingest.bar_stream(clean.valid_ticks(_event_stream(spark, folder)))
    closed.writeStream.format("parquet").option("path", f"{place}/bars").option(
        "checkpointLocation", f"{place}/c"
    ).trigger(**ONCE).start().awaitTermination()
    return spark.read.parquet(f"{place}/bars").withColumn("moving_avg", F.round("moving_avg", 6))


@query
def alert_stream(spark, folder):
    """The alert job over a silver stream, from a fresh start."""
    place = _run_folder(spark, "alerts")
    stream = clean.valid_ticks(_event_stream(spark, folder))
    alert_job.start_alerts(
        stream, place, f"{place}/c", SETTINGS, ONCE, now=datetime.fromisoformat("2024-01-01 00:00:00")
    ).awaitTermination()
    return _stream_alerts(spark, place)


def _stream_alerts(spark, place):
    done = tables.parquet_rows(spark, f"{place}/alerts", schemas.ALERTS)
    return done.select("alert_id", "symbol", "alert_type", "severity", "message", "created_at", "extra_data")


# The ticks of a stream land in parts that end at these times.
PART_ENDS = ("2024-01-08 00:00:00", RESTART_AT, "2024-01-23 00:00:00", "2100-01-01 00:00:00")


def _in_parts(rows):
    """Ticks by the time they land; each part reads its own range."""
    at = F.col("event_time")
    ends = [F.lit(end).cast("timestamp") for end in PART_ENDS]
    return [rows.filter(at < end if before is None else (at >= before) & (at < end)) for before, end in zip([None, *ends], ends)]


def _feed(parts, path, start):
    """Land part after part: two meet a running query, each of the others one started again."""
    query = None
    for n, part in enumerate(parts):
        part.write.mode("append").parquet(path)
        if n == 0:
            query = start({"processingTime": "0 seconds"})
        if n < 2:
            query.processAllAvailable()
        if n == 1:
            query.stop()
        if n >= 2:
            start(ONCE).awaitTermination()


@query
def outlier_stream(spark, folder):
    """The outlier filter over four micro-batches and two restarts."""
    place = _run_folder(spark, "outliers")
    rows = silver(spark, folder)
    _feed(_in_parts(rows), f"{place}/landed", lambda trigger: outliers.start_outliers(
        tables.parquet_stream(spark, f"{place}/landed", rows.schema), f"{place}/flagged", f"{place}/c", SETTINGS.outliers, trigger
    ))
    return spark.read.parquet(f"{place}/flagged")


@query
def accepted_prices(spark, folder):
    """The memory of the filter, handed from a batch over half of the ticks to a stream and read back."""
    place = _run_folder(spark, "accepted")
    first, second, *rest = _in_parts(silver(spark, folder))
    flagged = clean.outlier_flags(first, SETTINGS.outliers)
    before = clean.last_accepted(flagged)
    before = cut_lineage(clean.last_accepted(clean.outlier_flags(second, SETTINGS.outliers, last_accepted=before), before=before))
    _feed(rest, f"{place}/landed", lambda trigger: outliers.start_outliers(
        tables.parquet_stream(spark, f"{place}/landed", first.schema), f"{place}/flagged", f"{place}/c", SETTINGS.outliers, trigger,
        last_accepted=before,
    ))
    return outliers.accepted_prices(spark, f"{place}/c")


def _alert_job_in_parts(spark, folder):
    """The alert job over five micro-batches and restarts; the fourth holds the first part's ticks again, late."""
    place = _run_folder(spark, "alerts")
    at = F.col("event_time")
    parts = _in_parts(silver(spark, folder).drop("tick_id").withColumns({"ingestion_time": at, "processed_at": at}))
    _feed([*parts[:3], parts[0], parts[3]], f"{place}/landed", lambda trigger: alert_job.start_alerts(
        tables.parquet_stream(spark, f"{place}/landed", schemas.SILVER), place, f"{place}/c", SETTINGS, trigger,
        now=datetime.fromisoformat("2024-01-01 00:00:00"),
    ))
    return place


@query
def alert_stream_batches(spark, folder):
    return _stream_alerts(spark, _alert_job_in_parts(spark, folder))


@query
def late_ticks(spark, folder):
    """What each micro-batch of the alert job had: new ticks, late ones, newest time."""
    place = _alert_job_in_parts(spark, folder)
    stats = spark.read.parquet(f"{place}/batch_stats")
    return stats.select(F.col("batch_id").cast("int"), "ticks", "alerts", "late_ticks", "high_water")


@query
def silver_after_reset(spark, folder):
    """Silver whose source is rewritten while a batch is open: reading fails, and the supervised job goes on
    with a new checkpoint, without writing a row twice."""
    place = _run_folder(spark, "reset")
    landed, check = f"{place}/landed", f"{place}/c"
    at = F.col("event_time")
    rows = ticks(spark, folder).drop("tick_id").withColumn("ingestion_time", at)
    cut = F.lit(RESTART_AT).cast("timestamp")
    rows.filter(at < cut).write.parquet(landed)
    bronze = tables.parquet_stream(spark, landed, schemas.BRONZE)
    ingest.start_silver(bronze, f"{place}/first", check, trigger=ONCE).awaitTermination()

    rows.filter(at >= cut).write.mode("append").parquet(landed)

    def overtaken(batch, batch_id):
        # The batch knows its files; before it reads them the source is written anew and they go.
        old = spark.read.parquet(landed).inputFiles()
        spark.read.schema(schemas.BRONZE).parquet(landed).write.mode("append").parquet(landed)
        delete_files(spark, old)
        batch.write.mode("append").parquet(f"{place}/lost")

    def written():
        first = tables.parquet_rows(spark, f"{place}/first", schemas.SILVER).withColumn("run", F.lit("first"))
        again = tables.parquet_rows(spark, f"{place}/again", T.StructType([*schemas.SILVER.fields, T.StructField("run", T.StringType())]))
        return first.unionByName(again.select(*first.columns) if "event_date" in again.columns else again, allowMissingColumns=True)

    def start(checkpoint):
        if checkpoint == check:
            stream = ingest.silver_ticks(bronze).writeStream.foreachBatch(overtaken)
            return stream.option("checkpointLocation", checkpoint).trigger(**ONCE).start()
        return ingest.start_silver_again(bronze, written, f"{place}/again", checkpoint, ONCE)

    attempts = ingest.run_with_recovery(start, check, ingest.source_files_gone)
    done = written().select("symbol", "price", "source", "event_time")
    return done.withColumn("attempts", F.lit(attempts))
