"""Health of the tables: freshness of feeds, lag between layers, changes of status."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.config import HealthSettings
from tickloom.functions import fixed
from tickloom.functions.measures import instant, seconds_between
from tickloom.functions.text import check_line, health_head, heartbeat_text
from tickloom.operators.slices import CARRIED, ROWS_PER_SLICE, slice_rows, with_earlier_rows
from tickloom.sources.tables import DAY_OF


def expected_feeds(spark: SparkSession, settings: HealthSettings = HealthSettings()) -> DataFrame:
    """The tracked symbols in report order: a settings table, a few rows."""
    rows = [(n + 1, s, int(m)) for n, (s, m) in enumerate(settings.max_silence_seconds.items())]
    return spark.createDataFrame(rows, "position int, symbol string, max_silence_seconds int")


def last_ticks(silver: DataFrame) -> DataFrame:
    """Last tick time per symbol."""
    return silver.groupBy("symbol").agg(F.max("event_time").alias("last_seen"))


def day_of_files(rows: DataFrame, time: str = "event_time") -> list[date]:
    """Days of a table's partitions, from the names of its files; none if it is not partitioned by day."""
    mark = f"/{DAY_OF[time]}="
    if DAY_OF[time] not in rows.columns:
        return []
    found = {f.rpartition(mark)[2].partition("/")[0] for f in rows.inputFiles() if mark in f}
    return sorted(date.fromisoformat(day) for day in found if day != "__HIVE_DEFAULT_PARTITION__")


def of_days(rows: DataFrame, time: str, first: date, last: date | None) -> DataFrame:
    day = F.col(DAY_OF[time])
    return rows.filter(day >= F.lit(first) if last is None else (day >= F.lit(first)) & (day < F.lit(last)))


def newest_first(silver: DataFrame, symbols: Sequence[str], time: str = "event_time") -> DataFrame:
    """Last tick time of each of a few symbols, from the newest days back.

    A table by day is read from its newest day on; only symbols without a tick there are looked for in
    the days before, one, two, four and so on at a time. Other tables are read whole. A row a symbol.
    """
    spark = silver.sparkSession
    days = day_of_files(silver, time)
    if not days:
        return last_ticks(silver.filter(F.col("symbol").isin(*symbols)))
    found: list[tuple] = []
    missing, until, width = list(symbols), None, 1
    while missing and days:
        days, part = days[:-width], days[-width:]
        rows = of_days(silver, time, part[0], until).filter(F.col("symbol").isin(*missing))
        new = [tuple(r) for r in last_ticks(rows).filter(F.col("last_seen").isNotNull()).collect()]
        found += new
        missing = [s for s in missing if s not in {symbol for symbol, _ in new}]
        until, width = part[0], width * 2
    kind = silver.schema["symbol"].dataType.simpleString()
    return spark.createDataFrame(found, f"symbol {kind}, last_seen {silver.schema[time].dataType.simpleString()}")


def newest_day(rows: DataFrame, time: str = "event_time") -> DataFrame:
    """Rows that hold the last time of a table: its newest days that have any, or all rows without days."""
    days, until, width = day_of_files(rows, time), None, 1
    part = rows
    while days:
        days, newest = days[:-width], days[-width:]
        part = of_days(rows, time, newest[0], until)
        if not part.isEmpty():
            break
        until, width = newest[0], width * 2
    return part


def layer_lag(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """Seconds from the newest silver to the newest bronze time; null if a layer has none."""
    bronze, silver = newest_day(bronze), newest_day(silver)
    both = bronze.select(F.col("event_time").alias("b"), F.lit(None).cast("timestamp").alias("s")).unionByName(
        silver.select(F.lit(None).cast("timestamp").alias("b"), F.col("event_time").alias("s"))
    )
    return both.agg(seconds_between(F.max("s"), F.max("b")).alias("lag_seconds"))


def row_counts(layers: Mapping[str, DataFrame | None]) -> DataFrame:
    """Rows per layer; an absent layer counts 0."""
    spark = next(df for df in layers.values() if df is not None).sparkSession
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("layer"), "row_count")
        if df is not None
        else spark.range(1).select(F.lit(name).alias("layer"), F.lit(0).cast("bigint").alias("row_count"))
        for name, df in layers.items()
    ]
    result = counts[0]
    for one in counts[1:]:
        result = result.unionByName(one)
    return result


def table_row_counts(spark: SparkSession, paths: Mapping[str, str | None]) -> DataFrame:
    """Rows per layer of Parquet tables, summed up from the files' footers; an absent layer counts 0."""
    # Settings of its own: the newer reader, which lets counts be pushed into the files.
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return row_counts({name: None if path is None else session.read.parquet(path) for name, path in paths.items()})


def _graded(value: Column, limit: Column) -> Column:
    return (
        F.when(value >= limit, fixed.DEAD).when(value >= limit * 0.5, fixed.WARN).otherwise(fixed.OK)
    )


def _whole(value: Column) -> Column:
    return value.cast("bigint").cast("string")


def feed_checks(feeds: DataFrame, last: DataFrame, now=None) -> DataFrame:
    """One check per expected feed: never seen or silent too long is DEAD, half of that WARN."""
    at = instant(now)
    limit = F.col("max_silence_seconds")
    symbol, age = F.col("symbol"), F.col("value")
    joined = (
        feeds.join(last, "symbol", "left")
        .withColumn("value", seconds_between(F.col("last_seen"), at))
        .withColumn("status", F.when(age.isNull(), fixed.DEAD).otherwise(_graded(age, limit)))
    )
    message = (
        F.when(age.isNull(), F.concat(symbol, F.lit(" — never received any data")))
        .when(
            F.col("status") == fixed.DEAD,
            F.concat(symbol, F.lit(" — no data for "), _whole(age), F.lit("s (max="), limit.cast("string"), F.lit("s)")),
        )
        .when(
            F.col("status") == fixed.WARN,
            F.concat(symbol, F.lit(" — last tick "), _whole(age), F.lit("s ago (warn>"), _whole(limit * 0.5), F.lit("s)")),
        )
        .otherwise(F.concat(symbol, F.lit(" — OK ("), _whole(age), F.lit("s ago)")))
    )
    return joined.select(
        "position",
        F.concat(F.lit(fixed.FEED_CHECK_PREFIX), symbol).alias("name"),
        "status",
        message.alias("message"),
        "value",
    )


def lag_check(lag: DataFrame, settings: HealthSettings = HealthSettings()) -> DataFrame:
    """The check of the one-row :func:`layer_lag`; an unknown lag is a WARN."""
    value, limit = F.col("lag_seconds"), F.lit(int(settings.max_lag_seconds))
    status = F.when(value.isNull(), fixed.WARN).otherwise(_graded(value, limit))
    text = F.concat(F.lit("Bronze→Silver lag = "), _whole(value), F.lit("s "))
    message = (
        F.when(value.isNull(), "Could not compute Bronze→Silver lag (missing data?)")
        .when(value >= limit, F.concat(text, F.lit("(max="), limit.cast("string"), F.lit("s)")))
        .when(value >= limit * 0.5, F.concat(text, F.lit("(warn>"), _whole(limit * 0.5), F.lit("s)")))
        .otherwise(F.concat(text, F.lit("✓")))
    )
    return lag.select(
        F.lit(len(settings.max_silence_seconds) + 1).alias("position"),
        F.lit(fixed.LAG_CHECK).alias("name"),
        status.alias("status"),
        message.alias("message"),
        value.alias("value"),
    )


def health_report(
    bronze: DataFrame, silver: DataFrame, now=None, settings: HealthSettings = HealthSettings()
) -> DataFrame:
    """All checks (position, name, status, message, value): a few rows whatever the tables hold."""
    feeds = expected_feeds(silver.sparkSession, settings)
    # Only expected symbols are counted: as many rows as the settings have feeds.
    last = F.broadcast(newest_first(silver, list(settings.max_silence_seconds)))
    return feed_checks(feeds, last, now).unionByName(lag_check(layer_lag(bronze, silver), settings))


def worst_of(status: Column) -> Column:
    """Aggregate: DEAD over WARN over OK; null without any status."""
    return F.max_by(status, F.when(status == fixed.DEAD, 2).when(status == fixed.WARN, 1).when(status == fixed.OK, 0))


def report_summary(checks: DataFrame) -> DataFrame:
    """Healthy, has_dead and worst status; no checks at all count as healthy."""
    return checks.agg(
        F.coalesce(F.bool_and(F.col("status") == fixed.OK), F.lit(True)).alias("is_healthy"),
        F.coalesce(F.bool_or(F.col("status") == fixed.DEAD), F.lit(False)).alias("has_dead"),
        F.coalesce(worst_of(F.col("status")), F.lit(fixed.OK)).alias("worst_status"),
    )


def status_changes(checks: DataFrame, previous: DataFrame) -> DataFrame:
    """Names that became bad or recovered since the previous report. WARN to DEAD is no change."""
    bad, before = (df.filter(F.col("status") != fixed.OK).select("name").distinct() for df in (checks, previous))
    return (
        bad.join(before, "name", "left_anti")
        .withColumn("change", F.lit("newly_bad"))
        .unionByName(before.join(bad, "name", "left_anti").withColumn("change", F.lit("recovered")))
    )


def should_notify(checks: DataFrame, previous: DataFrame) -> DataFrame:
    return status_changes(checks, previous).agg((F.count(F.lit(1)) > 0).alias("notify"))


def status_history_changes(reports: DataFrame, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """The same over a log of reports (report_time, name, status): changes per check in time order."""
    log = reports.select("report_time", "name", (F.col("status") != fixed.OK).alias("_bad"))
    sliced = slice_rows(log, ["name"], ["report_time"], rows_per_slice)
    return (
        with_earlier_rows(sliced, 1)
        .withColumn("_was", F.coalesce(F.lag("_bad").over(sliced.window()), F.lit(False)))
        .filter(~F.col(CARRIED) & (F.col("_bad") != F.col("_was")))
        .select("report_time", "name", F.when(F.col("_bad"), "newly_bad").otherwise("recovered").alias("change"))
    )


def health_message(
    checks: DataFrame, now=None, zone: str = "Africa/Cairo", changes: DataFrame | None = None
) -> DataFrame:
    """The whole report as one text: head, blank line, one line per check in report order.

    With ``changes`` there is a message only if it has rows. A report is a handful of rows.
    """
    at = instant(now)
    rows = checks.withColumn("_changes", F.lit(1 if changes is None else 0))
    if changes is not None:
        rows = rows.unionByName(changes.select(F.lit(1).alias("_changes")), allowMissingColumns=True)
    line = F.struct("position", check_line(F.col("name"), F.col("status"), F.col("message")).alias("text"))
    lines = F.collect_list(F.when(F.col("position").isNotNull(), line))
    report = rows.agg(
        worst_of(F.col("status")).alias("worst"),
        F.transform(F.array_sort(lines), lambda one: one["text"]).alias("lines"),
        F.sum("_changes").alias("changes"),
    )
    return report.filter(F.col("changes") > 0).select(
        F.concat_ws(
            "\n",
            health_head(F.coalesce("worst", F.lit(fixed.OK)), at, zone),
            F.lit(""),
            F.array_join("lines", "\n"),
        ).alias("text")
    )


def heartbeats(reports: DataFrame, settings: HealthSettings = HealthSettings(), zone: str = "Africa/Cairo", sent: DataFrame | None = None) -> DataFrame:
    """Per local date, the first report time within the heartbeat hour: (local_date, sent_at, text).

    ``sent`` (local_date) lists dates that already had theirs. An aggregate, so any number of
    reports is fine.
    """
    local = F.from_utc_timestamp("report_time", zone)
    due = (
        reports.filter(F.hour(local) == settings.heartbeat_hour)
        .groupBy(F.to_date(local).alias("local_date"))
        .agg(F.min("report_time").alias("sent_at"))
    )
    if sent is not None:
        due = due.join(sent.select("local_date"), "local_date", "left_anti")
    return due.withColumn("text", heartbeat_text(F.col("sent_at"), zone))
