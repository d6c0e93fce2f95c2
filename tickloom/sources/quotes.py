"""Raw material to ticks: wire records, landed quote payloads and quote pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom import schemas
from tickloom.functions import fixed


def parse_wire(records: DataFrame, shift_zone: str | None = None) -> DataFrame:
    """JSON records (column ``value``) to bronze ticks, stamped with the ingestion time.

    Malformed records stay, as rows of nulls; the clean step drops them. ``shift_zone`` moves the
    ingestion time as if the clock showed that zone's wall time, for tables written that way.
    """
    now = F.current_timestamp()
    return (
        records.select(F.from_json(F.col("value").cast("string"), schemas.WIRE).alias("tick"))
        .select(
            F.col("tick.symbol").alias("symbol"),
            F.col("tick.price").alias("price"),
            F.col("tick.source").alias("source"),
            F.col("tick.timestamp").try_cast("timestamp").alias("event_time"),
        )
        .withColumn("ingestion_time", F.to_utc_timestamp(now, shift_zone) if shift_zone else now)
    )


def to_wire(ticks: DataFrame) -> DataFrame:
    """Ticks to JSON records: the inverse of :func:`parse_wire`. Nulls are written, not left out."""
    time = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    body = F.struct("symbol", "price", time.alias("timestamp"), "source")
    return ticks.select(
        F.to_json(body, {"ignoreNullFields": "false"}).cast("binary").alias("value")
    )


def payload_ticks(payloads: DataFrame) -> DataFrame:
    """Landed API answers (symbol, payload, fetched_at) to ticks.

    The price is under ``rate`` or ``price``; without one the tick keeps a null price and the
    fallback source.
    """
    body = F.col("payload")
    # get_json_object gives null on malformed JSON.
    price = F.coalesce(
        F.get_json_object(body, "$.rate").try_cast("double"), F.get_json_object(body, "$.price").try_cast("double")
    )
    named = F.col("symbol")
    for symbol, source in fixed.PAYLOAD_SOURCES.items():
        named = F.when(F.col("symbol") == symbol, source).otherwise(named)
    return payloads.withColumn("price", price).select(
        *[c for c in payloads.columns if c not in ("payload", "fetched_at")],
        "price",
        F.when(F.col("price").isNull(), fixed.FALLBACK_SOURCE).otherwise(named).alias("source"),
        F.col("fetched_at").alias("event_time"),
    )


def _text(html: Column) -> Column:
    """Text of an element: every piece between tags trimmed, then joined."""
    pieces = F.split(F.replace(html, F.lit("&nbsp;"), F.lit(" ")), "<[^>]*>")
    return F.array_join(F.transform(pieces, lambda p: F.regexp_replace(p, r"^[\s ]+|[\s ]+$", "")), "")


def _elements(html: Column, tag: str) -> Column:
    return F.regexp_extract_all(html, F.lit(rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>"), 1)


def page_prices(pages: DataFrame) -> DataFrame:
    """Price row of each quote page (column ``html``): price, or null with the reason.

    Looks into the first table of the wanted class for the first two-cell row whose label names
    the product and whose value has a number.
    """
    table_pattern = (
        rf"(?is)<table\b[^>]*\bclass\s*=\s*(?:[\"'][^\"'>]*(?<![\w-]){fixed.PAGE_TABLE_CLASS}(?![\w-])[^\"'>]*[\"']"
        rf"|{fixed.PAGE_TABLE_CLASS}(?![\w-]))[^>]*>(.*?)</table\s*>"
    )
    table = F.get(F.regexp_extract_all(F.col("html"), F.lit(table_pattern), 1), F.lit(0))
    cells = F.transform(_elements(F.col("_table"), "tr"), lambda row: F.transform(_elements(row, "td"), _text))

    def wanted(row: Column) -> Column:
        label, value = F.get(row, F.lit(0)), F.get(row, F.lit(1))
        match = F.size(row) == 2
        for part in fixed.PAGE_LABEL_PARTS:
            match = match & F.contains(label, F.lit(part))
        return match & F.regexp_like(value, F.lit(fixed.PAGE_NUMBER))

    value = F.get(F.get(F.filter(cells, wanted), F.lit(0)), F.lit(1))
    number = F.regexp_extract(value, fixed.PAGE_NUMBER, 0)
    reason = (
        F.when(F.col("_table").isNull(), "table not found")
        .when(F.col("price").isNull(), "row not found")
        .otherwise(F.lit(None).cast("string"))
    )
    # Step by step, so that a page is cut up once.
    return (
        pages.withColumn("_table", table)
        .drop("html")
        .withColumn("price", F.replace(number, F.lit(","), F.lit("")).try_cast("double"))
        .withColumn("reason", reason)
        .drop("_table")
    )


def page_ticks(pages: DataFrame, fetched_at: str = "fetched_at") -> DataFrame:
    """Pages with a price as ticks of the local symbol."""
    return (
        page_prices(pages)
        .filter(F.col("price").isNotNull())
        .select(
            F.lit(fixed.PAGE_SYMBOL).alias("symbol"),
            "price",
            F.lit(fixed.PAGE_SOURCE).alias("source"),
            F.col(fetched_at).alias("event_time"),
        )
    )
