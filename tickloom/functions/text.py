"""Text expressions: numbers as text, alert and health messages."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickloom.functions import fixed

MESSAGE_TIME = "yyyy-MM-dd HH:mm:ss"


def _lookup(table: Mapping[str, str], key: Column, otherwise: str) -> Column:
    found = F.lit(otherwise)
    for name, value in table.items():
        found = F.when(key == name, value).otherwise(found)
    return found


def _number_sql(x: str) -> str:
    plain = f"cast({x} as string)"
    digits = f"trim(trailing '0' from cast(try_cast({plain} as decimal(38,21)) as string))"
    exponent = f"try_cast(split({plain}, 'E')[1] as int)"
    return f"""case
      when {x} = 0 or abs({x}) >= 0.001 and abs({x}) < 1e7 then {plain}
      when abs({x}) >= 0.0001 and abs({x}) < 1e16 then {digits} || if(endswith({digits}, '.'), '0', '')
      when contains({plain}, 'E') then regexp_replace(split({plain}, 'E')[0], '[.]0$', '')
        || if({exponent} < 0, 'e-', 'e+') || if(abs({exponent}) < 10, '0', '') || cast(abs({exponent}) as string)
      else lower(replace({plain}, 'Infinity', 'inf')) end"""


def number_text(x: str) -> Column:
    """A double (column name or SQL text) in its shortest decimal form: ``4400.0``, ``0.613``, ``1e+16``.

    Spark's own cast switches to exponents at 1e7 and below 1e-3; this one between 1e-4 and 1e16
    never does.
    """
    return F.expr(_number_sql(x))


def number_list_text(xs: str) -> Column:
    """``[1.0, 2.5]``"""
    return F.expr(f"'[' || array_join(transform({xs}, x -> {_number_sql('x')}), ', ') || ']'")


def local_time_text(ts: Column, zone: str) -> Column:
    """A UTC instant as wall-clock text of ``zone`` (the session runs in UTC)."""
    return F.date_format(F.from_utc_timestamp(ts, zone), MESSAGE_TIME)


def _detail(label: str, value: Column, unit: str = "") -> Column:
    return F.concat(F.lit(label + "`"), value, F.lit(unit + "`"))


def alert_text(zone: str) -> Column:
    """The message of one alert row. Lines that do not apply are null and vanish."""
    kind, severity = F.col("alert_type"), F.col("severity")
    extra = F.col("extra_data")
    has_extra = F.coalesce(F.size(F.map_keys(extra)), F.lit(0)) > 0

    def known(key: str) -> Column:
        return F.coalesce(extra[key], F.lit("N/A"))

    is_gap = (kind == fixed.GOLD_GAP) & has_extra
    is_spike = kind.isin(fixed.SPIKE_UP, fixed.SPIKE_DOWN) & has_extra
    return F.concat_ws(
        "\n",
        F.concat(
            _lookup(fixed.TYPE_MARKS, kind, fixed.UNKNOWN_TYPE_MARK),
            F.lit(" *"),
            kind,
            F.lit("* "),
            _lookup(fixed.SEVERITY_MARKS, severity, ""),
        ),
        F.concat(F.lit("🕐 `"), local_time_text(F.col("created_at"), zone), F.lit(" (Cairo)`" if zone == "Africa/Cairo" else f" ({zone})`")),
        F.concat(F.lit("*Symbol:* `"), F.col("symbol"), F.lit("`")),
        F.concat(F.lit("*Message:* "), F.col("message")),
        F.concat(F.lit("*Price:* `"), F.format_number("current_price", 2), F.lit("`")),
        F.when(is_gap, _detail("*Expected:*    ", known("expected_local"), " EGP")),
        F.when(is_gap, _detail("*Actual:*      ", known("actual_local"), " EGP")),
        F.when(is_gap, _detail("*USD/EGP:*     ", known("usd_egp"))),
        F.when(is_gap, _detail("*Global Gold:* ", known("global_gold"), " USD")),
        F.when(is_spike, _detail("*Previous:* ", known("previous_price"))),
    )


def status_mark(status: Column) -> Column:
    return _lookup(fixed.STATUS_MARKS, status, "")


def check_line(name: Column, status: Column, message: Column) -> Column:
    """One line of the health message; the kind of check is cut from its name."""
    short = F.regexp_replace(
        F.regexp_replace(name, fixed.FEED_CHECK_PREFIX, ""), fixed.LAG_CHECK_PREFIX, ""
    )
    return F.concat(status_mark(status), F.lit(" *"), short, F.lit("*: "), message)


def health_head(worst: Column, at: Column, zone: str) -> Column:
    return F.concat(
        status_mark(worst), F.lit(" *Pipeline Health* — `"), local_time_text(at, zone), F.lit(" (Cairo)`")
    )


def heartbeat_text(at: Column, zone: str) -> Column:
    return F.concat(
        F.lit("💚 *Daily Heartbeat* — Pipeline is running\n🕐 `"),
        local_time_text(at, zone),
        F.lit(" (Cairo)`"),
    )
