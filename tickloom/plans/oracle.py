"""The same results as plain SQL, for comparison with another engine."""

from __future__ import annotations

TICKS = """ticks AS (
  SELECT event_id AS tick_id, event_type AS symbol, value AS price, 'events' AS source, ts AS event_time
  FROM events),
silver AS (SELECT * FROM ticks WHERE price > 0 AND symbol IS NOT NULL)"""

SUPPLIER_TICKS = """sticks AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS symbol, l_extendedprice AS price,
         l_shipdate AS event_time, l_orderkey AS order_key, l_linenumber AS line_number, l_partkey AS part_key
  FROM lineitem)"""


def _signals(source: str, order: str, spike: float, n: int, name: str) -> str:
    """Every tick with previous price, change, spike and trend."""
    rising = " AND ".join(f"p{k} > p{k + 1}" for k in range(n - 1))
    falling = " AND ".join(f"p{k} < p{k + 1}" for k in range(n - 1))
    lags = ", ".join(f"lag(price, {k}) OVER w AS p{k}" for k in range(1, n))
    listed = ", ".join(f"p{k}" for k in range(n - 1, -1, -1))
    return f"""{name}_lags AS (
  SELECT *, price AS p0, {lags} FROM {source} WINDOW w AS (PARTITION BY symbol ORDER BY {order})),
{name}_pct AS (
  SELECT *, CASE WHEN coalesce(p1, 0) = 0 THEN 0.0 ELSE round(abs((price - p1) / p1 * 100), 3) END AS change_percent
  FROM {name}_lags),
{name} AS (
  SELECT *, p1 AS previous_price,
    CASE WHEN p1 IS NOT NULL AND change_percent >= {spike}
         THEN CASE WHEN price > p1 THEN 'SPIKE_UP' ELSE 'SPIKE_DOWN' END END AS spike,
    CASE WHEN {rising} THEN 'UPTREND' WHEN {falling} THEN 'DOWNTREND' END AS trend,
    '[' || array_to_string([{listed}], ', ') || ']' AS prices
  FROM {name}_pct)"""


def _fired(signals: str, order: str, cooldown_us: int, name: str) -> str:
    """Spikes and trends after the cooldown: one step of the recursion per candidate and key."""
    return f"""{name}_candidates AS (
  SELECT * EXCLUDE (spike, trend, change_percent, previous_price, prices), spike AS alert_type,
         'Price moved ' || CAST(change_percent AS VARCHAR) || '%' AS message, change_percent,
         CAST(previous_price AS VARCHAR) AS previous_price, CAST(NULL AS VARCHAR) AS prices
  FROM {signals} WHERE spike IS NOT NULL
  UNION ALL
  SELECT * EXCLUDE (spike, trend, change_percent, previous_price, prices), trend,
         CASE trend WHEN 'UPTREND' THEN 'Uptrend' ELSE 'Downtrend' END || ' detected', NULL, NULL, prices
  FROM {signals} WHERE trend IS NOT NULL),
{name}_numbered AS (
  SELECT *, epoch_us(event_time) AS us, row_number() OVER (PARTITION BY symbol, alert_type ORDER BY {order}) AS rn
  FROM {name}_candidates),
{name}_walk AS (
  SELECT symbol, alert_type, rn, us AS last_us, true AS fires FROM {name}_numbered WHERE rn = 1
  UNION ALL
  SELECT n.symbol, n.alert_type, n.rn, CASE WHEN n.us - w.last_us > {cooldown_us} THEN n.us ELSE w.last_us END,
         n.us - w.last_us > {cooldown_us}
  FROM {name}_walk w JOIN {name}_numbered n
    ON n.symbol = w.symbol AND n.alert_type = w.alert_type AND n.rn = w.rn + 1),
{name} AS (
  SELECT n.* FROM {name}_numbered n JOIN {name}_walk w USING (symbol, alert_type, rn) WHERE w.fires)"""


LEGS = """leg_rows AS (SELECT *, epoch_us(event_time) AS us FROM silver WHERE symbol IN ('click', 'view', 'purchase')),
legs AS (
  SELECT *,
    last_value(CASE WHEN symbol = 'click' THEN price END IGNORE NULLS) OVER w AS global_price,
    last_value(CASE WHEN symbol = 'view' THEN price END IGNORE NULLS) OVER w AS rate_price,
    last_value(CASE WHEN symbol = 'purchase' THEN price END IGNORE NULLS) OVER w AS local_price,
    last_value(CASE WHEN symbol = 'click' THEN us END IGNORE NULLS) OVER w AS global_us,
    last_value(CASE WHEN symbol = 'view' THEN us END IGNORE NULLS) OVER w AS rate_us,
    last_value(CASE WHEN symbol = 'purchase' THEN us END IGNORE NULLS) OVER w AS local_us
  FROM leg_rows
  WINDOW w AS (ORDER BY event_time, tick_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
gaps AS (
  SELECT *, global_price * rate_price * 0.875 / 31.1035 AS expected,
         round(abs(local_price - global_price * rate_price * 0.875 / 31.1035), 2) AS gap
  FROM legs WHERE global_price IS NOT NULL AND rate_price IS NOT NULL AND local_price IS NOT NULL),
wide AS (
  SELECT *, (us - global_us) // 1000000 AS global_age_sec, (us - local_us) // 1000000 AS local_age_sec,
         row_number() OVER (ORDER BY event_time, tick_id) AS rn
  FROM gaps WHERE us - global_us <= 7200000000 AND us - local_us <= 7200000000 AND gap >= 5),
gap_walk AS (
  SELECT rn, us AS last_us, gap AS last_gap, true AS fires FROM wide WHERE rn = 1
  UNION ALL
  SELECT n.rn,
    CASE WHEN n.us - w.last_us >= 10800000000 OR abs(n.gap - w.last_gap) >= 40 THEN n.us ELSE w.last_us END,
    CASE WHEN n.us - w.last_us >= 10800000000 OR abs(n.gap - w.last_gap) >= 40 THEN n.gap ELSE w.last_gap END,
    n.us - w.last_us >= 10800000000 OR abs(n.gap - w.last_gap) >= 40
  FROM gap_walk w JOIN wide n ON n.rn = w.rn + 1),
gap_fired AS (
  SELECT n.*, 'Gold gap detected (' || CAST(n.gap AS VARCHAR) || ' EGP)' AS message
  FROM wide n JOIN gap_walk w USING (rn) WHERE w.fires)"""

SIGNALS = _signals("silver", "event_time, tick_id", 50.0, 4, "signals")
FIRED = _fired("signals", "event_time, tick_id", 3_600_000_000, "fired")


def _alerts(tie: str) -> str:
    return f"""alerts AS (
  SELECT sha256(concat_ws('|', symbol, alert_type, CAST(us AS VARCHAR), {tie.format(t='fired')})) AS alert_id,
         symbol, alert_type, 'LOW' AS severity, message, price AS current_price, change_percent,
         CAST(NULL AS DOUBLE) AS change_amount, event_time AS created_at,
         CASE WHEN alert_type LIKE 'SPIKE%' THEN 'previous_price=' || previous_price ELSE 'prices=' || prices END AS extra_data,
         previous_price, CAST(NULL AS DOUBLE) AS expected, CAST(NULL AS DOUBLE) AS rate_price, CAST(NULL AS DOUBLE) AS global_price
  FROM fired
  UNION ALL
  SELECT sha256(concat_ws('|', 'XAU_GAP', 'GOLD_GAP', CAST(us AS VARCHAR), {tie.format(t='gap_fired').replace('gap_fired.symbol', "'XAU_GAP'")})),
         'XAU_GAP', 'GOLD_GAP', CASE WHEN gap >= 300 THEN 'HIGH' WHEN gap >= 150 THEN 'MEDIUM' ELSE 'LOW' END,
         message, local_price, 0.0, gap, event_time,
         'actual_local=' || CAST(local_price AS VARCHAR) || ';expected_local=' || CAST(round(expected, 2) AS VARCHAR)
           || ';global_age_sec=' || CAST(global_age_sec AS VARCHAR) || ';global_gold=' || CAST(global_price AS VARCHAR)
           || ';local_age_sec=' || CAST(local_age_sec AS VARCHAR) || ';usd_egp=' || CAST(rate_price AS VARCHAR),
         NULL, round(expected, 2), rate_price, global_price
  FROM gap_fired)"""


ALERTS = _alerts("CAST({t}.tick_id AS VARCHAR)")
STREAM_ALERTS = _alerts("{t}.symbol, CAST({t}.price AS VARCHAR)")

_WITH = f"WITH RECURSIVE {TICKS}"
_WITH_ALERTS = f"{_WITH}, {SIGNALS}, {FIRED}, {LEGS}, {ALERTS}"
_NOW = "TIMESTAMP '2024-01-31 00:00:00'"
_CUT = "TIMESTAMP '2024-01-16 00:00:00'"
_ALERT_COLUMNS = (
    "alert_id, symbol, alert_type, severity, message, current_price, change_percent, change_amount, created_at, extra_data"
)

CHECKS = f"""feeds(position, symbol, max_silence) AS (
  VALUES (1, 'click', 172800), (2, 'view', 100000), (3, 'purchase', 3600), (4, 'refund', 600)),
{{name}}_ages AS (
  SELECT f.position, f.symbol, f.max_silence,
         (epoch_us({_NOW}) - epoch_us(max(s.event_time))) / 1000000.0 AS value
  FROM feeds f LEFT JOIN {{silver}} s USING (symbol) GROUP BY ALL),
{{name}}_lag AS (
  SELECT ((SELECT epoch_us(max(event_time)) FROM ticks) - (SELECT epoch_us(max(event_time)) FROM {{silver}})) / 1000000.0 AS value),
{{name}} AS (
  SELECT position, 'feed:' || symbol AS name,
    CASE WHEN value IS NULL OR value >= max_silence THEN 'DEAD' WHEN value >= max_silence * 0.5 THEN 'WARN' ELSE 'OK' END AS status,
    CASE WHEN value IS NULL THEN symbol || ' — never received any data'
         WHEN value >= max_silence THEN symbol || ' — no data for ' || CAST(CAST(trunc(value) AS BIGINT) AS VARCHAR) || 's (max=' || CAST(max_silence AS VARCHAR) || 's)'
         WHEN value >= max_silence * 0.5 THEN symbol || ' — last tick ' || CAST(CAST(trunc(value) AS BIGINT) AS VARCHAR) || 's ago (warn>' || CAST(max_silence // 2 AS VARCHAR) || 's)'
         ELSE symbol || ' — OK (' || CAST(CAST(trunc(value) AS BIGINT) AS VARCHAR) || 's ago)' END AS message,
    value
  FROM {{name}}_ages
  UNION ALL
  SELECT 5, 'pipeline:lag',
    CASE WHEN value IS NULL THEN 'WARN' WHEN value >= 300 THEN 'DEAD' WHEN value >= 150 THEN 'WARN' ELSE 'OK' END,
    CASE WHEN value IS NULL THEN 'Could not compute Bronze→Silver lag (missing data?)'
         ELSE 'Bronze→Silver lag = ' || CAST(CAST(trunc(value) AS BIGINT) AS VARCHAR) || 's ' ||
              CASE WHEN value >= 300 THEN '(max=300s)' WHEN value >= 150 THEN '(warn>150s)' ELSE '✓' END END,
    value
  FROM {{name}}_lag)"""

_REPORT = (
    f"{_WITH}, clicks AS (SELECT * FROM silver WHERE symbol = 'click'), "
    + CHECKS.format(name="checks", silver="clicks")
)
_MARK = "CASE {s} WHEN 'OK' THEN '✅' WHEN 'WARN' THEN '⚠️' ELSE '🔴' END"
_WORST = """(SELECT CASE max(CASE status WHEN 'DEAD' THEN 2 WHEN 'WARN' THEN 1 ELSE 0 END)
  WHEN 2 THEN 'DEAD' WHEN 1 THEN 'WARN' ELSE 'OK' END FROM checks)"""

_BARS = """SELECT time_bucket(INTERVAL '30 seconds', event_time) AS window_start,
  time_bucket(INTERVAL '30 seconds', event_time) + INTERVAL '30 seconds' AS window_end,
  symbol, round(avg(price), 6) AS moving_avg, max(price) AS max_price, min(price) AS min_price
  FROM silver GROUP BY ALL"""


def _outliers(source: str, order: str, limit: str, name: str) -> str:
    keep = "w.last_price = 0 OR NOT abs(n.price - w.last_price) / w.last_price * 100 > n.max_move"
    return f"""{name}_numbered AS (
  SELECT *, {limit} AS max_move, row_number() OVER (PARTITION BY symbol ORDER BY {order}) AS rn
  FROM {source} WHERE price IS NOT NULL),
{name}_walk AS (
  SELECT symbol, rn, price AS last_price, true AS accepted FROM {name}_numbered WHERE rn = 1
  UNION ALL
  SELECT n.symbol, n.rn, CASE WHEN {keep} THEN n.price ELSE w.last_price END, {keep}
  FROM {name}_walk w JOIN {name}_numbered n ON n.symbol = w.symbol AND n.rn = w.rn + 1),
{name} AS (SELECT n.*, w.accepted FROM {name}_numbered n JOIN {name}_walk w USING (symbol, rn))"""


ORACLE: dict[str, str] = {
    "declared_scan": "SELECT value, event_id, CAST(NULL AS VARCHAR) AS venue FROM events",
    "data_file_rows": "SELECT 1 AS files, count(*) AS row_count FROM events",
    "newest_ticks": f"{_WITH} SELECT * FROM ticks ORDER BY event_time DESC, tick_id LIMIT 50",
    "silver_preview": f"{_WITH} SELECT * FROM silver ORDER BY event_time, tick_id LIMIT 20",
    "wire_round_trip": f"{_WITH} SELECT symbol, price, source, event_time FROM ticks",
    "wire_malformed": f"""{_WITH} SELECT symbol, count(*) AS records, count(price) AS prices, count(event_time) AS times FROM ticks GROUP BY symbol
UNION ALL SELECT NULL, (SELECT count(*) FROM events) + (SELECT count(*) FROM documents), 0, 0""",
    "quote_payloads": """SELECT event_id AS tick_id, CASE event_type WHEN 'click' THEN 'USD/EGP' ELSE 'XAU/USD' END AS symbol,
  CASE WHEN event_type IN ('error', 'view') THEN NULL ELSE value END AS price,
  CASE WHEN event_type IN ('error', 'view') THEN 'fallback' WHEN event_type = 'click' THEN 'fxapi' ELSE 'gold_api' END AS source,
  ts AS event_time FROM events""",
    "page_prices": """SELECT 'page' AS kind, page_id AS id, CAST(NULL AS DOUBLE) AS price, 'table not found' AS reason FROM pages
UNION ALL SELECT 'part', p_partkey, CAST(floor(round(p_retailprice * 10, 2)) AS DOUBLE), NULL FROM part""",
    "valid_ticks": f"{_WITH} SELECT * FROM silver",
    "distinct_ticks": f"""{_WITH} SELECT min(tick_id) AS tick_id, symbol, price, any_value(source) AS source, event_time
FROM silver GROUP BY symbol, price, event_time""",
    "unwritten_ticks": f"{_WITH} SELECT * FROM silver WHERE event_time >= {_CUT}",
    "ticks_after": f"{_WITH} SELECT * FROM ticks WHERE event_time > {_CUT}",
    "outlier_flags": f"""{_WITH}, {_outliers('silver', 'event_time, tick_id', "CASE symbol WHEN 'click' THEN 70.0 ELSE 90.0 END", 'o')}
SELECT tick_id, symbol, price, source, event_time, accepted FROM o""",
    "supplier_outliers": f"""WITH RECURSIVE {SUPPLIER_TICKS}, {_outliers('sticks', 'event_time, order_key, line_number, part_key', '25.0', 'o')}
SELECT symbol, count(*) AS accepted, round(sum(price), 2) AS price_sum FROM o WHERE accepted GROUP BY symbol""",
    "price_bars": f"{_WITH} {_BARS}",
    "tick_signals": f"{_WITH}, {SIGNALS} SELECT tick_id, symbol, price, previous_price, change_percent, spike, trend FROM signals",
    "signal_alerts": f"""{_WITH}, {SIGNALS}, {FIRED}
SELECT symbol, price, event_time, tick_id, alert_type, message, change_percent, previous_price, prices FROM fired""",
    "supplier_signals": f"""WITH RECURSIVE {SUPPLIER_TICKS},
{_signals('sticks', 'event_time, order_key, line_number, part_key', 40.0, 5, 'ssignals')},
{_fired('ssignals', 'event_time, order_key, line_number, part_key', 86400 * 20 * 1_000_000, 'sfired')}
SELECT symbol, price, event_time, order_key, line_number, part_key, alert_type, message, change_percent, previous_price, prices FROM sfired""",
    "leg_prices": f"""{_WITH}, {LEGS}
SELECT tick_id, symbol, global_price, rate_price, local_price, global_us, rate_us, local_us FROM legs""",
    "gap_candidates": f"""{_WITH}, {LEGS}
SELECT tick_id, round(expected, 4) AS expected, gap, global_age_sec, local_age_sec FROM wide""",
    "gap_alerts": f"""{_WITH}, {LEGS}
SELECT tick_id, event_time, gap, message, global_age_sec, local_age_sec FROM gap_fired""",
    "alert_rows": f"{_WITH_ALERTS} SELECT {_ALERT_COLUMNS} FROM alerts",
    "alerts_after_restart": f"{_WITH_ALERTS} SELECT {_ALERT_COLUMNS} FROM alerts WHERE created_at > {_CUT}",
    "graded_orders": """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'GOLD_GAP' ELSE 'SPIKE_UP' END AS alert_type,
  CASE WHEN o_orderpriority = '5-LOW' THEN 'LOW'
       WHEN o_totalprice / 1000 >= CASE o_orderstatus WHEN 'F' THEN 300 ELSE 200 END THEN 'HIGH'
       WHEN o_totalprice / 1000 >= CASE o_orderstatus WHEN 'F' THEN 150 ELSE 120 END THEN 'MEDIUM' ELSE 'LOW' END AS severity
FROM orders""",
    "alert_messages": f"""{_WITH_ALERTS} SELECT alert_id, created_at, concat_ws(chr(10),
  CASE alert_type WHEN 'SPIKE_UP' THEN '📈' WHEN 'SPIKE_DOWN' THEN '📉' WHEN 'UPTREND' THEN '🚀' WHEN 'DOWNTREND' THEN '⬇️' ELSE '🔔' END
    || ' *' || alert_type || '* ' || CASE severity WHEN 'HIGH' THEN '🔴' WHEN 'MEDIUM' THEN '🟡' ELSE '🟢' END,
  '🕐 `' || strftime(created_at + INTERVAL '2 hours', '%Y-%m-%d %H:%M:%S') || ' (Cairo)`',
  '*Symbol:* `' || symbol || '`',
  '*Message:* ' || message,
  '*Price:* `' || format('{{:,.2f}}', current_price) || '`',
  CASE WHEN alert_type = 'GOLD_GAP' THEN '*Expected:*    `' || CAST(expected AS VARCHAR) || ' EGP`' END,
  CASE WHEN alert_type = 'GOLD_GAP' THEN '*Actual:*      `' || CAST(current_price AS VARCHAR) || ' EGP`' END,
  CASE WHEN alert_type = 'GOLD_GAP' THEN '*USD/EGP:*     `' || CAST(rate_price AS VARCHAR) || '`' END,
  CASE WHEN alert_type = 'GOLD_GAP' THEN '*Global Gold:* `' || CAST(global_price AS VARCHAR) || ' USD`' END,
  CASE WHEN alert_type LIKE 'SPIKE%' THEN '*Previous:* `' || previous_price || '`' END) AS text
FROM alerts""",
    "state_entries": f"""{_WITH}, newest AS (
  SELECT symbol, price, row_number() OVER (PARTITION BY symbol ORDER BY event_time DESC, tick_id DESC) AS back FROM silver)
SELECT symbol || '__last_price' AS state_key, CAST(price AS VARCHAR) AS state_value FROM newest WHERE back = 1
UNION ALL
SELECT symbol || '__price_history', '[' || string_agg(CAST(price AS VARCHAR), ',' ORDER BY back DESC) || ']'
FROM newest WHERE back <= 4 GROUP BY symbol""",
    "state_seeds": f"""{_WITH_ALERTS} SELECT symbol, alert_type, epoch_us(max(created_at)) AS seed_t,
  coalesce(max_by(change_amount, created_at), 0.0) AS seed_v FROM alerts GROUP BY symbol, alert_type""",
    "state_upsert": """SELECT o_orderpriority AS state_key, CAST(max(o_custkey) AS VARCHAR) AS state_value, max(o_orderdate) AS updated_at FROM orders GROUP BY 1
UNION ALL SELECT o_orderstatus, CAST(max(o_orderkey) AS VARCHAR), max(o_orderdate) FROM orders GROUP BY 1
UNION ALL SELECT event_type, CAST(max(event_id) AS VARCHAR), max(ts) FROM events GROUP BY 1""",
    "recent_alerts": f"""{_WITH_ALERTS} SELECT {_ALERT_COLUMNS} FROM alerts
WHERE created_at >= {_NOW} - INTERVAL '240 hours' ORDER BY created_at DESC, alert_id LIMIT 500""",
    "all_alerts": f"{_WITH_ALERTS} SELECT alert_id, created_at, alert_type FROM alerts ORDER BY created_at DESC, alert_id",
    "alert_counts_by_type": f"""{_WITH_ALERTS} SELECT alert_type, severity, count(*) AS "count" FROM alerts
WHERE created_at >= {_NOW} - INTERVAL '480 hours' GROUP BY ALL ORDER BY 3 DESC, 1, 2""",
    "alerts_timeseries": f"""{_WITH_ALERTS} SELECT time_bucket(INTERVAL '50 minutes', created_at) AS "time", alert_type, count(*) AS "count"
FROM alerts WHERE created_at >= {_NOW} - INTERVAL '480 hours' GROUP BY ALL ORDER BY 1, 2""",
    "recent_alert_count": f"""{_WITH_ALERTS} SELECT count(*) AS "count" FROM alerts WHERE created_at >= {_NOW} - INTERVAL '1440 minutes'""",
    "gap_history": f"""{_WITH_ALERTS} SELECT created_at, change_amount AS gap_egp, severity, CAST(expected AS VARCHAR) AS expected,
  CAST(current_price AS VARCHAR) AS actual, CAST(global_price AS VARCHAR) AS global_gold, CAST(rate_price AS VARCHAR) AS usd_egp
FROM alerts WHERE alert_type = 'GOLD_GAP' AND created_at >= {_NOW} - INTERVAL '240 hours' ORDER BY created_at, alert_id LIMIT 400""",
    "price_history": f"""{_WITH} SELECT event_time AS "time", price FROM silver
WHERE symbol = 'click' AND event_time >= {_NOW} - INTERVAL '480 hours' ORDER BY 1, 2 LIMIT 300""",
    "latest_price": f"{_WITH} SELECT symbol, price, event_time FROM silver WHERE symbol = 'purchase' ORDER BY event_time DESC, tick_id DESC LIMIT 1",
    "latest_prices": f"""{_WITH} SELECT symbol, price, event_time FROM silver
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY event_time DESC, tick_id DESC) = 1""",
    "supplier_latest_prices": f"""WITH {SUPPLIER_TICKS} SELECT symbol, price, event_time FROM sticks
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY event_time DESC, order_key DESC, line_number DESC, part_key DESC, price DESC) = 1""",
    "last_ticks": f"{_WITH} SELECT symbol, max(event_time) AS last_seen FROM silver GROUP BY symbol",
    "feed_ages": f"""{_WITH} SELECT symbol, max(event_time) AS last_seen,
  (epoch_us({_NOW}) - epoch_us(max(event_time))) / 1000000.0 AS age_seconds FROM silver GROUP BY symbol""",
    "layer_lag": f"""{_WITH} SELECT ((SELECT epoch_us(max(event_time)) FROM ticks)
  - (SELECT epoch_us(max(event_time)) FROM silver WHERE symbol = 'click')) / 1000000.0 AS lag_seconds""",
    "row_counts": f"""{_WITH} SELECT 'bronze' AS layer, count(*) AS row_count FROM ticks
UNION ALL SELECT 'silver', count(*) FROM silver UNION ALL SELECT 'gold', 0""",
    "batch_counts": f"""{_WITH_ALERTS} SELECT (SELECT count(*) FROM silver) AS ticks, (SELECT count(*) FROM alerts) AS alerts,
  (SELECT max(event_time) FROM silver) AS high_water""",
    "health_report": f"{_REPORT} SELECT * FROM checks",
    "report_summary": f"""{_REPORT} SELECT bool_and(status = 'OK') AS is_healthy, bool_or(status = 'DEAD') AS has_dead,
  {_WORST} AS worst_status FROM checks""",
    "status_changes": _REPORT
    + ", "
    + CHECKS.format(name="old", silver="silver").partition("),\n")[2]
    + """, bad AS (SELECT name FROM checks WHERE status <> 'OK'), was AS (SELECT name FROM old WHERE status <> 'OK')
SELECT name, 'newly_bad' AS change FROM (SELECT name FROM bad EXCEPT SELECT name FROM was)
UNION ALL SELECT name, 'recovered' FROM (SELECT name FROM was EXCEPT SELECT name FROM bad)""",
    "order_status_changes": """WITH log AS (
  SELECT CAST(o_custkey AS VARCHAR) AS name, o_orderdate AS report_time,
         max(CASE o_orderstatus WHEN 'F' THEN 'WARN' WHEN 'O' THEN 'OK' ELSE 'DEAD' END) <> 'OK' AS bad
  FROM orders GROUP BY ALL),
seen AS (SELECT *, coalesce(lag(bad) OVER (PARTITION BY name ORDER BY report_time), false) AS was FROM log)
SELECT report_time, name, CASE WHEN bad THEN 'newly_bad' ELSE 'recovered' END AS change FROM seen WHERE bad <> was""",
    "health_message": f"""{_REPORT} SELECT {_MARK.format(s=_WORST)} || ' *Pipeline Health* — `2024-01-31 02:00:00 (Cairo)`' || chr(10) || chr(10) ||
  string_agg({_MARK.format(s='status')} || ' *' || replace(replace(name, 'feed:', ''), 'pipeline:', '') || '*: ' || message, chr(10) ORDER BY position) AS text
FROM checks""",
    "health_log": f"""{_REPORT} SELECT 0 AS line, '[2024-01-31 02:00:00] STATUS=' || {_WORST} AS text
UNION ALL SELECT position, '  ' || {_MARK.format(s='status')} || ' ' || message FROM checks""",
    "heartbeats": f"""{_WITH} SELECT CAST(event_time + INTERVAL '2 hours' AS DATE) AS local_date, min(event_time) AS sent_at,
  '💚 *Daily Heartbeat* — Pipeline is running' || chr(10) || '🕐 `' || strftime(min(event_time) + INTERVAL '2 hours', '%Y-%m-%d %H:%M:%S') || ' (Cairo)`' AS text
FROM ticks WHERE hour(event_time + INTERVAL '2 hours') = 9 GROUP BY 1""",
    "bronze_silver_stream": f"{_WITH} SELECT DISTINCT symbol, price, source, event_time FROM silver",
    "bar_stream": f"""{_WITH}, bars AS ({_BARS}) SELECT * FROM bars
WHERE window_end <= (SELECT max(event_time) FROM silver) - INTERVAL '1 minute'""",
    "alert_stream": f"""{_WITH}, {SIGNALS}, {FIRED}, {LEGS}, {STREAM_ALERTS}
SELECT alert_id, symbol, alert_type, severity, message, created_at, extra_data FROM alerts
WHERE created_at > TIMESTAMP '2023-12-31 23:00:00'""",
    "table_row_counts": """SELECT 'events' AS layer, count(*) AS row_count FROM events
UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'gone', 0""",
    "last_ticks_by_day": f"""{_WITH} SELECT symbol, max(event_time) AS last_seen FROM silver
WHERE symbol IN ('click', 'purchase') OR symbol = 'view' AND event_time < TIMESTAMP '2024-01-09' GROUP BY symbol""",
    "silver_after_reset": f"{_WITH} SELECT DISTINCT symbol, price, source, event_time, 2 AS attempts FROM silver",
    "outlier_stream": f"""{_WITH}, {_outliers('silver', 'event_time, tick_id', "CASE symbol WHEN 'click' THEN 70.0 ELSE 90.0 END", 'o')}
SELECT tick_id, symbol, price, source, event_time, accepted FROM o""",
    "accepted_prices": f"""{_WITH}, {_outliers('silver', 'event_time, tick_id', "CASE symbol WHEN 'click' THEN 70.0 ELSE 90.0 END", 'o')}
SELECT symbol, arg_max(price, (event_time, tick_id)) AS price FROM o WHERE accepted GROUP BY symbol""",
    "alert_stream_batches": f"""{_WITH}, {SIGNALS}, {FIRED}, {LEGS}, {STREAM_ALERTS}
SELECT alert_id, symbol, alert_type, severity, message, created_at, extra_data FROM alerts
WHERE created_at > TIMESTAMP '2023-12-31 23:00:00'""",
    "late_ticks": f"""{_WITH}, {SIGNALS}, {FIRED}, {LEGS}, {STREAM_ALERTS},
landed AS (
  SELECT *, CASE WHEN event_time < TIMESTAMP '2024-01-08' THEN 0 WHEN event_time < {_CUT} THEN 1
                 WHEN event_time < TIMESTAMP '2024-01-23' THEN 2 ELSE 4 END AS batch_id FROM silver),
fired_in AS (
  SELECT CASE WHEN created_at < TIMESTAMP '2024-01-08' THEN 0 WHEN created_at < {_CUT} THEN 1
              WHEN created_at < TIMESTAMP '2024-01-23' THEN 2 ELSE 4 END AS batch_id, count(*) AS n FROM alerts GROUP BY 1)
SELECT batch_id, count(*) AS ticks, coalesce(any_value(n), 0) AS alerts, 0 AS late_ticks, max(event_time) AS high_water
FROM landed LEFT JOIN fired_in USING (batch_id) GROUP BY batch_id
UNION ALL SELECT 3, 0, 0, count(*), NULL FROM landed WHERE batch_id = 0""",
}

# The same answers whatever the layout.
ORACLE |= {f"sliced_{name}": ORACLE[name] for name in ("outlier_flags", "gap_alerts", "supplier_signals")}
