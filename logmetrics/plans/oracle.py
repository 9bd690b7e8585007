"""DuckDB SQL for each registered query, over the driver's pre-registered views.

Written independently of the Spark plans (window frames where Spark uses fan-out
aggregation, list functions where Spark uses arrays, and so on), so a match is a real
check.  Notes: DuckDB ``sum(BIGINT)`` is HUGEINT, cast back to BIGINT;
``quantile_disc`` equals Spark's ``percentile_approx`` on these group sizes and
``percentile_disc`` always.
"""

from __future__ import annotations

LOGS = """logs AS (
  SELECT event_id, ts AS event_ts,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS "timestamp",
    CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARN' WHEN 'view' THEN 'DEBUG' ELSE 'INFO' END
      AS level,
    (['api-gateway', 'auth-service', 'user-service', 'payment-service', 'order-service',
      'notification-service'])[user_id % 6 + 1] AS service,
    'host-' || (user_id % 10 + 1) AS host,
    'req-' || printf('%08d', event_id) AS request_id,
    'trace-' || (100000 + (event_id * 7919) % 900000) AS trace_id,
    (['GET', 'POST', 'PUT', 'DELETE', 'PATCH'])[event_id % 5 + 1] AS http_method,
    (['/api/v1/users', '/api/v1/orders', '/api/v1/payments', '/api/v1/products'])[user_id % 4 + 1] AS http_path,
    CAST(CASE event_type WHEN 'error' THEN 500 + k % 4 WHEN 'signup' THEN 400 + k % 5 ELSE 200 + k % 5 END
      AS INTEGER) AS http_status,
    CAST(floor(value) AS INTEGER) AS response_time_ms,
    '10.0.' || (user_id % 255 + 1) || '.' || (event_id % 255 + 1) AS client_ip,
    'Load test log' AS message,
    CAST(NULL AS VARCHAR) AS stack_trace
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) e
)"""

LOG_FIELDS = ('"timestamp", level, service, host, request_id, trace_id, http_method, http_path, http_status, '
              "response_time_ms, client_ip, message, stack_trace")


def sig(x: str, digits: int = 9) -> str:
    """``x`` rounded to significant digits, once, as the query does at its end."""
    return f"CAST(printf('%.{digits - 1}e', {x}) AS DOUBLE)"


def with_logs(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([LOGS, *ctes]) + "\n" + body


def _json_field(name: str, quoted: bool) -> str:
    v = f"'\"' || {name} || '\"'" if quoted else f"CAST({name} AS VARCHAR)"
    return f"CASE WHEN {name} IS NULL THEN NULL ELSE '\"{name.strip(chr(34))}\":' || {v} END"


_JSON_PARTS = [
    _json_field(c, c not in ("http_status", "response_time_ms"))
    for c in ['"timestamp"', "level", "service", "host", "request_id", "trace_id", "http_method", "http_path",
              "http_status", "response_time_ms", "client_ip", "message", "stack_trace"]
]
_PAYLOAD = "'{' || concat_ws(',', " + ", ".join(_JSON_PARTS) + ") || '}'"

PCT = ("quantile_disc(response_time_ms, 0.5) AS p50, quantile_disc(response_time_ms, 0.95) AS p95, "
       "quantile_disc(response_time_ms, 0.99) AS p99")

ORACLE: dict[str, str] = {}

ORACLE["parse_logs"] = with_logs(
    f"SELECT event_id, {LOG_FIELDS}, time_bucket(INTERVAL '1 second', event_ts) + INTERVAL '1 second' "
    "AS kafka_timestamp FROM logs"
)

ORACLE["encode_logs"] = with_logs(
    f"SELECT event_id, payload, CAST(strlen(payload) + 2 * 12 - 1 AS BIGINT) AS payload_bytes "
    f"FROM (SELECT event_id, {_PAYLOAD} AS payload FROM logs) p"
)

ORACLE["batch_metrics"] = with_logs(
    f"""SELECT service, level, count(*) AS log_count, avg(response_time_ms) AS avg_latency, {PCT},
  count(*) FILTER (WHERE level = 'ERROR') AS error_count
FROM logs GROUP BY service, level"""
)

ORACLE["error_rate"] = with_logs(
    """SELECT service, total, errors, CAST(errors AS DOUBLE) / total * 100.0 AS error_rate
FROM (SELECT service, count(*) AS total, count(*) FILTER (WHERE level = 'ERROR') AS errors
      FROM logs GROUP BY service) t
WHERE total > 0"""
)

ORACLE["error_count"] = with_logs(
    "SELECT service, level, count(*) FILTER (WHERE level = 'ERROR') AS error_count FROM logs GROUP BY ALL"
)

ORACLE["latency_percentiles"] = with_logs(
    f"""SELECT service, p50, coalesce(p95, 0) AS p95, coalesce(p99, 0) AS p99
FROM (SELECT service, {PCT} FROM logs GROUP BY service) t WHERE p50 IS NOT NULL"""
)

ORACLE["percentiles_exact"] = with_logs(f"SELECT service, level, {PCT} FROM logs GROUP BY service, level")

ORACLE["metric_samples"] = with_logs(
    f"""SELECT 'spark_logs_per_batch' AS metric, service, level, CAST(NULL AS VARCHAR) AS percentile,
  CAST(count(*) AS DOUBLE) AS value
FROM logs GROUP BY service, level
UNION ALL
SELECT 'spark_error_rate', service, NULL, NULL,
  CAST(count(*) FILTER (WHERE level = 'ERROR') AS DOUBLE) / count(*) * 100.0
FROM logs GROUP BY service
UNION ALL
SELECT 'spark_latency_ms', service, NULL, pct, v
FROM (SELECT service, {PCT} FROM logs GROUP BY service) s,
  LATERAL (VALUES ('p50', CAST(p50 AS DOUBLE)), ('p95', CAST(coalesce(p95, 0) AS DOUBLE)),
                  ('p99', CAST(coalesce(p99, 0) AS DOUBLE))) v(pct, v)
WHERE p50 IS NOT NULL"""
)

MEASURES = f"""count(*) AS log_count, avg(response_time_ms) AS avg_latency, {PCT},
  count(*) FILTER (WHERE level = 'ERROR') AS error_count"""


def _window(d: str) -> str:
    return (f"time_bucket(INTERVAL '{d}', event_ts) AS window_start, "
            f"time_bucket(INTERVAL '{d}', event_ts) + INTERVAL '{d}' AS window_end")


ORACLE["window_1m"] = with_logs(f"SELECT {_window('1 minute')}, service, level, {MEASURES} FROM logs GROUP BY ALL")
ORACLE["window_5m"] = with_logs(f"SELECT {_window('5 minutes')}, service, level, {MEASURES} FROM logs GROUP BY ALL")
ORACLE["errors_5s"] = with_logs(
    f"SELECT {_window('5 seconds')}, service, count(*) AS errors FROM logs WHERE level = 'ERROR' GROUP BY ALL"
)
ORACLE["error_anomalies"] = with_logs(
    f"""SELECT * FROM (
  SELECT {_window('1 hour')}, service, count(*) AS total, count(*) FILTER (WHERE level = 'ERROR') AS errors,
    CAST(count(*) FILTER (WHERE level = 'ERROR') AS DOUBLE) / count(*) * 100.0 AS error_rate
  FROM logs GROUP BY ALL) t
WHERE error_rate > 10.0"""
)
ORACLE["ingest_delay"] = with_logs(
    """SELECT service, count(d) AS samples, count(*) - count(d) AS unparsed, avg(d) / 1000.0 AS avg_delay_ms,
  quantile_disc(d, 0.5) / 1000.0 AS delay_p50_ms, quantile_disc(d, 0.95) / 1000.0 AS delay_p95_ms,
  quantile_disc(d, 0.99) / 1000.0 AS delay_p99_ms, max(d) / 1000.0 AS max_delay_ms
FROM (SELECT service,
        epoch_us(time_bucket(INTERVAL '1 second', event_ts) + INTERVAL '1 second')
        - CASE event_id % 97 WHEN 1 THEN NULL WHEN 2 THEN NULL
               WHEN 3 THEN epoch_us(date_trunc('second', event_ts))
               WHEN 4 THEN epoch_us(event_ts - INTERVAL '7 hours')
               ELSE epoch_us(event_ts) END AS d
      FROM logs) t
GROUP BY service"""
)
ORACLE["unwindowed_rows"] = with_logs("SELECT service, count(*) AS rows FROM logs WHERE event_id % 89 = 0 GROUP BY service")
ORACLE["daily_report"] = with_logs(
    f"""SELECT CAST(event_ts AS DATE) AS date, service, level, count(*) AS log_count,
  count(*) FILTER (WHERE level = 'ERROR') AS error_count, avg(response_time_ms) AS avg_latency, {PCT},
  count(*) FILTER (WHERE floor(http_status / 100) = 2) AS status_2xx,
  count(*) FILTER (WHERE floor(http_status / 100) = 3) AS status_3xx,
  count(*) FILTER (WHERE floor(http_status / 100) = 4) AS status_4xx,
  count(*) FILTER (WHERE floor(http_status / 100) = 5) AS status_5xx,
  CAST(count(*) FILTER (WHERE level = 'ERROR') AS DOUBLE) / count(*) * 100.0 AS error_rate
FROM logs GROUP BY ALL"""
)
ORACLE["threshold_band"] = with_logs(
    f"""SELECT panel, service, value,
  CASE WHEN value IS NULL THEN NULL WHEN value >= hi THEN 'red' WHEN value >= mid THEN 'yellow' ELSE 'green' END
    AS band
FROM (
  SELECT 'error_rate_pct' AS panel, service,
    CAST(count(*) FILTER (WHERE level = 'ERROR') AS DOUBLE) / count(*) * 100.0 AS value, 5.0 AS mid, 10.0 AS hi
  FROM logs GROUP BY service
  UNION ALL
  SELECT 'latency_ms', service, CAST(quantile_disc(response_time_ms, 0.95) AS DOUBLE), 200.0, 500.0
  FROM logs GROUP BY service HAVING quantile_disc(response_time_ms, 0.5) IS NOT NULL
  UNION ALL
  SELECT 'logs_per_second', NULL, CAST(max(n) AS DOUBLE), 500.0, 1000.0
  FROM (SELECT count(*) AS n FROM logs WHERE event_ts IS NOT NULL GROUP BY time_bucket(INTERVAL '1 second', event_ts)) c) t"""
)

# --- sketches: exact, since no group at this size is beyond the sketch's exact range


def _rolled(time: str, keys: str) -> str:
    return with_logs(
        f"""SELECT {time} AS window_start, {keys}, count(*) AS log_count, count(*) FILTER (WHERE level = 'ERROR') AS error_count,
  avg(response_time_ms) AS avg_latency, {PCT} FROM logs WHERE event_ts IS NOT NULL GROUP BY ALL""")


ORACLE["sketch_5m"] = _rolled("time_bucket(INTERVAL '5 minutes', event_ts)", "service, level")
ORACLE["sketch_day"] = _rolled("date_trunc('day', event_ts)::TIMESTAMP", "service, level")
ORACLE["sketch_service"] = _rolled("date_trunc('day', event_ts)::TIMESTAMP", "service")
ORACLE["percentile_rank_error"] = with_logs(
    """SELECT method, service, level, percentile, n, true AS within
FROM (SELECT service, level, count(response_time_ms) AS n FROM logs GROUP BY ALL HAVING count(response_time_ms) > 0) g,
  (SELECT unnest(['percentile_approx', 'sketch']) AS method) m, (SELECT unnest(['p50', 'p95', 'p99']) AS percentile) p""")

# --- counters -------------------------------------------------------------------------

COUNTS = """counts AS (
  SELECT coalesce(service, '') AS service, coalesce(level, '') AS level,
    time_bucket(INTERVAL '15 seconds', event_ts) + INTERVAL '15 seconds' AS ts, count(*) AS n
  FROM logs WHERE event_ts IS NOT NULL GROUP BY ALL)"""
GRID = """bounds AS (SELECT service, level, min(ts) AS s FROM counts GROUP BY ALL),
grid AS (
  SELECT service, level, unnest(generate_series(s, (SELECT max(ts) FROM counts), INTERVAL '15 seconds')) AS ts
  FROM bounds)"""
SAMPLES = """samples AS (
  SELECT g.service, g.level, g.ts,
    CAST(sum(coalesce(c.n, 0)) OVER (PARTITION BY g.service, g.level ORDER BY g.ts
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS value
  FROM grid g LEFT JOIN counts c ON c.service = g.service AND c.level = g.level AND c.ts = g.ts)"""


def _stats(range_sql: str) -> str:
    return f"""corr AS (
  SELECT *, CASE WHEN prev IS NOT NULL AND value < prev THEN prev ELSE 0.0 END AS c
  FROM (SELECT *, lag(value) OVER (PARTITION BY service, level ORDER BY ts) AS prev FROM samples) l),
st AS (
  SELECT service, level, epoch_us(ts) AS t_us, count(*) OVER f AS n,
    epoch_us(first_value(ts) OVER f) AS first_us, epoch_us(ts) AS last_us,
    first_value(value) OVER f AS first_v, value AS last_v, sum(c) OVER f - first_value(c) OVER f AS resets
  FROM corr
  WINDOW f AS (PARTITION BY service, level ORDER BY ts RANGE BETWEEN INTERVAL '{range_sql}' PRECEDING AND CURRENT ROW))"""


def _rates(range_sql: str, range_us: int) -> str:
    return f"""{_stats(range_sql)},
r0 AS (
  SELECT service, level, t_us, n, first_v, last_v - first_v + resets AS inc, (last_us - first_us) / 1e6 AS si,
    (first_us - (t_us - {range_us})) / 1e6 AS d_start0, (t_us - last_us) / 1e6 AS d_end
  FROM st WHERE n >= 2),
r1 AS (
  SELECT *, si / (n - 1) AS avg_i,
    CASE WHEN inc > 0 AND first_v >= 0 AND si * (first_v / inc) < d_start0 THEN si * (first_v / inc)
         ELSE d_start0 END AS d_start
  FROM r0),
rates AS (
  SELECT service, level, make_timestamp(t_us) AS ts,
    inc * ((si + CASE WHEN d_start < avg_i * 1.1::DOUBLE THEN d_start ELSE avg_i / 2.0::DOUBLE END
               + CASE WHEN d_end < avg_i * 1.1::DOUBLE THEN d_end ELSE avg_i / 2.0::DOUBLE END) / si)
      / {range_us / 1e6}::DOUBLE AS rate
  FROM r1)"""


_M = 60_000_000
SHORT_RATES = _rates("1 minute", _M)
LONG_RATES = _rates("5 minutes", 5 * _M)

# One label per series: the same steps with fewer series.
_BY_SERVICE = [x.replace("coalesce(level, '') AS level", "'' AS level") for x in (COUNTS, GRID, SAMPLES)]
_BY_LEVEL = [x.replace("coalesce(service, '') AS service", "'' AS service") for x in (COUNTS, GRID, SAMPLES)]

ORACLE["counter_samples"] = with_logs("SELECT service, ts, value FROM samples", *_BY_SERVICE)
ORACLE["counter_increase"] = with_logs(
    "SELECT level, make_timestamp(t_us) AS ts, n, last_v - first_v + resets AS increase "
    "FROM st WHERE n >= 2", *_BY_LEVEL, _stats("1 minute"))
ORACLE["counter_rate"] = with_logs("SELECT service, ts, rate FROM rates", *_BY_SERVICE, SHORT_RATES)
ORACLE["counter_samples_series"] = with_logs("SELECT service, level, ts, value FROM samples", COUNTS, GRID, SAMPLES)
ORACLE["counter_increase_series"] = with_logs(
    "SELECT service, level, make_timestamp(t_us) AS ts, n, last_v - first_v + resets AS increase "
    "FROM st WHERE n >= 2", COUNTS, GRID, SAMPLES, _stats("1 minute"))
ORACLE["counter_rate_series"] = with_logs("SELECT service, level, ts, rate FROM rates", COUNTS, GRID, SAMPLES, SHORT_RATES)
ORACLE["logs_per_second"] = with_logs(f"SELECT ts, {sig('sum(rate)')} AS value FROM rates GROUP BY ts",
                                      COUNTS, GRID, SAMPLES, SHORT_RATES)
ORACLE["rate_by_service"] = with_logs(f"SELECT ts, service, {sig('sum(rate)')} AS value FROM rates GROUP BY ALL",
                                      COUNTS, GRID, SAMPLES, SHORT_RATES)
ORACLE["rate_by_level"] = with_logs(f"SELECT ts, level, {sig('sum(rate)')} AS value FROM rates GROUP BY ALL",
                                    COUNTS, GRID, SAMPLES, SHORT_RATES)
ORACLE["error_rate_5m"] = with_logs(
    f"""SELECT ts, CASE WHEN den = 0 THEN NULL ELSE {sig('num / den * 100.0')} END AS value
FROM (SELECT ts, sum(CASE WHEN level = 'ERROR' THEN rate END) AS num, sum(rate) AS den,
        count(*) FILTER (WHERE level = 'ERROR') AS k
      FROM rates GROUP BY ts) t
WHERE k > 0""", COUNTS, GRID, SAMPLES, LONG_RATES)


def _event_rate(key: str, step_s: int, range_s: int) -> str:
    k = range_s // step_s
    return with_logs(
        f"""SELECT e.ts, e.{key}, CAST(sum(b.n) AS BIGINT) AS events, CAST(sum(b.n) AS BIGINT) / {range_s}.0::DOUBLE AS rate
FROM (SELECT DISTINCT {key}, b + to_seconds({step_s} * k) AS ts FROM b, range(1, {k + 1}) r(k)) e
JOIN b ON b.{key} = e.{key} AND b.b >= e.ts - to_seconds({range_s}) AND b.b < e.ts
GROUP BY ALL""",
        f"""b AS (SELECT coalesce({key}, '') AS {key}, time_bucket(to_seconds({step_s}), event_ts) AS b,
  count(*) AS n FROM logs WHERE event_ts IS NOT NULL GROUP BY ALL)""")


ORACLE["event_rate_1m"] = _event_rate("service", 15, 60)
ORACLE["event_rate_5m"] = _event_rate("level", 60, 300)
ORACLE["last_value_gauge"] = with_logs(
    "SELECT service, level, max(ts) AS ts, arg_max(value, ts) AS value FROM samples GROUP BY ALL",
    COUNTS, GRID, SAMPLES)
ORACLE["total_logs"] = with_logs("SELECT CAST(count(*) AS DOUBLE) AS total_logs FROM logs WHERE event_ts IS NOT NULL")

# --- metrics history --------------------------------------------------------------------

HISTORY = f"""h0 AS (
  SELECT epoch_us(kts) // 1000000 AS batch_id, time_bucket(INTERVAL '1 second', kts) + INTERVAL '1 second' AS ts,
    service, level, response_time_ms
  FROM (SELECT *, time_bucket(INTERVAL '1 second', event_ts) + INTERVAL '1 second' AS kts FROM logs) p),
history AS (
  SELECT batch_id, ts, 'spark_logs_per_batch' AS metric, service, level, CAST(NULL AS VARCHAR) AS percentile,
    CAST(count(*) AS DOUBLE) AS value
  FROM h0 GROUP BY batch_id, ts, service, level
  UNION ALL
  SELECT batch_id, ts, 'spark_error_rate', service, NULL, NULL,
    CAST(count(*) FILTER (WHERE level = 'ERROR') AS DOUBLE) / count(*) * 100.0
  FROM h0 GROUP BY batch_id, ts, service
  UNION ALL
  SELECT batch_id, ts, 'spark_latency_ms', service, NULL, pct, v
  FROM (SELECT batch_id, ts, service, {PCT} FROM h0 GROUP BY batch_id, ts, service) s,
    LATERAL (VALUES ('p50', CAST(p50 AS DOUBLE)), ('p95', CAST(coalesce(p95, 0) AS DOUBLE)),
                    ('p99', CAST(coalesce(p99, 0) AS DOUBLE))) v(pct, v)
  WHERE p50 IS NOT NULL)"""

ORACLE["metrics_history"] = with_logs("SELECT * FROM history", HISTORY)
ORACLE["metrics_latest"] = with_logs("SELECT * FROM history WHERE batch_id = (SELECT max(batch_id) FROM history)",
                                     HISTORY)
ORACLE["select_series"] = with_logs(
    "SELECT ts, service, percentile, value FROM history "
    "WHERE metric = 'spark_latency_ms' AND percentile IN ('p95', 'p99')", HISTORY)
ORACLE["time_range"] = with_logs(
    "SELECT * FROM history WHERE ts BETWEEN (SELECT max(ts) FROM history) - INTERVAL '15 minutes' "
    "AND (SELECT max(ts) FROM history)", HISTORY)
ORACLE["series_label"] = with_logs(
    """SELECT ts, metric,
  CASE WHEN metric = 'spark_logs_per_batch' THEN coalesce(service, '') || ' - ' || coalesce(level, '')
       ELSE coalesce(service, '') || ' ' || upper(percentile) END AS label, value
FROM history
WHERE metric = 'spark_logs_per_batch' OR (metric = 'spark_latency_ms' AND percentile IN ('p95', 'p99'))""",
    HISTORY)
ORACLE["logs_per_batch_by_service"] = with_logs(
    "SELECT ts, service, sum(value) AS value FROM history WHERE metric = 'spark_logs_per_batch' GROUP BY ALL",
    HISTORY)
ORACLE["series_reduce"] = with_logs(
    f"""SELECT metric, service, level, percentile, arg_max(value, ts) FILTER (WHERE value IS NOT NULL) AS last_value,
  {sig('avg(value)')} AS mean_value, max(value) AS max_value
FROM history GROUP BY metric, service, level, percentile""", HISTORY)
ORACLE["resample_last"] = with_logs(
    """SELECT g.t AS ts, g.service, g.level, s.value
FROM grid g ASOF JOIN s ON g.service IS NOT DISTINCT FROM s.service AND g.level IS NOT DISTINCT FROM s.level
  AND g.t >= s.ts
WHERE s.ts > g.t - INTERVAL '5 minutes'""",
    HISTORY,
    "s AS (SELECT ts, service, level, value FROM history WHERE metric = 'spark_logs_per_batch')",
    """grid AS (SELECT service, level,
  unnest(generate_series(time_bucket(INTERVAL '15 seconds', min(ts) + INTERVAL '14999999 microseconds'),
                         (SELECT max(ts) FROM s), INTERVAL '15 seconds')) AS t
  FROM s GROUP BY service, level)""")
ORACLE["gateway_scrape"] = with_logs(
    """SELECT g.t AS ts, h.metric, h.service, h.level, h.percentile, h.value
FROM (SELECT g.t, b.batch_id FROM grid g ASOF JOIN batches b ON g.t >= b.ts) g
JOIN history h ON h.batch_id = g.batch_id""",
    HISTORY,
    "batches AS (SELECT batch_id, max(ts) AS ts FROM history GROUP BY batch_id)",
    """grid AS (SELECT unnest(generate_series(
  time_bucket(INTERVAL '15 seconds', (SELECT min(ts) FROM history) + INTERVAL '14999999 microseconds'),
  (SELECT max(ts) FROM history), INTERVAL '15 seconds')) AS t)""")

# --- histograms -------------------------------------------------------------------------


def _k(keys, p=""):
    return ", ".join(f"{p}{k}" for k in keys)


def _on(keys, a, b):
    return " AND ".join(f"{a}.{k} = {b}.{k}" for k in keys)


_PAYLOAD_BYTES = f"CAST(strlen({_PAYLOAD}) + 2 * 12 - 1 AS BIGINT)"
_SIZE_LES = "[100.0::DOUBLE, 200.0, 500.0, 1000.0, 2000.0, 5000.0, 'Infinity'::DOUBLE]"
_LAT_LES = "[0.001::DOUBLE, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 'Infinity'::DOUBLE]"

ORACLE["size_histogram"] = with_logs(
    f"""SELECT b.le, count(x) FILTER (WHERE x <= b.le) AS bucket_count,
  (SELECT CAST(sum(x) AS BIGINT) FROM d) AS sum_value, (SELECT count(x) FROM d) AS count_value
FROM (SELECT unnest({_SIZE_LES}::DOUBLE[]) AS le) b, d GROUP BY b.le""",
    f"d AS (SELECT {_PAYLOAD_BYTES} AS x FROM logs)")

ORACLE["latency_histogram"] = with_logs(
    f"""SELECT d.service, b.le, count(x) FILTER (WHERE x <= b.le) AS bucket_count, s.sum_value, s.count_value
FROM (SELECT unnest({_LAT_LES}::DOUBLE[]) AS le) b, d
JOIN (SELECT service, CAST(sum(ms) AS BIGINT) / 1000.0::DOUBLE AS sum_value, count(ms) AS count_value FROM d GROUP BY service) s
  ON s.service IS NOT DISTINCT FROM d.service
GROUP BY d.service, b.le, s.sum_value, s.count_value""",
    "d AS (SELECT service, response_time_ms AS ms, response_time_ms / 1000.0::DOUBLE AS x FROM logs)")

# histogram_quantile: one column per bucket; a range's first sample is 20 rows back.
_LES = [0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, "'Infinity'"]
_B = range(len(_LES))


def _cols(form: str) -> str:
    return ", ".join(form.format(i=i, le=f"{le}::DOUBLE") for i, le in enumerate(_LES))


def _quantile_case() -> str:
    """Interpolation in the first bucket whose count reaches the rank."""
    cases = []
    for i in _B[:-1]:
        low_v, low_le = (f"v{i - 1}", f"{_LES[i - 1]}::DOUBLE") if i else ("0.0::DOUBLE", "0.0::DOUBLE")
        cases.append(f"WHEN v{i} >= rnk THEN {low_le} + ({_LES[i]}::DOUBLE - {low_le}) * ((rnk - {low_v}) / nullif(v{i} - {low_v}, 0))")
    return f"CASE WHEN v{_B[-1]} = 0 THEN NULL {' '.join(cases)} ELSE {_LES[-2]}::DOUBLE END"


ORACLE["histogram_quantile"] = with_logs(
    f"SELECT service, make_timestamp(t_us) AS ts, {_quantile_case()} * 1000.0::DOUBLE AS value_ms FROM q",
    f"""c AS (SELECT coalesce(service, '') AS service, time_bucket(INTERVAL '15 seconds', event_ts) + INTERVAL '15 seconds' AS ts,
  {_cols("count(x) FILTER (WHERE x <= {le}) AS b{i}")}
  FROM (SELECT *, response_time_ms / 1000.0::DOUBLE AS x FROM logs) WHERE event_ts IS NOT NULL GROUP BY ALL)""",
    """g AS (SELECT service, unnest(generate_series(s, (SELECT max(ts) FROM c), INTERVAL '15 seconds')) AS ts
  FROM (SELECT service, min(ts) AS s FROM c GROUP BY service))""",
    f"""s AS (SELECT service, ts, row_number() OVER w AS i, {_cols("sum(coalesce(b{i}, 0)) OVER w AS b{i}")}
  FROM g LEFT JOIN c USING (service, ts) WINDOW w AS (PARTITION BY service ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""",
    f"""f AS (SELECT service, epoch_us(ts) AS t_us, least(i, 21) AS n, {_cols("CAST(b{i} AS DOUBLE) AS b{i}")},
  {_cols("CAST(coalesce(lag(b{i}, 20) OVER w, first_value(b{i}) OVER w) AS DOUBLE) AS f{i}")}
  FROM s WINDOW w AS (PARTITION BY service ORDER BY i))""",
    f"""d AS (SELECT service, t_us, n, (n - 1) * 15.0::DOUBLE AS si, (300 - (n - 1) * 15.0::DOUBLE) AS gap, {_cols("f{i}")}, {_cols("b{i} - f{i} AS inc{i}")}
  FROM f WHERE n >= 2)""",
    f"""e AS (SELECT *, {_cols("CASE WHEN inc{i} > 0 AND si * (f{i} / inc{i}) < gap THEN si * (f{i} / inc{i}) ELSE gap END AS d{i}")} FROM d)""",
    f"""r AS (SELECT service, t_us, {_cols("inc{i} * ((si + CASE WHEN d{i} < 16.5::DOUBLE THEN d{i} ELSE 7.5::DOUBLE END) / si) / 300.0::DOUBLE AS r{i}")} FROM e)""",
    "m AS (SELECT service, t_us, " + ", ".join(f"greatest({', '.join(f'r{j}' for j in range(i + 1))}) AS v{i}" for i in _B) + " FROM r)",
    f"q AS (SELECT *, 0.95::DOUBLE * v{_B[-1]} AS rnk FROM m)")

# --- streaming, archive -----------------------------------------------------------------

_SLICE = """span AS (SELECT min(epoch_us(event_ts)) AS lo, max(epoch_us(event_ts)) AS hi FROM logs),
sliced AS (SELECT *, coalesce(least(2, (epoch_us(event_ts) - lo) * 3 // (hi - lo + 1)), 0) AS slice FROM logs, span)"""
_WEEK = """sliced AS (SELECT *, coalesce(week, min(week) OVER (), 0) AS slice
  FROM (SELECT *, CAST(floor(date_diff('day', DATE '2000-01-03', CAST(event_ts AS DATE)) / 7) AS BIGINT) AS week FROM logs) d)"""
_BATCHES = """w0 AS (
  SELECT slice, time_bucket(INTERVAL '1 second', event_ts) + INTERVAL '1 second' AS kts, service, level, response_time_ms
  FROM sliced),
parts AS (SELECT slice, row_number() OVER (ORDER BY slice) - 1 AS batch_id, max(kts) AS ts FROM w0 GROUP BY slice),
w AS (SELECT batch_id, ts, service, level, response_time_ms FROM w0 JOIN parts USING (slice))"""
_GAUGES = f"""SELECT batch_id, ts, 'spark_logs_per_batch' AS metric, service, level, CAST(NULL AS VARCHAR) AS percentile,
  CAST(count(*) AS DOUBLE) AS value
FROM w GROUP BY batch_id, ts, service, level
UNION ALL
SELECT batch_id, ts, 'spark_error_rate', service, NULL, NULL,
  CAST(count(*) FILTER (WHERE level = 'ERROR') AS DOUBLE) / count(*) * 100.0
FROM w GROUP BY batch_id, ts, service
UNION ALL
SELECT batch_id, ts, 'spark_latency_ms', service, NULL, pct, v
FROM (SELECT batch_id, ts, service, {PCT} FROM w GROUP BY batch_id, ts, service) s,
  LATERAL (VALUES ('p50', CAST(p50 AS DOUBLE)), ('p95', CAST(p95 AS DOUBLE)), ('p99', CAST(p99 AS DOUBLE))) v(pct, v)
WHERE p50 IS NOT NULL"""
ORACLE["stream_batch_metrics"] = with_logs(_GAUGES, _WEEK, _BATCHES)
ORACLE["history_compacted"] = ORACLE["metrics_history"]
ORACLE["history_snapshot"] = f"SELECT * FROM ({with_logs(_GAUGES, _SLICE, _BATCHES)}) s WHERE batch_id = 2"
ORACLE["rate_limited_stream"] = with_logs("SELECT service, level, count(*) AS log_count FROM logs GROUP BY ALL")
ORACLE["archive_logs"] = with_logs("SELECT CAST(event_ts AS DATE) AS date, request_id, service, level, response_time_ms FROM logs")
ORACLE["stream_logs_total"] = with_logs("SELECT service, level, count(*) AS logs_total FROM logs GROUP BY ALL")
ORACLE["stream_window_1m"] = with_logs(
    f"""SELECT * FROM (SELECT {_window('1 minute')}, service, level, {MEASURES} FROM logs GROUP BY ALL) w
WHERE window_end <= (SELECT max(event_ts) FROM logs) - INTERVAL '1 minute'""")
ORACLE["scan_archive"] = with_logs(
    "SELECT event_id, CAST(event_ts AS DATE) AS date, service, level, http_status, response_time_ms FROM logs "
    "WHERE CAST(event_ts AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-21'")
ORACLE["retention_split"] = with_logs(
    """SELECT CAST(event_ts AS DATE) AS date,
  CASE WHEN event_ts >= (SELECT max(event_ts) FROM logs) - INTERVAL '7 days' THEN 'topic'
       WHEN event_ts >= (SELECT max(event_ts) FROM logs) - INTERVAL '30 days' THEN 'hot'
       ELSE 'archive' END AS tier,
  count(*) AS rows
FROM logs GROUP BY ALL""")
ORACLE["retention_tables"] = with_logs(
    """SELECT CASE WHEN event_ts >= newest - INTERVAL '7 days' THEN 'hot' ELSE 'archive' END AS tab, event_id, event_ts
FROM logs, (SELECT max(event_ts) AS newest FROM logs) m WHERE event_ts >= newest - INTERVAL '20 days'""")
_LEDGER = f"""{_SLICE},
arrived AS (SELECT *, CASE WHEN event_id % 50 = 7 THEN least(slice + 1, 2) ELSE slice END AS part, event_id % 89 = 0 AS bad,
  time_bucket(INTERVAL '1 minute', event_ts) + INTERVAL '1 minute' AS w_end FROM sliced),
marks AS (SELECT k, (SELECT max(event_ts) FROM arrived WHERE NOT bad AND part < k) - INTERVAL '1 minute' AS mark FROM range(4) t(k)),
judged AS (SELECT a.*, CASE WHEN bad THEN 'unreadable' WHEN w_end <= m.mark THEN 'late' WHEN w_end <= e.mark THEN 'emitted' ELSE 'open' END AS fate
  FROM arrived a JOIN marks m ON m.k = a.part JOIN marks e ON e.k = 3)"""
ORACLE["ledger_balance"] = with_logs("SELECT fate, service, count(*) AS rows FROM judged GROUP BY ALL", _LEDGER)
ORACLE["ledger_windows"] = with_logs(
    f"""SELECT w_end - INTERVAL '1 minute' AS window_start, w_end AS window_end, service, level, {MEASURES}
FROM judged WHERE fate = 'emitted' GROUP BY ALL""", _LEDGER)
_PANEL = "ts >= (SELECT max(ts) FROM counts) - INTERVAL '15 minutes'"
ORACLE["panel_counter"] = with_logs(f"SELECT service, level, ts, value FROM samples WHERE {_PANEL}", COUNTS, GRID, SAMPLES)
ORACLE["panel_rate_by_service"] = with_logs(
    f"SELECT ts, service, {sig('sum(rate)')} AS value FROM rates WHERE {_PANEL} GROUP BY ALL", COUNTS, GRID, SAMPLES, LONG_RATES)
ORACLE["panel_error_rate"] = ORACLE["error_rate_5m"].replace("FROM rates GROUP BY ts", f"FROM rates WHERE {_PANEL} GROUP BY ts")
ORACLE["offset_ledger"] = with_logs(
    """SELECT partition, 'lost' AS fault, prev + 1 AS first_offset, "offset" - 1 AS last_offset
FROM (SELECT *, lag("offset") OVER (PARTITION BY partition ORDER BY "offset") AS prev FROM placed) p WHERE "offset" > prev + 1
UNION ALL
SELECT partition, 'repeated', min("offset"), max("offset")
FROM (SELECT *, "offset" - row_number() OVER (PARTITION BY partition ORDER BY "offset") AS island FROM placed WHERE again) r
GROUP BY partition, island""",
    """placed AS (SELECT CAST(CASE WHEN event_id % 5 < 3 THEN 0 ELSE event_id % 5 - 2 END AS INTEGER) AS partition,
  CASE WHEN event_id % 5 < 3 THEN event_id // 5 * 3 + event_id % 5 ELSE event_id // 5 END AS "offset", event_id % 101 < 3 AS again FROM logs WHERE event_id % 97 <> 5)""")
ORACLE["logs_total"] = with_logs("SELECT service, level, count(*) AS logs_total FROM logs GROUP BY ALL")
