"""The expected results as SQL over ``events``, from arithmetic on ``event_id`` instead of JSON."""

from __future__ import annotations

_TS = "strftime({0}, '%Y-%m-%d %H:%M:%S') AS {0}"

_SENT = """
sent AS (
  SELECT *, event_id * 2 AS arrival FROM events
  UNION ALL
  SELECT *, event_id * 2 + 1 AS arrival FROM events WHERE event_id % 10 = 3
)"""

_FIELDS = """
    ['mall_app', 'h5', 'mini_program'][1 + {key} % 3] AS app_id,
    CASE WHEN {key} % 17 <> 0 THEN 'DEV-' || (user_id % 50) END AS device_id,
    '/page/' || ({key} % 7) AS page,
    CAST(NULL AS VARCHAR) AS referrer,
    CASE WHEN {key} % 2 = 0 THEN 'P' || ({key} % 100) END AS product_id,
    CASE WHEN {key} % 11 <> 0 THEN CAST(round(value * 100) AS BIGINT) {absent} END AS duration_ms,
    CAST(NULL AS VARCHAR) AS ip, 'Android' AS os_type,
    CAST(NULL AS VARCHAR) AS os_version, CAST(NULL AS VARCHAR) AS net_type,
    '{{"k":' || regexp_extract(props, '([0-9]+)', 1) || '}}' AS ext_json"""

_LOG_FIELDS = _FIELDS.format(key="event_id", absent="ELSE 0")

_LOGS = (
    "WITH"
    + _SENT
    + """,
logs AS (
  SELECT arrival, event_id, ts AS arrived_at, event_id % 40 AS dirt,
    'U' || (100000 + user_id) AS user_id, event_type,
    date_trunc('second', ts) AS event_time,"""
    + _LOG_FIELDS
    + """
  FROM sent
),
tagged AS (
  SELECT *, CASE WHEN dirt < 10 THEN 'DIRTY' ELSE 'CLEAN' END AS verdict,
    CASE dirt WHEN 0 THEN 'PARSE_ERROR' WHEN 1 THEN 'PARSE_ERROR'
      WHEN 2 THEN 'MISSING_FIELDS' WHEN 3 THEN 'MISSING_FIELDS' WHEN 4 THEN 'MISSING_FIELDS'
      WHEN 5 THEN 'INVALID_EVENT_TIME' WHEN 6 THEN 'EVENT_TIME_TOO_OLD' WHEN 7 THEN 'EVENT_TIME_FUTURE'
      WHEN 8 THEN 'INVALID_APP_ID' WHEN 9 THEN 'INVALID_APP_ID' END AS reason,
    CASE dirt WHEN 0 THEN 'not a JSON object' WHEN 1 THEN 'empty json'
      WHEN 2 THEN 'user_id ' WHEN 3 THEN 'event_type ' WHEN 4 THEN 'event_time '
      WHEN 5 THEN strftime(event_time, '%Y-%m-%d %H:%M') WHEN 6 THEN '1999-01-01 00:00:00'
      WHEN 7 THEN '2099-11-11 00:00:00' WHEN 8 THEN 'pc_web' WHEN 9 THEN '' END AS detail,
    CASE WHEN dirt > 2 THEN user_id END AS known_user
  FROM logs
),
clean AS (SELECT * FROM tagged WHERE verdict = 'CLEAN')
"""
)

_EVENT = (
    "user_id, event_type, " + _TS.format("event_time") + ", app_id, device_id, page, referrer, product_id, "
    "duration_ms, ip, os_type, os_version, net_type"
)

_LATE = (
    "WITH"
    + _SENT
    + """,
clean AS (
  SELECT arrival, event_id, 'U' || (100000 + user_id) AS user_id, event_type,
    TIMESTAMP '2025-11-11 00:00:00' + to_seconds(event_id - CASE WHEN event_id % 5 = 0
      THEN [12, 25, 50, 200, 1200, 3600][1 + CAST(event_id // 5 AS BIGINT) % 6] ELSE 0 END) AS event_time,
    TIMESTAMP '2026-01-01 00:00:00' + to_seconds(event_id % 4000) AS etl_time,"""
    + _LOG_FIELDS
    + """
  FROM sent
),
marked AS (
  SELECT *, max(event_time) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    - INTERVAL 5 SECOND AS wm FROM clean
),
routed AS (
  SELECT *, CASE WHEN coalesce(event_time < wm, false) THEN 'LATE' ELSE 'ON_TIME' END AS route,
    CASE WHEN event_time < wm THEN epoch_ms(wm) - epoch_ms(event_time) END AS late_ms,
    CASE WHEN event_time < wm THEN wm END AS source_watermark FROM marked
),
late AS (SELECT * FROM routed WHERE route = 'LATE'),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type, device_id, event_time ORDER BY arrival) AS nth
  FROM routed WHERE route = 'ON_TIME'
),
main AS (SELECT * FROM numbered WHERE nth = 1)
"""
)

#: The same with the watermark of whole batches; {size} rows of ``events`` make a batch.
_BATCHED = _LATE.replace(
    """marked AS (
  SELECT *, max(event_time) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    - INTERVAL 5 SECOND AS wm FROM clean
)""",
    """batched AS (SELECT *, event_id // {size} AS batch FROM clean),
marks AS (
  SELECT batch, max(max(event_time)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    - INTERVAL 5 SECOND AS wm FROM batched GROUP BY batch
),
marked AS (SELECT batched.*, wm FROM batched JOIN marks USING (batch))""",
)
_BY_HUNDRED = _BATCHED.replace("{size}", "100")
_BY_QUARTER = _BATCHED.replace("{size}", "(SELECT (max(event_id) + 4) // 4 FROM events)")

_CDC = (
    """
WITH changes AS (
  SELECT event_id AS arrival, event_id // 3 AS r,
    CASE WHEN event_id % 3 = 0 THEN 'I' WHEN event_id % 3 = 2 AND (event_id // 3) % 5 = 0 THEN 'D' ELSE 'U' END AS op_type,
    TIMESTAMP '2025-11-11 00:00:00' + to_seconds(event_id) AS op_ts,
    TIMESTAMP '2025-11-11 00:00:00' + to_seconds(event_id // 3) AS event_time,
    user_id % 50 AS event_user, props, value
  FROM events
),
named AS (
  SELECT arrival, r, op_type, op_ts, event_time,
    'U' || (100000 + r % 1000) AS user_id, ['view', 'click', 'pay'][1 + r % 3] AS event_type,"""
    + _FIELDS.format(key="r", absent="").replace("'DEV-' || (user_id % 50)", "'DEV-' || (r % 50)")
    + """
  FROM changes
),
newest AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY arrival DESC) AS age FROM named),
state AS (SELECT * FROM newest WHERE age = 1 AND op_type <> 'D')
"""
)

_FILES = """
WITH files AS (
  SELECT CAST(ts AS DATE) AS dt, 'part-' || lpad(CAST(user_id % 50 AS VARCHAR), 2, '0') AS name,
    CAST(sum(event_id % 997 + 1) * 400 AS BIGINT) AS file_size_in_bytes
  FROM events GROUP BY ALL
),
listed AS (
  SELECT dt, 'dt=' || dt || '/' || name AS file_path, file_size_in_bytes, 'c' || (CAST(right(name, 2) AS INT) % 7) AS commit_id
  FROM files
)
"""

_SNAPSHOTS = """
WITH snapshots AS (
  SELECT CAST(min(event_id) AS BIGINT) AS snapshot_id, date_trunc('hour', ts) AS committed_at,
    CASE WHEN min(event_id) % 4 = 0 THEN 'overwrite' ELSE 'append' END AS operation, count(*) AS added
  FROM events GROUP BY date_trunc('hour', ts)
)
"""

_MOVES = """
SELECT CASE WHEN event_id % 8 = 0 THEN 'N' ELSE 'M' END || event_id AS user_id,
  strftime(TIMESTAMP '2025-11-11 00:00:00' + to_seconds(event_id), '%Y-%m-%d %H:%M:%S') AS event_time,
  CASE WHEN event_id % 8 = 4 THEN '/same' ELSE '/page/' || (event_id % 7) END AS page
FROM events
"""
_MOVES_DIRTY = """
SELECT reason, count(*) AS dirty_cnt FROM (
  SELECT CASE event_id % 8 WHEN 1 THEN 'NO_DATA_FIELD' WHEN 2 THEN 'PARSE_ERROR' WHEN 3 THEN 'INVALID_APP_ID'
    WHEN 5 THEN 'UNKNOWN_OP' WHEN 6 THEN 'PARSE_ERROR' END AS reason FROM events
) WHERE reason IS NOT NULL GROUP BY reason
"""

_CDC_ROW = _EVENT + ", ext_json, op_type, " + _TS.format("op_ts")
_ENDED = "TIMESTAMP '2026-01-01 01:06:40'"

#: Quarters of the log, every seventh event one later; the watermark is that of the quarters before.
_ROUNDS = """
, rounds AS (SELECT *, least(3, (arrival // 2) // (SELECT (max(event_id) + 4) // 4 FROM events) + CASE WHEN (arrival // 2) % 7 = 0 THEN 1 ELSE 0 END) AS r
  FROM clean),
marks AS (SELECT r, max(max(event_time)) OVER (ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 5 SECOND AS wm
  FROM rounds GROUP BY r),
judged AS (SELECT rounds.*, CASE WHEN coalesce(event_time < wm, false) THEN 'LATE' ELSE 'ON_TIME' END AS route FROM rounds JOIN marks USING (r)),
counted AS (SELECT *, row_number() OVER (PARTITION BY route, user_id, event_type, device_id, event_time ORDER BY r, arrival) AS nth FROM judged)
"""

_LATE_RATE = """
SELECT (SELECT count(*) FROM main) AS main_cnt, (SELECT count(*) FROM late) AS late_cnt,
  ROUND(CAST((SELECT count(*) FROM late) AS DOUBLE) * 100.0 / NULLIF((SELECT count(*) FROM main), 0), 2) AS late_pct"""

_HOURLY = """
SELECT strftime(event_time, '%Y-%m-%d %H') AS hour_slot, event_type, count(*) AS event_cnt FROM {0} GROUP BY ALL"""

_BACKFILLED = """
, everything AS (
  SELECT *, 0 AS origin FROM (SELECT * EXCLUDE (nth) FROM main) UNION ALL SELECT *, 1 FROM late
),
backfilled AS (
  SELECT DISTINCT user_id, event_type, device_id, event_time FROM everything
)"""


def _rule(reason: str) -> str:
    return _LOGS + f"SELECT arrival, detail FROM tagged WHERE reason = '{reason}'"


def oracle_sql() -> dict[str, str]:
    return {
        # sources
        "read_raw_logs": _LOGS + "SELECT verdict, count(*) AS cnt FROM tagged GROUP BY ALL",
        "read_cdc_envelopes": _CDC + "SELECT op_type, count(*) AS cnt FROM named GROUP BY ALL",
        "read_ods_table": _LOGS + "SELECT event_type, count(*) AS cnt FROM clean GROUP BY ALL",
        "lake_files": _LOGS + "SELECT CAST(CAST(event_time AS DATE) AS VARCHAR) AS dt FROM clean GROUP BY ALL",
        "lake_snapshots": "SELECT 'append' AS operation, (SELECT CAST(count(*) AS VARCHAR) FROM (" + _CDC
        + "SELECT * FROM named WHERE op_type = 'I')) AS added_records UNION ALL SELECT 'append', (SELECT CAST(count(*) AS VARCHAR) FROM ("
        + _CDC + "SELECT * FROM named WHERE op_type <> 'I' AND arrival % 3 = 1)) UNION ALL SELECT 'append', (SELECT CAST(count(*) AS VARCHAR) FROM ("
        + _CDC + "SELECT * FROM named WHERE arrival % 3 = 2))",
        # cleaning
        "clean_events": _LOGS + f"SELECT arrival, verdict, reason, detail, {_EVENT}, ext_json FROM clean UNION ALL "
        "SELECT arrival, verdict, reason, detail, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL "
        "FROM tagged WHERE verdict = 'DIRTY'",
        "rule_parse_error": _rule("PARSE_ERROR"),
        "rule_missing_fields": _rule("MISSING_FIELDS"),
        "rule_invalid_event_time": _rule("INVALID_EVENT_TIME"),
        "rule_event_time_too_old": _rule("EVENT_TIME_TOO_OLD"),
        "rule_event_time_future": _rule("EVENT_TIME_FUTURE"),
        "rule_invalid_app_id": _rule("INVALID_APP_ID"),
        "project_known_fields": _LOGS + f"SELECT arrival, {_EVENT} FROM clean",
        "duration_default": _LOGS + "SELECT arrival, 'log' AS mode, duration_ms FROM clean UNION ALL "
        "SELECT arrival, 'cdc', CASE WHEN event_id % 11 <> 0 THEN duration_ms END FROM clean",
        "collect_ext_json": _LOGS + "SELECT arrival, ext_json FROM clean",
        "dirty_records": _LOGS + "SELECT arrival, known_user AS user_id, reason, detail FROM tagged WHERE verdict = 'DIRTY'",
        "clean_events_lenient": _LOGS
        + "SELECT arrival, user_id, CASE WHEN dirt = 3 THEN '' ELSE event_type END AS event_type, "
        "CASE dirt WHEN 6 THEN '1999-01-01 00:00:00' WHEN 7 THEN '2099-11-11 00:00:00' "
        "ELSE strftime(event_time, '%Y-%m-%d %H:%M:%S') END AS event_time, "
        "CASE dirt WHEN 8 THEN 'pc_web' WHEN 9 THEN '' ELSE app_id END AS app_id, device_id, page, product_id, duration_ms, ext_json_lenient AS ext_json "
        "FROM (SELECT *, CAST(NULL AS VARCHAR) AS ext_json_lenient FROM tagged) WHERE dirt NOT IN (0, 1, 2, 4, 5)",
        "user_trajectory": _LOGS + "SELECT " + _TS.format("event_time")
        + ", event_type, page, product_id, duration_ms, arrival FROM clean WHERE user_id = 'U100001'",
        # change data
        "write_clustered": _LOGS + "SELECT " + _TS.format("event_time")
        + ", event_type, page, product_id, duration_ms, arrival FROM clean WHERE user_id = 'U100001'",
        # change data
        "cdc_parse_clean": _CDC + f"SELECT arrival, {_CDC_ROW} FROM named",
        "cdc_op_type": _CDC + "SELECT arrival, op_type FROM named",
        "cdc_row_image": _CDC + "SELECT arrival, user_id, page FROM named",
        "cdc_op_ts": _CDC + "SELECT arrival, " + _TS.format("op_ts") + " FROM named",
        "cdc_latest_state": _CDC + f"SELECT arrival, {_CDC_ROW} FROM state",
        "cdc_first_seen": _CDC + f"SELECT arrival, {_CDC_ROW} FROM named QUALIFY row_number() OVER (PARTITION BY r ORDER BY arrival) = 1",
        "to_lake_row": _CDC + f"SELECT {_CDC_ROW}, '2026-01-01 00:00:00' AS etl_time, CAST(CAST(event_time AS DATE) AS VARCHAR) AS dt FROM state",
        "upsert_lake": _CDC + f"SELECT {_CDC_ROW}, CAST(CAST(event_time AS DATE) AS VARCHAR) AS dt FROM state",
        "append_changes": _CDC + f"SELECT {_CDC_ROW}, CAST(CAST(event_time AS DATE) AS VARCHAR) AS dt FROM state",
        "compact_partitions": _CDC + f"SELECT {_CDC_ROW}, CAST(CAST(event_time AS DATE) AS VARCHAR) AS dt FROM state",
        "exactly_once_commit": _CDC
        + ", kept AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY arrival DESC) AS nth FROM named WHERE arrival % 3 <> 1) "
        + f"SELECT {_CDC_ROW}, CAST(CAST(event_time AS DATE) AS VARCHAR) AS dt FROM kept WHERE nth = 1 AND op_type <> 'D'",
        "cdc_key_moves": _MOVES,
        "cdc_first_seen_ttl": """
SELECT event_id AS arrival, CASE event_id % 3 WHEN 0 THEN 'I' ELSE CASE WHEN (event_id // 3) % 5 = 0 THEN 'D' ELSE 'U' END END AS op_type,
  'U' || ((event_id // 3) % 1000 + 100000) AS user_id
FROM events WHERE event_id % 3 != 1""",
        "cdc_dirty_by_reason": _MOVES_DIRTY,
        "stream_cdc_to_lake": _CDC + f"SELECT {_CDC_ROW}, CAST(CAST(event_time AS DATE) AS VARCHAR) AS dt FROM state",
        # event time, late rows, repeats
        "assign_event_time": _LATE + "SELECT arrival, epoch_ms(event_time) AS event_ts FROM clean",
        "bounded_watermark": _LATE + "SELECT arrival, strftime(wm, '%Y-%m-%d %H:%M:%S') AS watermark FROM marked",
        "route_late": _LATE + "SELECT arrival, route FROM routed",
        "route_late_batches": _BY_HUNDRED + "SELECT arrival, route, late_ms FROM routed",
        "late_diagnostics": _LATE + "SELECT arrival, late_ms, " + _TS.format("source_watermark") + " FROM routed",
        "late_counter": _LATE + "SELECT user_id, event_type, device_id, " + _TS.format("event_time")
        + ", count(*) AS late_cnt FROM late GROUP BY user_id, event_type, device_id, routed_time".replace("routed_time", "late.event_time"),
        "dedup_first_seen": _LATE + f"SELECT arrival, {_EVENT}, ext_json FROM main",
        "dedup_ttl": """
WITH RECURSIVE r AS (
  SELECT event_id, date_trunc('millisecond', ts) AS seen, CASE WHEN event_id % 3 = 0 THEN 'HOT' ELSE 'U' || (user_id % 20) END AS user_id,
    CASE WHEN event_id % 3 = 0 THEN 'view' ELSE event_type END AS event_type,
    CASE WHEN event_id % 3 != 0 AND event_id % 17 != 0 THEN 'DEV-' || (event_id % 2) END AS device_id,
    CASE WHEN event_id % 3 = 0 THEN TIMESTAMP '2025-11-11' ELSE date_trunc('day', ts) END AS event_time FROM events
),
e AS (SELECT dense_rank() OVER (ORDER BY user_id, event_type, device_id, event_time) AS k, seen, min(event_id) AS event_id,
    user_id, event_type, device_id FROM r GROUP BY user_id, event_type, device_id, event_time, seen),
nxt AS (
  SELECT *, min(seen) OVER (PARTITION BY k ORDER BY seen RANGE BETWEEN INTERVAL 1 HOUR FOLLOWING AND UNBOUNDED FOLLOWING) AS next_seen FROM e
),
chain AS (
  SELECT k, min(seen) AS seen FROM e GROUP BY k
  UNION ALL
  SELECT nxt.k, nxt.next_seen FROM chain JOIN nxt USING (k, seen) WHERE nxt.next_seen IS NOT NULL
)
SELECT e.event_id, e.user_id, e.event_type, e.device_id FROM chain JOIN e USING (k, seen)""",
        "stream_late_dedup": _BY_QUARTER + f"SELECT {_EVENT}, ext_json FROM main",
        "stream_late": _BY_QUARTER + f"SELECT {_EVENT}, ext_json, late_ms, " + _TS.format("source_watermark") + " FROM late",
        # sinks
        "write_main": _LOGS + f"SELECT {_EVENT}, ext_json, '2026-01-01 00:00:00' AS etl_time FROM clean",
        "write_late": _LATE + f"SELECT {_EVENT}, ext_json, late_ms, " + _TS.format("source_watermark")
        + ", '2026-01-01 00:00:00' AS etl_time FROM late",
        "write_dirty": _LOGS + "SELECT arrival, reason, detail FROM tagged WHERE verdict = 'DIRTY'",
        "write_lake": _LOGS + f"SELECT {_EVENT}, ext_json, CAST(CAST(event_time AS DATE) AS VARCHAR) AS dt FROM clean "
        "QUALIFY row_number() OVER (PARTITION BY user_id, event_type, device_id, event_time ORDER BY arrival) = 1",
        "filter_partition": _LOGS + f"SELECT arrival, {_EVENT} FROM clean WHERE CAST(event_time AS DATE) = DATE '2024-01-15'",
        # reports
        "hourly_event_count": _LOGS + _HOURLY.format("clean"),
        "hourly_event_count_from": _LOGS
        + _HOURLY.format("(SELECT * FROM clean WHERE event_time >= TIMESTAMP '2024-01-10 00:00:00')"),
        "hourly_event_count_until": _LOGS
        + _HOURLY.format("(SELECT * FROM clean WHERE event_time < TIMESTAMP '2024-01-20 00:00:00')"),
        "hourly_event_count_range": _LOGS
        + _HOURLY.format("clean WHERE event_time >= TIMESTAMP '2024-01-10' AND event_time < TIMESTAMP '2024-01-20'"),
        "cleaned_count": _LOGS + "SELECT count(*) AS ods_cleaned_cnt FROM clean",
        "dirty_rate": _LOGS + """
SELECT count(*) AS raw_cnt, count(*) FILTER (verdict = 'CLEAN') AS cleaned_cnt, count(*) FILTER (verdict = 'DIRTY') AS dirty_cnt,
  ROUND(CAST(count(*) FILTER (verdict = 'DIRTY') AS DOUBLE) * 100.0 / count(*), 2) AS dirty_pct FROM tagged""",
        "dirty_by_reason": _LOGS + "SELECT reason, count(*) AS dirty_cnt FROM tagged WHERE verdict = 'DIRTY' GROUP BY reason",
        "late_rate": _LATE + _LATE_RATE,
        "late_histogram": _LATE + f"""
SELECT CASE WHEN late_ms < 10000 THEN '< 10s' WHEN late_ms < 30000 THEN '10s ~ 30s' WHEN late_ms < 60000 THEN '30s ~ 1min'
    WHEN late_ms < 300000 THEN '1min ~ 5min' WHEN late_ms < 1800000 THEN '5min ~ 30min' ELSE '> 30min' END AS late_bucket,
  count(*) AS cnt, ROUND(avg(late_ms) / 1000, 2) AS avg_late_s
FROM late WHERE etl_time >= {_ENDED} - INTERVAL 1 HOUR GROUP BY ALL""",
        "late_rate_alert": _LATE + """
, m AS (SELECT time_bucket(INTERVAL 5 MINUTE, event_time) AS b, count(*) AS n FROM main GROUP BY ALL),
l AS (SELECT time_bucket(INTERVAL 5 MINUTE, event_time) AS b, count(*) AS n FROM late GROUP BY ALL),
rates AS (SELECT b, coalesce(m.n, 0) AS main_cnt, coalesce(l.n, 0) AS late_cnt,
  ROUND(CAST(coalesce(l.n, 0) AS DOUBLE) * 100.0 / NULLIF(coalesce(m.n, 0), 0), 2) AS late_pct FROM m FULL JOIN l USING (b)),
recent AS (SELECT *, count(*) OVER w AS k, min(coalesce(late_pct, 100.0)) OVER w AS lowest FROM rates
  WINDOW w AS (ORDER BY b RANGE BETWEEN INTERVAL 10 MINUTE PRECEDING AND CURRENT ROW))
SELECT strftime(b, '%Y-%m-%d %H:%M:%S') AS bucket_start, main_cnt, late_cnt, late_pct,
  CASE WHEN k = 3 AND lowest > 5 THEN 'INVESTIGATE' WHEN late_pct > 2 THEN 'WIDEN_WATERMARK' ELSE 'OK' END AS advice FROM recent""",
        "late_backfill": _LATE + _BACKFILLED + _HOURLY.format("backfilled"),
        "late_dirty_cross": _LATE + """
, lc AS (SELECT user_id, count(*) AS n FROM late GROUP BY user_id),
dc AS (SELECT 'U' || (100000 + user_id) AS user_id, count(*) AS n FROM sent WHERE event_id % 40 BETWEEN 3 AND 9 GROUP BY ALL)
SELECT user_id, coalesce(lc.n, 0) AS late_cnt, coalesce(dc.n, 0) AS dirty_cnt FROM lc FULL JOIN dc USING (user_id)""",
        "quality_monitor": _LOGS + """
, timed AS (SELECT *, max(event_time) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    - INTERVAL 5 SECOND AS wm FROM clean),
judged AS (SELECT *, CASE WHEN coalesce(event_time < wm, false) THEN 'LATE' ELSE 'ON_TIME' END AS route FROM timed),
counted AS (SELECT *, row_number() OVER (PARTITION BY route, user_id, event_type, device_id, event_time ORDER BY arrival) AS nth FROM judged),
every_row AS (
  SELECT arrived_at, 'DIRTY' AS status, reason FROM tagged WHERE verdict = 'DIRTY' UNION ALL
  SELECT arrived_at, CASE WHEN route = 'LATE' THEN 'LATE' WHEN nth = 1 THEN 'CLEAN' ELSE 'DUPLICATE' END, NULL FROM counted)
SELECT strftime(date_trunc('minute', arrived_at), '%Y-%m-%d %H:%M:%S') AS bucket_start, status, reason, count(*) AS cnt
FROM every_row GROUP BY ALL""",
        "quality_monitor_live": _LOGS + _ROUNDS + """,
every_row AS (
  SELECT arrived_at, 'DIRTY' AS status, reason FROM tagged WHERE verdict = 'DIRTY' UNION ALL
  SELECT arrived_at, CASE WHEN route = 'LATE' THEN 'LATE' WHEN nth = 1 THEN 'CLEAN' ELSE 'DUPLICATE' END, NULL FROM counted)
SELECT strftime(date_trunc('minute', arrived_at), '%Y-%m-%d %H:%M:%S') AS bucket_start, status, reason, count(*) AS cnt
FROM every_row GROUP BY ALL""",
        "late_counter_live": _LOGS + _ROUNDS + "SELECT user_id, event_type, device_id, " + _TS.format("event_time")
        + ", count(*) AS late_cnt FROM counted WHERE route = 'LATE' GROUP BY user_id, event_type, device_id, counted.event_time",
        "ahead_of_clock": _LATE + """
SELECT strftime(date_trunc('minute', clock), '%Y-%m-%d %H:%M:%S') AS bucket_start, count(*) AS ahead_cnt,
  max(epoch_ms(event_time) - epoch_ms(clock)) AS max_ahead_ms
FROM (SELECT *, TIMESTAMP '2025-11-11 00:00:00' + to_seconds(event_id - 7 + event_id % 10) AS clock FROM clean)
WHERE event_time > clock GROUP BY ALL""",
        # upkeep
        "compact_files": """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS dt, 7 AS files_before, 2 AS files_after, 1 AS untouched, 2 * count(*) AS rows, CAST(2 * sum(event_id) AS BIGINT) AS ids
FROM events GROUP BY 1""",
        "remove_orphans": _LOGS + """
, first AS (SELECT CAST(CAST(event_time AS DATE) AS VARCHAR) AS dt FROM clean
  QUALIFY row_number() OVER (PARTITION BY user_id, event_type, device_id, event_time ORDER BY arrival) = 1)
SELECT dt, 1 AS removed, 0 AS left_over, count(*) AS rows FROM first GROUP BY dt""",
        "expire_written_snapshots": """
SELECT 'append' AS operation, CAST(count(DISTINCT event_id // 3) AS VARCHAR) AS added_records FROM events WHERE event_id % 7 < 2 GROUP BY event_id % 7""",
        "lake_files_recorded": _LOGS + "SELECT CAST(CAST(event_time AS DATE) AS VARCHAR) AS dt, 0 AS files, 0 AS bytes FROM clean GROUP BY 1",
        "files_per_partition": _FILES + """
SELECT CAST(dt AS VARCHAR) AS dt, count(*) AS total_files, ROUND(sum(file_size_in_bytes) / 1024.0 / 1024 / 1024, 6) AS total_gb,
  ROUND(min(file_size_in_bytes) / 1024.0 / 1024, 4) AS min_mb, ROUND(max(file_size_in_bytes) / 1024.0 / 1024, 4) AS max_mb,
  ROUND(avg(file_size_in_bytes) / 1024.0 / 1024, 4) AS avg_mb FROM files GROUP BY files.dt ORDER BY files.dt DESC LIMIT 30""",
        "partition_distribution": _LOGS + """
SELECT CAST(CAST(event_time AS DATE) AS VARCHAR) AS dt, count(*) AS rows, count(DISTINCT user_id) AS users,
  count(DISTINCT device_id) AS devices FROM clean GROUP BY 1 ORDER BY 1 DESC LIMIT 30""",
        "partition_distribution_sketched": _LOGS + """
SELECT CAST(CAST(event_time AS DATE) AS VARCHAR) AS dt, count(*) AS rows, count(DISTINCT user_id) AS users,
  count(DISTINCT device_id) AS devices FROM clean GROUP BY 1 ORDER BY 1 DESC LIMIT 30""",
        "plan_compaction": _FILES + """
, packed AS (SELECT *, CAST((sum(file_size_in_bytes) OVER (PARTITION BY dt ORDER BY file_path) - 1) // 134217728 AS BIGINT) AS bin_id
  FROM listed WHERE file_size_in_bytes < 134217728)
SELECT CAST(dt AS VARCHAR) AS dt, bin_id, count(*) AS input_files, CAST(sum(file_size_in_bytes) AS BIGINT) AS input_bytes
FROM packed GROUP BY ALL HAVING count(*) >= 5""",
        "expire_snapshots": _SNAPSHOTS + """
SELECT snapshot_id, operation FROM snapshots WHERE committed_at < TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 7 DAY
  AND snapshot_id NOT IN (SELECT snapshot_id FROM snapshots ORDER BY committed_at DESC LIMIT 5)""",
        "recent_snapshots": _SNAPSHOTS + "SELECT snapshot_id, " + _TS.format("committed_at")
        + ", operation, CAST(added AS VARCHAR) AS added_records FROM snapshots ORDER BY snapshots.committed_at DESC LIMIT 20",
        "find_orphan_files": _FILES + "SELECT CAST(dt AS VARCHAR) AS dt, file_path FROM listed WHERE commit_id = 'c3'",
        "compaction_report": _FILES + """
SELECT count(*) AS files_before, CAST(floor(sum(file_size_in_bytes) / 1048576.0) AS BIGINT) AS mb_before, count(DISTINCT dt) AS files_after,
  CAST(floor(sum(file_size_in_bytes) / 1048576.0) AS BIGINT) AS mb_after, ROUND((1 - count(DISTINCT dt) / CAST(count(*) AS DOUBLE)) * 100, 1) AS reduction_pct
FROM listed""",
    }
