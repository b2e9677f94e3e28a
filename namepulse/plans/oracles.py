"""The same answers in SQL over the given tables.

Nothing here packs or parses a line: the SQL works on the columns that the
feed was packed from, so the two sides share no step.
"""

from __future__ import annotations

_STOP = "('Type ParentCategory', 'CategoryType ParentCategory', 'Read Full', 'Read Full Blog')"
_FEED_STOP = _STOP[:-1] + ", 'small ring', 'hot gear')"

_FEED = """
WITH feed AS (
  SELECT strftime(l_shipdate, '%Y-%m-%d') AS day,
         strftime(l_shipdate, '%Y%m%d%H%M%S') AS stamp,
         strftime(l_shipdate, '%Y%m%d%H%M%S') || '-' || (l_orderkey * 8 + l_linenumber) AS id,
         l_linenumber AS n, l_returnflag, l_shipdate, p_name, p_brand, p_type
  FROM lineitem JOIN part ON l_partkey = p_partkey
), lines AS (
  SELECT *,
         CASE WHEN n = 5 THEN 24 WHEN n = 6 AND l_returnflag = 'R' THEN 23 ELSE 27 END AS fields,
         CASE WHEN n = 7 THEN stamp[:4] || '13' || stamp[7:] ELSE stamp END AS raw_date,
         CASE n WHEN 2 THEN p_name || ',1;' || p_brand || ',2;' || p_type || ',3;Read Full,9'
                WHEN 3 THEN p_name || ',1;' || p_brand || ',2;' || p_type || ',3;;'
                WHEN 4 THEN p_name || ',1;;' || p_brand || ',2'
                WHEN 5 THEN p_name || ',1'
                WHEN 6 THEN ''
                ELSE p_name || ',1;' || p_brand || ',2;' || p_type || ',3' END AS names
  FROM feed
), words AS (
  SELECT day AS date, id, n,
         unnest(CASE n WHEN 2 THEN [p_name, p_brand, p_type, 'Read Full']
                       WHEN 4 THEN [p_name, '', p_brand]
                       WHEN 5 THEN [p_name]
                       ELSE [p_name, p_brand, p_type] END) AS word
  FROM feed WHERE n NOT IN (6, 7)
), counts AS (
  SELECT date, word, count(*) AS total FROM words
  WHERE word NOT IN """ + _FEED_STOP + """ GROUP BY date, word
), ranked AS (
  SELECT date, word, total,
         row_number() OVER (PARTITION BY date ORDER BY total DESC, word) AS rn
  FROM counts
)
"""

_EVENTS = """
WITH e AS (
  SELECT event_id, ts, event_type AS name, CAST(user_id AS VARCHAR) AS user,
         time_bucket(INTERVAL 15 MINUTE, ts) AS quarter,
         strftime(ts, '%Y%m%d%H%M%S') || '-' || event_id AS key,
         epoch_us(date_trunc('hour', ts)) AS hour_us
  FROM events
), segments AS (
  SELECT *, strftime(quarter, '%Y%m%d%H%M%S') || '.gkg.csv' AS segment,
         row_number() OVER (PARTITION BY quarter ORDER BY event_id) - 1 AS position,
         count(*) OVER (PARTITION BY quarter) AS size
  FROM e
), hours AS (
  SELECT name, hour_us, count(*) AS n FROM e GROUP BY name, hour_us
), sliding AS (
  SELECT name, user, unnest(generate_series(quarter - INTERVAL 45 MINUTE, quarter,
                                            INTERVAL 15 MINUTE)) AS window_start
  FROM e
), closing AS (
  SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 HOUR AS watermark FROM e
), slices AS (
  SELECT 0 AS batch, TIMESTAMP '0001-01-01' AS low, TIMESTAMP '2024-01-11' AS high
  UNION ALL SELECT 1, TIMESTAMP '2024-01-11', TIMESTAMP '2024-01-21'
  UNION ALL SELECT 2, TIMESTAMP '2024-01-21', TIMESTAMP '9999-01-01'
), totals AS (
  SELECT batch, user AS name, count(*) AS count, max(ts) >= any_value(low) AS changed
  FROM e JOIN slices ON ts < high GROUP BY batch, user
), tops AS (
  SELECT batch, name, count FROM totals
  QUALIFY row_number() OVER (PARTITION BY batch ORDER BY count DESC, name) <= 100
), deltas AS (
  SELECT coalesce(a.batch, b.batch + 1) AS batch, coalesce(a.name, b.name) AS name,
         coalesce(a.count, 0) AS count
  FROM tops a FULL JOIN tops b ON a.name = b.name AND a.batch = b.batch + 1
  WHERE a.count IS DISTINCT FROM b.count AND coalesce(a.batch, b.batch + 1) <= 2
)
"""

_CLOCK = "'%Y-%m-%d %H:%M:%S'"


def _feed(select: str) -> str:
    return _FEED + select


def _events(select: str) -> str:
    return _EVENTS + select


_TOPK_FLAT = _feed(
    "SELECT date, rn - 1 AS pos, word, total FROM ranked WHERE rn <= 10"
)
_TOPK_NESTED = _feed(
    "SELECT date AS data, rn - 1 AS pos, word AS topic, total AS count FROM ranked WHERE rn <= 10"
)
_DAILY_TOPK = _feed("SELECT date, rn, word, total FROM ranked WHERE rn <= 10")


def _sweep(bucket: str) -> str:
    """Rows of this sweep interval so far, and all of the one before."""
    return f"""
WITH s AS (SELECT event_id, ts, event_type AS name, {bucket} AS bucket FROM events)
SELECT event_id, name,
       count(*) OVER (PARTITION BY name ORDER BY bucket
                      RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND INTERVAL 1 HOUR PRECEDING)
       + count(*) OVER (PARTITION BY name, bucket ORDER BY ts, event_id
                        ROWS UNBOUNDED PRECEDING) AS last_hour
FROM s"""


def _last_hour(ts: str) -> str:
    return f"""
WITH s AS (SELECT event_type AS name, {ts} AS moment FROM events)
SELECT DISTINCT name, epoch_us(moment) AS ts_us,
       count(*) OVER (PARTITION BY name, moment) AS n,
       count(*) OVER (PARTITION BY name ORDER BY moment
                      RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW) AS last_hour
FROM s"""


_RUNNING = """
SELECT event_id, event_type AS name,
       count(*) OVER (PARTITION BY event_type ORDER BY ts, event_id
                      ROWS UNBOUNDED PRECEDING) AS running_count
FROM events"""

_SWEEP_UPDATES = """
SELECT a.name, a.hour_us + 7200000000 AS sweep_us, coalesce(b.n, 0) AS remaining
FROM hours a LEFT JOIN hours b ON a.name = b.name AND b.hour_us = a.hour_us + 3600000000"""

_BY_INTERVAL = _events("""
SELECT a.name, a.hour_us, a.n + coalesce(b.n, 0) AS last_hour
FROM hours a LEFT JOIN hours b ON a.name = b.name AND b.hour_us = a.hour_us - 3600000000""")

_WINDOW_TOPK = _events(f"""
, windows AS (
  SELECT window_start + INTERVAL 1 HOUR AS window_end, user AS name, count(*) AS n
  FROM sliding GROUP BY ALL)
SELECT strftime(window_end, {_CLOCK}) AS window_end,
       row_number() OVER (PARTITION BY window_end ORDER BY n DESC, name) AS rn, name, n
FROM windows WHERE window_end <= (SELECT watermark FROM closing)
QUALIFY rn <= 10""")

_SEND_SECOND = """CASE WHEN position < (900 - size % 900) * (size // 900)
            THEN position // greatest(size // 900, 1)
            ELSE 900 - size % 900
                 + (position - (900 - size % 900) * (size // 900)) // (size // 900 + 1)
       END"""

_TOP_100 = "SELECT name, count FROM tops WHERE batch = 2"

_SQL = {
    # Scans
    "scan_records": _feed("""
SELECT CASE WHEN n = 7 THEN 'no date' ELSE day END AS date, count(*) AS records,
       count(*) FILTER (WHERE n <> 6) AS with_names
FROM lines GROUP BY 1"""),
    "scan_lines": _feed("""
SELECT stamp[:8] AS day, count(*) AS lines, CAST(sum(fields) AS BIGINT) AS fields
FROM lines GROUP BY 1"""),
    "scan_multi_path": _feed("SELECT stamp[:6] AS month, count(*) AS records FROM lines GROUP BY 1"),
    "scan_index": _feed("""
SELECT stamp[:6] AS month, count(*) AS records FROM lines
WHERE stamp[:6] BETWEEN '199901' AND '199909' GROUP BY 1"""),
    "clean_utf8": "SELECT doc_id, md5(text) AS digest, length(text) AS chars FROM documents",
    # Fields and filters
    "split_fields": _feed("""
SELECT id, CAST(fields AS BIGINT) AS fields, raw_date,
       CASE WHEN fields > 23 THEN names ELSE 'none' END AS names
FROM lines"""),
    "filter_field_count": _feed("SELECT id, names FROM lines WHERE fields > 23"),
    "filter_names_present": _feed("SELECT id, names FROM lines WHERE n <> 6"),
    "parse_date": _feed("""
SELECT id, CASE WHEN n = 7 THEN 'not a date' ELSE day END AS day FROM lines WHERE fields > 23"""),
    "rejected_lines": _feed("""
SELECT id, CASE WHEN fields < 24 THEN 'short_line' WHEN n = 6 THEN 'no_names'
                ELSE 'bad_date' END AS reason
FROM lines WHERE n IN (6, 7)"""),
    "parse_record_id": """
SELECT event_id,
       CASE WHEN event_type IN ('error', 'signup') THEN 0
            ELSE CAST(strftime(ts, '%Y%m%d%H%M%S') AS BIGINT) END AS stamp,
       CASE WHEN event_type IN ('error', 'signup') THEN 0 ELSE event_id END AS number
FROM events""",
    "pseudo_key": """
SELECT event_id, event_type || ';' || (epoch_us(ts) // 1000) AS key_text, event_type AS name,
       epoch_us(ts) // 1000 AS ts_ms
FROM events""",
    "project_ops": _feed("""
SELECT day, word, "offset", count(*) AS total FROM (
  SELECT day, unnest(CASE n WHEN 2 THEN [(p_name, '1'), (p_brand, '2'), (p_type, '3'),
                                         ('Read Full', '9')]
                            WHEN 4 THEN [(p_name, '1'), ('', ''), (p_brand, '2')]
                            WHEN 5 THEN [(p_name, '1')]
                            ELSE [(p_name, '1'), (p_brand, '2'), (p_type, '3')] END) AS entry,
         entry[1] AS word, entry[2] AS "offset"
  FROM feed WHERE n NOT IN (6, 7))
GROUP BY ALL"""),
    # Names and daily histograms
    "explode_names": _feed("SELECT id, word FROM words"),
    "explode_names_keep_empty": _feed("""
SELECT date, word, count(*) AS total FROM (
  SELECT date, word FROM words
  UNION ALL SELECT day, unnest(['', '']) FROM feed WHERE n = 3)
GROUP BY ALL"""),
    "filter_stoplist": _feed("SELECT word, CAST(sum(total) AS BIGINT) AS total FROM counts GROUP BY word"),
    "filter_stoplist_table": _feed("""
SELECT word, count(*) AS total FROM words
WHERE word NOT IN (SELECT p_name FROM part WHERE p_size < 10) GROUP BY word"""),
    "daily_counts": _feed("SELECT date, word, total FROM counts"),
    "daily_histogram_map": _feed("SELECT date, word, total FROM counts"),
    "daily_topk": _DAILY_TOPK,
    "daily_topk_of_records": _DAILY_TOPK,
    "daily_topk_in_rounds": _DAILY_TOPK,
    "daily_topk_array": _TOPK_FLAT,
    "daily_topk_padded": _feed("""
SELECT d.date, pos, coalesce(word, '(none)') AS word, coalesce(total, -1) AS total
FROM (SELECT DISTINCT date FROM counts) d
JOIN generate_series(0, 19) g(pos) ON true
LEFT JOIN ranked r ON r.date = d.date AND r.rn = pos + 1 AND r.rn <= 10"""),
    "daily_topk_nested": _TOPK_NESTED,
    "daily_topk_json": _TOPK_NESTED,
    "daily_topk_by_day": _events("""
SELECT data, rn - 1 AS pos, topic, count FROM (
  SELECT *, row_number() OVER (PARTITION BY data ORDER BY count DESC, topic) AS rn FROM (
    SELECT strftime(ts, '%Y-%m-%d') AS data, topic, count(*) AS count
    FROM (SELECT ts, unnest([user, name]) AS topic FROM e) GROUP BY ALL))
WHERE rn <= 10"""),
    "global_topk": _feed("SELECT date, word, total FROM counts ORDER BY total DESC, date, word LIMIT 10"),
    # The segment grid and the replay
    "segment_list": _events("""
SELECT event_id, strftime(start, '%Y%m%d%H%M%S') || '.gkg.csv' AS segment FROM (
  SELECT event_id, unnest(generate_series(quarter - INTERVAL 60 MINUTE,
                                          quarter - INTERVAL 15 MINUTE,
                                          INTERVAL 15 MINUTE)) AS start FROM e)"""),
    "segments_new": _events("""
, present AS (SELECT segment FROM segments WHERE name = 'click' AND ts < TIMESTAMP '2024-01-15'),
marked AS (
  SELECT DISTINCT segment, segment NOT IN (SELECT segment FROM present) AS to_fetch,
         segment > (SELECT max(segment) FROM segments WHERE ts < TIMESTAMP '2024-01-10') AS to_feed
  FROM segments)
SELECT * FROM marked WHERE to_fetch OR to_feed"""),
    "quarter_floor": _events(f"SELECT event_id, strftime(quarter, {_CLOCK}) AS quarter FROM e"),
    "quarter_next": _events(f"""
SELECT event_id, strftime(quarter + INTERVAL 15 MINUTE, {_CLOCK}) AS quarter FROM e"""),
    "segment_start": _events(f"""
SELECT event_id, strftime(date_trunc('minute', ts), {_CLOCK}) AS start FROM e"""),
    "spread_timestamps": _events("""
SELECT segment, key, position,
       epoch_ms(date_trunc('minute', first(ts) OVER (PARTITION BY quarter ORDER BY event_id)))
       + position * (900000 // size) AS event_ms
FROM segments"""),
    "replay_records": _events(f"""
SELECT key, CAST(27 AS BIGINT) AS fields,
       epoch_ms(date_trunc('minute', first(ts) OVER (PARTITION BY quarter ORDER BY event_id)))
       + position * (900000 // size) AS event_ms,
       {_SEND_SECOND} AS send_second
FROM segments"""),
    "stream_replay": _events(f"""
SELECT key,
       epoch_ms(date_trunc('minute', first(ts) OVER (PARTITION BY quarter ORDER BY event_id)))
       + position * (900000 // size) AS event_ms,
       CAST((epoch_us(quarter) // 1000000 - min(epoch_us(quarter) // 1000000) OVER () + {_SEND_SECOND}) // 864000 AS BIGINT) AS part
FROM segments"""),
    "replay_rate": _events(f"""
SELECT strftime(quarter, {_CLOCK}) AS quarter, queued, seconds, queued // seconds AS rate FROM (
  SELECT quarter, count(*) AS queued,
         greatest((epoch_us(quarter + INTERVAL 15 MINUTE) // 1000 - epoch_us(min(ts)) // 1000) // 1000, 1) AS seconds
  FROM e GROUP BY quarter)"""),
    "last_key": _events("SELECT name AS topic, arg_max(key, event_id) AS last_key FROM e GROUP BY name"),
    # Counts over time
    "count_by_name_ts": """
SELECT event_type AS name, epoch_us(date_trunc('minute', ts)) AS ts_us, count(*) AS n
FROM events GROUP BY ALL""",
    "running_count": _RUNNING,
    "running_count_of_large_names": _events("""
SELECT event_id, 'all' AS name, row_number() OVER (ORDER BY ts, event_id) AS running_count FROM e"""),
    "latest_per_name": _events("SELECT user AS name, count(*) AS count FROM e GROUP BY user"),
    "last_hour_exact": _last_hour("ts"),
    "last_hour_exact_of_large_names": _last_hour("date_trunc('minute', ts)"),
    "last_hour_sweep": _sweep("date_trunc('hour', ts)"),
    "last_hour_sweep_phase": _sweep(
        "date_trunc('hour', ts - INTERVAL 25 MINUTE) + INTERVAL 25 MINUTE"
    ),
    "last_hour_by_interval": _BY_INTERVAL,
    "sweep_updates": _events(_SWEEP_UPDATES),
    "expired_entries": """
SELECT event_type AS name, epoch_us(ts) AS ts_us, count(*) AS n FROM events
WHERE ts < TIMESTAMP '2024-01-14 23:00:00' GROUP BY ALL""",
    "tumbling_quarter": _events(f"""
SELECT strftime(quarter, {_CLOCK}) AS window_start, name, count(*) AS n FROM e
GROUP BY quarter, name"""),
    "sliding_hour": _events(f"""
SELECT strftime(window_start, {_CLOCK}) AS window_start,
       strftime(window_start + INTERVAL 1 HOUR, {_CLOCK}) AS window_end, name, count(*) AS n
FROM sliding GROUP BY ALL"""),
    # Top lists
    "topk_minimum": _events(f"""
SELECT first(name ORDER BY count, name) AS name, min(count) AS count, count(*) AS size
FROM ({_TOP_100})"""),
    "topk_delta_of_tables": _events("""
, old AS (SELECT user AS name, count(*) AS count FROM e WHERE ts < TIMESTAMP '2024-01-10'
          GROUP BY user ORDER BY count DESC, name LIMIT 100)
SELECT coalesce(new.name, old.name) AS name, coalesce(new.count, 0) AS count
FROM (SELECT * FROM tops WHERE batch = 2) new FULL JOIN old ON new.name = old.name
WHERE new.count IS DISTINCT FROM old.count"""),
    # Streams
    "stream_scan": _events("""
SELECT key[:8] AS day, CAST(batch AS BIGINT) AS batch, count(*) AS records,
       CAST(sum(epoch_us(ts) % 1000000) AS BIGINT) AS micros
FROM e JOIN slices ON ts >= low AND ts < high GROUP BY ALL"""),
    "stream_names": _events("""
SELECT key AS id, epoch_us(ts) AS ts_us, unnest([user, name]) AS name FROM e WHERE name <> 'error'
UNION ALL SELECT key, epoch_us(ts), user FROM e WHERE name = 'error'"""),
    "stream_count_update": _events("SELECT user AS name, count(*) AS count FROM e GROUP BY user"),
    "changelog_decode": _events("""
SELECT name, count, CAST(batch AS BIGINT) AS seq FROM totals WHERE changed"""),
    "changelog_from_latest": _events("""
SELECT name, count, CAST(batch AS BIGINT) AS seq FROM totals WHERE changed AND batch = 2"""),
    "topk_snapshot": _events(_TOP_100),
    "stream_top100": _events(_TOP_100),
    "topk_from_state": _events(_TOP_100),
    "stream_running_count": _RUNNING,
    "topk_delta": _events("SELECT CAST(batch AS BIGINT) AS batch, name, count FROM deltas"),
    "delta_json": _events("""
SELECT CAST(batch AS BIGINT) AS batch,
       '[' || string_agg('{"name":"' || name || '","count":' || count || '}', ',' ORDER BY name)
       || ']' AS message
FROM deltas GROUP BY batch"""),
    "stream_sliding_hour": _events(f"""
SELECT strftime(window_start, {_CLOCK}) AS window_start,
       strftime(window_start + INTERVAL 1 HOUR, {_CLOCK}) AS window_end, name, count(*) AS n
FROM sliding WHERE window_start + INTERVAL 1 HOUR <= (SELECT watermark FROM closing)
GROUP BY ALL"""),
    "stream_window_topk": _WINDOW_TOPK,
    "stream_window_topk_chained": _WINDOW_TOPK,
    "stream_last_hour_top": _events("""
, user_hours AS (SELECT user AS name, hour_us, count(*) AS n FROM e GROUP BY ALL
), states AS (
  SELECT a.name, a.hour_us AS at_us, 1 AS kind, a.n + coalesce(b.n, 0) AS count
  FROM user_hours a LEFT JOIN user_hours b ON a.name = b.name AND b.hour_us = a.hour_us - 3600000000
  UNION ALL
  SELECT a.name, a.hour_us + 7200000000, 0, coalesce(b.n, 0)
  FROM user_hours a LEFT JOIN user_hours b ON a.name = b.name AND b.hour_us = a.hour_us + 3600000000
  WHERE a.hour_us + 7200000000 <= (SELECT epoch_us(watermark) FROM closing)
)
SELECT name, count FROM (
  SELECT name, arg_max(count, at_us * 2 + kind) AS count FROM states GROUP BY name)
WHERE count > 0 ORDER BY count DESC, name LIMIT 100"""),
    "stream_last_hour_sweep": _BY_INTERVAL,
    "stream_wall_sweep": _events("""
SELECT name, count(*) AS counted, count(*) AS swept, CAST(0 AS BIGINT) AS last_hour FROM e GROUP BY name"""),
    "stream_sweep_from_history": f"""
SELECT * FROM ({_BY_INTERVAL}) WHERE hour_us >= epoch_us(TIMESTAMP '2024-01-11')""",
    "stream_last_hour_processor": _BY_INTERVAL,
    "stream_sweep_updates": _events(f"""
SELECT * FROM ({_SWEEP_UPDATES})
WHERE sweep_us <= (SELECT epoch_us(watermark) FROM closing)"""),
}


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
