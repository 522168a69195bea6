"""Shared pieces of the checking SQL (DuckDB). Each piece is a CTE; ``statement`` puts the pieces a
query names, and those they need, in front of it."""

from __future__ import annotations

PIECES: dict[str, tuple[tuple[str, ...], str]] = {}


def piece(name: str, text: str, *needs: str) -> None:
    PIECES[name] = (needs, text)


def statement(body: str, *names: str) -> str:
    done: dict[str, str] = {}

    def add(name: str) -> None:
        if name not in done:
            needs, text = PIECES[name]
            for need in needs:
                add(need)
            done[name] = text

    for name in names:
        add(name)
    ctes = ",\n".join(f"{n} AS (\n{t}\n)" for n, t in done.items())
    return f"WITH {ctes}\n{body}"


piece("ev", """
SELECT CAST(event_id AS VARCHAR) AS event_id, event_id AS seq, 'u' || user_id AS user_id, event_type,
       '/p/' || json_extract_string(props, '$.k') AS page_url, CAST(ts AS TIMESTAMP) AS event_timestamp,
       ['mobile','desktop','tablet'][1 + user_id % 3] AS device_type,
       ['US','DE','JP','BR'][1 + user_id % 4] AS country,
       ['web','app','email'][1 + event_id % 3] AS channel, value AS price,
       CAST(ts + to_minutes(CASE WHEN event_id % 5 = 0 THEN (event_id * 37) % 61 ELSE 0 END) AS TIMESTAMP)
         AS processing_timestamp
FROM events""")

piece("counts", """
SELECT time_bucket(INTERVAL 5 MINUTE, event_timestamp) AS window_start,
       time_bucket(INTERVAL 5 MINUTE, event_timestamp) + INTERVAL 5 MINUTE AS window_end,
       event_type, count(*) AS count
FROM ev GROUP BY ALL""", "ev")

piece("views", """
SELECT time_bucket(INTERVAL 5 MINUTE, event_timestamp) AS window_start,
       time_bucket(INTERVAL 5 MINUTE, event_timestamp) + INTERVAL 5 MINUTE AS window_end,
       page_url, count(*) AS count
FROM ev WHERE event_type = 'view' GROUP BY ALL""", "ev")

piece("by_user", """
SELECT time_bucket(INTERVAL 2 MINUTE, event_timestamp) - to_minutes(2 * i) AS window_start,
       time_bucket(INTERVAL 2 MINUTE, event_timestamp) - to_minutes(2 * i) + INTERVAL 10 MINUTE AS window_end,
       user_id, count(*) AS event_count
FROM ev, range(5) t(i) GROUP BY ALL""", "ev")

piece("rates", """
SELECT time_bucket(INTERVAL 1 MINUTE, event_timestamp) - to_minutes(i) AS window_start,
       time_bucket(INTERVAL 1 MINUTE, event_timestamp) - to_minutes(i) + INTERVAL 5 MINUTE AS window_end,
       count(*) AS click_count, round(CAST(count(*) AS DOUBLE) / 5.0::DOUBLE, 2) AS clicks_per_minute
FROM ev, range(5) t(i) WHERE event_type = 'click' GROUP BY ALL""", "ev")

for label, gap in (("30m", "30 MINUTE"), ("12h", "12 HOUR")):
    piece(f"linked_{label}", f"""
SELECT *, lag(event_timestamp) OVER u AS prev_event_timestamp, lag(channel) OVER u AS prev_channel
FROM ev WINDOW u AS (PARTITION BY user_id ORDER BY event_timestamp, event_id)""", "ev")
    piece(f"flagged_{label}", f"""
SELECT *, CASE WHEN event_timestamp > prev_event_timestamp + INTERVAL {gap} THEN 1 ELSE 0 END AS is_new_session
FROM linked_{label}""", f"linked_{label}")
    piece(f"numbered_{label}", f"""
SELECT *, CAST(sum(is_new_session) OVER (PARTITION BY user_id ORDER BY event_timestamp, event_id
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS session_number
FROM flagged_{label}""", f"flagged_{label}")
    piece(f"assigned_{label}", f"""
SELECT *, min(event_timestamp) OVER (PARTITION BY user_id, session_number) AS session_start,
       user_id || '-' || (epoch_us(min(event_timestamp) OVER (PARTITION BY user_id, session_number)) // 1000) AS session_id
FROM numbered_{label}""", f"numbered_{label}")
    piece(f"sessions_{label}", f"""
SELECT session_id, user_id, min(event_timestamp) AS start_time, max(event_timestamp) AS end_time,
       round((epoch_us(max(event_timestamp)) - epoch_us(min(event_timestamp)))::DOUBLE / 6e7::DOUBLE, 2) AS duration_minutes,
       count(*) AS event_count, count(DISTINCT page_url) AS pages_visited,
       arg_min(event_type, (event_timestamp, event_id)) AS first_event_type,
       arg_max(event_type, (event_timestamp, event_id)) AS last_event_type,
       arg_min(device_type, (event_timestamp, event_id)) AS device_type,
       arg_min(country, (event_timestamp, event_id)) AS country,
       max(event_timestamp) + INTERVAL {gap} AS closes_at
FROM assigned_{label} GROUP BY session_id, user_id""", f"assigned_{label}")

piece("seen", """
SELECT *, max(event_timestamp) OVER (ORDER BY processing_timestamp, seq
       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest
FROM ev""", "ev")

for label, minutes in (("5m", 5), ("10m", 10)):
    piece(f"classed_{label}", f"""
SELECT * EXCLUDE newest, newest - INTERVAL 10 MINUTE AS watermark,
       time_bucket(INTERVAL {minutes} MINUTE, event_timestamp) AS window_start,
       time_bucket(INTERVAL {minutes} MINUTE, event_timestamp) + INTERVAL {minutes} MINUTE AS window_end,
       CASE WHEN newest - INTERVAL 10 MINUTE >= time_bucket(INTERVAL {minutes} MINUTE, event_timestamp) + INTERVAL {minutes + 5} MINUTE
            THEN 'too_late'
            WHEN newest - INTERVAL 10 MINUTE >= time_bucket(INTERVAL {minutes} MINUTE, event_timestamp) + INTERVAL {minutes} MINUTE
            THEN 'late' ELSE 'on_time' END AS lateness_class
FROM seen""", "seen")

piece("late_counts", """
SELECT window_start, window_end, event_type, count(*) AS count,
       (count(*) FILTER (lateness_class = 'on_time') > 0 AND count(*) FILTER (lateness_class = 'late') > 0)
       OR (count(*) FILTER (lateness_class = 'on_time') = 0 AND count(*) > 1) AS is_late_update
FROM classed_5m WHERE lateness_class <> 'too_late' GROUP BY window_start, window_end, event_type""", "classed_5m")

piece("late", """
SELECT event_id, event_type, event_timestamp, processing_timestamp,
       CAST(floor((epoch_us(processing_timestamp) - epoch_us(event_timestamp)) / 1000) AS BIGINT) AS lateness_ms,
       window_start, window_end, 'Arrived after allowed lateness' AS reason
FROM classed_5m WHERE lateness_class = 'too_late'""", "classed_5m")

piece("carts", """
SELECT session_id, user_id, max(event_timestamp) AS last_activity,
       count(*) FILTER (event_type = 'signup') AS items_added,
       CAST(floor((epoch_us((SELECT max(event_timestamp) FROM ev)) - epoch_us(max(event_timestamp)))::DOUBLE / 6e7::DOUBLE) AS BIGINT)
         AS time_since_last_activity_minutes, false AS alert_sent
FROM assigned_12h GROUP BY session_id, user_id
HAVING count(*) FILTER (event_type = 'signup') > 0 AND count(*) FILTER (event_type = 'purchase') = 0
   AND (SELECT max(event_timestamp) FROM ev) - max(event_timestamp) > INTERVAL 60 MINUTE""", "assigned_12h")

piece("clicks", "SELECT event_id, user_id, event_timestamp FROM ev WHERE event_type = 'click'", "ev")
piece("profiles", """
SELECT user_id, event_timestamp AS profile_ts, price AS profile_value FROM ev WHERE event_type = 'signup'""", "ev")

piece("plain_messages", """
SELECT seq, seq % 20 AS kind, user_id AS key, event_id, user_id, 's-' || user_id AS session_id, event_type, page_url,
       (epoch_us(event_timestamp) // 1000) AS millis, country, device_type, price, (epoch_us(processing_timestamp) // 1000) AS arrived,
       processing_timestamp
FROM ev""", "ev")
piece("messages", """
SELECT *, CASE
  WHEN kind = 0 THEN NULL
  WHEN kind = 1 THEN json_object('event_id', event_id, 'session_id', session_id, 'event_type', event_type,
       'page_url', page_url, 'timestamp', millis, 'country', country, 'device_type', device_type)
  WHEN kind = 2 THEN json_object('event_id', event_id, 'user_id', user_id, 'session_id', session_id,
       'event_type', event_type, 'page_url', page_url, 'timestamp', NULL, 'country', country, 'device_type', device_type)
  WHEN kind = 3 THEN json_object('event_id', event_id, 'user_id', user_id, 'session_id', session_id,
       'event_type', event_type, 'page_url', page_url, 'timestamp', 'soon', 'country', country, 'device_type', device_type)
  WHEN kind = 4 THEN json_object('event_id', event_id, 'user_id', user_id, 'session_id', session_id,
       'event_type', event_type, 'page_url', page_url, 'timestamp', millis, 'country', country, 'device_type', device_type,
       'campaign', 'spring')
  WHEN kind = 5 THEN NULL
  WHEN kind = 6 THEN json_object('event_id', event_id, 'user_id', user_id, 'session_id', session_id,
       'event_type', event_type, 'product_id', page_url, 'price', price, 'timestamp', millis, 'processing_time', arrived)
  ELSE json_object('event_id', event_id, 'user_id', user_id, 'session_id', session_id,
       'event_type', event_type, 'page_url', page_url, 'timestamp', millis, 'country', country, 'device_type', device_type)
  END AS body
FROM plain_messages""", "plain_messages")
piece("decoded", """
SELECT seq, kind, json_extract_string(body, '$.event_id') AS event_id, json_extract_string(body, '$.user_id') AS user_id,
       json_extract_string(body, '$.session_id') AS session_id, json_extract_string(body, '$.event_type') AS event_type,
       json_extract_string(body, '$.page_url') AS page_url,
       TRY_CAST(json_extract_string(body, '$.timestamp') AS BIGINT) AS "timestamp",
       json_extract_string(body, '$.ip_address') AS ip_address, json_extract_string(body, '$.user_agent') AS user_agent,
       json_extract_string(body, '$.referrer') AS referrer, json_extract_string(body, '$.country') AS country,
       json_extract_string(body, '$.device_type') AS device_type
FROM messages""", "messages")
