"""Queries over rows, windows, rates, counts and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventide.catalog.registry import register, rounded
from eventide.catalog.sql import statement
from eventide.operators import anomalies, counting, joins, rows, windows
from eventide.sinks import tables
from eventide.sources import ingest
from eventide.sources.contract import clickstream_contract, contract_audit, contract_schema
from eventide.sources.events import CHANNELS, CLICK, PAGE_VIEW, PURCHASE, load_events
from eventide.sources.messages import message_log

SCHEMA = contract_schema(clickstream_contract())


def _messages(spark: SparkSession, folder: str) -> DataFrame:
    return message_log(load_events(spark, folder))


# Ingest.


@register("parse_events", statement("SELECT * EXCLUDE (seq, kind) FROM decoded", "decoded"))
def _(spark, folder):
    return ingest.parse_events(_messages(spark, folder), SCHEMA)


@register("valid_events", statement("""
SELECT * EXCLUDE (seq, kind) FROM decoded WHERE kind NOT IN (0, 1, 2, 3, 5)""", "decoded"))
def _(spark, folder):
    return ingest.valid_events(_messages(spark, folder), SCHEMA)


@register("quarantine_reasons", statement("""
SELECT CASE WHEN kind IN (0, 3, 5) THEN 'undecodable' WHEN kind = 1 THEN 'no user_id' ELSE 'no timestamp' END AS reason,
       count(*) AS messages
FROM messages WHERE kind IN (0, 1, 2, 3, 5) GROUP BY reason""", "messages"))
def _(spark, folder):
    return ingest.quarantine(_messages(spark, folder), SCHEMA).groupBy("reason").agg(F.count(F.lit(1)).alias("messages"))


@register("contract_audit", statement("""
SELECT field, count(*) FILTER (NOT json_exists(body, '$.' || field)) AS missing,
       count(*) FILTER (json_exists(body, '$.' || field) AND json_extract_string(body, '$.' || field) IS NULL) AS nulls,
       count(*) FILTER (field = 'timestamp' AND json_extract_string(body, '$.timestamp') IS NOT NULL
                        AND TRY_CAST(json_extract_string(body, '$.timestamp') AS BIGINT) IS NULL) AS bad_type,
       0::BIGINT AS unknown
FROM messages, unnest(['event_id', 'user_id', 'session_id', 'event_type', 'page_url', 'timestamp', 'ip_address',
                       'user_agent', 'referrer', 'country', 'device_type']) f(field)
WHERE body IS NOT NULL GROUP BY field
UNION ALL
SELECT k, 0, 0, 0, count(*) FROM (SELECT unnest(json_keys(body)) AS k FROM messages WHERE body IS NOT NULL)
WHERE k NOT IN ('event_id', 'user_id', 'session_id', 'event_type', 'page_url', 'timestamp', 'ip_address',
                'user_agent', 'referrer', 'country', 'device_type') GROUP BY k""", "messages"))
def _(spark, folder):
    return contract_audit(_messages(spark, folder), SCHEMA)


@register("message_key", statement("SELECT key, seq AS \"offset\" FROM messages", "messages"))
def _(spark, folder):
    return _messages(spark, folder).select(ingest.message_key().alias("key"), "offset")


@register("lake_read", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def _(spark, folder):
    return ingest.read_table(spark, f"{folder}/events.parquet")


@register("lake_count", "SELECT count(*) AS count FROM events")
def _(spark, folder):
    return ingest.read_table(spark, f"{folder}/events.parquet").agg(F.count(F.lit(1)).alias("count"))


@register("type_distribution", statement("SELECT event_type, count(*) AS count FROM ev GROUP BY event_type", "ev"))
def _(spark, folder):
    return ingest.type_distribution(load_events(spark, folder))


@register("sample_rows", statement("SELECT event_id, user_id, event_type, event_timestamp FROM ev ORDER BY seq LIMIT 20", "ev"))
def _(spark, folder):
    ordered = load_events(spark, folder).orderBy("seq").select("event_id", "user_id", "event_type", "event_timestamp")
    return ingest.sample_rows(ordered, 20)


@register("union_channels", statement("""
SELECT channel, event_type, count(*) AS count FROM ev GROUP BY ALL""", "ev"))
def _(spark, folder):
    # Events without a channel (an event without an id has none) are a source of their own.
    ev = load_events(spark, folder)
    sources = {c: ev.where(F.col("channel").eqNullSafe(F.lit(c).cast("string"))).drop("channel") for c in [*CHANNELS, None]}
    return ingest.union_channels(sources).groupBy("channel", "event_type").count()


_ISO = """CASE WHEN (epoch_us({c}) // 1000) % 1000 = 0 THEN strftime({c}, '%Y-%m-%dT%H:%M:%SZ')
               ELSE strftime({c}, '%Y-%m-%dT%H:%M:%S.%gZ') END"""


@register("to_jsonl", statement(f"""
SELECT json_object('event_id', event_id, 'user_id', user_id, 'event_type', event_type, 'page_url', page_url,
  'timestamp', (epoch_us(event_timestamp) // 1000), 'referrer', NULL, 'event_timestamp', {_ISO.format(c='event_timestamp')},
  'event_timestamp_start', '2024-02-01T00:00:00Z', 'event_timestamp_end', '2024-02-01T00:01:00Z')::VARCHAR AS value
FROM ev""", "ev"))
def _(spark, folder):
    ev = load_events(spark, folder).select(
        "event_id", "user_id", "event_type", "page_url", F.unix_millis("event_timestamp").alias("timestamp"),
        F.lit(None).cast("string").alias("referrer"), "event_timestamp",
    )
    return ingest.to_jsonl(rows.enrich_iso(ev, F.lit("2024-02-01 00:00:00").cast("timestamp")))


# Rows.


@register("event_time", statement("""
SELECT event_id, make_timestamp((epoch_us(event_timestamp) // 1000) * 1000) AS event_timestamp FROM ev""", "ev"))
def _(spark, folder):
    millis = load_events(spark, folder).select("event_id", F.unix_millis("event_timestamp").alias("timestamp"))
    return rows.with_event_time(millis).drop("timestamp")


@register("window_tags", statement("""
SELECT event_id, event_timestamp, time_bucket(INTERVAL 5 MINUTE, event_timestamp) AS event_timestamp_start,
       time_bucket(INTERVAL 5 MINUTE, event_timestamp) + INTERVAL 5 MINUTE AS event_timestamp_end
FROM ev""", "ev"))
def _(spark, folder):
    ev = rows.with_window(load_events(spark, folder))
    return ev.select("event_id", "event_timestamp", "event_timestamp_start", "event_timestamp_end")


@register("enrich_iso", statement(f"""
SELECT event_id, {_ISO.format(c='event_timestamp')} AS event_timestamp,
       '2024-02-01T00:00:00Z' AS event_timestamp_start, '2024-02-01T00:01:00Z' AS event_timestamp_end
FROM ev""", "ev"))
def _(spark, folder):
    out = rows.enrich_iso(load_events(spark, folder), F.lit("2024-02-01 00:00:00").cast("timestamp"))
    return out.select("event_id", "event_timestamp", "event_timestamp_start", "event_timestamp_end")


@register("only_type", statement("SELECT event_id, page_url FROM ev WHERE event_type = 'view'", "ev"))
def _(spark, folder):
    return rows.only_type(load_events(spark, folder), PAGE_VIEW).select("event_id", "page_url")


@register("arrival_delay", statement("""
SELECT event_id, CAST(floor((epoch_us(processing_timestamp) - epoch_us(event_timestamp)) / 1000) AS BIGINT) AS delay_ms,
       coalesce(event_timestamp < newest, false) AS out_of_order
FROM seen""", "seen"))
def _(spark, folder):
    return rows.arrival_delay(load_events(spark, folder))


@register("delay_summary", statement("""
SELECT round(avg(d), 9) AS avg_ms, max(d) AS max_ms, count(*) FILTER (d > 60000) AS over_1min
FROM (SELECT CAST(floor((epoch_us(processing_timestamp) - epoch_us(event_timestamp)) / 1000) AS BIGINT) AS d FROM ev)""", "ev"))
def _(spark, folder):
    return rounded(rows.delay_summary(load_events(spark, folder)), avg_ms=9)


@register("recent_windows", statement("""
SELECT window_start, event_type, count FROM counts
WHERE window_start >= (SELECT max(window_start) FROM counts) - INTERVAL 1 HOUR
ORDER BY window_start DESC, count DESC""", "counts"))
def _(spark, folder):
    counts = windows.tumbling_count(load_events(spark, folder))
    as_of = counts.agg(F.max("window_start")).scalar()
    listed = rows.recent(counts, "window_start", as_of, "1 hour").select("window_start", "event_type", "count")
    return listed.orderBy(F.desc("window_start"), F.desc("count"))


@register("dedup_events", statement("""
SELECT event_id, user_id, event_type, event_timestamp, processing_timestamp FROM ev""", "ev"))
def _(spark, folder):
    # Every event twice, the copy arriving an hour later.
    ev = load_events(spark, folder).select("event_id", "seq", "user_id", "event_type", "event_timestamp", "processing_timestamp")
    copies = ev.withColumn("processing_timestamp", F.col("processing_timestamp") + F.expr("INTERVAL 1 HOUR"))
    return rows.dedup_events(ev.unionByName(copies)).drop("seq")


# Windows.


@register("tumbling_count", statement("SELECT * FROM counts", "counts"))
def tumbling(spark, folder):
    return windows.tumbling_count(load_events(spark, folder))


@register("page_views", statement("SELECT * FROM views", "views"))
def _views(spark, folder):
    return windows.page_views(load_events(spark, folder), PAGE_VIEW)


@register("top_n_per_window", statement("""
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY count DESC, page_url) AS rank FROM views)
WHERE rank <= 10""", "views"))
def _(spark, folder):
    return windows.top_n_per_window(_views(spark, folder), 10)


@register("top_ranked_per_window", statement("""
SELECT * FROM (SELECT *, rank() OVER (PARTITION BY window_start ORDER BY count DESC) AS rank FROM views)
WHERE rank <= 10""", "views"))
def _(spark, folder):
    return windows.top_n_per_window(_views(spark, folder), 10, tie="rank")


@register("top_pages_latest", statement("""
SELECT *, rank() OVER (PARTITION BY window_start ORDER BY count DESC) AS rank FROM views
WHERE window_start = (SELECT max(window_start) FROM views) ORDER BY rank, page_url LIMIT 10""", "views"))
def _(spark, folder):
    return windows.top_pages_latest(_views(spark, folder), 10)


@register("latest_window", statement("""
SELECT * FROM counts WHERE window_start = (SELECT max(window_start) FROM counts)""", "counts"))
def _(spark, folder):
    return windows.latest_window(tumbling(spark, folder))


@register("sliding_count", statement("SELECT * FROM by_user", "by_user"))
def _by_user(spark, folder):
    return windows.sliding_count(load_events(spark, folder))


@register("sliding_rate", statement("SELECT * FROM rates", "rates"))
def _rates(spark, folder):
    return windows.sliding_rate(load_events(spark, folder), CLICK)


@register("sliding_avg", statement("""
SELECT time_bucket(INTERVAL 5 MINUTE, event_timestamp) - to_minutes(5 * i) AS window_start,
       time_bucket(INTERVAL 5 MINUTE, event_timestamp) - to_minutes(5 * i) + INTERVAL 10 MINUTE AS window_end,
       user_id, round(avg(price), 9) AS avg_value
FROM ev, range(2) t(i) GROUP BY window_start, window_end, user_id""", "ev"))
def _(spark, folder):
    return rounded(windows.sliding_avg(load_events(spark, folder), "price"), avg_value=9)


_HISTORY = """
SELECT c.window_start, c.window_end, c.clicks_per_minute, round(avg(b.clicks_per_minute), 6) AS mean,
       round(stddev_samp(b.clicks_per_minute), 6) AS sd
FROM rates c LEFT JOIN rates b
  ON b.window_start BETWEEN c.window_start - INTERVAL 60 MINUTE AND c.window_start - INTERVAL 1 MINUTE
GROUP BY c.window_start, c.window_end, c.clicks_per_minute"""


@register("rate_anomaly", statement(f"""
SELECT window_start, window_end, clicks_per_minute, mean AS baseline,
       coalesce(clicks_per_minute > 2.0::DOUBLE * mean, false) AS is_anomaly
FROM ({_HISTORY})""", "rates"))
def _(spark, folder):
    return anomalies.rate_anomaly(_rates(spark, folder), 2.0)


@register("rate_anomaly_2d", statement(f"""
SELECT window_start, window_end, clicks_per_minute, mean AS baseline,
       coalesce(clicks_per_minute > 2.0::DOUBLE * mean, false) AS is_anomaly
FROM ({_HISTORY.replace('INTERVAL 60 MINUTE', 'INTERVAL 48 HOUR')})""", "rates"))
def _(spark, folder):
    return anomalies.rate_anomaly(_rates(spark, folder), 2.0, "48 hours")


@register("rate_zscore", statement(f"""
SELECT window_start, window_end, clicks_per_minute, mean, sd, round(zscore, 3) AS zscore,
       coalesce(abs(zscore) > 3, false) AS is_anomaly
FROM (SELECT *, CASE WHEN sd > 0 THEN round((clicks_per_minute - mean) / sd, 6) END AS zscore FROM ({_HISTORY}))""", "rates"))
def _(spark, folder):
    return rounded(anomalies.rate_zscore(_rates(spark, folder), 3.0), zscore=3)


@register("baseline_theta_join", statement("""
SELECT c.*, min(b.baseline_avg) AS baseline_avg
FROM rates c JOIN (SELECT time_bucket(INTERVAL 1 HOUR, window_start) AS baseline_start,
                          round(avg(clicks_per_minute), 6) AS baseline_avg
                   FROM rates GROUP BY baseline_start) b
  ON c.window_start >= b.baseline_start AND c.clicks_per_minute > 2.0::DOUBLE * b.baseline_avg
GROUP BY ALL""", "rates"))
def _(spark, folder):
    current = _rates(spark, folder)
    return anomalies.baseline_theta_join(current, anomalies.hourly_baseline(current), 2.0)


@register("windows_containing", statement("""
SELECT DISTINCT window_start, window_end FROM by_user
WHERE window_start <= TIMESTAMP '2024-01-15 10:15:00' AND window_end > TIMESTAMP '2024-01-15 10:15:00'
ORDER BY window_start""", "by_user"))
def _(spark, folder):
    return windows.windows_containing(_by_user(spark, folder), F.lit("2024-01-15 10:15:00").cast("timestamp"))


@register("window_multiplicity", statement("""
SELECT user_id, event_count, count(*) AS count FROM by_user GROUP BY user_id, event_count ORDER BY count DESC""", "by_user"))
def _(spark, folder):
    return windows.window_multiplicity(_by_user(spark, folder))


@register("tumbling_vs_sliding", statement("""
SELECT 'tumbling' AS kind, time_bucket(INTERVAL 10 MINUTE, event_timestamp) AS window_start,
       time_bucket(INTERVAL 10 MINUTE, event_timestamp) + INTERVAL 10 MINUTE AS window_end, count(*) AS count
FROM ev GROUP BY ALL
UNION ALL
SELECT 'sliding', time_bucket(INTERVAL 2 MINUTE, event_timestamp) - to_minutes(2 * i),
       time_bucket(INTERVAL 2 MINUTE, event_timestamp) - to_minutes(2 * i) + INTERVAL 10 MINUTE, count(*)
FROM ev, range(5) t(i) GROUP BY ALL""", "ev"))
def _(spark, folder):
    return windows.tumbling_vs_sliding(load_events(spark, folder))


@register("minute_histogram", statement("""
SELECT time_bucket(INTERVAL 1 MINUTE, event_timestamp) AS window_start, count(*) AS count FROM ev
GROUP BY window_start ORDER BY window_start""", "ev"))
def _(spark, folder):
    return windows.minute_histogram(load_events(spark, folder))


_CLOSURE = """
SELECT window_start, window_end, rows,
       (epoch_us(lead(window_start) OVER (ORDER BY window_start)) - epoch_us(window_start))::DOUBLE / 6e7::DOUBLE AS gap_minutes
FROM (SELECT window_start, window_end, count(*) AS rows FROM counts GROUP BY window_start, window_end)"""


@register("window_closure", statement(_CLOSURE, "counts"))
def _(spark, folder):
    return windows.window_closure(tumbling(spark, folder))


@register("window_closure_latest", statement(f"{_CLOSURE} ORDER BY window_start DESC LIMIT 20", "counts"))
def _(spark, folder):
    return windows.window_closure(tumbling(spark, folder), latest=20)


@register("hopping_gap_count", statement("""
SELECT time_bucket(INTERVAL 15 MINUTE, event_timestamp) AS window_start,
       time_bucket(INTERVAL 15 MINUTE, event_timestamp) + INTERVAL 5 MINUTE AS window_end, count(*) AS count
FROM ev WHERE event_timestamp < time_bucket(INTERVAL 15 MINUTE, event_timestamp) + INTERVAL 5 MINUTE
GROUP BY ALL""", "ev"))
def _(spark, folder):
    return windows.hopping_gap_count(load_events(spark, folder))


@register("top_products", statement("""
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY count DESC, page_url) AS rank FROM (
    SELECT time_bucket(INTERVAL 15 MINUTE, event_timestamp) AS window_start,
           time_bucket(INTERVAL 15 MINUTE, event_timestamp) + INTERVAL 15 MINUTE AS window_end, page_url, count(*) AS count
    FROM ev WHERE event_type = 'view' GROUP BY ALL))
WHERE rank <= 10""", "ev"))
def _(spark, folder):
    return windows.top_products(load_events(spark, folder), 10, view_type=PAGE_VIEW)


@register("conversion_rate", statement("""
SELECT time_bucket(INTERVAL 5 MINUTE, event_timestamp) - to_minutes(5 * i) AS window_start,
       time_bucket(INTERVAL 5 MINUTE, event_timestamp) - to_minutes(5 * i) + INTERVAL 1 HOUR AS window_end,
       count(*) AS total, count(*) FILTER (event_type = 'purchase') AS conversions,
       round(100.0::DOUBLE * count(*) FILTER (event_type = 'purchase') / count(*), 2) AS rate
FROM ev, range(12) t(i) GROUP BY window_start, window_end""", "ev"))
def _(spark, folder):
    return windows.conversion_rate(load_events(spark, folder), PURCHASE)


@register("active_sessions", statement("""
SELECT time_bucket(INTERVAL 5 MINUTE, event_timestamp) AS window_start,
       time_bucket(INTERVAL 5 MINUTE, event_timestamp) + INTERVAL 5 MINUTE AS window_end, count(DISTINCT user_id) AS active
FROM ev GROUP BY ALL""", "ev"))
def _(spark, folder):
    return windows.active_sessions(load_events(spark, folder))


@register("daily_report", statement("""
SELECT time_bucket(INTERVAL 1 DAY, event_timestamp) AS window_start,
       time_bucket(INTERVAL 1 DAY, event_timestamp) + INTERVAL 1 DAY AS window_end, event_type, count(*) AS count
FROM ev GROUP BY ALL""", "ev"))
def _(spark, folder):
    return windows.tumbling_count(load_events(spark, folder), "event_type", "1 day")


@register("hourly_report", statement("""
SELECT time_bucket(INTERVAL 1 HOUR, event_timestamp) AS window_start,
       time_bucket(INTERVAL 1 HOUR, event_timestamp) + INTERVAL 1 HOUR AS window_end, page_url, count(*) AS count
FROM ev GROUP BY ALL""", "ev"))
def _(spark, folder):
    return windows.tumbling_count(load_events(spark, folder), "page_url", "1 hour")


# Sorting, limits, sets.


@register("events_in_order", statement("SELECT event_id, event_timestamp FROM ev ORDER BY event_timestamp DESC", "ev"))
def _(spark, folder):
    return load_events(spark, folder).select("event_id", "event_timestamp").orderBy(F.desc("event_timestamp"))


@register("largest_counts", statement("""
SELECT * FROM counts ORDER BY count DESC, window_start, event_type LIMIT 10""", "counts"))
def _(spark, folder):
    return tumbling(spark, folder).orderBy(F.desc("count"), "window_start", "event_type").limit(10)


@register("distinct_pages", statement("SELECT DISTINCT page_url FROM ev", "ev"))
def _(spark, folder):
    return load_events(spark, folder).select("page_url").distinct()


@register("union_streams", statement("""
SELECT event_type, count(*) AS count FROM ev GROUP BY event_type""", "ev"))
def _(spark, folder):
    ev = load_events(spark, folder)
    views = rows.only_type(ev, PAGE_VIEW)
    others = ev.where(~F.col("event_type").eqNullSafe(PAGE_VIEW))
    return views.unionByName(others).groupBy("event_type").count()


# Count windows and eviction.


@register("count_windows", statement("""
SELECT user_id, block, count(*) AS count, min(event_timestamp) AS first_ts, max(event_timestamp) AS last_ts
FROM (SELECT *, (row_number() OVER (PARTITION BY user_id ORDER BY processing_timestamp, seq) - 1) // 10 AS block FROM ev)
GROUP BY user_id, block HAVING count(*) = 10""", "ev"))
def _(spark, folder):
    return counting.count_windows(load_events(spark, folder), "user_id", 10)


@register("keep_recent", statement("""
SELECT event_id, event_type, event_timestamp, window_start FROM (
  SELECT *, row_number() OVER (PARTITION BY window_start, event_type ORDER BY event_timestamp DESC, event_id DESC) AS place
  FROM (SELECT *, time_bucket(INTERVAL 1 HOUR, event_timestamp) AS window_start FROM ev))
WHERE place <= 2""", "ev"))
def _(spark, folder):
    kept = counting.keep_recent(load_events(spark, folder), "1 hour", "event_type", 2)
    return kept.select("event_id", "event_type", "event_timestamp", "window_start")


@register("drop_outliers", statement("""
SELECT event_id, price, e.window_start
FROM (SELECT *, time_bucket(INTERVAL 1 HOUR, event_timestamp) AS window_start FROM ev) e
JOIN (SELECT time_bucket(INTERVAL 1 HOUR, event_timestamp) AS window_start, avg(price) AS m, stddev_samp(price) AS s
      FROM ev GROUP BY ALL) w ON e.window_start = w.window_start
WHERE NOT coalesce(abs(price - m) > 2.0::DOUBLE * s, false)""", "ev"))
def _(spark, folder):
    return counting.drop_outliers(load_events(spark, folder), "1 hour", "price", 2.0).select("event_id", "price", "window_start")


@register("sample_events", statement("""
SELECT event_id FROM ev WHERE ('0x' || substr(md5(event_id), 1, 8))::BIGINT % 10000 < 1000""", "ev"))
def _(spark, folder):
    return counting.sample_events(load_events(spark, folder), 10).select("event_id")


# Joins.


def clicks_and_profiles(ev: DataFrame) -> tuple[DataFrame, DataFrame]:
    clicks = ev.where(F.col("event_type") == CLICK).select("event_id", "user_id", "event_timestamp")
    profiles = ev.where(F.col("event_type") == "signup").select(
        "user_id", F.col("event_timestamp").alias("profile_ts"), F.col("price").alias("profile_value")
    )
    return clicks, profiles


def interval_sql(within: str) -> str:
    return statement(f"""
SELECT event_id, c.user_id, event_timestamp, profile_ts, profile_value
FROM clicks c JOIN profiles p ON c.user_id = p.user_id
 AND profile_ts BETWEEN event_timestamp - INTERVAL {within} AND event_timestamp""", "clicks", "profiles")


@register("interval_join", interval_sql("6 HOUR"))
def _(spark, folder):
    return joins.interval_join(
        *clicks_and_profiles(load_events(spark, folder)), "user_id", "event_timestamp", "profile_ts", "6 hours"
    )


@register("interval_join_5min", interval_sql("5 MINUTE"))
def _(spark, folder):
    return joins.interval_join(
        *clicks_and_profiles(load_events(spark, folder)), "user_id", "event_timestamp", "profile_ts", "5 minutes"
    )


@register("asof_join", statement("""
SELECT c.event_id, c.user_id, c.event_timestamp,
       CASE WHEN p.profile_ts >= c.event_timestamp - INTERVAL 6 HOUR THEN p.profile_ts END AS profile_ts,
       CASE WHEN p.profile_ts >= c.event_timestamp - INTERVAL 6 HOUR THEN p.profile_value END AS profile_value
FROM clicks c ASOF LEFT JOIN profiles p ON c.user_id = p.user_id AND c.event_timestamp >= p.profile_ts""", "clicks", "profiles"))
def _(spark, folder):
    return joins.asof_join(
        *clicks_and_profiles(load_events(spark, folder)), "user_id", "event_timestamp", "profile_ts", "6 hours"
    )


# Serving tables.


@register("upsert", statement("""
SELECT coalesce(o.window_start, n.window_start) AS window_start, coalesce(o.event_type, n.event_type) AS event_type,
       coalesce(n.count, o.count) AS count, coalesce(o.window_end, n.window_end) AS window_end
FROM (SELECT time_bucket(INTERVAL 1 DAY, event_timestamp) AS window_start, event_type, count(*) AS count,
             time_bucket(INTERVAL 1 DAY, event_timestamp) + INTERVAL 1 DAY AS window_end
      FROM ev WHERE event_timestamp < TIMESTAMP '2024-01-20' GROUP BY ALL) o
FULL JOIN (SELECT time_bucket(INTERVAL 1 DAY, event_timestamp) AS window_start, event_type, count(*) AS count,
                  time_bucket(INTERVAL 1 DAY, event_timestamp) + INTERVAL 2 DAY AS window_end
           FROM ev WHERE event_timestamp >= TIMESTAMP '2024-01-10' GROUP BY ALL) n
  ON o.window_start = n.window_start AND o.event_type = n.event_type""", "ev"))
def _(spark, folder):
    ev = load_events(spark, folder)
    at = F.col("event_timestamp")
    old = windows.tumbling_count(ev.where(at < "2024-01-20"), "event_type", "1 day")
    new = windows.tumbling_count(ev.where(at >= "2024-01-10"), "event_type", "1 day")
    new = new.withColumn("window_end", F.col("window_end") + F.expr("INTERVAL 1 DAY"))
    return tables.upsert(old, new, ["window_start", "event_type"], ["count"])
