"""Queries over sessions and late data."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventide.catalog.registry import register, rounded
from eventide.catalog.sql import statement
from eventide.operators import late, sessions
from eventide.sinks import tables
from eventide.sources.events import CART, CHECKOUT, CLICK, PAGE_VIEW, PURCHASE, load_events

GAPS = {"30m": "30 minutes", "12h": "12 hours"}
STAGES = [PAGE_VIEW, CLICK, CART, CHECKOUT, PURCHASE]

_SHARES = """
       count(*) FILTER (event_count = 1) AS bounce_sessions,
       round(100.0::DOUBLE * count(*) FILTER (event_count = 1) / count(*), 2) AS bounce_rate"""
_BOUGHT = """
       count(*) FILTER (last_event_type = 'purchase') AS conversion_sessions,
       round(100.0::DOUBLE * count(*) FILTER (last_event_type = 'purchase') / count(*), 2) AS conversion_rate"""


def _sessions(spark, folder, label="12h", pages=True):
    return sessions.session_metrics(load_events(spark, folder), GAPS[label], pages=pages)


for _label, _gap in GAPS.items():

    @register(f"assign_sessions_{_label}", statement(f"""
SELECT event_id, user_id, event_timestamp, prev_event_timestamp,
       coalesce((epoch_us(event_timestamp) - epoch_us(prev_event_timestamp))::DOUBLE / 1e6::DOUBLE, 0) AS time_since_last_seconds,
       CAST(is_new_session AS BIGINT) AS is_new_session, session_number, session_id
FROM assigned_{_label}""", f"assigned_{_label}"))
    def _(spark, folder, gap=_gap):
        return sessions.assign_sessions(load_events(spark, folder), gap).select(
            "event_id", "user_id", "event_timestamp", "prev_event_timestamp", "time_since_last_seconds",
            "is_new_session", "session_number", "session_id",
        )

    @register(f"session_metrics_{_label}", statement(f"SELECT * FROM sessions_{_label}", f"sessions_{_label}"))
    def _(spark, folder, label=_label):
        return _sessions(spark, folder, label)

    @register(f"session_summary_{_label}", statement(f"""
SELECT date_trunc('hour', start_time) AS hour, count(*) AS total_sessions, round(avg(duration_minutes), 9) AS avg_duration,
       round(avg(event_count), 9) AS avg_events_per_session, round(avg(pages_visited), 9) AS avg_pages_per_session,
       {_SHARES}, {_BOUGHT}
FROM sessions_{_label} GROUP BY hour""", f"sessions_{_label}"))
    def _(spark, folder, label=_label):
        out = sessions.session_summary(_sessions(spark, folder, label), PURCHASE)
        return rounded(out, avg_duration=9, avg_events_per_session=9, avg_pages_per_session=9)

    @register(f"bounce_rate_by_hour_{_label}", statement(f"""
SELECT date_trunc('hour', start_time) AS hour, count(*) AS total_sessions, {_SHARES}
FROM sessions_{_label} GROUP BY hour ORDER BY hour""", f"sessions_{_label}"))
    def _(spark, folder, label=_label):
        return sessions.bounce_rate(_sessions(spark, folder, label, pages=False))

    @register(f"session_funnel_{_label}", statement(f"""
SELECT count(*) AS total_sessions, count(*) FILTER (event_count > 1) AS engaged,
       count(*) FILTER (last_event_type = 'signup') AS added_to_cart, count(*) FILTER (last_event_type = 'purchase') AS purchased
FROM sessions_{_label}""", f"sessions_{_label}"))
    def _(spark, folder, label=_label):
        return sessions.session_funnel(_sessions(spark, folder, label, pages=False), CART, PURCHASE)

    @register(f"session_size_histogram_{_label}", statement(f"""
SELECT event_count, count(*) AS sessions FROM sessions_{_label} GROUP BY event_count""", f"sessions_{_label}"))
    def _(spark, folder, label=_label):
        return sessions.session_size_histogram(_sessions(spark, folder, label, pages=False))


@register("session_metrics_window_end", statement("""
SELECT * REPLACE (closes_at AS end_time,
    round((epoch_us(closes_at) - epoch_us(start_time))::DOUBLE / 6e7::DOUBLE, 2) AS duration_minutes)
FROM sessions_30m""", "sessions_30m"))
def _(spark, folder):
    return sessions.session_metrics(load_events(spark, folder), GAPS["30m"], end="window_end")


@register("session_upsert", statement("""
SELECT * FROM sessions_12h""", "sessions_12h"))
def _(spark, folder):
    # Sessions as known on the 15th, then refreshed with what the whole month says about them. A
    # session open on the 15th keeps its id, start, first event, device and country.
    ev = load_events(spark, folder)
    early = sessions.session_metrics(ev.where(F.col("event_timestamp") < "2024-01-15"), GAPS["12h"])
    updated = [*sessions.SESSION_UPDATES, "closes_at"]
    return tables.upsert(early, _sessions(spark, folder), ["session_id"], updated)


@register("session_metrics_hourly", statement(f"""
SELECT date_trunc('hour', start_time) AS hour, device_type, country, count(*) AS total_sessions,
       CAST(round(CAST(avg(duration_minutes) AS DECIMAL(18, 6)), 2) AS DOUBLE) AS avg_duration_minutes, {_SHARES}, {_BOUGHT}
FROM sessions_12h GROUP BY hour, device_type, country""", "sessions_12h"))
def _(spark, folder):
    return sessions.session_metrics_hourly(_sessions(spark, folder, pages=False), PURCHASE)


@register("bounce_rate_total", statement(f"SELECT count(*) AS total_sessions, {_SHARES} FROM sessions_12h", "sessions_12h"))
def _(spark, folder):
    return sessions.bounce_rate(_sessions(spark, folder, pages=False), by_hour=False)


@register("sessions_by_device", statement("""
SELECT device_type, count(*) AS sessions, CAST(round(CAST(avg(duration_minutes) AS DECIMAL(18, 6)), 2) AS DOUBLE) AS avg_duration,
       CAST(round(CAST(avg(pages_visited) AS DECIMAL(18, 6)), 1) AS DOUBLE) AS avg_pages
FROM sessions_12h GROUP BY device_type""", "sessions_12h"))
def _(spark, folder):
    return sessions.sessions_by_device(_sessions(spark, folder))


@register("long_sessions", statement("""
SELECT user_id, session_id, duration_minutes, event_count, pages_visited FROM sessions_12h
WHERE duration_minutes > 30 ORDER BY duration_minutes DESC, session_id LIMIT 20""", "sessions_12h"))
def _(spark, folder):
    return sessions.long_sessions(_sessions(spark, folder), 30, 20)


@register("frequent_users", statement("""
SELECT user_id, count(*) AS session_count, round(avg(duration_minutes), 9) AS avg_duration
FROM sessions_12h GROUP BY user_id HAVING count(*) > 5""", "sessions_12h"))
def _(spark, folder):
    return rounded(sessions.frequent_users(_sessions(spark, folder, pages=False), 5), avg_duration=9)


@register("recent_sessions", statement("""
SELECT * FROM sessions_12h ORDER BY start_time DESC, session_id LIMIT 10""", "sessions_12h"))
def _(spark, folder):
    return sessions.recent_sessions(_sessions(spark, folder), 10)


@register("session_facts", statement("""
SELECT s.*, page_views, cart_additions, round(purchase_amount, 9) AS purchase_amount
FROM sessions_12h s JOIN (
  SELECT session_id, count(*) FILTER (event_type = 'view') AS page_views,
         count(*) FILTER (event_type = 'signup') AS cart_additions,
         sum(CASE WHEN event_type = 'purchase' THEN price ELSE 0 END) AS purchase_amount
  FROM assigned_12h GROUP BY session_id) f ON s.session_id = f.session_id""", "sessions_12h"))
def _(spark, folder):
    facts = sessions.session_facts(load_events(spark, folder), GAPS["12h"], PAGE_VIEW, CART, PURCHASE)
    return rounded(facts, purchase_amount=9)


@register("abandoned_carts", statement("SELECT * FROM carts", "carts"))
def _carts(spark, folder):
    return sessions.abandoned_carts(load_events(spark, folder), GAPS["12h"], cart=CART, purchase=PURCHASE)


@register("abandoned_recent", statement("SELECT * FROM carts WHERE time_since_last_activity_minutes <= 1440", "carts"))
def _(spark, folder):
    return sessions.abandoned_recent(_carts(spark, folder), 24)


def _funnel_sql() -> str:
    steps = ["""r0 AS (
SELECT session_id, session_start, min(event_timestamp) AS t0 FROM assigned_12h WHERE event_type = 'view' GROUP BY ALL)"""]
    for i, stage in enumerate(STAGES[1:], 1):
        steps.append(f"""r{i} AS (
SELECT r.session_id, r.session_start, r.t{i - 1} AS since, min(event_timestamp) AS t{i}
FROM r{i - 1} r JOIN assigned_12h a ON a.session_id = r.session_id AND a.event_type = '{stage}' AND a.event_timestamp >= r.t{i - 1}
GROUP BY ALL)""")
    rows = []
    for i, stage in enumerate(STAGES):
        last = i == len(STAGES) - 1
        if last:
            converted, seconds, source = "count(*)", "0", f"r{i} r"
        else:
            converted, seconds = f"count(n.t{i + 1})", f"round(avg((epoch_us(n.t{i + 1}) - epoch_us(n.since))::DOUBLE / 1e6::DOUBLE))"
            source = f"r{i} r LEFT JOIN r{i + 1} n ON n.session_id = r.session_id"
        rows.append(f"""
SELECT date_trunc('hour', r.session_start) AS hour, '{stage}' AS stage, count(*) AS users_entered, {converted} AS users_converted,
       round(100.0::DOUBLE * {converted} / count(*), 2) AS conversion_rate, CAST({seconds} AS BIGINT) AS avg_time_to_next_seconds
FROM {source} GROUP BY hour""")
    whole = statement("", "assigned_12h").rstrip()
    return whole + ",\n" + ",\n".join(steps) + "\nUNION ALL".join(rows)


@register("funnel", _funnel_sql())
def _(spark, folder):
    return sessions.funnel(load_events(spark, folder), STAGES, GAPS["12h"])


_JOURNEYS = """
SELECT s.session_id, any_value(p.path) AS path,
       coalesce(max(seconds) FILTER (channel = 'web'), 0) AS web_seconds,
       coalesce(max(seconds) FILTER (channel = 'app'), 0) AS app_seconds,
       coalesce(max(seconds) FILTER (channel = 'email'), 0) AS email_seconds, bool_or(bought) AS converted
FROM (SELECT session_id, channel, bool_or(event_type = 'purchase') AS bought,
             round(sum(coalesce((epoch_us(next) - epoch_us(event_timestamp))::DOUBLE / 1e6::DOUBLE, 0)), 9) AS seconds
      FROM (SELECT *, lead(event_timestamp) OVER (PARTITION BY session_id ORDER BY event_timestamp, event_id) AS next FROM assigned_12h)
      GROUP BY session_id, channel) s
JOIN (SELECT session_id, string_agg(channel, '>' ORDER BY event_timestamp, event_id) AS path FROM (
        SELECT *, lag(channel) OVER (PARTITION BY session_id ORDER BY event_timestamp, event_id) AS before FROM assigned_12h)
      WHERE before IS NULL OR before <> channel GROUP BY session_id) p ON s.session_id = p.session_id
GROUP BY s.session_id"""


def _journeys(spark, folder):
    return sessions.channel_journeys(load_events(spark, folder), GAPS["12h"], PURCHASE)


@register("channel_journeys", statement(_JOURNEYS, "assigned_12h"))
def _(spark, folder):
    spent = F.col("seconds_per_channel")
    return _journeys(spark, folder).select(
        "session_id", "path",
        *[F.round(F.coalesce(spent[c], F.lit(0.0)), 9).alias(f"{c}_seconds") for c in ("web", "app", "email")],
        "converted",
    )


@register("path_counts", statement(f"""
SELECT path, count(*) AS sessions, count(*) FILTER (converted) AS conversions FROM ({_JOURNEYS}) GROUP BY path""", "assigned_12h"))
def _(spark, folder):
    return sessions.path_counts(_journeys(spark, folder))


@register("journey_steps", statement("""
SELECT session_id, user_id, channel, event_timestamp AS entered_at FROM assigned_12h
WHERE event_timestamp = session_start OR channel <> prev_channel""", "assigned_12h"))
def _(spark, folder):
    return sessions.journey_steps(load_events(spark, folder), GAPS["12h"])


# Late data.


@register("classify_lateness", statement("""
SELECT event_id, watermark, window_start, window_end, lateness_class FROM classed_5m""", "classed_5m"))
def _(spark, folder):
    ev = load_events(spark, folder).select("event_id", "seq", "event_timestamp", "processing_timestamp")
    return late.classify_lateness(ev).select("event_id", "watermark", "window_start", "window_end", "lateness_class")


@register("counts_with_late", statement("SELECT * FROM late_counts", "late_counts"))
def _late_counts(spark, folder):
    return late.counts_with_late(load_events(spark, folder))


@register("late_events", statement("SELECT * FROM late", "late"))
def _late(spark, folder):
    return late.late_events(load_events(spark, folder))


@register("late_event_stats", statement("""
SELECT date_trunc('hour', event_timestamp) AS hour, count(*) AS late_event_count,
       round(avg(lateness_ms / 1000.0::DOUBLE), 9) AS avg_lateness_seconds,
       max(lateness_ms / 1000.0::DOUBLE) AS max_lateness_seconds, min(lateness_ms / 1000.0::DOUBLE) AS min_lateness_seconds,
       round(quantile_cont(lateness_ms, 0.5) / 1000.0::DOUBLE, 9) AS median_lateness_seconds,
       round(quantile_cont(lateness_ms, 0.95) / 1000.0::DOUBLE, 9) AS p95_lateness_seconds
FROM late GROUP BY hour""", "late"))
def _(spark, folder):
    return rounded(
        late.late_event_stats(_late(spark, folder)),
        avg_lateness_seconds=9, median_lateness_seconds=9, p95_lateness_seconds=9,
    )


@register("lateness_histogram", statement("""
SELECT CASE WHEN lateness_ms // 1000 < 60 THEN '<1min' WHEN lateness_ms // 1000 < 300 THEN '1-5min'
            WHEN lateness_ms // 1000 < 600 THEN '5-10min' WHEN lateness_ms // 1000 < 900 THEN '10-15min' ELSE '>15min' END
       AS lateness_bucket, count(*) AS count
FROM late GROUP BY lateness_bucket""", "late"))
def _(spark, folder):
    return late.lateness_histogram(_late(spark, folder))


@register("delay_histogram", statement("""
SELECT CASE WHEN d // 1000 < 60 THEN '<1min' WHEN d // 1000 < 300 THEN '1-5min'
            WHEN d // 1000 < 600 THEN '5-10min' WHEN d // 1000 < 900 THEN '10-15min' ELSE '>15min' END
       AS lateness_bucket, count(*) AS count
FROM (SELECT CAST(floor((epoch_us(processing_timestamp) - epoch_us(event_timestamp)) / 1000) AS BIGINT) AS d FROM ev)
GROUP BY lateness_bucket""", "ev"))
def _(spark, folder):
    ev = load_events(spark, folder).withColumns(late.window_columns("5 minutes"))
    return late.lateness_histogram(ev.select(*late.late_row()))


@register("late_by_type", statement("""
SELECT event_type, count(*) AS late_count, round(avg(lateness_ms / 1000.0::DOUBLE), 9) AS avg_lateness_seconds
FROM late GROUP BY event_type""", "late"))
def _(spark, folder):
    return rounded(late.late_by_type(_late(spark, folder)), avg_lateness_seconds=9)


@register("most_late", statement("SELECT * FROM late ORDER BY lateness_ms DESC, event_id LIMIT 20", "late"))
def _(spark, folder):
    return late.most_late(_late(spark, folder), 20)


@register("late_updates", statement("SELECT * FROM late_counts WHERE is_late_update", "late_counts"))
def _(spark, folder):
    return late.late_updates(_late_counts(spark, folder))


@register("watermark_tuning", statement("""
SELECT d.delay AS delay_minutes, count(*) FILTER (NOT dropped) AS kept, count(*) FILTER (dropped) AS dropped,
       any_value(c.avg_close) AS avg_close_delay_seconds,
       round(count(*) FILTER (NOT dropped)::DOUBLE / count(*), 4) AS accuracy
FROM (SELECT delay, coalesce(newest - to_minutes(delay) >= time_bucket(INTERVAL 5 MINUTE, event_timestamp) + INTERVAL 5 MINUTE, false)
             AS dropped
      FROM seen, (SELECT unnest([1, 5, 30])::BIGINT AS delay)) d
JOIN (SELECT delay, round(avg((epoch_us(closed_at) - epoch_us(we))::DOUBLE / 1e6::DOUBLE), 9) AS avg_close
      FROM (SELECT w.we, delay, min(s.processing_timestamp) AS closed_at
            FROM (SELECT DISTINCT time_bucket(INTERVAL 5 MINUTE, event_timestamp) + INTERVAL 5 MINUTE AS we, delay
                  FROM ev, (SELECT unnest([1, 5, 30])::BIGINT AS delay)) w
            JOIN seen s ON s.event_timestamp >= w.we + to_minutes(delay)
            GROUP BY w.we, delay)
      GROUP BY delay) c ON c.delay = d.delay
GROUP BY d.delay""", "seen"))
def _(spark, folder):
    return rounded(late.watermark_tuning(load_events(spark, folder)), avg_close_delay_seconds=9)


FIRED = """
, w AS (
SELECT window_start, window_end, min(processing_timestamp) + INTERVAL 5 MINUTE AS early_at,
       count(*) FILTER (lateness_class = 'on_time') AS on_time, count(*) FILTER (lateness_class = 'late') AS late,
       max(processing_timestamp) FILTER (lateness_class = 'late') AS last_late
FROM classed_10m WHERE lateness_class <> 'too_late' GROUP BY window_start, window_end),
x AS (
SELECT w.*, (SELECT min(s.processing_timestamp) FROM ev s WHERE s.event_timestamp >= w.window_end + INTERVAL 10 MINUTE) AS closed_at,
       (SELECT count(*) FROM classed_10m c WHERE c.window_start = w.window_start AND c.lateness_class = 'on_time'
          AND c.processing_timestamp <= w.early_at) AS early
FROM w),
fired AS (
SELECT window_start, window_end, early AS count, 'EARLY' AS firing_type, early_at AS emitted_at FROM x
WHERE early > 0 AND (closed_at IS NULL OR early_at < closed_at)
UNION ALL
SELECT window_start, window_end, on_time, 'ON_TIME', closed_at FROM x WHERE on_time > 0 AND closed_at IS NOT NULL
UNION ALL
SELECT window_start, window_end, on_time + late, 'LATE', last_late FROM x WHERE late > 0)"""


@register("firings", statement(FIRED + " SELECT * FROM fired", "classed_10m"))
def _(spark, folder):
    return late.firings(load_events(spark, folder))


@register("lag_monitor", statement("""
SELECT window_start, window_end, round(avg((epoch_us(processing_timestamp) - epoch_us(event_timestamp))::DOUBLE / 1000), 6) AS avg_lag_ms,
       max((epoch_us(processing_timestamp) - epoch_us(event_timestamp))::DOUBLE / 1000) AS max_lag_ms,
       round(100.0::DOUBLE * count(*) FILTER (lateness_class <> 'on_time') / count(*), 2) AS late_rate
FROM classed_5m GROUP BY window_start, window_end""", "classed_5m"))
def _(spark, folder):
    return rounded(late.lag_monitor(load_events(spark, folder)), avg_lag_ms=6)


@register("lag_spikes", statement("""
, m AS (
SELECT window_start, window_end, round(avg((epoch_us(processing_timestamp) - epoch_us(event_timestamp))::DOUBLE / 1000)) AS avg_lag_ms
FROM classed_5m GROUP BY window_start, window_end)
SELECT c.window_start, c.window_end, c.avg_lag_ms, round(avg(b.avg_lag_ms), 6) AS baseline,
       coalesce(c.avg_lag_ms > 2.0::DOUBLE * round(avg(b.avg_lag_ms), 6), false) AS is_anomaly
FROM m c LEFT JOIN m b ON b.window_start BETWEEN c.window_start - INTERVAL 60 MINUTE AND c.window_start - INTERVAL 1 MINUTE
GROUP BY c.window_start, c.window_end, c.avg_lag_ms""", "classed_5m"))
def _(spark, folder):
    return late.lag_spikes(late.lag_monitor(load_events(spark, folder)), 2.0)
