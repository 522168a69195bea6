"""Queries that run as streams over the given tables, and return what the stream wrote.

They use the operators of the batch queries. In append mode a window is final, and written, once
the watermark (10 minutes behind the newest event) has passed its end; so says the checking SQL.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventide.catalog.journeys import FIRED
from eventide.catalog.registry import register, rounded
from eventide.catalog.reports import SCHEMA, clicks_and_profiles
from eventide.catalog.sql import statement
from eventide.operators import anomalies, joins, rows, sessions, windows
from eventide.session import scratch_folder
from eventide.sinks import tables
from eventide.sinks.tables import ForeachBatch
from eventide.sources import ingest
from eventide.sources.events import CART, CLICK, PAGE_VIEW, PURCHASE, load_events, stream_events
from eventide.sources.messages import message_log
from eventide.streaming import alerts, blocks, closed, firings, ledger, run, stateful


def _final(event_type: str | None = None) -> str:
    # Spark applies a filter on the event type before the watermark, which then follows that type.
    only = f" WHERE event_type = '{event_type}'" if event_type else ""
    return f"WHERE window_end <= (SELECT max(event_timestamp) FROM ev{only}) - INTERVAL 10 MINUTE"


def _appended(df: DataFrame) -> DataFrame:
    """Run a stream over all there is into a parquet table and read it back."""
    spark = df.sparkSession
    folder = scratch_folder(spark, "append")
    run.append_sink(df, f"{folder}/rows", f"{folder}/state", every=None).awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{folder}/rows")


def _watermarked(spark: SparkSession, folder: str) -> DataFrame:
    return rows.with_watermark(stream_events(spark, folder), "10 minutes")


def _delivered(df: DataFrame) -> str:
    """Rows written to a new folder, as a producer or an earlier job would leave them."""
    out = scratch_folder(df.sparkSession, "delivered")
    df.write.parquet(out)
    return out


@register("stream_ingest", statement("""
SELECT time_bucket(INTERVAL 5 MINUTE, moment) AS window_start, time_bucket(INTERVAL 5 MINUTE, moment) + INTERVAL 5 MINUTE AS window_end,
       event_type, count(*) AS count
FROM (SELECT *, make_timestamp("timestamp" * 1000) AS moment FROM decoded WHERE kind NOT IN (0, 1, 2, 3, 5))
WHERE time_bucket(INTERVAL 5 MINUTE, moment) + INTERVAL 5 MINUTE
      <= (SELECT make_timestamp(max("timestamp") * 1000) FROM decoded WHERE kind NOT IN (0, 1, 2, 3, 5)) - INTERVAL 10 MINUTE
GROUP BY ALL""", "decoded"))
def _(spark, folder):
    # Messages to counts: source, decoding, event time, watermark, window.
    log = _delivered(message_log(load_events(spark, folder)))
    events = ingest.valid_events(ingest.read_events(spark, log, "parquet"), SCHEMA)
    return _appended(windows.tumbling_count(rows.with_watermark(rows.with_event_time(events))))


@register("stream_quarantine", statement("""
SELECT seq AS "offset", CASE WHEN kind IN (0, 3, 5) THEN 'undecodable' WHEN kind = 1 THEN 'no user_id' ELSE 'no timestamp' END AS reason
FROM messages WHERE kind IN (0, 1, 2, 3, 5)""", "messages"))
def _(spark, folder):
    out = scratch_folder(spark, "quarantine")
    log = _delivered(message_log(load_events(spark, folder)))
    bad = ingest.quarantine(ingest.read_events(spark, log, "parquet"), SCHEMA, "offset").select("offset", "reason")
    run.batch_sink(bad, tables.append_rows(f"{out}/rows"), f"{out}/state", every=None).awaitTermination()
    return spark.read.parquet(f"{out}/rows").select("offset", "reason")


@register("stream_two_queries", statement(f"""
SELECT 'event_type' AS kind, window_start, window_end, event_type AS key, count FROM counts {_final()}
UNION ALL
SELECT 'page_url', window_start, window_end, page_url, count FROM views {_final(PAGE_VIEW)}""", "counts", "views"))
def _(spark, folder):
    # Two queries off one source, running side by side.
    out, ev = scratch_folder(spark, "pair"), _watermarked(spark, folder)
    both = {"event_type": windows.tumbling_count(ev), "page_url": windows.page_views(ev, PAGE_VIEW)}
    started = [run.append_sink(df, f"{out}/{k}", f"{out}/state-{k}", every=None) for k, df in both.items()]
    while any(q.isActive for q in started):
        run.await_any(spark, 60)
        spark.streams.resetTerminated()
    for query in started:
        query.awaitTermination()
    read = [
        spark.read.schema(df.schema).parquet(f"{out}/{k}").select(
            F.lit(k).alias("kind"), "window_start", "window_end", F.col(k).alias("key"), "count"
        )
        for k, df in both.items()
    ]
    return read[0].unionByName(read[1])


@register("stream_memory_sink", statement("SELECT event_type, count(*) AS count FROM ev GROUP BY event_type", "ev"))
def _(spark, folder):
    # The memory sink is for small results: here one row per event type.
    totals = stream_events(spark, folder).groupBy("event_type").count()
    name = f"totals_{uuid.uuid4().hex}"
    run.memory_sink(totals, name, "complete").awaitTermination()
    return spark.table(name)


@register("partitioned_write", statement("""
SELECT window_start, window_end, event_type, count, CAST(window_start AS DATE) AS date FROM counts""", "counts"))
def _(spark, folder):
    # A table by day, read back whole; a filter on the day would read that day's folder only.
    out = scratch_folder(spark, "by-day")
    tables.partitioned_write(windows.tumbling_count(load_events(spark, folder)), out)
    return ingest.read_table(spark, out)


@register("watermark", statement("SELECT date_trunc('millisecond', max(event_timestamp) - INTERVAL 10 MINUTE) AS watermark FROM ev", "ev"))
def _(spark, folder):
    # What the engine itself reports as the watermark once a stream has read everything.
    out = scratch_folder(spark, "watermark")
    query = run.append_sink(windows.tumbling_count(_watermarked(spark, folder)), f"{out}/rows", f"{out}/state", every=None)
    query.awaitTermination()
    newest = max(p["eventTime"]["watermark"] for p in query.recentProgress if "watermark" in p.get("eventTime", {}))
    return spark.range(1).select(F.lit(newest).cast("timestamp").alias("watermark"))


@register("stream_tumbling_count", statement(f"SELECT * FROM counts {_final()}", "counts"))
def _(spark, folder):
    return _appended(windows.tumbling_count(_watermarked(spark, folder)))


@register("stream_page_views", statement(f"SELECT * FROM views {_final(PAGE_VIEW)}", "views"))
def _(spark, folder):
    return _appended(windows.page_views(_watermarked(spark, folder), PAGE_VIEW))


@register("stream_sliding_count", statement(f"SELECT * FROM by_user {_final()}", "by_user"))
def _(spark, folder):
    return _appended(windows.sliding_count(_watermarked(spark, folder)))


@register("stream_sliding_rate", statement(f"SELECT * FROM rates {_final(CLICK)}", "rates"))
def _(spark, folder):
    return _appended(windows.sliding_rate(_watermarked(spark, folder), CLICK))


@register("stream_sliding_avg", statement(f"""
SELECT window_start, window_end, user_id, round(avg_value, 6) AS avg_value FROM (
  SELECT time_bucket(INTERVAL 5 MINUTE, event_timestamp) - to_minutes(5 * i) AS window_start,
         time_bucket(INTERVAL 5 MINUTE, event_timestamp) - to_minutes(5 * i) + INTERVAL 10 MINUTE AS window_end, user_id, avg(price) AS avg_value
  FROM ev, range(2) t(i) GROUP BY ALL) {_final()}""", "ev"))
def _(spark, folder):
    return rounded(_appended(windows.sliding_avg(_watermarked(spark, folder), "price")), avg_value=6)


@register("stream_conversion_rate", statement(f"""
SELECT * FROM (
  SELECT time_bucket(INTERVAL 5 MINUTE, event_timestamp) - to_minutes(5 * i) AS window_start,
         time_bucket(INTERVAL 5 MINUTE, event_timestamp) - to_minutes(5 * i) + INTERVAL 1 HOUR AS window_end,
         count(*) AS total, count(*) FILTER (event_type = 'purchase') AS conversions,
         round(100.0::DOUBLE * count(*) FILTER (event_type = 'purchase') / count(*), 2) AS rate
  FROM ev, range(12) t(i) GROUP BY window_start, window_end) {_final()}""", "ev"))
def _(spark, folder):
    return _appended(windows.conversion_rate(_watermarked(spark, folder), PURCHASE))


@register("stream_active_sessions", statement(f"""
SELECT * FROM (
  SELECT time_bucket(INTERVAL 5 MINUTE, event_timestamp) AS window_start,
         time_bucket(INTERVAL 5 MINUTE, event_timestamp) + INTERVAL 5 MINUTE AS window_end, count(DISTINCT user_id) AS active
  FROM ev GROUP BY ALL) {_final()}""", "ev"))
def _(spark, folder):
    # Exact: two windows in a row, the second over the time of the first.
    return _appended(windows.active_sessions(_watermarked(spark, folder)))


@register("stream_split", statement("""
SELECT CASE WHEN kind IN (0, 3, 5) THEN 'undecodable' WHEN kind = 1 THEN 'no user_id' WHEN kind = 2 THEN 'no timestamp' ELSE 'valid' END AS outcome,
       count(*) AS count
FROM messages GROUP BY ALL""", "messages"))
def _(spark, folder):
    # Valid events and quarantine from one pass over the messages.
    out = scratch_folder(spark, "split")
    raw = ingest.read_events(spark, _delivered(message_log(load_events(spark, folder))), "parquet")
    sink = ingest.split_sink(SCHEMA, f"{out}/good", f"{out}/bad", "offset")
    run.batch_sink(raw, sink, f"{out}/state", every=None).awaitTermination()
    bad = spark.read.parquet(f"{out}/bad").select(F.col("reason").alias("outcome"))
    good = spark.read.parquet(f"{out}/good").select(F.lit("valid").alias("outcome"))
    return good.unionByName(bad).groupBy("outcome").count()


@register("stream_sessions", statement("""
SELECT * FROM sessions_30m WHERE closes_at <= (SELECT max(event_timestamp) FROM ev) - INTERVAL 10 MINUTE""", "sessions_30m"))
def _(spark, folder):
    return _appended(sessions.session_metrics_stream(_watermarked(spark, folder)))


@register("stream_window_tags", statement("""
SELECT event_id, time_bucket(INTERVAL 5 MINUTE, event_timestamp) AS event_timestamp_start,
       time_bucket(INTERVAL 5 MINUTE, event_timestamp) + INTERVAL 5 MINUTE AS event_timestamp_end
FROM ev""", "ev"))
def _(spark, folder):
    tagged = rows.with_window(stream_events(spark, folder))
    return _appended(tagged.select("event_id", "event_timestamp_start", "event_timestamp_end"))


@register("stream_dedup", statement("SELECT event_id, event_timestamp, event_type FROM ev", "ev"))
def _(spark, folder):
    twice = stream_events(spark, folder).unionByName(stream_events(spark, folder))
    once = rows.dedup_events(rows.with_watermark(twice, "10 minutes"))
    return _appended(once.select("event_id", "event_timestamp", "event_type"))


@register("stream_interval_join", statement("""
SELECT event_id, c.user_id, event_timestamp, profile_ts, profile_value
FROM clicks c JOIN profiles p ON c.user_id = p.user_id
 AND profile_ts BETWEEN event_timestamp - INTERVAL 6 HOUR AND event_timestamp""", "clicks", "profiles"))
def _(spark, folder):
    clicks, _unused = clicks_and_profiles(stream_events(spark, folder))
    _unused, profiles = clicks_and_profiles(stream_events(spark, folder))
    clicks, profiles = clicks.withWatermark("event_timestamp", "10 minutes"), profiles.withWatermark("profile_ts", "10 minutes")
    return _appended(joins.interval_join(clicks, profiles, "user_id", "event_timestamp", "profile_ts", "6 hours"))


@register("stream_count_windows", statement("""
SELECT user_id, block, count(*) AS count, min(event_timestamp) AS first_ts, max(event_timestamp) AS last_ts
FROM (SELECT *, (row_number() OVER (PARTITION BY user_id ORDER BY processing_timestamp, seq) - 1) // 10 AS block FROM ev)
GROUP BY user_id, block HAVING count(*) = 10""", "ev"))
def _(spark, folder):
    out = _deliveries(spark, folder, lambda path: blocks.count_blocks(path, "user_id", 10))
    return blocks.full_blocks(spark, out)


@register("stream_abandoned_carts", statement("""
SELECT session_id, user_id, max(event_timestamp) AS last_activity, count(*) FILTER (event_type = 'signup') AS items_added,
       60::BIGINT AS time_since_last_activity_minutes, true AS alert_sent
FROM assigned_30m GROUP BY session_id, user_id
HAVING count(*) FILTER (event_type = 'signup') > 0 AND count(*) FILTER (event_type = 'purchase') = 0
   AND max(event_timestamp) <= (SELECT max(event_timestamp) FROM ev) - INTERVAL 70 MINUTE""", "assigned_30m"))
def _(spark, folder):
    ev = stream_events(spark, folder)
    return _appended(stateful.abandoned_carts_stream(ev, cart=CART, purchase=PURCHASE))


@register("stream_complete_counts", statement("SELECT * FROM counts", "counts"))
def _(spark, folder):
    out = scratch_folder(spark, "complete")
    counts = windows.tumbling_count(stream_events(spark, folder))
    run.complete_sink(counts, f"{out}/table", f"{out}/state", every=None).awaitTermination()
    return run.read_complete(spark, f"{out}/table")


@register("stream_upsert_log", statement("SELECT * FROM counts", "counts"))
def _(spark, folder):
    out = scratch_folder(spark, "upsert")
    counts = windows.tumbling_count(stream_events(spark, folder))
    run.batch_sink(counts, tables.upsert_log_sink(f"{out}/log"), f"{out}/state", "update", every=None).awaitTermination()
    log = spark.read.parquet(f"{out}/log")
    return tables.fold_upserts(log, ["window_start", "event_type"], ["window_end", "count"]).select(*counts.columns)


# The month arrives in three deliveries of ten days each. The stream is started anew for each, from its
# checkpoint, and takes it as one micro-batch.
DAYS, DELIVERIES = 10, 3
_CHUNKED = """
, cut AS (SELECT *, least(CAST(floor((epoch(processing_timestamp) - epoch(TIMESTAMP '2024-01-01'))::DOUBLE / 864000) AS INTEGER), 2)
          AS chunk FROM ev)"""


def _deliveries(
    spark: SparkSession, folder: str, sink: Callable[[str], ForeachBatch], build: Callable[[DataFrame], DataFrame] = lambda s: s
) -> str:
    """The folder of a foreach-batch sink after the month's events came in three deliveries, with a restart before each."""
    out = scratch_folder(spark, "deliveries")
    ev = load_events(spark, folder)
    day = F.datediff(F.to_date("processing_timestamp"), F.lit("2024-01-01").cast("date"))
    delivery = F.least(F.floor(day / DAYS).cast("int"), F.lit(DELIVERIES - 1))
    for i in range(DELIVERIES):
        ev.where(delivery == i).write.mode("append").parquet(f"{out}/arrivals")
        arrivals = spark.readStream.schema(ev.schema).parquet(f"{out}/arrivals")
        run.batch_sink(build(arrivals), sink(out), f"{out}/state", every=None).awaitTermination()
    return out


# The watermark goes on from delivery to delivery, so what the three give is what the whole month gives.
@register("stream_counts_with_late", statement("SELECT * FROM late_counts", "late_counts"))
def _(spark, folder):
    return ledger.ledger_counts(spark, _deliveries(spark, folder, ledger.late_ledger))


@register("stream_late_events", statement("SELECT * FROM late", "late"))
def _(spark, folder):
    return ledger.ledger_late_events(spark, _deliveries(spark, folder, ledger.late_ledger))


@register("stream_firings", statement(FIRED + """
SELECT * FROM fired WHERE firing_type <> 'EARLY' OR emitted_at < (SELECT max(processing_timestamp) FROM ev)""", "classed_10m"))
def _(spark, folder):
    # An early firing waits for an arrival after its time; the last windows have none.
    return firings.last_firings(spark, _deliveries(spark, folder, firings.firing_sink))


@register("stream_rate_anomaly", statement(_CHUNKED + """,
before AS (SELECT chunk, max(max(event_timestamp)) OVER (ORDER BY chunk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest
           FROM cut WHERE event_type = 'click' GROUP BY chunk),
counted AS (SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, round(count(*) / 5.0::DOUBLE, 2) AS clicks_per_minute
            FROM (SELECT chunk, time_bucket(INTERVAL 1 MINUTE, event_timestamp) - to_minutes(i) AS window_start
                  FROM cut, range(5) t(i) WHERE event_type = 'click') JOIN before USING (chunk)
            WHERE newest IS NULL OR window_start + INTERVAL 5 MINUTE > newest - INTERVAL 10 MINUTE GROUP BY window_start),
closed AS (SELECT * FROM counted WHERE window_end <= (SELECT max(event_timestamp) FROM cut WHERE event_type = 'click') - INTERVAL 10 MINUTE)
SELECT c.window_start, c.window_end, c.clicks_per_minute, round(avg(b.clicks_per_minute), 6) AS baseline,
       coalesce(c.clicks_per_minute > 2.0::DOUBLE * round(avg(b.clicks_per_minute), 6), false) AS is_anomaly
FROM closed c LEFT JOIN closed b ON b.window_start BETWEEN c.window_start - INTERVAL 60 MINUTE AND c.window_start - INTERVAL 1 MINUTE
GROUP BY c.window_start, c.window_end, c.clicks_per_minute""", "ev"))
def _(spark, folder):
    # Late clicks of a delivery whose window the one before has closed are dropped by the watermark.
    rates = lambda s: windows.sliding_rate(rows.with_watermark(s, "10 minutes"), CLICK)
    out = _deliveries(spark, folder, lambda path: alerts.alerts_sink(path, anomalies.rate_anomaly), rates)
    return alerts.alert_rows(spark, out)


# Views of a delivery whose window the one before has closed are dropped by the watermark.
_CLOSED_VIEWS = _CHUNKED + """,
before AS (SELECT chunk, max(max(event_timestamp)) OVER (ORDER BY chunk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest
           FROM cut WHERE event_type = 'view' GROUP BY chunk),
closed AS (SELECT * FROM (
  SELECT time_bucket(INTERVAL 5 MINUTE, event_timestamp) AS window_start,
         time_bucket(INTERVAL 5 MINUTE, event_timestamp) + INTERVAL 5 MINUTE AS window_end, page_url, count(*) AS count
  FROM cut JOIN before USING (chunk)
  WHERE event_type = 'view' AND (newest IS NULL OR time_bucket(INTERVAL 5 MINUTE, event_timestamp) + INTERVAL 5 MINUTE > newest - INTERVAL 10 MINUTE)
  GROUP BY ALL)
  WHERE window_end <= (SELECT max(event_timestamp) FROM cut WHERE event_type = 'view') - INTERVAL 10 MINUTE)"""


def _closed_views(spark: SparkSession, folder: str, report: Callable[[DataFrame], DataFrame]) -> str:
    views = lambda s: windows.page_views(rows.with_watermark(s, "10 minutes"), PAGE_VIEW)
    return _deliveries(spark, folder, lambda path: closed.closed_windows_sink(path, report), views)


@register("stream_top_n", statement(_CLOSED_VIEWS + """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY count DESC, page_url) AS rank FROM closed)
WHERE rank <= 10""", "ev"))
def _(spark, folder):
    return closed.closed_windows(spark, _closed_views(spark, folder, windows.top_n_per_window))


@register("stream_top_pages_latest", statement(_CLOSED_VIEWS + """
SELECT *, rank() OVER (PARTITION BY window_start ORDER BY count DESC) AS rank FROM closed
WHERE window_start = (SELECT max(window_start) FROM closed) ORDER BY rank, page_url LIMIT 10""", "ev"))
def _(spark, folder):
    return closed.newest_closed(spark, _closed_views(spark, folder, windows.top_pages_latest))


# The oldest profile that the join still holds for a click is 6 hours older; a click is final when the watermark is past that.
@register("stream_asof_join", statement("""
SELECT c.event_id, c.user_id, c.event_timestamp,
       CASE WHEN p.profile_ts >= c.event_timestamp - INTERVAL 6 HOUR THEN p.profile_ts END AS profile_ts,
       CASE WHEN p.profile_ts >= c.event_timestamp - INTERVAL 6 HOUR THEN p.profile_value END AS profile_value
FROM clicks c ASOF LEFT JOIN profiles p ON c.user_id = p.user_id AND c.event_timestamp >= p.profile_ts
WHERE c.event_timestamp < least((SELECT max(event_timestamp) FROM clicks), (SELECT max(profile_ts) FROM profiles)) - INTERVAL 370 MINUTE""", "clicks", "profiles"))
def _(spark, folder):
    clicks, _unused = clicks_and_profiles(stream_events(spark, folder))
    _unused, profiles = clicks_and_profiles(stream_events(spark, folder))
    clicks, profiles = clicks.withWatermark("event_timestamp", "10 minutes"), profiles.withWatermark("profile_ts", "10 minutes")
    return _appended(joins.asof_join_stream(clicks, profiles, "user_id", "event_timestamp", "profile_ts", "6 hours"))
