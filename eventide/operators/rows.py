"""Row-level operators: event time, watermark, window tags, enrichment, filters, arrival delay."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from eventide.functions.timing import duration_micros, iso_instant, plus, window_bounds
from eventide.plans.ordered import Running, ordered_runs, running

ARRIVAL = ("processing_timestamp", "seq")


def with_event_time(ev: DataFrame, millis: str = "timestamp") -> DataFrame:
    return ev.withColumn("event_timestamp", F.timestamp_millis(F.col(millis)))


def with_watermark(ev: DataFrame, delay: str = "10 minutes") -> DataFrame:
    return ev.withWatermark("event_timestamp", delay)


def with_window(ev: DataFrame, size: str = "5 minutes") -> DataFrame:
    """Tag each event with its tumbling window; rows without event time belong to none and go."""
    start, end = window_bounds(F.col("event_timestamp"), size)
    return (
        ev.where(F.col("event_timestamp").isNotNull())
        .withColumn("event_timestamp_start", start)
        .withColumn("event_timestamp_end", end)
    )


def enrich_iso(ev: DataFrame, now: Column | None = None) -> DataFrame:
    """Event time and the bounds ``now .. now + 60 s`` as ISO-8601 text; pass ``now`` to fix the clock."""
    now = F.current_timestamp() if now is None else now
    return (
        ev.withColumn("event_timestamp", iso_instant(F.col("event_timestamp")))
        .withColumn("event_timestamp_start", iso_instant(now))
        .withColumn("event_timestamp_end", iso_instant(plus(now, duration_micros("60 seconds"))))
    )


def only_type(ev: DataFrame, event_type: str) -> DataFrame:
    return ev.where(F.col("event_type") == event_type)


def recent(df: DataFrame, column: str, as_of: Column, span: str = "1 hour") -> DataFrame:
    return df.where(F.col(column) >= plus(as_of, -duration_micros(span)))


def _delay_ms() -> Column:
    delay = F.unix_micros("processing_timestamp") - F.unix_micros("event_timestamp")
    return F.floor(delay / 1000).cast("long")


def arrival_delay(ev: DataFrame, arrival: Sequence[str] = ARRIVAL) -> DataFrame:
    """Delay per event, and whether an event of later event time had arrived before it."""
    narrow = ev.select("event_id", "event_timestamp", *arrival)
    seen = running(
        ordered_runs(narrow, [], arrival),
        [],
        arrival,
        newest=Running("max", F.col("event_timestamp"), inclusive=False),
    )
    behind = F.coalesce(F.col("event_timestamp") < F.col("newest"), F.lit(False))
    return seen.select("event_id", _delay_ms().alias("delay_ms"), behind.alias("out_of_order"))


def delay_summary(ev: DataFrame) -> DataFrame:
    delay = _delay_ms()
    return ev.agg(
        F.avg(delay).alias("avg_ms"),
        F.max(delay).alias("max_ms"),
        F.count_if(delay > 60_000).alias("over_1min"),
    )


def dedup_events(ev: DataFrame, arrival: Sequence[str] = ARRIVAL) -> DataFrame:
    """One row per (event_id, event time). Batch keeps the first to arrive; a stream keeps the
    first it sees and forgets ids once the watermark has passed them."""
    if ev.isStreaming:
        return ev.dropDuplicatesWithinWatermark(["event_id", "event_timestamp"])
    keys = ["event_id", "event_timestamp"]
    rest = [c for c in ev.columns if c not in keys]
    first = F.min(F.struct(*arrival, *[c for c in rest if c not in arrival])).alias("_row")
    return ev.groupBy(*keys).agg(first).select(
        *[c if c in keys else F.col("_row")[c].alias(c) for c in ev.columns]
    )
