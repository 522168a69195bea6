"""Late data: watermark per arrival, allowed lateness, too-late events, statistics, tuning.

The watermark before an event is the newest event time among the events that arrived earlier, minus
the tolerated disorder. It is a running maximum over the whole table in arrival order, computed on
runs (see ``eventide.plans.ordered``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from eventide.functions.quantile import exact_percentiles
from eventide.functions.timing import duration_micros, percent, plus, slot, window_bounds
from eventide.operators.anomalies import rate_anomaly
from eventide.operators.rows import ARRIVAL
from eventide.plans.ordered import Running, ordered_runs, running

OUT_OF_ORDER, LATENESS, SIZE = "10 minutes", "5 minutes", "5 minutes"
REASON = "Arrived after allowed lateness"  # fixed value
ON_TIME, LATE, TOO_LATE = "on_time", "late", "too_late"


def with_newest(ev: DataFrame, arrival: Sequence[str] = ARRIVAL, before: Column | None = None) -> DataFrame:
    """Add ``_newest``: the newest event time among the events that arrived before. ``before`` is that of all events that arrived
    before the first of ``ev``; with it, parts of a table one after the other give what the whole table gives."""
    known = ev.where(F.col("event_timestamp").isNotNull())
    newest = Running("max", F.col("event_timestamp"), inclusive=False)
    found = running(ordered_runs(known, [], arrival), [], arrival, _newest=newest).drop("_run")
    return found if before is None else found.withColumn("_newest", F.greatest("_newest", before))


def window_columns(size: str) -> dict[str, Column]:
    start, end = window_bounds(F.col("event_timestamp"), size)
    return {"window_start": start, "window_end": end}


def lateness_class(watermark: Column, window_end: Column, lateness: str) -> Column:
    return (
        F.when(watermark >= plus(window_end, duration_micros(lateness)), TOO_LATE)
        .when(watermark >= window_end, LATE)
        .otherwise(ON_TIME)
    )


def classify_lateness(
    ev: DataFrame, ooo: str = OUT_OF_ORDER, lateness: str = LATENESS, size: str = SIZE,
    arrival: Sequence[str] = ARRIVAL, before: Column | None = None,
) -> DataFrame:
    return (
        with_newest(ev, arrival, before)
        .withColumn("watermark", plus(F.col("_newest"), -duration_micros(ooo)))
        .withColumns(window_columns(size))
        .withColumn("lateness_class", lateness_class(F.col("watermark"), F.col("window_end"), lateness))
        .drop("_newest")
    )


def late_update(on_time: Column, late: Column) -> Column:
    """A count was changed after it was first emitted: a late event after an on-time firing, or a
    second late event where the first one fired the window."""
    return ((on_time > 0) & (late > 0)) | ((on_time == 0) & (late > 1))


def count_by_class(classified: DataFrame, key: str = "event_type") -> DataFrame:
    kind = F.col("lateness_class")
    return classified.where(kind != TOO_LATE).groupBy("window_start", "window_end", key).agg(
        F.count_if(kind == ON_TIME).alias("on_time_n"), F.count_if(kind == LATE).alias("late_n")
    )


def final_counts(by_class: DataFrame, key: str = "event_type") -> DataFrame:
    return by_class.select(
        "window_start", "window_end", key,
        (F.col("on_time_n") + F.col("late_n")).alias("count"),
        late_update(F.col("on_time_n"), F.col("late_n")).alias("is_late_update"),
    )


def counts_with_late(
    ev: DataFrame, ooo: str = OUT_OF_ORDER, lateness: str = LATENESS, size: str = SIZE,
    key: str = "event_type", arrival: Sequence[str] = ARRIVAL,
) -> DataFrame:
    narrow = ev.select("event_timestamp", key, *arrival)
    return final_counts(count_by_class(classify_lateness(narrow, ooo, lateness, size, arrival), key), key)


def late_row() -> list[Column]:
    """The late table's columns from a classified event."""
    lateness = F.floor((F.unix_micros("processing_timestamp") - F.unix_micros("event_timestamp")) / 1000)
    return [
        F.col("event_id"), F.col("event_type"), F.col("event_timestamp"), F.col("processing_timestamp"),
        lateness.cast("long").alias("lateness_ms"), F.col("window_start"), F.col("window_end"),
        F.lit(REASON).alias("reason"),
    ]


def late_events(
    ev: DataFrame, ooo: str = OUT_OF_ORDER, lateness: str = LATENESS, size: str = SIZE,
    arrival: Sequence[str] = ARRIVAL,
) -> DataFrame:
    needed = dict.fromkeys(["event_id", "event_type", "event_timestamp", "processing_timestamp", *arrival])
    classified = classify_lateness(ev.select(*needed), ooo, lateness, size, arrival)
    return classified.where(F.col("lateness_class") == TOO_LATE).select(*late_row())


# Reports over the late table.


def late_event_stats(late: DataFrame) -> DataFrame:
    hourly = late.withColumn("hour", F.date_trunc("hour", "event_timestamp"))
    seconds = F.col("lateness_ms") / F.lit(1000.0)
    basic = hourly.groupBy("hour").agg(
        F.count(F.lit(1)).alias("late_event_count"),
        F.avg(seconds).alias("avg_lateness_seconds"),
        F.max(seconds).alias("max_lateness_seconds"),
        F.min(seconds).alias("min_lateness_seconds"),
    )
    quantiles = exact_percentiles(hourly, ["hour"], "lateness_ms", _median=0.5, _p95=0.95)
    return basic.join(quantiles, "hour").select(
        *basic.columns,
        (F.col("_median") / F.lit(1000.0)).alias("median_lateness_seconds"),
        (F.col("_p95") / F.lit(1000.0)).alias("p95_lateness_seconds"),
    ).orderBy(F.desc("hour"))


def lateness_histogram(late: DataFrame) -> DataFrame:
    whole_seconds = F.floor(F.col("lateness_ms") / 1000)
    bucket = (
        F.when(whole_seconds < 60, "<1min").when(whole_seconds < 300, "1-5min").when(whole_seconds < 600, "5-10min")
        .when(whole_seconds < 900, "10-15min").otherwise(">15min")
    )
    return late.groupBy(bucket.alias("lateness_bucket")).count().orderBy("lateness_bucket")


def late_by_type(late: DataFrame) -> DataFrame:
    return late.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("late_count"), F.avg(F.col("lateness_ms") / F.lit(1000.0)).alias("avg_lateness_seconds")
    ).orderBy(F.desc("late_count"))


def most_late(late: DataFrame, n: int = 20) -> DataFrame:
    return late.orderBy(F.desc("lateness_ms"), "event_id").limit(n)


def late_updates(counts: DataFrame) -> DataFrame:
    return counts.where("is_late_update")


# When windows close.


def closing_times(seen: DataFrame, targets: DataFrame) -> DataFrame:
    """For each ``_target`` the arrival of the first event that lifts the newest event time to it.

    ``seen`` has (event_timestamp, _newest, processing_timestamp). Only events that raise the newest
    time matter. Going down in value, the earliest arrival met so far is the first to reach the
    value; one running minimum serves all targets, without an inequality join.
    """
    raises = F.col("_newest").isNull() | (F.col("event_timestamp") > F.col("_newest"))
    value = lambda ts: (-F.unix_micros(ts)).alias("_falling")
    steps = seen.where(raises).select(
        value("event_timestamp"), F.lit(0).alias("_kind"), F.col("processing_timestamp").alias("_arrived")
    )
    wanted = targets.select(value("_target"), F.lit(1).alias("_kind"), *targets.columns)
    both = steps.unionByName(wanted, allowMissingColumns=True)
    order = ["_falling", "_kind"]
    met = running(ordered_runs(both, [], order), [], order, closed_at=Running("min", F.col("_arrived")))
    return met.where(F.col("_kind") == 1).select(*[c for c in targets.columns if c != "_target"], "closed_at")


def watermark_tuning(
    ev: DataFrame, delays: Sequence[int] = (1, 5, 30), size: str = SIZE, arrival: Sequence[str] = ARRIVAL
) -> DataFrame:
    """What each watermark delay (minutes) would keep and drop without allowed lateness, how long
    after its end a window closes on average, and the share of events kept."""
    minute = duration_micros("1 minute")
    seen = with_newest(ev.select("event_timestamp", *arrival), arrival).withColumns(window_columns(size)).checkpoint()
    dropped = [
        F.count_if(F.coalesce(plus(F.col("_newest"), -d * minute) >= F.col("window_end"), F.lit(False))).alias(f"_dropped_{d}")
        for d in delays
    ]
    totals = seen.agg(F.count(F.lit(1)).alias("_all"), *dropped)
    per_delay = totals.select(
        "_all", F.inline(F.array(*[
            F.struct(F.lit(d).cast("long").alias("delay_minutes"), F.col(f"_dropped_{d}").alias("dropped")) for d in delays
        ]))
    )
    ends = seen.select("window_end").distinct()
    each = F.explode(F.array(*[F.lit(d).cast("long") for d in delays])).alias("delay_minutes")
    targets = ends.select("window_end", each)
    targets = targets.withColumn("_target", plus(F.col("window_end"), F.col("delay_minutes") * minute))
    waits = closing_times(seen, targets).where(F.col("closed_at").isNotNull())
    wait = (F.unix_micros("closed_at") - F.unix_micros("window_end")) / F.lit(1e6)
    closing = waits.groupBy("delay_minutes").agg(F.avg(wait).alias("avg_close_delay_seconds"))
    kept = F.col("_all") - F.col("dropped")
    return per_delay.join(closing, "delay_minutes", "left").select(
        "delay_minutes", kept.alias("kept"), "dropped", "avg_close_delay_seconds",
        F.round(kept / F.col("_all"), 4).alias("accuracy"),
    )


def counted_early(on_time: DataFrame, windows: DataFrame, early: str) -> DataFrame:
    """(window_start, _early): events that arrived up to ``early`` after their window's ``_first``, its first arrival.

    The early interval touches two arrival slots of its own length. Joining on them too leaves the rest of a heavy
    window's events out, and the counts are partially aggregated after the join.
    """
    wait, arrived = duration_micros(early), F.col("processing_timestamp")
    first_slot = slot(F.col("_first"), wait)
    spans = windows.select("window_start", "_first", F.explode(F.array(first_slot, first_slot + wait)).alias("_slot"))
    met = on_time.select("window_start", "processing_timestamp", slot(arrived, wait).alias("_slot")).join(spans, ["window_start", "_slot"])
    return met.where(arrived <= plus(F.col("_first"), wait)).groupBy("window_start").agg(F.count(F.lit(1)).alias("_early"))


def firings(
    ev: DataFrame, size: str = "10 minutes", early: str = "5 minutes", ooo: str = OUT_OF_ORDER,
    lateness: str = LATENESS, arrival: Sequence[str] = ARRIVAL,
) -> DataFrame:
    """EARLY, ON_TIME and LATE results of each window.

    EARLY: ``early`` after the window's first arrival, with what has arrived by then, if the window
    is still open. ON_TIME: when the watermark passes the window's end. LATE: the count after the
    last late event, at its arrival. A window the watermark never passes has no ON_TIME row.
    """
    seen = with_newest(ev.select("event_timestamp", *arrival), arrival).withColumns(window_columns(size))
    mark = plus(F.col("_newest"), -duration_micros(ooo))
    seen = seen.withColumn("_class", lateness_class(mark, F.col("window_end"), lateness)).checkpoint()

    arrived, kind = F.col("processing_timestamp"), F.col("_class")
    windows = seen.where(kind != TOO_LATE).groupBy("window_start", "window_end").agg(
        F.min(arrived).alias("_first"),
        F.count_if(kind == ON_TIME).alias("_on_time"),
        F.count_if(kind == LATE).alias("_late"),
        F.max(F.when(kind == LATE, arrived)).alias("_last_late"),
    ).withColumn("_early_at", plus(F.col("_first"), duration_micros(early)))
    early_counts = counted_early(seen.where(kind == ON_TIME), windows, early)
    targets = windows.select("window_start", plus(F.col("window_end"), duration_micros(ooo)).alias("_target"))
    closing = closing_times(seen.select("event_timestamp", "_newest", "processing_timestamp"), targets)

    wide = windows.join(early_counts, "window_start", "left").join(closing, "window_start", "left")

    def firing(label: str, count: Column, at: Column, fires: Column) -> Column:
        row = F.struct(count.alias("count"), F.lit(label).alias("firing_type"), at.alias("emitted_at"))
        return F.when(fires, row)

    open_at_early = F.col("closed_at").isNull() | (F.col("_early_at") < F.col("closed_at"))
    rows = F.array(
        firing("EARLY", F.col("_early"), F.col("_early_at"), (F.col("_early") > 0) & open_at_early),
        firing("ON_TIME", F.col("_on_time"), F.col("closed_at"), (F.col("_on_time") > 0) & F.col("closed_at").isNotNull()),
        firing("LATE", F.col("_on_time") + F.col("_late"), F.col("_last_late"), F.col("_late") > 0),
    )
    return wide.select("window_start", "window_end", F.inline(F.array_compact(rows)))


def lag_monitor(
    ev: DataFrame, size: str = SIZE, ooo: str = OUT_OF_ORDER, lateness: str = LATENESS,
    arrival: Sequence[str] = ARRIVAL,
) -> DataFrame:
    """Mean and largest processing lag per window and the share of events arriving late at all."""
    lag = F.unix_micros("processing_timestamp") - F.unix_micros("event_timestamp")
    classified = classify_lateness(ev.select("event_timestamp", *arrival), ooo, lateness, size, arrival)
    late = F.count_if(F.col("lateness_class") != ON_TIME)
    return classified.groupBy("window_start", "window_end").agg(
        (F.avg(lag) / 1000).alias("avg_lag_ms"), (F.max(lag) / 1000).alias("max_lag_ms"),
        percent(late, F.count(F.lit(1))).alias("late_rate"),
    )


def lag_spikes(monitor: DataFrame, factor: float = 2.0, span: str = "1 hour") -> DataFrame:
    """Windows whose mean lag exceeds ``factor`` times that of the hour before. Lags are compared in
    whole milliseconds, whose sums are exact, so a flag does not hang on the order of addition."""
    renamed = monitor.withColumn("clicks_per_minute", F.round("avg_lag_ms"))
    return rate_anomaly(renamed, factor, span).withColumnRenamed("clicks_per_minute", "avg_lag_ms")
