"""Early, on-time and late results of windows on a stream, each once.

A table of open windows stands in for timers: per window its first arrival, counts and what has fired. A batch reads the table that the
batch before wrote, adds its rows and fires what two clocks have reached: arrivals for EARLY, the watermark for ON_TIME. Windows that
can't change any more leave the table, so it is as large as the stream's disorder, not its age. Watermarks within a batch are the
batch operator's, seeded with the newest event time so far (see :mod:`eventide.streaming.ledger`), and every output lies in a
folder named after its batch, so a replayed batch fires the same rows again into the same place.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eventide.functions.timing import duration_micros, plus
from eventide.operators.late import (
    LATE, LATENESS, ON_TIME, OUT_OF_ORDER, TOO_LATE, closing_times, counted_early, lateness_class, window_columns, with_newest,
)
from eventide.operators.rows import ARRIVAL
from eventide.sinks.tables import BATCH, ForeachBatch

_CLOCKS = "newest timestamp, arrived timestamp"
_OPEN = (
    "window_start timestamp, window_end timestamp, _first timestamp, _early long, _on_time long, _late long, closed_at timestamp, "
    "_early_done boolean, _on_time_done boolean"
)


def _before(spark: SparkSession, path: str, batch_id: int) -> tuple[datetime | None, datetime | None, DataFrame]:
    """Newest event time, newest arrival and open windows after the batch before."""
    if batch_id == 0:
        return None, None, spark.createDataFrame([], _OPEN)
    clocks = spark.read.schema(_CLOCKS).parquet(f"{path}/clocks/{BATCH}={batch_id - 1}").first()
    return clocks["newest"], clocks["arrived"], spark.read.schema(_OPEN).parquet(f"{path}/open/{BATCH}={batch_id - 1}")


def firing_sink(
    path: str, size: str = "10 minutes", early: str = "5 minutes", ooo: str = OUT_OF_ORDER, lateness: str = LATENESS,
    arrival: Sequence[str] = ARRIVAL,
) -> ForeachBatch:
    """The foreach-batch writer; ``path`` gets the folders ``firings``, ``open`` and ``clocks``.

    EARLY fires when an event arrives later than ``early`` after the window's first arrival, with what had arrived by then, if the
    window was still open. ON_TIME fires when the watermark passes the window's end. A batch with late events of a window fires its
    new count as LATE, at the last one's arrival. Too-late events and those without a time count nowhere. Batches come in the order
    of arrival.
    """
    wait, minute = duration_micros(early), duration_micros(ooo)

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        newest, arrived, opened = _before(spark, path, batch_id)
        newest, arrived = (F.lit(x).cast("timestamp") for x in (newest, arrived))
        narrow = batch.select("event_timestamp", *dict.fromkeys(["processing_timestamp", *arrival]))
        seen = with_newest(narrow, arrival, newest).withColumns(window_columns(size))
        kind = lateness_class(plus(F.col("_newest"), -minute), F.col("window_end"), lateness)
        seen = seen.withColumn("_class", kind).persist()
        try:
            clocks = seen.agg(
                F.greatest(F.max("event_timestamp"), newest).alias("newest"), F.greatest(F.max("processing_timestamp"), arrived).alias("arrived")
            )
            clocks.write.mode("overwrite").parquet(f"{path}/clocks/{BATCH}={batch_id}")
            now = spark.read.schema(_CLOCKS).parquet(f"{path}/clocks/{BATCH}={batch_id}").first()
            known = _added(seen, opened).persist()
            windows = _judged(seen, known, early, minute).persist()
            try:
                fired = _fired(windows, wait, F.lit(now["arrived"]).cast("timestamp"))
                fired.write.mode("overwrite").parquet(f"{path}/firings/{BATCH}={batch_id}")
                left = _still_open(windows, wait, F.lit(now["arrived"]).cast("timestamp"))
                passed = plus(F.lit(now["newest"]).cast("timestamp"), -minute) >= plus(F.col("window_end"), duration_micros(lateness))
                left = left.where(~F.coalesce(passed, F.lit(False)))
                left.write.mode("overwrite").parquet(f"{path}/open/{BATCH}={batch_id}")
            finally:
                windows.unpersist()
                known.unpersist()
        finally:
            seen.unpersist()

    return process


def _added(seen: DataFrame, opened: DataFrame) -> DataFrame:
    """The open windows with a batch's rows: sums and minima of both."""
    kind, arrived = F.col("_class"), F.col("processing_timestamp")
    fresh = seen.where(kind != TOO_LATE).groupBy("window_start", "window_end").agg(
        F.min(arrived).alias("_first"), F.count_if(kind == ON_TIME).alias("_on_time"), F.count_if(kind == LATE).alias("_late"),
        F.max(F.when(kind == LATE, arrived)).alias("_last_late"),
    )
    return opened.unionByName(fresh, allowMissingColumns=True).groupBy("window_start", "window_end").agg(
        F.min("_first").alias("_first"), F.sum("_early").alias("_had_early"), F.sum("_on_time").alias("_on_time"), F.sum("_late").alias("_late"),
        F.max("_last_late").alias("_last_late"), F.min("closed_at").alias("_was_closed"),
        *[F.coalesce(F.bool_or(c), F.lit(False)).alias(c) for c in ("_early_done", "_on_time_done")],
    )


def _judged(seen: DataFrame, both: DataFrame, early: str, ooo: int) -> DataFrame:
    """The same with the batch's early counts and closing times."""
    kind = F.col("_class")
    counted = counted_early(seen.where(kind == ON_TIME), both, early)
    targets = both.where(F.col("_was_closed").isNull()).select("window_start", plus(F.col("window_end"), ooo).alias("_target"))
    closing = closing_times(seen.select("event_timestamp", "_newest", "processing_timestamp"), targets)
    wide = both.join(counted, "window_start", "left").join(closing, "window_start", "left")
    return wide.select(
        "window_start", "window_end", "_first", (F.coalesce("_had_early", F.lit(0)) + F.coalesce("_early", F.lit(0))).alias("_early"),
        "_on_time", "_late", "_last_late", F.coalesce("_was_closed", "closed_at").alias("closed_at"), "_early_done", "_on_time_done",
    )


def _early_due(wait: int, arrived: Column) -> Column:
    """No event can any more arrive within the window's early time."""
    return F.coalesce(arrived > plus(F.col("_first"), wait), F.lit(False))


def _fired(windows: DataFrame, wait: int, arrived: Column) -> DataFrame:
    early_at, closed = plus(F.col("_first"), wait), F.col("closed_at")

    def firing(label: str, count: Column, at: Column, fires: Column) -> Column:
        return F.when(fires, F.struct(count.alias("count"), F.lit(label).alias("firing_type"), at.alias("emitted_at")))

    open_then = closed.isNull() | (early_at < closed)
    rows = F.array(
        firing("EARLY", F.col("_early"), early_at, ~F.col("_early_done") & _early_due(wait, arrived) & (F.col("_early") > 0) & open_then),
        firing("ON_TIME", F.col("_on_time"), closed, ~F.col("_on_time_done") & closed.isNotNull() & (F.col("_on_time") > 0)),
        firing("LATE", F.col("_on_time") + F.col("_late"), F.col("_last_late"), F.col("_last_late").isNotNull()),
    )
    return windows.select("window_start", "window_end", F.inline(F.array_compact(rows)))


def _still_open(windows: DataFrame, wait: int, arrived: Column) -> DataFrame:
    return windows.select(
        "window_start", "window_end", "_first", "_early", "_on_time", "_late", "closed_at",
        (F.col("_early_done") | _early_due(wait, arrived)).alias("_early_done"), (F.col("_on_time_done") | F.col("closed_at").isNotNull()).alias("_on_time_done"),
    )


def fired_rows(spark: SparkSession, path: str) -> DataFrame:
    """Every firing in the order of the batches: a window's EARLY and ON_TIME once, LATE for each batch that changed it."""
    return spark.read.parquet(f"{path}/firings").drop(BATCH)


def last_firings(spark: SparkSession, path: str) -> DataFrame:
    """The firings with a window's last LATE only: what the batch operator gives over all that has arrived."""
    rest = [c for c in fired_rows(spark, path).columns if c not in ("window_start", "window_end", "firing_type")]
    last = fired_rows(spark, path).groupBy("window_start", "window_end", "firing_type").agg(F.max_by(F.struct(*rest), F.struct("emitted_at", "count")).alias("_row"))
    return last.select("window_start", "window_end", "_row.count", "firing_type", "_row.emitted_at")
