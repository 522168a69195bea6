"""Count windows per key, and what an evictor would leave of a time window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from eventide.functions.timing import window_bounds
from eventide.operators.rows import ARRIVAL
from eventide.plans.ordered import Running, ordered_runs, running


def count_windows(ev: DataFrame, key: str = "user_id", n: int = 100, arrival: Sequence[str] = ARRIVAL) -> DataFrame:
    """Every full block of ``n`` events of a key in arrival order, as a count trigger fires them.
    Numbering goes over runs, so a heavy key is counted by many tasks."""
    narrow = ev.select(key, "event_timestamp", *arrival)
    numbered = running(ordered_runs(narrow, [key], arrival), [key], arrival, _number=Running("sum", F.lit(1)))
    block = F.floor((F.col("_number") - 1) / F.lit(n)).cast("long")
    blocks = numbered.groupBy(key, block.alias("block")).agg(
        F.count(F.lit(1)).alias("count"), F.min("event_timestamp").alias("first_ts"), F.max("event_timestamp").alias("last_ts")
    )
    return blocks.where(F.col("count") == n)


def keep_recent(ev: DataFrame, size: str = "5 minutes", key: str = "event_type", n: int = 3) -> DataFrame:
    """The newest ``n`` events of each (window, key). Spark cuts each map task's rows to ``n`` per
    group before the shuffle."""
    start, _ = window_bounds(F.col("event_timestamp"), size)
    newest = Window.partitionBy("window_start", key).orderBy(F.desc("event_timestamp"), F.desc("event_id"))
    tagged = ev.withColumn("window_start", start)
    return tagged.withColumn("_place", F.row_number().over(newest)).where(F.col("_place") <= n).drop("_place")


def drop_outliers(ev: DataFrame, size: str = "1 hour", metric: str = "price", z: float = 2.0) -> DataFrame:
    """Events within ``z`` standard deviations of their window's mean. The statistics are one row
    per window and join back on the window; windows without a spread keep all."""
    start, _ = window_bounds(F.col("event_timestamp"), size)
    tagged = ev.withColumn("window_start", start)
    stats = tagged.groupBy("window_start").agg(F.avg(metric).alias("_mean"), F.stddev_samp(metric).alias("_sd"))
    far = F.abs(F.col(metric) - F.col("_mean")) > F.lit(z) * F.col("_sd")
    return tagged.join(stats, "window_start").where(~F.coalesce(far, F.lit(False))).drop("_mean", "_sd")


def sample_events(ev: DataFrame, pct: float = 10) -> DataFrame:
    """A repeatable sample: an event is in or out by a hash of its id."""
    number = F.conv(F.substring(F.md5("event_id"), 1, 8), 16, 10).cast("long")
    return ev.where(F.pmod(number, F.lit(10_000)) < F.lit(round(pct * 100)))
