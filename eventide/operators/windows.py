"""Tumbling, sliding and hopping window aggregates. Every count is partially aggregated before
the shuffle, so a heavy key or window reaches the final task as one row per map task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from eventide.functions.timing import duration_micros, percent, plus, window_bounds

BOUNDS = ("window_start", "window_end")


def _bounds() -> list[Column]:
    return [F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end")]


def tumbling_count(ev: DataFrame, key: str | None = "event_type", size: str = "5 minutes") -> DataFrame:
    keys = [key] if key else []
    counted = ev.groupBy(F.window("event_timestamp", size), *keys).agg(F.count(F.lit(1)).alias("count"))
    return counted.select(*_bounds(), *keys, "count")


def page_views(ev: DataFrame, page_type: str = "page_view", size: str = "5 minutes") -> DataFrame:
    return tumbling_count(ev.where(F.col("event_type") == page_type), "page_url", size)


def sliding_sums(
    ev: DataFrame, size: str, slide: str, keys: Sequence[str] = (), **values: Column
) -> DataFrame:
    """Sums per sliding window.

    A batch without keys first sums per slide-wide pane, so each event is touched once and only
    the few pane rows are copied into their size/slide windows. With a key, panes are about as
    many as events and the copy would come after a shuffle of its own, so the windows are built
    directly; so they are on a stream, where one stateful step is cheaper than two.
    """
    if not keys and not ev.isStreaming and duration_micros(size) % duration_micros(slide) == 0:
        start, _ = window_bounds(F.col("event_timestamp"), slide)
        panes = ev.where(F.col("event_timestamp").isNotNull()).groupBy(start.alias("event_timestamp"))
        ev = panes.agg(*[F.sum(v).alias(n) for n, v in values.items()])
        values = {n: F.col(n) for n in values}
    summed = ev.groupBy(F.window("event_timestamp", size, slide), *keys)
    summed = summed.agg(*[F.sum(v).alias(n) for n, v in values.items()])
    return summed.select(*_bounds(), *keys, *values)


def sliding_count(
    ev: DataFrame, key: str | None = "user_id", size: str = "10 minutes", slide: str = "2 minutes"
) -> DataFrame:
    return sliding_sums(ev, size, slide, [key] if key else [], event_count=F.lit(1))


def sliding_rate(
    ev: DataFrame, event_type: str = "click", size: str = "5 minutes", slide: str = "1 minute"
) -> DataFrame:
    minutes = duration_micros(size) / duration_micros("1 minute")
    counts = sliding_sums(ev.where(F.col("event_type") == event_type), size, slide, click_count=F.lit(1))
    return counts.withColumn("clicks_per_minute", F.round(F.col("click_count") / F.lit(minutes), 2))


def sliding_avg(
    ev: DataFrame, metric: str, key: str = "user_id", size: str = "10 minutes", slide: str = "5 minutes"
) -> DataFrame:
    averaged = ev.groupBy(F.window("event_timestamp", size, slide), key).agg(F.avg(metric).alias("avg_value"))
    return averaged.select(*_bounds(), key, "avg_value")


def top_n_per_window(counts: DataFrame, n: int = 10, tie: str = "row_number", key: str = "page_url") -> DataFrame:
    """The ``n`` largest counts of every window. ``row_number`` breaks ties by key, ``rank`` keeps
    them. Spark applies the limit on each map task before the shuffle."""
    largest = [F.desc("count"), F.asc(key)] if tie == "row_number" else [F.desc("count")]
    place = (F.row_number() if tie == "row_number" else F.rank()).over(
        Window.partitionBy("window_start").orderBy(*largest)
    )
    return counts.withColumn("rank", place).where(F.col("rank") <= n).withColumn("rank", F.col("rank").cast("long"))


def latest_window(counts: DataFrame) -> DataFrame:
    newest = counts.agg(F.max("window_start")).scalar()
    return counts.where(F.col("window_start") == newest)


def top_pages_latest(counts: DataFrame, n: int = 10) -> DataFrame:
    """Ranked pages of the newest window. The ``n`` rows are cut out first (a distributed top-k);
    a rank only counts larger rows, and those are all in the cut."""
    top = latest_window(counts).orderBy(F.desc("count"), F.asc("page_url")).limit(n)
    place = F.rank().over(Window.partitionBy("window_start").orderBy(F.desc("count")))
    return top.withColumn("rank", place.cast("long"))


def windows_containing(df: DataFrame, instant: Column) -> DataFrame:
    holds = (F.col("window_start") <= instant) & (F.col("window_end") > instant)
    return df.where(holds).select(*BOUNDS).distinct().orderBy("window_start")


def window_multiplicity(sliding: DataFrame) -> DataFrame:
    return sliding.groupBy("user_id", "event_count").count().orderBy(F.desc("count"))


def tumbling_vs_sliding(ev: DataFrame, size: str = "10 minutes", slide: str = "2 minutes") -> DataFrame:
    """Both shapes of the same count, labelled. The sliding windows are sums of slide-wide panes,
    and the tumbling ones are those of them that start on a size boundary."""
    sliding = sliding_sums(ev, size, slide, count=F.lit(1))
    on_boundary = F.pmod(F.unix_micros("window_start"), F.lit(duration_micros(size))) == 0
    kinds = F.when(on_boundary, F.array(F.lit("sliding"), F.lit("tumbling"))).otherwise(F.array(F.lit("sliding")))
    return sliding.select(F.explode(kinds).alias("kind"), *BOUNDS, "count")


def minute_histogram(ev: DataFrame) -> DataFrame:
    return tumbling_count(ev, None, "1 minute").select("window_start", "count").orderBy("window_start")


def window_closure(counts: DataFrame, latest: int | None = None) -> DataFrame:
    """Rows per window and minutes to the next window's start; ``latest`` keeps the newest ones.

    The next start is looked up inside the day; a day's last window takes the first start of the
    next day present, from a table with one row per day.
    """
    rows = counts.groupBy(*BOUNDS).agg(F.count(F.lit(1)).alias("rows"))
    rows = rows.withColumn("_day", F.to_date("window_start"))
    days = rows.groupBy("_day").agg(F.min("window_start").alias("_first"))
    next_day = F.lead("_first").over(Window.partitionBy(F.lit(0)).orderBy("_day"))
    days = days.select("_day", next_day.alias("_next_day"))
    in_day = F.lead("window_start").over(Window.partitionBy("_day").orderBy("window_start"))
    following = F.coalesce(in_day, F.col("_next_day"))
    gap = (F.unix_micros(following) - F.unix_micros("window_start")) / F.lit(6e7)
    out = rows.join(days, "_day").select(*BOUNDS, "rows", gap.alias("gap_minutes"))
    return out.orderBy(F.desc("window_start")).limit(latest) if latest else out


def hopping_gap_count(ev: DataFrame, size: str = "5 minutes", slide: str = "15 minutes") -> DataFrame:
    """Windows of ``size`` every ``slide`` with slide > size: events in the gaps are not counted.
    ``window`` refuses that shape, so tumble by slide and keep the leading part of each."""
    start, _ = window_bounds(F.col("event_timestamp"), slide)
    end = plus(start, duration_micros(size))
    inside = ev.where(F.col("event_timestamp") < end)
    counted = inside.groupBy(start.alias("window_start")).agg(F.count(F.lit(1)).alias("count"))
    return counted.select("window_start", plus(F.col("window_start"), duration_micros(size)).alias("window_end"), "count")


def top_products(
    ev: DataFrame, n: int = 10, product: str = "page_url", view_type: str = "page_view", size: str = "15 minutes"
) -> DataFrame:
    views = tumbling_count(ev.where(F.col("event_type") == view_type), product, size)
    return top_n_per_window(views, n, key=product)


def conversion_rate(
    ev: DataFrame, purchase_type: str = "purchase", size: str = "1 hour", slide: str = "5 minutes"
) -> DataFrame:
    bought = F.coalesce(F.col("event_type") == purchase_type, F.lit(False)).cast("long")
    sums = sliding_sums(ev, size, slide, total=F.lit(1), conversions=bought)
    return sums.withColumn("rate", percent(F.col("conversions"), F.col("total")))


def active_sessions(ev: DataFrame, size: str = "5 minutes", approximate: bool = False) -> DataFrame:
    """Users seen per window, exactly, in batch and on a stream; ``approximate`` estimates with a sketch.

    A row per window and user is counted per window in a second step. On a stream that is a second window
    over the first one's time, and the watermark clears the state of both. Null users are not counted.
    """
    if approximate:
        counted = ev.groupBy(F.window("event_timestamp", size)).agg(F.approx_count_distinct("user_id").alias("active"))
        return counted.select(*_bounds(), "active")
    users = ev.groupBy(F.window("event_timestamp", size), "user_id").agg(F.count(F.lit(1)).alias("_events"))
    at = F.window(F.window_time("window"), size) if ev.isStreaming else F.col("window")
    return users.groupBy(at.alias("window")).agg(F.count("user_id").alias("active")).select(*_bounds(), "active")
