"""Gap sessions and what is computed from them.

A session must not become one task's work: a user may own a third of all events, and so may one
session. The sessions are therefore found on slices. A slice is a user's events of one epoch-aligned
interval as long as the gap; two events of a slice are less than a gap apart, so they always share a
session. Slices are built with partial aggregation, and the ordered window that chains them into
sessions sees at most (time range / gap) rows per user, however many events the user has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from eventide.functions.timing import duration_micros, epoch_millis, minutes_between, percent, plus, slot
from eventide.plans.ordered import Running, ordered_runs, running, split_keys_only

GAP = "30 minutes"
SLICE = "_slice"
ORDER = ("event_timestamp", "event_id")

SESSION_COLUMNS = (
    "session_id", "user_id", "start_time", "end_time", "duration_minutes", "event_count", "pages_visited",
    "first_event_type", "last_event_type", "device_type", "country", "closes_at",
)
# Columns a repeated session row refreshes in the serving table; the rest keep their first value.
SESSION_UPDATES = ("end_time", "duration_minutes", "event_count", "pages_visited", "last_event_type")


def with_slice(ev: DataFrame, gap: str) -> DataFrame:
    return ev.withColumn(SLICE, slot(F.col("event_timestamp"), duration_micros(gap)))


def session_slices(ev: DataFrame, gap: str = GAP, **aggregates: Column) -> DataFrame:
    """One row per (user, slice) with the start of the session it belongs to."""
    usable = ev.where(F.col("event_timestamp").isNotNull() & F.col("user_id").isNotNull())
    slices = with_slice(usable, gap).groupBy("user_id", SLICE).agg(
        F.min("event_timestamp").alias("_from"), F.max("event_timestamp").alias("_to"),
        *[a.alias(n) for n, a in aggregates.items()],
    )
    by_time = Window.partitionBy("user_id").orderBy(SLICE)
    before = F.lag("_to").over(by_time)
    opens = before.isNull() | (F.col("_from") > plus(before, duration_micros(gap)))
    marked = slices.withColumn("_opened", F.when(opens, F.col("_from")))
    return marked.withColumn("session_start", F.max("_opened").over(by_time)).drop("_opened")


def session_id(user: Column, start: Column) -> Column:
    return F.concat(user, F.lit("-"), epoch_millis(start))


def is_type(event_type: str) -> Column:
    """1 for events of the type, 0 for others and for events without one."""
    return F.coalesce(F.col("event_type") == event_type, F.lit(False)).cast("long")


def session_totals(
    ev: DataFrame, gap: str = GAP, *, sums: dict[str, Column] | None = None
) -> DataFrame:
    """Per session: start, end, event count and the given sums, without shuffling events by session."""
    sums = {"event_count": F.lit(1), **(sums or {})}
    slices = session_slices(ev, gap, **{n: F.sum(c) for n, c in sums.items()})
    return slices.groupBy("user_id", "session_start").agg(
        F.max("_to").alias("session_end"), *[F.sum(n).alias(n) for n in sums]
    )


def assign_sessions(ev: DataFrame, gap: str = GAP) -> DataFrame:
    """Row level: previous event of the user, seconds since, new-session flag, running session
    number from 0, session id. Batch only, as ordered windows are not allowed on streams."""
    keys, width = ["user_id"], duration_micros(gap)
    at = F.col("event_timestamp")
    usable = ev.where(at.isNotNull() & F.col("user_id").isNotNull())
    runs = ordered_runs(usable, keys, ORDER)
    prev = F.col("prev_event_timestamp")
    since = (F.unix_micros(at) - F.unix_micros(prev)) / F.lit(1e6)

    def linked(rows: DataFrame) -> DataFrame:
        # In event-time order the previous timestamp is the largest one so far.
        out = running(rows, keys, ORDER, prev_event_timestamp=Running("max", at, inclusive=False))
        return out.withColumn("time_since_last_seconds", F.coalesce(since, F.lit(0.0))).withColumn(
            "is_new_session", F.when(at > plus(prev, width), 1).otherwise(0).cast("long")
        )

    opens = prev.isNull() | (F.col("is_new_session") == 1)
    numbered = running(
        linked(runs), keys, ORDER, totals_from=linked(split_keys_only(runs, keys)),
        session_number=Running("sum", F.col("is_new_session")),
        _start=Running("max", F.when(opens, at)),
    )
    identity = session_id(F.col("user_id"), F.col("_start"))
    return numbered.withColumn("session_id", identity).drop("_start", "_run")


def _shape(df: DataFrame, gap: str, end: str, *more: str) -> DataFrame:
    """Final columns from (user_id, start_time, last_time, ...) rows."""
    closes = plus(F.col("_last"), duration_micros(gap))
    until = F.col("_last") if end == "last_event" else closes
    return (
        df.withColumn("session_id", session_id(F.col("user_id"), F.col("start_time")))
        .withColumn("closes_at", closes)
        .withColumn("end_time", until)
        .withColumn("duration_minutes", F.round(minutes_between(F.col("start_time"), F.col("end_time")), 2))
        .select(*SESSION_COLUMNS, *more)
    )


def _metrics(pages: Column) -> list[Column]:
    at = F.struct(*ORDER)

    def first_known(column: str) -> Column:
        return F.min_by(column, F.when(F.col(column).isNotNull(), at)).alias(column)

    return [
        F.max("event_timestamp").alias("_last"),
        F.count(F.lit(1)).alias("event_count"),
        pages.alias("pages_visited"),
        F.min_by("event_type", at).alias("first_event_type"),
        F.max_by("event_type", at).alias("last_event_type"),
        first_known("device_type"),
        first_known("country"),
    ]


def session_metrics(
    ev: DataFrame, gap: str = GAP, end: str = "last_event", *, pages: bool = True, sums: dict[str, Column] | None = None
) -> DataFrame:
    """One row per session. ``end`` is the last event, or ``window_end`` = last event + gap.

    Everything but the pages is a minimum, maximum or sum, and so part of the slice aggregation: single
    events are not shuffled. Pages are reduced to (user, slice, page) before they meet the slices; reports
    that need no page count leave them out (``pages=False``, the column is then null). ``sums`` are
    further columns, each the sum of an expression over the session's events.
    """
    at, sums = F.struct(*ORDER), sums or {}

    def known(column: str) -> Column:
        return F.min(F.when(F.col(column).isNotNull(), F.struct(*ORDER, F.col(column).alias("value"))))

    typed = F.struct(*ORDER, F.col("event_type").alias("value"))
    slices = session_slices(
        ev, gap, _n=F.count(at), _first=F.min(typed), _late=F.max(typed), _device=known("device_type"), _country=known("country"),
        **{f"_sum_{n}": F.sum(c) for n, c in sums.items()},
    )
    rows = slices.groupBy("user_id", F.col("session_start").alias("start_time")).agg(
        F.max("_to").alias("_last"), F.sum("_n").alias("event_count"), F.min("_first")["value"].alias("first_event_type"),
        F.max("_late")["value"].alias("last_event_type"), F.min("_device")["value"].alias("device_type"), F.min("_country")["value"].alias("country"),
        *[F.sum(f"_sum_{n}").alias(n) for n in sums],
    )
    if not pages:
        return _shape(rows.withColumn("pages_visited", F.lit(None).cast("long")), gap, end, *sums)
    usable = ev.where(F.col("event_timestamp").isNotNull() & F.col("user_id").isNotNull() & F.col("page_url").isNotNull())
    seen = with_slice(usable, gap).select("user_id", SLICE, "page_url").distinct()
    starts = session_slices(ev, gap).select("user_id", SLICE, F.col("session_start").alias("start_time"))
    counted = seen.join(starts, ["user_id", SLICE]).groupBy("user_id", "start_time").agg(F.count_distinct("page_url").alias("_pages"))
    rows = rows.join(counted, ["user_id", "start_time"], "left").withColumn("pages_visited", F.coalesce("_pages", F.lit(0)))
    return _shape(rows, gap, end, *sums)


def session_metrics_stream(
    ev: DataFrame, gap: str = GAP, end: str = "last_event", approximate_pages: bool = False
) -> DataFrame:
    """The same rows from a watermarked stream (append mode): a session comes out once the
    watermark passes its closing time. The state of an open session holds its distinct pages;
    ``approximate_pages`` holds a sketch of fixed size instead, and the count is then an estimate."""
    pages = F.approx_count_distinct("page_url") if approximate_pages else F.size(F.collect_set("page_url")).cast("long")
    grouped = ev.groupBy(F.session_window("event_timestamp", gap), "user_id").agg(
        F.min("event_timestamp").alias("start_time"), *_metrics(pages)
    )
    return _shape(grouped, gap, end)


def session_facts(
    ev: DataFrame, gap: str = GAP, view: str = "page_view", cart: str = "add_to_cart",
    purchase: str = "purchase", amount: str = "price",
) -> DataFrame:
    """Session metrics plus page views, cart additions and purchase amount, all from one aggregation."""
    spent = F.when(F.col("event_type") == purchase, F.col(amount)).otherwise(F.lit(0.0))
    return session_metrics(
        ev, gap, sums={"page_views": is_type(view), "cart_additions": is_type(cart), "purchase_amount": F.coalesce(spent, F.lit(0.0))}
    )


# Reports over session rows.


def _shares(purchase: str) -> list[Column]:
    n = F.count(F.lit(1))
    bounced = F.count_if(F.col("event_count") == 1)
    bought = F.count_if(F.col("last_event_type") == purchase)
    return [
        bounced.alias("bounce_sessions"), percent(bounced, n).alias("bounce_rate"),
        bought.alias("conversion_sessions"), percent(bought, n).alias("conversion_rate"),
    ]


def _mean(column: str, places: int) -> Column:
    """Rounded mean of values with two decimals, summed exactly so that ties round the same way
    whatever the order of the rows."""
    return F.round(F.avg(F.col(column).cast("decimal(18,2)")), places).cast("double")


def _hour() -> Column:
    return F.date_trunc("hour", "start_time").alias("hour")


def session_summary(sessions: DataFrame, purchase: str = "purchase") -> DataFrame:
    return sessions.groupBy(_hour()).agg(
        F.count(F.lit(1)).alias("total_sessions"),
        F.avg("duration_minutes").alias("avg_duration"),
        F.avg("event_count").alias("avg_events_per_session"),
        F.avg("pages_visited").alias("avg_pages_per_session"),
        *_shares(purchase),
    ).orderBy(F.desc("hour"))


def session_metrics_hourly(sessions: DataFrame, purchase: str = "purchase") -> DataFrame:
    return sessions.groupBy(_hour(), "device_type", "country").agg(
        F.count(F.lit(1)).alias("total_sessions"),
        _mean("duration_minutes", 2).alias("avg_duration_minutes"),
        *_shares(purchase),
    )


def bounce_rate(sessions: DataFrame, by_hour: bool = True) -> DataFrame:
    n, bounced = F.count(F.lit(1)), F.count_if(F.col("event_count") == 1)
    figures = [
        n.alias("total_sessions"), bounced.alias("bounce_sessions"), percent(bounced, n).alias("bounce_rate"),
    ]
    return sessions.groupBy(_hour()).agg(*figures).orderBy("hour") if by_hour else sessions.agg(*figures)


def sessions_by_device(sessions: DataFrame) -> DataFrame:
    return sessions.groupBy("device_type").agg(
        F.count(F.lit(1)).alias("sessions"),
        _mean("duration_minutes", 2).alias("avg_duration"),
        _mean("pages_visited", 1).alias("avg_pages"),
    )


def long_sessions(sessions: DataFrame, minutes: float = 30, n: int = 20) -> DataFrame:
    listed = sessions.where(F.col("duration_minutes") > minutes)
    listed = listed.select("user_id", "session_id", "duration_minutes", "event_count", "pages_visited")
    return listed.orderBy(F.desc("duration_minutes"), "session_id").limit(n)


def frequent_users(sessions: DataFrame, more_than: int = 5) -> DataFrame:
    per_user = sessions.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("session_count"), F.avg("duration_minutes").alias("avg_duration")
    )
    return per_user.where(F.col("session_count") > more_than).orderBy(F.desc("session_count"))


def session_funnel(sessions: DataFrame, cart: str = "add_to_cart", purchase: str = "purchase") -> DataFrame:
    last = F.col("last_event_type")
    return sessions.agg(
        F.count(F.lit(1)).alias("total_sessions"),
        F.count_if(F.col("event_count") > 1).alias("engaged"),
        F.count_if(last == cart).alias("added_to_cart"),
        F.count_if(last == purchase).alias("purchased"),
    )


def session_size_histogram(sessions: DataFrame) -> DataFrame:
    return sessions.groupBy("event_count").agg(F.count(F.lit(1)).alias("sessions")).orderBy("event_count")


def recent_sessions(sessions: DataFrame, n: int = 10) -> DataFrame:
    return sessions.orderBy(F.desc("start_time"), "session_id").limit(n)


# Carts, funnels, channels.


def abandoned_carts(
    ev: DataFrame, gap: str = GAP, idle: str = "60 minutes", as_of: Column | None = None,
    cart: str = "add_to_cart", purchase: str = "purchase",
) -> DataFrame:
    """Sessions with cart additions, no purchase and no event for longer than ``idle`` before
    ``as_of`` (default: the newest event time)."""
    as_of = ev.agg(F.max("event_timestamp")).scalar() if as_of is None else as_of
    totals = session_totals(ev, gap, sums={"items_added": is_type(cart), "_bought": is_type(purchase)})
    left = totals.where((F.col("items_added") > 0) & (F.col("_bought") == 0))
    left = left.withColumn("_idle", F.unix_micros(as_of) - F.unix_micros("session_end"))
    return left.where(F.col("_idle") > duration_micros(idle)).select(
        session_id(F.col("user_id"), F.col("session_start")).alias("session_id"),
        "user_id",
        F.col("session_end").alias("last_activity"),
        "items_added",
        F.floor(F.col("_idle") / F.lit(6e7)).cast("long").alias("time_since_last_activity_minutes"),
        F.lit(False).alias("alert_sent"),
    )


def abandoned_recent(carts: DataFrame, hours: float = 2) -> DataFrame:
    return carts.where(F.col("time_since_last_activity_minutes") <= hours * 60)


def stage_times(ev: DataFrame, stages: list[str], gap: str = GAP) -> list[DataFrame]:
    """For each stage the sessions reaching it, with the time they did so.

    A stage is reached at its first event at or after the time the stage before was reached. Each
    step meets the next stage's events by (user, slice) from the reached time to the session's end,
    so no step gathers a session's events in one place.
    """
    width = duration_micros(gap)
    at = F.col("event_timestamp")
    opening = session_slices(ev, gap, _hit=F.min(F.when(F.col("event_type") == stages[0], at)))
    reached = opening.groupBy("user_id", "session_start").agg(
        F.max("_to").alias("session_end"), F.min("_hit").alias("reached_at")
    ).where(F.col("reached_at").isNotNull()).withColumn("seconds", F.lit(None).cast("double"))
    steps = [reached]
    for stage in stages[1:]:
        slots = F.sequence(slot(F.col("reached_at"), width), slot(F.col("session_end"), width), F.lit(width))
        waiting = reached.select(
            "user_id", "session_start", "session_end", F.col("reached_at").alias("_since"), F.explode(slots).alias(SLICE)
        )
        hits = with_slice(ev.where(F.col("event_type") == stage), gap).select("user_id", SLICE, "event_timestamp")
        reached = (
            hits.join(waiting, ["user_id", SLICE])
            .where(at >= F.col("_since"))
            .groupBy("user_id", "session_start", "session_end", "_since")
            .agg(F.min("event_timestamp").alias("reached_at"))
            .withColumn("seconds", (F.unix_micros("reached_at") - F.unix_micros("_since")) / F.lit(1e6))
            .drop("_since")
        )
        steps.append(reached)
    return steps


def funnel(ev: DataFrame, stages: list[str], gap: str = GAP, names: list[str] | None = None) -> DataFrame:
    """Per hour of session start and stage: entered, converted to the next stage, rate, mean
    seconds to the next stage. The last stage converts to itself at once."""
    names = names or stages
    parts = []
    for i, reached in enumerate(stage_times(ev, stages, gap)):
        hourly = reached.groupBy(F.date_trunc("hour", "session_start").alias("hour")).agg(
            F.count(F.lit(1)).alias("n"), F.avg("seconds").alias("seconds")
        )
        none = F.lit(0).cast("long")
        rows = [F.struct(F.lit(i).alias("place"), F.col("n").alias("entered"), none.alias("converted"),
                         F.lit(None).cast("double").alias("seconds"))]
        if i:
            rows.append(F.struct(F.lit(i - 1).alias("place"), none.alias("entered"), F.col("n").alias("converted"),
                                 F.col("seconds").alias("seconds")))
        if i == len(stages) - 1:
            rows.append(F.struct(F.lit(i).alias("place"), none.alias("entered"), F.col("n").alias("converted"),
                                 F.lit(0.0).alias("seconds")))
        parts.append(hourly.select("hour", F.inline(F.array(*rows))))
    together = parts[0]
    for part in parts[1:]:
        together = together.unionByName(part)
    stage = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("place") + 1)
    return together.groupBy("hour", "place").agg(
        F.sum("entered").alias("users_entered"), F.sum("converted").alias("users_converted"), F.max("seconds").alias("_s")
    ).select(
        "hour", stage.alias("stage"), "users_entered", "users_converted",
        percent(F.col("users_converted"), F.col("users_entered")).alias("conversion_rate"),
        F.round(F.col("_s")).cast("long").alias("avg_time_to_next_seconds"),
    )


def _linked_channels(ev: DataFrame, gap: str) -> DataFrame:
    """Events with their session's start and the user's event before them (time and channel)."""
    keys, at = ["user_id"], F.col("event_timestamp")
    narrow = ev.select("user_id", "event_timestamp", "event_id", "channel", "event_type")
    narrow = narrow.where(at.isNotNull() & F.col("user_id").isNotNull())
    runs = ordered_runs(narrow, keys, ORDER)
    split = split_keys_only(runs, keys)
    before = Running("max", F.struct(*ORDER, "channel"), inclusive=False)
    opens = F.col("_prev").isNull() | (at > plus(F.col("_prev.event_timestamp"), duration_micros(gap)))

    def linked(rows: DataFrame) -> DataFrame:
        return running(rows, keys, ORDER, totals_from=split, _prev=before).withColumn("_opens", opens)

    start = Running("max", F.when(F.col("_opens"), at))
    return running(linked(runs), keys, ORDER, totals_from=linked(split), session_start=start)


NO_CHANNEL = "(none)"  # what a path calls events without a channel


def _enters() -> Column:
    return F.col("_opens") | ~F.col("channel").eqNullSafe(F.col("_prev.channel"))


def journey_steps(ev: DataFrame, gap: str = GAP) -> DataFrame:
    """The whole journey in row form: one row per entry into a channel within a session."""
    return _linked_channels(ev, gap).where(_enters()).select(
        session_id(F.col("user_id"), F.col("session_start")).alias("session_id"),
        "user_id", "channel", F.col("event_timestamp").alias("entered_at"),
    )


def channel_journeys(ev: DataFrame, gap: str = GAP, purchase: str = "purchase", longest: int = 1000) -> DataFrame:
    """Per session: the sequence of channels it went through, seconds spent per channel, conversion.

    A channel is listed each time the session enters it (``web>app>web``). The time between two events of a
    session counts for the channel of the earlier one; an event without a channel is at ``(none)``. A path of
    more than ``longest`` entries lists that many and ends in a checksum over all of them with their places, so
    paths still count as different while no session's entries are gathered without bound.
    """
    named = F.coalesce("channel", F.lit(NO_CHANNEL))
    linked = _linked_channels(ev, gap).withColumn("_enters", _enters())
    dwell = F.when(~F.col("_opens"), (F.unix_micros("event_timestamp") - F.unix_micros("_prev.event_timestamp")) / F.lit(1e6))
    bought = is_type(purchase)
    here = F.struct(named.alias("channel"), F.lit(0.0).alias("seconds"), bought.alias("bought"))
    there = F.struct(F.coalesce("_prev.channel", F.lit(NO_CHANNEL)).alias("channel"), dwell.alias("seconds"), F.lit(0).cast("long").alias("bought"))
    both = F.when(F.col("_opens"), F.array(here)).otherwise(F.array(here, there))
    per_channel = linked.select("user_id", "session_start", F.inline(both)).groupBy("user_id", "session_start", "channel").agg(
        F.sum("seconds").alias("seconds"), F.max("bought").alias("bought")
    )
    spent = per_channel.groupBy("user_id", "session_start").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("channel", "seconds")))).alias("seconds_per_channel"), (F.max("bought") == 1).alias("converted")
    )

    entries = linked.where("_enters").select("user_id", "session_start", *ORDER, named.alias("channel"))
    keys = ["user_id", "session_start"]
    placed = running(ordered_runs(entries, keys, ORDER), keys, ORDER, _place=Running("sum", F.lit(1)))
    listed = F.when(F.col("_place") <= longest, F.struct("_place", "channel"))
    paths = placed.groupBy(*keys).agg(
        F.array_sort(F.collect_list(listed)).alias("_listed"), F.count(F.lit(1)).alias("_entries"),
        F.sum(F.xxhash64("_place", "channel").cast("decimal(38,0)")).alias("_sum"),
    )
    path = F.array_join(F.transform("_listed", lambda e: e["channel"]), ">")
    path = F.when(F.col("_entries") > longest, F.concat_ws(">", path, F.concat(F.lit("#"), F.col("_sum").cast("string")))).otherwise(path)
    return spent.join(paths, keys).select(
        session_id(F.col("user_id"), F.col("session_start")).alias("session_id"), path.alias("path"), "seconds_per_channel", "converted"
    )


def path_counts(journeys: DataFrame) -> DataFrame:
    return journeys.groupBy("path").agg(
        F.count(F.lit(1)).alias("sessions"), F.count_if("converted").alias("conversions")
    )
