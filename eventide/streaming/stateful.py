"""Alerts from open sessions on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from eventide.functions.timing import duration_micros
from eventide.operators.sessions import GAP, is_type, session_id


def abandoned_carts_stream(
    ev: DataFrame, gap: str = GAP, idle: str = "60 minutes", ooo: str = "10 minutes",
    cart: str = "add_to_cart", purchase: str = "purchase",
) -> DataFrame:
    """Abandoned carts as alerts, once per session (append mode); ``ev`` has no watermark yet.

    A session window comes out when the watermark passes last event + gap. Holding the watermark
    back by idle - gap on top of the disorder makes that the moment the session has been idle for
    ``idle``; no timers or user state are needed. An ``idle`` under ``gap`` is refused: such a session may still go on.
    """
    if duration_micros(idle) < duration_micros(gap):
        raise ValueError(f"idle ({idle}) must be at least the session gap ({gap})")
    hold = duration_micros(ooo) + duration_micros(idle) - duration_micros(gap)
    sessions = ev.withWatermark("event_timestamp", f"{hold // 1000} milliseconds").groupBy(
        F.session_window("event_timestamp", gap), "user_id"
    ).agg(
        F.min("event_timestamp").alias("_start"),
        F.max("event_timestamp").alias("last_activity"),
        F.sum(is_type(cart)).alias("items_added"),
        F.sum(is_type(purchase)).alias("_bought"),
    )
    return sessions.where((F.col("items_added") > 0) & (F.col("_bought") == 0)).select(
        session_id(F.col("user_id"), F.col("_start")).alias("session_id"),
        "user_id",
        "last_activity",
        "items_added",
        F.lit(duration_micros(idle) // 60_000_000).alias("time_since_last_activity_minutes"),
        F.lit(True).alias("alert_sent"),
    )
