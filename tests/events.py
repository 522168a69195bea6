"""Small hand-made event frames."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

SCHEMA = (
    "event_id string, seq long, user_id string, event_type string, page_url string, event_timestamp timestamp, "
    "device_type string, country string, channel string, price double, processing_timestamp timestamp"
)
DAY = dt.datetime(2024, 10, 28, tzinfo=dt.timezone.utc)


def at(text: str) -> dt.datetime:
    """``"10:05"`` or ``"10:05:30.5"`` on the test day."""
    hours, minutes, *seconds = text.split(":")
    return DAY + dt.timedelta(hours=int(hours), minutes=int(minutes), seconds=float(seconds[0]) if seconds else 0)


def event(seq: int, when, user="u1", kind="view", page="/p", arrived=None, channel="web", price=1.0, device="mobile", country="US"):
    when = at(when) if isinstance(when, str) else when
    arrived = at(arrived) if isinstance(arrived, str) else arrived
    return (f"e{seq:06d}", seq, user, kind, page, when, device, country, channel, price, arrived or when + dt.timedelta(seconds=seq))


def frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, SCHEMA)


def clock(moment: dt.datetime) -> str:
    return moment.strftime("%H:%M:%S")
