"""Canonical events over the supplied ``events`` table.

The clickstream contract asks for page, device, country, channel and arrival time; the table has
(event_id, ts, user_id, event_type, value, props). The missing columns are derived by arithmetic on
the ids, row by row, the same way in the SQL the results are checked with.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from eventide.functions.timing import plus
from eventide.session import prepare

# Roles the table's event types play in the operators.
PAGE_VIEW, CLICK, CART, CHECKOUT, PURCHASE = "view", "click", "signup", "error", "purchase"

CHANNELS = ["web", "app", "email"]

RAW_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def canonical(raw: DataFrame) -> DataFrame:
    number, user, at = F.col("event_id"), F.col("user_id"), F.col("ts").cast("timestamp")
    delay = F.when(number % 5 == 0, (number * 37) % 61).otherwise(0)
    return raw.select(
        number.cast("string").alias("event_id"),
        number.alias("seq"),
        F.concat(F.lit("u"), user).alias("user_id"),
        "event_type",
        F.concat(F.lit("/p/"), F.get_json_object("props", "$.k")).alias("page_url"),
        at.alias("event_timestamp"),
        _pick(["mobile", "desktop", "tablet"], user % 3).alias("device_type"),
        _pick(["US", "DE", "JP", "BR"], user % 4).alias("country"),
        _pick(CHANNELS, number % 3).alias("channel"),
        F.col("value").alias("price"),
        plus(at, delay * 60_000_000).alias("processing_timestamp"),
    )


def load_events(spark: SparkSession, folder: str) -> DataFrame:
    return canonical(prepare(spark).read.parquet(f"{folder}/events.parquet"))


def stream_events(spark: SparkSession, folder: str, **options: str) -> DataFrame:
    """The same rows as a file stream. The path is written as a pattern because a file stream
    takes a plain path for a directory, and the table may be a single file."""
    reader = prepare(spark).readStream.schema(RAW_SCHEMA).options(**options)
    return canonical(reader.parquet(f"{folder}/events.parque[t]"))
