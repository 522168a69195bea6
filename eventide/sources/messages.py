"""A message log over the supplied ``events`` table: every event as a keyed JSON message.

A fixed share of the messages is broken in a known way, by event number, so that decoding,
quarantine and audit have all their cases: cut text, missing user, null or wrong event time, a field
outside the contract, an empty value, and the shape of a producer that ignores the contract.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

KINDS = 20
CUT, NO_USER, NULL_TIME, WORD_TIME, EXTRA_FIELD, EMPTY, OTHER_SHAPE = range(7)


def message_log(ev: DataFrame) -> DataFrame:
    kind = F.col("seq") % KINDS
    session = F.concat(F.lit("s-"), "user_id").alias("session_id")
    millis = F.unix_millis("event_timestamp").alias("timestamp")
    user = F.when(kind != NO_USER, F.col("user_id")).alias("user_id")
    whole = F.to_json(F.struct("event_id", user, session, "event_type", "page_url", millis, "country", "device_type"))
    other = F.to_json(
        F.struct(
            "event_id", "user_id", session, "event_type", F.col("page_url").alias("product_id"), "price", millis,
            F.unix_millis("processing_timestamp").alias("processing_time"),
        )
    )
    value = (
        F.when(kind == CUT, whole.substr(F.lit(1), F.length(whole) - 5))
        .when(kind == NULL_TIME, F.regexp_replace(whole, '"timestamp":[0-9]+', '"timestamp":null'))
        .when(kind == WORD_TIME, F.regexp_replace(whole, '"timestamp":[0-9]+', '"timestamp":"soon"'))
        .when(kind == EXTRA_FIELD, F.regexp_replace(whole, r"\}$", ',"campaign":"spring"}'))
        .when(kind == EMPTY, F.lit(""))
        .when(kind == OTHER_SHAPE, other)
        .otherwise(whole)
    )
    return ev.select(
        F.col("user_id").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit("clickstream").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("seq").alias("offset"),
        F.col("processing_timestamp").alias("timestamp"),
    )
