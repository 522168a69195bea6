"""Alerts on a stream that compare a window with those before it.

A stream has no window over its own closed windows, so these are kept as a table: append mode hands each closed window to
a foreach-batch writer once, in the order of the watermark, and the batch operator runs over the new windows and the ``span``
before them. That is a few rows per minute of event time, whatever the number of events.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from eventide.functions.timing import duration_micros, plus
from eventide.sinks.tables import BATCH, ForeachBatch


def alerts_sink(path: str, alerts: Callable[[DataFrame], DataFrame], span: str = "1 hour") -> ForeachBatch:
    """``alerts`` (such as :func:`rate_anomaly` with the same ``span``) over closed windows; ``path`` gets ``windows`` and ``alerts``.

    A replayed batch reads only what earlier batches wrote and replaces its own folders.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{path}/windows/{BATCH}={batch_id}")
        known = spark.read.schema(T.StructType([*batch.schema.fields, T.StructField(BATCH, T.LongType())])).parquet(f"{path}/windows").where(F.col(BATCH) <= batch_id)
        new = known.where(F.col(BATCH) == batch_id)
        first = new.agg(F.min("window_start")).scalar()
        around = known.where(F.col("window_start") >= plus(first, -duration_micros(span))).drop(BATCH)
        found = alerts(around).join(new.select("window_start"), "window_start", "left_semi")
        found.write.mode("overwrite").parquet(f"{path}/alerts/{BATCH}={batch_id}")

    return process


def alert_rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/alerts").drop(BATCH)
