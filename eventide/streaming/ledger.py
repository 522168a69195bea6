"""Allowed lateness on a stream.

Spark's watermark drops late rows before any operator sees them, so the stream is left without one
and the watermark is kept here: a ledger holds, per micro-batch, the newest event time up to and
including it. Within a batch the watermark before each row is the batch operator's running maximum in
arrival order, which starts from the entry of the batch before. So results don't depend on where the stream
was cut into batches, as long as a batch's rows arrived after those of the batches before. Rows are counted by
class into a log of per-batch deltas, and the too-late ones go to a side table. Every output of a batch
lies in a folder named after it, so a replayed batch replaces what it wrote before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventide.operators.late import LATENESS, OUT_OF_ORDER, SIZE, TOO_LATE, classify_lateness, count_by_class, final_counts, late_row
from eventide.operators.rows import ARRIVAL
from eventide.sinks.tables import BATCH, ForeachBatch

_LEDGER = "newest timestamp"


def newest_before(spark: SparkSession, path: str, batch_id: int):
    """Ledger entry of the batch before: one row in one file, whatever the stream's age."""
    if batch_id == 0:
        return None
    return spark.read.schema(_LEDGER).parquet(f"{path}/ledger/{BATCH}={batch_id - 1}").first()["newest"]


def late_ledger(
    path: str, ooo: str = OUT_OF_ORDER, lateness: str = LATENESS, size: str = SIZE, key: str = "event_type",
    arrival: Sequence[str] = ARRIVAL,
) -> ForeachBatch:
    """The foreach-batch writer; ``path`` gets the folders ``ledger``, ``counts`` and ``late``."""

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = F.lit(newest_before(spark, path, batch_id)).cast("timestamp")
        needed = dict.fromkeys(["event_id", "event_type", key, "event_timestamp", "processing_timestamp", *arrival])
        classified = classify_lateness(batch.select(*needed), ooo, lateness, size, arrival, before).persist()
        try:
            count_by_class(classified, key).write.mode("overwrite").parquet(f"{path}/counts/{BATCH}={batch_id}")
            too_late = classified.where(F.col("lateness_class") == TOO_LATE).select(*late_row())
            too_late.write.mode("overwrite").parquet(f"{path}/late/{BATCH}={batch_id}")
            newest = F.greatest(F.max("event_timestamp"), before)
            classified.agg(newest.alias("newest")).write.mode("overwrite").parquet(f"{path}/ledger/{BATCH}={batch_id}")
        finally:
            classified.unpersist()

    return process


def ledger_counts(spark: SparkSession, path: str, key: str = "event_type") -> DataFrame:
    """Current counts with their late-update flag, folded from the per-batch deltas."""
    deltas = spark.read.parquet(f"{path}/counts")
    totals = deltas.groupBy("window_start", "window_end", key).agg(
        F.sum("on_time_n").alias("on_time_n"), F.sum("late_n").alias("late_n")
    )
    return final_counts(totals, key)


def ledger_late_events(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/late").drop(BATCH)
