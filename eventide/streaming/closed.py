"""Reports over windows that a stream has closed.

A stream can't rank rows of a window while the window is open. Append mode hands over all rows of a window in the one micro-batch in which
the watermark passes its end, so in a foreach-batch writer the batch operator sees each window whole and once: nothing of
earlier batches is read, whatever the stream's age.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventide.operators.windows import latest_window
from eventide.sinks.tables import BATCH, ForeachBatch


def closed_windows_sink(path: str, report: Callable[[DataFrame], DataFrame]) -> ForeachBatch:
    """``report`` (such as :func:`top_n_per_window`) over the windows each batch closes; a replayed batch replaces its own folder."""

    def process(batch: DataFrame, batch_id: int) -> None:
        report(batch).write.mode("overwrite").parquet(f"{path}/closed/{BATCH}={batch_id}")

    return process


def closed_windows(spark: SparkSession, path: str) -> DataFrame:
    """The report's rows of all windows closed so far."""
    return spark.read.parquet(f"{path}/closed").drop(BATCH)


def newest_closed(spark: SparkSession, path: str) -> DataFrame:
    """The report's rows of the window that closed last."""
    return latest_window(closed_windows(spark, path))
