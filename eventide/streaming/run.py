"""Starting streaming queries: append, complete, memory and foreach-batch sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from eventide.sinks.tables import BATCH, ForeachBatch


def _trigger(every: str | None) -> dict:
    """A processing-time trigger, or with ``None`` everything available and then stop."""
    return {"processingTime": every} if every else {"availableNow": True}


def append_sink(
    df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", every: str | None = "30 seconds"
) -> StreamingQuery:
    writer = df.writeStream.format(fmt).outputMode("append")
    return writer.option("path", path).option("checkpointLocation", checkpoint).trigger(**_trigger(every)).start()


def complete_sink(
    df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", every: str | None = "30 seconds"
) -> StreamingQuery:
    """Replace the whole table with every micro-batch's result; see :func:`read_complete`.

    A batch writes a folder of its own and names it in ``done`` when it is whole, so readers see the last whole
    table at any time and a crash leaves that one.
    """

    def replace(result: DataFrame, batch_id: int) -> None:
        result.write.format(fmt).mode("overwrite").save(f"{path}/rows/{BATCH}={batch_id}")
        done = result.sparkSession.range(batch_id, batch_id + 1).toDF("batch")
        done.coalesce(1).write.mode("overwrite").parquet(f"{path}/done/{BATCH}={batch_id}")

    writer = df.writeStream.outputMode("complete").foreachBatch(replace)
    return writer.option("checkpointLocation", checkpoint).trigger(**_trigger(every)).start()


def read_complete(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The newest whole table that :func:`complete_sink` wrote."""
    newest = spark.read.parquet(f"{path}/done").agg(F.max("batch")).first()[0]
    return spark.read.format(fmt).load(f"{path}/rows/{BATCH}={newest}")


def batch_sink(df: DataFrame, write: ForeachBatch, checkpoint: str, mode: str = "append", every: str | None = "30 seconds") -> StreamingQuery:
    writer = df.writeStream.outputMode(mode).foreachBatch(write)
    return writer.option("checkpointLocation", checkpoint).trigger(**_trigger(every)).start()


def memory_sink(df: DataFrame, name: str, mode: str = "append", every: str | None = None) -> StreamingQuery:
    return df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(**_trigger(every)).start()


def await_any(spark: SparkSession, timeout: float | None = None) -> bool | None:
    """Block until one of the running queries stops, or for ``timeout`` seconds."""
    return spark.streams.awaitAnyTermination(timeout) if timeout else spark.streams.awaitAnyTermination()
