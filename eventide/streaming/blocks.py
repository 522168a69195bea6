"""Count windows on a stream.

Each micro-batch is numbered in arrival order by the batch operator's own method, which splits a heavy key over
many tasks, and continued from the open blocks of the batch before. There is no Python and no state store: a
batch's full blocks and what it leaves open lie in folders named after it, so a replayed batch reads the same
state and replaces what it wrote.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from eventide.functions.timing import duration_micros, plus
from eventide.operators.rows import ARRIVAL
from eventide.plans.ordered import Running, ordered_runs, running
from eventide.sinks.tables import BATCH, ForeachBatch


def _open_schema(key: str) -> T.StructType:
    return T.StructType.fromDDL(f"{key} string, block long, count long, first_ts timestamp, last_ts timestamp, touched timestamp")


def _open_before(spark: SparkSession, path: str, key: str, batch_id: int) -> DataFrame:
    schema = _open_schema(key)
    if batch_id == 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/open/{BATCH}={batch_id - 1}")


def count_blocks(path: str, key: str = "user_id", n: int = 100, arrival: Sequence[str] = ARRIVAL, ttl: str | None = None) -> ForeachBatch:
    """The foreach-batch writer; ``path`` gets the folders ``blocks`` (full ones) and ``open`` (a row per key).

    With ``ttl`` a key's open block is forgotten when that much processing time has passed without events. Events without
    a time count like any other; a block's first and last time are then those of its other events.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = _open_before(spark, path, key, batch_id)
        if ttl:
            before = before.where(F.col("touched") >= plus(F.current_timestamp(), -duration_micros(ttl)))
        narrow = batch.select(F.col(key).cast("string").alias(key), "event_timestamp", *arrival)
        numbered = running(ordered_runs(narrow, [key], arrival), [key], arrival, _number=Running("sum", F.lit(1)))
        left = before.select(F.col(key).alias("_key"), F.col("block").alias("_block"), F.col("count").alias("_have"))
        continued = numbered.join(left, F.col(key).eqNullSafe(F.col("_key")), "left")
        place = F.coalesce("_have", F.lit(0)) + F.col("_number") - 1
        block = F.coalesce("_block", F.lit(0)) + F.floor(place / F.lit(n)).cast("long")
        fresh = continued.groupBy(key, block.alias("block")).agg(
            F.count(F.lit(1)).alias("count"), F.min("event_timestamp").alias("first_ts"), F.max("event_timestamp").alias("last_ts"),
            F.current_timestamp().alias("touched"),
        )
        merged = before.unionByName(fresh).groupBy(key, "block").agg(
            F.sum("count").alias("count"), F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"), F.max("touched").alias("touched")
        ).persist()
        try:
            full = F.col("count") == n
            merged.where(full).drop("touched").write.mode("overwrite").parquet(f"{path}/blocks/{BATCH}={batch_id}")
            last = merged.groupBy(key).agg(F.max_by(F.struct("block", "count", "first_ts", "last_ts", "touched"), "block").alias("_b")).select(key, "_b.*")
            none = F.lit(None).cast("timestamp")
            left_open = last.select(
                key, (F.col("block") + full.cast("long")).alias("block"), F.when(full, 0).otherwise(F.col("count")).cast("long").alias("count"),
                F.when(full, none).otherwise(F.col("first_ts")).alias("first_ts"), F.when(full, none).otherwise(F.col("last_ts")).alias("last_ts"), "touched",
            )
            left_open.write.mode("overwrite").parquet(f"{path}/open/{BATCH}={batch_id}")
        finally:
            merged.unpersist()

    return process


def full_blocks(spark: SparkSession, path: str, key: str = "user_id") -> DataFrame:
    schema = f"{key} string, block long, count long, first_ts timestamp, last_ts timestamp"
    return spark.read.schema(schema).parquet(f"{path}/blocks").drop(BATCH)
