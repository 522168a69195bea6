"""Writing results: keyed upserts, an upsert log for streams, partitioned and database tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

BATCH = "batch_id"
ForeachBatch = Callable[[DataFrame, int], None]


def last_per_key(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_row"))
    return newest.select(*[c if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], update_cols: Sequence[str], order: str | None = None
) -> DataFrame:
    """``target`` after inserting ``source`` with, on equal keys, only ``update_cols`` replaced.

    Keys are unique in the target; give ``order`` if the source may repeat one, the last row then
    counts. A marker column, not a value, says whether the source had the row: an update to null is
    an update.
    """
    incoming = last_per_key(source, keys, order) if order else source
    values = [c for c in target.columns if c not in keys]
    new = incoming.select(*keys, F.lit(True).alias("_new"), *[F.col(c).alias(f"_{c}") for c in values if c in incoming.columns])
    old = target.withColumn("_old", F.lit(True))
    both = old.join(new, list(keys), "full_outer")

    def merged(c: str):
        if f"_{c}" not in new.columns:
            return F.col(c)
        if c in update_cols:
            return F.when(F.col("_new"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c)
        return F.when(F.col("_old"), F.col(c)).otherwise(F.col(f"_{c}")).alias(c)

    return both.select(*[c if c in keys else merged(c) for c in target.columns])


def upsert_log_sink(path: str) -> ForeachBatch:
    """Each micro-batch's rows in a partition of its own. A replayed batch overwrites its
    partition, so replays change nothing, and a batch costs its own size, not the table's."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    return write


def fold_upserts(
    log: DataFrame, keys: Sequence[str], update_cols: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """Current rows of an upsert log: ``update_cols`` from a key's last row, the rest from its first."""
    at = F.struct(BATCH, *order)
    values = [c for c in log.columns if c not in keys and c != BATCH]
    picks = [(F.max_by if c in update_cols else F.min_by)(c, at).alias(c) for c in values]
    return log.groupBy(*keys).agg(*picks)


def compact_upserts(
    spark: SparkSession, path: str, target: str, keys: Sequence[str], update_cols: Sequence[str], order: Sequence[str] = ()
) -> None:
    """Write the log's current rows as the first batch of a new log."""
    rows = fold_upserts(spark.read.parquet(path), keys, update_cols, order)
    rows.write.mode("overwrite").parquet(f"{target}/{BATCH}=-1")


# Columns that the serving tables hold as decimals, with precision and scale.
DECIMALS = {
    "duration_minutes": (10, 2), "avg_duration_minutes": (10, 2), "bounce_rate": (5, 2), "conversion_rate": (5, 2),
}


def serving_types(df: DataFrame, decimals: dict[str, tuple[int, int]] = DECIMALS) -> DataFrame:
    """``df`` with the serving tables' decimal types; a value that doesn't fit is an error, not a null."""
    named = {c: f"decimal({p},{s})" for c, (p, s) in decimals.items() if c in df.columns}
    return df.withColumns({c: F.round(c, decimals[c][1]).cast(t) for c, t in named.items()})


def partitioned_write(df: DataFrame, path: str, by: str = "window_start", fmt: str = "parquet", mode: str = "append") -> None:
    """A table partitioned by day. The rebalance hint gathers a day's rows into few files and lets
    AQE split a day that is too large for one task."""
    dated = df.withColumn("date", F.to_date(by)).hint("rebalance", "date")
    dated.write.format(fmt).mode(mode).partitionBy("date").save(path)


def append_rows(path: str, fmt: str = "parquet") -> ForeachBatch:
    """Insert-only table for micro-batches, repeatable in the same way as the upsert log."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.format(fmt).mode("overwrite").save(f"{path}/{BATCH}={batch_id}")

    return write


def upsert_statement(table: str, staging: str, columns: Sequence[str], keys: Sequence[str], update_cols: Sequence[str], batch_id: int) -> str:
    """SQL that merges a batch's staged rows into ``table``: new keys are inserted, known ones get ``update_cols``.

    Running it again changes nothing, also if a repeated write has staged rows twice.
    """
    quoted = lambda names: ", ".join(f'"{n}"' for n in names)
    sets = ", ".join(f'"{c}" = EXCLUDED."{c}"' for c in update_cols)
    action = f"UPDATE SET {sets}" if sets else "NOTHING"
    return (
        f"INSERT INTO {table} ({quoted(columns)}) SELECT DISTINCT ON ({quoted(keys)}) {quoted(columns)} FROM {staging} "
        f"WHERE {BATCH} = {int(batch_id)} ORDER BY {quoted(keys)} ON CONFLICT ({quoted(keys)}) DO {action}"
    )


def jdbc_sink(url: str, staging: str, batch_rows: int = 100, connections: int = 8, **properties: str) -> ForeachBatch:
    """Stage micro-batches in a database table, each row with its ``batch_id``, over at most ``connections`` connections.

    Spark's writer only inserts, and a failed task or a replayed batch inserts rows again: :func:`upsert_statement`, run in the
    database per batch, merges staged rows by key whatever their number. Needs a JDBC driver on the classpath; a failed
    batch is repeated by the stream.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        writer = batch.withColumn(BATCH, F.lit(batch_id)).write.format("jdbc").mode("append")
        writer.options(url=url, dbtable=staging, batchsize=batch_rows, numPartitions=connections, **properties).save()

    return write
