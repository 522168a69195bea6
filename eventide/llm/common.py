"""What several operators share: tables, folds, whole-text helpers, reliable checkpoints, connected components."""

from __future__ import annotations

import gc
import pickle
import uuid
from collections.abc import Iterator
from typing import Any

from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventide.session import checkpoint_root

# The white space of the contracts, as a Java and Python character class.
SPACE = r"[\x20\x09-\x0D]+"
ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the identifier as text, modulo ``folds``; a null identifier falls in fold 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds, F.lit(0)).cast("int")


def kept(df: DataFrame) -> DataFrame:
    """``df`` as written to the shared checkpoint folder, read by several later branches."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder that the driver and all executors see."""
    return f"{checkpoint_root(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of :func:`shared_folder` that nothing reads any more."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def release(spark: SparkSession) -> None:
    """Have Spark remove the shuffle files and broadcasts of what nothing refers to any more.

    It does so when the driver collects garbage, which a driver with little to do puts off while the executors' disks fill.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def send(spark: SparkSession, model: object) -> Broadcast:
    """Broadcast a model of bounded size; pickled by value, as executors have no copy of its class."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(model))


def received(sent: Broadcast) -> Any:
    return pickle.loads(sent.value)


def small_batches(spark: SparkSession, rows: int = 1000, mb: int = 16) -> None:
    """Bound what one Arrow batch of whole texts holds: a batch ends at ``rows`` rows or ``mb`` MB."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", mb << 20)


def word_blocks(data: bytes, size: int = 1 << 20, overlap: int = 0) -> Iterator[list[bytes]]:
    """The white-space separated words of ``data`` in order, about ``size`` bytes at a time.

    Each later block starts with the last ``overlap`` words before it (fewer where there are no more), so that
    shingles of overlap + 1 words are whole and none is seen twice. At least one block, which may be empty.
    """
    if len(data) <= size:
        yield data.split()
        return
    carried: list[bytes] = []
    at = 0
    while at < len(data):
        end = min(len(data), at + size)
        while end < len(data) and data[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        words = carried + data[at:end].split()
        yield words
        carried = words[-overlap:] if overlap else []
        at = end


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of undirected links (``a``, ``b``): (``node``, ``root``), root the smallest reachable node.

    Alternating large-star and small-star steps: every step moves links closer to their root and needs two
    shuffles; a node of any degree is reduced by partial aggregation and its join may be split. A step's links are
    checkpointed; only their count and checksum come to the driver. Nodes without a link do not appear.
    """
    links = kept(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = _mark(links)
    for _ in range(rounds):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a")
        small = small.select("b", "m").where("b <> m").toDF("a", "b").unionByName(lowest.toDF("a", "b")).distinct()
        links = kept(small)
        before, mark = mark, _mark(links)
        if before == mark:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def numbered(df: DataFrame, keys: list[str], buckets: int = 4096) -> tuple[DataFrame, int]:
    """Rows of a thin table with a global row number from 0 (``row_number``), and how many rows there are.

    The number depends on the rows alone: rows are dealt to ``buckets`` by a hash of ``keys``, ordered by ``keys``
    within, and the buckets' counts (one row per bucket, which bounds the broadcast and the one-task window) put
    the buckets one after the other. Equal rows may swap numbers, which shows nowhere.
    """
    dealt = df.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)))
    counts = kept(dealt.groupBy("_bucket").agg(F.count("*").alias("_n")))
    total = counts.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy(*keys))
    placed = dealt.withColumn("_in", inside).join(F.broadcast(offsets), "_bucket")
    return placed.withColumn("row_number", F.col("_before") + F.col("_in") - 1).drop("_bucket", "_in", "_before"), total
