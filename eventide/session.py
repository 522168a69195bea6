"""Session settings and the shared folder for reliable checkpoints."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the operators rely on. Event time is handled in UTC throughout; AQE
# coalesces small shuffle partitions and splits skewed join partitions.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A checkpoint's files go when nothing refers to it any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # On a stream, merge a user's sessions in each task before they are shuffled.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def build_session(app: str = "eventide", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Bring a session built elsewhere to the settings the operators rely on."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Folder for ``DataFrame.checkpoint()`` and for streaming state.

    A folder named by the cluster (``spark.checkpoint.dir``) or already set on the
    context wins. Only a local master gets a temporary one; a cluster without a
    shared folder is an error, since a machine-local folder dies with its machine.
    """
    context = spark.sparkContext
    current = context._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="eventide-checkpoint-")
    context.setCheckpointDir(named)
    return context._jsc.sc().getCheckpointDir().get()


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the checkpoint root, for one streaming run's output and state."""
    return f"{checkpoint_root(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
