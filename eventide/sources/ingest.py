"""From messages to typed events: sources, decoding, quarantine, channels, lake reads."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from eventide.sinks.tables import BATCH, ForeachBatch

# Columns of a message, as Spark's Kafka source names them.
ENVELOPE = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)
# The contract's required fields that both shapes of producers send; a stricter list can be given.
MUST_HAVE = ("event_id", "user_id", "event_type", "timestamp")
_BROKEN = "_broken"


def contract_fields(schema: T.StructType) -> tuple[str, ...]:
    """Every field that the contract declares as never null."""
    return tuple(f.name for f in schema.fields if not f.nullable)


def read_events(
    spark: SparkSession, source: str | list[str], fmt: str = "kafka", *, streaming: bool = True, **options: str
) -> DataFrame:
    """Messages from Kafka topics (from the earliest offset unless told otherwise), or from files
    holding the same columns (``parquet``, ``json``) or one JSON event per line (``text``)."""
    reader = spark.readStream if streaming else spark.read
    if fmt == "kafka":
        topics = source if isinstance(source, str) else ",".join(source)
        settings = {"startingOffsets": "earliest", "subscribe": topics, **options}
        return reader.format("kafka").options(**settings).load()
    if fmt == "text":
        lines = reader.format("text").options(**options).load(source)
        empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in ENVELOPE.fields if f.name != "value"]
        return lines.select(F.col("value").cast("binary").alias("value"), *empty).select(*ENVELOPE.names)
    return reader.format(fmt).schema(ENVELOPE).options(**options).load(source)


def message_key() -> Column:
    return F.col("key").cast("string")


def _decoded(schema: T.StructType) -> Column:
    """The message as a struct of contract fields plus a field set where the text is broken."""
    # Decoding fills in nulls whatever the contract says, so the fields are declared nullable.
    relaxed = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
    relaxed = relaxed.add(_BROKEN, T.StringType(), True)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN}
    return F.from_json(F.col("value").cast("string"), relaxed, options)


def _judged(schema: T.StructType, required: Sequence[str]) -> Column:
    """One-element array of the decoded message and what is wrong with it. Being an array element
    makes the optimizer decode once: a filter on a decoded column would be pushed below the
    projection and decode again."""

    def fault(data: Column) -> Column:
        found = F.when(data.isNull() | data[_BROKEN].isNotNull(), "undecodable")
        for name in required:
            if name in schema.names:
                found = found.when(data[name].isNull(), f"no {name}")
        return found

    return F.transform(F.array(_decoded(schema)), lambda d: F.struct(d.alias("data"), fault(d).alias("reason")))


def parse_events(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Contract columns of every message; what cannot be decoded is null."""
    return raw.select(_decoded(schema).alias("_data")).select(*[F.col(f"_data.{f.name}") for f in schema.fields])


def valid_events(raw: DataFrame, schema: T.StructType, required: Sequence[str] = MUST_HAVE) -> DataFrame:
    """Contract columns of the messages that decode and carry the ``required`` fields."""
    good = F.filter(_judged(schema, required), lambda m: m["reason"].isNull())
    return raw.select(F.inline(good)).select(*[F.col(f"data.{f.name}") for f in schema.fields])


def quarantine(raw: DataFrame, schema: T.StructType, *keep: str, required: Sequence[str] = MUST_HAVE) -> DataFrame:
    """The other messages, as text, with the reason and the envelope columns named in ``keep``."""
    bad = F.filter(_judged(schema, required), lambda m: m["reason"].isNotNull())
    return raw.select(*keep, F.col("value").cast("string").alias("value"), F.inline(bad)).drop("data")


def judged_events(raw: DataFrame, schema: T.StructType, *keep: str, required: Sequence[str] = MUST_HAVE) -> DataFrame:
    """Every message once: ``data`` (contract columns) where ``reason`` is null, else the reason and the text."""
    return raw.select(*keep, F.col("value").cast("string").alias("value"), F.inline(_judged(schema, required)))


def split_sink(schema: T.StructType, good: str, bad: str, *keep: str, required: Sequence[str] = MUST_HAVE) -> ForeachBatch:
    """Foreach-batch writer of valid events to ``good`` and of the others to ``bad``, decoding each message once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        judged = judged_events(batch, schema, *keep, required=required).persist()
        try:
            right = judged.where("reason is null").select(*[F.col(f"data.{f.name}") for f in schema.fields])
            right.write.mode("overwrite").parquet(f"{good}/{BATCH}={batch_id}")
            judged.where("reason is not null").drop("data").write.mode("overwrite").parquet(f"{bad}/{BATCH}={batch_id}")
        finally:
            judged.unpersist()

    return write


def union_channels(channels: dict[str | None, DataFrame]) -> DataFrame:
    """Events of several sources in one frame, labelled with their channel; a source without a name has the channel null."""
    labelled = [df.withColumn("channel", F.lit(name).cast("string")) for name, df in channels.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), labelled)


def to_jsonl(df: DataFrame) -> DataFrame:
    """One compact JSON object per row, nulls written out, timestamps in ISO-8601."""
    options = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"}
    return df.select(F.to_json(F.struct("*"), options).alias("value"))


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def sample_rows(df: DataFrame, n: int = 20) -> DataFrame:
    return df.limit(n)


def type_distribution(ev: DataFrame) -> DataFrame:
    return ev.groupBy("event_type").count().orderBy(F.desc("count"))
