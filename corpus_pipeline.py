"""A corpus pipeline: toxic, copied, near-copied and contaminated documents go, the rest is encoded for training.

Every stage reads all that its predecessor kept and returns whole rows of ``documents``, the last one their tokens.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from eventide.llm import contamination, exact, jaccard, pieces, toxicity
from eventide.llm.common import remove_folder, shared_folder, table


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Rows that the string-kernel machine doesn't judge toxic; it learns from the labelled rows among ``docs``."""
    return toxicity.clean(docs, table(spark, folder, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of equal normalised texts the row with the smallest doc_id."""
    return exact.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of documents linked by a Jaccard similarity of at least 0.8 over five-word shingles the row with the smallest doc_id.

    SimHash fingerprints and pivot distance tables name most candidates, prefixes of the shingle sets the others.
    """
    return jaccard.deduplicate(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Rows of which less than 5 % of the words stand in benchmark phrases."""
    return contamination.decontaminate(docs, table(spark, folder, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """(doc_id, ids, n_tokens, n_chunks, round_trip) of every row."""
    return pieces.encode(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("sentencepiece", encode),
]

# Fingerprint components, a trained classifier and BPE aren't SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written to the shared folder and read again by the next.

    A stage's folder goes when the next one's is whole; the last one's stays, as the result reads it. Null and empty texts count as
    clean; of several, one stays. Repeated ids are told apart by their texts. An empty table gives no rows.
    """
    docs, before = table(spark, folder, "documents"), None
    for name, stage in STAGES:
        place = shared_folder(spark, f"pipeline-{name}")
        stage(spark, docs, folder).write.parquet(place)
        docs = spark.read.parquet(place)
        if before:
            remove_folder(spark, before)
        before = place
    return docs
