"""Shards by a Feistel permutation of global row numbers: a reproducible shuffle with a computable place per row."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import numbered


def permute(numbers: np.ndarray, total: int, seed: int = 0, rounds: int = 6) -> np.ndarray:
    """The place of each row number in a pseudo-random permutation of 0 .. total - 1.

    A balanced Feistel network permutes the smallest range of 4^w that holds ``total``; a value that lands outside
    is sent through again (cycle walking, under four turns on average), so the result stays a permutation.
    """
    half = np.uint64(max(1, ((max(total, 1) - 1).bit_length() + 1) // 2))
    mask = np.uint64((1 << int(half)) - 1)

    def mixed(x: np.ndarray, turn: int) -> np.ndarray:
        key = np.uint64((seed * 0x9E3779B97F4A7C15 + (turn + 1) * 0xD1B54A32D192ED03) & (2**64 - 1))
        x = (x ^ key) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(32))

    out = numbers.astype(np.uint64)
    todo = np.arange(len(out))
    with np.errstate(over="ignore"):
        while len(todo):
            left, right = out[todo] >> half, out[todo] & mask
            for turn in range(rounds):
                left, right = right, left ^ (mixed(right, turn) & mask)
            out[todo] = (left << half) | right
            todo = todo[out[todo] >= total]
    return out.astype(np.int64)


def feistel_shards(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 24, seed: int = 20240
) -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard) per row, by the law ``rows``: counts at most one apart.

    A row's place is the Feistel permutation of its global row number; place modulo ``shards`` is the shard, the
    quotient the slot, so slots have no gaps. Row numbers follow (id, checksum, size), not how the table is split, so
    any later run finds the same places. Texts leave the scan as size and checksum only. Null text: size 8, checksum
    of nothing (0). Null and repeated ids each keep a place of their own. Other columns are ignored; an empty table
    gives no rows.
    """
    data = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    thin = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(data) + 8).cast("long").alias("size"), F.crc32(data).alias("text_crc32"))
    rows, total = numbered(thin, ["doc_id", "text_crc32", "size"])

    @F.pandas_udf("long")
    def place(numbers: pd.Series) -> pd.Series:
        return pd.Series(permute(numbers.to_numpy(), total, seed))

    at = rows.withColumn("_place", place("row_number"))
    return at.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), (F.col("_place") % shards).cast("int").alias("shard"),
        F.floor(F.col("_place") / shards).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
