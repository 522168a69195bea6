"""Exact dedup by content sort, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm.common import SPACE, kept


def content_sort(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_row: bool = False) -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256[, row]) per row: equal normalised texts keep their smallest id.

    Texts are equal when identical after each run of white space has become one space; null counts as empty.
    Rows are range-partitioned at sampled splitters by (leading text, digest, part) and sorted externally within by
    (leading text, digest, part, text, id), so equal texts are adjacent; the group borders come from comparing whole
    neighbouring texts. The one exchange is the range partitioning, which the window's grouping then reuses; its
    splitters are short keys, never texts.

    A group of copies larger than its fair share, rows / (4 x partitions), is cut into parts by a hash of the id. There
    are fewer than 4 x partitions such groups, which bounds the broadcasts; their parts' first rows, with whole texts,
    meet in a second small window.

    Null ids sort last; of rows that are equal even in id one stays. ``with_row`` adds the input row as a struct, which
    keeps extra columns from clashing. An empty table gives no rows.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    norm = F.regexp_replace(F.coalesce(F.col("_text"), F.lit("")), SPACE, " ")
    row = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")] if with_row else []
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"), *row)
    keyed = base.withColumn("_norm", norm).withColumn("_sha", F.sha2(F.encode("_norm", "UTF-8"), 256))

    sizes = kept(keyed.groupBy("_sha").agg(F.count("*").alias("_n")).where("_n > 1"))
    total = docs.count()
    share = max(1, total // (4 * parts))
    large = F.broadcast(sizes.where(F.col("_n") > share).select("_sha", F.ceil(F.col("_n") / share).cast("int").alias("_cuts")))

    dealt = keyed.join(large, "_sha", "left").select(
        "doc_id", "_text", *(["_row"] if with_row else []), "_sha", F.substring("_norm", 1, 24).alias("_lead"),
        F.coalesce(F.pmod(F.xxhash64("doc_id"), F.col("_cuts")), F.lit(-1)).alias("_part"),
    )
    ranged = dealt.repartitionByRange(parts, "_lead", "_sha", "_part").withColumn("_norm", norm)
    group = Window.partitionBy("_lead", "_sha", "_part", "_norm")
    order = group.orderBy(F.asc_nulls_last("doc_id"))
    sorted_rows = ranged.select(
        "doc_id", *(["_row"] if with_row else []), "_sha", "_part", F.first("doc_id").over(order).alias("_first"),
        F.count("*").over(group).alias("_count"), F.row_number().over(order).alias("_at"), "_norm",
    )
    run = F.xxhash64("_norm", F.length("_norm"))
    thin = kept(
        sorted_rows.select(
            "doc_id", *(["_row"] if with_row else []), "_sha", "_part", "_first", "_count", "_at",
            F.when(F.col("_part") >= 0, run).alias("_run"), F.when((F.col("_part") >= 0) & (F.col("_at") == 1), F.col("_norm")).alias("_norm"),
        )
    )

    same = Window.partitionBy("_sha", "_norm")
    first = same.orderBy(F.asc_nulls_last("_first"), "_part")
    merged = thin.where("_norm is not null").select(
        "_sha", "_part", "_run", F.first("_first").over(first).alias("_keep"), F.sum("_count").over(same).alias("_all"),
        (F.row_number().over(first) == 1).alias("_leads"),
    )
    whole = thin.join(F.broadcast(merged), ["_sha", "_part", "_run"], "left")
    split = F.col("_leads").isNotNull()
    return whole.select(
        "doc_id", F.when(split, F.col("_keep")).otherwise(F.col("_first")).alias("keep_id"),
        F.when(split, F.col("_all")).otherwise(F.col("_count")).cast("long").alias("group_size"),
        ((F.col("_at") == 1) & F.coalesce(F.col("_leads"), F.lit(True))).alias("kept"), F.col("_sha").alias("text_sha256"), *(["_row"] if with_row else []),
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    return content_sort(docs, id_col, text_col, with_row=True).where("kept").select("_row.*")
