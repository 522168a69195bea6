"""SimHash near-dedup: pivot distance tables discard pairs before their fingerprints are compared."""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import components, kept, small_batches, word_blocks

BITS, BLOCK = 64, 16


def simhash(data: bytes, shingle: int = 3) -> int:
    """The fingerprint of a whole text: bit i is 1 if set in over half the shingles' XXH64 (seed 42); signed, 0 if no words."""
    ones, total, few = np.zeros(BITS, np.int64), 0, []
    for words in word_blocks(data.lower(), overlap=shingle - 1):
        few = words  # of a text of fewer words the last block has all
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
        hashes = np.array([xxhash.xxh64_intdigest(s, 42) for s in shingles], "<u8")
        total += len(hashes)
        for at in range(0, len(hashes), 1 << 16):
            part = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
            ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    if not total:
        return int(np.uint64(xxhash.xxh64_intdigest(b" ".join(few), 42)).astype(np.int64)) if few else 0
    return int(np.packbits(2 * ones > total, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = 3) -> Column:
    small_batches(docs.sparkSession)

    @F.pandas_udf("long")
    def fingerprint(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash(t.encode(), shingle) if t else 0 for t in texts], dtype="int64")

    return fingerprint(F.col(text))


def pivots(count: int = 16) -> list[int]:
    """Reference fingerprints, the same in every run: XXH64 of their number, signed."""
    return [int(np.uint64(xxhash.xxh64_intdigest(b"pivot %d" % i, 42)).astype(np.int64)) for i in range(count)]


def distance_table(prints: DataFrame, count: int = 16) -> DataFrame:
    """``fp`` with its Hamming distances to ``count`` pivots, eight to a long (``d0``, ``d1`` ..)."""
    near = [F.bit_count(F.col("fp").bitwiseXOR(F.lit(p))).cast("long") for p in pivots(count)]
    packed = []
    for at in range(0, count, 8):
        word = near[at]
        for place, d in enumerate(near[at + 1 : at + 8], 1):
            word = word.bitwiseOR(F.shiftleft(d, 8 * place))
        packed.append(word.alias(f"d{at // 8}"))
    return prints.select("fp", *packed)


def near_links(prints: DataFrame, within: int = 2, count: int = 16) -> DataFrame:
    """Pairs (``a``, ``b``) of different fingerprints at ``within`` or fewer bits; within is 0, 1 or 2.

    Fingerprints meet in cells: of four 16-bit blocks, two must agree if at most two bits differ, so a cell is a pair
    of blocks with their bits. Of a cell's pairs those are discarded whose distances to any pivot differ by more than
    ``within`` (a triangle inequality, so none is lost); survivors are compared bit by bit. All this is the join's
    condition: only links leave it. A crowded cell can be split by the join, as it holds distinct fingerprints only.
    """
    if not 0 <= within <= 2:
        raise ValueError("cells of two blocks in four find pairs up to two bits apart")
    blocks = BITS // BLOCK
    part = [F.shiftrightunsigned("fp", BLOCK * i).bitwiseAND(F.lit((1 << BLOCK) - 1)) for i in range(blocks)]
    cells, pair = [], 0
    for i in range(blocks):
        for j in range(i + 1, blocks):
            cells.append(F.lit(pair << 32).bitwiseOR(F.shiftleft(part[i], BLOCK)).bitwiseOR(part[j]))
            pair += 1
    longs = [f"d{i}" for i in range(count // 8)]
    dealt = distance_table(prints, count).select("fp", *longs, F.explode(F.array(*cells)).alias("cell"))
    a, b = dealt.alias("a"), dealt.alias("b")

    def apart(name: str, place: int) -> Column:
        get = lambda side: F.shiftright(F.col(f"{side}.{name}"), 8 * place).bitwiseAND(F.lit(255))
        return F.abs(get("a") - get("b"))

    discarded = F.greatest(*[apart(name, place) for name in longs for place in range(8)]) > within
    close = F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= within
    meet = (F.col("a.cell") == F.col("b.cell")) & (F.col("a.fp") < F.col("b.fp"))
    return a.join(b, meet & ~discarded & close).select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, within: int = 2) -> DataFrame:
    """(id, fingerprint, fp, component_id) per row; the component is named by the smallest id reachable by links.

    Links join distinct fingerprints only; copies follow through their fingerprint, so a group of any size costs one
    row each. Null and wordless texts have fingerprint zero and link like any other. Null ids stay, and name a component only
    if it has no other (then null). Other columns are ignored; an empty table gives no rows.
    """
    prints = kept(docs.select(F.col(id_col).alias("doc_id"), fingerprints(docs, text_col, shingle).alias("fp")))
    distinct = kept(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = components(near_links(distinct.select("fp"), within))
    named = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    names = named.join(smallest, "root").select("fp", "component_id")
    found = prints.join(names, "fp", "left")
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "fp", "component_id")


def row_mark(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def one_each(docs: DataFrame, thin: DataFrame, roots: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows of ``docs`` with the smallest id among those of a root; ``thin`` has (_id, _mark, node) of each row, ``roots`` what links join."""
    distinct = thin.groupBy("node").agg(F.min(F.struct(F.col("_id").isNull(), "_id", "_mark")).alias("first"))
    named = distinct.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    stay = named.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first._id").alias("_id"), F.col("first._mark").alias("_mark"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(id_col).alias("_own"), row_mark(text_col).alias("_own_mark"))
    match = F.col("_own").eqNullSafe(F.col("_id")) & (F.col("_own_mark") == F.col("_mark"))
    chosen = rows.join(stay, match, "left_semi")
    one = chosen.groupBy("_own_mark", "_own").agg(F.first("_row").alias("_row"))
    return one.select("_row.*")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, within: int = 2) -> DataFrame:
    """One row of each near-duplicate group of ``docs``, with all its columns: that with the smallest id.

    Ids that repeat are told apart by their texts; of rows equal in both one stays.
    """
    thin = kept(docs.select(F.col(id_col).alias("_id"), row_mark(text_col).alias("_mark"), fingerprints(docs, text_col, shingle).alias("node")))
    roots = components(near_links(thin.select(F.col("node").alias("fp")).distinct(), within))
    return one_each(docs, thin, roots, id_col, text_col)
