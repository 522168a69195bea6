"""Hard negatives by exact inner products, most pairs ruled out by rotated one-bit codes.

A vector is rotated and coded by its signs, one bit a component; its alignment with that code is stored. What the code leaves is coded the
same way, a few levels deep, so that vector = a1 c1 + a2 c2 + .. + rest, with unit codes c and the rest's length known. A query is rotated
too and its components rounded to a few bit planes: popcounts of code bits with planes give its inner products with the codes. By
Cauchy-Schwarz the rest changes the product by no more than its length times the query's: an interval that holds the true product.
Only pairs whose interval reaches what is wanted are scored, in integers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm.common import kept, received, send, small_batches

LIMIT = 1 << 26  # a long holds inner products of smaller components
LEVELS, PLANES = 4, 6
TILE = 1 << 20  # pairs judged at a time


def rotation(size: int) -> np.ndarray:
    """An orthogonal matrix, the same in every process."""
    return np.linalg.qr(np.random.default_rng(20240 + size).normal(size=(size, size)))[0]


@dataclass
class Codes:
    """Rows of one length: sign codes of each level as words, alignments, what no code holds, and the length of the whole."""

    bits: np.ndarray  # rows, levels, words
    align: np.ndarray  # rows, levels
    rest: np.ndarray
    norm: np.ndarray


def words_of(bits: np.ndarray) -> np.ndarray:
    """Booleans packed along the last axis into 64-bit words, the last one filled up with zeros."""
    raw = np.packbits(bits, axis=-1, bitorder="little")
    pad = -raw.shape[-1] % 8
    return np.concatenate([raw, np.zeros((*raw.shape[:-1], pad), np.uint8)], axis=-1).view("<u8") if pad else np.ascontiguousarray(raw).view("<u8")


def encode(values: np.ndarray, levels: int = LEVELS) -> Codes:
    size = values.shape[1]
    rest, bits, align = values @ rotation(size), [], []
    norm = np.sqrt((rest**2).sum(axis=1))
    for _ in range(levels):
        up = rest >= 0
        along = np.abs(rest).sum(axis=1) / np.sqrt(size)
        rest = rest - np.where(up, along[:, None], -along[:, None]) / np.sqrt(size)
        bits.append(words_of(up))
        align.append(along)
    return Codes(np.stack(bits, axis=1), np.stack(align, axis=1), np.sqrt((rest**2).sum(axis=1)), norm)


@dataclass
class Queries:
    """Rotated queries rounded to whole steps, lifted to be no less than zero, as bit planes."""

    planes: np.ndarray  # rows, planes, words
    step: np.ndarray
    lift: np.ndarray
    total: np.ndarray  # sum of the lifted steps
    error: np.ndarray  # length of what rounding took
    norm: np.ndarray
    size: int


def prepare(values: np.ndarray, planes: int = PLANES) -> Queries:
    turned = values @ rotation(values.shape[1])
    low = turned.min(axis=1)
    step = np.maximum((turned.max(axis=1) - low) / ((1 << planes) - 1), 1e-12)
    steps = np.rint((turned - low[:, None]) / step[:, None]).astype(np.int64)
    error = np.sqrt((((steps * step[:, None] + low[:, None]) - turned) ** 2).sum(axis=1))
    bits = (steps[:, None, :] >> np.arange(planes)[None, :, None]) & 1
    return Queries(words_of(bits.astype(np.uint8)), step, low, steps.sum(axis=1), error, np.sqrt((turned**2).sum(axis=1)), values.shape[1])


def intervals(q: Queries, c: Codes) -> tuple[np.ndarray, np.ndarray]:
    """(least, greatest) product of each query (row) with each vector (column); the true one is never outside.

    A code's signs are 2 bit - 1, so its product with the rounded query is twice what popcounts give less the total, by the step,
    plus the lift times the sum of the signs.
    """
    centre = np.zeros((len(q.step), len(c.rest)))
    root = np.sqrt(q.size)
    for level in range(c.bits.shape[1]):
        code = c.bits[:, level]
        hits = np.zeros(centre.shape, np.int32)
        for plane in range(q.planes.shape[1]):
            for word in range(code.shape[1]):
                hits += np.bitwise_count(q.planes[:, plane, word, None] & code[None, :, word]).astype(np.int32) << plane
        signs = 2 * np.bitwise_count(code).sum(axis=1, dtype=np.int64) - q.size
        along = (q.step[:, None] * (2 * hits - q.total[:, None]) + q.lift[:, None] * signs[None, :]) / root
        centre += c.align[None, :, level] * along
    held = c.norm + c.rest  # at least the length of what the codes hold
    slack = q.norm[:, None] * c.rest[None, :] + q.error[:, None] * held[None, :] + 1e-7 * (1 + q.norm[:, None] * c.norm[None, :])
    return centre - slack, centre + slack


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of equally many rows."""
    return np.einsum("ij,ij->i", a, b)


class Best:
    """The ``k`` best (score, id) of each of ``n`` slots: higher scores first, then smaller ids. Rows that repeat count each."""

    def __init__(self, n: int, k: int) -> None:
        self.k, self.slot, self.score, self.name = k, *(np.zeros(0, np.int64) for _ in range(3))
        self.least = np.full(n, np.iinfo(np.int64).min)  # score to reach, where a slot is full

    def add(self, slot: np.ndarray, score: np.ndarray, name: np.ndarray) -> None:
        slot, score, name = (np.concatenate(x) for x in ((self.slot, slot), (self.score, score), (self.name, name)))
        order = np.lexsort((name, -score, slot))
        slot, score, name = slot[order], score[order], name[order]
        first = np.searchsorted(slot, slot)
        place = np.arange(len(slot)) - first
        stay = place < self.k
        self.slot, self.score, self.name = slot[stay], score[stay], name[stay]
        last = place[stay] == self.k - 1
        self.least[self.slot[last]] = self.score[last]


def usable(vector: Column, scale: int) -> Column:
    """A vector with components, none null or non-finite (nor too large for exact products)."""
    fine = lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(LIMIT / scale))
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, fine), F.lit(False))


def rows_of(vectors: DataFrame, id_col: str, label_col: str, vector_col: str, scale: int, changed: int, labels: int) -> DataFrame:
    """(id, label, values) of the rows that take part, as the contract changes them, written once for all blocks."""
    name, label = F.col(id_col).cast("long"), F.col(label_col).cast("long")
    label = F.when(name % changed == 0, (label + 1) % labels).otherwise(label)
    values = F.transform(F.col(vector_col), lambda x: F.floor(x.cast("double") * scale))
    rows = vectors.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & usable(F.col(vector_col), scale))
    return kept(rows.select(name.alias("id"), label.alias("label"), values.alias("values")))


@dataclass
class Anchors:
    """A block of anchors of one length, which bounds what is sent to tasks."""

    name: np.ndarray
    label: np.ndarray
    values: np.ndarray


def blocks(rows: DataFrame, every: int, most: int) -> Iterator[Anchors]:
    """The anchors, ``most`` at a time: packed by tasks into blocks in the shared folder, which the driver reads one after the other."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for size, same in batch.groupby(batch["values"].str.len()):
                for at in range(0, len(same), most):
                    some = same.iloc[at : at + most]
                    stacked = np.stack(some["values"].to_numpy()).astype("<i8")
                    yield pd.DataFrame({"size": [size], "n": [len(some)], "name": [some["id"].to_numpy("<i8").tobytes()], "label": [some["label"].to_numpy("<i8").tobytes()], "values": [stacked.tobytes()]})

    packs = kept(rows.where(F.col("id") % every == 0).mapInPandas(pack, "size int, n int, name binary, label binary, values binary"))
    packs = kept(packs.withColumn("no", F.monotonically_increasing_id()))
    listed = packs.select("no", "size", "n").orderBy("size", "no").toLocalIterator()
    group: list[tuple[int, int, int]] = []

    def load() -> Anchors:
        found = packs.where(F.col("no").isin([no for no, _, _ in group])).collect()
        joined = {c: np.frombuffer(b"".join(r[c] for r in found), "<i8") for c in ("name", "label", "values")}
        return Anchors(joined["name"], joined["label"], joined["values"].reshape(-1, group[0][1]))

    for no, size, n in listed:
        if group and (group[0][1] != size or sum(x[2] for x in group) + n > most):
            yield load()
            group = []
        group.append((no, size, n))
    if group:
        yield load()


def _searched(rows: DataFrame, anchors: Anchors, judge: Callable, schema: str, *more: object) -> DataFrame:
    """``judge(anchors, batches of (ids, labels, values), ..)`` in every task over the rows that have as many components as the anchors."""
    size = anchors.values.shape[1]
    sent = send(rows.sparkSession, (anchors, *more))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, *rest = received(sent)
        arrays = ((b["id"].to_numpy(np.int64), b["label"].to_numpy(np.int64), np.stack(b["values"].to_numpy()).astype(np.int64)) for b in batches if len(b))
        yield judge(block, arrays, *rest)

    return rows.where(F.size("values") == size).mapInPandas(search, schema)


def tiles(anchors: np.ndarray, rows: int) -> Iterator[np.ndarray]:
    """Anchors in parts small enough to meet ``rows`` rows at once."""
    step = max(1, TILE // max(rows, 1))
    for at in range(0, len(anchors), step):
        yield anchors[at : at + step]


def task_positives(a: Anchors, batches: Iterator, k: int) -> pd.DataFrame:
    """The best ``k`` rows of each anchor's label that a task has. Anchors meet the rows of their label only."""
    best, queries = Best(len(a.name), k), prepare(a.values)
    for names, labels, values in batches:
        codes = encode(values)
        for label in np.unique(labels):
            mine, at = np.flatnonzero(labels == label), np.flatnonzero(a.label == label)
            for some in tiles(at, len(mine)):
                _, high = intervals(part(queries, some), part(codes, mine))
                hope = (high >= best.least[some, None]) & (names[mine][None, :] != a.name[some, None])
                i, j = np.nonzero(hope)
                i, j = some[i], mine[j]
                best.add(i, products(a.values[i], values[j]), names[j])
    return pd.DataFrame({"anchor": best.slot, "score": best.score, "id": best.name})


def part(of: Queries | Codes, rows: np.ndarray) -> Queries | Codes:
    return type(of)(**{k: v if k == "size" else v[rows] for k, v in vars(of).items()})


def task_negatives(a: Anchors, batches: Iterator, positives: tuple[np.ndarray, np.ndarray], k: int) -> pd.DataFrame:
    """For each (anchor, positive) the best ``k`` rows of other labels in its range of scores that a task has.

    ``positives``: anchor and score of each, in the order of anchors.
    """
    anchor, score = positives
    floor, top = -(-50 * score // 100), 95 * score // 100
    best, queries, away = Best(len(anchor), k), prepare(a.values), np.iinfo(np.int64).max
    each = np.unique(anchor)
    begins = np.searchsorted(anchor, each)
    for names, labels, values in batches:
        codes = encode(values)
        for some in tiles(np.arange(len(each)), len(names)):
            needed = np.minimum.reduceat(np.maximum(floor, best.least), begins) if len(each) else np.zeros(0)
            most = np.maximum.reduceat(top, begins) if len(each) else np.full(0, away)
            at = each[some]
            low, high = intervals(part(queries, at), codes)
            hope = (high >= needed[some, None]) & (low <= most[some, None]) & (labels[None, :] != a.label[at, None])
            i, j = np.nonzero(hope)
            found = products(a.values[at[i]], values[j])
            rank = some[i]
            for turn in range(int(np.diff([*begins, len(anchor)]).max()) if len(begins) else 0):
                slot = begins[rank] + turn
                inside = slot < np.append(begins, len(anchor))[rank + 1]
                slot = np.where(inside, slot, 0)
                fits = inside & (found >= np.maximum(floor[slot], best.least[slot])) & (found <= top[slot])
                best.add(slot[fits], found[fits], names[j[fits]])
    return pd.DataFrame({"slot": best.slot, "score": best.score, "id": best.name})


def first_of(found: DataFrame, key: str, k: int) -> DataFrame:
    """The best ``k`` rows of each key over all tasks, ranked from 1; partial lists are cut before they are shuffled."""
    order = Window.partitionBy(key).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    vectors: DataFrame, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding", *, every: int = 50, positives: int = 5,
    negatives: int = 3, scale: int = 256, changed: int = 7, labels: int = 10, block: int = 16384,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of each anchor's hard negatives.

    Anchors are rows whose id is divisible by ``every``; components become floor(``scale`` x); where the id is divisible by ``changed``
    the label becomes (label + 1) % ``labels``. An anchor's positives are its ``positives`` best other rows of its label, its negatives
    per positive the best ``negatives`` rows of other labels with 50 positive_score <= 100 score <= 95 positive_score. Higher scores come
    first, then smaller ids. Scores are exact: intervals only say which pairs need none.

    Rows with a null id, label or vector, an empty vector, or a component that is null, not finite or 2^26 or more after scaling take no
    part. Only vectors of equally many components meet. Rows that repeat an id count each; those with an anchor's id are not its own
    positives or negatives. Anchors without a positive, and positives without a negative in range (none with a score below zero),
    have no rows. Other columns are ignored; an empty table gives no rows.

    Anchors go out in blocks of at most ``block``, whatever their number; a job per block has every row judged where it lies, and a
    task sends ``positives`` rows per anchor, then ``negatives`` per positive.
    """
    spark = vectors.sparkSession
    small_batches(spark, rows=4096)
    rows = rows_of(vectors, id_col, label_col, vector_col, scale, changed, labels)
    parts = []
    for anchors in blocks(rows, every, block):
        found = _searched(rows, anchors, task_positives, "anchor long, score long, id long", positives)
        best = first_of(found, "anchor", positives).orderBy("anchor", "rank").toPandas()
        anchor, score = best["anchor"].to_numpy(np.int64), best["score"].to_numpy(np.int64)
        found = _searched(rows, anchors, task_negatives, "slot long, score long, id long", (anchor, score), negatives)
        names = [(n, int(anchors.name[i]), int(p), int(s)) for n, (i, p, s) in enumerate(zip(anchor, best["id"], score, strict=True))]
        pairs = spark.createDataFrame(names, "slot long, anchor_id long, positive_id long, positive_score long")
        closest = first_of(found, "slot", negatives).join(F.broadcast(pairs), "slot")
        parts.append(kept(closest.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))))
    if not parts:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    whole = parts[0]
    for one in parts[1:]:
        whole = whole.unionByName(one)
    return whole
