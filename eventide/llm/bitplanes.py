"""Centroid clustering on bit planes: a vector's 64 components are packed plane by plane into 64-bit words.

A component of b bits in two's complement is the sum of w(i) * bit(i), with w(i) = 2^i and -2^(b-1) for the sign. So a dot product is
the sum over pairs of planes of w(i) * w(j) * popcount(plane i AND plane j), exact in integers, and a squared distance follows from
three of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import kept, received, send

WIDTH = 64  # components of a vector, bits of a word
LIMIT = 1 << 26  # squared distances of smaller components fit a long


def scaled(vector: Column, scale: int) -> Column:
    """Integer components: floor of ``scale`` times each, as double."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def usable(vector: Column, scale: int) -> Column:
    """A vector without null, non-finite or overlong components; null vectors are not usable."""
    fine = lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(LIMIT / scale))  # noqa: E731  NaN is above all numbers
    return F.coalesce(F.forall(vector, fine), F.lit(False))


def weights(planes: int) -> np.ndarray:
    """What a bit of each plane is worth in two's complement."""
    worth = np.int64(1) << np.arange(planes, dtype=np.int64)
    worth[-1] = -worth[-1]
    return worth


def pack(values: np.ndarray, planes: int) -> np.ndarray:
    """(rows, 64) integers as (rows, planes) words: bit j of word i is bit i of component j."""
    bits = (values[:, None, :] >> np.arange(planes)[None, :, None]) & 1
    return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little").view("<u8")[:, :, 0]


def unpack(words: np.ndarray) -> np.ndarray:
    """The integers of :func:`pack`, whose two's complement has as many planes as there are words."""
    bits = np.unpackbits(np.ascontiguousarray(words).view(np.uint8).reshape(*words.shape, 8), axis=2, bitorder="little")
    return np.einsum("rpj,p->rj", bits.astype(np.int64), weights(words.shape[1]))


def dots(words: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Dot product of each row's planes with a centroid's planes."""
    out, mine, theirs = np.zeros(len(words), np.int64), weights(words.shape[1]), weights(len(centroid))
    for i, row_worth in enumerate(mine):
        common = np.bitwise_count(words[:, i, None] & centroid[None, :])
        out += row_worth * (common.astype(np.int64) @ theirs)
    return out


def nearest(words: np.ndarray, norms: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared distance) of each row's nearest centroid; of equally near ones the smallest number."""
    best, where = np.full(len(words), np.iinfo(np.int64).max), np.zeros(len(words), np.int32)
    for number, own in enumerate((centroids**2).sum(axis=1)):
        away = norms - 2 * dots(words, pack(centroids[number : number + 1], planes_for(centroids))[0]) + own
        closer = away < best
        best[closer], where[closer] = away[closer], number
    return where, best


def planes_for(values: np.ndarray) -> int:
    """Planes that hold all the values in two's complement."""
    return int(max(values.max(), -values.min() - 1, 0)).bit_length() + 1 if values.size else 1


def packed_vectors(rows: DataFrame) -> DataFrame:
    """(_id, planes, norm) of (_id, _v) rows, written once for all rounds; ``planes`` are words one after the other."""

    def packs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                values = np.stack(batch["_v"].to_numpy()).astype(np.int64)
                words = pack(values, planes_for(values))
                yield pd.DataFrame({"_id": batch["_id"], "planes": [w.tobytes() for w in words], "norm": (values**2).sum(axis=1)})

    kind = rows.schema["_id"].dataType.simpleString()
    return kept(rows.mapInPandas(packs, f"_id {kind}, planes binary, norm long"))


def _grouped(planes: pd.Series) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, words) of a batch's rows by their number of planes, which is one per batch they were packed in."""
    sizes = planes.str.len().to_numpy()
    for n in np.unique(sizes):
        at = np.flatnonzero(sizes == n)
        yield at, np.frombuffer(b"".join(planes.iloc[at]), "<u8").reshape(len(at), n // 8)


def assign(sent: Broadcast) -> Column:
    """struct(cluster, distance) of a row's ``planes`` and ``norm`` by the centroids that were sent."""

    @F.pandas_udf("struct<cluster:int,distance:long>")
    def place(planes: pd.Series, norm: pd.Series) -> pd.DataFrame:
        centroids, norms = received(sent), norm.to_numpy()
        cluster, away = np.zeros(len(planes), np.int32), np.zeros(len(planes), np.int64)
        for at, words in _grouped(planes):
            cluster[at], away[at] = nearest(words, norms[at], centroids)
        return pd.DataFrame({"cluster": cluster, "distance": away})

    return place("planes", "norm")


def sums(packed: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Count and componentwise sum of each cluster's vectors. A task sends one row per cluster, the driver gets as many."""
    sent = send(packed.sparkSession, centroids)

    def totals(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, counts, total = received(sent), np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
        for batch in batches:
            for at, words in _grouped(batch["planes"]):
                cluster, _ = nearest(words, batch["norm"].to_numpy()[at], known)
                values = unpack(words)
                for number in np.unique(cluster):
                    mine = cluster == number
                    counts[number] += mine.sum()
                    total[number] += values[mine].sum(axis=0)
        full = np.flatnonzero(counts)
        if len(full):
            yield pd.DataFrame({"cluster": full.astype(np.int32), "n": counts[full], "total": list(total[full])})

    parts = packed.select("planes", "norm").mapInPandas(totals, "cluster int, n long, total array<long>")
    added = [F.sum(F.col("total")[j].cast("decimal(38,0)")).alias(f"_{j}") for j in range(WIDTH)]
    found = parts.groupBy("cluster").agg(F.sum("n").alias("n"), *added).collect()
    return {r["cluster"]: (r["n"], [int(r[f"_{j}"]) for j in range(WIDTH)]) for r in found}


def cluster(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 16, rounds: int = 3, scale: int = 64, seed: int = 1
) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) per kept vector.

    Kept are vectors of exactly 64 components, none null, NaN or infinite (nor 2^26 or more in size after scaling, whose distances
    no long holds). Centroids start as the ``k`` with the smallest SHA-256 of ``seed:id``, fewer if fewer are kept; vectors with a
    null id are assigned but never start one. Repeated ids and equal vectors count each by itself: equal starts are centroids of
    which the later stays empty and in its place; starts of one id stand in the order of their components. Distances are squared and exact; ties go to the smaller number. Other columns are
    ignored. A table without kept vectors gives no rows; if all kept ids are null there is one centroid, at zero.

    The driver holds k centroids and k sums, whatever the number of vectors; a hot vector costs what others do, as nothing is grouped
    before it is summed.
    """
    spark = vectors.sparkSession
    v = F.col(vector_col)
    rows = vectors.where((F.size(v) == WIDTH) & usable(v, scale)).select(F.col(id_col).alias("_id"), scaled(v, scale).alias("_v"))
    packed = packed_vectors(rows)
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("_id").cast("string")).cast("binary"), 256)
    first = rows.where(F.col("_id").isNotNull()).select(mark.alias("mark"), "_v").orderBy("mark", "_v").limit(k).collect()
    centroids = np.array([r["_v"] for r in first] or [[0] * WIDTH], np.int64)
    for _ in range(rounds):
        for number, (n, total) in sums(packed, centroids).items():
            centroids[number] = [t // n for t in total]
    placed = kept(packed.select(F.col("_id").alias("vec_id"), assign(send(spark, centroids)).alias("_at")).select("vec_id", "_at.*"))
    inertia = {r[0]: int(r[1]) for r in placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect()}
    facts = []
    for number, centre in enumerate(centroids.tolist()):
        digest = hashlib.sha256(",".join(map(str, centre)).encode()).hexdigest()
        facts.append(F.struct(F.lit(inertia.get(number, 0)).cast("long").alias("cluster_inertia"), F.lit(digest).alias("centroid_sha256")))
    of = F.element_at(F.array(*facts), F.col("cluster") + 1)
    total = F.lit(sum(inertia.values())).cast("long").alias("inertia")
    return placed.select("vec_id", "cluster", "distance", of["cluster_inertia"].alias("cluster_inertia"), total, of["centroid_sha256"].alias("centroid_sha256"))
