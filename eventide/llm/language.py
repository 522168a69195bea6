"""Language identification by the nearest of several clustered centroids per language."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm.common import fold, kept, received, send, small_batches

FEATURES = 1 << 13
PIECE = 1 << 20


def letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams(text: str, letter: np.ndarray) -> np.ndarray | None:
    """Counts of hashed n-grams (1 to 3 characters of lower-case words) of a whole text; None without a letter."""
    counts, seen = np.zeros(FEATURES, np.float64), False
    for at in range(0, len(text), PIECE):
        code = np.frombuffer(text[at : at + PIECE].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        code = np.where(letter[code], code, 32).astype(np.uint32)
        code = code[np.append(True, (code[1:] != 32) | (code[:-1] != 32))]
        seen = seen or bool((code != 32).any())
        code = np.concatenate([[np.uint32(32)], code, [np.uint32(32)]]).astype(np.uint32)
        one = code[code != 32] * np.uint32(0x9E3779B1)
        two = code[:-1] * np.uint32(0x85EBCA6B) + code[1:] * np.uint32(0xC2B2AE35)
        three = two[:-1] * np.uint32(0x27D4EB2F) + code[2:] * np.uint32(0x165667B1)
        for h in (one, two[(code[:-1] != 32) | (code[1:] != 32)], three[code[1:-1] != 32]):
            counts += np.bincount((h ^ (h >> np.uint32(15))) % np.uint32(FEATURES), minlength=FEATURES)
    return counts if seen else None


def vectors(texts: list[str | None], idf: np.ndarray, letter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Normalised TF-IDF rows and which texts have a letter."""
    out, has = np.zeros((len(texts), FEATURES), np.float32), np.zeros(len(texts), bool)
    for i, text in enumerate(texts):
        counts = grams(text, letter) if text else None
        if counts is not None:
            row = np.sqrt(counts) * idf
            out[i], has[i] = row / max(np.linalg.norm(row), 1e-12), True
    return out, has


@dataclass
class Centroids:
    """A row per cluster: its language, unit centroid, and the lowest similarity at which it still accepts."""

    langs: list[str]
    idf: np.ndarray
    points: np.ndarray
    radius: np.ndarray


def clusters(x: np.ndarray, count: int, turns: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means, started at rows far from each other: centroids and accepted similarity of each."""
    seeds = [int(np.argmax(x @ x.mean(axis=0)))]
    while len(seeds) < min(count, len(x)):
        seeds.append(int(np.argmin((x @ x[seeds].T).max(axis=1))))
    points = x[seeds]
    for _ in range(turns):
        own = np.argmax(x @ points.T, axis=1)
        points = np.stack([x[own == k].mean(axis=0) if (own == k).any() else points[k] for k in range(len(points))])
        points /= np.maximum(np.linalg.norm(points, axis=1, keepdims=True), 1e-12)
    own, best = np.argmax(x @ points.T, axis=1), (x @ points.T).max(axis=1)
    radius = [best[own == k].mean() - 4 * best[own == k].std() if (own == k).any() else 1.0 for k in range(len(points))]
    return points, np.maximum(radius, 0)


def fit(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    sample: int = 400, per_language: int = 4, languages: int = 400, folds: int = 4, held: int = 2,
) -> Centroids | None:
    """Learn from rows with a language outside fold ``held``; None if there are none.

    Document frequencies of the n-grams count every training row. Centroids come from at most ``sample`` rows per
    language, first by a hash of the row, one language per task; the ``languages`` most frequent labels are learned. Those
    bounds (languages x clusters x 8192 numbers) are also the bound of what is sent to the executors.
    """
    spark = docs.sparkSession
    small_batches(spark)
    known = docs.where(F.col(lang_col).isNotNull() & (fold(id_col, folds) != held)).select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), F.col(id_col).alias("_id"))
    known = known.where("text is not null")

    def frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        letter, total, rows = letters(), np.zeros(FEATURES), 0
        for batch in batches:
            for text in batch["text"]:
                counts = grams(text, letter)
                if counts is not None:
                    total += counts > 0
                    rows += 1
        yield pd.DataFrame({"feature": np.arange(FEATURES + 1), "n": np.append(total, rows).astype(np.int64)})

    df = np.zeros(FEATURES + 1)
    for feature, n in known.select("text").mapInPandas(frequencies, "feature long, n long").groupBy("feature").agg(F.sum("n")).collect():
        df[feature] = n
    if not df[-1]:
        return None
    idf = np.log((1 + df[-1]) / (1 + df[:-1])) + 1

    keyed = known.withColumn("_h", F.xxhash64("_id", "text"))
    common = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages)
    # Hashes below a share that leaves about three samples of a language; the ordered choice is then among few rows.
    spread = F.pmod("_h", F.lit(1 << 31)).cast("double") * F.col("count") < F.lit(3.0 * sample * (1 << 31))
    first = F.row_number().over(Window.partitionBy("lang").orderBy("_h"))
    some = keyed.select("lang", "_h").join(F.broadcast(common), "lang").where(spread)
    chosen = some.withColumn("_at", first).where(F.col("_at") <= sample)
    chosen = kept(chosen.select("lang", "_h").distinct())
    rows = keyed.join(F.broadcast(chosen), ["lang", "_h"], "left_semi").dropDuplicates(["lang", "_h"]).select("lang", "text")

    def centroids(group: pd.DataFrame) -> pd.DataFrame:
        x, has = vectors(list(group["text"]), idf, letters())
        if not has.any():
            return pd.DataFrame({"lang": [], "point": [], "radius": []})
        points, radius = clusters(x[has], per_language)
        return pd.DataFrame({"lang": group["lang"].iloc[0], "point": list(points.astype(np.float32)), "radius": radius})

    found = rows.groupBy("lang").applyInPandas(centroids, "lang string, point array<float>, radius double").toPandas().sort_values("lang", kind="stable")
    if not len(found):
        return None
    return Centroids(list(found["lang"]), idf, np.array(found["point"].tolist(), np.float32), found["radius"].to_numpy())


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(id, held_out, lang_pred, score, rejected) per row.

    The language of the centroid with the highest cosine to the whole text; score is that cosine. ``rejected``: the text
    is farther from that centroid than its own training texts ever were (mean minus four deviations), so the language is
    the nearest but hardly right. Null texts and texts without a letter: ``und``, 0, rejected; so is everything if nothing
    could be learned. Repeated rows are judged alike, ties go to the first language by name; other columns are ignored.
    """
    model = fit(docs, id_col, text_col, lang_col)
    sent = send(docs.sparkSession, model)

    @F.pandas_udf("struct<lang:string,score:double,rejected:boolean>")
    def nearest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        letter, m = letters(), received(sent)
        for batch in batches:
            texts = list(batch)
            if m is None:
                yield pd.DataFrame({"lang": ["und"] * len(texts), "score": 0.0, "rejected": True})
                continue
            x, has = vectors(texts, m.idf, letter)
            cosine = x @ m.points.T
            best = np.argmax(cosine, axis=1) if len(texts) else np.zeros(0, int)
            score = np.clip(cosine[np.arange(len(texts)), best], 0, 1).astype(float)
            yield pd.DataFrame(
                {
                    "lang": [m.langs[b] if h else "und" for b, h in zip(best, has, strict=True)],
                    "score": np.where(has, score, 0.0),
                    "rejected": ~has | (score < m.radius[best]),
                }
            )

    found = docs.select(F.col(id_col).alias("doc_id"), (fold(id_col, 4) == 2).alias("held_out"), nearest(F.col(text_col)).alias("_p"))
    return found.select("doc_id", "held_out", F.col("_p.lang").alias("lang_pred"), F.col("_p.score").alias("score"), F.col("_p.rejected").alias("rejected"))
