"""Toxicity: a support vector machine on a gap-weighted subsequence kernel with Nystroem landmarks."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from string import punctuation as PUNCTUATION

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import SPACE, fold, kept, release, small_batches

DECAY, REACH, POWER, LONGEST = 0.6, 5, 2, 24
FEATURES = 1 << 20
EDGE_OPEN, EDGE_CLOSE = "\x02", "\x03"
SPACED = re.compile(r"(?<!\w)\w(?:[\W_]{1,3}\w(?!\w)){2,}")
MARKS = re.compile(r"[\W_]+")
EDGES = re.compile(r"^[\W_]+|[\W_]+$")
SHAPE = bytes(ord("a") if chr(i).isalnum() else ord(" ") for i in range(128)) + bytes(128)
SHAPES = re.compile(rb" a {1,3}a {1,3}a ")  # three letters alone, in a text as SHAPE shows it


def units(text: str) -> tuple[set[str], int]:
    """What a text is judged by: its words in lower case, and runs of single letters (``i d i o t``) as one word each.

    They come without ASCII punctuation around them, and with how many there were before that.
    """
    low = text.lower()
    found = set(low.split())
    if not low.isascii() or "_" in low or SHAPES.search(f" {low} ".encode().translate(SHAPE)):
        found.update(MARKS.sub("", m) for m in SPACED.findall(low))
    return {word.strip(PUNCTUATION) for word in found}, len(found)


def pieces(unit: str) -> list[str]:
    """A word without punctuation around it, and without any if it has some inside; longer ones as overlapping pieces."""
    if len(unit) <= LONGEST and unit.isalnum():
        return [unit]
    bare = EDGES.sub("", unit)
    if len(bare) <= LONGEST and bare.isalnum():
        return [bare]
    out = []
    for form in dict.fromkeys((bare, MARKS.sub("", bare))):
        if len(form) <= LONGEST:
            out += [form] if form else []
        else:
            out += [form[i : i + LONGEST] for i in range(0, len(form) - LONGEST // 2, LONGEST // 2)]
    return out


def triples(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """(word, feature, weight) of three letters in order within REACH + 1 places, by the two gaps."""
    width = max(map(len, words), default=0) + 2
    codes = np.array([EDGE_OPEN + w + EDGE_CLOSE for w in words], f"U{width}").view(np.uint32).reshape(len(words), width)
    for j in range(1, min(REACH, width - 1)):
        pairs = (codes[:, :-j] * np.uint32(0x9E3779B1) + codes[:, j:]) * np.uint32(0x85EBCA77)
        for k in range(j + 1, min(REACH, width - 1) + 1):
            last = codes[:, k:]
            row, place = np.nonzero(last)
            mixed = pairs[row, place] + last[row, place] * np.uint32(0xC2B2AE3D)
            yield row, ((mixed ^ (mixed >> np.uint32(15))) % np.uint32(FEATURES)).astype(np.int64), DECAY ** (k + 1)


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, feature, weight): three letters in order weigh DECAY to their span; each word's row is normalised.

    The kernel of two words is the dot product of these rows: inserted or left-out letters lower it, they don't void it.
    """
    found = list(triples(words))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    key = np.concatenate([row * FEATURES + feature for row, feature, _ in found])
    order = np.argsort(key.astype(np.uint32) if len(words) <= 1 << 12 else key)  # FEATURES are 1 << 20
    key = key[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    total = np.add.reduceat(np.repeat([weight for _, _, weight in found], [len(row) for row, _, _ in found])[order], first)
    word, feature = key[first] // FEATURES, key[first] % FEATURES
    norm = np.sqrt(np.bincount(word, total**2, len(words)))
    return word, feature, total / norm[word]


@dataclass
class Landmarks:
    """Landmark words, inverted: for each feature in use the landmarks that have it, with weights."""

    words: list[str]
    place: np.ndarray  # of each of FEATURES among those in use, -1: in no landmark
    starts: np.ndarray
    owners: np.ndarray
    weights: np.ndarray


def landmarks(words: list[str]) -> Landmarks:
    word, feature, weight = subsequences(words)
    order = np.argsort(feature, kind="stable")
    features, starts = np.unique(feature[order], return_index=True)
    place = np.full(FEATURES, -1, np.int32)
    place[features] = np.arange(len(features))
    return Landmarks(words, place, np.append(starts, len(order)), word[order], weight[order])


def kernel(words: list[str], marks: Landmarks, block: int = 2048) -> np.ndarray:
    """Kernel of each word with each landmark, 0 to 1: the cosine of their subsequences to the POWER, itself a kernel.

    Words are taken ``block`` at a time, so that only a block's subsequences are in memory.
    """
    if len(words) > block:
        out = np.empty((len(words), len(marks.words)))
        for at in range(0, len(words), block):
            out[at : at + block] = kernel(words[at : at + block], marks, block)
        return out
    word, feature, weight = subsequences(words)
    if not len(word) or not len(marks.owners):
        return np.zeros((len(words), len(marks.words)))
    place = marks.place[feature]
    hit = np.flatnonzero(place >= 0)
    word, place, weight = word[hit], place[hit], weight[hit]
    many = marks.starts[place + 1] - marks.starts[place]
    which = np.repeat(np.arange(len(word)), many)
    at = np.repeat(marks.starts[place], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    cell = word[which] * len(marks.words) + marks.owners[at]
    return np.bincount(cell, weight[which] * marks.weights[at], len(words) * len(marks.words)).reshape(len(words), -1) ** POWER


@dataclass
class Model:
    """A word's decision is its kernel with the landmarks times ``vector`` (the Nystroem map folded in) plus ``bias``.

    ``weights`` turn what a text shows (see ``Judge.shown``) into the logarithm of its odds.
    """

    marks: Landmarks
    vector: np.ndarray
    bias: float
    weights: np.ndarray | None = None

    def decisions(self, words: list[str]) -> np.ndarray:
        return kernel(words, self.marks) @ self.vector + self.bias

    def probability(self, shown: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(shown @ self.weights, -30, 30)))


HIGHEST = 4


class Judge:
    """The highest decisions of a text's different words; words once judged are remembered."""

    def __init__(self, model: Model, most: int = 500_000) -> None:
        self.model, self.most, self.seen, self.judged = model, most, {}, {}
        self.lowest = float(model.bias)

    def learn(self, fresh: list[str]) -> None:
        for at in range(0, len(fresh), 4000):
            part = fresh[at : at + 4000]
            cut = {unit: found for unit in part if (found := pieces(unit)) != [unit]}
            new = list(({unit for unit in part if unit not in cut} | {p for found in cut.values() for p in found}) - self.judged.keys())
            self.judged.update(zip(new, np.maximum(self.model.decisions(new), self.lowest).tolist(), strict=True))
            for unit in part:
                self.seen[unit] = max(map(self.judged.__getitem__, cut[unit]), default=self.lowest) if unit in cut else self.judged[unit]

    def shown(self, texts: list[str | None]) -> np.ndarray:
        """A row per text: its HIGHEST decisions in falling order, the logarithm of its number of different words, 1.

        Most texts have that many among the batch's upper twentieth of words, and the others needn't be looked up.
        """
        if len(self.seen) > self.most:
            self.seen.clear()
            self.judged.clear()
        of = [units(text) if text else (set(), 0) for text in texts]
        every = list(set().union(*(found for found, _ in of)))
        self.learn([u for u in every if u not in self.seen])
        decided = np.array([self.seen[u] for u in every])
        high = {every[i] for i in np.flatnonzero(decided > np.quantile(decided, 0.95))} if every else set()
        out = np.full((len(texts), HIGHEST + 2), self.lowest)
        for row, (found, many) in zip(out, of, strict=True):
            among = found & high
            top = sorted(map(self.seen.__getitem__, among if len(among) >= HIGHEST else found), reverse=True)[:HIGHEST]
            row[: len(top)] = top
            row[HIGHEST:] = math.log1p(many), 1
        return out


def judge_column(model: Model, text: Column, probability: bool = True) -> Column:
    @F.pandas_udf("double" if probability else "array<double>")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        texts = Judge(model)
        for batch in batches:
            shown = texts.shown(list(batch))
            yield pd.Series(model.probability(shown), dtype=float) if probability else pd.Series(list(shown), dtype=object)

    return judge(text)


def pick(candidates: list[str], count: int, alike: float = 0.75) -> list[str]:
    """The first ``count`` words that aren't nearly the same as one already taken."""
    chosen: list[str] = []
    for at in range(0, len(candidates), 256):
        part = candidates[at : at + 256]
        among = kernel(part, landmarks(part))
        known = kernel(part, landmarks(chosen)) if chosen else np.zeros((len(part), 0))
        taken: list[int] = []
        for i, word in enumerate(part):
            if len(chosen) < count and not (known[i] > alike).any() and not (among[i, taken] > alike).any():
                chosen.append(word)
                taken.append(i)
    return chosen


def machine(x: np.ndarray, y: np.ndarray, cost: float = 3.0, positive: float = 4.0, turns: int = 60) -> tuple[np.ndarray, float]:
    """Linear support vector machine with squared hinge loss, label 1 weighing ``positive`` times as much, by Newton steps."""
    a = np.hstack([x, np.ones((len(x), 1))])
    sign = np.where(y > 0, 1.0, -1.0)
    each = np.where(y > 0, positive, 1.0) * cost
    w, ridge = np.zeros(a.shape[1]), np.append(np.ones(x.shape[1]), 1e-4)
    for _ in range(turns):
        active = sign * (a @ w) < 1
        weight = np.where(active, each, 0)
        new = np.linalg.solve((a * weight[:, None]).T @ a + np.diag(ridge), (a * weight[:, None]).T @ sign)
        if np.allclose(new, w, atol=1e-9):
            break
        w = new
    return w[:-1], float(w[-1])


def odds(shown: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a logistic regression on what texts show, with smoothed targets; a higher decision never lowers the odds."""
    positive, negative = (y > 0).sum(), (y <= 0).sum()
    target = np.where(y > 0, (positive + 1) / (positive + 2), 1 / (negative + 2))
    free = np.ones(shown.shape[1], bool)
    while True:
        a, w = shown[:, free], np.zeros(free.sum())
        for _ in range(200):
            p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
            step = np.linalg.solve((a * (p * (1 - p) + 1e-4)[:, None]).T @ a + 1e-2 * np.eye(len(w)), a.T @ (p - target) + 1e-2 * w)
            w = w - step
            if np.abs(step).max() < 1e-7:
                break
        out = np.zeros(shown.shape[1])
        out[free] = w
        wrong = np.flatnonzero(out[:HIGHEST] < 0)
        if not len(wrong):
            return out
        free[wrong] = False


def variants(word: str) -> list[str]:
    """The word with a letter doubled or one inserted, at each place inside."""
    return [word[:i] + c + word[i:] for i in range(1, len(word)) for c in (word[i - 1], "x")] if len(word) > 3 else []


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    sample: int = 8000, marks: int = 128, others: int = 20_000, folds: int = 3, held: int = 1,
) -> Model | None:
    """Learn from labelled rows outside fold ``held``; None if they don't hold both classes.

    At most ``sample`` rows of each class are used, those first by a hash of their id (texts are used whole). A toxic text is
    toxic for some of its words, so each gives one word to learn from: that which most separates the classes (counts
    stay in Spark); words that do so in many texts are joined by variants of them with a letter more. Against them stand the ``others`` words of clean texts that are most like a landmark. Landmarks are the
    most separating words, none too like another, and a few clean ones; Nystroem: kernels with them times the inverse root of
    their own kernel. A logistic regression on the sample's texts turns the highest decisions of a text's words into a probability:
    one certain word is enough, and several doubtful ones are more than one.
    """
    small_batches(docs.sparkSession)
    known = labels.where(fold(id_col, folds) != held).where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y"))
    some = [known.where(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(sample) for y in (0, 1)]
    chosen = kept(some[0].unionByName(some[1]).groupBy("_id").agg(F.max("_y").alias("_y")))
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(chosen), "_id")
    rows = kept(rows.where("_text is not null"))
    totals = {r["_y"]: r["n"] for r in rows.groupBy("_y").agg(F.count("*").alias("n")).collect()}
    if len(totals) < 2:
        return None

    words = rows.select("_id", "_y", F.explode(F.array_distinct(F.split(F.lower("_text"), SPACE))).alias("w"))
    bare = F.regexp_replace("w", r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")
    words = words.select("_id", "_y", bare.alias("w")).where(F.length("w").between(3, LONGEST))
    spread = words.groupBy("w").agg(F.sum("_y").alias("p"), F.sum(1 - F.col("_y")).alias("n"))
    rate = (F.col("p") + F.col("n")) / float(sum(totals.values()))
    z = (F.col("p") / float(totals[1]) - F.col("n") / float(totals[0])) / F.sqrt(rate * (1 - rate) + F.lit(1e-6))
    share = F.col("p") / float(totals[1]) / (F.col("p") / float(totals[1]) + F.col("n") / float(totals[0]))
    ranked = kept(spread.select("w", "p", "n", z.alias("z"), share.alias("share")))
    tops = [[r["w"] for r in ranked.where(x).orderBy(F.desc(F.abs("z")), "w").limit(20 * marks).collect()] for x in ("share > 0.9", "z < 0")]
    toxic = pick(tops[0], marks - marks // 8)
    if not toxic:
        return None
    found = landmarks(toxic + [w for w in pick(tops[1], marks // 8) if w not in toxic])

    best = words.where("_y = 1").join(ranked.where("share > 0.9"), "w").groupBy("_id").agg(F.max_by("w", F.struct("z", "w")).alias("w"))
    plain = ranked.where("share > 0.97").where(F.col("p") >= max(3, 0.02 * totals[1])).select("w")
    guilty = sorted(r["w"] for r in best.select("w").union(plain).distinct().collect())
    common = {r["w"] for r in plain.collect()}
    guilty += sorted({v for w in guilty if w in common for v in variants(w)})

    @F.pandas_udf("double")
    def alike(batch: pd.Series) -> pd.Series:
        return pd.Series(kernel(list(batch), found).max(axis=1, initial=0), dtype=float)

    clean = ranked.where("n > 0 and share <= 0.9").select("w", alike("w").alias("k")).orderBy(F.desc("k"), "w").limit(others)
    innocent = [r["w"] for r in clean.collect()]
    release(docs.sparkSession)
    x, y = kernel(guilty + innocent, found), np.repeat([1, 0], [len(guilty), len(innocent)])
    value, vectors = np.linalg.eigh(kernel(found.words, found) + 1e-3 * np.eye(len(found.words)))
    root = vectors @ np.diag(1 / np.sqrt(np.maximum(value, 1e-3))) @ vectors.T
    w, bias = machine(x @ root, y)
    model = Model(found, root @ w, bias)
    data = rows.select("_y", judge_column(model, F.col("_text"), probability=False).alias("x")).toPandas()
    model.weights = odds(np.array(data["x"].tolist(), float), data["_y"].to_numpy())
    return model


def score(model: Model | None, text: Column) -> Column:
    """Probability of label 1 for a whole text, null and empty ones too; 0 where nothing could be learned."""
    return F.lit(0.0) if model is None else judge_column(model, text)


def judged(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: float = 0.7) -> DataFrame:
    """(id, held_out, score, predicted) per row. Other columns are ignored; repeated rows are judged alike.

    Null, empty and wordless texts get the score of a text that shows nothing. Texts are judged whole, whatever their length. An id with labels
    of both kinds counts as toxic; labels without an id or without a row teach nothing, and without both labels every score is 0.
    """
    model = fit(docs, labels, id_col, text_col)
    found = docs.select(F.col(id_col).alias("doc_id"), (fold(id_col, 3) == 1).alias("held_out"), score(model, F.col(text_col)).alias("score"))
    return found.withColumn("predicted", (F.col("score") >= limit).cast("int"))


def clean(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: float = 0.7) -> DataFrame:
    """The rows of ``docs`` that aren't judged toxic, with all their columns."""
    model = fit(docs, labels, id_col, text_col)
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), score(model, F.col(text_col)).alias("_score"))
    return row.where(F.col("_score") < limit).select("_row.*")
