"""Benchmark decontamination: positional inverted indexes of the training text, one per block of documents."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import received, send, small_batches

# Fixed value: the contract's words, on UTF-8 bytes after A-Z became a-z.
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPAN = 1 << 40
FOUND = "struct<n_words:long,spans:array<struct<start:long,end:long>>,items:array<string>,near:array<string>>"


@dataclass
class Phrases:
    """Test phrases of a block of items: the terms' numbers, and a row of terms per window (-1 beyond its length)."""

    terms: dict[bytes, int]
    rows: np.ndarray
    items: np.ndarray
    names: list[str]


def term_numbers(text: str, terms: dict[bytes, int], size: int = 1 << 22) -> np.ndarray:
    """The words of a whole text as term numbers, -1 for words of no phrase; long texts are read in slices."""
    data = text.encode().lower()
    if len(data) <= size:
        return np.array([terms.get(w, -1) for w in WORD.findall(data)], np.int32)
    parts, at = [], 0
    while at < len(data):
        end = min(len(data), at + size)
        while end < len(data) and WORD.match(data, end, end + 1):
            end += 1
        parts.append(np.array([terms.get(w, -1) for w in WORD.findall(data, at, end)], np.int32))
        at = end
    return np.concatenate(parts)


def phrases(items: list[tuple[str, str]], width: int) -> Phrases:
    terms: dict[bytes, int] = {}
    rows, owner = [np.zeros((0, width), np.int32)], [np.zeros(0, np.int64)]
    for number, (_, text) in enumerate(items):
        words = np.array([terms.setdefault(w, len(terms)) for w in WORD.findall(text.encode().lower())], np.int32)
        if 0 < len(words) < width:
            words = np.concatenate([words, np.full(width - len(words), -1, np.int32)])
        if len(words):
            rows.append(np.lib.stride_tricks.sliding_window_view(words, width))
            owner.append(np.full(len(words) - width + 1, number))
    return Phrases(terms, np.concatenate(rows), np.concatenate(owner), [name for name, _ in items])


def search(tokens: np.ndarray, p: Phrases, slack: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Exact matches (window, start) and windows with a proximity match and its start, in one index of ``tokens``.

    The index holds each term's positions in order. A window begins with the positions of its rarest term, shifted by
    the term's offset, and is intersected with the shifted positions of the next rarest until none or all are left.
    """
    at = np.flatnonzero(tokens >= 0)
    keys = np.sort(tokens[at].astype(np.int64) * SPAN + at)
    heads = np.searchsorted(keys, np.arange(len(p.terms) + 1, dtype=np.int64) * SPAN)
    counts = np.append(np.diff(heads), 0)
    size = np.where(p.rows >= 0, counts[p.rows], np.iinfo(np.int64).max)
    alive = np.flatnonzero(size.min(axis=1) > 0) if len(size) else np.zeros(0, np.int64)
    order = np.argsort(size[alive], axis=1, kind="stable")
    rarest = p.rows[alive, order[:, 0]]
    many = counts[rarest]
    which = np.repeat(np.arange(len(alive)), many)
    first = np.repeat(heads[rarest], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    start = keys[first] % SPAN - order[which, 0] if len(first) else np.zeros(0, np.int64)

    def intersect(which: np.ndarray, start: np.ndarray, slack: int, turns: range) -> tuple[np.ndarray, np.ndarray]:
        for turn in turns:
            if not len(which):
                break
            offset = order[which, turn]
            term = p.rows[alive[which], offset].astype(np.int64)
            wanted = term * SPAN + start + offset
            place = np.minimum(np.searchsorted(keys, wanted - slack), len(keys) - 1)
            stays = (term < 0) | ((keys[place] >= wanted - slack) & (keys[place] <= wanted + slack))
            which, start = which[stays], start[stays]
        return which, start

    width = p.rows.shape[1]
    exact, begins = intersect(which, start, 0, range(1, width))
    shifts = np.arange(-slack, slack + 1)
    near, near_start = intersect(np.repeat(which, len(shifts)), (start[:, None] + shifts).ravel(), slack, range(1, width))
    return alive[exact], begins, np.stack([alive[near], near_start])


def match_texts(texts: list[str | None], p: Phrases, slack: int, limit: int = 1 << 21) -> Iterator[tuple]:
    """(n_words, merged spans, items, near items) per text; an index covers texts of up to about ``limit`` words."""
    width, gap = p.rows.shape[1], p.rows.shape[1] + 4 * slack + 2
    block: list[np.ndarray] = []

    def flush() -> Iterator[tuple]:
        if not block:
            return
        starts = np.cumsum([gap] + [len(t) + gap for t in block])
        tokens = np.full(starts[-1], -1, np.int32)
        for begin, t in zip(starts, block, strict=False):
            tokens[begin : begin + len(t)] = t
        window, start, close = search(tokens, p, slack)
        length = (p.rows[window] >= 0).sum(axis=1)
        change = np.zeros(len(tokens) + width + 1, np.int32)
        np.add.at(change, start, 1)
        np.add.at(change, start + length, -1)
        edges = np.diff(np.concatenate([[0], (np.cumsum(change) > 0).astype(np.int8), [0]]))
        opens, closes = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        of = np.searchsorted(starts, opens, "right") - 1
        pairs = np.unique(np.stack([np.searchsorted(starts, start, "right") - 1, p.items[window]]), axis=1)
        nears = np.unique(np.stack([np.searchsorted(starts, close[1] + 2 * slack, "right") - 1, p.items[close[0]]]), axis=1)
        low, high = np.searchsorted(of, [np.arange(len(block)), np.arange(1, len(block) + 1)])
        for i, t in enumerate(block):
            spans = [{"start": int(a - starts[i]), "end": int(b - starts[i])} for a, b in zip(opens[low[i] : high[i]], closes[low[i] : high[i]], strict=True)]
            names = [sorted({p.names[k] for k in x[1][np.searchsorted(x[0], i) : np.searchsorted(x[0], i, "right")]}) for x in (pairs, nears)]
            yield len(t), spans, names[0], names[1]
        block.clear()

    held = 0
    for text in texts:
        block.append(term_numbers(text or "", p.terms))
        held += len(block[-1])
        if held > limit:
            yield from flush()
            held = 0
    yield from flush()


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, words: int) -> Iterator[list[tuple[str, str]]]:
    """The test items, streamed through the driver in blocks of about ``words`` words."""
    block, held = [], 0
    named = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    for name, text in benchmark.select(named, F.coalesce(F.col(text_col), F.lit(""))).toLocalIterator():
        block.append((name, text))
        held += len(text) // 4 + 1
        if held >= words:
            yield block
            block, held = [], 0
    if block:
        yield block


def _visit(sent: Broadcast, slack: int) -> Callable[[Column], Column]:
    @F.pandas_udf(FOUND)
    def visit(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        sought = received(sent)
        for texts in batches:
            yield pd.DataFrame(match_texts(list(texts), sought, slack), columns=["n_words", "spans", "items", "near"])

    return visit


def matches(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
    width: int = 13, slack: int = 1, block_words: int = 1_000_000,
) -> Column:
    """A column of ``docs``: struct(n_words, spans, items, near).

    The training text is indexed where it lies: each Arrow batch of documents becomes a positional index, which the
    test phrases visit in blocks of at most ``block_words`` words (that bounds what is broadcast; a larger benchmark
    makes more visits). Nothing is shuffled. A phrase is ``width`` consecutive words of an item, or all words of a
    shorter one. ``spans`` are the merged word ranges of exact matches, ``items`` the items that have some, ``near`` the items
    each of whose phrase words lies within ``slack`` words of its place. A null or wordless text has no words; null item
    ids are named by the empty string, items without words match nothing, and repeated items count once by their id.
    """
    spark = docs.sparkSession
    small_batches(spark)
    blocks = item_blocks(benchmark, item_col, item_text, block_words)
    found = [_visit(send(spark, phrases(items, width)), slack)(F.col(text_col)) for items in blocks]
    found = found or [_visit(send(spark, phrases([], width)), slack)(F.col(text_col))]
    whole = found[0]
    for more in found[1:]:
        whole = F.struct(
            whole["n_words"].alias("n_words"), F.concat(whole["spans"], more["spans"]).alias("spans"),
            F.array_union(whole["items"], more["items"]).alias("items"), F.array_union(whole["near"], more["near"]).alias("near"),
        )
    return whole


def hit_words(spans: Column) -> Column:
    """How many words the ranges cover, each counted once."""
    step = lambda acc, s: F.struct(
        (acc["n"] + F.greatest(F.lit(0).cast("long"), s["end"] - F.greatest(s["start"], acc["to"]))).alias("n"), F.greatest(acc["to"], s["end"]).alias("to")
    )
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to"))
    return F.aggregate(F.array_sort(spans), zero, step, lambda acc: acc["n"])


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_hit, n_items, items_sha256, contaminated, n_near) per row; contaminated from 5 % hit words on."""
    found = docs.select(F.col(id_col).alias("doc_id"), matches(docs, benchmark, text_col).alias("m"))
    n_hit = hit_words(F.col("m.spans"))
    named = F.array_sort("m.items")
    wide = found.select("doc_id", F.col("m.n_words").alias("n_words"), n_hit.alias("n_hit"), named.alias("_items"), F.size("m.near").cast("long").alias("n_near"))
    return wide.select(
        "doc_id", "n_words", "n_hit", F.size("_items").cast("long").alias("n_items"), F.sha2(F.array_join("_items", ",").cast("binary"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"), "n_near",
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), matches(docs, benchmark, text_col).alias("_m"))
    counted = row.withColumn("_hit", hit_words(F.col("_m.spans")))
    return counted.where((F.col("_hit") == 0) | (20 * F.col("_hit") < F.col("_m.n_words"))).select("_row.*")
