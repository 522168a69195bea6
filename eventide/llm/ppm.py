"""Language-model scores by prediction by partial matching: a byte-context trie with escapes and symbol exclusion."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm.common import fold, kept, received, release, send, small_batches, word_blocks

ORDER = 5
SYMBOLS = 256
START, STOP = b"\xfe" * ORDER, b"\xff"  # bytes that UTF-8 never has: what stands before a text, and its end
GAP = re.compile(rb"[\x20\x09-\x0D]+")  # fixed value: the contract's white space
MASKS = [np.int64((1 << 8 * (k + 1)) - 1) for k in range(ORDER + 1)]


def coded(text: str | None) -> bytes:
    """What is coded of a text: its lower-cased words with a space between, then the end."""
    return GAP.sub(b" ", (text or "").encode().lower()).strip(b" ") + STOP


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(context and symbol as one number of ORDER + 1 bytes, number of the text) for every coded byte."""
    data = np.frombuffer(START + START.join(texts), np.uint8)
    key = np.zeros(len(data) - ORDER, np.int64)
    for k in range(ORDER + 1):
        key = (key << 8) | data[k : len(data) - ORDER + k]
    real = data[ORDER:] != START[0]
    of = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    return key[real], of


def slices(texts: list[str | None], size: int = 1 << 22) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``grams`` of some texts after the other, about ``size`` bytes at a time; long texts in overlapping parts."""
    held, numbers, total = [], [], 0

    def flush() -> tuple[np.ndarray, np.ndarray]:
        key, of = grams(held)
        out = key, np.array(numbers)[of]
        held.clear()
        numbers.clear()
        return out

    for i, text in enumerate(texts):
        data = coded(text)
        if len(data) > size:
            if held:
                yield flush()
            whole = np.frombuffer(START + data, np.uint8)
            for at in range(0, len(data), size):
                part = whole[at : at + size + ORDER]
                key = np.zeros(len(part) - ORDER, np.int64)
                for k in range(ORDER + 1):
                    key = (key << 8) | part[k : len(part) - ORDER + k]
                yield key, np.full(len(key), i)
            continue
        held.append(data)
        numbers.append(i)
        total += len(data)
        if total > size:
            total = 0
            yield flush()
    if held:
        yield flush()


class Places:
    """A hash table from numbers to their index, looked up for whole arrays at once; -1 where there is none."""

    def __init__(self, keys: np.ndarray) -> None:
        self.bits = np.uint64(max(4, int(3 * len(keys)).bit_length()))
        self.keys = np.full((1 << int(self.bits)) + 1, -1, np.int64)
        self.index = np.full(len(self.keys), -1, np.int32)
        todo, slot = np.arange(len(keys)), self._slot(keys)
        while len(todo):
            free = self.keys[slot] == -1
            self.keys[slot[free]] = keys[todo[free]]
            own = free & (self.keys[slot] == keys[todo])
            self.index[slot[own]] = todo[own]
            todo, slot = todo[~own], (slot[~own] + 1) & ((1 << int(self.bits)) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> (np.uint64(64) - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        held = self.keys[slot]
        out = np.where(held == keys, self.index[slot], -1)
        todo = np.flatnonzero((held != keys) & (held != -1))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & ((1 << int(self.bits)) - 1)
            held = self.keys[slot[todo]]
            hit = held == keys[todo]
            out[todo[hit]] = self.index[slot[todo[hit]]]
            todo = todo[~hit & (held != -1)]
        return out


@dataclass
class Level:
    """Contexts of one length. A context's total is of all that followed it, ``mass`` of the symbols in the trie, ``seen`` their number.

    The ``rest`` of a context is what the context one byte shorter has besides this one's symbols.
    """

    pairs: Places
    count: np.ndarray
    own: np.ndarray  # log10 probability of each pair when its context comes first
    contexts: Places
    total: np.ndarray
    mass: np.ndarray
    seen: np.ndarray
    rest: np.ndarray  # a row each of total, mass and seen


def trie(counted: list[tuple[np.ndarray, np.ndarray]], totals: list[tuple[np.ndarray, np.ndarray]]) -> list[Level]:
    """Levels 0 to ORDER from (sorted pairs, counts) and (sorted contexts, totals) of each.

    Whatever follows a longer context in the trie must follow its shorter ones there too.
    """
    levels: list[Level] = []
    for k, ((keys, count), (contexts, total)) in enumerate(zip(counted, totals, strict=True)):
        of = np.searchsorted(contexts, keys >> 8)
        mass = np.bincount(of, count, len(contexts))
        seen = np.bincount(of, minlength=len(contexts)).astype(float)
        rest = np.zeros((3, len(contexts)))
        if k and len(keys):
            below = levels[-1]
            shorter = below.pairs.find(keys & MASKS[k - 1])
            parent = below.contexts.find(contexts & (MASKS[k - 2] if k > 1 else np.int64(0)))
            gone = np.bincount(of, below.count[shorter], len(contexts))
            rest = np.stack([below.total[parent] - gone, below.mass[parent] - gone, below.seen[parent] - seen])
        own = np.log10((count - 0.5) / total[of]) if len(keys) else np.zeros(0)
        levels.append(Level(Places(keys), count.astype(float), own, Places(contexts), total.astype(float), mass, seen, rest))
    return levels


def code_lengths(keys: np.ndarray, levels: list[Level]) -> np.ndarray:
    """log10 probability of each symbol after its context: the longest known context first, an escape per context without it.

    A context that was followed T times gives (c - 1/2) / T to a symbol of the trie seen c times; what is left, half a count per such
    symbol and all that the trie leaves out, is the escape. After an escape the longer context's symbols are excluded from the
    shorter one. Below the empty context all other bytes are alike.
    """
    out = np.zeros(len(keys))
    found = levels[ORDER].pairs.find(keys)
    hit = found >= 0
    if hit.any():
        out[hit] = levels[ORDER].own[found[hit]]
    todo = np.flatnonzero(~hit)
    state = np.full((3, len(todo)), -1.0)  # total, mass and seen of the context in turn without excluded symbols; -1: none were
    for k in range(ORDER, -1, -1):
        level, key = levels[k], keys[todo] & MASKS[k]
        found = level.pairs.find(key) if k < ORDER else np.full(len(todo), -1)
        context = level.contexts.find(key >> 8)
        known = context >= 0
        if known.any():
            own = np.stack([level.total[context], level.mass[context], level.seen[context]])
            state = np.where((state[0] < 0) & known, own, state)
        hit = found >= 0
        add = np.zeros(len(todo))
        if hit.any():
            add[hit] = np.log10((level.count[found[hit]] - 0.5) / state[0, hit])
        escape = ~hit & known & (state[0] > 0)
        total, mass, seen = state[:, escape]
        add[escape] = np.log10((total - mass + 0.5 * seen) / total)
        out[todo] += add
        if k:
            state = np.where(known, level.rest[:, context], -1.0) if known.any() else np.full((3, len(todo)), -1.0)
        todo, state = todo[~hit], state[:, ~hit]
    out[todo] -= np.log10(SYMBOLS - (levels[0].seen[0] if len(levels[0].seen) else 0))
    return out


def _add_up(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, inverse = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(inverse, np.concatenate([n for _, n in parts]), len(keys)).astype(np.int64)


def gram_counts(texts: DataFrame) -> DataFrame:
    """(gram, n) of all ``text``: counted in each task, then added up."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            for key, _ in slices(list(batch["text"])):
                parts.append(np.unique(key, return_counts=True))
                if len(parts) >= 8:
                    parts = [_add_up(parts)]
                    if len(parts[0][0]) > 3_000_000:
                        yield pd.DataFrame({"gram": parts[0][0], "n": parts[0][1]})
                        parts = []
        if parts:
            keys, n = _add_up(parts)
            yield pd.DataFrame({"gram": keys, "n": n})

    return texts.select("text").mapInPandas(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def word_counts(texts: DataFrame, most: int = 500_000) -> DataFrame:
    """(word, n) of all ``text``, lower-cased; counted in each task, then added up."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch["text"]:
                for words in word_blocks((text or "").encode().lower()):
                    counts.update(words)
                if len(counts) > most:
                    yield pd.DataFrame({"word": list(counts.keys()), "n": list(counts.values())})
                    counts.clear()
        yield pd.DataFrame({"word": list(counts.keys()), "n": np.array(list(counts.values()), np.int64)})

    return texts.select("text").mapInPandas(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, most: int | None = None) -> list[Level]:
    """The trie of all ``text`` in the driver's memory, for a corpus that fits it; :func:`scores` keeps it in Spark tables instead.

    Counts cover every row; those of shorter contexts are sums of those of the longest. A caller may have pairs of a context length
    rarer than 1 in ``most`` symbols left to the escape; by default none is.
    """
    longest = kept(gram_counts(docs))
    symbols = longest.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col("gram").bitwiseAND(F.lit(int(MASKS[k]))).alias("key")) for k in range(ORDER + 1)]))
    pairs = kept(longest.select(each.alias("p"), "n").groupBy("p.k", "p.key").agg(F.sum("n").alias("n")))
    often = F.lit(True) if most is None else F.col("n") * most >= F.lit(symbols)
    contexts = pairs.groupBy("k", F.shiftright("key", 8).alias("key")).agg(F.sum("n").alias("n"), F.max(often).alias("some")).where("some").drop("some")
    levels = []
    for found in (pairs.where(often), contexts):
        rows = found.toPandas().sort_values(["k", "key"])
        levels.append([(x["key"].to_numpy(np.int64), x["n"].to_numpy(np.int64)) for x in (rows[rows["k"] == k] for k in range(ORDER + 1))])
    return trie(*levels)


def contexts_of(grams: DataFrame) -> DataFrame:
    """The whole trie: (k, context, total, seen, gone, followers), a row per context of 0 to ORDER bytes. All pairs of ``grams`` (gram, n) are in.

    ``followers`` maps each byte that followed, 256 at most, to its count; ``total`` adds these up and ``seen`` numbers them. ``gone`` is how
    often the same bytes followed the context one byte shorter.
    """
    masked = lambda k: F.col("gram").bitwiseAND(F.lit(int(MASKS[k])))
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), masked(k).alias("key")) for k in range(ORDER + 1)]))
    pairs = grams.select(each.alias("p"), "n").groupBy("p.k", "p.key").agg(F.sum("n").alias("n"))
    shorter = F.get(F.array(*[F.col("key").bitwiseAND(F.lit(int(m))) for m in (0, *MASKS[:-1])]), F.col("k"))
    pairs = pairs.withColumn("below", F.sum("n").over(Window.partitionBy("k", shorter)))
    follower = F.struct(F.col("key").bitwiseAND(F.lit(255)).alias("s"), "n")
    return pairs.groupBy("k", F.shiftright("key", 8).alias("context")).agg(
        F.sum("n").alias("total"), F.count("*").alias("seen"), F.sum("below").alias("gone"), F.map_from_entries(F.collect_list(follower)).alias("followers")
    )


def gram_logs(contexts: DataFrame) -> DataFrame:
    """(gram, n, log) of every pair of the longest contexts: what ``code_lengths`` gives where the longest context comes first."""
    pairs = contexts.where(F.col("k") == ORDER).select("context", "total", F.explode("followers").alias("s", "n"))
    return pairs.select(F.shiftleft("context", 8).bitwiseOR(F.col("s")).alias("gram"), "n", F.log10((F.col("n") - 0.5) / F.col("total")).alias("log"))


def escaped_logs(grams: DataFrame, contexts: DataFrame) -> DataFrame:
    """(gram, log) of different ``gram`` values that the longest contexts don't have, by escapes as in ``code_lengths``.

    A gram meets its six contexts in a join. Those of no and one byte, 257 at most that every gram shares, are broadcast.
    """

    def met(orders: range, table: DataFrame) -> DataFrame:
        context = lambda k: F.shiftright(F.col("gram").bitwiseAND(F.lit(int(MASKS[k]))), 8)
        each = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), context(k).alias("context")) for k in orders]))
        found = grams.select("gram", each.alias("c")).select("gram", "c.k", "c.context").join(table, ["k", "context"], "left")
        count = F.element_at("followers", F.col("gram").bitwiseAND(F.lit(255)))
        return found.select("gram", F.struct((-F.col("k")).alias("order"), "total", "seen", "gone", count.alias("count")).alias("c"))

    every = met(range(2), F.broadcast(contexts.where("k < 2"))).unionByName(met(range(2, ORDER + 1), contexts.where("k >= 2")))
    of = every.groupBy("gram").agg(F.sort_array(F.collect_list("c")).alias("c"))
    log, still, gone, longer = F.lit(0.0), F.lit(True), F.lit(0), F.lit(0)
    for i in range(ORDER + 1):
        here = F.col("c")[i]
        total, seen, count = here["total"] - gone, here["seen"] - longer, here["count"]
        add = F.when(count.isNotNull(), F.log10((count - 0.5) / total)).when(total > 0, F.log10(0.5 * seen / total))
        log, still = log + F.when(still, F.coalesce(add, F.lit(0.0))).otherwise(0.0), still & count.isNull()
        gone, longer = F.coalesce(here["gone"], F.lit(0)), F.coalesce(here["seen"], F.lit(0))
    return of.select("gram", (log - F.when(still, F.log10(SYMBOLS - longer)).otherwise(0.0)).alias("log"))


def least_count(grams: DataFrame, most: int) -> int:
    """The least n that at most ``most`` of the rows (gram, n) reach, to an eighth of a doubling: a row per step comes to the driver."""
    step = F.floor(F.log2("n") * 8 + 1e-9).alias("step")
    held, least = 0, 1 << 62
    for r in sorted(grams.groupBy(step).agg(F.count("*").alias("many"), F.min("n").alias("n")).collect(), key=lambda r: -r["step"]):
        held += r["many"]
        if held > most:
            break
        least = r["n"]
    return least


@dataclass
class Model:
    """What tasks know without a join: logarithms of frequent grams and words, and of the end."""

    grams: np.ndarray
    logs: np.ndarray
    words: dict[bytes, float]
    end: float


def scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", frequent: int = 1 << 20, near: int = 1 << 20) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row.

    ``score`` is the pretrained trie's log10 probability of the text as its lower-cased words and an end. The trie has all pairs of all
    training rows and stays in Spark. ``base_score`` is the smoothed unigram score of the same tokens.

    Words of at least 1 in ``frequent`` training tokens and the most counted ``near`` grams at most (a byte and its ORDER bytes before) are
    sent to the tasks with their logarithms. A text's other words, as 16-byte digests, and other grams leave the task and meet the whole
    tables in joins, so results don't depend on ``frequent`` or ``near``. Null and empty texts have the end only. Repeated rows and ids are scored
    one by one; other columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(id_col).alias("doc_id"), (fold(id_col, 5) == 1).alias("held_out"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    known = rows.where(~F.col("held_out"))
    ends = known.count()
    words = kept(word_counts(known))
    n, v = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    total, kinds = n + ends, v + (ends > 0)
    below = total + 0.5 * (kinds + 1)
    log = lambda c: F.log10((c + 0.5) / F.lit(float(below)))
    often = F.col("n") * frequent >= F.lit(total)
    top = words.where(often).select("word", log(F.col("n")).alias("log")).toPandas()
    longest = kept(gram_counts(known))
    contexts, least = kept(contexts_of(longest)), least_count(longest, near)
    grams = gram_logs(contexts)
    held = grams.where(F.col("n") >= least).select("gram", "log").toArrow()
    model = Model(held["gram"].to_numpy(), held["log"].to_numpy(), dict(zip(map(bytes, top["word"]), top["log"], strict=True)), float(np.log10((ends + 0.5) / below)))
    sent = send(spark, model)
    del held, top, model
    release(spark)

    @F.pandas_udf("struct<n_tokens:long,n_known:long,base:double,score:double,rare:binary,far:array<long>,times:array<long>>")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = received(sent)
        places = Places(m.grams)
        for batch in batches:
            texts = list(batch)
            logs = np.zeros(len(texts))
            far: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in texts]
            for key, of in slices(texts):
                found = places.find(key)
                hit = found >= 0
                logs += np.bincount(of[hit], m.logs[found[hit]], len(texts))
                key, of = key[~hit], of[~hit]
                borders = np.flatnonzero(np.diff(of)) + 1
                for part, text in zip(np.split(key, borders), of[np.append(0, borders)] if len(of) else [], strict=False):
                    far[text].append(np.unique(part, return_counts=True))
            out = []
            for text in texts:
                tokens, base, rare = 1, m.end, []
                for block in word_blocks(text.encode().lower()):
                    found = list(map(m.words.get, block))
                    tokens += len(block)
                    if None in found:
                        rare += [hashlib.md5(w).digest() for w, x in zip(block, found, strict=True) if x is None]
                        base += sum(x for x in found if x is not None)
                    else:
                        base += sum(found)
                out.append((tokens, tokens - len(rare) - (not ends), base, b"".join(rare)))
            frame = pd.DataFrame(out, columns=["n_tokens", "n_known", "base", "rare"])
            frame.insert(3, "score", logs)
            none = np.zeros(0, np.int64)
            for i, name in enumerate(("far", "times")):
                frame[name] = pd.Series([np.concatenate([none, *(x[i] for x in parts)]) for parts in far], dtype=object)
            yield frame

    scored = kept(rows.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "held_out", score("text").alias("s")))
    digests = F.transform(F.sequence(F.lit(0), (F.octet_length("s.rare") / 16 - 1).cast("int")), lambda i: F.substring(F.col("s.rare"), i * 16 + 1, F.lit(16)))
    rare = scored.where(F.octet_length("s.rare") > 0).select("uid", F.explode(digests).alias("digest"))
    counts = words.where(~often).select(F.unhex(F.md5("word")).alias("digest"), "n")
    met = rare.join(counts, "digest", "left").groupBy("uid").agg(F.sum(log(F.coalesce("n", F.lit(0)))).alias("_log"), F.count("n").alias("_known"))
    far = scored.select("uid", F.explode(F.arrays_zip("s.far", "s.times")).alias("f")).select("uid", F.col("f.far").alias("gram"), F.col("f.times").alias("times"))
    far = kept(far.join(grams.where(F.col("n") < least).select("gram", "log"), "gram", "left"))
    strange = far.where("log is null").select("uid", "gram", "times")
    escaped = strange.join(escaped_logs(strange.select("gram").distinct(), contexts), "gram")
    coded_far = far.where("log is not null").select("uid", "times", "log").unionByName(escaped.select("uid", "times", "log"))
    coded_far = coded_far.groupBy("uid").agg(F.sum(F.col("times") * F.col("log")).alias("_far"))
    thin = scored.select("uid", "doc_id", "held_out", *[F.col(f"s.{c}").alias(c) for c in ("n_tokens", "n_known", "base", "score")])
    whole = thin.join(met, "uid", "left").join(coded_far, "uid", "left")
    return whole.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("_log", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("_far", F.lit(0.0))).alias("score"),
    )
