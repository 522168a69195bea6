"""SentencePiece encoding and decoding; giant texts by a max-plus scan over chunks.

The model's BPE merges the best scored adjacent pair until none is left. A sequence of pieces is the encoding of its text
exactly if every two neighbours are the encoding of theirs, so an encoding is the one path of finite weight through the
graph of pieces whose edges weigh 0 between neighbours that fit and minus infinity otherwise. Chunks of a giant text become
max-plus matrices from the pieces over their left border to those over their right one.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm.common import kept, received, send, small_batches

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BLANK = "▁"  # fixed value: how the format writes a space
NEVER = -np.inf
PARTS = (
    "uid long, id string, no int, behind string, body string, ahead string, open_left boolean, open_right boolean, "
    "rows int, cols int, matrix array<double>, ids array<int>, ok boolean"
)


@dataclass
class Vocabulary:
    """What a model file says: pieces with number and score, the bytes' numbers, and each number's text as bytes."""

    pieces: dict[str, tuple[int, float]]
    byte_ids: list[int]
    texts: list[bytes]
    longest: int


def vocabulary(path: str = MODEL) -> Vocabulary:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, byte_ids, texts = {}, [model.unk_id()] * 256, []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
            texts.append(bytes([int(piece[3:5], 16)]))
        elif model.is_control(i) or model.is_unknown(i):
            texts.append(b"")
        else:
            pieces[piece] = (i, model.get_score(i))
            texts.append(piece.replace(BLANK, " ").encode())
    return Vocabulary(pieces, byte_ids, texts, max(map(len, pieces)))


def _segments(v: Vocabulary) -> str:
    """A pattern that cuts a text where no piece can lie over the cut.

    A piece has blanks at its start only, and characters that no longer piece has stand alone. ``tail`` characters are letters and
    whatever follows one inside a piece; no piece has another character after one of them, so there is a cut in between.
    """
    longer = [p for p in v.pieces if len(p) > 1]
    joined = {c for p in longer for c in p} - {BLANK}
    tail, follows = {c for c in joined if c.isalpha()}, {(a, b) for p in longer for a, b in zip(p, p[1:]) if a != BLANK}
    while more := {b for a, b in follows if a in tail} - tail:
        tail |= more
    head = joined - tail
    of = lambda chars: "".join(map(re.escape, sorted(chars)))
    ways = [f"{BLANK}*{f'[{of(head)}]*' if head else ''}[{of(tail)}]+"] if tail else []
    ways += [f"{BLANK}*[{of(head)}]+"] if head else []
    return "|".join([*ways, f"{BLANK}+", f"[^{of(joined)}{BLANK}]" if joined else "."])


class Encoder:
    """Encoding with a vocabulary: segments that no piece crosses are encoded once and remembered."""

    def __init__(self, v: Vocabulary, most: int = 500_000) -> None:
        self.v, self.most, self.fits = v, most, {}
        self.score = {p: s for p, (_, s) in v.pieces.items()}
        self.ids = {p: i for p, (i, _) in v.pieces.items()}
        self.segment = re.compile(_segments(v), re.S)
        encoder = self

        class Memory(dict):
            def __missing__(self, segment: str) -> tuple:
                part = encoder.merged(segment)
                try:
                    found = tuple(map(encoder.ids.__getitem__, part))
                except KeyError:
                    found = tuple(chain.from_iterable(map(encoder.numbers, part)))
                if len(self) >= encoder.most:
                    self.clear()
                self[segment] = found
                return found

        self.memory = Memory()

    def numbers(self, piece: str) -> tuple:
        known = self.v.pieces.get(piece)
        return (known[0],) if known else tuple(self.v.byte_ids[b] for b in piece.encode("utf-8", "replace"))

    def merged(self, text: str) -> list[str]:
        """The pieces of one segment: best score first, leftmost first among equals."""
        if len(text) <= 1:
            return [text] if text else []
        if len(text) <= 128:
            return self._merged_short(text)
        known = self.v.pieces
        part: list[str | None] = list(text)
        after, before = list(range(1, len(text) + 1)), list(range(-1, len(text) - 1))
        queue: list[tuple[float, int, str]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < len(part):
                both = part[i] + part[j]
                if both in known:
                    heapq.heappush(queue, (-known[both][1], i, both))

        for i in range(len(text) - 1):
            offer(i)
        while queue:
            _, i, both = heapq.heappop(queue)
            if part[i] is None or after[i] >= len(part) or part[i] + part[after[i]] != both:
                continue
            j = after[i]
            part[i], part[j] = both, None
            after[i] = after[j]
            if after[j] < len(part):
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [p for p in part if p is not None]

    def _merged_short(self, text: str) -> list[str]:
        get, part = self.score.get, list(text)
        pairs = [get(a + b, NEVER) for a, b in zip(part, part[1:])]
        while pairs:
            best = max(pairs)
            if best == NEVER:
                break
            i = pairs.index(best)
            part[i : i + 2] = [part[i] + part[i + 1]]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = get(part[i] + part[i + 1], NEVER)
            if i:
                pairs[i - 1] = get(part[i - 1] + part[i], NEVER)
        return part

    def fit(self, a: str, b: str) -> bool:
        key = (a, b)
        found = self.fits.get(key)
        if found is None:
            if len(self.fits) > self.most:
                self.fits.clear()
            found = self.fits[key] = self.merged(a + b) == [a, b]
        return found

    def encode(self, escaped: str) -> list[int]:
        return list(chain.from_iterable(map(self.memory.__getitem__, self.segment.findall(escaped))))

    def decode(self, ids: list[int]) -> str:
        """The text of all numbers, its leading blank included."""
        return b"".join(map(self.v.texts.__getitem__, ids)).decode("utf-8", "replace")

    def cut(self, text: str, at: int) -> bool:
        """Whether no piece can lie over the place before character ``at``."""
        if at <= 0 or at >= len(text):
            return True
        return self.segment.match(text, max(0, self._start(text, at))).end() <= at

    def _start(self, text: str, at: int) -> int:
        """A place at or before ``at`` - 1 where a segment starts, or as far back as a piece can reach."""
        low = max(0, at - 2 * self.v.longest)
        start = low
        for m in self.segment.finditer(text, low, at):
            start = m.start()
        return start

    def over(self, text: str, at: int) -> list[tuple[int, int]]:
        """The pieces that lie over or end at ``at``, as (start, end); a border's states, the same from either side."""
        found = []
        for start in range(max(0, at - self.v.longest), at):
            for end in range(at, min(len(text), start + self.v.longest) + 1):
                if text[start:end] in self.v.pieces or end - start == 1:
                    found.append((start, end))
        return found

    def paths(self, text: str, begins: list[tuple[int, int]] | int, stop: int, ends: list[tuple[int, int]] | None) -> dict:
        """Pieces reachable from ``begins`` (or from the segment start ``begins``) up to ``stop``.

        {(start, end): bits of the begins it can be reached from}; pieces start before ``stop`` and, unless ``ends`` are
        given, end there at the latest.
        """
        reach: dict[tuple[int, int], int] = {}
        at: dict[int, list[tuple[int, int]]] = {}
        if isinstance(begins, int):
            first, free = begins, {begins: 1}
        else:
            first, free = min(e for _, e in begins), {}
            for bit, piece in enumerate(begins):
                reach[piece] = 1 << bit
                at.setdefault(piece[1], []).append(piece)
        limit = len(text) if ends is not None else stop
        for start in range(first, stop):
            before = at.get(start, [])
            if not before and start not in free:
                continue
            for end in range(start + 1, min(limit, start + self.v.longest) + 1):
                piece = text[start:end]
                if end - start > 1 and piece not in self.v.pieces:
                    continue
                bits = free.get(start, 0)
                for other in before:
                    if reach[other] & ~bits and self.fit(text[other[0] : start], piece):
                        bits |= reach[other]
                if bits:
                    if (start, end) not in reach:
                        at.setdefault(end, []).append((start, end))
                    reach[(start, end)] = reach.get((start, end), 0) | bits
        return reach

    def back(self, text: str, reach: dict, begins: list[tuple[int, int]] | int, last: tuple[int, int]) -> list[str]:
        """The one path of fitting pieces that ends with ``last``."""
        ending: dict[int, list[tuple[int, int]]] = {}
        for piece in reach:
            ending.setdefault(piece[1], []).append(piece)
        path = [last]
        while path[-1][0] != begins if isinstance(begins, int) else path[-1] not in begins:
            here = text[path[-1][0] : path[-1][1]]
            path.append(next(p for p in ending[path[-1][0]] if self.fit(text[p[0] : p[1]], here)))
        if not isinstance(begins, int):
            path.pop()
        return [text[a:b] for a, b in reversed(path)]


@dataclass
class Chunk:
    """Part of a text with what pieces over its borders need from its neighbours. An open border has several states."""

    behind: str
    body: str
    ahead: str
    open_left: bool
    open_right: bool

    def layout(self, e: Encoder) -> tuple[str, int, int, list[tuple[int, int]], int, int]:
        """Text, start, end, segments inside, and the first and last cut (end and start where there is none)."""
        text, start = self.behind + self.body + self.ahead, len(self.behind)
        end = start + len(self.body)
        if not self.open_left and not self.open_right:
            return text, start, end, start, end
        cuts = [m.start() for m in e.segment.finditer(text) if start <= m.start() <= end and (m.start() > 0 or not self.open_left)]
        if self.open_left:
            cuts = [c for c in cuts if c > start]
        else:
            cuts = [start, *cuts]
        if self.open_right:
            cuts = [c for c in cuts if c < end]
        else:
            cuts = [*cuts, end]
        return text, start, end, min(cuts, default=-1), max(cuts, default=-1)

    def states(self, e: Encoder) -> tuple[list | None, list | None]:
        text, start = self.behind + self.body + self.ahead, len(self.behind)
        return e.over(text, start) if self.open_left else None, e.over(text, start + len(self.body)) if self.open_right else None

    def matrix(self, e: Encoder) -> np.ndarray:
        """Weight from each state of the left border to each of the right one: 0 or minus infinity."""
        text, start, end, first, last = self.layout(e)
        left, right = self.states(e)
        out = np.full((len(left) if left else 1, len(right) if right else 1), NEVER)
        if first < 0:
            reach = e.paths(text, left, end, right)
            for j, piece in enumerate(right):
                for i in range(len(left)):
                    if reach.get(piece, 0) >> i & 1:
                        out[i, j] = 0
            return out
        enters = np.zeros(out.shape[0])
        if left:
            reach = e.paths(text, left, first, None)
            bits = 0
            for piece, b in reach.items():
                bits |= b if piece[1] == first else 0
            enters = np.array([0 if bits >> i & 1 else NEVER for i in range(len(left))])
        leaves = np.zeros(out.shape[1])
        if right:
            reach = e.paths(text, last, end, right)
            leaves = np.array([0 if reach.get(p) else NEVER for p in right])
        return enters[:, None] + leaves[None, :]

    def encode(self, e: Encoder, enter: int, leave: int) -> tuple[list[int], bool]:
        """The numbers of the pieces that start in this chunk, given its border states; whether they spell its text."""
        text, start, end, first, last = self.layout(e)
        left, right = self.states(e)
        begin, stop = left[enter][1] if left else start, right[leave][1] if right else end
        if first < 0:
            whole = e.back(text, e.paths(text, [left[enter]], end, right), [left[enter]], right[leave])
            ids = list(chain.from_iterable(map(e.numbers, whole)))
        else:
            ids = []
            if left and begin < first:
                reach = e.paths(text, [left[enter]], first, None)
                ends = [p for p in reach if p[1] == first and p != left[enter]]
                ids += chain.from_iterable(map(e.numbers, e.back(text, reach, [left[enter]], ends[0])))
            ids += e.encode(text[max(begin, first) : last])
            if right:
                ids += chain.from_iterable(map(e.numbers, e.back(text, e.paths(text, last, end, right), last, right[leave])))
        return ids, e.decode(ids) == text[begin:stop].replace(BLANK, " ")


def chunks(escaped: str, e: Encoder, size: int) -> Iterator[Chunk]:
    """Chunks of at least ``size`` characters. A border moves on to the next cut if one is near, else it is open."""
    reach, at, was_open = 2 * e.v.longest, 0, False
    while at < len(escaped):
        end, opened = at + size, True
        if end >= len(escaped) - reach:
            end, opened = len(escaped), False
        else:
            for place in range(end, min(end + 4 * reach, len(escaped))):
                if e.cut(escaped, place):
                    end, opened = place, False
                    break
        yield Chunk(escaped[max(0, at - reach) : at] if was_open else "", escaped[at:end], escaped[end : end + reach] if opened else "", was_open, opened)
        at, was_open = end, opened


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus matrix product."""
    return (a[:, :, None] + b[None, :, :]).max(axis=1)


def scan(matrices: list[np.ndarray]) -> list[np.ndarray]:
    """Max-plus products of each prefix, by halves: pairs are combined, scanned, and filled in between."""
    if len(matrices) < 2:
        return list(matrices)
    pairs = scan([product(matrices[i], matrices[i + 1]) for i in range(0, len(matrices) - 1, 2)])
    out = [matrices[0]]
    for i in range(1, len(matrices)):
        out.append(pairs[i // 2] if i % 2 else product(pairs[i // 2 - 1], matrices[i]))
    return out


def border_states(matrices: list[np.ndarray]) -> list[tuple[int, int]]:
    """(state on entering, state on leaving) of each chunk on the best path."""
    ahead, state, out = scan(matrices), 0, []
    for k in range(len(matrices) - 1, -1, -1):
        before = ahead[k - 1][0] if k else np.zeros(1)
        enter = int(np.argmax(before + matrices[k][:, state]))
        out.append((enter, state))
        state = enter
    return out[::-1]


def escape(text: str) -> str:
    return BLANK + text.replace(" ", BLANK) if text else ""


def _short(sent: Broadcast) -> Callable:
    @F.pandas_udf("struct<ids:array<int>,round_trip:boolean>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        e = Encoder(received(sent))
        for texts in batches:
            ids = [e.encode(escape(t)) if t else [] for t in texts]
            right = [e.decode(i)[1:] == t.replace(BLANK, " ") if t else True for i, t in zip(ids, texts, strict=True)]
            yield pd.DataFrame({"ids": ids, "round_trip": right})

    return encode


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL, chunk: int = 16384) -> DataFrame:
    """(id, ids, n_tokens, n_chunks, round_trip) per row: the numbers the model's own library gives, of whole texts.

    Texts up to ``chunk`` characters are one chunk. Longer ones are cut into chunks. A chunk between two cuts has one state on either
    side and is encoded at once; where no cut is near, the border is open and the chunk yields its matrix. A document's matrices (never
    its text) then meet in one task where they are scanned, and its open chunks, spread over the cluster, are traced back each on its own.
    Null and empty texts have no tokens. ``round_trip``: decoding gives the text again (U+2581, the format's blank, counts as a
    space). Repeated rows and ids are encoded one by one; other columns are ignored. The vocabulary is read on the driver.
    """
    spark = docs.sparkSession
    small_batches(spark)
    sent = send(spark, vocabulary(model))
    kind = docs.schema[id_col].dataType
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    giant = F.coalesce(F.length("text") > chunk, F.lit(False))
    short = rows.where(~giant).select("doc_id", _short(sent)(F.col("text")).alias("_e"))
    short = short.select("doc_id", F.col("_e.ids").alias("ids"), F.lit(1).alias("n_chunks"), F.col("_e.round_trip").alias("round_trip"))

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        e = Encoder(received(sent))
        for batch in batches:
            for uid, name, text in zip(batch["uid"], batch["id"], batch["text"], strict=True):
                out = []
                for no, c in enumerate(chunks(escape(text), e, chunk)):
                    if c.open_left or c.open_right:
                        m = c.matrix(e)
                        out.append((uid, name, no, c.behind, c.body, c.ahead, c.open_left, c.open_right, *m.shape, m.ravel(), None, None))
                    else:  # one state on either side: the chunk's path is known
                        out.append((uid, name, no, None, None, None, False, False, 1, 1, [0.0], *c.encode(e, 0, 0)))
                yield pd.DataFrame(out, columns=[x.split()[0] for x in PARTS.split(", ")], dtype=object)

    named = rows.where(giant).select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("string").alias("id"), "text")
    parts = kept(named.mapInPandas(deal, PARTS))

    def resolve(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("no")
        found = border_states([np.array(m).reshape(r, c) for r, c, m in zip(group["rows"], group["cols"], group["matrix"], strict=True)])
        return pd.DataFrame({"uid": group["uid"], "no": group["no"], "enter": [a for a, _ in found], "leave": [b for _, b in found]})

    closed = parts.where("not open_left and not open_right").select("uid", "id", "no", "ids", "ok")
    pending = parts.where("open_left or open_right")
    scanned = parts.select("uid", "no", "rows", "cols", "matrix").join(pending.select("uid").distinct(), "uid", "left_semi")
    states = scanned.groupBy("uid").applyInPandas(resolve, "uid long, no int, enter int, leave int")

    def trace(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        e = Encoder(received(sent))
        for batch in batches:
            found = [Chunk(r.behind, r.body, r.ahead, r.open_left, r.open_right).encode(e, r.enter, r.leave) for r in batch.itertuples(index=False)]
            yield pd.DataFrame({"uid": batch["uid"], "id": batch["id"], "no": batch["no"], "ids": [i for i, _ in found], "ok": [ok for _, ok in found]})

    traced = pending.join(states, ["uid", "no"]).select("uid", "id", "no", "behind", "body", "ahead", "open_left", "open_right", "enter", "leave")
    traced = traced.mapInPandas(trace, "uid long, id string, no int, ids array<int>, ok boolean")
    whole = closed.unionByName(traced).groupBy("uid").agg(
        F.first("id").alias("id"), F.array_sort(F.collect_list(F.struct("no", "ids"))).alias("_parts"), F.count("*").cast("int").alias("n_chunks"), F.min("ok").alias("round_trip")
    )
    long = whole.select(F.col("id").cast(kind).alias("doc_id"), F.flatten(F.transform("_parts", lambda p: p["ids"])).alias("ids"), "n_chunks", "round_trip")
    return short.unionByName(long).select("doc_id", "ids", F.size("ids").alias("n_tokens"), "n_chunks", "round_trip")


def decode(spark: SparkSession, model: str = MODEL) -> Callable:
    """A column function from numbers to text: null stays null; bytes that make no character become U+FFFD."""
    sent = send(spark, vocabulary(model))

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        e = Encoder(received(sent))
        for ids in batches:
            yield pd.Series([None if i is None else e.decode(list(i))[1:] for i in ids], dtype=object)

    return text
