"""Token numbers in binary files of patched frame-of-reference blocks.

A file is a row of segments. A segment holds whole documents of one stretch of the corpus, all numbers little-endian::

    header    "PFOR" | bytes of the segment u4 | part u4 | segment in part u4 | documents u4 | blocks u4 | numbers u8 | numbers of the part before u8
    documents bytes of the section u4, then per document: bytes of its id u4 (2^32 - 1: null) | id in UTF-8 | numbers u4
    index     per block: where its body starts, in bytes from the first body, u4
    bodies    per block: minimum u4 | width u1 | exceptions u1 | numbers less one u1 | packed | places u1 each | offsets u4 each

A block has up to 256 numbers. Its minimum is subtracted, offsets are packed at the width that a percentile of them needs, and those that
don't fit are exceptions: their low bits are packed, their place and whole offset listed. After each segment stands one line feed.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventide.llm.common import kept, received, send, shared_folder, small_batches

MAGIC, HEADER, BLOCK_HEAD = b"PFOR", "<4sIIIIIQQ", "<IBBB"
HEADER_SIZE = struct.calcsize(HEADER)
BLOCK, NO_ID = 256, 2**32 - 1
PERCENTILE = 98.0

SPACE_MARK = "\u0120"  # fixed value: how the vocabulary writes a space byte
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
# Pieces whose ends no tokenizer takes for white space.
# Words that the vocabulary's pre-tokenizer takes as one part after a space, and the marks after them, which are another part.
LETTERS = "".join(c for c in map(chr, range(0x250)) if c.isalpha() and c not in "ªº")
SIGNS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())
# How byte-level vocabularies write each byte; those that don't stand for themselves are written from U+0100 on.
BYTES = np.arange(256, dtype="<u4")
BYTES[[*range(33), *range(127, 161), 173]] = np.arange(256, 324)
SOME, SEARCHED = 1 << 14, 1 << 18  # parts that are Python objects at a time; pieces in a block of the table
PLAIN, CLOSED = r"^[!-~\pL\pN]([^ ]*[!-~\pL\pN])?$", re.compile(r"([!-~]|[^\W_])\Z")


def _bits(values: np.ndarray, width: int) -> np.ndarray:
    """Each row's numbers at ``width`` bits, low bits first, as rows of bytes. Eight numbers fill ``width`` bytes."""
    rows, n = values.shape
    groups = -(-n // 8)
    eights = np.zeros((rows, groups * 8), np.uint64)
    eights[:, :n] = values
    out = np.zeros((rows, groups, width), np.uint8)
    for j in range(8):
        first, shift = divmod(j * width, 8)
        spread = eights[:, j::8] << np.uint64(shift)
        for i in range((shift + width + 7) // 8):
            out[:, :, first + i] |= (spread >> np.uint64(8 * i)).astype(np.uint8)
    return out.reshape(rows, -1)[:, : (n * width + 7) // 8]


def _numbers(packed: np.ndarray, n: int, width: int) -> np.ndarray:
    """The numbers of :func:`_bits`."""
    rows, groups = len(packed), -(-n // 8)
    eights = np.zeros((rows, groups * width), np.uint8)
    eights[:, : packed.shape[1]] = packed
    eights = eights.reshape(rows, groups, width)
    out, mask = np.zeros((rows, groups * 8), np.uint32), np.uint64((1 << width) - 1)
    for j in range(8):
        first, shift = divmod(j * width, 8)
        gathered = np.zeros((rows, groups), np.uint64)
        for i in range((shift + width + 7) // 8):
            gathered |= eights[:, :, first + i].astype(np.uint64) << np.uint64(8 * i)
        out[:, j::8] = (gathered >> np.uint64(shift)) & mask
    return out[:, :n]


def _pack_rows(values: np.ndarray, percentile: float) -> list[bytes]:
    """Bodies of blocks that have as many numbers each, a block per row."""
    rows, n = values.shape
    low = values.min(axis=1)
    away = values - low[:, None]
    place = min(n - 1, int(np.ceil(percentile / 100 * n)) - 1) if percentile < 100 else n - 1
    fits = np.partition(away, max(place, 0), axis=1)[:, max(place, 0)]
    widths = np.frexp(fits.astype(np.float64))[1]  # bits that hold the percentile
    out: list[bytes] = [b""] * rows
    for width in np.unique(widths):
        mine = np.flatnonzero(widths == width)
        part, mask = away[mine], np.uint32((1 << int(width)) - 1)
        packed = _bits(part & mask, int(width))
        outlying = part > mask
        counts = outlying.sum(axis=1)
        for row, at in enumerate(mine):
            body = struct.pack(BLOCK_HEAD, int(low[at]), int(width), int(counts[row]), n - 1) + packed[row].tobytes()
            if counts[row]:
                where = np.flatnonzero(outlying[row])
                body += where.astype(np.uint8).tobytes() + part[row, where].astype("<u4").tobytes()
            out[at] = body
    return out


def pack(values: np.ndarray, percentile: float = PERCENTILE) -> list[bytes]:
    """Bodies of the blocks of a run of numbers below 2^32."""
    whole = len(values) // BLOCK * BLOCK
    out = _pack_rows(values[:whole].reshape(-1, BLOCK).astype(np.uint32), percentile) if whole else []
    return out + _pack_rows(values[None, whole:].astype(np.uint32), percentile) if len(values) > whole else out


def unpack(bodies: bytes, starts: np.ndarray) -> np.ndarray:
    """The numbers of the blocks whose bodies begin at ``starts``; blocks of one shape are unpacked together."""
    raw = np.frombuffer(bodies, np.uint8)
    starts = starts.astype(np.int64)
    head = raw[starts[:, None] + np.arange(7)]
    low = np.ascontiguousarray(head[:, :4]).view("<u4")[:, 0]
    width, outlying, n = head[:, 4].astype(np.int64), head[:, 5].astype(np.int64), head[:, 6].astype(np.int64) + 1
    ends = np.cumsum(n)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint32)
    for shape in np.unique(width * 512 + n):
        w, m = int(shape) >> 9, int(shape) & 511
        mine = np.flatnonzero((width == w) & (n == m))
        size = (m * w + 7) // 8
        found = _numbers(raw[starts[mine, None] + 7 + np.arange(size)], m, w)
        for row in np.flatnonzero(outlying[mine]):
            at, many = int(starts[mine[row]]) + 7 + size, int(outlying[mine[row]])
            found[row, raw[at : at + many]] = np.frombuffer(bodies, "<u4", many, at + many)
        out[(ends[mine] - m)[:, None] + np.arange(m)] = found + low[mine, None]
    return out


def write_segment(part: int, number: int, before: int, names: list[str | None], runs: list[bytes], percentile: float = PERCENTILE) -> bytes:
    """Documents' numbers, given as u4, as one segment; its blocks run across documents."""
    values = np.frombuffer(b"".join(runs), "<u4")
    bodies = pack(values, percentile)
    raw = [b"" if x is None else x.encode() for x in names]
    sizes = [NO_ID if x is None else len(r) for x, r in zip(names, raw, strict=True)]
    listed = b"".join(struct.pack("<I", n) + r + struct.pack("<I", len(run) // 4) for n, r, run in zip(sizes, raw, runs, strict=True))
    starts = np.cumsum([0, *map(len, bodies)])[:-1].astype("<u4").tobytes() if bodies else b""
    body = struct.pack("<I", len(listed)) + listed + starts + b"".join(bodies)
    return struct.pack(HEADER, MAGIC, HEADER_SIZE + len(body), part, number, len(names), len(bodies), len(values), before) + body


class Segment:
    """Reads a segment's documents, all its numbers, or those of a span through the block index."""

    def __init__(self, data: bytes, at: int = 0) -> None:
        magic, self.size, self.part, self.number, count, blocks, self.length, self.before = struct.unpack_from(HEADER, data, at)
        if magic != MAGIC or at + self.size > len(data):
            raise ValueError("no whole segment at this place")
        place = at + HEADER_SIZE + 4
        self.names: list[str | None] = []
        self.lengths: list[int] = []
        for _ in range(count):
            size = struct.unpack_from("<I", data, place)[0]
            place += 4
            if size == NO_ID:
                self.names.append(None)
            else:
                self.names.append(data[place : place + size].decode())
                place += size
            self.lengths.append(struct.unpack_from("<I", data, place)[0])
            place += 4
        self.starts = np.frombuffer(data, "<u4", blocks, place)
        self.bodies = data[place + 4 * blocks : at + self.size]

    def numbers(self) -> np.ndarray:
        return unpack(self.bodies, self.starts) if len(self.starts) else np.zeros(0, np.uint32)

    def span(self, first: int, count: int) -> np.ndarray:
        """``count`` numbers from place ``first`` on; only their blocks are read."""
        block = first // BLOCK
        found = unpack(self.bodies, self.starts[block : (first + count - 1) // BLOCK + 1]) if count else np.zeros(0, np.uint32)
        return found[first - block * BLOCK :][:count]


def segments(data: bytes) -> Iterator[Segment]:
    """The segments of a file."""
    at = 0
    while at < len(data):
        one = Segment(data, at)
        yield one
        at += one.size + 1


class Pieces:
    """Encodes texts by the library, each different piece between plain spaces once.

    A space between two characters that are no white space always starts a token, and no token of the vocabulary goes across it. So
    what stands between such spaces may be encoded by itself: a batch's pieces are numbered, new ones encoded together, the others
    taken from a table. A piece that is LETTERS with SIGNS or none after them has two parts for the pre-tokenizer; these go to the library's model
    directly, each different one once in a batch. Texts with other spaces are encoded whole.

    Beside the table, memory goes to one batch's pieces: Python objects and tokens are made for SOME of them at a time, and the table is
    searched block by block, as the library's search makes a hash table of all that it is given.
    """

    def __init__(self, definition: str, end: int, most: int = 1 << 21) -> None:
        from tokenizers import Tokenizer

        self.encoder, self.end, self.most = Tokenizer.from_str(definition), np.array([end], "<u4").tobytes(), most
        vocabulary = self.encoder.get_vocab()
        self.starts = np.zeros(max(vocabulary.values()) + 1, bool)  # numbers of tokens that start with a space
        self.starts[[n for token, n in vocabulary.items() if token.startswith(SPACE_MARK)]] = True
        parts = json.loads(definition)
        byte_level = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        self.direct = (
            parts.get("normalizer") is None
            and byte_level.items() <= (parts.get("pre_tokenizer") or {}).items()
            and parts["model"]["type"] == "BPE"
            and not any(not x["content"].lstrip(" ").lstrip(LETTERS).rstrip(SIGNS) for x in parts.get("added_tokens", ()))
        )
        self.forget()

    def forget(self) -> None:
        """Blocks of known pieces, as they are after a space, and the numbers of each: ``sizes`` many from ``places`` on; -1: not to be taken by itself."""
        self.known: list[pa.StringArray] = []
        self.numbers = np.zeros(0, "<u4")
        self.sizes = self.places = np.zeros(0, np.int64)

    def whole(self, text: str) -> bytes:
        return np.array(self.encoder.encode(text, add_special_tokens=False).ids, "<u4").tobytes() if text else b""

    def parts(self, parts: pa.StringArray, words: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(numbers, sizes) of parts by the library's model; ``words`` are written as the vocabulary has them after a space."""
        tokenize, numbers, sizes = self.encoder.model.tokenize, [np.zeros(0, "<u4")], [np.zeros(0, np.int64)]
        for first in range(0, len(parts), SOME):
            some = parts.slice(first, SOME).to_pylist()
            if words:
                written = BYTES[np.frombuffer((" " + " ".join(some)).encode(), np.uint8)].tobytes().decode("utf-32-le")
                some = [SPACE_MARK + w for w in written.split(SPACE_MARK)[1:]]
            found = [[token.id for token in tokenize(part)] for part in some]
            numbers.append(np.fromiter(chain.from_iterable(found), "<u4"))
            sizes.append(np.fromiter(map(len, found), np.int64, len(found)))
        return np.concatenate(numbers), np.concatenate(sizes)

    def simple(self, pieces: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """(numbers, sizes) of pieces of LETTERS and SIGNS, as they are after a space."""
        words = pc.utf8_rtrim(pieces, characters=SIGNS).dictionary_encode()
        signs = pc.utf8_ltrim(pieces, characters=LETTERS).dictionary_encode()
        numbers, sizes = self.parts(words.dictionary, words=True)
        more, more_sizes = self.parts(signs.dictionary)
        pool, sizes = np.concatenate([numbers, more]), np.concatenate([sizes, more_sizes])
        which = np.stack([words.indices.to_numpy(), signs.indices.to_numpy() + len(words.dictionary)], axis=1).ravel()
        starts, lengths = (np.cumsum(sizes) - sizes)[which], sizes[which]
        upto = np.cumsum(lengths)
        return pool[np.repeat(starts - (upto - lengths), lengths) + np.arange(upto[-1])], lengths.reshape(-1, 2).sum(axis=1)

    def learn(self, pieces: pa.StringArray) -> np.ndarray:
        """Where each of the different ``pieces`` stands in the table, new ones added to it."""
        if len(self.sizes) > self.most:
            self.forget()
        at, fresh, new, before = np.zeros(len(pieces), np.int64), pieces, np.arange(len(pieces)), 0
        for block in self.known:
            found = pc.index_in(fresh, value_set=block)
            unknown = pc.is_null(found)
            at[new] = before + pc.fill_null(found, 0).to_numpy(zero_copy_only=False)
            fresh, new = fresh.filter(unknown), new[unknown.to_numpy(zero_copy_only=False)]
            before += len(block)
        if not len(fresh):
            return at
        at[new] = before + np.arange(len(fresh))
        sizes, places, numbers = np.full(len(fresh), -1, np.int64), np.zeros(len(fresh), np.int64), [self.numbers]
        signs = pc.utf8_ltrim(fresh, characters=LETTERS)
        simple = pc.and_(pc.less(pc.binary_length(signs), pc.binary_length(fresh)), pc.equal(pc.utf8_rtrim(signs, characters=SIGNS), ""))
        simple = simple.to_numpy(zero_copy_only=False) & self.direct
        if simple.any():
            ids, sizes[simple] = self.simple(fresh.filter(pa.array(simple)))
            numbers.append(ids)
        rows = np.flatnonzero(~simple)
        rows = rows[pc.match_substring_regex(fresh.take(rows), PLAIN).to_numpy(zero_copy_only=False)]
        for first in range(0, len(rows), 4096):
            some = rows[first : first + 4096]
            text = " " + " ".join(fresh.take(some).to_pylist())
            ids = np.array(self.encoder.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            sizes[some] = np.diff([*np.flatnonzero(self.starts[ids]), len(ids)])
            numbers.append(ids)
        order = np.concatenate([np.flatnonzero(simple), rows])  # as ``numbers`` has them
        places[order] = len(self.numbers) + np.cumsum(sizes[order]) - sizes[order]
        self.numbers = np.concatenate(numbers)
        if self.known and len(self.known[-1]) + len(fresh) <= SEARCHED:
            fresh = pa.concat_arrays([self.known.pop(), fresh])
        self.known.append(fresh)
        self.sizes, self.places = np.concatenate([self.sizes, sizes]), np.concatenate([self.places, places])
        return at

    def encode(self, texts: pa.StringArray) -> list[bytes]:
        """Numbers of each whole text and the end, as u4; null is as empty."""
        split = pc.split_pattern(pc.fill_null(texts, ""), " ")
        bounds = split.offsets.to_numpy() - split.offsets[0].as_py()
        coded = split.flatten().dictionary_encode()
        if not len(coded):
            return []
        place, indices, out = self.learn(coded.dictionary), coded.indices.to_numpy(), []
        for text, a, b in zip(texts, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            first, at = (text.as_py() or "").split(" ", 1)[0], place[indices[a + 1 : b]]  # a text's first piece has no space before it
            lengths = self.sizes[at]
            if b > a + 1 and (lengths.min() < 0 or not CLOSED.search(first)):
                out.append(self.whole(text.as_py()) + self.end)
            else:
                out.append(self.whole(first) + self.taken(at, lengths) + self.end)
        return out

    def taken(self, at: np.ndarray, lengths: np.ndarray) -> bytes:
        """The numbers of the table's pieces ``at``, one after the other; a long text's SEARCHED pieces at a time."""
        out = []
        for first in range(0, len(at), SEARCHED):
            some = lengths[first : first + SEARCHED]
            upto = np.cumsum(some)
            out.append(self.numbers[np.repeat(self.places[at[first : first + SEARCHED]] - (upto - some), some) + np.arange(upto[-1])].tobytes())
        return b"".join(out)


def write_tokens(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY, end: int = 2, segment: int = 1 << 18,
    percentile: float = PERCENTILE, per_file: int = 32, stretch: int = 128 << 20,
) -> None:
    """Write every whole text's numbers, each text's followed by ``end``, in ascending order of the id as files under ``path``.

    Null ids come first; equal ids stand in the order of a hash of their texts. Null and empty texts have the end only. Repeated rows are
    written each. Other columns are ignored. An empty table leaves a folder without files.

    Range partitioning at sampled splitters orders the table and cuts heavy ids. A task encodes about ``stretch`` bytes, so that most of
    its pieces are known, and writes segments of about ``segment`` numbers, ``per_file`` to a file. It holds one Arrow batch and one
    segment, and at least one document.
    """
    small_batches(docs.sparkSession, rows=2000)
    with open(vocabulary, encoding="utf-8") as file:
        sent = send(docs.sparkSession, file.read())

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, number, before = Pieces(received(sent), end), TaskContext.get().partitionId(), 0, 0
        names: list[str | None] = []
        runs: list[bytes] = []
        held = 0
        for batch in batches:
            out = []
            for name, run in zip(batch.column("_id").to_pylist(), encoder.encode(batch.column("_text")), strict=True):
                names.append(name)
                runs.append(run)
                held += len(run) // 4
                if held >= segment:
                    out.append(write_segment(part, number, before, names, runs, percentile))
                    number, before, names, runs, held = number + 1, before + held, [], [], 0
            yield pa.RecordBatch.from_pydict({"segment": pa.array(out, pa.binary())})
        if names:
            yield pa.RecordBatch.from_pydict({"segment": pa.array([write_segment(part, number, before, names, runs, percentile)], pa.binary())})

    rows = docs.select(F.col(id_col).alias("_order"), F.col(id_col).cast("string").alias("_id"), F.col(text_col).alias("_text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("_text")), F.lit(0))).first()[0]
    parts = max(docs.sparkSession.sparkContext.defaultParallelism, -(-size // stretch))
    rows = rows.withColumns({"_hash": F.xxhash64("_text"), "_origin": F.spark_partition_id()})
    ordered = rows.repartitionByRange(parts, "_order", "_hash", "_origin").sortWithinPartitions("_order", "_hash")
    written = ordered.select("_id", "_text").mapInArrow(encode, "segment binary").select(F.col("segment").cast("string").alias("value"))
    written.write.option("lineSep", "\n").option("maxRecordsPerFile", per_file).text(path)


def _parsed(spark: SparkSession, path: str, parse: Callable, schema: str) -> DataFrame:
    """``parse`` over the bytes of each file of a corpus."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for data in batch["content"]:
                yield from parse(data)

    small_batches(spark, rows=1)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInPandas(each, schema)


def part_starts(spark: SparkSession, path: str) -> DataFrame:
    """(part, before): numbers in all parts before. A part is what one task wrote, so there are no more than tasks."""

    def heads(data: bytes) -> Iterator[pd.DataFrame]:
        found = [(s.part, s.before + s.length) for s in segments(data)]
        yield pd.DataFrame(found, columns=["part", "upto"])

    totals = kept(_parsed(spark, path, heads, "part int, upto long").groupBy("part").agg(F.max("upto").alias("n")))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))


def read_tokens(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """(doc_id, start, ids) of each document in the files: the numbers of all documents before it, and its own as u4 bytes."""

    def documents(data: bytes) -> Iterator[pd.DataFrame]:
        for s in segments(data):
            numbers = s.numbers().astype("<u4")
            starts = np.cumsum([0, *s.lengths])
            runs = [numbers[a:b].tobytes() for a, b in zip(starts, starts[1:], strict=False)]
            yield pd.DataFrame({"part": s.part, "id": s.names, "place": s.before + starts[:-1], "ids": runs})

    found = _parsed(spark, path, documents, "part int, id string, place long, ids binary")
    placed = found.join(F.broadcast(part_starts(spark, path)), "part")
    return placed.select(F.col("id").cast(id_type).alias("doc_id"), (F.col("before") + F.col("place")).alias("start"), "ids")


def token_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, **settings: object) -> DataFrame:
    """(id, start, n_tokens, ids_crc32) per document, from files written by :func:`write_tokens` and read back."""
    spark = docs.sparkSession
    place = path or shared_folder(spark, "tokens")
    write_tokens(docs, place, id_col, text_col, **settings)
    found = read_tokens(spark, place, docs.schema[id_col].dataType.simpleString())
    return found.select("doc_id", "start", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
