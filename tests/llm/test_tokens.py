"""Token files against the tokenizers library, whole and by spans."""

import struct
import tracemalloc
import zlib
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from eventide.llm import tokens
from eventide.llm.common import table
from tests.llm.conftest import TEXTS

LIBRARY = Tokenizer.from_file(tokens.VOCABULARY)
with open(tokens.VOCABULARY, encoding="utf-8") as file:
    DEFINITION = file.read()
ENCODER = tokens.Pieces(DEFINITION, 2)


def plain(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids + [2]


def numbers(run):
    return np.frombuffer(run, "<u4").tolist()


WORDS = st.lists(st.sampled_from(["word", "a", "Ünï", "it's", "'s", "x.\ny", "9", "", "́e", " ", "\n", "\x85", "\x1c", "日本", "<|endoftext|>", "🙂", "."]), max_size=12)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=30), WORDS.map(" ".join)), max_size=5))
def test_pieces_are_what_the_library_gives(texts):
    assert [numbers(r) for r in ENCODER.encode(pa.array(texts, pa.string()))] == [plain(t) for t in texts]


def test_a_full_table_starts_anew():
    small, texts = tokens.Pieces(DEFINITION, 2, most=3), [f"one two{i} three{i % 3} four{i}." for i in range(20)]
    for t in texts:
        assert numbers(small.encode(pa.array([t]))[0]) == plain(t)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 30), st.integers(0, 2**32 - 1), st.just(0)), max_size=700), st.sampled_from([50.0, 90.0, 98.0, 100.0]))
def test_blocks_round_trip(values, percentile):
    run = np.array(values, "<u4").tobytes()
    half = len(values) // 2
    data = tokens.write_segment(3, 1, 9, ["a", None, "", "ä"], [run[: 4 * half], b"", run[4 * half :], b""], percentile)
    s = tokens.Segment(data)
    assert (s.part, s.number, s.before, s.length, s.names, s.lengths) == (3, 1, 9, len(values), ["a", None, "", "ä"], [half, 0, len(values) - half, 0])
    assert s.numbers().tolist() == values
    for first in range(0, len(values), 97):
        assert s.span(first, 300).tolist() == values[first : first + 300]


def test_outliers_are_listed_not_packed():
    values = np.arange(1000, 1256)
    values[[3, 200]] = [70_000, 4_000_000_000]
    body = tokens.pack(values, 98.0)[0]
    low, width, outlying, more = struct.unpack_from(tokens.BLOCK_HEAD, body)
    assert (low, width, outlying, more) == (1000, 8, 2, 255) and len(body) == 7 + 256 + 2 * 5
    assert tokens.unpack(body, np.array([0])).tolist() == values.tolist()


def wanted(rows):
    """Starts in ascending order of ids, nulls first, for rows whose ids are unique."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    runs = [plain(t) for _, t in rows]
    starts = accumulate([0, *map(len, runs)])
    return [(i, start, len(r), zlib.crc32(np.array(r, "<u4").tobytes())) for (i, _), r, start in zip(rows, runs, starts, strict=False)]


def found(df):
    assert df.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[1])


def test_whole_table(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(tokens.token_spans(docs.repartition(5))) == wanted(rows)
    assert found(tokens.token_spans(docs, segment=1000, per_file=2, stretch=50_000)) == wanted(rows)  # many parts, files and segments


def test_odd_rows(odd, nothing):
    got = found(tokens.token_spans(odd, segment=10))
    assert [r[0] for r in got] == sorted((i for i, _ in TEXTS), key=lambda i: (i is not None, i or 0))
    assert [r[1] for r in got] == list(accumulate([0, *(r[2] for r in got)]))[:-1]  # no gap
    assert sorted((r[0] or 0, *r[2:]) for r in got) == sorted((i or 0, len(plain(t)), zlib.crc32(np.array(plain(t), "<u4").tobytes())) for i, t in TEXTS)
    assert found(tokens.token_spans(nothing)) == []


def test_ids_of_one_value_stand_by_their_texts(spark):
    rows = [(1, f"text {i % 7}") for i in range(300)] + [(2, "x")]
    one, other = (found(tokens.token_spans(spark.createDataFrame(rows, "doc_id long, text string").repartition(n), stretch=500)) for n in (2, 9))
    assert one == other and len(one) == 301


def test_text_ids_and_no_whole_segment(spark):
    rows = [("b", "two words"), ("a", None), (None, "x")]
    assert found(tokens.token_spans(spark.createDataFrame(rows, "doc_id string, text string")))[1][:3] == ("a", 2, 1)
    with pytest.raises(ValueError, match="no whole segment"):
        tokens.Segment(tokens.write_segment(0, 0, 0, ["a"], [b"\0\0\0\0"])[:-1])


def test_words_go_to_the_model_directly():
    """Words and the marks after them as the library encodes them in a whole text, without its text pipeline for each."""
    words = ["word", "Müller", "naïve", "ǆɏÿ", "straße", "a", "it", "ªb", "Ωmega", "日本", "x1", "don't", "a_b"]
    signs = ["", ".", ",", "'", "'s", "\")", "...", "!?", "_", "<|", "\u00a0", "\u2019"]
    text = "start " + " ".join(w + s for w in words for s in signs) + " <|endoftext|> end<|endoftext|>"
    whole = ENCODER.encoder.encode(text, add_special_tokens=False).ids
    fresh, asked = tokens.Pieces(DEFINITION, 2), []
    library = fresh.encoder

    class Counted:
        model = library.model

        def encode(self, text, **settings):
            return library.encode(text, **settings)

        def encode_batch_fast(self, texts, **settings):
            asked.extend(texts)
            return library.encode_batch_fast(texts, **settings)

    fresh.encoder = Counted()
    for _ in range(2):
        assert np.frombuffer(fresh.encode(pa.array([text, None, "one word"]))[0], "<u4").tolist() == whole + [2]
    assert fresh.direct and "Müller." not in " ".join(asked).split(" ") and "x1." in " ".join(asked).split(" ")


@pytest.mark.parametrize("different", [1000, 300_000])
def test_memory_goes_to_a_batch_s_different_pieces_and_their_numbers(different):
    """Neither a batch's pieces times several arrays, nor Python objects for all that is new in it."""
    words = ["".join(chr(97 + n // 26**k % 26) for k in range(4)) for n in range(different)]
    batch = pa.array([" ".join(words[i * 1000 % different :][:1000]) for i in range(300)])
    fresh = tokens.Pieces(DEFINITION, 2)
    tracemalloc.start()
    out = fresh.encode(batch)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert numbers(out[-1]) == plain(batch[-1].as_py()) and len(out) == 300
    assert most < sum(map(len, out)) + 140 * different + (8 << 20)
    assert numbers(fresh.encode(batch)[0]) == plain(batch[0].as_py())
