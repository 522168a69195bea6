"""Encoding against the format's own library, with chunk sizes that leave borders open."""

import random

import numpy as np
import pytest
import sentencepiece

from eventide.llm import pieces
from tests.llm.conftest import TEXTS

ALPHABETS = ["abcdefghijklmnopqrstuvwxyz", "the in an er ation", " \n\t", "aaaaaaaaaaaaaab", "éàñ日本語中文字🙂", "   x", "0123456789abcdef", "ABCabc./:-_▁"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)


@pytest.fixture(scope="module")
def encoder():
    return pieces.Encoder(pieces.vocabulary())


def test_chunks_give_the_librarys_numbers(library, encoder):
    rng, opened = random.Random(1), 0
    for _ in range(250):
        letters = rng.choice(ALPHABETS)
        text = "".join(rng.choice(letters) for _ in range(rng.randint(1, 400)))
        want = library.encode(text)
        assert encoder.encode(pieces.escape(text)) == want
        parts = list(pieces.chunks(pieces.escape(text), encoder, rng.choice([40, 64, 100])))
        states = pieces.border_states([c.matrix(encoder) for c in parts])
        found = [c.encode(encoder, a, b) for c, (a, b) in zip(parts, states, strict=True)]
        assert [i for ids, _ in found for i in ids] == want and all(ok for _, ok in found)
        opened += sum(c.open_right for c in parts)
    assert opened > 100


def test_scan_equals_products_in_turn():
    rng = np.random.default_rng(4)
    for n in range(1, 12):
        sizes = [1, *rng.integers(1, 5, n - 1), 1]
        mats = [np.where(rng.random((a, b)) < 0.3, -np.inf, rng.normal(size=(a, b))) for a, b in zip(sizes, sizes[1:], strict=False)]
        mats = [np.where(np.isneginf(m).all(), 0.0, m) for m in mats]
        turn, want = mats[0], [mats[0]]
        for m in mats[1:]:
            turn = pieces.product(turn, m)
            want.append(turn)
        assert all(np.allclose(a, b) for a, b in zip(pieces.scan(mats), want, strict=True))


@pytest.mark.parametrize("chunk", [64, 16384])
def test_rows(spark, odd, library, chunk):
    rows = pieces.encode(odd, chunk=chunk).collect()
    want = sorted((str(i), library.encode(t or "")) for i, t in TEXTS)
    assert sorted((str(r.doc_id), list(r.ids)) for r in rows) == want
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in rows)
    assert max(r.n_chunks for r in rows) > 1


def test_decode(spark, odd, nothing):
    encoded = pieces.encode(odd, chunk=1000)
    texts = [r.t for r in encoded.select(pieces.decode(spark)("ids").alias("t")).collect()]
    assert sorted(texts) == sorted((t or "") for _, t in TEXTS)
    assert pieces.encode(nothing).count() == 0
