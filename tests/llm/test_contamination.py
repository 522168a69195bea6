"""Phrase matches against a plain search."""

import hashlib
import random
import re

import pytest

from eventide.llm import contamination
from tests.llm.conftest import TEXTS

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall((text or "").encode().lower())


def plain(text, items, width=13):
    words, hit, found = words_of(text), set(), set()
    for name, item in items:
        terms = words_of(item)
        size = min(width, len(terms))
        for w in range(len(terms) - size + 1 if size else 0):
            for at in range(len(words) - size + 1):
                if words[at : at + size] == terms[w : w + size]:
                    hit.update(range(at, at + size))
                    found.add("" if name is None else str(name))
    names = ",".join(sorted(found))
    return len(words), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(words)


def sample(spark):
    rng = random.Random(11)
    vocabulary = ["the", "of", "a", "in"] + [f"w{i}" for i in range(60)] + ["été", "日本"]
    item = lambda n: " ".join(rng.choices(vocabulary, k=n))
    items = [(i, item(rng.choice([1, 5, 13, 14, 30]))) for i in range(12)] + [(3, item(20)), (None, item(15)), (90, None), (91, ""), (92, "...")]
    docs = [(1000 + i, item(200)) for i in range(10)]
    for i in range(30):
        source = items[rng.randrange(13)][1].split()
        cut = source[rng.randrange(3) :] if len(source) > 16 else source
        docs.append((i, f"{item(rng.randrange(60))}, {'; '.join(cut).upper()} ... {item(rng.randrange(400))}"))
    return docs + TEXTS, items


@pytest.mark.parametrize("block_words", [1_000_000, 20])
def test_contamination_equals_plain_search(spark, block_words):
    docs, items = sample(spark)
    left = spark.createDataFrame(docs, "doc_id long, text string")
    right = spark.createDataFrame(items, "item_id long, text string")
    if block_words == 20:
        m = left.select("doc_id", "text", contamination.matches(left, right, block_words=block_words).alias("m"))
        got = [(r.doc_id, r.text, r.m.n_words, r.n, sorted(r.m["items"])) for r in m.withColumn("n", contamination.hit_words(m["m.spans"])).collect()]
        want = [(i, t, *plain(t, items)[:2]) for i, t in docs]
        assert sorted(map(repr, [g[:4] for g in got])) == sorted(map(repr, want))
        return
    got = [tuple(r)[:6] for r in contamination.contamination(left, right).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, [(i, *plain(t, items)) for i, t in docs]))


def test_near_matches_tolerate_shifts(spark):
    item = " ".join(f"t{i}" for i in range(13))
    moved = item.replace("t5", "extra t5").replace("t9 ", "")
    docs = spark.createDataFrame([(1, item), (2, item.replace("t5 t6", "t6 t5")), (3, "t0 t1 t2"), (4, moved)], "doc_id long, text string")
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    got = {r.doc_id: (r.n_items, r.n_near) for r in contamination.contamination(docs, bench).collect()}
    assert got == {1: (1, 1), 2: (0, 1), 3: (0, 0), 4: (0, 0)}


def test_long_text_slices():
    terms = {b"a": 0, b"bb": 1}
    text = "a bb  c," * 3000
    whole = contamination.term_numbers(text, terms)
    assert list(contamination.term_numbers(text, terms, size=11)) == list(whole)


def test_rows_and_empty_tables(spark, odd, nothing):
    bench = spark.createDataFrame([(1, "one two three four five")], "item_id long, text string")
    kept = contamination.decontaminate(odd, bench)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} == {3, 4, 5, None, 6, 7, 8, 9}
    assert contamination.decontaminate(odd, bench.limit(0)).count() == odd.count()
    assert contamination.contamination(nothing, bench).count() == 0
