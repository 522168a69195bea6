"""Near-copies by shingle sets against brute-force Jaccard."""

import random

import numpy as np

import corpus_pipeline
from eventide.llm import jaccard
from eventide.llm.common import table
from tests.llm.conftest import TEXTS


def plain_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def plain_kept(rows):
    """Smallest id of each group of (id, text) rows linked at Jaccard 0.8 or more, all pairs compared."""
    sets, root = [plain_set(t) for _, t in rows], list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 5 * len(a & b) >= 4 * len(a | b):
                root[find(i)] = find(j)
    groups = {}
    for i, (name, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(name)
    return sorted(min((x for x in g if x is not None), default=-1) for g in groups.values())


def test_stage_keeps_what_brute_force_keeps(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = plain_kept(rows)
    assert sorted(r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()) == want
    assert not {145, 177} & set(want)  # near copies of 6 and 1, 7 and 11 bits apart by SimHash


def test_edited_copies_and_the_limit(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    rows, line = [], [word() for _ in range(30)]
    for _ in range(12):
        base = [word() for _ in range(rng.choice([5, 20, 60, 130]))] + line * rng.randint(0, 1)
        for _ in range(10):
            text = list(base)
            for _ in range(rng.randint(0, 4)):
                text[rng.randrange(len(text))] = word()
            rows.append((len(rows), " ".join(text)))
    a = [str(i) for i in range(13)]  # nine shingles: with one more 9 of 10, cut to eight of ten at the limit
    rows += [(500, " ".join(a[:12])), (501, " ".join([*a, "x"])), (502, " ".join(["y", *a[:11]]))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert sorted(r.doc_id for r in jaccard.deduplicate(df).collect()) == plain_kept(rows)


def test_odd_rows(odd, nothing):
    found = jaccard.deduplicate(odd)
    assert found.columns == odd.columns and sorted(-1 if r.doc_id is None else r.doc_id for r in found.collect()) == plain_kept(TEXTS)
    assert jaccard.deduplicate(nothing).count() == 0


def test_long_first_word_is_no_shingle():
    text = "x" * (1 << 20) + " two three four five six"
    assert len(jaccard.shingle_set(text.encode())) == len(plain_set(text)) == 2


def test_long_sets_about_the_limit(spark):
    rng = random.Random(9)
    base, rows = [f"w{rng.randrange(10**6)}" for _ in range(5000)], []
    for n, edits in enumerate([0, 40, 90, 105, 112, 118, 130, 200, 600]):  # an edit changes five shingles
        text = list(base)
        for at in rng.sample(range(0, 5000, 6), edits):
            text[at] = f"x{rng.randrange(10**6)}"
        rows.append((n, " ".join(text[: 5000 - 100 * (n % 3)])))
    assert sorted(r.doc_id for r in jaccard.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()) == plain_kept(rows)


def test_sketches_never_differ_in_more_bits_than_the_sets_in_tokens():
    rng = np.random.default_rng(4)
    for n in (1, 60, 1000, 1025, 2048, 2049, 9000):
        a = np.unique(rng.integers(-(2**63), 2**63 - 1, n))
        b = np.unique(np.concatenate([a[n // 20 :], rng.integers(-(2**63), 2**63 - 1, n // 9)]))
        x, y = sorted((jaccard.sketch_of(a), jaccard.sketch_of(b)), key=len)
        y = y[: len(x)] ^ y[len(x) :] if len(y) > len(x) else y
        assert int(np.bitwise_count((x ^ y).view("<u8")).sum()) <= len(set(a.tolist()) ^ set(b.tolist()))


def test_a_large_group_of_edited_copies_is_joined_without_all_its_pairs(spark, monkeypatch):
    """Copies with three edits are alike to the text they come from (131 of 161 shingles), not to each other; with five to none."""
    rng = random.Random(5)
    base = [f"w{rng.randrange(10**6)}" for _ in range(150)]
    rows = [(0, " ".join(base))]
    for n in range(1, 241):
        text = list(base)
        for at in rng.sample(range(6, 144, 6), 3 if n % 6 else 5):
            text[at] = f"x{rng.randrange(10**6)}"
        rows.append((n, " ".join(text)))
    compared, plain_likely = [], jaccard.likely

    def likely(pairs, nodes):
        compared.append(pairs.distinct().count())
        return plain_likely(pairs, nodes)

    monkeypatch.setattr(jaccard, "likely", likely)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted(r.doc_id for r in jaccard.deduplicate(df).collect()) == plain_kept(rows)
    assert len(plain_kept(rows)) == 41 and compared[-1] <= len(rows) and sum(compared) <= 20 * len(rows)
