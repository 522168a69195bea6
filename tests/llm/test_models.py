"""The trained operators: language, language model, toxicity; each against plain code or held-out rows."""

import math
import random
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from eventide.llm import language, ppm, toxicity
from eventide.llm.common import table
from tests.llm.conftest import TEXTS

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def test_language_of_held_out_rows(spark):
    docs = table(spark, MIDDLE, "documents")
    truth = {r.doc_id: r.lang for r in docs.collect()}
    rows = language.identify(docs).collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(truth) and len(held) > 150
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)


def test_language_of_odd_rows(odd, nothing):
    rows = language.identify(odd).collect()
    got = {(r.doc_id, r.lang_pred) for r in rows}
    assert len(rows) == len(TEXTS) and {(3, "und"), (4, "und"), (5, "und"), (None, "und"), (1, "en"), (6, "en"), (9, "und"), (9, "en")} <= got
    assert all(r.score == 0 and r.rejected for r in rows if r.lang_pred == "und")
    assert language.identify(nothing).count() == 0


def test_unlike_texts_are_rejected(spark):
    known = table(spark, SMALL, "documents").select("doc_id", "text", "lang")
    strange = spark.createDataFrame([(-1, "ζηθικλ μνξοπρ στυφχ ψω " * 20, None)], known.schema)
    got = {r.doc_id: r.rejected for r in language.identify(known.unionByName(strange)).collect()}
    assert got[-1] and sum(got.values()) < 0.1 * len(got)


def plain_ppm(train, texts, most):
    """Probabilities by plain dictionaries: the trie, escapes and exclusion as ``code_lengths`` describes them."""
    counts = [Counter() for _ in range(ppm.ORDER + 1)]
    coded = lambda t: ppm.START + ppm.coded(t)
    for t in train:
        data = coded(t)
        for i in range(ppm.ORDER, len(data)):
            for k in range(ppm.ORDER + 1):
                counts[k][(data[i - k : i], data[i])] += 1
    symbols = sum(counts[0].values())
    follow, total = [defaultdict(dict) for _ in counts], [Counter() for _ in counts]
    for k, c in enumerate(counts):
        for (context, s), n in c.items():
            total[k][context] += n
            if n * most >= symbols:
                follow[k][context][s] = n
    out = []
    for t in texts:
        data, log = coded(t), 0.0
        for i in range(ppm.ORDER, len(data)):
            excluded = set()
            for k in range(ppm.ORDER, -1, -1):
                context = data[i - k : i]
                if context not in follow[k]:
                    continue
                have = {s: n for s, n in follow[k][context].items() if s not in excluded}
                whole = total[k][context] - sum(counts[k][(context, s)] for s in excluded)
                if data[i] in have:
                    log += math.log10((have[data[i]] - 0.5) / whole)
                    break
                if whole:
                    log += math.log10(1 - sum(n - 0.5 for n in have.values()) / whole)
                excluded = set(follow[k][context])
            else:
                log -= math.log10(256 - len(excluded))
        out.append(log)
    return out


@pytest.mark.parametrize("most", [1 << 20, 400])
def test_trie_scores_equal_plain_ppm(spark, most):
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("abcdé", k=rng.randint(1, 4)))
    train = [" ".join(word() for _ in range(60)) for _ in range(20)] + ["", "Zz  q\n"]
    texts = train[:3] + ["abc  DE\tzz", "日本 xyz", "", "qqqq"]
    levels = ppm.train(spark.createDataFrame([(t,) for t in train], "text string"), most)
    got = np.zeros(len(texts))
    for key, of in ppm.slices(texts, 64):
        got += np.bincount(of, ppm.code_lengths(key, levels), len(texts))
    assert np.allclose(got, plain_ppm(train, texts, most))


def test_trie_probabilities_add_up_to_one(spark):
    levels = ppm.train(spark.createDataFrame([("abracadabra",), ("banana abba",)], "text string"))
    for context in (b"\xfe\xfe\xfe\xfe\xfe", b"abrac", b" zzan", b"zzzzz"):
        key = int.from_bytes(context, "big")
        p = 10 ** ppm.code_lengths(np.array([key << 8 | s for s in range(256)]), levels)
        assert abs(p.sum() - 1) < 1e-9


@pytest.mark.parametrize("settings", [{}, {"frequent": 20, "near": 20}])
def test_scores_know_every_pair_of_a_large_corpus(spark, settings):
    rng = random.Random(7)
    word = lambda: "".join(rng.choices("abcdé", k=rng.randint(1, 4)))
    rows = [(0, "ab cd " * 180_000)] + [(i, " ".join(word() for _ in range(40))) for i in range(1, 40)] + [(40, "zq zq"), (41, "日本 xyz"), (42, None)]
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 1]
    train = [t for i, t in rows if i not in held]
    assert 0 not in held and held and sum(len(ppm.coded(t)) for t in train) > 1 << 20
    want = dict(zip([i for i, _ in rows], plain_ppm(train, [t for _, t in rows], 1 << 40), strict=True))
    got = ppm.scores(spark.createDataFrame(rows, "doc_id long, text string"), **settings).collect()
    assert len(got) == len(rows)
    for r in got:
        assert abs(r.score - want[r.doc_id]) < 1e-6 * abs(want[r.doc_id]) + 1e-6


@pytest.mark.parametrize("frequent", [1 << 20, 50])
def test_base_scores(odd, nothing, frequent):
    rows = ppm.scores(odd, frequent=frequent).collect()
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 1 if i is not None else False
    tokens = lambda t: [w.lower() for w in (t or "").encode().split()] + [None]
    counts = Counter(w for i, t in TEXTS if not held(i) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    want = []
    for i, t in TEXTS:
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens(t))
        want.append((str(i), held(i), len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), n, round(base, 3)))
    got = [(str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 3)) for r in rows]
    assert sorted(got) == sorted(want)
    assert all(r.score <= 0 for r in rows) and ppm.scores(nothing).count() == 0


def plain_kernel(a, b):
    def weights(w):
        w, out = "\x02" + w + "\x03", Counter()
        for i in range(len(w)):
            for j in range(i + 1, len(w)):
                for k in range(j + 1, len(w)):
                    if k - i <= toxicity.REACH:
                        out[w[i] + w[j] + w[k]] += toxicity.DECAY ** (k - i + 1)
        return out

    x, y = weights(a), weights(b)
    norm = lambda c: math.sqrt(sum(v * v for v in c.values()))
    return (sum(v * y[s] for s, v in x.items()) / (norm(x) * norm(y))) ** toxicity.POWER


def test_kernel_equals_plain_subsequences():
    words, marks = ["idiot", "idxiot", "idio", "patient", "a", "éàñ", "banananana"], ["idiot", "banana", "xé"]
    got = toxicity.kernel(words, toxicity.landmarks(marks))
    assert np.allclose(got, [[plain_kernel(w, m) for m in marks] for w in words])
    assert got[1, 0] > 0.1 > got[3, 0]


def test_kernel_of_many_words_needs_little_memory():
    rng = random.Random(3)
    words = ["".join(rng.choices("aeiourstnl", k=9)) for _ in range(20_000)]
    marks = toxicity.landmarks(words[:128])
    tracemalloc.start()
    got = toxicity.kernel(words, marks)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150 << 20 and np.allclose(got[:50], toxicity.kernel(words[:50], marks)) and np.allclose(got[-1], toxicity.kernel(words[-1:], marks)[0])


def test_units():
    assert toxicity.pieces("i.d*i-o.t!") == ["i.d*i-o.t", "idiot"]
    found, many = toxicity.units("You  i d i o t, OK OK!")
    assert found == {"you", "idiot", "ok", *"idt", "o"} and many == 8  # ok and ok! are two
    for text in ("a i d", "x é y z", "a_b_c", "i _d i", "a b", "1 2  3", "(i) (d) (i)", "a    b c", "is a b", ""):
        want = {toxicity.MARKS.sub("", m) for m in toxicity.SPACED.findall(text)}
        assert toxicity.units(text)[0] == {w.strip(toxicity.PUNCTUATION) for w in text.split()} | want, text
    assert toxicity.pieces("...") == [] and toxicity.pieces("(word)") == ["word"]
    assert "".join(p[: toxicity.LONGEST // 2] for p in toxicity.pieces("x" * 100)) and all(len(p) <= 24 for p in toxicity.pieces("x" * 100))


def test_scores_equal_plain_ones():
    marks = ["idiot", "stupid", "banana", "patient"]
    model = toxicity.Model(toxicity.landmarks(marks), np.array([2.0, 1.5, -1.0, 0.5]), -0.7, np.array([1.5, 0.5, 0.2, 0.1, -0.3, -0.4]))
    texts = [None, "", "...", "You idiot, you IDIOT!", "stup-id s t u p i d banana", "patient " * 50 + "idxiot", "one two three four five stupid", "é" * 60]

    def plain(text):
        low = (text or "").lower()
        spaced = [toxicity.MARKS.sub("", m) for m in toxicity.SPACED.findall(low)]
        written = {*low.split(), *spaced}
        decisions = []
        for word in {w.strip(toxicity.PUNCTUATION) for w in written}:
            kernels = [[plain_kernel(p, m) for m in marks] for p in toxicity.pieces(word)]
            decisions.append(max([model.bias, *(float(np.dot(k, model.vector)) + model.bias for k in kernels)]))
        top = (sorted(decisions, reverse=True) + [model.bias] * toxicity.HIGHEST)[: toxicity.HIGHEST]
        return 1 / (1 + math.exp(-np.dot([*top, math.log1p(len(written)), 1], model.weights)))

    judge = toxicity.Judge(model)
    for part in (texts, texts[::-1], texts[3:4], []):
        assert np.allclose(model.probability(judge.shown(part)), [plain(t) for t in part])


def test_contradicting_labels_count_as_toxic(spark):
    docs = spark.createDataFrame([(i, "you utter moron" if i % 2 else f"a calm word{i} here") for i in range(60)], "doc_id long, text string")
    labels = [(i, i % 2) for i in range(60)]
    one = toxicity.judged(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    both = toxicity.judged(docs, spark.createDataFrame(labels + [(i, 0) for i in range(1, 60, 2)], "doc_id long, toxic int")).collect()
    assert sorted((r.doc_id, r.predicted) for r in one) == sorted((r.doc_id, r.predicted) for r in both)
    assert all(r.predicted == r.doc_id % 2 for r in one)


def test_toxic_rows_held_out(spark):
    docs, labels = table(spark, MIDDLE, "documents"), table(spark, MIDDLE, "labels")
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    rows = toxicity.judged(docs, labels).collect()
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    hits = sum(r.predicted for r in held if truth[r.doc_id] == 1)
    assert hits >= 0.7 * sum(truth[r.doc_id] for r in held)
    assert sum(r.predicted for r in held if truth[r.doc_id] == 0) <= 0.03 * len(held)
    assert all(r.predicted == (r.score >= 0.7) for r in rows) and len(rows) == docs.count()


def test_toxicity_of_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(i, 0, i % 2) for i in range(12)] + [(None, None, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    assert toxicity.judged(odd, labels).count() == len(TEXTS)
    assert {r.score for r in toxicity.judged(odd, labels.limit(0)).collect()} == {0.0}
    assert toxicity.judged(nothing, labels).count() == 0
    assert toxicity.clean(odd, labels.limit(0)).columns == odd.columns
