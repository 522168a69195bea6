"""Exact dedup and SimHash against plain versions."""

import random
import re
from collections import Counter

import xxhash

from eventide.llm import exact, simhash
from tests.llm.conftest import TEXTS


def plain_groups(rows):
    groups = {}
    for i, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), []).append(i)
    out = []
    for i, text in rows:
        ids = groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")]
        out.append((i, min((x for x in ids if x is not None), default=None), len(ids)))
    return out


def test_exact_groups(odd):
    got = [(r.doc_id, r.keep_id, r.group_size) for r in exact.content_sort(odd).collect()]
    assert Counter(got) == Counter(plain_groups(TEXTS))


def test_exact_keeps_one_of_each_group(odd):
    rows = exact.content_sort(odd).collect()
    assert Counter(r.text_sha256 for r in rows if r.kept) == Counter({r.text_sha256 for r in rows})
    assert all(r.doc_id == r.keep_id for r in rows if r.kept)


def test_exact_hot_group_is_cut_and_joined(spark):
    rows = [(i, "same  text" if i % 3 else f"text {i % 40}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = Counter((r.doc_id, r.keep_id, r.group_size) for r in exact.content_sort(df).collect())
    assert got == Counter(plain_groups(rows))
    assert sorted(r.doc_id for r in exact.deduplicate(df).collect()) == sorted({k for _, k, _ in plain_groups(rows)})


def test_exact_rows_keep_their_columns(odd, nothing):
    assert exact.deduplicate(odd).columns == odd.columns
    assert exact.content_sort(nothing).count() == 0
    assert exact.deduplicate(nothing).count() == 0


def test_exact_uses_no_python(odd):
    plan = exact.content_sort(odd)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def plain_simhash(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    words = [bytes(c + 32 if 65 <= c <= 90 else c for c in w) for w in words]
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    ones = Counter(b for s in shingles for b in range(64) if xxhash.xxh64_intdigest(s, 42) >> b & 1)
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def test_simhash_of_words_longer_than_a_block():
    long = "x" * (1 << 20)
    for text in (f"{long} two three four five", f"one {long}y three", f"{long} {long}z", f"one {long} two {long} three", long, f"{long} ", " " * (1 << 20) + " a b"):
        assert simhash.simhash(text.encode()) % (1 << 64) == plain_simhash(text), text[:4]


def plain_components(prints):
    """{row: smallest id reachable} of (id, fingerprint) rows linked at two or fewer bits."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= 2:
                root[find(i)] = find(j)
    best = {}
    for i, (name, _) in enumerate(prints):
        if name is not None:
            best[find(i)] = min(best.get(find(i), name), name)
    return Counter((name, f"{fp:016x}", best.get(find(i))) for i, (name, fp) in enumerate(prints))


def test_simhash_fingerprints_and_components(odd):
    got = Counter((r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_groups(odd).collect())
    assert got == plain_components([(i, plain_simhash(t)) for i, t in TEXTS])


def test_simhash_blocks_of_long_texts():
    data = " ".join(random.Random(3).choices(["alpha", "beta", "gamma", "delta"], k=5000))
    whole = simhash.simhash(data.encode())
    assert whole & (2**64 - 1) == plain_simhash(data)


def test_word_blocks_lose_and_repeat_nothing():
    from eventide.llm.common import word_blocks

    data = b" ".join(b"w%d" % i for i in range(500)) + b"\n\n"
    for size in (1, 7, 64, 10_000):
        shingles = [s for words in word_blocks(data, size, 2) for s in zip(words, words[1:], words[2:], strict=False)]
        words = data.split()
        assert shingles == list(zip(words, words[1:], words[2:], strict=False))


def test_near_links_find_all_pairs(spark):
    rng = random.Random(5)
    seeds = [rng.getrandbits(64) for _ in range(60)]
    prints = set(seeds)
    for s in seeds:
        for _ in range(6):
            x = s
            for _ in range(rng.randint(1, 3)):
                x ^= 1 << rng.randrange(64)
            prints.add(x)
    signed = {p - (1 << 64) if p >> 63 else p for p in prints}
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    got = {tuple(sorted((r.a, r.b))) for r in simhash.near_links(df).collect()}
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 2}
    assert got == want


def test_simhash_chain_is_one_component(spark):
    from eventide.llm.common import components

    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(1000, 1001), (1001, 1000), (7, 7)], "a long, b long")
    got = {(r.node, r.root) for r in components(links).collect()}
    assert got == {(i, 0) for i in range(201)} | {(1000, 1000), (1001, 1000)}
    assert components(links.limit(0)).count() == 0


def test_near_dedup_keeps_one_row_per_component(odd, nothing):
    kept = simhash.deduplicate(odd)
    assert kept.columns == odd.columns
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    names = {c for _, _, c in plain_components([(i, plain_simhash(t)) for i, t in TEXTS])}
    assert {i for i, _ in rows} == names
    assert sorted(i for i, _ in rows) == [1, 3, 6, 7, 8, 9, 9]  # the texts of the repeated id are in two components
    assert simhash.deduplicate(nothing).count() == 0 and simhash.near_groups(nothing).count() == 0
