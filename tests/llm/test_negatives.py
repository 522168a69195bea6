"""Hard negatives against brute force, and intervals that must hold the true product."""

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from eventide.llm import negatives

SCHEMA = "vec_id long, label int, embedding array<float>, score string, id string, rank string, anchor string"


def vector(rng, size=64):
    v = [rng.gauss(0, 1) for _ in range(size)]
    n = math.sqrt(sum(x * x for x in v))
    return [float(np.float32(x / n)) for x in v]


def plain(rows):
    """All pairs scored, in plain integers."""
    rows = [(i, l, v) for i, l, v in rows if i is not None and l is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    rows = [(i, (l + 1) % 10 if i % 7 == 0 else l, [math.floor(256 * x) for x in v]) for i, l, v in rows]
    out = []
    for i, l, v in rows:
        if i % 50:
            continue
        met = [(-sum(a * b for a, b in zip(v, w, strict=True)), j, m) for j, m, w in rows if j != i and len(w) == len(v)]
        for s, p, _ in sorted(x for x in met if x[2] == l)[:5]:
            found = sorted((t, j) for t, j, m in met if m != l and 50 * -s <= 100 * -t <= 95 * -s)[:3]
            out += [(i, p, n, j, -s, -t) for n, (t, j) in enumerate(found, 1)]
    return sorted(out)


def got(df):
    assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in df.collect())


def frame(spark, rows, parts=4):
    return spark.createDataFrame([(*r, "x", "y", None, "z") for r in rows], SCHEMA).repartition(parts)


@settings(max_examples=80, deadline=None)
@given(st.integers(1, 150), st.integers(0, 2**32), st.sampled_from([1, 40, 10**6]), st.integers(1, 5))
def test_intervals_hold_the_product(size, seed, spread, levels):
    rng = np.random.default_rng(seed)
    a, b = (np.floor(rng.normal(size=(n, size)) * spread).astype(np.int64) for n in (5, 7))
    a[0], b[0], b[1] = 0, 0, 3
    low, high = negatives.intervals(negatives.prepare(a), negatives.encode(b, levels))
    assert (low <= a @ b.T).all() and (a @ b.T <= high).all()


def test_deeper_codes_leave_less_to_score():
    rng = random.Random(8)
    values = np.floor(256 * np.array([vector(rng) for _ in range(400)])).astype(np.int64)
    wide = [float(np.subtract(*negatives.intervals(negatives.prepare(values[:20]), negatives.encode(values, n))[::-1]).mean()) for n in (1, 2, 4)]
    assert wide[2] < wide[1] / 1.5 < wide[0] / 2.25


@pytest.mark.parametrize("block", [16384, 3])
def test_against_all_pairs(spark, block):
    rng = random.Random(3)
    centres = [vector(rng) for _ in range(6)]
    rows = []
    for i in range(900):
        c = rng.choice(centres)
        rows.append((i, rng.randrange(10), [float(np.float32(x + rng.gauss(0, 0.1))) for x in c]))
    hot = vector(rng)
    rows += [(2000 + i, i % 3, hot) for i in range(450)]  # a third of all rows is one vector, ties go by id
    assert got(negatives.mine(frame(spark, rows), block=block)) == plain(rows)


def test_odd_rows(spark):
    rng = random.Random(5)
    good, zero = vector(rng), [0.0] * 64
    rows = [(i, i % 2, vector(rng)) for i in range(120)]
    rows += [(0, 1, good), (50, 0, good), (50, 0, good), (350, None, good), (400, 1, None), (450, 1, []), (None, 1, good), (500, 1, [None, *good[1:]])]
    rows += [(550, 1, [math.nan, *good[1:]]), (600, 1, [math.inf, *good[1:]]), (650, 1, zero), (651, 0, zero), (652, 1, zero), (700, 1, good[:40]), (701, 1, good[:40])]
    rows += [(702, 0, [x * 0.8 for x in good[:40]]), (750, 3, good), (5, 1, rows[5][2]), (5, 0, rows[5][2]), (800, 9, [-x for x in good]), (-50, 0, good)]
    rows += [(900, 7, [50.0 * x for x in good])]
    wanted = plain(rows)
    assert got(negatives.mine(frame(spark, rows))) == wanted and {0, 50, 650, -50} <= {r[0] for r in wanted}
    assert got(negatives.mine(frame(spark, rows, 1).limit(0))) == []
    assert got(negatives.mine(frame(spark, [(1, 1, good), (2, 0, good)]))) == []  # no anchor
    assert got(negatives.mine(frame(spark, [(50, 1, [1e30] * 4), (51, 1, [1.0] * 4)]))) == []  # too large for a long
