"""Bit-plane clustering against plain integer arithmetic."""

import hashlib
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from eventide.llm import bitplanes

SCHEMA = "vec_id long, embedding array<float>, cluster string, distance string, planes string, _id string"


def vector(rng, size=64, spread=1.0):
    return [float(np.float32(rng.gauss(0, spread))) for _ in range(size)]


def plain(rows, k=16, rounds=3, scale=64):
    """(id, cluster, distance, cluster inertia, inertia, digest) of each kept (id, vector)."""
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    seeds = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), c) for i, c in kept if i is not None)[:k]
    centres = [c for _, c in seeds]
    away = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    place = lambda c: min(range(len(centres)), key=lambda n: (away(c, centres[n]), n))
    for _ in range(rounds):
        groups = {}
        for _, c in kept:
            groups.setdefault(place(c), []).append(c)
        for n, g in groups.items():
            centres[n] = [sum(x) // len(g) for x in zip(*g, strict=True)]
    found = [(i, place(c), away(c, centres[place(c)])) for i, c in kept]
    inertia = {n: sum(d for _, at, d in found if at == n) for n in range(len(centres))}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, n, d, inertia[n], sum(inertia.values()), digest[n]) for i, n, d in found), key=repr)


def got(df):
    assert df.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((tuple(r) for r in df.collect()), key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", None, "y", "z") for i, v in rows], SCHEMA).repartition(3)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(-(2**26), 2**26 - 1), min_size=64, max_size=64), min_size=1, max_size=4), st.lists(st.integers(-200, 200), min_size=64, max_size=64))
def test_planes_are_exact(rows, centre):
    values, other = np.array(rows, np.int64), np.array([centre], np.int64)
    words = bitplanes.pack(values, bitplanes.planes_for(values))
    assert (bitplanes.unpack(words) == values).all()
    assert (bitplanes.dots(words, bitplanes.pack(other, bitplanes.planes_for(other))[0]) == values @ other[0]).all()


def test_against_plain_arithmetic(spark):
    rng = random.Random(1)
    centres = [vector(rng) for _ in range(9)]
    rows = [(i, [float(np.float32(x + rng.gauss(0, 0.2))) for x in rng.choice(centres)]) for i in range(400)]
    rows += [(1000 + i, rows[7][1]) for i in range(150)]  # a hot vector
    assert got(bitplanes.cluster(frame(spark, rows))) == plain(rows)


def test_rows_that_are_not_kept_and_ties(spark):
    rng = random.Random(2)
    good, zero = vector(rng), [0.0] * 64
    rows = [(1, good), (1, good), (1, zero), (2, None), (3, []), (4, good[:63]), (5, [*good, 1.0]), (6, [None, *good[1:]]), (7, [math.nan, *good[1:]])]
    rows += [(8, [math.inf, *good[1:]]), (9, [-math.inf, *good[1:]]), (None, good), (None, vector(rng)), (10, vector(rng, spread=900.0)), (11, zero)]
    found = got(bitplanes.cluster(frame(spark, rows)))
    assert found == plain(rows) and len(found) == 7  # equal starts: the smaller number takes the rows, the other stays empty


@pytest.mark.parametrize("rows", [[], [(None, [0.5] * 64)], [(5, [0.5] * 64)]])
def test_few_rows(spark, rows):
    found = got(bitplanes.cluster(frame(spark, rows)))
    if rows and rows[0][0] is None:  # no start but zero, which the first round moves
        assert [r[1:3] for r in found] == [(0, 0)]
    else:
        assert found == plain(rows)


def test_overlong_components_are_left_out(spark):
    assert got(bitplanes.cluster(frame(spark, [(1, [1e30] * 64), (2, [1.0] * 64)])))[0][:3] == (2, 0, 0)
