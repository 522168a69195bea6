import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from eventide.llm import sharding
from tests.llm.conftest import TEXTS


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 3000), st.integers(0, 50))
def test_permutation(total, seed):
    assert sorted(sharding.permute(np.arange(total), total, seed)) == list(range(total))


def test_places(odd, nothing):
    rows = sharding.feistel_shards(odd, shards=4).collect()
    counts = Counter(r.shard for r in rows)
    assert max(counts.values()) - min(counts.values()) <= 1 and len(rows) == len(TEXTS)
    for shard in counts:
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(counts[shard]))
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in TEXTS)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == want
    assert all(r.law == "rows" and r.grown_shard is None for r in rows)
    assert sharding.feistel_shards(nothing).count() == 0


@pytest.mark.parametrize("parts", [1, 7])
def test_places_do_not_depend_on_partitions(odd, parts):
    key = lambda df: sorted(map(repr, (tuple(r) for r in sharding.feistel_shards(df).collect())))
    assert key(odd.repartition(parts)) == key(odd)
