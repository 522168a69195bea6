import pytest
from pyspark.sql import types as T

#: Nulls, empty and blank texts, repeated rows and ids, ties, and a long text.
TEXTS = [
    (1, "one two three four five"),
    (2, "one  two\tthree\nfour five"),
    (2, "one  two\tthree\nfour five"),
    (3, None),
    (4, ""),
    (5, "   "),
    (None, "one two three four five"),
    (None, None),
    (6, "Ünïcödé 日本 🙂 text ONE two"),
    (7, "word " * 40_000),
    (8, "x" * 60_000),
    (9, "... 42 !!"),
    (9, "an other text with the same id"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with every unusual shape and extra columns whose names clash with results."""
    clash = [T.StructField(c, T.StringType()) for c in "kept score fingerprint _row _text text_sha256 shard n_hit ids".split()]
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), *clash])
    rows = [(i, t, None if n % 5 == 4 else "en", *[None if n % 2 else "x"] * len(clash)) for n, (i, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)
