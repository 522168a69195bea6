"""Running aggregates over runs against plain Python."""

import random

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from eventide.plans.ordered import RUN, Running, ordered_runs, running


def _expected(rows):
    out, state = {}, {}
    for key, at, number, value in sorted(rows, key=lambda r: r[:3]):
        largest, total, count = state.get(key, (None, 0, 0))
        before = largest
        largest = value if largest is None else max(largest, value)
        state[key] = (largest, total + value, count + 1)
        out[number] = (before, total + value, count + 1)
    return out


def _check(spark, rows, expect_split=False):
    df = spark.createDataFrame(rows, "key string, at long, number long, value long").repartition(4)
    runs = ordered_runs(df, ["key"], ["at", "number"])
    out = running(
        runs, ["key"], ["at", "number"],
        before=Running("max", F.col("value"), inclusive=False), total=Running("sum", F.col("value")),
        place=Running("sum", F.lit(1)),
    )
    got = {r["number"]: (r["before"], r["total"], r["place"]) for r in out.collect()}
    assert got == _expected(rows)
    if expect_split:
        per_key = runs.groupBy("key").agg(F.count_distinct(RUN).alias("n")).where("key = 'hot'").first()["n"]
        largest = runs.groupBy(RUN).count().agg(F.max("count")).first()[0]
        assert per_key > 2
        assert largest < len(rows) / 2


def test_heavy_key_and_heavy_moment_are_split(spark):
    rng = random.Random(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = []
        for number in range(4000):
            hot = number % 3 != 0  # two thirds of the rows have one key, most of those one moment
            key = "hot" if hot else f"k{rng.randrange(200)}"
            rows.append((key, 5 if hot and number % 4 else rng.randrange(100), number, rng.randrange(-1000, 1000)))
        _check(spark, rows, expect_split=True)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_copies_of_one_row_are_split(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [("k", 5)] * 2000 + [("k", i % 5) for i in range(500)] + [("k", 6)] * 500
        df = spark.createDataFrame(rows, "key string, at long").repartition(16)
        runs = ordered_runs(df, ["key"], ["at"])
        assert runs.where("at = 5").select(RUN).distinct().count() > 2
        out = running(runs, ["key"], ["at"], place=Running("sum", F.lit(1)))
        assert sorted(r.place for r in out.collect()) == list(range(1, 3001))
        assert [tuple(r) for r in out.groupBy("at").agg(F.min("place"), F.max("place")).where("at > 4").orderBy("at").collect()] == [
            (5, 501, 2500), (6, 2501, 3000)
        ]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 5), st.integers(-9, 9)), min_size=1, max_size=60))
def test_any_rows(spark, drawn):
    _check(spark, [(k, at, i, v) for i, (k, at, v) in enumerate(drawn)])


def test_without_keys_and_descending_minimum(spark):
    rows = [(i, (i * 37) % 101) for i in range(500)]
    df = spark.createDataFrame(rows, "number long, value long").repartition(5)
    out = running(ordered_runs(df, [], ["number"]), [], ["number"], least=Running("min", F.col("value")))
    least, want = 1000, {}
    for number, value in rows:
        least = min(least, value)
        want[number] = least
    assert {r["number"]: r["least"] for r in out.collect()} == want
