"""Limits of the joins: ranges of no length, refused join types, sources without a name."""

import pytest
from pyspark.sql import functions as F

from eventide.operators import joins
from eventide.sources import ingest
from tests.events import at

LEFT = [("a", at("10:00"), 1), ("a", at("10:01"), 2), ("b", at("10:00"), 3), (None, at("10:00"), 4), ("c", None, 5)]
RIGHT = [("a", at("10:00"), 7), ("a", at("10:00"), 8), ("b", at("10:02"), 9), (None, at("10:00"), 10)]


def sides(spark):
    return spark.createDataFrame(LEFT, "k string, lt timestamp, x long"), spark.createDataFrame(RIGHT, "k string, rt timestamp, y long")


@pytest.mark.parametrize("how", ["inner", "left", "right", "full_outer", "left_anti"])
def test_a_range_of_no_length_joins_equal_times(spark, how):
    left, right = sides(spark)
    found = joins.interval_join(left, right, "k", "lt", "rt", "0 minutes", how)
    if how == "left_anti":
        assert sorted(r.x for r in found.collect()) == [2, 3, 4, 5]
        return
    met = {(1, 7), (1, 8)}
    alone = {(x, None) for _, _, x in LEFT[1:]} if how in ("left", "full_outer") else set()
    other = {(None, y) for _, _, y in RIGHT[2:]} if how in ("right", "full_outer") else set()
    assert {(r.x, r.y) for r in found.collect()} == met | alone | other
    assert {r.k for r in found.where("x is null").collect()} == ({"b", None} if other else set())


def test_a_negative_range_is_refused(spark):
    with pytest.raises(ValueError, match="holds nothing"):
        joins.interval_join(*sides(spark), "k", "lt", "rt", "-1 minutes")


@pytest.mark.parametrize("join", [joins.asof_join, joins.asof_join_stream])
def test_asof_joins_refuse_what_they_cannot_do(spark, join):
    for how in ("right", "full", "left_anti", "left_semi", "cross"):
        with pytest.raises(ValueError, match="left or inner"):
            join(*sides(spark), "k", "lt", "rt", "5 minutes", how)
    assert joins.asof_join(*sides(spark), "k", "lt", "rt", "5 minutes", "left_outer").count() == len(LEFT)


def test_a_source_without_a_name(spark):
    one, other = spark.range(2), spark.range(3)
    rows = ingest.union_channels({"web": one, None: other}).groupBy("channel").agg(F.count("*").alias("n")).collect()
    assert {r.channel: r.n for r in rows} == {"web": 2, None: 3}
