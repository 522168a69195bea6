"""Interval and as-of joins on a key and a time range."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from eventide.functions.timing import duration_micros, plus, slot
from eventide.plans.ordered import Running, ordered_runs, running


def interval_join(
    left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str,
    lower: str = "5 minutes", how: str = "inner",
) -> DataFrame:
    """Pairs with equal key and ``right_time`` in ``[left_time - lower, left_time]``.

    Column names of the two sides must differ except for the key. In batch the time range becomes
    an equality on a slot as long as the range: a right row is put into its own slot and the next,
    so a heavy key is spread over its slots. A stream-stream join gets the plain range condition,
    from which Spark derives how long to keep state. ``how`` is any join type of Spark; right rows that
    meet nothing come from an anti-join, as each of their two copies would look unmatched, and keep their key.
    A range of no length joins equal times; a negative one is refused.
    """
    how = how.replace("_", "").removesuffix("outer")
    width = duration_micros(lower)
    if width < 0:
        raise ValueError(f"a range of {lower} holds nothing")
    in_range = (F.col(right_time) >= plus(F.col(left_time), -width)) & (F.col(right_time) <= F.col(left_time))
    other = f"_{key}"
    right = right.withColumnRenamed(key, other)
    if left.isStreaming or right.isStreaming:
        bounded = (F.col(right_time) >= F.col(left_time) - F.expr(f"INTERVAL {lower}")) & (F.col(right_time) <= F.col(left_time))
        return left.join(right, (F.col(key) == F.col(other)) & bounded, how).drop(other)
    if not width:
        met = left.join(right, (F.col(key) == F.col(other)) & (F.col(left_time) == F.col(right_time)), how)
        return met.withColumn(key, F.coalesce(key, other)).drop(other) if how in ("right", "full") else met.drop(other)
    if how in ("right", "full"):
        kept = "left" if how == "full" else "inner"
        met = interval_join(left, right.withColumnRenamed(other, key), key, left_time, right_time, lower, kept)
        own = slot(F.col(left_time), width)
        seen = left.select(key, left_time, F.explode(F.array(own, own - width)).alias("_slot"))
        same = (F.col(key) == F.col(other)) & (F.col("_slot") == slot(F.col(right_time), width))
        alone = right.join(seen, same & in_range, "left_anti").withColumnRenamed(other, key)
        return met.unionByName(alone, allowMissingColumns=True)
    own = slot(F.col(right_time), width)
    right = right.withColumn("_right_slot", F.explode(F.array(own, own + width)))
    left = left.withColumn("_left_slot", slot(F.col(left_time), width))
    same = (F.col(key) == F.col(other)) & (F.col("_left_slot") == F.col("_right_slot"))
    return left.join(right, same & in_range, how).drop(other, "_left_slot", "_right_slot")


def _one_match_each(how: str) -> str:
    """An as-of join keeps left rows, with or without those that have no match; anything else is refused."""
    plain = how.replace("_", "").removesuffix("outer")
    if plain not in ("left", "inner"):
        raise ValueError(f"an as-of join is left or inner, not {how}")
    return plain


def asof_join_stream(
    left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str,
    within: str = "5 minutes", how: str = "left",
) -> DataFrame:
    """:func:`asof_join` of two watermarked streams, in append mode.

    The interval join finds each left row's candidates, and a grouping by the left row keeps the newest; the watermark
    clears both. A row comes out once the watermark says that no newer match can arrive. Left rows must differ, for
    instance by an event id.
    """
    how = _one_match_each(how)
    values = [c for c in right.columns if c not in (key, right_time)]
    met = interval_join(left, right, key, left_time, right_time, within, how)
    newest = F.max(F.when(F.col(right_time).isNotNull(), F.struct(right_time, *values))).alias("_match")
    rows = met.groupBy(*left.columns).agg(newest)
    return rows.select(*left.columns, *[F.col("_match")[c].alias(c) for c in (right_time, *values)])


def asof_join(
    left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str,
    within: str = "5 minutes", how: str = "left",
) -> DataFrame:
    """Each left row with the newest right row of its key in ``[left_time - within, left_time]``.

    Both sides are put in one order and the newest right row is carried along as a running maximum
    over runs: no pairs are formed, and neither a heavy key nor a heavy moment ends up in one task.
    Right rows of one moment rank by their columns in schema order. As in any join a null key matches
    nothing, and nor does a null time. ``how`` is left or inner.
    """
    how = _one_match_each(how)
    unkeyed = left.where(F.col(key).isNull() | F.col(left_time).isNull())
    left = left.where(F.col(key).isNotNull() & F.col(left_time).isNotNull())
    right = right.where(F.col(key).isNotNull() & F.col(right_time).isNotNull())
    values = [c for c in right.columns if c not in (key, right_time)]
    found = F.struct(F.col(right_time), *[F.col(c) for c in values])
    row = F.struct(*[F.col(c) for c in left.columns if c != key])
    lefts = left.select(key, F.col(left_time).alias("_at"), F.lit(1).alias("_side"), row.alias("_row"))
    rights = right.select(key, F.col(right_time).alias("_at"), F.lit(0).alias("_side"), found.alias("_found"))
    both = lefts.unionByName(rights, allowMissingColumns=True)
    order = ["_at", "_side"]
    met = running(ordered_runs(both, [key], order), [key], order, _newest=Running("max", F.col("_found")))
    fresh = F.col("_newest")[right_time] >= plus(F.col("_at"), -duration_micros(within))
    out = met.where(F.col("_side") == 1).withColumn("_match", F.when(fresh, F.col("_newest")))
    if how == "inner":
        out = out.where(F.col("_match").isNotNull())
    joined = out.select(
        *[F.col(key) if c == key else F.col("_row")[c].alias(c) for c in left.columns],
        *[F.col("_match")[c].alias(c) for c in (right_time, *values)],
    )
    return joined if how == "inner" else joined.unionByName(unkeyed, allowMissingColumns=True)
