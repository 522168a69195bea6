"""Running aggregates in order, without ever putting one key's rows into one task.

``Window.partitionBy(key).orderBy(...)`` sends a whole key to one task, and with no key the whole
table. Here the rows are range-partitioned on (keys, order) instead, so a heavy key, a heavy time
bucket or a heavy group of equal timestamps is cut into runs of partition size. Windows work inside
a run, and each run then gets what the earlier runs of its key add up to. A range partition boundary
cuts at most one key, so this carried table has fewer rows than there are partitions: a broadcast
of proven size.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window, functions as F

from eventide.session import checkpoint_root

RUN = "_run"
_ORIGIN = "_origin"


@dataclass(frozen=True)
class Running:
    """A running ``max``, ``min`` or ``sum`` of ``value``; ``inclusive`` counts the row itself."""

    kind: str
    value: Column
    inclusive: bool = True


_TOTAL = {"max": F.max, "min": F.min, "sum": F.sum}
_JOIN = {
    "max": F.greatest,
    "min": F.least,
    "sum": lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)),
}


def ordered_runs(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Cut ``df`` into runs that are contiguous in (keys, order), numbered by ``_run``.

    Rows equal in keys and order, copies of one row included, may be cut apart as well: the input
    partition they come from is the last sort column. It stays the same when a task is repeated.

    The result is checkpointed: run borders come from sampling, so two branches planning the
    range shuffle on their own could cut at different places.
    """
    checkpoint_root(df.sparkSession)
    traced = df.withColumn(_ORIGIN, F.spark_partition_id())
    cut = traced.repartitionByRange(*[F.col(c) for c in (*keys, *order, _ORIGIN)]).drop(_ORIGIN)
    return cut.withColumn(RUN, F.spark_partition_id()).checkpoint()


def split_keys_only(runs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of those keys that lie in more than one run. There are fewer such keys than runs, so
    the semi-join's key table is a broadcast of proven size."""
    pieces = runs.select(*[F.col(k).alias(f"_key_{k}") for k in keys], RUN).distinct()
    split = pieces.groupBy(*[f"_key_{k}" for k in keys]).agg(F.count(F.lit(1)).alias("_runs")).where("_runs > 1")
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys])
    return runs.join(F.broadcast(split), same, "left_semi")


def running(
    runs: DataFrame, keys: Sequence[str], order: Sequence[str], totals_from: DataFrame | None = None, **columns: Running
) -> DataFrame:
    """Add running aggregates over ``keys`` in ``order`` to the output of :func:`ordered_runs`.

    Only keys cut by a run border carry anything over. Where the totals of a run are expensive, let
    ``totals_from`` be the same rows for just those keys (see :func:`split_keys_only`).
    """
    in_run = Window.partitionBy(*keys, RUN).orderBy(*order)
    earlier_runs = Window.partitionBy(*keys).orderBy(RUN).rowsBetween(Window.unboundedPreceding, -1)
    totals = (runs if totals_from is None else totals_from).groupBy(*keys, RUN).agg(
        *[_TOTAL[c.kind](c.value).alias(f"_total_{name}") for name, c in columns.items()]
    )
    carried = totals.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys],
        F.col(RUN).alias("_key_run"),
        *[_TOTAL[c.kind](F.col(f"_total_{n}")).over(earlier_runs).alias(f"_carry_{n}") for n, c in columns.items()],
    )
    carried = carried.where(reduce(or_, [F.col(f"_carry_{n}").isNotNull() for n in columns]))

    local = runs.select(
        "*",
        *[
            _TOTAL[c.kind](c.value)
            .over(in_run.rowsBetween(Window.unboundedPreceding, 0 if c.inclusive else -1))
            .alias(f"_local_{n}")
            for n, c in columns.items()
        ],
    )
    same = reduce(
        and_, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys], F.col(RUN) == F.col("_key_run")
    )
    return local.join(F.broadcast(carried), same, "left").select(
        *runs.columns,
        *[_JOIN[c.kind](F.col(f"_carry_{n}"), F.col(f"_local_{n}")).alias(n) for n, c in columns.items()],
    )
