"""Exact interpolated percentiles per group from value counts.

``percentile`` keeps every distinct value of a group in one buffer. Counting each value first makes
the input one row per distinct value, and the positions are then read off a running count over runs, so
that a group with very many values is spread over tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from eventide.plans.ordered import Running, ordered_runs, running


def exact_percentiles(df: DataFrame, keys: Sequence[str], value: str, **quantiles: float) -> DataFrame:
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    runs = ordered_runs(counts, list(keys), [value])
    upto = running(runs, list(keys), [value], _upto=Running("sum", F.col("_n")))
    ranked = upto.select(*keys, value, "_upto")
    sizes = runs.groupBy(*keys).agg(F.sum("_n").alias("_size"))
    placed = ranked.join(sizes, list(keys))
    reads = []
    for name, q in quantiles.items():
        place = F.lit(q) * (F.col("_size") - 1)
        for side, index in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            reads.append(F.min(F.when(F.col("_upto") > index, F.col(value))).alias(f"_{name}_{side}"))
    found = placed.groupBy(*keys, "_size").agg(*reads)
    out = []
    for name, q in quantiles.items():
        place = F.lit(q) * (F.col("_size") - 1)
        lo, hi = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        out.append((lo + (hi - lo) * (place - F.floor(place))).alias(name))
    return found.select(*keys, *out)
