"""Named queries with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = run
        if sql:
            CHECKS[name] = sql
        return run

    return keep


def rounded(df: DataFrame, **places: int) -> DataFrame:
    """Round floating-point results whose last digits depend on the order of summation."""
    return df.select(*[F.round(c, places[c]).alias(c) if c in places else F.col(c) for c in df.columns])
