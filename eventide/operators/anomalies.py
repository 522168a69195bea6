"""Rate anomalies. They work on window rows (at most one per slide), never on events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from eventide.functions.timing import duration_micros, plus

_MINUTE = duration_micros("1 minute")
# Means of rates are rounded before they are compared: a sum's last digits depend on its order.
PLACES = 6


def _with_history(rates: DataFrame, span: str, **stats: Column) -> DataFrame:
    """Statistics over the windows starting in ``[start - span, start - 1 minute]``.

    Partitioned by day: a row is copied into every later day that its ``span`` reaches, so that those
    days' windows see their whole history, and the copies are dropped afterwards.
    """
    width = duration_micros(span)
    day, spill = F.to_date("window_start"), F.to_date(plus(F.col("window_start"), width))
    days = F.sequence(day, spill)
    spread = rates.withColumn("_day", F.explode(days)).withColumn("_at", F.unix_micros("window_start"))
    before = Window.partitionBy("_day").orderBy("_at").rangeBetween(-width, -_MINUTE)
    with_stats = spread.select("*", *[s.over(before).alias(n) for n, s in stats.items()])
    return with_stats.where(F.col("_day") == day).drop("_day", "_at")


def rate_anomaly(rates: DataFrame, factor: float = 2.0, span: str = "1 hour") -> DataFrame:
    """Flag windows whose rate exceeds ``factor`` times the mean of the hour before."""
    out = _with_history(rates, span, baseline=F.avg("clicks_per_minute"))
    out = out.withColumn("baseline", F.round("baseline", PLACES))
    flag = F.coalesce(F.col("clicks_per_minute") > F.lit(factor) * F.col("baseline"), F.lit(False))
    return out.select("window_start", "window_end", "clicks_per_minute", "baseline", flag.alias("is_anomaly"))


def rate_zscore(rates: DataFrame, threshold: float = 3.0, span: str = "1 hour") -> DataFrame:
    rate = F.col("clicks_per_minute")
    out = _with_history(rates, span, mean=F.avg(rate), sd=F.stddev_samp(rate))
    out = out.withColumn("mean", F.round("mean", PLACES)).withColumn("sd", F.round("sd", PLACES))
    z = F.when(F.col("sd") > 0, F.round((rate - F.col("mean")) / F.col("sd"), PLACES))
    flag = F.coalesce(F.abs(F.col("zscore")) > threshold, F.lit(False))
    return (
        out.withColumn("zscore", z)
        .select("window_start", "window_end", "clicks_per_minute", "mean", "sd", "zscore", flag.alias("is_anomaly"))
    )


def hourly_baseline(rates: DataFrame) -> DataFrame:
    """Mean rate per hour of window start."""
    return rates.groupBy(F.window("window_start", "1 hour")).agg(
        F.round(F.avg("clicks_per_minute"), PLACES).alias("baseline_avg")
    ).select(F.col("window.start").alias("baseline_start"), "baseline_avg")


def baseline_theta_join(rates: DataFrame, baseline: DataFrame, factor: float = 2.0) -> DataFrame:
    """Windows exceeding ``factor`` times a baseline that starts no later than they do.

    Comparing with every earlier baseline is settled by the lowest of them, so the inequality join
    becomes an equality join on the hour with a running minimum over the hours of both sides (one row
    per hour): one row per alerting window, not one per (window, baseline) pair. An hour without a
    baseline of its own has the lowest of the hours before. Baselines start on the hour.
    """
    lowest = F.min("baseline_avg").over(
        Window.partitionBy(F.lit(0)).orderBy("_hour").rowsBetween(Window.unboundedPreceding, 0)
    )
    hour = F.date_trunc("hour", "window_start")
    known = baseline.select(F.col("baseline_start").alias("_hour"), "baseline_avg")
    hours = known.unionByName(rates.select(hour.alias("_hour")).distinct(), allowMissingColumns=True)
    so_far = hours.groupBy("_hour").agg(F.min("baseline_avg").alias("baseline_avg")).select("_hour", lowest.alias("baseline_avg"))
    joined = rates.withColumn("_hour", hour).join(so_far, "_hour").drop("_hour")
    return joined.where(F.col("clicks_per_minute") > F.lit(factor) * F.col("baseline_avg"))
