"""Clocks of runs, their means and trimmed means, and late runs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clock import clock_us
from .runs import TASK, Machine, node_table, situations

#: Width of the buckets in which values are summed up, in microseconds.
BUCKET_US = 1_000_000


def clock_means(df: DataFrame, by: list[str], columns: list[str], ratio: float = 0.25) -> DataFrame:
    """``n_C``, ``mean_C`` and ``trimmed_C`` for each column C, per key, in whole units.

    The trimmed mean is that without the ``floor(ratio * n)`` smallest and largest of the n
    values. Nulls do not count; a key with nulls alone has n 0 and no means. Equal values
    are counted first, buckets of values are summed up next, and windows run over the
    buckets of a key and over the values of a bucket; so a key with very many values is
    not sorted in one task, and no value is dropped or sampled. All columns go through
    one aggregation.
    """
    stacked = F.explode(F.array(*[F.struct(F.lit(c).alias("which"), F.col(c).cast("bigint").alias("v")) for c in columns]))
    keys = [*by, "which"]
    values = df.select(*by, stacked.alias("x")).select(*by, "x.which", "x.v").groupBy(*keys, "v").agg(F.count("*").alias("c"))
    return means_of_counts(values, by, columns, ratio)


def means_of_counts(values: DataFrame, by: list[str], columns: list[str], ratio: float = 0.25) -> DataFrame:
    """The means of :func:`clock_means` from how often each value occurs: ``which`` (the column), ``v``, ``c``, one row a value."""
    keys = [*by, "which"]
    values = values.withColumn("b", F.floor(F.col("v") / F.lit(BUCKET_US)))
    buckets = values.filter("v is not null").groupBy(*keys, "b").agg(F.sum("c").alias("bc"))
    whole = Window.partitionBy(*keys)
    before = whole.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.select(*keys, "b", F.coalesce(F.sum("bc").over(before), F.lit(0)).alias("below"), F.sum("bc").over(whole).alias("n"))
    inside = Window.partitionBy(*keys, "b").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    placed = values.join(buckets, [*keys, "b"], "left")
    placed = placed.withColumn("hi", F.col("below") + F.sum("c").over(inside)).withColumn("lo", F.col("hi") - F.col("c"))
    k = F.floor(F.col("n") * F.lit(ratio))
    taken = F.greatest(F.lit(0), F.least("hi", F.col("n") - k) - F.greatest("lo", k))
    sums = placed.groupBy(*keys).agg(
        F.coalesce(F.max("n"), F.lit(0)).alias("n"),
        F.sum(F.col("c") * F.col("v")).alias("total"),
        F.sum(taken * F.col("v")).alias("inner_total"),
        F.sum(F.when(F.col("v").isNotNull(), taken)).alias("kept"),
    )
    sums = sums.select(
        *keys, "n", F.expr("total div nullif(n, 0)").alias("mean"), F.expr("inner_total div nullif(kept, 0)").alias("trimmed")
    )
    pick = [F.max(F.when(F.col("which") == c, F.col(f))).alias(f"{f}_{c}") for c in columns for f in ("n", "mean", "trimmed")]
    return sums.groupBy(*by).agg(*pick)


def trimmed_mean(df: DataFrame, by: list[str], col: str, ratio: float = 0.25, name: str = "trimmed_mean") -> DataFrame:
    """Trimmed mean of one column per key that has a value."""
    means = clock_means(df, by, [col], ratio)
    return means.filter(F.col(f"n_{col}") > 0).select(*by, F.col(f"trimmed_{col}").alias(name))


def time_point(log: DataFrame, status: str, start, stop, machine: Machine = TASK, earliest_time=None, clip_to_stop: bool = False, node_paths=None) -> DataFrame:
    """Per node and day, the clock at which its completed run entered ``status`` (microseconds from the day's midnight)."""
    table = node_table(situations(log, start, stop, machine, earliest_time, clip_to_stop, node_paths))
    column = f"time_point_{status}"
    if column not in table.columns:
        raise ValueError(f"no time point of status {status!r}")
    return table.select("node_path", "run_date", "run_key", clock_us(F.col("run_date"), F.col(column)).alias("clock"))


def time_point_summary(points: DataFrame, ratio: float = 0.25) -> DataFrame:
    """Mean and trimmed mean of the clocks of each node; days without one do not count."""
    if "clock" not in points.columns:
        raise ValueError("time points have a column clock")
    means = clock_means(points, ["node_path"], ["clock"], ratio)
    return means.select("node_path", F.col("n_clock").alias("n"), F.col("mean_clock").alias("mean"), F.col("trimmed_clock").alias("trimmed_mean"))


def time_period(log: DataFrame, start, stop, machine: Machine = TASK, earliest_time=None, clip_to_stop: bool = False, node_paths=None) -> DataFrame:
    """Per node and day: start clock, end clock and duration of its completed run, in microseconds."""
    table = node_table(situations(log, start, stop, machine, earliest_time, clip_to_stop, node_paths))
    return table.select(
        "node_path", "run_date", "run_key",
        clock_us(F.col("run_date"), F.col("time_period_in_all_start")).alias("start_clock"),
        clock_us(F.col("run_date"), F.col("time_period_in_all_end")).alias("end_clock"),
        F.col("time_period_in_all").alias("duration"),
    )


def summary_of_counts(values: DataFrame, ratio: float = 0.25) -> DataFrame:
    """:func:`time_period_summary` from maintained counts of ``start_clock`` and ``end_clock`` (:mod:`runledger.sources.deltas`)."""
    means = means_of_counts(values, ["node_path"], ["start_clock", "end_clock"], ratio)
    return means.select("node_path", F.col("n_start_clock").alias("n"), F.col("trimmed_start_clock").alias("start_mean"), F.col("trimmed_end_clock").alias("end_mean"))


def time_period_summary(periods: DataFrame, ratio: float = 0.25) -> DataFrame:
    """Trimmed means of the start and end clocks of each node."""
    for c in ("start_clock", "end_clock"):
        if c not in periods.columns:
            raise ValueError(f"time periods have a column {c}")
    means = clock_means(periods, ["node_path"], ["start_clock", "end_clock"], ratio)
    return means.select(
        "node_path", F.col("n_start_clock").alias("n"), F.col("trimmed_start_clock").alias("start_mean"), F.col("trimmed_end_clock").alias("end_mean")
    )


def with_late(periods: DataFrame, ratio: float = 0.25, threshold_minutes: int = 30) -> DataFrame:
    """``end_clock_late``: more than the threshold over the node's trimmed mean; false without a run."""
    mean = trimmed_mean(periods, ["node_path"], "end_clock", ratio, "end_mean")
    late = F.col("end_clock") - F.col("end_mean") > threshold_minutes * 60 * 1_000_000
    return periods.join(mean, "node_path", "left").withColumn("end_clock_late", F.coalesce(late, F.lit(False))).drop("end_mean")


def late_runs(periods: DataFrame, ratio: float = 0.25, threshold_minutes: int = 30) -> DataFrame:
    return with_late(periods, ratio, threshold_minutes).filter("end_clock_late")


def model_run_report(
    log: DataFrame, stop, days: int = 30, ratio: float = 0.25, threshold_minutes: int = 30, drop_unrecognised: bool = True
) -> DataFrame:
    """Runs of all nodes on the ``days`` days before ``stop``, with the late flag."""
    stop = dt.date.fromisoformat(stop) if isinstance(stop, str) else stop
    out = with_late(time_period(log, stop - dt.timedelta(days=days), stop), ratio, threshold_minutes)
    return out.na.drop() if drop_unrecognised else out

