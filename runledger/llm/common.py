"""Checkpoints in the shared folder, connected components, table access."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import storage


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settled(value: Column) -> Column:
    """The same value, behind a generator of one row.

    The optimizer moves filters below projections by putting the projected expressions
    into them. Where those hold lambdas over earlier columns, each element would compute these
    again; a filter does not pass a generator.
    """
    return F.explode(F.array(value))


def whole_ids(name: str) -> list[Column]:
    """An id column and where it is null, apart: with nulls in it, pandas would hold it as floats."""
    return [F.coalesce(F.col(name).cast("long"), F.lit(0).cast("long")).alias(name), F.col(name).isNull().alias("no_id")]


def nullable(ids, missing) -> pd.api.extensions.ExtensionArray:
    """The ids of :func:`whole_ids` as they were."""
    out = pd.array(np.asarray(ids, np.int64), "Int64")
    out[np.asarray(missing, bool)] = pd.NA
    return out


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, as ``spark.checkpoint.dir`` names it.

    Only a session without that setting whose executors are threads of the driver (tests) gets a temporary one; another raises.
    """
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(storage.shared_folder(spark))
    return (spark.conf.get("spark.checkpoint.dir", None) or sc._jsc.sc().getCheckpointDir().get()).rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage by a checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every non-minimal node of an edge table ``(a, b)``.

    ``component`` is the smallest node reachable. Alternating large-star and
    small-star rounds: every round links each node to the least neighbour it
    has seen, so stars form in a logarithmic number of rounds. Only one
    count and one checksum per round reach the driver. Nodes that are the
    least of their component, and nodes without edges, are not listed.
    """
    e = checkpointed(
        edges.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    before = None
    while True:
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before or now[0] == 0:
            return e.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = now
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        large = (
            both.join(least, "a")
            .filter(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .distinct()
        )
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(least.select("a", F.col("m").alias("b")))
        e = checkpointed(small.filter(F.col("a") != F.col("b")).distinct())
