"""Streaming forms of the load and of the run windows.

Spark's file source reads new files; lines added to a file that it has read already are not
seen. These streams serve rolled files; :func:`runledger.sources.lines.tail` follows growing ones. A batch of
:func:`stream_situations` reads all records of the nodes that it touches; :mod:`.machine` keeps their state instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.runs import TASK, Machine, assign_run_window, situations, status_changes
from ..sources.grammar import keep_records, parse_sms

#: Partitions of the table of situations.
BUCKETS = 256
KEYS = ("owner", "repo", "version_id", "line_no")


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p) and len(fs.listStatus(p)) > 0


def append_new(batch: DataFrame, out: str, keys: tuple[str, ...] = KEYS) -> None:
    """Rows of a batch that the table lacks, null keys being equal. Only the batch's days of the table are read."""
    spark = batch.sparkSession
    rows = batch.dropDuplicates(list(keys))
    if _exists(spark, out):
        days = rows.select("record_date").distinct()
        stored = spark.read.schema(batch.schema).parquet(out).join(F.broadcast(days) if days.count() <= 10_000 else days, "record_date", "left_semi")
        there = stored.select(*[F.col(k).alias(f"_{k}") for k in keys])
        rows = rows.join(there, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], "left_anti")
    rows.write.mode("append").partitionBy("record_date").parquet(out)


def stream_ingest(lines: DataFrame, out: str, checkpoint: str, parse: Callable[[DataFrame], DataFrame] = parse_sms):
    """Parse a stream of lines (``value`` and any key columns) into a record table, each record once.

    No watermark: a file that comes late is loaded like any other. Its numbers must be set
    before, in ``line_no``, or be part of the line.
    """

    def load(batch: DataFrame, _number: int) -> None:
        append_new(keep_records(parse(batch)), out)

    return lines.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def bucket(n: int = BUCKETS):
    return F.pmod(F.xxhash64("node_path"), F.lit(n)).cast("int")


def refresh_situations(records: DataFrame, touched: DataFrame, out: str, start, stop, machine: Machine = TASK) -> None:
    """Compute the buckets of the touched nodes anew, from all their records, and replace these alone."""
    buckets = touched.select(bucket().alias("bucket")).distinct()  # at most BUCKETS rows
    mine = records.withColumn("bucket", bucket()).join(F.broadcast(buckets), "bucket", "left_semi").drop("bucket")
    found = situations(mine, start, stop, machine).withColumn("bucket", bucket())
    found.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(out)


def stream_situations(records: DataFrame, table: str, out: str, checkpoint: str, start, stop, machine: Machine = TASK):
    """Keep the situations of every node up to date with a stream of records.

    A batch is added to ``table``; then the buckets of nodes it touches are computed anew from
    the table, so a late record corrects its windows however late it is. A batch that
    runs again adds nothing and writes the same partitions.
    """

    def load(batch: DataFrame, _number: int) -> None:
        append_new(batch, table, ("line_no",))
        stored = batch.sparkSession.read.schema(batch.schema).parquet(table)
        refresh_situations(stored, batch.select("node_path").distinct(), out, start, stop, machine)

    return records.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_run_windows(records: DataFrame, table: str, out: str, checkpoint: str, start, stop):
    """Counts of each node's two-day windows; the days that a batch touches are counted anew."""

    def load(batch: DataFrame, _number: int) -> None:
        append_new(batch, table, ("line_no",))
        stored = batch.sparkSession.read.schema(batch.schema).parquet(table)
        days = batch.select(F.explode(F.array("record_date", F.date_sub("record_date", 1))).alias("run_date")).distinct()
        near = days.select(F.explode(F.array("run_date", F.date_add("run_date", 1))).alias("record_date")).distinct()
        placed = assign_run_window(status_changes(stored.join(near, "record_date", "left_semi")), start, stop)
        counts = placed.join(days, "run_date", "left_semi").groupBy("node_path", "run_date").agg(F.count("*").alias("n_records"))
        counts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_date").parquet(out)

    return records.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
