"""Line numbers, log inventory, and loads of log files into the record table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.predicate import as_day
from ..schema import LOG_SCHEMA
from .grammar import keep_records, parse_ecflow, parse_sms


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file_path, value, block, at`` of text files; ``at`` orders the lines of a block."""
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file_path"),
        "value",
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
    )


def read_ecflow_logs(spark: SparkSession, path: str) -> DataFrame:
    return parse_ecflow(read_lines(spark, path).drop("block", "at"))


def with_line_no(lines: DataFrame) -> DataFrame:
    """0-based ``line_no`` within the file, over all lines, blank ones too.

    Two passes for every file: lines are counted per block, block counts are summed up per
    file, and each line adds its place in its block. No task sorts a whole file.
    """
    keys = ["file_path", "block"]
    sizes = lines.groupBy(*keys).agg(F.count("*").alias("n"), F.min("at").alias("first"))
    before = Window.partitionBy("file_path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*keys, "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    # A block is read by one task in order, so its ids are consecutive.
    return lines.join(starts, keys).withColumn("line_no", F.col("start") + F.col("at") - F.col("first")).drop("first", "start")


def with_log_date(records: DataFrame, known: str | None = None) -> DataFrame:
    """``log_date``: the date of the nearest dated line at or before it in the file (else the first one).

    Blocks give their last date, which is carried over to the blocks behind them. ``known``: a column with the date
    that a file's lines before these have ended with, where these are not a file's first.
    """
    keys = ["file_path", "block"]
    dated = F.when(F.col("record_date").isNotNull(), F.col("line_no"))
    at_start = F.lit(None).cast("date") if known is None else F.first(known, True)
    ends = records.groupBy(*keys).agg(F.max_by("record_date", dated).alias("d"), F.min_by("record_date", dated).alias("f"), at_start.alias("k"))
    before = Window.partitionBy("file_path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("file_path").orderBy("block").rowsBetween(0, Window.unboundedFollowing)
    ahead = ends.select(*keys, F.coalesce(F.last("d", True).over(before), "k", F.first("f", True).over(after)).alias("ahead"))
    inside = Window.partitionBy(*keys).orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    carried = records.join(ahead, keys).withColumn("log_date", F.last("record_date", True).over(inside))
    return carried.withColumn("log_date", F.coalesce("log_date", "ahead")).drop("ahead")


def log_file_info(records: DataFrame) -> DataFrame:
    """Per file: number of lines, and time of the first and the last dated one. Takes all lines, not only kept ones."""
    dated = F.when(F.col("ts").isNotNull(), F.col("line_no"))
    return records.groupBy("file_path").agg(
        F.count("*").alias("line_count"), F.min_by("ts", dated).alias("first_ts"), F.max_by("ts", dated).alias("last_ts")
    )


def incremental_rows(records: DataFrame, stored: DataFrame) -> DataFrame:
    """Records behind the highest stored line of their ``(owner, repo, version_id)``."""
    keys = ["owner", "repo", "version_id"]
    seen = stored.groupBy(*keys).agg(F.max("line_no").alias("_seen"))
    return records.join(seen, keys, "left").filter(F.coalesce(F.col("line_no") > F.col("_seen"), F.lit(True))).drop("_seen")


def in_range(records: DataFrame, start: dt.date | str, stop: dt.date | str) -> DataFrame:
    """Records of the half-open range by ``log_date``, so undated lines go with the day they stand in."""
    return records.filter((F.col("log_date") >= as_day(start)) & (F.col("log_date") < as_day(stop)))


def parse_file(spark: SparkSession, path: str, owner: str, repo: str, version_id: str | Column) -> DataFrame:
    """All kept lines of log files in the record schema, with ``log_date``."""
    parsed = parse_sms(with_line_no(read_lines(spark, path)))
    named = with_log_date(parsed).select(
        "*", F.lit(owner).alias("owner"), F.lit(repo).alias("repo"),
        (F.lit(version_id) if isinstance(version_id, str) else version_id).alias("version_id"), F.col("value").alias("raw"),
    )
    return keep_records(named).select(*LOG_SCHEMA.fieldNames(), "log_date")


def ingest_logs(spark: SparkSession, path: str, owner: str, repo: str, version_id: str, out: str) -> int:
    """Load what a file, or a folder's files, have that the version lacks; the number of lines. Again: nothing."""
    return _store(spark, out).load(path, owner, repo, version_id)


def ingest_range(spark: SparkSession, path: str, owner: str, repo: str, version_id: str, start, stop, out: str, zones: DataFrame | None = None) -> None:
    """Replace the days of a half-open range in a version; other days stay. A zone map of the files spares their other days."""
    _store(spark, out).load_days(path, owner, repo, version_id, start, stop, zones)


def ingest_incremental(records: DataFrame, spark: SparkSession, out: str) -> int:
    """Add the records behind the last committed line of their version; the number of versions that had some.

    What is committed is known from the commit records, so the table is not read.
    """
    return _store(spark, out).add_behind(records)


def record_table(spark: SparkSession, out: str, owner: str, repo: str) -> DataFrame:
    """One repo's records; files of other repos are not opened."""
    return _store(spark, out).read(owner, repo)


def _store(spark: SparkSession, out: str):
    from .loads import RecordStore  # which builds on this module

    return RecordStore(spark, out)


def import_records_csv(spark: SparkSession, path: str) -> DataFrame:
    """Records with a header; fields may be quoted, a quote within being doubled."""
    return spark.read.schema(LOG_SCHEMA).csv(path, header=True, escape='"')
