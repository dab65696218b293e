"""A zone map of log files: which bytes hold which days.

A zone is a stretch of whole lines of a file. Its row says where it is, the number of its first line, the times of its
first and last dated line, and the days that its lines belong to, undated ones going with the day before them. A range of dates then
reads its zones alone, not the log. The map is a DataFrame of a few hundred bytes for every
``zone_bytes`` of log; write it next to the log and add the zones of what has grown.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.predicate import as_day, in_calendar
from . import lines
from .grammar import parse_ecflow

ZONE_BYTES = 4 << 20


def zone_map(spark: SparkSession, path: str, parse: Callable[[DataFrame], DataFrame] = parse_ecflow, known: DataFrame | None = None, zone_bytes: int = ZONE_BYTES) -> DataFrame:
    """``file_path, first_byte, end_byte, first_line, lines, first_ts, last_ts, first_day, last_day, start_day`` of whole lines.

    ``start_day``: the day of undated lines ahead of the zone's first dated one. ``known``: a map of the same files as they were;
    only what lies behind it is read, and the zones of both are returned.
    """
    ends = {}
    if known is not None:
        last = known.groupBy("file_path").agg(F.max_by(F.struct("end_byte", (F.col("first_line") + F.col("lines")).alias("line"), "last_day"), "end_byte").alias("e"))
        ends = {r.file_path: r.e for r in last.collect()}  # a row a file
    wanted, days = {}, []
    for file, size in lines.list_files(path).items():
        byte, line, day = ends.get(file, (0, 0, None))
        if size < byte:
            raise ValueError(f"{file} has become shorter; a rolled log needs a new name")
        wanted[file] = (byte, line, lines.last_line_end(file, byte, size))
        days.append((file, day, wanted[file][2]))
    ranges = lines.plan_ranges(spark, wanted, zone_bytes)
    tasks = lines.range_tasks(spark, sum(-(-(stop - a) // zone_bytes) for a, _, stop in wanted.values()), sum(stop - a for a, _, stop in wanted.values()))
    found = parse(lines.read_ranges(ranges, tasks))
    dated = F.when(F.col("ts").isNotNull(), F.col("line_no"))
    day_at = F.when(F.col("record_date").isNotNull(), F.col("line_no"))
    # The lines are read once, and none leaves its task: each zone sums itself up, and days are carried from zone to zone.
    zones = found.groupBy("file_path", F.col("block").alias("first_byte")).agg(
        F.min("line_no").alias("first_line"), F.count("*").alias("lines"), F.min_by("ts", dated).alias("first_ts"), F.max_by("ts", dated).alias("last_ts"),
        F.min("record_date").alias("least"), F.max("record_date").alias("most"), F.min_by("record_date", "line_no").alias("at_start"),
        F.min_by("record_date", day_at).alias("f"), F.max_by("record_date", day_at).alias("d"),
    )
    zones = zones.join(F.broadcast(spark.createDataFrame(days, "file_path string, known date, stop long")), "file_path")  # a row a file
    order = Window.partitionBy("file_path").orderBy("first_byte")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    ahead = F.coalesce(F.last("d", True).over(before), "known", F.first("f", True).over(after))
    zones = zones.withColumns({"end_byte": F.coalesce(F.lead("first_byte").over(order), "stop"), "ahead": ahead})
    zones = zones.withColumn("start_day", F.coalesce("at_start", "ahead"))
    # A zone that starts with an undated line has lines of the day before it.
    zones = zones.withColumns({"first_day": F.least("least", "start_day"), "last_day": F.greatest("most", "start_day")})
    zones = zones.select("file_path", "first_byte", "end_byte", "first_line", "lines", "first_ts", "last_ts", "first_day", "last_day", "start_day")
    return zones if known is None else known.unionByName(zones)


def zones_of(zones: DataFrame, start, stop) -> DataFrame:
    """The zones that may hold lines of days in ``[start, stop)``."""
    return zones.filter((F.col("first_day") < as_day(stop)) & (F.col("last_day") >= as_day(start)))


def zone_tasks(zones: DataFrame) -> int:
    """Tasks to read so many zones, small ones together."""
    n, size = zones.agg(F.count("*"), F.coalesce(F.sum(F.col("end_byte") - F.col("first_byte")), F.lit(0))).first()
    return lines.range_tasks(zones.sparkSession, n, size)


def read_days(zones: DataFrame, start, stop, parse: Callable[[DataFrame], DataFrame] = parse_ecflow, bytes_read=None) -> DataFrame:
    """Records whose date is in ``[start, stop)``, with ``file_path`` and ``line_no``, read from their zones alone."""
    mine = zones_of(zones, start, stop).select("file_path", "first_byte", "end_byte", "first_line")
    found = lines.read_ranges(mine, zone_tasks(mine), bytes_read)
    return parse(found.drop("byte", "block")).filter(in_calendar(F.col("record_date"), start, stop))
