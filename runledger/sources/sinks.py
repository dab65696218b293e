"""Report files, JSON by date, and the keyed export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clock import hex_epoch
from ..functions.predicate import as_day


def write_report_csv(report: DataFrame, path: str) -> None:
    """With a header; the run key comes first, and rows are in its order."""
    rest = [c for c in report.columns if c != "run_key"]
    report.select("run_key", *rest).orderBy("run_key", "node_path").write.mode("overwrite").option("header", True).csv(path)


def export_timeline_json(timeline: DataFrame, path: str) -> None:
    """One folder a day, of a few files, so that no task has a whole day."""
    timeline.repartition("run_date", F.pmod(F.xxhash64(*timeline.columns), F.lit(8))).write.mode("overwrite").partitionBy("run_date").json(path)


def records_as_json(records: DataFrame) -> DataFrame:
    return records.select(F.to_json(F.struct(*records.columns)).alias("json"))


def row_key(version: Column, line_no: Column, moment: Column) -> Column:
    """Eight hex digits of a digest of ``version.line``, and the time as eight more."""
    digest = F.substring(F.sha2(F.concat_ws(".", version, line_no), 256), 1, 8)
    return F.concat_ws("-", digest, hex_epoch(moment))


def export_keyed(records: DataFrame, date=None) -> DataFrame:
    """Records, of one day if given, under their row key."""
    rows = records if date is None else records.filter(F.col("record_date") == as_day(date))
    return rows.select(row_key(F.col("version_id"), F.col("line_no"), F.col("ts")).alias("row_key"), "*")


def scan_by_key(keyed: DataFrame, pattern: str) -> DataFrame:
    return keyed.filter(F.col("row_key").rlike(pattern))


#: Rows of a file of the sorted store, about.
FILE_ROWS = 1_000_000
#: Rows of a task that writes the sorted store, at least, where its files are smaller.
TASK_ROWS = 100_000
_SPECIAL = set(".^$*+?{}[]\\|()")


def write_sorted_keys(keyed: DataFrame, path: str, file_rows: int = FILE_ROWS) -> None:
    """The keyed rows twice, each range-split and sorted over all files: by key, and by the time at the key's end.

    What each file begins and ends with is kept beside them, so that a scan opens the files of its range alone.
    """
    spark = keyed.sparkSession
    rows = keyed.count()
    files = rows // file_rows + 1
    # A task of small files writes many, one after the other: each range costs the driver samples, sizes and a result.
    tasks = min(files, rows // TASK_ROWS + 1)
    for order, column in (("by_key", F.col("row_key")), ("by_time", _time_first(F.col("row_key")))):
        laid = keyed.withColumn("sort_key", column).repartitionByRange(tasks, "sort_key").sortWithinPartitions("sort_key")
        laid.write.mode("overwrite").option("maxRecordsPerFile", file_rows if tasks < files else 0).parquet(f"{path}/{order}")
        named = spark.read.parquet(f"{path}/{order}").groupBy(F.input_file_name().alias("file"))
        named.agg(F.min("sort_key").alias("low"), F.max("sort_key").alias("high"), F.count("*").alias("n")).write.mode("overwrite").parquet(f"{path}/{order}_files")


def _time_first(key: Column) -> Column:
    return F.concat_ws("-", F.substring_index(key, "-", -1), F.substring_index(key, "-", 1))


def _literal(pattern: str) -> str:
    """The characters that any match begins with."""
    out = ""
    for k, c in enumerate(pattern):
        if c in _SPECIAL or pattern[k + 1 : k + 2] in ("*", "?", "{"):
            break
        out += c
    return out


def key_range(pattern: str) -> tuple[str, str]:
    """Which order of the sorted store serves a pattern, and what its sort keys begin with ("" where nothing is known)."""
    if set("|()\\") & set(pattern):
        return "by_key", ""
    start = _literal(pattern[1:]) if pattern.startswith("^") else ""
    plain = pattern.split("[")  # a hyphen outside of brackets is the one of the key, and time stands behind it
    parts = [plain[0], *(p.partition("]")[2] for p in plain[1:])]
    at = next((k for k, p in enumerate(parts) if "-" in p), None)
    time = _literal(parts[at].split("-", 1)[1] + ("[" if at + 1 < len(parts) else "")) if at is not None else ""
    return ("by_key", start) if len(start) >= len(time) else ("by_time", time)


def scan_sorted(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """The rows whose key matches a regular expression, from the files that may hold such keys."""
    order, start = key_range(pattern)
    files = spark.read.parquet(f"{path}/{order}_files")
    mine = files.filter((F.col("high") >= start) & (F.substring("low", 1, len(start)) <= start)) if start else files
    found = [r.file for r in mine.select("file").collect()]  # a row for every FILE_ROWS rows of the range
    rows = spark.read.schema(spark.read.parquet(f"{path}/{order}").schema).parquet(*found) if found else spark.read.parquet(f"{path}/{order}").limit(0)
    if start:
        rows = rows.filter(F.col("sort_key").startswith(start))
    return scan_by_key(rows, pattern).drop("sort_key")
