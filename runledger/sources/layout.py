"""A layout of records that serves several predicates: time, command, type and node.

Files sorted by one column skip well for that column alone. Here rows are sorted along a Z-order curve over time, command and node: the
bits of three ranks are interleaved, so rows that are near in all three lie together, and the least and largest values of a row
group stay close in each. Bloom filters answer for single nodes and types within what is left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clock import micros_between

#: Bits of a rank; values of a column that are sampled for its splits (balance alone); rows of a file, about.
BITS, SAMPLE, FILE_ROWS = 10, 20_000, 2_000_000
BLOOM = ("node_path", "record_type")


def _spread(rank: Column) -> Column:
    """A rank's bits at every third place."""
    x = rank.cast("bigint").bitwiseAND(F.lit(0x1FFFFF))
    for by, mask in ((32, 0x1F00000000FFFF), (16, 0x1F0000FF0000FF), (8, 0x100F00F00F00F00F), (4, 0x10C30C30C30C30C3), (2, 0x1249249249249249)):
        x = x.bitwiseOR(F.shiftleft(x, by)).bitwiseAND(F.lit(mask))
    return x


def interleave(a: Column, b: Column, c: Column) -> Column:
    """One number whose bits are those of three ranks in turn, the first one's highest."""
    return F.shiftleft(_spread(a), 2).bitwiseOR(F.shiftleft(_spread(b), 1)).bitwiseOR(_spread(c))


def splits(df: DataFrame, column: str, n: int) -> list:
    """Values that cut a column into about ``n`` equal parts, from a bounded sample; the same for the same rows."""
    drawn = df.filter(F.col(column).isNotNull()).select(column, F.xxhash64(*df.columns).alias("_h")).orderBy("_h").limit(SAMPLE)
    values = sorted(r[0] for r in drawn.select(column).collect())
    return sorted({values[len(values) * k // n] for k in range(1, n)}) if values else []


def rank(column: Column, cuts: list) -> Column:
    """How many cuts are not above a value, found by halving; nulls come first."""

    def within(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(column < F.lit(cuts[middle]), within(low, middle)).otherwise(within(middle + 1, high))

    return F.when(column.isNull(), F.lit(0)).otherwise(within(0, len(cuts)))


def z_order(records: DataFrame, bits: int = BITS) -> Column:
    """The place of a record on the curve over ``ts``, ``command`` and ``node_path``."""
    ends = records.agg(F.min("ts").alias("a"), F.max("ts").alias("b")).select("a", micros_between(F.col("a"), F.col("b")).alias("span")).first()
    if ends.a is None:
        time = F.lit(0)
    else:
        time = F.floor(micros_between(F.lit(ends.a).cast("timestamp_ntz"), F.col("ts")) * ((1 << bits) - 1) / F.lit(max(1, ends.span)))
    commands = rank(F.col("command"), splits(records, "command", 1 << 4)) * (1 << (bits - 4))
    nodes = rank(F.col("node_path"), splits(records, "node_path", 1 << min(bits, 6))) * (1 << max(0, bits - 6))
    return interleave(F.coalesce(time, F.lit(0)), commands, nodes)


def write_clustered(records: DataFrame, path: str, file_rows: int = FILE_ROWS, group_bytes: int | None = None) -> None:
    """Parquet files along the curve, with Bloom filters. ``group_bytes``: size of a row group, if not the usual one."""
    files = records.count() // file_rows + 1
    laid = records.withColumn("_z", z_order(records)).repartitionByRange(files, "_z").sortWithinPartitions("_z").drop("_z")
    out = laid.write.mode("overwrite")
    for c in BLOOM:
        if c in records.columns:
            out = out.option(f"parquet.bloom.filter.enabled#{c}", "true")
    if group_bytes:
        out = out.option("parquet.block.size", group_bytes).option("parquet.page.size", max(1024, group_bytes // 8)).option("parquet.page.row.count.limit", 500)
    out.parquet(path)
