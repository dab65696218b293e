"""Counts of values that are kept up to date by signed changes.

A batch of results that is new, corrected or withdrawn becomes signed counts: +1 for each value that now holds, -1 for each that held
before. What does not change cancels out. A batch is written as an attempt and counts when the next commit record names it; a source numbers
its batches, and one that has counted adds nothing when it is sent again. Reading sums up; every ``FOLD`` batches are folded into one.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import storage

FOLD = 16


def value_changes(before: DataFrame | None, after: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """``*by, which, v, c``: the signed counts that lead from the results ``before`` to ``after``. Null values count as values."""

    def signed(df: DataFrame, sign: int) -> DataFrame:
        stacked = F.explode(F.array(*[F.struct(F.lit(c).alias("which"), F.col(c).cast("bigint").alias("v")) for c in columns]))
        return df.select(*by, stacked.alias("x")).select(*by, "x.which", "x.v", F.lit(sign).cast("bigint").alias("c"))

    rows = signed(after, 1) if before is None else signed(after, 1).unionByName(signed(before, -1))
    return rows.groupBy(*by, "which", "v").agg(F.sum("c").alias("c")).filter("c <> 0")


class DeltaCounts:
    """Counts under ``folder``, with the keys ``by``."""

    def __init__(self, spark: SparkSession, folder: str, by: tuple[str, ...] = ("node_path",)):
        self.spark, self.folder, self.by = spark, folder.rstrip("/"), by
        self.schema = ", ".join(f"{k} string" for k in by) + ", which string, v bigint, c bigint"

    def _last(self) -> dict:
        names = [n for n in storage.names(self.spark, f"{self.folder}/commits") if n.endswith(".json") and n[0] != "."]
        if not names:
            return {"number": 0, "attempts": [], "sources": {}}
        return json.loads(storage.read_text(self.spark, f"{self.folder}/commits/{names[-1]}"))

    def _write(self, rows: DataFrame) -> str:
        attempt = uuid.uuid4().hex
        rows.select(*self.by, "which", "v", "c").write.parquet(f"{self.folder}/attempts/{attempt}")
        return attempt

    def add(self, source: str, batch: int, changes: DataFrame) -> bool:
        """False if this batch of the source, or a later one, counts already."""
        last = self._last()
        if last["sources"].get(source, -1) >= batch:
            return False
        attempts = [*last["attempts"], self._write(changes)]
        if len(attempts) >= FOLD:
            attempts = [self._write(self._sums(attempts))]
        record = {"number": last["number"] + 1, "attempts": attempts, "sources": last["sources"] | {source: batch}}
        if not storage.create_once(self.spark, f"{self.folder}/commits/{record['number']:08d}.json", json.dumps(record)):
            raise RuntimeError("another batch was committed in the meantime; send this one again")
        return True

    def _sums(self, attempts: list[str]) -> DataFrame:
        if not attempts:
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(self.schema).parquet(*[f"{self.folder}/attempts/{a}" for a in attempts])
        return rows.groupBy(*self.by, "which", "v").agg(F.sum("c").alias("c")).filter("c <> 0")

    def read(self) -> DataFrame:
        """``*by, which, v, c``: how often each value holds now."""
        return self._sums(self._last()["attempts"])
