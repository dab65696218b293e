"""The corpus pipeline: quality rules, line dedup, near-duplicate join, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``docs`` is what the stage
before it kept, with the columns of ``documents``. Between stages the rows are written as
Parquet in the folder that all executors share and read again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runledger.llm import bin_slack, line_spread, rule_ledger, shingle_join
from runledger.llm.common import shared_folder

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules of the current policy."""
    return rule_ledger.ledger(docs.select(*COLUMNS)).filter(rule_ledger.passes("v1")).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without cross-site boilerplate; a document of nothing else goes, its first copy stays whole."""
    clean = line_spread.dedup(docs.select(*COLUMNS), more=line_spread.MORE)
    emptied = (F.col("n_removed") > 0) & (F.length(F.btrim("text", F.lit(rule_ledger.SPACE))) == 0)
    return clean.filter(~F.coalesce(emptied, F.lit(False))).select(
        "doc_id", "text", "lang", "source", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars")
    )


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each group of near copies; rows that repeat an id stay or go together."""
    classes = shingle_join.join(docs).filter("doc_id <> component_id").select("doc_id").distinct()
    return docs.select(*COLUMNS).join(classes, "doc_id", "left_anti").select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: each piece of a document with its place."""
    return bin_slack.pack(docs, bin_slack.ranks_path())


STAGES = [("quality_rules", quality), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("packing", packing)]

#: The near-duplicate join and the packing have no SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. What a stage read is deleted when it has written."""
    top = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = f"{top}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before is not None:
            hadoop(before).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop(before), True)
        before = path
    return docs
