"""Token counts by delta-maintained rollups.

A change is an insert, a delete or a revised count of one document. Signed rows carry it:
an insert adds ``(+1, +n)``, a delete ``(-1, -n)``, a revision the difference of the counts. All
totals are sums, so a batch of changes shrinks to one row for each (source, language,
tokenizer version) before it meets the store, and the store never sees a text again.

The store is a folder in the file system that all executors share. An attempt to add a batch writes its sums into a folder of its own; the batch counts
when a commit record names that attempt and a digest of its sums. Records are numbered, hold all that counts, and are created once,
never replaced: whoever reads sees one record's batches, whole, and a crash at any point leaves the last record as it was. A batch that is sent again, after
a crash or by mistake, has the same digest and adds no record; with other sums it replaces itself. Batches may arrive in
any order. :meth:`Rollup.compact` folds batches into one; their names and digests stay known.

Grouping is by three columns of few values; it sums in every task before the shuffle, so a
source with a third of all rows costs one row a task. Null sources and languages
are groups of their own (null); null counts count as 0; null texts have no tokens. In the query a row with a null
doc_id is no copy and has none; it is recounted like the rest. Rows that repeat an id with the same text are the first one each.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import storage
from . import bin_slack
from .common import checkpointed, shared_folder, table

KEYS = ("source", "lang", "tokenizer")


def inserts(df: DataFrame, count: Column) -> DataFrame:
    """Signed rows of new documents; ``df`` has the key columns."""
    return _signed(df, F.lit(1), count)


def deletes(df: DataFrame, count: Column) -> DataFrame:
    return _signed(df, F.lit(-1), -count)


def revisions(df: DataFrame, old: Column, new: Column) -> DataFrame:
    """Signed rows of documents that stay, with another count."""
    return _signed(df, F.lit(0), F.coalesce(new, F.lit(0)) - F.coalesce(old, F.lit(0)))


def _signed(df: DataFrame, docs: Column, tokens: Column) -> DataFrame:
    keys = [F.col(k) for k in KEYS]
    return df.select(*keys, docs.cast("long").alias("d_docs"), F.coalesce(tokens, F.lit(0)).cast("long").alias("d_tokens"))


class Rollup:
    """Totals under ``folder``, kept by batches of signed rows."""

    SCHEMA = "source string, lang string, tokenizer string, d_docs long, d_tokens long"

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _last(self) -> dict:
        """``number``; ``batches``: name -> [attempt, digest]; ``folded``: names and digests that ``base`` holds."""
        names = [n for n in storage.names(self.spark, f"{self.folder}/commits") if n.endswith(".json") and n[0] != "."]
        if not names:
            return {"number": 0, "batches": {}, "folded": {}, "base": None}
        return json.loads(storage.read_text(self.spark, f"{self.folder}/commits/{names[-1]}"))

    def _publish(self, record: dict) -> None:
        record = record | {"number": record["number"] + 1}
        if not storage.create_once(self.spark, f"{self.folder}/commits/{record['number']:08d}.json", json.dumps(record)):
            raise RuntimeError("another batch was committed in the meantime; send this one again")

    def _write(self, changes: DataFrame) -> tuple[str, str]:
        """An attempt and the digest of its sums."""
        attempt = uuid.uuid4().hex
        sums = changes.groupBy(*KEYS).agg(F.sum("d_docs").alias("d_docs"), F.sum("d_tokens").alias("d_tokens"))
        sums.write.parquet(f"{self.folder}/attempts/{attempt}")
        back = self.spark.read.schema(self.SCHEMA).parquet(f"{self.folder}/attempts/{attempt}").filter("d_docs <> 0 or d_tokens <> 0")
        digest = back.agg(F.count("*"), F.sum(F.xxhash64(*back.columns).cast("decimal(38,0)"))).first()
        return attempt, f"{digest[0]}-{digest[1]}"

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Add a batch of signed rows; again under the same name replaces it. False: it counted already, with the same sums."""
        if not batch or not all(c.isalnum() or c in "-_" for c in batch):
            raise ValueError("a batch name holds letters, digits, - and _")
        attempt, digest = self._write(changes)
        last = self._last()
        known = last["batches"].get(batch, [None, last["folded"].get(batch)])[1]
        if known == digest:
            storage.delete(self.spark, f"{self.folder}/attempts/{attempt}")
            return False
        if batch in last["folded"]:
            raise ValueError(f"{batch} has been compacted and cannot be replaced")
        self._publish(last | {"batches": last["batches"] | {batch: [attempt, digest]}})
        return True

    def batches(self) -> list[str]:
        """Names of the committed batches."""
        last = self._last()
        return sorted([*last["batches"], *last["folded"]])

    def compact(self) -> None:
        """Fold all batches into one attempt."""
        last = self._last()
        attempt, _ = self._write(self._rows(last))
        folded = last["folded"] | {name: digest for name, (_, digest) in last["batches"].items()}
        self._publish(last | {"batches": {}, "folded": folded, "base": attempt})

    def _rows(self, record: dict) -> DataFrame:
        attempts = [a for a, _ in record["batches"].values()] + ([record["base"]] if record["base"] else [])
        if not attempts:
            return self.spark.createDataFrame([], self.SCHEMA)
        return self.spark.read.schema(self.SCHEMA).parquet(*[f"{self.folder}/attempts/{a}" for a in attempts])

    def totals(self) -> DataFrame:
        """``source, lang, tokenizer, n_docs, n_tokens`` over all committed batches; groups without documents go."""
        sums = self._rows(self._last()).groupBy(*KEYS).agg(F.sum("d_docs").alias("n_docs"), F.sum("d_tokens").alias("n_tokens"))
        return sums.filter("n_docs <> 0 or n_tokens <> 0")


def bpe_counts(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` without its text, with the number of its tokens as ``n_tokens``."""
    rest = [c for c in docs.columns if c != "text"]
    size = F.pandas_udf(_counter(path), "long")
    return docs.select(*rest, size("text").alias("n_tokens"))


def _counter(path: str):
    def count(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = bin_slack.encoder(path)
        for part in texts:
            yield pd.Series(np.fromiter((len(encode(t)) for t in part), np.int64, len(part)))

    return count


def op6_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after a load of all documents under two tokenizers, a dedup and a recount, one batch sent twice.

    ``load`` inserts every document, under ``words-1`` (white-space words) and ``bpe50k-1``.
    ``dedup`` deletes each document whose text another document with a smaller id has, from
    ``words-1`` alone. ``recount`` revises ``words-1`` of the rest by the end token that
    a sequence needs. ``dedup`` then arrives once more.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    text = F.coalesce(F.col("text"), F.lit(""))
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\f\r"))
    words = F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, "[ \\t\\n\\x0B\\f\\r]+")))
    ready = docs.select(
        "doc_id", "source", "lang", "text", words.cast("long").alias("words"), F.xxhash64(text).alias("h1"), F.crc32(text.cast("binary")).alias("h2")
    )
    # Two hashes and the length stand for the text, which is not shuffled.
    ready = checkpointed(bpe_counts(ready, bin_slack.ranks_path()))
    words_1 = ready.withColumn("tokenizer", F.lit("words-1"))
    bpe_1 = ready.withColumn("tokenizer", F.lit("bpe50k-1"))
    same = ["h1", "h2", "words", "n_tokens"]
    # A table of its own, so that Spark can split the join where one text has very many copies.
    first = checkpointed(ready.groupBy(*same).agg(F.min("doc_id").alias("first")))
    marked = words_1.join(first, same, "left")
    copy = F.coalesce(F.col("doc_id") != F.col("first"), F.lit(False))
    copies, rest = marked.filter(copy), marked.filter(~copy)

    store = Rollup(spark, f"{shared_folder(spark)}/rollup-{uuid.uuid4().hex}")
    store.commit("load", inserts(words_1, F.col("words")).unionByName(inserts(bpe_1, F.col("n_tokens"))))
    store.commit("dedup", deletes(copies, F.col("words")))
    store.commit("recount", revisions(rest, F.col("words"), F.col("words") + 1))
    store.commit("dedup", deletes(copies, F.col("words")))
    return store.totals()


QUERIES = {"op6_token_rollup": op6_token_rollup}
ORACLES: dict[str, str] = {}
