"""URL filters over a sorted digest array.

Rules are ``host/path-prefix`` strings. A rule fits its host and all subdomains where the
url's path starts with the rule's; the longest wins. The keys' 64-bit xxhash values are
kept as one sorted array in a file that every worker maps into memory, so the workers
of an executor share one copy. A url probes with each parent domain of its host joined
with each prefix of its path whose length some rule has; all probes of a batch go
through one vectorised binary search, and each hit is confirmed against the stored full
string, since two strings may share a digest.

The file is sent by ``SparkContext.addFile`` and must stay below ``MAX_BYTES``; larger rule
tables are joined by key instead (:func:`judge_by_join`), which needs no bound. Rules may be a list or a
DataFrame (``host, path, action``), which reaches the driver only where it is below the bound. Both ways answer alike: the longest rule wins; of rules as long, the one with the
longer host; and of a rule that is given with both actions, block.

A null url, or one without ``://``, has an empty host and path, which no rule fits.
Repeated rows are judged alike; extra columns are carried along.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

MAX_BYTES = 64 << 20
ALLOW, BLOCK = 0, 1

# The rules of the query, and domains that are blocked where no rule fits.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
BLOCKED_NAMES = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
BLOCKED_DOMAINS = tuple(f"{name}.example.{top}" for name in BLOCKED_NAMES for top in ("com", "net", "org"))


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    found = F.regexp_extract(_rest(url), r"(?s)^([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"(?s)^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


class DigestArray:
    """A file of sorted digests with the strings and values behind them, mapped into memory.

    Layout, all little-endian 64-bit but the strings: number of keys n, n digests,
    n + 1 offsets, n values, then the strings.
    """

    def __init__(self, file: str):
        data = np.memmap(file, np.uint8, "r")
        n = int(data[:8].view("<i8")[0])
        ends = np.cumsum([8, 8 * n, 8 * (n + 1), 8 * n])
        self.digests = data[8 : ends[1]].view("<u8")
        self.offsets = data[ends[1] : ends[2]].view("<i8")
        self.values = data[ends[2] : ends[3]].view("<i8")
        self.strings = data[ends[3] :]

    @staticmethod
    def packed(entries: Iterable[tuple[bytes, int]]) -> bytes:
        """The file of ``(key, value)``. A repeated key keeps its greatest value."""
        kept: dict[bytes, int] = {}
        for k, v in entries:
            kept[k] = max(v, kept.get(k, v))
        rows = sorted((xxhash.xxh64_intdigest(k), k, v) for k, v in kept.items())
        parts = (
            np.array([len(rows)], "<i8"),
            np.array([d for d, _, _ in rows], "<u8"),
            np.cumsum([0, *(len(k) for _, k, _ in rows)], dtype="<i8"),
            np.array([v for _, _, v in rows], "<i8"),
        )
        return b"".join(a.tobytes() for a in parts) + b"".join(k for _, k, _ in rows)

    def find(self, keys: Sequence[bytes]) -> np.ndarray:
        """Place of each key, -1 where there is none."""
        asked = np.fromiter(map(xxhash.xxh64_intdigest, keys), np.uint64, len(keys))
        lo = np.searchsorted(self.digests, asked, "left")
        hi = np.searchsorted(self.digests, asked, "right")
        out = np.full(len(keys), -1, np.int64)
        for k in np.nonzero(hi > lo)[0]:
            for at in range(lo[k], hi[k]):  # several only where digests collide
                if self.strings[self.offsets[at] : self.offsets[at + 1]].tobytes() == keys[k]:
                    out[k] = at
                    break
        return out


def probes(name: str, where: str, lengths: Sequence[int]) -> list[str]:
    """Keys that may name a rule for this host and path, longest first."""
    labels = name.split(".")
    domains = [".".join(labels[k:]) for k in range(len(labels))] if name else []
    return [f"{d}{where[:n]}" for d in domains for n in lengths if n <= len(where) and d]


def _order(rule: str) -> tuple[int, int]:
    """Which of the rules that fit wins: the greatest."""
    return len(rule), len(rule.partition("/")[0])


def judge(df: DataFrame, rules=RULES, blocked=BLOCKED_DOMAINS, url: str = "url") -> DataFrame:
    """``df`` with ``host, path, rule, verdict``."""
    spark = df.sparkSession
    if isinstance(rules, DataFrame):
        size = rules.agg(F.sum(F.length("host") + F.length("path") + 32)).first()[0] or 0
        if size > MAX_BYTES:
            return judge_by_join(df, rules, blocked, url)
        rules = [tuple(r) for r in rules.select("host", "path", "action").collect()]
    rules = list(rules)
    lengths = sorted({len(p) for _, p, _ in rules}, reverse=True)
    # Two lists in one array: a rule's value is its action, a blocked domain's is told by its prefix.
    entries = [(f"r {h}{p}".encode(), BLOCK if a == "block" else ALLOW) for h, p, a in rules]
    entries += [(f"b {d}".encode(), BLOCK) for d in blocked]
    data = DigestArray.packed(entries)
    if len(data) > MAX_BYTES:
        return judge_by_join(df, rules, blocked, url)
    name = f"digests-{xxhash.xxh3_128_hexdigest(data)}.bin"
    sc = spark.sparkContext
    if not any(f.endswith(f"/{name}") for f in sc.listFiles):  # named by its content: sent once a session
        file = os.path.join(tempfile.mkdtemp(prefix="digests-"), name)
        with open(file, "wb") as f:
            f.write(data)
        sc.addFile(file)  # Spark copies it to every executor, also to later ones
    named = df.withColumn("host", host(F.col(url))).withColumn("path", path(F.col(url)))

    def look(frames: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        index = DigestArray(SparkFiles.get(name))
        for hosts, paths in frames:
            keys, owner, kind = [], [], []
            for row, (h, p) in enumerate(zip(hosts, paths, strict=True)):
                mine = probes(h, p, lengths)
                keys += [f"r {k}".encode() for k in mine]
                kind += [0] * len(mine)
                owner += [row] * len(mine)
                mine = probes(h, "", (0,))
                keys += [f"b {k}".encode() for k in mine]
                kind += [1] * len(mine)
                owner += [row] * len(mine)
            at = index.find(keys)
            rule: list[str | None] = [None] * len(hosts)
            verdict = ["allow"] * len(hosts)
            for k in np.nonzero(at >= 0)[0]:
                row, said = owner[k], "block" if index.values[at[k]] == BLOCK else "allow"
                text = keys[k][2:].decode()
                if kind[k] == 0:
                    if rule[row] is None or _order(text) > _order(rule[row]):
                        rule[row], verdict[row] = text, said
                elif rule[row] is None:
                    verdict[row] = said
            yield pd.DataFrame({"rule": rule, "verdict": verdict})

    apply = F.pandas_udf(look, "rule string, verdict string")
    return named.withColumn("_found", apply("host", "path")).select(
        *[c for c in named.columns if c not in ("rule", "verdict")], "_found.rule", "_found.verdict"
    )


def judge_by_join(df: DataFrame, rules, blocked=BLOCKED_DOMAINS, url: str = "url") -> DataFrame:
    """The same verdicts by a join on probe keys, for rule tables beyond ``MAX_BYTES``."""
    spark = df.sparkSession
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame([tuple(r) for r in rules], "host string, path string, action string")
    lengths = [r.n for r in rules.select(F.length("path").alias("n")).distinct().collect()]  # as many as paths have lengths
    bad = spark.createDataFrame([(d,) for d in blocked], "key string").select(F.lit(1).alias("kind"), "key", F.lit("block").alias("said"))
    # "block" is the greater word.
    known = rules.select(F.lit(0).alias("kind"), F.concat("host", "path").alias("key"), F.col("action").alias("said")).unionByName(bad)
    known = known.groupBy("kind", "key").agg(F.max("said").alias("said"))
    named = df.withColumn("host", host(F.col(url))).withColumn("path", path(F.col(url)))
    pairs = named.select("host", "path").distinct()
    labels = F.split("host", "\\.")
    domains = F.expr("filter(transform(sequence(1, size(_l)), i -> array_join(slice(_l, i, size(_l)), '.')), d -> d <> '')")
    cut = ", ".join(f"if(length(path) >= {n}, concat(_d, substr(path, 1, {n})), null)" for n in lengths) or "cast(null as string)"
    asked = pairs.withColumn("_l", labels).withColumn("_d", F.explode(domains))
    asked = asked.withColumn("_k", F.explode(F.expr(f"array_compact(array({', '.join(['struct(1 as kind, _d as key)'])}))")))
    asked = asked.select("host", "path", "_k.kind", "_k.key").unionByName(
        pairs.withColumn("_l", labels)
        .withColumn("_d", F.explode(domains))
        .withColumn("key", F.explode(F.expr(f"array_compact(array({cut}))")))
        .select("host", "path", F.lit(0).alias("kind"), "key")
    )
    hits = asked.join(known, ["kind", "key"])
    best = hits.groupBy("host", "path").agg(
        F.max(F.when(F.col("kind") == 0, F.struct(F.length("key").alias("n"), F.length(F.substring_index("key", "/", 1)).alias("h"), "key", "said"))).alias("r"),
        F.max(F.when(F.col("kind") == 1, F.col("said"))).alias("b"),
    )
    verdict = F.coalesce("r.said", "b", F.lit("allow"))
    keep = [c for c in named.columns if c not in ("rule", "verdict")]
    return named.join(best, ["host", "path"], "left").select(*keep, F.col("r.key").alias("rule"), verdict.alias("verdict"))


def op7_url_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


def _oracle() -> str:
    rules = ", ".join(f"('{h}', '{p}', '{a}')" for h, p, a in RULES)
    blocked = ", ".join(f"('{d}')" for d in BLOCKED_DOMAINS)
    return f"""
WITH rules(h, p, said) AS (VALUES {rules}), blocked(d) AS (VALUES {blocked}),
r AS (SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
u AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
hit AS (SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(said, length(h || p)) AS said
        FROM u, rules WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
SELECT u.page_id, host, path, hit.rule AS rule,
       CASE WHEN hit.rule IS NOT NULL THEN hit.said
            WHEN EXISTS (SELECT 1 FROM blocked WHERE host = d OR ends_with(host, '.' || d)) THEN 'block' ELSE 'allow' END AS verdict
FROM u LEFT JOIN hit ON u.page_id = hit.page_id
"""


QUERIES = {"op7_url_digest": op7_url_digest}
ORACLES = {"op7_url_digest": _oracle()}
