"""N-gram Jaccard join: size-banded tiles, hashed bitmap signatures, exact check.

A document's set holds its distinct 5-word shingles (64-bit hashes); two link
at 100 |A & B| >= 80 |A | B|. The result is one row per document with its
component. Nothing is capped or sampled; every step below only drops pairs that
cannot link or are connected already.

1. Document frequencies of all shingles come from :mod:`block_counts`. A linked
   document shares at least ceil(0.8 n) of its n shingles, so one with fewer
   shingles of frequency two or more is alone. What is left is what has copies.
2. Equal sets collapse to one representative, the smallest id.
3. Prefix: in the order (frequency, hash) two linked sets share a shingle among
   their first n - ceil(0.8 n) + 1. Rare shingles come first, so a passage that
   very many documents share hardly opens a tile.
4. Pods: sets that agree in a min-hash are compared in groups of about ``POD``, a larger
   group being salted into several. A pod skips pairs that it has connected already and
   returns a forest of links, which connects most of a big group of near copies.
5. Tiles: a prefix shingle and a size band of ratio 1.25; a set stands in its own
   band and the next, so each pair whose sizes allow a link meets once for each
   shared shingle. A tile whose sets are all connected already is dropped, and only
   pairs of different components are looked at.
6. Each such pair meets first its bitmaps: the popcount of the difference of two hashed
   parity bitmaps, as wide as the tile's band asks, bounds the overlap from above. What
   passes gets an exact intersection of the sorted arrays.

Null, empty and white-space texts have empty sets and stay alone, as do rows with
a null id (their component is null). Where rows repeat an
id, each row is judged by its own set and named by that id; what one of them links with, the id links with. Fewer than five words make one shingle of the whole sequence.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import block_counts
from .block_counts import Block, mix
from .common import checkpointed, components, table, whole_ids

WORDS, PERCENT = 5, 80
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5], np.uint64)
#: Frequencies are counted by 48 bits of a shingle's hash. Where two shingles share
#: them, both only seem more frequent, for all documents alike, so no link is lost.
_COUNTED = ~np.uint64(0xFFFF)
_LEADERS = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)

SCHEMA = (
    "doc_id long, n_shingles long, fp string, hashes binary, prefix array<long>, leaders array<long>, "
    "band int, bits array<long>, bits_up array<long>"
)

#: Sets in a pod, about; and the number of crowded min-hashes up to which they are broadcast.
POD, BROADCAST_ROWS = 512, 100_000


def _need(n: int, percent: int) -> int:
    """Shingles that a set of n shares with any set it links with."""
    return -(-percent * n // 100)


def _sets(block: Block, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each document, one after another, and their ends."""
    h = block.hashes[block.tokens]
    factors = np.resize(_FACTORS, words) + np.arange(words, dtype=np.uint64) // np.uint64(5) * np.uint64(2)
    rolled = np.zeros(max(0, len(h) - words + 1), np.uint64)
    for j in range(words):
        rolled += h[j : j + len(rolled)] * factors[j]
    rolled = mix(rolled)
    sets, ends, total = [], [], 0
    for i, j in zip(block.starts.tolist(), block.ends.tolist(), strict=True):
        if j - i >= words:
            one = np.unique(rolled[i : j - words + 1])
        elif j > i:
            short = np.uint64(j - i) + (h[i:j] * factors[: j - i]).sum(dtype=np.uint64)
            one = mix(np.array([short ^ np.uint64(0xA5A5A5A5A5A5A5A5)], np.uint64))
        else:
            one = rolled[:0]
        sets.append(one)
        total += len(one)
        ends.append(total)
    return np.concatenate(sets) if sets else rolled[:0], np.array(ends, np.int64)


def size_band(n: int, percent: int) -> int:
    """Sets that may link are in the same band or in neighbouring ones."""
    return math.floor(math.log(n) / math.log(100 / percent) + 1e-9)


def bitmap(hashes: np.ndarray, band: int, percent: int) -> np.ndarray:
    """Parity bitmap as 64-bit words, with twice as many bits as a set of the band has hashes, or more."""
    bits = max(64, 1 << math.ceil(math.log2(2 * (100 / percent) ** (band + 1))))
    place = (mix(hashes) >> np.uint64(64 - bits.bit_length() + 1)).astype(np.int64)
    return np.packbits((np.bincount(place, minlength=bits) & 1).astype(np.uint8)).view(np.int64)


def overlap_bound(n_a, bits_a: np.ndarray, n_b, bits_b: np.ndarray):
    """No smaller than the number of common hashes of two sets (the last axis holds the words).

    Of signed words, numpy would count the bits of the absolute value.
    """
    return (n_a + n_b - np.bitwise_count((bits_a ^ bits_b).view(np.uint64)).sum(axis=-1, dtype=np.int64)) // 2


def links(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Exact, on sorted distinct hashes."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


def document_sets(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per document; ``fp`` names a set that may link, ``hashes`` and the rest come with its smallest id in a block."""

    def keys(block: Block):
        return np.unique(_sets(block, words)[0] & _COUNTED, return_counts=True)

    def finish(block: Block, k, totals, _stats):
        flat, ends = _sets(block, words)
        frequency = totals[np.searchsorted(k, flat & _COUNTED)] if len(flat) else np.empty(0, np.int64)
        cuts = [0, *ends.tolist()]
        spans = list(zip(block.ids.tolist(), block.known.tolist(), cuts, ends.tolist(), strict=False))
        names, least = [], {}
        for doc, known, i, j in spans:
            linkable = j > i and known and int((frequency[i:j] > 1).sum()) >= _need(j - i, percent)
            names.append(xxhash.xxh3_128_hexdigest(flat[i:j].astype("<u8").tobytes()) if linkable else None)
            if linkable:
                least[names[-1]] = min(doc, least.get(names[-1], doc))
        rows = []
        for (doc, known, i, j), name in zip(spans, names, strict=True):
            one, f, n = flat[i:j], frequency[i:j], j - i
            if name is None or least.get(name) != doc:  # alone, or not the one that stands for its set
                rows.append((doc if known else None, n, name, *[None] * 6))
                continue
            del least[name]
            order = np.lexsort((one, f))[: n - _need(n, percent) + 1]
            order = order[f[order] > 1]
            leaders = [int(mix(one * m).min().view(np.int64)) for m in _LEADERS]
            band = size_band(n, percent)
            bits = [bitmap(one, b, percent).tolist() for b in (band, band + 1)]
            rows.append((doc, n, name, one.astype("<u8").tobytes(), one[order].view(np.int64).tolist(), leaders, band, *bits))
        columns = ["doc_id", "n_shingles", "fp", "hashes", "prefix", "leaders", "band", "bits", "bits_up"]
        return pd.DataFrame(rows, columns=columns).astype({"doc_id": "Int64", "band": "Int32"})

    rows = docs.select(*whole_ids("doc_id"), F.lit(0).alias("flag"), "text").withColumnRenamed("doc_id", "id")
    return block_counts.exchange(rows, keys, finish, SCHEMA)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` that link, by exact intersection."""

    def exact(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            keep = [links(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"), percent) for x, y in zip(f["x"], f["y"], strict=True)]
            yield f.loc[np.array(keep, bool), ["a", "b"]]

    full = pairs.join(sets.select(F.col("rep").alias("a"), F.col("hashes").alias("x")), "a")
    full = full.join(sets.select(F.col("rep").alias("b"), F.col("hashes").alias("y")), "b")
    return full.select("a", "b", "x", "y").mapInPandas(exact, "a long, b long")


def _pods(sets: DataFrame, percent: int) -> DataFrame:
    """A forest of links ``(a, b)`` among sets that agree in a min-hash."""

    def forest(group: pd.DataFrame) -> pd.DataFrame:
        group = group.drop_duplicates(["rep", "fp"])  # an id may stand for several sets
        hashes = [np.frombuffer(x, "<u8") for x in group["hashes"]]
        n = np.array([len(x) for x in hashes])
        top = size_band(int(n.max()), percent)
        words = np.stack([bitmap(x, top, percent) for x in hashes])
        names, root, out = group["rep"].to_numpy(), np.arange(len(n)), []
        for i in range(len(n) - 1):
            rest = np.arange(i + 1, len(n))
            rest = rest[(root[rest] != root[i]) & (100 * np.minimum(n[rest], n[i]) >= percent * np.maximum(n[rest], n[i]))]
            bound = overlap_bound(n[rest], words[rest], n[i], words[i])
            for j in rest[(100 + percent) * bound >= percent * (n[rest] + n[i])].tolist():
                if root[j] != root[i] and links(hashes[i], hashes[j], percent):
                    out.append((names[i], names[j]))
                    root[root == root[j]] = root[i]
        return pd.DataFrame(out, columns=["a", "b"], dtype=np.int64)

    crowded = sets.select(F.explode("leaders").alias("key")).groupBy("key").count().filter(F.col("count") > POD)
    crowded = checkpointed(crowded.select("key", F.ceil(F.col("count") / F.lit(POD)).cast("long").alias("pods")))
    if crowded.count() <= BROADCAST_ROWS:
        crowded = F.broadcast(crowded)
    keyed = sets.select("rep", "fp", "hashes", F.explode("leaders").alias("key")).join(crowded, "key", "left")
    salt = F.pmod(F.xxhash64("rep", "key"), F.coalesce("pods", F.lit(1).cast("long")))
    return keyed.withColumn("salt", salt).drop("pods").groupBy("key", "salt").applyInPandas(forest, "a long, b long")


def join(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``."""
    rows = checkpointed(document_sets(docs, words, percent))
    reps = rows.filter("fp is not null").groupBy("fp").agg(F.min("doc_id").alias("rep"))
    # The arrays stay where they are; only what a step needs is moved.
    sets = rows.filter("hashes is not null").select(F.col("doc_id").alias("rep"), F.col("n_shingles").alias("n"), "*")
    mine = ["fp", "rep"]
    # Where an id stands for several sets, as its rows have different texts, they are told apart by a number, which is 0 for nearly all.
    reps = checkpointed(reps.withColumn("twin", F.row_number().over(Window.partitionBy("rep").orderBy("fp")) - 1))

    # Equal sets of several blocks hang on their representative.
    same = sets.select(F.col("rep").alias("b"), "fp").join(reps.select("fp", F.col("rep").alias("a")), "fp").select("a", "b")
    found = checkpointed(_pods(sets, percent).unionByName(same.filter("a <> b")).distinct())
    first = components(found).select(F.col("node").alias("rep"), "component")

    thin = sets.select("rep", "fp", "n", "prefix", "band").join(reps, mine).join(first, "rep", "left")
    thin = thin.withColumn("component", F.coalesce("component", "rep"))
    posted = (
        thin.select("rep", "twin", "n", "component", "band", F.explode("prefix").alias("shingle"))
        .withColumn("guest", F.explode(F.array(F.lit(False), F.lit(True))))
        .withColumn("tile", F.col("band") + F.col("guest").cast("int"))
        .drop("band")
    )
    mixed = posted.groupBy("shingle", "tile").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    mixed = mixed.filter("lo <> hi").select("shingle", "tile")
    posted = checkpointed(posted.join(mixed, ["shingle", "tile"], "left_semi"))
    bits = sets.select("rep", "fp", "bits", "bits_up").join(reps, mine).drop("fp")
    bits = bits.join(posted.select("rep", "twin").distinct(), ["rep", "twin"], "left_semi")
    tiles = posted.join(bits.dropDuplicates(["rep", "twin"]), ["rep", "twin"]).withColumn("bits", F.expr("if(guest, bits_up, bits)")).drop("bits_up")
    differ = "aggregate(zip_with(p.bits, q.bits, (x, y) -> bit_count(x ^ y)), 0, (total, x) -> total + x)"
    pairs = (
        tiles.alias("p")
        .join(tiles.alias("q"), ["shingle", "tile"])
        .filter(
            "p.rep < q.rep and p.component <> q.component and not (p.guest and q.guest)"
            f" and 100 * least(p.n, q.n) >= {percent} * greatest(p.n, q.n)"
            f" and {100 + percent} * ((p.n + q.n - {differ}) div 2) >= {percent} * (p.n + q.n)"
        )
        .select(F.col("p.rep").alias("a"), F.col("q.rep").alias("b"))
        .distinct()
    )
    pairs = checkpointed(pairs)
    found = found.unionByName(_verified(pairs, sets, percent))
    linked = components(found).select(F.col("node").alias("rep"), "component")
    return (
        rows.select("doc_id", "n_shingles", "fp")
        .join(reps.drop("twin"), "fp", "left")
        .join(linked, "rep", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "rep", "doc_id").alias("component_id"))
    )


def op10_shingle_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents"))


QUERIES = {"op10_shingle_tiles": op10_shingle_tiles}
ORACLES: dict[str, str] = {}
