"""Best-fit packing by minimum bin slack.

Every document is encoded, closed with an end token and, if longer than a
sequence, cut so that only its first piece may be short. Pieces are counted by
length: at most ``capacity`` lengths exist, whatever the corpus, so this histogram
is all that reaches the driver. There bins are planned a pattern at a time:
the longest length still available opens the bin, and a subset-sum programme over
bitsets of reachable fills finds the fullest combination of the lengths that are
left, each as often as it is available. The pattern is taken as many times as
its scarcest length allows and removed, so the number of patterns depends on the
capacity and not on the corpus. Pieces are then numbered within their length,
length and salt at a time, and a length's numbers map to bins and offsets by the
plan.

Null texts count as empty and hold the end token alone. Rows that repeat a doc_id
are packed row by row.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import checkpointed, nullable, partitions, table, whole_ids

CAPACITY, END_ID = 1024, 2
#: Slacks that a bin may be left with while planning; the plan with the fewest bins is taken.
SLACKS = (0, 1, 2, 3, 4, 6, 8, 12, 16, 24, 32)
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
SPECIAL = "<|endoftext|>"  # fixed value: the vocabulary's only special string, id 50256
SPECIAL_ID = 50256
#: What the pattern's \s matches. tiktoken's matcher backtracks over a run of it and fails beyond about
#: 700,000 characters, so runs of LONG_RUN characters or more are cut out before.
SPACES = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
LONG_RUN = 100_000

_ENCODERS: dict = {}


def encoder(path: str):
    """Text to ids as the tokenizers library gives them with ``byte_bpe_50k.json``.

    They come from tiktoken instead, with the same vocabulary as the rank file at ``path``.
    """
    if path not in _ENCODERS:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        pattern = public_tokenizers.PATTERN
        _ENCODERS[path] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={SPECIAL: SPECIAL_ID})
    plain = _ENCODERS[path]

    def with_long_runs(text: str) -> list[int]:
        out = []
        for k, part in enumerate(text.split(SPECIAL)):
            if k:
                out.append(SPECIAL_ID)
            at = 0
            for run in SPACES.finditer(part):
                if run.end() - run.start() >= LONG_RUN:
                    # The pattern takes a run as one piece, but for its last character where more text follows.
                    stop = run.end() - (run.end() < len(part))
                    out += plain.encode_ordinary(part[at : run.start()])
                    out += plain._encode_single_piece(part[run.start() : stop])
                    at = stop
            out += plain.encode_ordinary(part[at:])
        return out

    def ids(text: str | None) -> list[int]:
        if not text:
            return []
        if len(text) >= LONG_RUN:
            return with_long_runs(text)
        if SPECIAL in text:
            return plain.encode(text, allowed_special={SPECIAL}, disallowed_special=())
        return plain.encode_ordinary(text)

    return ids


def ranks_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of n ids; only the first may be shorter than the capacity."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(at, capacity) for at in range(first, n, capacity)]


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(path)
        for f in frames:
            rows = []
            for doc, no_id, text in zip(f["doc_id"], f["no_id"], f["text"], strict=True):
                ids = np.array([*encode(text), END_ID], "<u4")
                for k, (start, length) in enumerate(cut(len(ids), capacity)):
                    rows.append((doc, no_id, k, start, length, zlib.crc32(ids[start : start + length].tobytes())))
            out = pd.DataFrame(rows, columns=["doc_id", "no_id", "piece", "start", "length", "ids_crc32"])
            yield out.assign(doc_id=nullable(out["doc_id"], out["no_id"])).drop(columns="no_id")

    return docs.select(*whole_ids("doc_id"), "text").mapInPandas(run, PIECES)


def fullest(available: dict[int, int], capacity: int, slack: int = 0) -> dict[int, int]:
    """The longest length available, and with it the combination that leaves the least slack.

    Lengths join in descending order, and the search ends as soon as no more
    than ``slack`` is left, which saves the short ones for later bins.
    """
    lengths = sorted(available, reverse=True)
    bin_ = {lengths[0]: 1}
    room = capacity - lengths[0]
    mask = (1 << (room + 1)) - 1
    reach = [1]
    used = []
    for length in lengths:
        if length > room:
            continue
        copies = min(available[length] - bin_.get(length, 0), room // length)
        now, step = reach[-1], 1
        while copies > 0:  # copies in binary steps
            take = min(step, copies)
            now |= (now << (take * length)) & mask
            copies -= take
            step *= 2
        if now != reach[-1]:
            reach.append(now)
            used.append(length)
        if now >> max(0, room - slack):
            break
    fill = reach[-1].bit_length() - 1
    for k in range(len(used) - 1, -1, -1):
        while fill and not reach[k] >> fill & 1:
            fill -= used[k]
            bin_[used[k]] = bin_.get(used[k], 0) + 1
    return bin_


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """``(times, {length: copies})`` until nothing is left: the best plan of some admitted slacks."""
    least = -(-sum(length * n for length, n in histogram.items()) // capacity)
    best, fewest = [], None
    for slack in SLACKS:
        found = _plan(histogram, capacity, slack)
        bins = sum(times for times, _ in found)
        if fewest is None or bins < fewest:
            best, fewest = found, bins
        if fewest == least:
            break
    return best


def _plan(histogram: dict[int, int], capacity: int, slack: int) -> list[tuple[int, dict[int, int]]]:
    left = {length: n for length, n in histogram.items() if n}
    out = []
    while left:
        pattern = fullest(left, capacity, slack)
        times = min(left[length] // copies for length, copies in pattern.items())
        out.append((times, pattern))
        for length, copies in pattern.items():
            left[length] -= times * copies
            if not left[length]:
                del left[length]
    return out


def segments(patterns: list[tuple[int, dict[int, int]]]) -> list[tuple[int, int, int, int, int, int]]:
    """``(length, first, last, bin, copies, offset)``: numbers first..last-1 of a length go to the bins from ``bin`` on."""
    out, taken, bins = [], {}, 0
    for times, pattern in patterns:
        offset = 0
        for length, copies in pattern.items():
            first = taken.get(length, 0)
            taken[length] = first + times * copies
            out.append((length, first, taken[length], bins, copies, offset))
            offset += length * copies
        bins += times
    return out


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of ``docs`` with their ``sequence_id`` and ``offset``."""
    spark = docs.sparkSession
    cuts = checkpointed(pieces(docs, path, capacity))
    # At most `capacity` rows.
    histogram = {r["length"]: r["n"] for r in cuts.groupBy("length").agg(F.count("*").alias("n")).collect()}
    parts = segments(plan(histogram, capacity))
    schema = "length long, first long, last long, bin long, copies long, at long"
    where = spark.createDataFrame(parts, schema)

    salt = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(4 * partitions(spark)))
    salted = cuts.withColumn("salt", salt)
    counts = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32", "start")
    numbered = (
        salted.withColumn("k", F.row_number().over(inside) - 1)
        .join(base, ["length", "salt"])
        .withColumn("number", F.col("base") + F.col("k"))
    )
    # Patterns times lengths of a pattern: bounded by the capacity alone.
    placed = numbered.join(F.broadcast(where), "length").filter("first <= number and number < last")
    k = F.col("number") - F.col("first")
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("bin") + F.floor(k / F.col("copies"))).cast("long").alias("sequence_id"),
        (F.col("at") + F.pmod(k, F.col("copies")) * F.col("length")).cast("long").alias("offset"),
    )


def op5_bin_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), ranks_path())


QUERIES = {"op5_bin_slack": op5_bin_slack}
ORACLES: dict[str, str] = {}
