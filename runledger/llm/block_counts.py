"""Corpus-wide counts of hashed keys without a row per key.

Counting every n-gram of a corpus as one Spark row per n-gram would move many
times the input. Here each task gathers documents into blocks of a bounded
number of tokens, sorts the distinct 64-bit keys of a block once, and sends
them as packed arrays, one row per (block, key range). Each key range is
summed in one group, and the totals return to the blocks that asked, aligned
with the keys they sent. There they meet the block's own text, packed as token
numbers by a second reading of the input, so that text is shuffled only once.
Spark does the partitioning and both shuffles; keys are spread by hash, so a
frequent word or passage weighs no more than one entry a block.

Block numbers come from the partition number, a counter and a checksum of the ids.
The input's partitions must be the same whenever they are computed, as they are for
files; then a task that runs again after a lost executor makes the same blocks. If
the two readings differed, a block would lack its text or its totals, which raises.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions

#: Tokens in a block; a single longer document is a block by itself. A block sends one row to
#: each key range, so for inputs of many terabytes raise it as far as workers' memory allows.
BLOCK_TOKENS = 1_000_000
#: Input bytes for each key range, about; there are four ranges a shuffle partition at least.
RANGE_BYTES = 64 << 20
ROWS = "block long, shard int, kind int, part int, a binary, b binary"
COLUMNS = ["block", "shard", "kind", "part", "a", "b"]
KEYS, REPLY, TEXT = 0, 1, 2

_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finaliser of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * _MIX[0]
    h = (h ^ (h >> np.uint64(27))) * _MIX[1]
    return h ^ (h >> np.uint64(31))


def words_of(text: str | None) -> list[bytes]:
    """Lower-case A-Z, then split at ASCII white space (20, 09-0D)."""
    return text.encode("utf-8", "replace").lower().split() if text else []


class _Vocabulary(dict):
    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


class Block:
    """Documents as token numbers: ``tokens[ends[i-1]:ends[i]]`` is document i.

    ``hashes[t]`` is the 64-bit hash of token number ``t``. ``ids`` are the
    document ids (``known`` is false where the id was null), ``flags`` is one
    small integer a document for the caller.
    """

    def __init__(self, ids, known, flags, ends, tokens, hashes):
        self.ids, self.known, self.flags = ids, known, flags
        self.ends, self.tokens, self.hashes = ends, tokens, hashes

    @property
    def starts(self) -> np.ndarray:
        return np.concatenate(([0], self.ends[:-1])).astype(np.int64)

    def pack(self) -> bytes:
        parts = [
            self.ids.astype("<i8").tobytes(),
            self.known.astype("u1").tobytes(),
            self.flags.astype("u1").tobytes(),
            self.ends.astype("<i8").tobytes(),
            _planes(self.tokens.astype("<u4")),
            self.hashes.astype("<u8").tobytes(),
        ]
        head = np.array([len(self.ids), len(self.tokens), len(self.hashes)], "<i8").tobytes()
        return zstandard.ZstdCompressor(level=1).compress(head + b"".join(parts))

    @classmethod
    def unpack(cls, data: bytes) -> Block:
        data = zstandard.ZstdDecompressor().decompress(data)
        d, t, h = (int(x) for x in np.frombuffer(data, "<i8", 3))
        at = 24
        out = []
        for kind, n in (("<i8", d), ("u1", d), ("u1", d), ("<i8", d), ("planes", t), ("<u8", h)):
            if kind == "planes":
                out.append(_unplanes(data[at : at + 4 * n], "<u4"))
                at += 4 * n
            else:
                out.append(np.frombuffer(data, kind, n, at))
                at += n * np.dtype(kind).itemsize
        return cls(*out)


def _planes(x: np.ndarray) -> bytes:
    """Bytes by place value: high bytes are mostly equal and compress well."""
    width = x.dtype.itemsize
    return np.ascontiguousarray(x.view("u1").reshape(-1, width).T).tobytes()


def _unplanes(data: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, "u1").reshape(width, -1).T).view(kind).ravel()


#: Low bytes of a difference that are as good as random and stay as they are; those above are small numbers.
_RANDOM_BYTES = 5


def _pack_sorted(keys: np.ndarray) -> bytes:
    """Sorted distinct keys as differences; their high bytes, whose values are uneven, go through an entropy coder."""
    planes = _planes(np.diff(keys, prepend=np.uint64(0)).astype("<u8"))
    low = _RANDOM_BYTES * len(keys)
    return np.array([len(keys)], "<i8").tobytes() + planes[:low] + zstandard.ZstdCompressor(level=1).compress(planes[low:])


def _unpack_sorted(data: bytes) -> np.ndarray:
    low = 8 + _RANDOM_BYTES * int(np.frombuffer(data, "<i8", 1)[0])
    planes = data[8:low] + zstandard.ZstdDecompressor().decompress(data[low:])
    return np.cumsum(_unplanes(planes, "<u8"), dtype=np.uint64)


def _pack_counts(counts: np.ndarray) -> bytes:
    kind = "<u4" if counts.max(initial=0) < 1 << 32 else "<u8"
    packed = zstandard.ZstdCompressor(level=1).compress(_planes(counts.astype(kind)))
    return bytes([np.dtype(kind).itemsize]) + packed


def _unpack_counts(data: bytes) -> np.ndarray:
    return _unplanes(zstandard.ZstdDecompressor().decompress(data[1:]), f"<u{data[0]}").astype(np.int64)


def _edges(shards: int) -> np.ndarray:
    return np.array([(s << 64) // shards for s in range(1, shards)], np.uint64)


def _blocks(frames: Iterator[pd.DataFrame], end: bytes | None) -> Iterator[Block]:
    vocabulary, ids, known, flags, ends, tokens, total = _Vocabulary(), [], [], [], [], [], 0

    def made() -> Block:
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in vocabulary), np.uint64, len(vocabulary))
        text = np.concatenate(tokens) if tokens else np.empty(0, np.uint32)
        # Numbers by frequency: small ones are frequent, so that the text packs well.
        by = np.argsort(-np.bincount(text, minlength=len(hashes)), kind="stable")
        rank = np.empty(len(by), np.uint32)
        rank[by] = np.arange(len(by), dtype=np.uint32)
        return Block(
            np.array(ids, np.int64), np.array(known, np.uint8), np.array(flags, np.uint8), np.array(ends, np.int64),
            rank[text], hashes[by],
        )

    for frame in frames:
        for doc, no_id, flag, text in zip(frame["id"], frame["no_id"], frame["flag"], frame["text"], strict=True):
            words = words_of(text)
            if end is not None:
                words.append(end)
            if total and total + len(words) > BLOCK_TOKENS:
                yield made()
                vocabulary, ids, known, flags, ends, tokens, total = _Vocabulary(), [], [], [], [], [], 0
            tokens.append(np.fromiter(map(vocabulary.__getitem__, words), np.uint32, len(words)))
            total += len(words)
            ids.append(doc)
            known.append(not no_id)
            flags.append(flag)
            ends.append(total)
    if ids:
        yield made()


def _ranges(docs: DataFrame) -> int:
    """Number of key ranges: so many that the keys of one fit into a task, by the input's size where Spark knows it."""
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    known = size if size < 1 << 60 else 0  # a plan of unknown size claims the largest number
    return max(4 * partitions(docs.sparkSession), known // RANGE_BYTES)


def exchange(
    docs: DataFrame,
    keys: Callable[[Block], tuple[np.ndarray, ...]],
    finish: Callable[..., pd.DataFrame],
    schema: str,
    end: bytes | None = None,
) -> DataFrame:
    """``finish`` of every block, with corpus-wide totals of the block's keys.

    ``docs``: columns ``id`` long, ``no_id`` boolean, ``flag`` int, ``text``.
    ``keys(block)``: sorted distinct uint64 keys, their counts in the block, and whatever ``finish`` is to be given.
    ``finish(block, keys, totals, (sum, distinct), ...)``: the pair holds the
    total and the number of odd keys whose total is positive, corpus-wide.
    ``end``: a token added to every document.
    """
    shards = _ranges(docs)

    def numbered(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[int, Block]]:
        frames = iter(frames)
        head = next((f for f in frames if len(f)), None)
        if head is None:
            return
        partition = int(head["partition"].iloc[0])
        for n, block in enumerate(_blocks(itertools.chain([head], frames), end)):
            name = np.array([partition, n], "<i8").tobytes() + block.ids.tobytes()
            yield xxhash.xxh3_64_intdigest(name) >> 1, block

    def send(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for number, block in numbered(frames):
            k, c, *_ = keys(block)
            cuts = [0, *np.searchsorted(k, _edges(shards)).tolist(), len(k)]
            rows = [
                (number, s, KEYS, 0, _pack_sorted(k[i:j]), _pack_counts(c[i:j]))
                for s, (i, j) in enumerate(zip(cuts, cuts[1:], strict=False))
            ]
            yield pd.DataFrame(rows, columns=COLUMNS)

    def bring(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for number, block in numbered(frames):
            yield pd.DataFrame([(number, -1, TEXT, 0, block.pack(), b"")], columns=COLUMNS)

    def total(group: pd.DataFrame) -> pd.DataFrame:
        sent = [_unpack_sorted(x) for x in group["a"]]
        counts = np.concatenate([_unpack_counts(x) for x in group["b"]])
        distinct, place = np.unique(np.concatenate(sent), return_inverse=True)
        totals = np.zeros(len(distinct), np.int64)
        np.add.at(totals, place, counts)
        odd = totals[(distinct & np.uint64(1)).astype(bool)]
        stats = np.array([odd.sum(), (odd > 0).sum()], "<i8").tobytes()
        cuts = np.cumsum([0, *map(len, sent)])
        replies = [_pack_counts(totals[place[i:j]]) for i, j in zip(cuts, cuts[1:], strict=False)]
        return group.assign(kind=REPLY, part=group["shard"], a=replies, b=stats)

    def close(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("part")
        text, reply = group[group["kind"] == TEXT], group[group["kind"] == REPLY]
        if len(text) != 1 or len(reply) != shards:
            raise RuntimeError("the input's partitions changed between two readings; checkpoint it first")
        block = Block.unpack(text["a"].iloc[0])
        stats = np.array([np.frombuffer(x, "<i8") for x in reply["b"]]).sum(axis=0)
        k, _, *more = keys(block)
        totals = np.concatenate([_unpack_counts(x) for x in reply["a"]])
        return finish(block, k, totals, (int(stats[0]), int(stats[1])), *more)

    docs = docs.select("id", "no_id", "flag", "text", F.spark_partition_id().alias("partition"))
    replied = docs.mapInPandas(send, ROWS).groupBy("shard").applyInPandas(total, ROWS)
    both = replied.unionByName(docs.mapInPandas(bring, ROWS))
    return both.groupBy("block").applyInPandas(close, schema)
