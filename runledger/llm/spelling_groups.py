"""Spelling variants by search schemes over FM-indexes of the vocabulary.

Words that differ by one inserted, deleted or replaced code point agree in their first or in
their second half. So each word asks twice: once its second half is matched exactly and
the first may hold the error, once the other way round. Both searches run over an FM-index of the
delimited vocabulary, ``#word#word#...#``, and extend to one side only: the first over the index of
the words, the second over the index of the reversed words. A whole match ``#word#`` is one
suffix-rank interval of one row, and the rank among the suffixes that start with ``#`` is the
place of the word in the sorted vocabulary, so no position has to be looked up.

The vocabulary is no task's. A half that is matched exactly is a key: a word asks under its own halves and is found
under the halves that words one longer, as long, and one shorter would match. Keys
are dealt into shards of about ``SHARD_CHARS`` code points by hash; a key that has more is split into chunks, and
those who ask under it ask in each chunk. All words of a shard are searched together, one step of the
intervals being one binary search in a sorted array of (character, row). No two searches report
the same neighbour, so a shard returns one row per word: the number of its neighbours and the best.

Words of the query: runs of ``[A-Za-z\\u00C0-\\u00FF]+`` of whole texts, A-Z in lower case; the unsigned crc32
of ``doc_id:run`` decides which runs lose a code point. Null texts hold no words; a null id counts as an empty one; rows that
repeat an id count each; texts of any length are taken whole. An empty table gives an empty result, extra columns are not
read. Equal counts among near words: the least in code-point order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpointed, partitions, table

# Fixed values of the query.
EVERY, LEAST_LENGTH, LEAST_COUNT = 97, 5, 3
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Code points of a shard's words, about; and queries that are searched together.
SHARD_CHARS, BATCH = 500_000, 8192
#: Crowded keys (there are fewer than shards) up to which they are broadcast.
BROADCAST_ROWS = 100_000


def counted_words(docs: DataFrame) -> DataFrame:
    """``word, n`` of all words of ``docs`` (``doc_id, text``) that are long and frequent enough, after the damage."""
    lowered = F.translate("text", UPPER, LOWER)
    runs = F.regexp_extract_all(lowered, F.lit(f"[a-zÀ-ÿ]{{{LEAST_LENGTH},}}"), F.lit(0))
    each = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    drawn = F.crc32(F.concat_ws(":", "id", "run").cast("binary"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    word = F.when(F.col("h") % EVERY == 0, cut).otherwise(F.col("run"))
    counts = each.withColumn("h", drawn).select(word.alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return counts.filter((F.length("word") >= LEAST_LENGTH) & (F.col("n") >= LEAST_COUNT))


class FMIndex:
    """An FM-index of ``#w1#w2#...#`` for sorted distinct words; ``#`` is the least character.

    Rotations of the text are sorted as if it were a ring. Those that start with ``#`` come first: row 0 is the
    ring's seam, row i starts with ``#wi#``.
    """

    def __init__(self, words: list[str]):
        self.n = len(words)
        text = np.frombuffer(("\0" + "\0".join(words) + "\0").encode("utf-32-le"), "<u4")
        self.alphabet, ranks = np.unique(text, return_inverse=True)
        self.sigma, self.size = len(self.alphabet), len(text)
        ranks = ranks.astype(np.int64)
        # As many characters as fit into a number, then twice as many each round, until all rotations differ.
        bits = max(1, int(self.sigma - 1).bit_length())
        width = max(1, 62 // bits)
        key = ranks.copy()
        for k in range(1, width):
            key = (key << bits) | np.roll(ranks, -k)
        order, k = None, width
        while True:
            values, place = np.unique(key, return_inverse=True)
            if len(values) == self.size:
                break
            key = place * np.int64(self.size) + np.roll(place, -k)
            k *= 2
        order = np.empty(self.size, np.int64)
        order[place] = np.arange(self.size)
        self.before = ranks[order - 1]  # the character ahead of each rotation
        rows = np.argsort(self.before, kind="stable")
        #: Sorted (character, row): the number of entries below (c, i) is where row i goes when c is put ahead of it.
        self.steps = self.before[rows] * np.int64(self.size) + rows

    def codes(self, text: str) -> np.ndarray:
        """Character numbers, -1 for characters that the index does not have."""
        points = np.frombuffer(text.encode("utf-32-le"), "<u4")
        at = np.minimum(np.searchsorted(self.alphabet, points), self.sigma - 1)
        return np.where(self.alphabet[at] == points, at, -1).astype(np.int64)

    def extend(self, lo: np.ndarray, hi: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of ``c`` put ahead of the matched strings; empty where ``c`` is -1."""
        base = c * np.int64(self.size)
        lo, hi = np.searchsorted(self.steps, base + lo), np.searchsorted(self.steps, base + hi)
        return lo, np.where(c < 0, lo, hi)

    def branches(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(state, character)`` for each character but ``#`` ahead of a row of each interval."""
        size = hi - lo
        few = np.flatnonzero((size > 0) & (size < self.sigma))
        many = np.flatnonzero(size >= self.sigma)
        rows = np.repeat(lo[few] - np.cumsum(size[few]) + size[few], size[few]) + np.arange(size[few].sum())
        pairs = np.unique(np.repeat(few, size[few]) * np.int64(self.sigma) + self.before[rows])
        state = np.concatenate((pairs // self.sigma, np.repeat(many, self.sigma)))
        c = np.concatenate((pairs % self.sigma, np.tile(np.arange(self.sigma), len(many))))
        return state[c > 0], c[c > 0]


def neighbours(index: FMIndex, asked: list[str], exact: list[int], owns_seam: bool) -> tuple[np.ndarray, np.ndarray]:
    """``(number in asked, place in the index's words)`` of all words at one error ahead of the exact end.

    The last ``exact[i]`` characters of ``asked[i]`` are matched as they are; exactly one error is in what comes before. An error within a run of
    one character is placed at the run's end, so each neighbour is found once. ``owns_seam``: whether errors
    right at the seam of the halves, which the search from the other side finds as well, are reported here.
    """
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for top in range(0, len(asked), BATCH):
        words = asked[top : top + BATCH]
        sizes = np.array([len(w) for w in words], np.int64)
        starts = np.cumsum(sizes) - sizes
        codes = index.codes("".join(words))
        free = sizes - np.array(exact[top : top + BATCH], np.int64)  # characters that may hold the error
        left = sizes.copy()  # characters not matched yet
        live = np.arange(len(words))
        lo, hi = np.zeros(len(words), np.int64), np.full(len(words), index.n + 1, np.int64)
        while len(live):  # the exact end
            more = left[live] > free[live]
            if not more.any():
                break
            at = live[more]
            lo[at], hi[at] = index.extend(lo[at], hi[at], codes[starts[at] + left[at] - 1])
            left[at] -= 1
            live = live[hi[live] > lo[live]]
        while len(live):  # the rest: errors branch off, the word itself goes on
            j = left[live]
            seam = j == free[live]
            here = codes[starts[live] + j - 1]  # garbage where j is 0, never used there
            right = codes[starts[live] + np.minimum(j, sizes[live] - 1)]
            state, c = index.branches(lo[live], hi[live])
            lo_c, hi_c = index.extend(lo[live][state], hi[live][state], c)
            insert = np.where(seam[state], owns_seam, c != right[state]) & (hi_c > lo_c)
            replace = (j[state] > 0) & (c != here[state]) & (hi_c > lo_c)
            delete = (j > 0) & ((here != right) | (seam & owns_seam))
            q = np.concatenate((live[state[insert]], live[state[replace]], live[delete]))
            rest = np.concatenate((j[state[insert]], j[state[replace]] - 1, j[delete] - 1))
            a = np.concatenate((lo_c[insert], lo_c[replace], lo[live][delete]))
            b = np.concatenate((hi_c[insert], hi_c[replace], hi[live][delete]))
            while len(q):  # after the error all is exact, up to the delimiter
                done = rest == 0
                a, b = index.extend(a, b, np.where(done, 0, codes[starts[q] + np.maximum(rest, 1) - 1]))
                alive = b > a
                hit = done & alive
                if hit.any():
                    found.append((q[hit] + top, a[hit] - 1))
                on = alive & ~done
                q, rest, a, b = q[on], rest[on] - 1, a[on], b[on]
            on = live[j > 0]
            lo[on], hi[on] = index.extend(lo[on], hi[on], codes[starts[on] + left[on] - 1])
            left[on] -= 1
            live = on[hi[on] > lo[on]]
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _half(length: Column, side: int) -> Column:
    """Code points of the half that is matched exactly: the second for side 0, the first for side 1."""
    first = (length / 2).cast("int")
    return length - first if side == 0 else first


def best_neighbours(words: DataFrame) -> DataFrame:
    """``word, n_near, best, best_n`` for each word of ``words`` (``word, n``) that has near words."""
    spark = words.sparkSession
    size = F.length("word")
    places = []
    for side in (0, 1):
        own = _half(size, side)
        for step in (-1, 0, 1):  # found by words that much longer
            half = _half(size + step, side)
            key = F.substr("word", size - half + 1) if side == 0 else F.substr("word", F.lit(1), half)
            places.append(F.struct(F.lit(side).alias("side"), key.alias("key"), (half == own).alias("asks")))
    # Two of the three halves are equal.
    placed = words.select("word", "n", F.explode(F.array_distinct(F.array(*places))).alias("p")).select("word", "n", "p.*")
    load = F.sum(F.length("word") + 1).cast("long")
    total = placed.agg(load).first()[0] or 0
    shards = max(1, min(partitions(spark), total // 10_000), total // SHARD_CHARS)
    crowded = placed.groupBy("side", "key").agg(load.alias("load")).filter(F.col("load") > SHARD_CHARS)
    crowded = checkpointed(crowded.select("side", "key", F.ceil(F.col("load") / SHARD_CHARS).cast("long").alias("chunks")))
    n_crowded = crowded.count()
    if n_crowded:
        placed = placed.join(F.broadcast(crowded) if n_crowded <= BROADCAST_ROWS else crowded, ["side", "key"], "left")
    else:
        placed = placed.withColumn("chunks", F.lit(None).cast("long"))
    home = F.pmod(F.xxhash64("word"), "chunks")
    chunk = F.explode(F.when(F.col("chunks").isNull(), F.array(F.lit(-1).cast("long"))).when(F.col("asks"), F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).otherwise(F.array(home)))
    shard = F.when(F.col("chunks").isNull(), F.pmod(F.xxhash64("side", "key"), F.lit(shards).cast("long"))).otherwise(F.xxhash64("key"))
    dealt = placed.withColumn("chunk", chunk).select(
        "side", shard.alias("shard"), "chunk", "word", "n", "asks", F.coalesce(F.col("chunk") == home, F.lit(True)).alias("stands")
    )

    def search(group: pd.DataFrame) -> pd.DataFrame:
        side = int(group["side"].iloc[0])
        turn = (lambda w: w) if side == 0 else (lambda w: w[::-1])
        here = group[group["stands"]].drop_duplicates("word")
        here = here.assign(turned=here["word"].map(turn)).sort_values("turned")
        names, counts = here["word"].to_numpy(), here["n"].to_numpy(np.int64)
        asking = group[group["asks"]].drop_duplicates("word")["word"].tolist()
        nothing = pd.DataFrame({"word": pd.Series([], dtype=object), "near": [], "best": pd.Series([], dtype=object), "best_n": []})
        if not len(names) or not asking:
            return nothing
        exact = [len(w) - len(w) // 2 if side == 0 else len(w) // 2 for w in asking]
        q, at = neighbours(FMIndex(here["turned"].tolist()), [turn(w) for w in asking], exact, side == 1)
        if not len(q):
            return nothing
        order = np.argsort(np.argsort(names))  # numpy orders these as Python strings do
        by = np.lexsort((order[at], -counts[at], q))
        q, at = q[by], at[by]
        who, first, near = np.unique(q, return_index=True, return_counts=True)
        return pd.DataFrame({"word": np.array(asking, object)[who], "near": near, "best": names[at[first]], "best_n": counts[at[first]]})

    said = dealt.groupBy("side", "shard", "chunk").applyInPandas(search, "word string, near long, best string, best_n long")
    merged = said.groupBy("word").agg(F.sum("near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("m"), "best")).alias("b"))
    return merged.select("word", "n_near", "b.best", (-F.col("b.m")).alias("best_n"))


def roots(words: DataFrame) -> DataFrame:
    """``word, root`` of the words with a form (``word, form``), by pointer doubling.

    Counts double at least from a word to its form, so a path has no more than 63 steps and six rounds do.
    """
    ahead = checkpointed(words.filter("form is not null").select("word", F.col("form").alias("root")))
    while True:
        further = ahead.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = checkpointed(ahead.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if moved.filter("moved").isEmpty():
            return ahead
        ahead = moved.select("word", "root")


def groups(words: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for distinct words with counts (``word, n``)."""
    words = checkpointed(words.select("word", F.col("n").cast("long").alias("n")))
    near = words.join(best_neighbours(words), "word", "left")
    is_form = F.col("best_n") >= 2 * F.col("n")
    formed = checkpointed(
        near.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n"),
        )
    )
    rooted = formed.join(roots(formed), "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups(counted_words(table(spark, sf_dir, "documents").select("doc_id", "text")))


QUERIES = {"op12_spelling_groups": op12_spelling_groups}
ORACLES: dict[str, str] = {}
