"""LM scoring by a weighted backoff automaton.

Training counts n-grams of orders 1 to ``order`` over all documents that are
not held out. Each n-gram with a positive count is a state reached by an arc;
a state that has no arc for the next word fails over to the state of its
longest proper suffix, at the price of its backoff weight. Weights come from
Dirichlet smoothing, for a context h with count c(h) and strength m:

    p(w | h) = (c(h w) + m p(w | h')) / (c(h) + m),   h' = h without its first word

so the arc weighs log10 p and the failure arc log10(m / (c(h) + m)). At the
root, p(w) = (c(w) + 0.1) / (N + 0.1 (V + 1)). All weights need only counts,
which :mod:`block_counts` totals over the whole corpus and returns to each
block of documents; a block then builds the part of the automaton that its own
texts can reach, which scores them exactly as the whole automaton would. No
model is broadcast, pruned or capped.

One left-to-right traversal scores a document: the state it carries is the longest suffix of the words so far that the
automaton knows; a word follows the state's arc, or fails over until a state has one. Numpy takes many
stretches of text at a time, one word of each a step. A long document has several stretches; a state holds ``order - 1`` words at most,
so a stretch that begins that many words earlier has the state of the whole traversal where it starts to count.

Words are ASCII-lower-cased ``[^\\x20\\x09-\\x0D]+``; every document ends in an
end token, which also is the state before its first word. Null or empty texts
hold the end token alone. A null id counts as training and stays null. Rows that repeat an id are texts of their own,
all of which are scored and counted.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import block_counts
from .block_counts import Block, mix
from .common import nullable, table, whole_ids

END = b"\n"  # holds white space, so no word equals it

#: Smoothing strength of orders 2, 3, ...
STRENGTH = (4000.0, 100.0)
#: Words of a stretch of text.
STRETCH = 64

SCHEMA = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
    "base_score double, score double, n_backoffs long"
)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 10 == 0, F.lit(False))


def _grams(block: Block, order: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each order: the key of the n-gram that ends at each position, and where there is one."""
    h = block.hashes[block.tokens]
    starts, end = block.starts, h[block.ends[0] - 1]
    index = np.arange(len(h)) - np.repeat(starts, np.diff(block.ends, prepend=0))
    out = [(mix(h) | np.uint64(1), np.ones(len(h), bool))]
    key = h
    for back in range(1, order):
        before = np.empty_like(h)
        before[back:] = h[: len(h) - back]
        before[index == back - 1] = end
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + before)
        out.append((key & ~np.uint64(1), index >= back - 1))
    return out


class Automaton:
    """The states and arcs that a block's texts can reach.

    Gram g (a number among the block's distinct grams) with a positive total is an arc, from the state of its words but the last, by its last
    word, of weight ``weight[g]``, to state ``target[g]``. One shorter than ``order`` is state ``1 + g`` as well, of ``size`` words; state 0 is
    the root, which has an arc for each word, known or not. ``fail[s]`` is the state of the longest proper suffix, at the weight ``backoff[s]``.
    Which gram a state of k words and the word at a position make is known by position: ``grams[k]``.
    """

    def __init__(self, block: Block, grams: list[np.ndarray], totals, tokens: int, distinct: int, strength):
        order, n = len(grams), len(totals)
        self.block, self.order, self.grams = block, order, np.stack(grams)
        end = int(block.ends[0]) - 1  # where an end token stands
        root = tokens + 0.1 * (distinct + 1)
        self.real = totals > 0
        self.known = self.real[grams[0]]
        p = np.empty(n)
        p[grams[0]] = (totals[grams[0]] + 0.1) / root
        self.target, self.size = np.zeros(n, np.int64), np.zeros(n + 1, np.int8)
        self.fail, self.backoff = np.zeros(n + 1, np.int64), np.zeros(n + 1)
        if order > 1:
            self.target[grams[0]] = np.where(self.known, 1 + grams[0], 0)
            self.size[1 + grams[0]] = 1
        first = np.zeros(len(block.tokens), bool)
        first[block.starts] = True
        for k in range(1, order):
            # A position of each gram of k + 1 words.
            at = np.full(n, -1, np.int64)
            there = np.flatnonzero(grams[k] >= 0)
            at[grams[k][there]] = there
            gram = np.flatnonzero(at >= 0)
            at = at[gram]
            # The context ends one word earlier; ahead of a text stands an end token.
            context = grams[k - 1][np.where(first[at], end if k == 1 else at, at - 1)]
            suffix = grams[k - 1][at]
            m = strength[k - 1]
            p[gram] = (totals[gram] + m * p[suffix]) / (totals[context] + m)
            self.backoff[1 + context] = np.log10(m / (totals[context] + m))
            self.target[gram] = 1 + (gram if k + 1 < order else suffix)
            if k + 1 < order:
                self.fail[1 + gram] = 1 + suffix
                self.size[1 + gram] = k + 1
        self.weight = np.log10(p)
        self.start = int(self.target[grams[0][end]])

    def root_weights(self) -> np.ndarray:
        return self.weight[self.grams[0]]

    def traverse(self) -> tuple[np.ndarray, np.ndarray]:
        """log10 probability of every position's word, and the failure arcs taken there."""
        n = len(self.block.tokens)
        score, failed = np.zeros(n), np.zeros(n, np.int64)
        # Stretches: where one counts from and to, and where it starts to walk.
        pieces = -(-np.diff(self.block.ends, prepend=0) // STRETCH)
        number = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = np.repeat(self.block.starts, pieces)
        counts = begin + number * STRETCH
        stop = np.minimum(counts + STRETCH, np.repeat(self.block.ends, pieces))
        walk = np.maximum(counts - (self.order - 1), begin)
        state = np.where(walk == begin, self.start, 0)
        for step in range(STRETCH + self.order - 1):
            live = np.flatnonzero(walk + step < stop)
            at, now = walk[live] + step, state[live]
            paid, arcs = np.zeros(len(live)), np.zeros(len(live), np.int64)
            open_ = np.arange(len(live))
            while len(open_):
                s = now[open_]
                gram = self.grams[self.size[s], at[open_]]
                hit = (s == 0) | self.real[gram]
                paid[open_] += np.where(hit, self.weight[gram], self.backoff[s])
                now[open_] = np.where(hit, self.target[gram], self.fail[s])
                open_ = open_[~hit]
                arcs[open_] += 1
            state[live] = now
            counted = at >= counts[live]
            score[at[counted]], failed[at[counted]] = paid[counted], arcs[counted]
        return score, failed


def score(docs: DataFrame, order: int = 3, strength: tuple[float, ...] = STRENGTH) -> DataFrame:
    """Train on ``docs`` that are not held out and score all of them."""
    if order < 1 or len(strength) < order - 1:
        raise ValueError("one smoothing strength for each order above 1")

    def keys(block: Block):
        train = np.repeat(block.flags == 0, np.diff(block.ends, prepend=0))
        grams = _grams(block, order)
        all_keys = np.concatenate([k[there] for k, there in grams])
        weight = np.concatenate([train[there] for _, there in grams])
        distinct, place = np.unique(all_keys, return_inverse=True)
        places, at = [], 0
        for _, there in grams:
            mine = np.full(len(there), -1, np.int64)
            size = int(there.sum())
            mine[there] = place[at : at + size]
            places.append(mine)
            at += size
        return distinct, np.bincount(place, weight, len(distinct)).astype(np.int64), places

    def finish(block: Block, _k, totals, stats, places):
        tokens, distinct = stats
        model = Automaton(block, places, totals, tokens, distinct, strength)
        got, failed = model.traverse()
        at = block.starts
        return pd.DataFrame(
            {
                "doc_id": nullable(block.ids, block.known == 0),
                "held_out": block.flags == 1,
                "n_tokens": np.diff(block.ends, prepend=0),
                "n_known": np.add.reduceat(model.known.astype(np.int64), at),
                "train_tokens": tokens,
                "base_score": np.add.reduceat(model.root_weights(), at),
                "score": np.add.reduceat(got, at),
                "n_backoffs": np.add.reduceat(failed, at),
            }
        )

    rows = docs.select(
        *whole_ids("doc_id"),
        held_out(F.col("doc_id")).cast("int").alias("flag"),
        "text",
    ).withColumnRenamed("doc_id", "id")
    return block_counts.exchange(rows, keys, finish, SCHEMA, end=END)


def op2_backoff_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))


QUERIES = {"op2_backoff_lm": op2_backoff_lm}
ORACLES: dict[str, str] = {}
