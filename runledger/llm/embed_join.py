"""Embedding near-dedup by a subspace pigeonhole join.

Unit vectors at cosine c lie at squared distance 2 - 2c. Vectors are rotated by a
fixed random orthogonal matrix and split into ``blocks`` of equal width. If two
vectors are within the whole budget 2 - 2c, at least one block holds at most its
proportional share of the squared distance. So each block is range-joined under
its own budget, and every candidate is verified exactly, by cosine of the given
components in double precision.

Range join of a block: a k-d tree splits all its coordinates, each node at the median of its widest one, and the deeper the more
vectors there are (``TILE_ROWS`` in a leaf, about). A vector stands in its own leaf and, as a guest, in each leaf to the right of one of its splits
whose summed squared gap to it is within the block's budget; so two vectors within the budget meet in exactly one leaf that is home to one of
them. A leaf is a tile, a task's work, and is split on in the same way down to ``LEAF`` vectors before any pair is
looked at. Tiles with more than ``TILE_ROWS`` rows are dealt into chunks, and chunks meet in pairs, so a dense group is spread
over tasks. A pair is counted only in the first block that admits it, so no list
of pairs is made, shuffled or deduplicated: a tile returns one row per vector with
its number of links and the least vector it reaches inside the tile.

Equal vectors collapse to one representative with a multiplicity first. Vectors
that are null, empty, zero, or hold null or non-finite components
link with nothing; vectors of each width are joined among themselves, by a plan of their own. ``vec_id`` should be unique;
rows that repeat one share its links and class.
The trees' splits are medians of at most ``SAMPLE`` vectors of a width; they steer balance alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpointed, components, table

COSINE = 0.9
BLOCKS = 8
TILE_ROWS, SAMPLE = 60_000, 8192
#: Splits of a tree between tasks at most; beyond, tiles are dealt into chunks. Vectors of a leaf within a task.
DEPTH, LEAF = 10, 64
#: Candidates that are verified at once.
VERIFY = 1 << 18
SLACK = 1e-5


def rotation(width: int) -> np.ndarray:
    """A fixed orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(20240229).normal(size=(width, width)))
    return q * np.sign(np.diag(r))


class Guests:
    """Rows beside a node of a tree, with their squared gaps to its cell, by coordinate and summed."""

    def __init__(self, rows: np.ndarray, gaps: np.ndarray, total: np.ndarray):
        self.rows, self.gaps, self.total = rows, gaps, total

    @classmethod
    def none(cls, width: int) -> Guests:
        return cls(np.empty(0, np.int64), np.empty((0, width)), np.empty(0))

    def beyond(self, points: np.ndarray, axis: int, bound: float, right: bool, budget: float) -> Guests:
        """Those that are still near the part of the cell on one side of a split."""
        x = points[self.rows, axis]
        away = x < bound if right else x > bound
        gap = np.where(away, (x - bound) ** 2, self.gaps[:, axis])
        total = self.total - self.gaps[:, axis] + gap
        near = np.flatnonzero(total <= budget)
        gaps = self.gaps[near]
        gaps[:, axis] = gap[near]
        return Guests(self.rows[near], gaps, total[near])

    def with_rows(self, rows: np.ndarray, points: np.ndarray, axis: int, bound: float, budget: float) -> Guests:
        """And rows from the other side of a split, as far as they are near."""
        gap = (points[rows, axis] - bound) ** 2
        rows, gap = rows[gap <= budget], gap[gap <= budget]
        gaps = np.zeros((len(rows), points.shape[1]))
        gaps[:, axis] = gap
        return Guests(np.concatenate((self.rows, rows)), np.concatenate((self.gaps, gaps)), np.concatenate((self.total, gap)))


def split(points: np.ndarray, own: np.ndarray, guests: Guests, axis: int, bound: float, budget: float):
    """``(own, guests)`` of both sides: rows on the left visit the right, never the other way round."""
    low = points[own, axis] < bound
    left, right = own[low], own[~low]
    visitors = guests.beyond(points, axis, bound, True, budget).with_rows(left, points, axis, bound, budget)
    return (left, guests.beyond(points, axis, bound, False, budget)), (right, visitors)


class Plan:
    """Blocks, budgets and trees for vectors of one width. A block's tree has ``cells ** grid`` leaves, or the next power of two."""

    def __init__(self, width: int, cosine: float, blocks: int, grid: int, cells: int, sample: np.ndarray):
        self.width, self.cosine = width, cosine
        self.matrix = rotation(width)
        self.cuts = [c for c in np.array_split(np.arange(width), min(blocks, width))]
        whole = 2 - 2 * cosine
        self.budget = np.array([whole * len(c) / width for c in self.cuts])
        self.depth = int(np.ceil(grid * np.log2(cells)))
        self.leaves = 1 << self.depth
        turned = self.turn(sample) if len(sample) else np.zeros((1, width))
        self.trees = [self._tree(turned[:, c]) for c in self.cuts]

    def turn(self, x: np.ndarray) -> np.ndarray:
        return _unit(x) @ self.matrix

    def _tree(self, points: np.ndarray) -> list[tuple[int, float]]:
        """Axis and bound of each inner node, level by level."""
        out, level = [], [points]
        for _ in range(self.depth):
            below = []
            for p in level:
                axis = int(np.ptp(p, axis=0).argmax()) if len(p) else 0
                bound = float(np.median(p[:, axis])) if len(p) else 0.0
                out.append((axis, bound))
                low = p[:, axis] < bound
                below += [p[low], p[~low]]
            level = below
        return out

    def places(self, turned: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row numbers, leaf numbers and guest marks of all places that vectors take in a block."""
        points, budget = turned[:, self.cuts[block]], self.budget[block] + SLACK
        level = [(np.arange(len(points)), Guests.none(points.shape[1]))]
        nodes = iter(self.trees[block])
        for _ in range(self.depth):
            level = [part for own, guests in level for part in split(points, own, guests, *next(nodes), budget)]
        rows = [np.concatenate((own, guests.rows)) for own, guests in level]
        leaf = np.repeat(np.arange(len(level)), [len(r) for r in rows])
        guest = [np.repeat([0, 1], [len(own), len(guests.rows)]) for own, guests in level]
        return np.concatenate(rows), leaf, np.concatenate(guest).astype(np.int64)

    def links(self, x: np.ndarray, turned: np.ndarray, guest: np.ndarray, chunk: np.ndarray, block: int, both: bool, counted: list | None = None):
        """Pairs (i < j) that link and belong to this tile; ``both``: only pairs across the two chunks. ``counted`` takes the number of pairs compared."""
        points, budget = turned[:, self.cuts[block]], self.budget[block] + SLACK
        y = points.astype(np.float32)
        half = (y * y).sum(axis=1, keepdims=True)
        one = np.ones_like(half)
        # The product of these is the squared distance.
        left, right = np.hstack((y, half, one)), np.hstack((-2 * y, one, half))
        limit = np.float32(budget)
        unit = _unit(x)
        found, waiting, n_waiting = [], [], 0

        def verified() -> None:
            i, j = (np.concatenate(z) for z in zip(*waiting, strict=True))
            if both:
                across = chunk[i] != chunk[j]
                i, j = i[across], j[across]
            i, j = np.minimum(i, j), np.maximum(i, j)
            linked = np.einsum("ij,ij->i", unit[i], unit[j]) >= self.cosine
            i, j = i[linked], j[linked]
            gaps = (turned[i] - turned[j]) ** 2
            inside = np.stack([gaps[:, c].sum(axis=1) for c in self.cuts], axis=1) <= self.budget + SLACK / 2
            mine = inside.argmax(axis=1) == block
            found.append((i[mine], j[mine]))

        own, visiting = np.flatnonzero(guest == 0), np.flatnonzero(guest)
        # How far the tile's guests are from the leaf is not known here; within the leaf, their gaps begin at nothing.
        todo = [(own, Guests(visiting, np.zeros((len(visiting), points.shape[1])), np.zeros(len(visiting))))]
        while todo:
            own, guests = todo.pop()
            if not len(own) or len(own) + len(guests.rows) < 2:
                continue
            spread = np.ptp(points[own], axis=0)
            axis = int(spread.argmax())
            bound = float(np.median(points[own, axis]))
            if len(own) > LEAF and (points[own, axis] < bound).any():
                todo += split(points, own, guests, axis, bound, budget)
                continue
            for top in range(0, len(own), 256):  # as long as rows that no split tells apart
                mine = own[top : top + 256]
                others = np.concatenate((own[top:], guests.rows))
                for first in range(0, len(others), 65_536):
                    part = others[first : first + 65_536]
                    at = np.flatnonzero(left[mine] @ right[part].T <= limit)
                    if counted is not None:
                        counted.append(len(mine) * len(part))
                    i, j = at // len(part), at % len(part) + first
                    keep = (j >= len(mine)) | (i < j)  # the first columns are these rows themselves
                    if keep.any():
                        waiting.append((mine[i[keep]], others[j[keep]]))
                        n_waiting += int(keep.sum())
                        if n_waiting >= VERIFY:
                            verified()
                            waiting, n_waiting = [], 0
        if waiting:
            verified()
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return tuple(np.concatenate(z) for z in zip(*found, strict=True))


def _unit(x: np.ndarray) -> np.ndarray:
    """Unit vectors; scaled by the largest component first, so that no square overflows or vanishes."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _vectors(column: pd.Series, kind: str) -> np.ndarray:
    return np.stack([np.frombuffer(b, kind) for b in column]).astype(np.float64)


def _least_reached(n: int, names: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least name that each of n rows reaches over the links."""
    rank = np.argsort(np.argsort(names, kind="stable"), kind="stable")
    order = np.argsort(rank)
    root = rank.copy()
    while True:
        new = root.copy()
        np.minimum.at(new, i, root[j])
        np.minimum.at(new, j, root[i])
        new = np.minimum(new, new[order[new]])
        if (new == root).all():
            return names[order[root]]
        root = new


def plans(one: DataFrame, cosine: float, blocks: int) -> dict[int, Plan]:
    """A plan for each width that several distinct vectors have; ``one``: those vectors, as ``v``."""
    sizes = one.groupBy(F.size("v").alias("width")).count().filter("count > 1").collect()  # a row a width
    out = {}
    for r in sorted(sizes):
        depth = min(DEPTH, max(0, int(np.ceil(np.log2(r["count"] / TILE_ROWS)))))
        # The grouping dealt the vectors by hash, so the first rows are a random sample.
        sample = one.filter(F.size("v") == r.width).limit(SAMPLE).select("v").toPandas()["v"] if depth else []
        known = np.stack([np.asarray(v, np.float64) for v in sample]) if len(sample) else np.empty((0, r.width))
        out[r.width] = Plan(r.width, cosine, blocks, depth, 2, known)
    return out


def near_duplicates(df: DataFrame, cosine: float = COSINE, blocks: int = BLOCKS) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``df`` (``vec_id``, ``embedding``)."""
    kind = "<f4" if df.schema["embedding"].dataType.simpleString() == "array<float>" else "<f8"
    rows = df.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("v"))
    good = F.expr(
        "vec_id is not null and size(v) > 0 and exists(v, x -> x <> 0)"
        " and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('inf'))"
    )
    rows = rows.withColumn("v", F.when(good, F.col("v")))
    one = rows.filter("v is not null").groupBy("v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    one = checkpointed(one)
    plan = plans(one, cosine, blocks)

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for width, same in f.groupby(f["v"].map(len)):
                p = plan[width]
                x = np.stack([np.asarray(v, np.float64) for v in same["v"]])
                turned = p.turn(x)
                data = np.array([v.astype(kind).tobytes() for v in x], object)
                reps, copies = same["rep"].to_numpy(), same["copies"].to_numpy()
                for b in range(len(p.cuts)):
                    at, leaf, guest = p.places(turned, b)
                    for top in range(0, len(at), 10_000):
                        k = at[top : top + 10_000]
                        yield pd.DataFrame(
                            {
                                "width": width, "tile": b * p.leaves + leaf[top : top + 10_000], "guest": guest[top : top + 10_000],
                                "rep": reps[k], "copies": copies[k], "x": data[k],
                            }
                        )

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["rep"])
        p = plan[int(group["width"].iloc[0])]
        block = int(group["tile"].iloc[0]) // p.leaves
        x = _vectors(group["x"], kind)
        chunk = group["chunk"].to_numpy()
        both = bool(group["p"].iloc[0] != group["q"].iloc[0])
        i, j = p.links(x, p.turn(x), group["guest"].to_numpy(), chunk, block, both)
        names, copies = group["rep"].to_numpy(), group["copies"].to_numpy()
        n = np.bincount(i, copies[j], len(x)) + np.bincount(j, copies[i], len(x))
        root = _least_reached(len(x), names, i, j)
        out = pd.DataFrame({"rep": names, "links": n.astype(np.int64), "root": root})
        return out[out["links"] > 0]

    several = one.filter(F.size("v").isin(*plan)) if len(plan) <= 1000 else one.join(one.groupBy(F.size("v").alias("w")).count().filter("count > 1"), F.size("v") == F.col("w"), "left_semi")
    placed = checkpointed(several.select("rep", "copies", "v").mapInPandas(place, "width int, tile long, guest long, rep long, copies long, x binary"))
    # At most blocks * 2 ** DEPTH tiles a width, however many vectors.
    sizes = placed.groupBy("width", "tile").agg(F.ceil(F.count("*") / F.lit(TILE_ROWS)).cast("long").alias("chunks"))
    dealt = (
        placed.join(sizes, ["width", "tile"])
        .withColumn("chunk", F.pmod(F.xxhash64("rep"), F.col("chunks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
        .withColumn("p", F.least("chunk", "other"))
        .withColumn("q", F.greatest("chunk", "other"))
        .drop("other", "chunks")
    )
    reached = checkpointed(dealt.groupBy("width", "tile", "p", "q").applyInPandas(compare, "rep long, links long, root long"))
    linked = components(reached.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    linked = linked.select(F.col("node").alias("rep"), "component")
    counted = reached.groupBy("rep").agg(F.sum("links").alias("links"))
    classes = one.select("v", "rep", "copies").join(counted, "rep", "left").join(linked, "rep", "left")
    out = rows.join(classes, "v", "left").select(
        "vec_id",
        F.coalesce(F.coalesce("links", F.lit(0)) + F.col("copies") - 1, F.lit(0)).alias("n_links"),
        F.coalesce("component", "rep", "vec_id").alias("component_id"),
    )
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def op1_subspace_pigeonhole(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


QUERIES = {"op1_subspace_pigeonhole": op1_subspace_pigeonhole}
ORACLES: dict[str, str] = {}
