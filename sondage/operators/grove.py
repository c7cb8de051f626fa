"""Forests grown in tasks: every task holds the rows as bytes and grows a few whole trees.

Spark's learner grows all trees of a fit level by level: every partition sends the statistics of every node, and the driver
holds all trees. Here a row is one byte per feature, the bin of its value, so that rows within ``HELD_BYTES`` are sent to every
worker once. A tree then needs no exchange; it votes for the rows asked about and is dropped. Only sums of votes move.

The trees follow the rules of Spark's learner: up to 31 thresholds per feature, found on 10,000 rows of a larger table;
rows drawn with replacement; the square root of the features tried at every node (all of them for a single tree); the
split with the largest Gini gain whose parts have the least size; two leaves of one parent that vote alike become one.
The random numbers are others, so that a forest is not Spark's tree by tree.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import ceil, sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .distribute import materialize

HELD_BYTES = 256 * 1024 * 1024  # of binned rows, which every Python worker holds
MAX_BINS = 32
CANDIDATE_ROWS = 10_000  # Spark's number of rows that thresholds are found on
CELLS_AT_ONCE = 500_000  # values of rows at tried features that are sorted together
BLOCK_ROWS = 1024


# --- rows as bytes -----------------------------------------------------------------------

def fits(rows: DataFrame, n: int, copies: int = 1) -> bool:
    """Whether every worker can hold ``copies`` tables of ``n`` of the rows."""
    first = rows.select(F.size(vector_to_array("features")).alias("d")).first()
    return first is not None and n * first["d"] * copies <= HELD_BYTES


def _thresholds_of(values: np.ndarray, n_bins: int) -> np.ndarray:
    """Middles between neighbouring values, at most ``n_bins - 1`` of them, at equal shares of the rows."""
    found, counts = np.unique(values, return_counts=True)
    if len(found) <= n_bins:
        return (found[:-1] + found[1:]) / 2
    middles, counts = (found[:-1] + found[1:]) / 2, counts.tolist()
    stride = len(values) / n_bins
    out, upto, target = [], counts[0], stride
    for i in range(1, len(counts)):
        before, upto = upto, upto + counts[i]
        if abs(before - target) < abs(upto - target):
            out.append(middles[i - 1])
            target += stride
    return np.array(out)


def thresholds(train: DataFrame, n: int, seed: int = 1) -> list[np.ndarray]:
    """Candidate thresholds per feature of ``n`` training rows."""
    if not n:
        raise ValueError("a forest needs training rows")
    drawn = train if n <= CANDIDATE_ROWS else train.sample(False, CANDIDATE_ROWS / n, seed)
    x = _matrix(drawn.select(vector_to_array("features").alias("x")).toArrow().column("x").combine_chunks())
    return [_thresholds_of(x[:, j], min(MAX_BINS, n)) for j in range(x.shape[1])]


def _matrix(column: pa.Array) -> np.ndarray:
    """Dense rows of one width as a matrix."""
    if column.null_count:
        raise ValueError("a row has no features")
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return x.reshape(len(column), -1) if len(column) else x.reshape(0, 0)


@dataclass
class Held:
    """Rows as the tasks hold them: bins by row and feature, class, and which of the parts a row belongs to."""
    bins: np.ndarray
    label: np.ndarray
    part: np.ndarray

    def at(self, parts: Sequence[int]) -> np.ndarray:
        return np.flatnonzero(np.isin(self.part, parts))


def held(rows: DataFrame, cuts: Sequence[np.ndarray], part: str = "part") -> Held:
    """``label_idx, features`` and the number of the ``part`` of every row, in an order that does not depend on partitions."""
    cuts = list(cuts)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            x = _matrix(batch.column("x"))
            bins = np.stack([np.searchsorted(c, x[:, j]) for j, c in enumerate(cuts)], axis=1).astype(np.uint8)
            label = batch.column("label_idx").to_numpy(zero_copy_only=False).astype(">u2")
            lead = np.concatenate([batch.column(part).to_numpy(zero_copy_only=False).astype(np.uint8)[:, None],
                                   label.view(np.uint8).reshape(-1, 2)], axis=1)
            yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([lead, bins], axis=1).tobytes()], pa.binary())], ["b"])
    packed = rows.select("label_idx", F.col(part).cast("int").alias(part), vector_to_array("features").alias("x")).mapInArrow(pack, "b binary")
    width = len(cuts) + 3
    every = np.frombuffer(b"".join(bytes(r["b"]) for r in packed.collect()), np.uint8).reshape(-1, width)
    every = every[np.argsort(np.ascontiguousarray(every).view(f"S{width}").ravel(), kind="stable")]
    return Held(np.ascontiguousarray(every[:, 3:]), every[:, 1].astype(np.int64) * 256 + every[:, 2], every[:, 0].astype(np.int64))


# --- one tree ----------------------------------------------------------------------------

@dataclass
class Tree:
    """Nodes level by level, the first of each level in ``levels``; a leaf has ``left = -1``, a split sends bins up to ``cut``
    to the left."""
    left: np.ndarray
    right: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    levels: np.ndarray

    def leaves(self, depth: int) -> np.ndarray:
        """The leaves of the tree grown to ``depth``: two leaves of one parent with the same first largest class become one."""
        leaf = self.left < 0
        if depth < len(self.levels):
            leaf[self.levels[depth]:] = True
        best = self.value.argmax(axis=1)
        for start, end in reversed(list(zip(self.levels[:depth], self.levels[1:depth + 1]))):
            at = start + np.flatnonzero(~leaf[start:end])
            a, b = self.left[at], self.right[at]
            leaf[at[leaf[a] & leaf[b] & (best[a] == best[b])]] = True
        return leaf

    def votes(self, bins: np.ndarray, depths: Sequence[int]) -> np.ndarray:
        """Class shares by row and by depth that the tree is grown to; its nodes are those of a tree of less depth, as far as
        that one goes."""
        share = self.value / self.value.sum(axis=1, keepdims=True)
        out = np.empty((len(bins), len(depths), share.shape[1]))
        known: dict[int, int] = {}
        for i, depth in enumerate(depths):
            reached = min(depth, len(self.levels))
            if reached in known:
                out[:, i] = out[:, known[reached]]
                continue
            known[reached] = i
            leaf, at, moving = self.leaves(depth), np.zeros(len(bins), np.int64), np.arange(len(bins))
            while len(moving):
                here = at[moving]
                inner = ~leaf[here]
                moving, here = moving[inner], here[inner]
                at[moving] = np.where(bins[moving, self.feature[here]] <= self.cut[here], self.left[here], self.right[here])
            out[:, i] = share[at]
        return out


def _tried(rng: np.random.Generator, nodes: int, d: int, k: int) -> np.ndarray:
    """``k`` different features of ``d`` for every node, each set as likely as any other (Floyd's draw)."""
    if k >= d:
        return np.tile(np.arange(d), (nodes, 1))
    out = np.empty((nodes, k), np.int64)
    for i, j in enumerate(range(d - k, d)):
        drawn = rng.integers(0, j + 1, nodes)
        out[:, i] = np.where((out[:, :i] == drawn[:, None]).any(axis=1), j, drawn)
    return out


def _best_splits(bins: np.ndarray, y: np.ndarray, w: np.ndarray, slot: np.ndarray, total: np.ndarray, tried: np.ndarray,
                 min_leaf: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Score (sum of squared class weights over weight, both parts added), feature and cut of the best split of every slot;
    a slot without one has the score minus infinity.

    The values of the rows are sorted once by class and once by bin. Running sums over the first order give what each row adds
    to the squared class weights on its left, those over the second the squares at every cut, so that no histogram is built."""
    n_slots, k = tried.shape
    n_classes = total.shape[1]
    weight, squares = total.sum(axis=1), (total * total).sum(axis=1)
    score, feature, cut = np.full(n_slots, -np.inf), np.zeros(n_slots, np.int64), np.zeros(n_slots, np.int64)
    columns = max(1, CELLS_AT_ONCE // max(len(y), 1))
    for first in range(0, k, columns):
        part = tried[:, first:first + columns]
        m = part.shape[1]
        size = len(y) * m
        bits = max(int(size - 1).bit_length(), 1)
        mask = (1 << bits) - 1
        b = bins[np.arange(len(y))[:, None], part[slot]].astype(np.int64)
        group = slot[:, None] * m + np.arange(m)
        cell = np.arange(size)

        key = np.sort((((group * n_classes + y[:, None]) * MAX_BINS + b).ravel() << bits) | cell)
        order = key & mask
        each = w[order // m]
        upto = np.cumsum(each)
        starts = np.flatnonzero(np.diff(key >> (bits + 5), prepend=-1))
        before = upto - each - np.repeat((upto - each)[starts], np.diff(starts, append=size))
        adds = np.empty(size, np.int64)
        adds[order] = each * (2 * before + each)  # to the sum of squares on the left

        key = np.sort(((group * MAX_BINS + b).ravel() << bits) | cell)
        order = key & mask
        row = order // m
        key >>= bits
        starts = np.flatnonzero(np.diff(key >> 5, prepend=-1))
        run = np.diff(starts, append=size)
        ends = np.flatnonzero(np.diff(key, append=-1))  # the last row of each bin

        def running(x: np.ndarray) -> np.ndarray:
            upto = np.cumsum(x)
            return (upto - np.repeat((upto - x)[starts], run))[ends]
        n_left, sq_left = running(w[row]), running(adds[order])
        crossed = running(w[row] * total[slot[row], y[row]])
        which = key[ends] >> 5
        at = which // m
        n_right = weight[at] - n_left
        sq_right = squares[at] - 2 * crossed + sq_left
        large = (n_left >= min_leaf) & (n_right >= max(min_leaf, 1))
        value = np.where(large, sq_left / n_left + sq_right / np.maximum(n_right, 1), -np.inf)
        starts = np.flatnonzero(np.diff(at, prepend=-1))  # every slot has rows, so that there is one run for each
        top = np.maximum.reduceat(value, starts)
        hit = np.flatnonzero(value == np.repeat(top, np.diff(starts, append=len(at))))
        hit = hit[np.flatnonzero(np.diff(at[hit], prepend=-1))]  # the first of each slot
        better = top > score
        score[better] = top[better]
        feature[better] = part[at[hit], which[hit] % m][better]
        cut[better] = (key[ends[hit]] & (MAX_BINS - 1))[better]
    return score, feature, cut


def grow_tree(bins: np.ndarray, y: np.ndarray, n_classes: int, k: int, depth: int, min_leaf: int, rng: np.random.Generator) -> Tree:
    """One tree over rows drawn with replacement."""
    w = rng.poisson(1.0, len(y))
    if not w.any():
        w[rng.integers(0, len(y))] = 1
    rows = np.flatnonzero(w)
    w, node = w[rows], np.zeros(len(rows), np.int64)
    value = [np.bincount(y[rows], w, n_classes).astype(np.int64)[None]]
    left, right, feature, cut = ([np.array([x])] for x in (-1, -1, 0, 0))
    made = 1
    for _ in range(depth):
        first, total = made - len(value[-1]), value[-1]
        n = total.sum(axis=1)
        open_ = (total.max(axis=1) < n) & (n >= 2 * min_leaf)  # not pure, and large enough for two parts
        if not open_.any():
            break
        slot_of = np.cumsum(open_) - 1
        stays = open_[node - first]
        rows, w, node = rows[stays], w[stays], node[stays]
        slot, nodes, total = slot_of[node - first], np.flatnonzero(open_), total[open_]
        tried = _tried(rng, len(nodes), bins.shape[1], k)
        score, f, c = _best_splits(bins[rows], y[rows], w, slot, total, tried, min_leaf)
        gained = score > ((total * total).sum(axis=1) / total.sum(axis=1)) * (1 + 1e-12)
        if not gained.any():
            break
        child = np.cumsum(gained) * 2 - 2 + made
        at = nodes[gained]
        left[-1][at], right[-1][at] = child[gained], child[gained] + 1
        feature[-1][at], cut[-1][at] = f[gained], c[gained]
        stays = gained[slot]
        rows, w, slot = rows[stays], w[stays], slot[stays]
        node = child[slot] + (bins[rows, f[slot]] > c[slot])
        new = 2 * int(gained.sum())
        value.append(np.bincount((node - made) * n_classes + y[rows], w, new * n_classes).astype(np.int64).reshape(new, n_classes))
        for known, fill in ((left, -1), (right, -1), (feature, 0), (cut, 0)):
            known.append(np.full(new, fill))
        made += new
    sizes = [len(v) for v in value]
    return Tree(*(np.concatenate(x) for x in (left, right, feature, cut, value)), np.cumsum(sizes) - sizes)


# --- forests -----------------------------------------------------------------------------

@dataclass(frozen=True)
class Growth:
    """A forest to be grown: on the rows of some parts of held rows ``data``, voting for those of others."""
    data: int
    train: tuple[int, ...]
    asked: tuple[int, ...]
    trees: int
    depth: int
    min_leaf: int
    seed: int


def _blocks(rows: np.ndarray) -> list[np.ndarray]:
    return [rows[i:i + BLOCK_ROWS] for i in range(0, len(rows), BLOCK_ROWS)]


def _summed_votes(spark, tables: Sequence[Held], jobs: Sequence[Growth], sizes: Sequence[int], depths: Sequence[int]):
    """``job, block, segment, votes``: sums of the votes of some trees between two sizes, by blocks of the rows asked about,
    to be read once; the rows, broadcast, and the classes of each job."""
    shared = [spark.sparkContext.broadcast(t) for t in tables]
    classes = [int(tables[j.data].label[tables[j.data].at(j.train)].max()) + 1 for j in jobs]
    bounds = [0, *sorted(set(sizes))]
    per = max(1, ceil(sum(j.trees for j in jobs) / (4 * spark.sparkContext.defaultParallelism)))
    work = [(i, s, a, min(a + per, hi)) for i in range(len(jobs)) for s, (lo, hi) in enumerate(zip(bounds, bounds[1:])) for a in range(lo, hi, per)]
    depths, jobs = list(depths), list(jobs)

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in batch.column("id").to_pylist():
                i, segment, start, stop = work[at]
                job, table = jobs[i], shared[jobs[i].data].value
                train, asked = table.at(job.train), table.at(job.asked)
                bins, y, wanted = table.bins[train], table.label[train], table.bins[asked]
                k = bins.shape[1] if job.trees == 1 else ceil(sqrt(bins.shape[1]))
                total = np.zeros((len(asked), len(depths), classes[i]))
                for t in range(start, stop):
                    tree = grow_tree(bins, y, classes[i], k, job.depth, job.min_leaf, np.random.default_rng([abs(job.seed), t]))
                    for a in range(0, len(asked), 64 * BLOCK_ROWS):
                        total[a:a + 64 * BLOCK_ROWS] += tree.votes(wanted[a:a + 64 * BLOCK_ROWS], depths)
                for block, a in enumerate(range(0, len(asked), BLOCK_ROWS)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([i], pa.int32()), pa.array([block], pa.int32()), pa.array([segment], pa.int32()),
                         pa.array([total[a:a + BLOCK_ROWS].tobytes()], pa.binary())], ["job", "block", "segment", "votes"])
    ids = spark.range(0, len(work), 1, len(work))
    return ids.mapInArrow(grow, "job int, block int, segment int, votes binary"), shared, classes


def grown_accuracies(spark, tables: Sequence[Held], jobs: Sequence[Growth], sizes: Sequence[int],
                     depths: Sequence[int]) -> dict[tuple[int, int, int, int], float]:
    """Accuracy by job, part asked about, size (the first trees) and depth (the trees cut there); a part without rows has 0."""
    votes, shared, classes = _summed_votes(spark, tables, jobs, sizes, depths)
    by_size, jobs, depths = sorted(set(sizes)), list(jobs), list(depths)

    def hits(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        i, block = int(key[0]), int(key[1])
        table = shared[jobs[i].data].value
        rows = _blocks(table.at(jobs[i].asked))[block]
        added = np.zeros((len(by_size), len(rows), len(depths), classes[i]))
        for segment, sums in zip(parts["segment"], parts["votes"]):
            added[segment] += np.frombuffer(sums).reshape(added.shape[1:])
        right = np.round(np.cumsum(added, axis=0), 9).argmax(axis=3) == table.label[rows][None, :, None]
        out = []
        for part in np.unique(table.part[rows]):
            here = table.part[rows] == part
            out += [(i, int(part), by_size[s], depths[d], int(right[s, here, d].sum())) for s in range(len(by_size)) for d in range(len(depths))]
        return pd.DataFrame(out, columns=["job", "part", "size", "depth", "hits"])
    counted = votes.groupBy("job", "block").applyInPandas(hits, "job int, part int, size int, depth int, hits bigint")
    found = {(r["job"], r["part"], r["size"], r["depth"]): r["hits"] for r in
             counted.groupBy("job", "part", "size", "depth").agg(F.sum("hits").alias("hits")).collect()}
    rows = [{p: int((t.part == p).sum()) for p in set(t.part.tolist())} for t in tables]
    for b in shared:
        b.unpersist()
    return {(i, p, s, d): found.get((i, p, s, d), 0) / max(rows[j.data].get(p, 0), 1)
            for i, j in enumerate(jobs) for p in j.asked for s in by_size for d in depths}


class GrownForest:
    """A forest over held rows, grown where it is asked to predict; ``rows`` of the fit stay as they were given."""

    def __init__(self, rows: DataFrame, trees: int, depth: int, min_leaf: int, seed: int) -> None:
        self.rows, self.getNumTrees = rows, trees
        self._settings = (trees, depth, min_leaf, seed)

    def transform(self, rows: DataFrame) -> DataFrame:
        """``label_idx, prediction`` of ``rows``."""
        spark = rows.sparkSession
        trees, depth, min_leaf, seed = self._settings
        both = (self.rows.select("label_idx", "features", F.lit(0).alias("part"))
                .union(rows.select("label_idx", "features", F.lit(1).alias("part"))))
        table = held(both, thresholds(self.rows, self.rows.count()))
        votes, shared, classes = _summed_votes(spark, [table], [Growth(0, (0,), (1,), trees, depth, min_leaf, seed)], [trees], [depth])
        n_classes, asked = classes[0], shared[0]

        def predict(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
            rows = _blocks(asked.value.at((1,)))[int(key[0])]
            total = sum(np.frombuffer(v).reshape(len(rows), n_classes) for v in parts["votes"])
            return pd.DataFrame({"label_idx": asked.value.label[rows].astype(float), "prediction": np.round(total, 9).argmax(axis=1).astype(float)})
        return materialize(votes.groupBy("block").applyInPandas(predict, "label_idx double, prediction double"))
