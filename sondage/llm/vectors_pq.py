"""Near-duplicate vectors: inverted lists with product-quantised residuals, then exact cosines.

Unit vectors are assigned to the nearest of a few coarse centroids; what is left of a vector is
coded by one small codebook per group of dimensions. A link (cosine >= threshold) bounds the
distance of two unit vectors by r = sqrt(2 - 2 threshold), and that gives two tests that never
lose a link: a list whose Voronoi border lies further than r from the query need not be probed,
and a vector whose table-lookup distance to the query exceeds r by more than its own coding
error is no candidate. Candidates are compared by their true cosine in double precision.

Lists are packed to blocks of bounded size, a long list is cut into several. Which blocks must meet is told by their
lists alone; a pair of blocks is one cell of work, in which every vector looks into those lists that it reaches itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.distribute import materialize
from .common import field_type, first_by_hash, share
from .graph import components

THRESHOLD = 0.93
SAMPLE = 8_000            # vectors that centroids and codebooks are fitted on, at most
LISTS_AT_MOST = 1024
ROWS_PER_LIST = 1024
ROWS_PER_BLOCK = 4096
SUBSPACES = 8
CODES = 64
_SLACK = 1e-4


def _kmeans(x: np.ndarray, k: int, rng, rounds: int = 12) -> np.ndarray:
    """Centroids of at most ``k`` clusters; an empty one takes a random row."""
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = (x @ centres.T - 0.5 * (centres ** 2).sum(axis=1)).argmax(axis=1)
        order = np.argsort(near, kind="stable")
        size = np.bincount(near, minlength=len(centres))
        full = size > 0
        sums = np.add.reduceat(x[order], (np.cumsum(size) - size)[full], axis=0)
        centres[full] = sums / size[full, None]
        if not full.all():
            centres[~full] = x[rng.choice(len(x), int((~full).sum()))]
    return centres


class Quantiser:
    """Coarse centroids and one codebook per group of dimensions."""

    def __init__(self, sample: np.ndarray, lists: int, subspaces: int = SUBSPACES, codes: int = CODES, seed: int = 5):
        rng = np.random.default_rng(seed)
        coarse = _kmeans(sample, lists, rng)
        # Numbered along their main axis, so that lists with neighbouring numbers, which share a block, lie near each other.
        centred = coarse - coarse.mean(axis=0)
        self.coarse = coarse[np.argsort(centred @ np.linalg.svd(centred, full_matrices=False)[2][0], kind="stable")]
        left = sample - self.coarse[self.nearest(sample)]
        self.parts = np.array_split(np.arange(sample.shape[1]), min(subspaces, sample.shape[1]))
        self.books = [_kmeans(np.ascontiguousarray(left[:, p]), codes, rng) for p in self.parts]

    def distances(self, x: np.ndarray) -> np.ndarray:
        """Squared distances to the coarse centroids."""
        return np.maximum((x ** 2).sum(axis=1)[:, None] - 2 * x @ self.coarse.T + (self.coarse ** 2).sum(axis=1), 0)

    def nearest(self, x: np.ndarray) -> np.ndarray:
        return (x @ self.coarse.T - 0.5 * (self.coarse ** 2).sum(axis=1)).argmax(axis=1)

    def code(self, x: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the residuals, and how far each vector is from what its codes stand for."""
        left = x - self.coarse[lists]
        codes = np.empty((len(x), len(self.books)), np.uint8)
        error = np.zeros(len(x))
        for i, (part, book) in enumerate(zip(self.parts, self.books)):
            own = left[:, part]
            codes[:, i] = (own @ book.T - 0.5 * (book ** 2).sum(axis=1)).argmax(axis=1)
            error += ((own - book[codes[:, i]]) ** 2).sum(axis=1)
        return codes, np.sqrt(error)

    def reachable(self, x: np.ndarray, own: np.ndarray, radius: float) -> np.ndarray:
        """Which lists can hold a vector within ``radius`` of each row: the distance of the row to the
        border between its own list and the other one decides."""
        lists, at = np.unique(own, return_inverse=True)
        apart = np.stack([np.sqrt(((self.coarse - self.coarse[i]) ** 2).sum(axis=1)) for i in lists])
        near = np.empty((len(x), len(self.coarse)), bool)
        for i in range(0, len(x), 512):  # a few rows at a time: the distances are doubles
            d, part = self.distances(x[i:i + 512]), slice(i, i + 512)
            near[part] = d - np.take_along_axis(d, own[part, None], 1) <= 2 * (radius + _SLACK) * apart[at[part]] + _SLACK
        return near

    def lookup(self, x: np.ndarray, which: int, codes: np.ndarray) -> np.ndarray:
        """Squared distances of queries to coded vectors of one list, by sums of table entries."""
        left = x - self.coarse[which]
        total = np.zeros((len(x), len(codes)), np.float32)
        for i, (part, book) in enumerate(zip(self.parts, self.books)):
            own = left[:, part]
            table = (own ** 2).sum(axis=1)[:, None] - 2 * own @ book.T + (book ** 2).sum(axis=1)
            total += table.astype(np.float32)[:, codes[:, i]]
        return total


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that very large or small components do no harm."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _hook(root: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Join the trees of linked positions under their smallest root."""
    while True:
        left, right = root[left], root[right]
        apart = left != right
        if not apart.any():
            return root
        left, right = left[apart], right[apart]
        np.minimum.at(root, np.maximum(left, right), np.minimum(left, right))
        while (root[root] != root).any():
            root = root[root]


def _rows(data: bytes, width: int, kind: str) -> np.ndarray:
    """Unit vectors from the bytes of given ones."""
    return _unit(np.frombuffer(data, kind).reshape(-1, width).astype(np.float64))


def usable(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """``vec_id, label, v, n`` of the rows that can link: label given, all components finite, not all zero;
    ``n`` is the number of dimensions."""
    kind = field_type(vectors, vec_col)  # single precision travels as such
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"),
                          F.col(vec_col).cast("array<float>" if kind == "array<float>" else "array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return rows.filter(F.col("label").isNotNull() & F.col("v").isNotNull() & ~bad & F.exists("v", lambda x: x != 0)).withColumn("n", F.size("v"))


def block_of_lists(sizes: DataFrame, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """``label, list, block, cuts`` from ``label, list, count``: lists of a label with neighbouring numbers share a block, one
    beyond the size of a block is cut into ``cuts`` blocks of its own."""
    small = F.when(F.col("count") <= rows_per_block, F.col("count")).otherwise(0)
    before = F.sum(small).over(Window.partitionBy("label").orderBy("list").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return sizes.withColumn("upto", before).select(
        "label", "list", F.when(F.col("count") <= rows_per_block, F.concat(F.lit("g"), F.floor((F.col("upto") - 1) / rows_per_block).cast("string")))
        .otherwise(F.concat(F.lit("l"), F.col("list").cast("string"))).alias("block"),
        F.ceil(F.col("count") / rows_per_block).cast("int").alias("cuts"))


def link_rows(distinct: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """``rep, links, least`` from every compared pair of blocks: how many rows (copies included) a distinct
    vector links with there, and the smallest vector it is connected with there.

    ``distinct`` has ``rep`` (bigint, unique), ``label, v, copies`` with vectors of one length."""
    spark = distinct.sparkSession
    seen = first_by_hash(distinct.select("rep", "v"), "rep", sample, "pq").collect()
    if not seen:
        return spark.createDataFrame([], "rep bigint, links bigint, least bigint")
    learned = np.array([r["v"] for r in seen], np.float64)
    width, kind = learned.shape[1], "<f4" if field_type(distinct, "v") == "array<float>" else "<f8"
    largest = distinct.groupBy("label").count().agg(F.max("count")).first()[0]
    quantiser = share(spark, Quantiser(_unit(learned), int(np.clip(-(-largest // ROWS_PER_LIST), 1, LISTS_AT_MOST))))
    radius = float(np.sqrt(max(2 - 2 * threshold, 0)))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = quantiser()
        for b in batches:
            if not b.num_rows:
                continue
            given = b.column("v").flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(b.num_rows, width)
            own = q.nearest(_unit(given.astype(np.float64)))
            yield pa.RecordBatch.from_arrays(
                [b.column("rep"), b.column("label"), b.column("copies"), pa.array(own.astype(np.int32)), pa.array([r.tobytes() for r in given], pa.binary())],
                ["rep", "label", "copies", "list", "x"])
    label = field_type(distinct, "label")
    assigned = materialize(distinct.select("rep", "label", "copies", "v").mapInArrow(
        assign, f"rep bigint, label {label}, copies bigint, list int, x binary"))
    homes = materialize(block_of_lists(assigned.groupBy("label", "list").count(), rows_per_block))
    cut = F.when(F.col("cuts") > 1, F.concat(F.col("block"), F.lit("-"), F.pmod(F.xxhash64("rep"), F.col("cuts")).cast("string"))).otherwise(F.col("block"))
    blocks = assigned.join(homes, ["label", "list"]).withColumn("block", cut).drop("cuts")

    def packed(group: pa.Table) -> pa.Table:
        q = quantiser()
        group = group.sort_by([("list", "ascending"), ("rep", "ascending")])
        data = b"".join(group.column("x").to_pylist())
        x, own = _rows(data, width, kind), group.column("list").to_numpy()
        codes, error = q.code(x, own)
        near = np.flatnonzero(q.reachable(x, own, radius).any(axis=0))
        return pa.table({
            "label": group.column("label")[:1], "block": group.column("block")[:1],
            "x": pa.array([data], pa.binary()), "codes": pa.array([codes.tobytes()], pa.binary()),
            "error": pa.array([error.tobytes()], pa.binary()), "lists": pa.array([own.astype(np.int32).tobytes()], pa.binary()),
            "reps": pa.array([group.column("rep").to_numpy().astype(np.int64).tobytes()], pa.binary()),
            "copies": pa.array([group.column("copies").to_numpy().astype(np.int64).tobytes()], pa.binary()),
            "probes": pa.array([near.tolist()], pa.list_(pa.int32())), "own": pa.array([np.unique(own).tolist()], pa.list_(pa.int32()))})
    packed_rows = materialize(blocks.groupBy("label", "block").applyInArrow(
        packed, f"label {label}, block string, x binary, codes binary, error binary, lists binary, reps binary, copies binary, "
                "probes array<int>, own array<int>"))
    # Names of blocks that must meet; a link is within the reach of both its ends, so that one order of the two is enough.
    place = packed_rows.select("label", F.col("block").alias("block_b"), F.explode("own").alias("probe"))
    cells = materialize(packed_rows.select("label", F.col("block").alias("block_a"), F.explode("probes").alias("probe"))
                        .join(place, ["label", "probe"]).filter("block_a <= block_b").select("label", "block_a", "block_b").distinct())
    # Both sides are dealt out by the same count of tasks, which small sizes do not melt together: a cell is much work.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    left = cells.join(packed_rows.select("label", F.col("block").alias("block_a"), F.col("x").alias("x_a"), F.col("lists").alias("lists_a"),
                                         F.col("reps").alias("reps_a"), F.col("copies").alias("copies_a")), ["label", "block_a"])
    right = packed_rows.select("label", F.col("block").alias("block_b"), F.col("x").alias("x_b"), "codes", "error", F.col("lists").alias("lists_b"),
                               F.col("reps").alias("reps_b"), F.col("copies").alias("copies_b"))
    met = left.repartition(tasks, "label", "block_b").join(right.repartition(tasks, "label", "block_b"), ["label", "block_b"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = quantiser()
        for b in batches:
            for at in range(b.num_rows):  # a cell at a time
                row = b.slice(at, 1).to_pylist()[0]
                reps, links, least = _compare(q, row, width, kind, radius, threshold)
                if len(reps):
                    yield pa.RecordBatch.from_arrays([pa.array(reps), pa.array(links), pa.array(least)], ["rep", "links", "least"])
    return met.select("x_a", "lists_a", "reps_a", "copies_a", "x_b", "codes", "error", "lists_b", "reps_b", "copies_b").mapInArrow(
        compare, "rep bigint, links bigint, least bigint")


def _compare(q: Quantiser, row: dict, width: int, kind: str, radius: float, threshold: float):
    """Links within one cell: counts per vector, and the smallest vector each is connected with inside it."""
    xa, xb = (_rows(row[k], width, kind) for k in ("x_a", "x_b"))
    ra, rb, ca, cb = (np.frombuffer(row[k], np.int64) for k in ("reps_a", "reps_b", "copies_a", "copies_b"))
    la, lb = (np.frombuffer(row[k], np.int32) for k in ("lists_a", "lists_b"))
    codes = np.frombuffer(row["codes"], np.uint8).reshape(len(xb), -1)
    reach = (radius + np.frombuffer(row["error"], np.float64) + _SLACK) ** 2
    same = row["reps_a"] == row["reps_b"]
    ids = np.unique(np.concatenate([ra, rb]))
    at_a, at_b = np.searchsorted(ids, ra), np.searchsorted(ids, rb)
    links, root = np.zeros(len(ids), np.int64), np.arange(len(ids))
    for at in range(0, len(xa), 512):  # linked pairs are counted and joined at once, never kept
        part = slice(at, at + 512)
        probed = q.reachable(xa[part], la[part], radius)
        for which in np.unique(lb):
            rows = at + np.flatnonzero(probed[:, which])
            first, last = np.searchsorted(lb, which), np.searchsorted(lb, which, side="right")
            if not len(rows):
                continue
            near = q.lookup(xa[rows], int(which), codes[first:last]) <= reach[first:last].astype(np.float32) + np.float32(_SLACK)
            a, b = np.nonzero(near)
            a, b = rows[a], b + first
            if same:
                a, b = a[ra[a] < rb[b]], b[ra[a] < rb[b]]
            for i in range(0, len(a), 100_000):
                one, two = a[i:i + 100_000], b[i:i + 100_000]
                linked = np.einsum("ij,ij->i", xa[one], xb[two]) >= threshold
                one, two = one[linked], two[linked]
                links += np.bincount(at_a[one], cb[two], len(ids)).astype(np.int64) + np.bincount(at_b[two], ca[one], len(ids)).astype(np.int64)
                root = _hook(root, at_a[one], at_b[two])
    some = links > 0
    return ids[some], links[some], ids[root[some]]


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vec_col: str = "embedding",
                    label_col: str = "label", sample: int = SAMPLE) -> DataFrame:
    """One row per input row: ``vec_id, n_links, component_id, kept``.

    Vectors that are null, empty, all zero or hold null or non-finite components, and rows with a
    null label or id, link with nothing and are their own component. Equal vectors of a label are
    compared once; copies count as links of each other and of all that the vector links with (a row
    repeated with its id counts as a copy). Vectors of different length do not link. An empty table
    gives no rows."""
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vec_col).alias("v"))
    live = usable(vectors, id_col, vec_col, label_col).filter("vec_id IS NOT NULL")
    keyed = live.select("vec_id", "label", "n", "v", F.unhex(F.sha2(F.concat(
        F.col("label").cast("string"), F.lit(":"), F.col("v").cast("string")).cast("binary"), 256)).alias("same"))
    distinct = materialize(keyed.groupBy("same").agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("copies"),
                                                     F.first("label").alias("label"), F.first("n").alias("n"), F.first("v").alias("v"))
                           .withColumn("rep", F.monotonically_increasing_id()))
    lengths = [r["n"] for r in distinct.select("n").distinct().orderBy("n").collect()]
    found = None
    for n in lengths:
        part = link_rows(distinct.filter(F.col("n") == n), threshold, sample)
        found = part if found is None else found.union(part)
    if found is None:
        return rows.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    found = materialize(found)
    comp = components(found.select(F.col("rep").alias("a"), F.col("least").alias("b"))).withColumnRenamed("v", "rep")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    told = materialize(distinct.select("rep", "same", "copies", "first_id").join(links, "rep", "left").join(comp, "rep", "left").select(
        "same", "first_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component")))
    smallest = materialize(told.groupBy("component").agg(F.min("first_id").alias("component_id")))
    told = materialize(told.join(smallest, "component").select("same", "n_links", "component_id"))
    linked = keyed.select("vec_id", "same").join(told, "same").select("vec_id", "n_links", "component_id")
    bad = F.exists(F.col("v"), lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == F.lit(float("inf"))))
    alone = rows.filter(F.col("label").isNull() | F.col("vec_id").isNull() | F.col("v").isNull() | F.coalesce(bad, F.lit(True))
                        | ~F.coalesce(F.exists("v", lambda x: x != 0), F.lit(False))).select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
