"""Exact nearest neighbours and their votes.

``nearest`` returns one row per query with its ``k`` neighbours in order
(distance, then id). Two ways, both exact and without a cross join:

* reference rows within ``limit_bytes`` are broadcast as one matrix;
* otherwise references are packed to groups about as large as a task can hold,
  by their nearest pivot and the distance to it. A query is first compared with
  its home group; the distance of its k-th neighbour there and the triangle
  inequality rule out groups, and each remaining (queries, group) cell is one
  matrix product that only ``k`` candidates per query leave. Where vectors do
  not cluster, nothing can be ruled out and a query goes to every group: exact
  search visits all pairs, but a query is copied once per group, not per block.

Votes read the neighbour array of their own row, so every ``k`` of a sweep
comes from one search without another shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import let
from .distribute import BROADCAST_BYTES, materialize

PIVOTS = 64
BLOCK_ROWS = 1 << 14
TILE_ROWS = 1 << 12
ASKED_ROWS = 1 << 12
RINGS = 64
MAX_BLOCKS = 1 << 17
_PAIRS_AT_ONCE = 1 << 16
_CELLS_AT_ONCE = 1 << 24


def _matrix(values: Sequence, dim: int) -> np.ndarray:
    return np.concatenate([np.asarray(v, dtype=np.float64) for v in values]).reshape(-1, dim)


def _lengths(x: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", x, x)


def _distances(q: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Squared distances by one matrix product (rounding error: see ``_slack``)."""
    near = q @ r.T
    near *= -2.0
    near += _lengths(q)[:, None]
    near += _lengths(r)[None, :]
    return near


def _slack(q: np.ndarray, r: np.ndarray) -> np.ndarray:
    size = _lengths(q) + _lengths(r).max()
    return 8.0 * (q.shape[1] + 4) * np.finfo(np.float64).eps * size


def _ordered(rows: np.ndarray, cols: np.ndarray, exact: np.ndarray, ids: np.ndarray, k: int):
    """The ``k`` first of each row by distance and id."""
    order = np.lexsort((ids[cols], exact, rows))
    rows, cols, exact = rows[order], cols[order], exact[order]
    keep = np.arange(len(rows)) - np.searchsorted(rows, rows) < k
    return rows[keep], cols[keep], exact[keep]


def _top(q: np.ndarray, r: np.ndarray, ids: np.ndarray, k: int, tile: int = TILE_ROWS):
    """Row of ``q``, row of ``r`` and exact distance of the ``k`` nearest, in order.

    The references are taken ``tile`` rows at a time, so that memory does not grow with their number. The matrix
    product only picks candidates, with a margin above its rounding error, among those no further than the ``k``
    nearest of the tiles before; their distances are then taken from the differences.
    """
    slack = 2.0 * _slack(q, r)
    bound = np.full(len(q), np.inf)
    found = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    for start in range(0, len(r), tile):
        part = r[start:start + tile]
        near = _distances(q, part)
        hit = near <= (bound + slack)[:, None]
        most = min(k, len(part))
        if np.count_nonzero(hit) > 4 * most * len(q):
            hit &= near <= (np.partition(near, most - 1, axis=1)[:, most - 1] + slack)[:, None]
        rows, cols = np.nonzero(hit)
        exact = np.empty(len(rows))
        for at in range(0, len(rows), _PAIRS_AT_ONCE):
            some = slice(at, at + _PAIRS_AT_ONCE)
            diff = q[rows[some]] - part[cols[some]]
            exact[some] = (diff * diff).sum(axis=1)
        found = _ordered(*(np.concatenate(two) for two in zip(found, (rows, cols + start, exact))), ids, k)
        ends = np.searchsorted(found[0], np.arange(1, len(q) + 1))
        full = np.diff(ends, prepend=0) == k
        bound[full] = found[2][ends[full] - 1]
    return found[0], found[1], np.sqrt(found[2])


def _answers(query_ids, q, r, ref_ids, labels, k: int, step: int = 256):
    """Pandas batches of neighbour lists, a few queries at a time."""
    for at in range(0, len(q), step):
        part = q[at:at + step]
        rows, cols, dist = _top(part, r, ref_ids, k)
        ends = np.searchsorted(rows, np.arange(1, len(part)))
        yield pd.DataFrame({
            "query_id": query_ids[at:at + step],
            "ref_id": np.split(ref_ids[cols], ends),
            "dist": np.split(dist, ends),
            "label": np.split(labels[cols], ends)})


def _schemas(queries: DataFrame, refs: DataFrame) -> tuple[str, str, str]:
    def kind(df, c):
        return df.schema[c].dataType.simpleString()
    return kind(queries, "query_id"), kind(refs, "ref_id"), kind(refs, "label")


def _search_broadcast(queries: DataFrame, refs: DataFrame, k: int, dim: int) -> DataFrame:
    table = refs.toPandas()  # within limit_bytes, checked by the caller
    shared = queries.sparkSession.sparkContext.broadcast((
        table["ref_id"].to_numpy(), _matrix(table["vec"], dim), table["label"].to_numpy()))
    qt, rt, lt = _schemas(queries, refs)

    def search(batches):
        ids, r, labels = shared.value
        for batch in batches:
            if len(batch):
                yield from _answers(batch["query_id"].to_numpy(), _matrix(batch["vec"], dim),
                                    r, ids, labels, k)

    found = queries.mapInPandas(
        search, f"query_id {qt}, ref_id array<{rt}>, dist array<double>, label array<{lt}>")
    return found.select("query_id", F.arrays_zip("ref_id", "dist", "label").alias("neighbours"))


def _assign(df: DataFrame, pivots: np.ndarray, dim: int) -> DataFrame:
    """Nearest pivot of each row and the distance to it."""
    shared = df.sparkSession.sparkContext.broadcast(pivots)
    schema = T.StructType([*df.schema.fields, T.StructField("cell", T.IntegerType()),
                           T.StructField("gap", T.DoubleType())])

    def assign(batches):
        for batch in batches:
            if len(batch):
                rows = _matrix(batch["vec"], dim)
                cell = _distances(rows, shared.value).argmin(axis=1)
                diff = rows - shared.value[cell]
                yield batch.assign(cell=cell.astype(np.int32), gap=np.sqrt((diff * diff).sum(1)))
    return df.mapInPandas(assign, schema)


def _groups(refs: DataFrame, n_rows: int, group_rows: int) -> DataFrame:
    """References with the ``block``, of about ``group_rows`` rows, that each is in. A cell is cut into rings by the
    distance to its pivot, so that few groups lie in a query's reach; rows that share a ring's distance by
    chance of rounding are cut by hash."""
    per_group = max(group_rows, -(-n_rows // MAX_BLOCKS))
    cuts = F.percentile_approx("gap", [i / RINGS for i in range(1, RINGS)], 10_000)
    cells = refs.groupBy("cell").agg(F.count(F.lit(1)).alias("size"), cuts.alias("cuts"))  # one row per pivot
    wanted = F.least(F.ceil(F.col("size") / F.lit(per_group)), F.lit(RINGS))
    ringed = refs.join(F.broadcast(cells), "cell").withColumn("ring", F.floor(
        F.size(F.filter("cuts", lambda c: c < F.col("gap"))) * wanted / F.lit(RINGS)).cast("int")).drop("size", "cuts")
    ringed = materialize(ringed)
    sizes = ringed.groupBy("cell", "ring").agg(F.count(F.lit(1)).alias("size"))  # at most RINGS rows per pivot
    salted = ringed.join(F.broadcast(sizes), ["cell", "ring"]).withColumn(
        "salt", F.pmod(F.xxhash64("ref_id"), F.ceil(F.col("size") / F.lit(2 * per_group))).cast("int"))
    return salted.withColumn("block", F.concat_ws("-", "cell", "ring", "salt"))


def _packed(rows: DataFrame, key: str, others: Sequence[str], vecs: str, at_once: int) -> DataFrame:
    """The rows ``key, vec, *others`` of a key side by side, at most about ``at_once`` in each row of the result.

    Rows are written and moved singly and meet after the shuffle: a table of such wide rows would be read in
    batches that no task holds."""
    sizes = materialize(rows.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / at_once).alias("parts")))
    marked = rows.hint("merge").join(sizes, key).withColumn("part", F.pmod(F.xxhash64(others[0]), F.col("parts")))
    return marked.groupBy(key, "part").agg(F.collect_list(F.struct("vec", *others)).alias("m")).select(
        key, F.flatten("m.vec").alias(vecs), *[F.col(f"m.{c}").alias(c) for c in others])


class _Reach:
    """Which groups a query must see, from the pivots and the ranges of the groups."""

    def __init__(self, pivots: np.ndarray, stats: pd.DataFrame, k: int):
        self.pivots, self.k = pivots, k
        self.names, self.cell = stats["block"].to_numpy(), stats["cell"].to_numpy()
        self.inner, self.outer, self.size = (stats[c].to_numpy() for c in ("inner", "outer", "n"))
        self.at_once = max(1, _CELLS_AT_ONCE // max(len(self.names), 1))

    def _gaps(self, q: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(_distances(q, self.pivots), 0.0))[:, self.cell]

    def home(self, q: np.ndarray) -> np.ndarray:
        """The group closest by its range of distances, if possible one with k rows."""
        gap = self._gaps(q)
        least = np.maximum(np.maximum(gap - self.outer, self.inner - gap), 0.0)
        return np.lexsort((gap, least, np.broadcast_to(self.size < self.k, gap.shape)), axis=-1)[:, 0]

    def rest(self, q: np.ndarray, home: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Query x group: may the group, other than the home, hold one nearer than ``radius``?"""
        gap = self._gaps(q)
        least = np.maximum(gap - self.outer, self.inner - gap)
        possible = least <= (radius + 4.0 * np.sqrt(_slack(q, self.pivots)))[:, None]
        possible[np.arange(len(q)), home] = False
        return possible


def _search_groups(queries: DataFrame, refs: DataFrame, k: int, dim: int, n_refs: int, n_pivots: int,
                   group_rows: int) -> tuple[DataFrame, DataFrame]:
    """The neighbours, and the further (queries, group) cells that were compared."""
    context = queries.sparkSession.sparkContext
    chosen = (refs.orderBy(F.xxhash64("ref_id"), "ref_id").limit(n_pivots).select("vec").collect())
    pivots = _matrix([p["vec"] for p in chosen], dim)
    groups = materialize(_groups(_assign(refs, pivots, dim), n_refs, group_rows))
    # At most MAX_BLOCKS + n_pivots x RINGS rows of five numbers.
    stats = groups.groupBy("block", "cell").agg(F.min("gap").alias("inner"), F.max("gap").alias("outer"), F.count(F.lit(1)).alias("n"))
    stats = stats.select("block", "cell", "inner", "outer", "n").orderBy("block").toPandas()
    shared = context.broadcast((pivots, stats))
    qt, rt, lt = _schemas(queries, refs)
    asked_type = T.StructType([queries.schema["query_id"], queries.schema["vec"], T.StructField("block", T.ArrayType(T.StringType()))])

    def at_home(batches):
        reach = _Reach(*shared.value, k)
        for batch in batches:
            for at in range(0, len(batch), reach.at_once):
                part = batch.iloc[at:at + reach.at_once]
                home = reach.home(_matrix(part["vec"], dim))
                yield part.assign(block=[[name] for name in reach.names[home]])

    def search(batches):
        for batch in batches:
            for row in batch.itertuples(index=False):
                q = np.asarray(row.qvecs, dtype=np.float64).reshape(-1, dim)
                for found in _answers(np.asarray(row.query_id), q, np.asarray(row.vecs, dtype=np.float64).reshape(-1, dim),
                                      np.asarray(row.ref_id), np.asarray(row.label), k):
                    yield found.assign(block=row.block)

    def compare(asked: DataFrame) -> DataFrame:
        single = asked.select("query_id", "vec", F.explode("block").alias("block"))
        tables = _packed(groups, "block", ("ref_id", "label"), "vecs", n_refs)  # a group is one row
        # By shuffle: what the queries come to is not known from the size of their table.
        return _packed(single, "block", ("query_id",), "qvecs", ASKED_ROWS).hint("merge").join(tables, "block").mapInPandas(
            search, f"query_id {qt}, ref_id array<{rt}>, dist array<double>, label array<{lt}>, block string")
    first = materialize(compare(materialize(queries.select("query_id", "vec").mapInPandas(at_home, asked_type))))
    # The true k-th distance at home bounds the search elsewhere; a home of fewer rows bounds nothing.
    radius = first.select("query_id", "block", F.when(F.size("dist") >= k, F.get("dist", F.lit(k - 1)))
                          .otherwise(F.lit(float("inf"))).alias("radius"))
    waiting = queries.select("query_id", "vec").join(radius, "query_id")

    def elsewhere(batches):
        reach = _Reach(*shared.value, k)
        place = {name: i for i, name in enumerate(reach.names)}
        for batch in batches:
            for at in range(0, len(batch), reach.at_once):
                part = batch.iloc[at:at + reach.at_once]
                rows = _matrix(part["vec"], dim)
                hits = reach.rest(rows, part["block"].map(place).to_numpy(), part["radius"].to_numpy())
                yield part[["query_id", "vec"]].assign(block=[list(reach.names[hit]) for hit in hits])
    further = materialize(waiting.mapInPandas(elsewhere, asked_type))
    found = first.drop("block").unionByName(compare(further).drop("block"))
    single = found.select("query_id", F.explode(F.arrays_zip("ref_id", "dist", "label")).alias("x"))
    best = Window.partitionBy("query_id").orderBy("x.dist", "x.ref_id")
    nearest_of = (single.withColumn("rk", F.row_number().over(best)).filter(F.col("rk") <= k)
                  .groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rk", "x"))).alias("s"))
                  .select("query_id", F.col("s.x").alias("neighbours")))
    return nearest_of, further.select(F.explode("block").alias("block")).groupBy("block").agg(F.count(F.lit(1)).alias("queries"))


def _without_spare_copies(refs: DataFrame, k: int) -> DataFrame:
    """Of equal vectors only the ``k`` smallest ids can be among the ``k`` nearest, as
    ties go to the smaller id. Spark applies the limit before the shuffle, too, so a
    large group of copies does not meet in one task."""
    copies = Window.partitionBy("vec").orderBy("ref_id")
    return refs.withColumn("copy", F.row_number().over(copies)).filter(F.col("copy") <= k).drop("copy")


def nearest(queries: DataFrame, refs: DataFrame, k: int, *, query_id: str, ref_id: str, vec: str,
            label: str, limit_bytes: int = BROADCAST_BYTES, n_pivots: int = PIVOTS,
            block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``query_id, neighbours array<struct<ref_id, dist, label>>``, Euclidean, exact; ``query_id`` is unique."""
    q = queries.select(F.col(query_id).alias("query_id"), F.col(vec).cast("array<double>").alias("vec"))
    r = refs.select(F.col(ref_id).alias("ref_id"), F.col(vec).cast("array<double>").alias("vec"),
                    F.col(label).alias("label"))
    r = materialize(r)
    size = r.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("dim"),
                 F.min(F.size("vec")).alias("low")).first()
    if not size["n"]:
        raise ValueError("no reference rows")
    if size["dim"] != size["low"]:
        raise ValueError("vectors differ in length")
    if size["n"] * (size["dim"] + 4) * 8 <= limit_bytes:
        return _search_broadcast(q, r, k, size["dim"])
    r = materialize(_without_spare_copies(r, k))
    return _search_groups(q, r, k, size["dim"], size["n"], n_pivots, block_rows)[0]


def _probes(code: np.ndarray, gap: np.ndarray, probes: int) -> np.ndarray:
    """Bucket of every row and the ``probes - 1`` buckets that are nearest by the projections whose signs differ.

    Of the sets of up to two of the closest planes those with the least summed distance are flipped."""
    close = np.argsort(gap, axis=1)[:, :max(int(np.ceil(np.sqrt(2 * probes))) + 1, 1)]
    sets = [(i,) for i in range(close.shape[1])] + [(i, j) for i in range(close.shape[1]) for j in range(i)]
    rows = np.arange(len(code))
    cost = np.stack([sum(gap[rows, close[:, i]] for i in s) for s in sets], axis=1)
    flips = np.stack([sum(np.int64(1) << close[:, i].astype(np.int64) for i in s) for s in sets], axis=1)
    best = np.argsort(cost, axis=1, kind="stable")[:, :max(probes - 1, 0)]
    return np.concatenate([code[:, None], code[:, None] ^ np.take_along_axis(flips, best, axis=1)], axis=1)


class _Planes:
    """Random hyperplanes through the mean of the references, ``bits`` for each of ``tables`` hash tables."""

    def __init__(self, mean: np.ndarray, tables: int, bits: int, seed: int):
        self.mean, self.tables, self.bits = mean, tables, bits
        self.planes = np.random.default_rng(seed).standard_normal((len(mean), tables * bits))

    def codes(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """rows x tables codes, and rows x tables x bits distances to the planes."""
        along = ((x - self.mean) @ self.planes).reshape(len(x), self.tables, self.bits)
        return ((along > 0).astype(np.int64) << np.arange(self.bits)).sum(axis=2), np.abs(along)


def nearest_approximate(queries: DataFrame, refs: DataFrame, k: int, *, query_id: str, ref_id: str, vec: str, label: str,
                        tables: int = 16, probes: int = 16, bucket_rows: int = 256, block_rows: int = BLOCK_ROWS,
                        seed: int = 0) -> DataFrame:
    """As ``nearest``, but a query sees only references of the buckets it probes; distances are exact, neighbours may be missed.

    ``tables`` hash tables of random projections, each with buckets of about ``bucket_rows`` references; a query looks
    into ``probes`` buckets of each, those on the other side of its closest planes first. More tables and probes raise the
    recall. A query whose buckets are all empty has an empty list. ``nearest`` is the exact search, and the default of
    every vote."""
    q = queries.select(F.col(query_id).alias("query_id"), F.col(vec).cast("array<double>").alias("vec"))
    r = refs.select(F.col(ref_id).alias("ref_id"), F.col(vec).cast("array<double>").alias("vec"), F.col(label).alias("label"))
    r = materialize(_without_spare_copies(r, k))
    size = r.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("dim"), F.min(F.size("vec")).alias("low")).first()
    if not size["n"]:
        raise ValueError("no reference rows")
    if size["dim"] != size["low"]:
        raise ValueError("vectors differ in length")
    dim = size["dim"]
    mean = np.array(r.agg(*[F.avg(F.get("vec", F.lit(i))) for i in range(dim)]).first(), np.float64)
    bits = min(max(int(np.ceil(np.log2(max(size["n"] / bucket_rows, 1)))), 1), 62)
    shared = q.sparkSession.sparkContext.broadcast(_Planes(mean, tables, bits, seed))
    qt, rt, lt = _schemas(q, r)
    first = np.arange(tables, dtype=np.int64) << bits  # a bucket is its table's number before its code

    def fill(batches):
        for batch in batches:
            if len(batch):
                codes, _ = shared.value.codes(_matrix(batch["vec"], dim))
                yield batch.assign(bucket=list(codes + first))

    def ask(batches):
        for batch in batches:
            if len(batch):
                codes, gaps = shared.value.codes(_matrix(batch["vec"], dim))
                wanted = [_probes(codes[:, t], gaps[:, t], probes) + first[t] for t in range(tables)]
                yield batch.assign(bucket=list(np.concatenate(wanted, axis=1)))

    def placed(rows: DataFrame, fn) -> DataFrame:
        buckets = T.StructField("bucket", T.ArrayType(T.LongType()))
        return materialize(rows.mapInPandas(fn, T.StructType([*rows.schema.fields, buckets])))

    def packed(rows: DataFrame, others: Sequence[str], vecs: str, at_once: int) -> DataFrame:
        return _packed(rows.select("vec", *others, F.explode(F.array_distinct("bucket")).alias("bucket")), "bucket", others, vecs, at_once)
    held = packed(placed(r, fill), ("ref_id", "label"), "vecs", block_rows)
    asked = packed(placed(q, ask), ("query_id",), "qvecs", ASKED_ROWS)

    def search(batches):
        for batch in batches:
            for row in batch.itertuples(index=False):
                own = np.asarray(row.qvecs, dtype=np.float64).reshape(-1, dim)
                yield from _answers(np.asarray(row.query_id), own, np.asarray(row.vecs, dtype=np.float64).reshape(-1, dim),
                                    np.asarray(row.ref_id), np.asarray(row.label), k)
    # By shuffle: a query has a copy for every bucket it probes, which the size of its table does not tell.
    found = asked.hint("merge").join(held, "bucket").mapInPandas(
        search, f"query_id {qt}, ref_id array<{rt}>, dist array<double>, label array<{lt}>")
    single = found.select("query_id", F.explode(F.arrays_zip("ref_id", "dist", "label")).alias("x"))
    # A reference comes from several tables, always at the same distance.
    once = single.groupBy("query_id", "x.ref_id").agg(F.min("x").alias("x")).select("query_id", "x")
    best = Window.partitionBy("query_id").orderBy("x.dist", "x.ref_id")
    lists = (once.withColumn("rk", F.row_number().over(best)).filter(F.col("rk") <= k)
             .groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rk", "x"))).alias("s")).select("query_id", F.col("s.x").alias("neighbours")))
    none = F.array().cast(lists.schema["neighbours"].dataType)
    return q.select("query_id").join(lists, "query_id", "left").withColumn("neighbours", F.coalesce("neighbours", none))


def vote(neighbours: str | Column, k: int, weights: str = "uniform") -> Column:
    """Winning label of the first ``k`` neighbours; ties go to the smallest label.

    ``distance`` weighs by 1/d; where a neighbour has distance 0, only such
    neighbours count.
    """
    everyone = F.col(neighbours) if isinstance(neighbours, str) else neighbours

    def winner(first: Column) -> Column:
        def weight(n: Column) -> Column:
            if weights == "uniform":
                return F.lit(1.0)
            copy = F.get(first, F.lit(0))["dist"] == 0
            return (F.when(copy, (n["dist"] == 0).cast("double"))
                    .otherwise(F.try_divide(F.lit(1.0), n["dist"])))
        labels = F.array_distinct(F.transform(first, lambda n: n["label"]))
        scored = F.transform(labels, lambda one: F.struct(
            (-F.round(F.aggregate(F.filter(first, lambda n: n["label"] == one), F.lit(0.0),
                                  lambda acc, n: acc + weight(n)), 9)).alias("w"), one.alias("label")))
        return F.array_min(scored)["label"]

    return let(F.slice(everyone, 1, k), winner)


def k_sweep(found: DataFrame, truth: str, ks: Sequence[int], weights: str = "distance") -> DataFrame:
    """Accuracy per ``k`` from one neighbour table; ``truth`` is a column of ``found``."""
    hits = found.agg(*[F.avg((vote("neighbours", k, weights) == F.col(truth)).cast("double")).alias(f"k{k}")
                       for k in ks])
    return hits.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(k).alias("k"), F.col(f"k{k}").alias("accuracy"))
        for i, k in enumerate(ks)])))


def committee(neighbours: str | Column, bag: int, classes: Sequence,
              ks: Sequence[int] = (1, 2, 3, 4, 5)) -> Column:
    """Majority of ``bag`` distance-weighted voters, which differ in ``k``.

    All voters see the same rows; ties go to the earlier class in ``classes``.
    """
    ballots = F.array(*[vote(neighbours, ks[i % len(ks)], "distance") for i in range(bag)])
    return let(ballots, lambda b: F.array_min(F.array(*[
        F.struct((-F.size(F.filter(b, lambda p: p == F.lit(c)))).alias("w"), F.lit(i).alias("i"),
                 F.lit(c).alias("c")) for i, c in enumerate(classes)]))["c"])
