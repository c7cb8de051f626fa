"""Centroid clustering of integer vectors with geometric drift tightening.

Every vector carries the number of its centroid, an upper bound on the distance to it and a lower
bound on the distance to all others. When the centroids have moved, the lower bound of a vector
need not shrink by the full drift D of another centroid: with M the middle of the old and the new
place, the vector x comes closer to that centroid by

    |x - old| - |x - new| = 2 s D / (|x - old| + |x - new|) <= D cos(angle at M between x and the drift),

where s is the part of x - M along the drift (the sum of both distances is at least 2 |x - M|). All
vectors of a cluster lie in a sphere about its old centroid, which is seen from M under the angle
asin(radius / distance). In the plane through M, the sphere's centre and the drift this gives the
least possible angle, hence one loosening for each cluster, less than the full drift unless the
sphere reaches into the drift's direction. Vectors whose bounds then still tell the centroids
apart keep theirs unseen; of the others the distance to their own centroid is taken first, and
only if that is still ambiguous all centroids are scanned, in exact integers.

A round is one pass over the written vectors and one aggregation of sums, counts and radii per
cluster; what meets on the driver is a row per centroid.
"""

from __future__ import annotations

import hashlib
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.distribute import materialize
from .common import field_type, map_batches

DIMENSIONS = 64
CENTROIDS = 16
ROUNDS = 3
SCALE = 64.0
SEED = 1
#: Components beyond this do not leave room for a squared distance in 64 bits.
LARGEST = 1 << 27
#: Up to this size the products and sums of doubles are exact integers.
_EXACT_IN_DOUBLES = 1 << 20
_SLACK = 1e-9


def integers(vectors: DataFrame, id_col: str, vec_col: str, dimensions: int, scale: float) -> DataFrame:
    """``vec_id, x`` (array of int): floor(scale * component) of the vectors that can be used."""
    # The cast first, so that arrays of strings or decimals work as well.
    e = F.col(vec_col).cast("array<double>")
    whole = F.transform(e, lambda v: F.floor(v * F.lit(float(scale))))
    good = (F.size(e) == dimensions) & F.forall(e, lambda v: v.isNotNull() & (F.abs(v) * scale < float(LARGEST)))
    return (vectors.select(F.col(id_col).alias("vec_id"), F.when(F.coalesce(good, F.lit(False)), whole).cast("array<int>").alias("x"))
            .filter("x IS NOT NULL"))


def id_hash(seed: int = SEED) -> Column:
    return F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)


def first_centroids(rows: DataFrame, k: int, seed: int = SEED) -> np.ndarray:
    """The vectors whose hashed ids are smallest (equal ids: by components), in this order."""
    best = rows.select(id_hash(seed).alias("h"), "x").orderBy("h", "x").limit(k).collect()
    return np.array([r["x"] for r in best], np.int64) if best else np.zeros((0, 0), np.int64)


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of ``x`` to all rows of ``c``."""
    if max(np.abs(x).max(initial=0), np.abs(c).max(initial=0)) <= _EXACT_IN_DOUBLES:
        a, b = x.astype(np.float64), c.astype(np.float64)
        d = (a * a).sum(axis=1)[:, None] - 2.0 * (a @ b.T) + (b * b).sum(axis=1)[None, :]
        return d.astype(np.int64)
    return np.stack([((x - row) ** 2).sum(axis=1) for row in c], axis=1)


def own_squared(x: np.ndarray, c: np.ndarray, own: np.ndarray) -> np.ndarray:
    gap = x - c[own]
    return (gap * gap).sum(axis=1)


def loosening(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """By how much the lower bound of a cluster's vectors must shrink when ``old`` became ``new``."""
    k = len(old)
    out = np.zeros(k)
    drift = np.sqrt(((new - old).astype(np.float64) ** 2).sum(axis=1))
    for j in np.flatnonzero(drift > 0):
        middle, along = (old[j] + new[j]) / 2.0, (new[j] - old[j]) / drift[j]
        to_centre = old - middle
        apart = np.sqrt((to_centre ** 2).sum(axis=1))
        with np.errstate(divide="ignore", invalid="ignore"):
            seen = np.arccos(np.clip(to_centre @ along / apart, -1.0, 1.0))
            half = np.arcsin(np.clip(radius * (1 + _SLACK) / apart, 0.0, 1.0))
        angle = np.where(radius * (1 + _SLACK) >= apart, 0.0, np.maximum(seen - half - _SLACK, 0.0))
        move = drift[j] * np.maximum(np.cos(angle), 0.0)
        move[j] = 0.0
        out = np.maximum(out, move)
    return out * (1 + _SLACK) + _SLACK


def scan(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest centroid (ties: the smaller number), its distance, and the distance of the next."""
    d = squared(x, c)
    own = d.argmin(axis=1)
    at = np.arange(len(x))
    upper = np.sqrt(d[at, own].astype(np.float64))
    d = d.astype(np.float64)
    d[at, own] = np.inf
    return own, upper, np.sqrt(d.min(axis=1))


def reassign(x: np.ndarray, c: np.ndarray, own: np.ndarray, upper: np.ndarray, lower: np.ndarray,
             drift: np.ndarray, loose: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Own centroid and bounds after a move, and how many vectors were scanned."""
    own, upper, lower = own.copy(), upper + drift[own], np.maximum(lower - loose[own], 0.0)
    between = np.sqrt(squared(c, c).astype(np.float64))
    np.fill_diagonal(between, np.inf)
    nearest = between.min(axis=1)[own]

    def unsure() -> np.ndarray:
        other = np.maximum(lower, nearest - upper)  # the triangle of vector, own and nearest other centroid
        return np.flatnonzero(upper * (1 + _SLACK) + _SLACK >= other * (1 - _SLACK))
    near = unsure()
    upper[near] = np.sqrt(own_squared(x[near], c, own[near]).astype(np.float64))
    near = unsure()
    if len(near):
        own[near], upper[near], lower[near] = scan(x[near], c)
    return own, upper, lower, len(near)


def _matrix(batch: pa.RecordBatch, name: str = "x") -> np.ndarray:
    column = batch.column(name)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(batch.num_rows, -1)


STATE = "own int, upper double, lower double, scanned int"


def _state(batch: pa.RecordBatch, own, upper, lower, scanned) -> pa.RecordBatch:
    marks = np.zeros(len(own), np.int32)
    marks[:1] = scanned  # the sum over the rows counts
    return pa.RecordBatch.from_arrays(
        [batch.column("vec_id"), batch.column("x"), pa.array(own.astype(np.int32)), pa.array(upper), pa.array(lower), pa.array(marks)],
        ["vec_id", "x", "own", "upper", "lower", "scanned"])


def assign(rows: DataFrame, c: np.ndarray) -> DataFrame:
    """State after a scan of every vector."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return _state(batch, *scan(_matrix(batch), c), batch.num_rows)
    return map_batches(rows, run, f"vec_id {field_type(rows, 'vec_id')}, x array<int>, {STATE}")


def follow(state: DataFrame, c: np.ndarray, drift: np.ndarray, loose: np.ndarray) -> DataFrame:
    """State after the centroids moved to ``c``."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own, upper, lower = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("own", "upper", "lower"))
        return _state(batch, *reassign(_matrix(batch), c, own, upper, lower, drift, loose))
    return map_batches(state, run, f"vec_id {field_type(state, 'vec_id')}, x array<int>, {STATE}")


def moved(state: DataFrame, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Componentwise floor of the means (an empty cluster stays), and the radius of every cluster's sphere."""
    sums = [F.sum(F.get("x", F.lit(i)).cast("bigint")).alias(f"s{i}") for i in range(c.shape[1])]
    new, radius = c.copy(), np.zeros(len(c))
    for r in state.groupBy("own").agg(F.count(F.lit(1)).alias("n"), F.max("upper").alias("radius"), *sums).collect():
        new[r["own"]] = [r[f"s{i}"] // r["n"] for i in range(c.shape[1])]
        radius[r["own"]] = r["radius"]
    return new, radius


def fit(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = CENTROIDS, rounds: int = ROUNDS,
        dimensions: int = DIMENSIONS, scale: float = SCALE, seed: int = SEED) -> tuple[DataFrame, np.ndarray]:
    """State (``vec_id, x, own, upper, lower, scanned``) under the last centroids, and these."""
    rows = materialize(integers(vectors, id_col, vec_col, dimensions, scale))
    c = first_centroids(rows, k, seed)
    if not len(c):
        return assign(rows, c), c
    state = materialize(assign(rows, c))
    for _ in range(rounds):
        new, radius = moved(state, c)
        drift = np.sqrt(((new - c).astype(np.float64) ** 2).sum(axis=1)) * (1 + _SLACK)
        state, c = materialize(follow(state, new, drift, loosening(c, new, radius))), new
    return state, c


def clusters(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = CENTROIDS, rounds: int = ROUNDS,
             dimensions: int = DIMENSIONS, scale: float = SCALE, seed: int = SEED) -> DataFrame:
    """One row per vector that is used: ``vec_id, cluster, distance`` (squared), ``cluster_inertia, inertia,
    centroid_sha256``.

    Vectors that are null, of another length, with a null, non-finite or (after scaling) component of 2^27 or more
    give no row: their distance would not fit 64 bits. Rows repeated with one id are vectors of their own; the
    first centroids are taken by hashed id, then by components; a null id is hashed as empty text. With fewer
    vectors than ``k`` there are as many centroids as vectors. An empty table gives none."""
    state, c = fit(vectors, id_col, vec_col, k, rounds, dimensions, scale, seed)
    digests = [hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in c.tolist()]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = batch.column("own").to_numpy(zero_copy_only=False)
        return pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("own"), pa.array(own_squared(_matrix(batch), c, own))],
                                          ["vec_id", "cluster", "distance"])
    spark = vectors.sparkSession
    found = map_batches(state.select("vec_id", "x", "own"), run, f"vec_id {field_type(state, 'vec_id')}, cluster int, distance bigint")
    if not len(c):
        return found.select("*", *(F.lit(None).cast(t).alias(n) for n, t in (
            ("cluster_inertia", "bigint"), ("inertia", "bigint"), ("centroid_sha256", "string"))))
    found = materialize(found)
    sums = {r["cluster"]: r["s"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    told = [(i, sums.get(i, 0), sum(sums.values()), digests[i]) for i in range(len(c))]
    table = spark.createDataFrame(told, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return found.join(F.broadcast(table), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def scanned(state: DataFrame) -> int:
    """How many vectors of a state were compared with all centroids in its round."""
    return state.agg(F.coalesce(F.sum("scanned"), F.lit(0)).alias("n")).first()["n"]


def sql(k: int = CENTROIDS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, seed: int = SEED) -> str:
    """The result over a table ``embeddings`` in SQL, every vector against every centroid in each round."""
    parts = [f"""v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) = {dimensions} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
             f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, e) - 1 AS c, e FROM
  (SELECT e, sha256('{seed}:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h FROM v) ORDER BY h, e LIMIT {k})"""]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (SELECT r, c, d FROM (SELECT v.r, k.c, list_sum(list_transform(list_zip(v.e, k.e), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d FROM v CROSS JOIN c{i} k)
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)""")
        if i < rounds:
            parts.append(f"""c{i + 1} AS MATERIALIZED (SELECT k.c, coalesce(m.e, k.e) AS e FROM c{i} k LEFT JOIN (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS e
  FROM (SELECT c, i, sum(x) AS s, count(*) AS n FROM (SELECT a.c, unnest(v.e) AS x, unnest(range({dimensions})) AS i FROM v JOIN a{i} a USING (r)) GROUP BY c, i) GROUP BY c) m USING (c))""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT v.vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance, CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(a.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(k.e, ',')) AS centroid_sha256
FROM a{rounds} a JOIN v USING (r) JOIN c{rounds} k USING (c)"""
