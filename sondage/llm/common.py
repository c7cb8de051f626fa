"""Pieces the corpus operators share: input columns, seeded splits, Arrow batches, row sets."""

from __future__ import annotations

import hashlib
import pickle
import sys
import types
import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read(spark, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator needs, under fixed names, so that further columns cannot clash."""
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def held_out(key: str | Column, folds: int, fold: int) -> Column:
    """True where crc32 of the key as text leaves ``fold`` modulo ``folds``; a null key is not held out."""
    key = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.crc32(key.cast("string")) % F.lit(folds) == F.lit(fold), F.lit(False))


def batch_texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """UTF-8 bytes of a text column, null as empty."""
    return [t or b"" for t in batch.column(name).cast(pa.binary()).to_pylist()]


def ascii_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lowered (both work on ASCII bytes only)."""
    return text.lower().split()


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: T.StructType | str) -> DataFrame:
    """Apply ``fn`` to every Arrow batch of every partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                if out is not None:
                    yield out
    return df.mapInArrow(run, schema)


def worker_cache() -> dict:
    """A dictionary that lives as long as the Python worker; the package itself is sent anew with every task."""
    return sys.modules.setdefault("_sondage_worker_cache", types.ModuleType("_sondage_worker_cache")).__dict__


def share(spark: SparkSession, value) -> Callable:
    """Broadcast a model of bounded size; the result, called in a task, gives it back.

    Workers need no copy of this package and unpack one model at a time, once."""
    data = cloudpickle.dumps(value)
    held, key = spark.sparkContext.broadcast(data), f"shared-{uuid.uuid4().hex}"

    def get():
        cache = worker_cache()
        if key not in cache:
            for old in [k for k in cache if k.startswith("shared-")]:
                del cache[old]
            cache[key] = pickle.loads(held.value)
        return cache[key]
    return get


def field_type(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def first_by_hash(df: DataFrame, key: str, n: int, seed: str) -> DataFrame:
    """At most ``n`` rows of a written table, those whose seeded hash of the key is smallest: a sample that does
    not depend on layout. The number of rows tells which hashes can be among them, so that few rows are ordered."""
    mark = F.xxhash64(F.lit(seed), F.coalesce(F.col(key).cast("string"), F.lit("")))
    share = int(min(1.0, (1.2 * n + 100) / max(df.count(), 1)) * (1 << 30))
    rows = df.withColumn("_mark", F.pmod(mark, F.lit(1 << 30))).filter(F.col("_mark") <= share)
    return rows.orderBy("_mark", key).limit(n).drop("_mark")


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def sample_per_class(df: DataFrame, key: str, label: str, per_class: int, seed: str) -> DataFrame:
    """At most ``per_class`` rows of each value of ``label`` (few values), by a seeded hash of ``key``.

    The counts per class give the share of hash values to look at, so that only about four
    times the wanted rows are ranked; the rows do not depend on how the input is laid out."""
    marked = df.withColumn("_mark", F.xxhash64(F.lit(seed), F.coalesce(F.col(key).cast("string"), F.lit(""))))
    counts = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    near = F.lit(False)
    for value, n in counts.items():
        share = int(min(1.0, 4 * per_class / n + 100 / n) * (1 << 20))
        near = near | (F.col(label).eqNullSafe(F.lit(value)) & (F.pmod(F.col("_mark"), F.lit(1 << 20)) <= share))
    rank = Window.partitionBy(label).orderBy("_mark", key)
    return marked.filter(near).withColumn("_rank", F.row_number().over(rank)).filter(F.col("_rank") <= per_class).drop("_mark", "_rank")


def most_frequent(counts: DataFrame, most: int, n: str = "n") -> DataFrame:
    """Rows of a written table with the largest ``n``, at most ``most``; rows with equal ``n`` stay or go together.

    Two small histograms find the least ``n``, so that no task sends or sorts more than its part of the result."""
    octave = F.floor(F.log2(n) * 16).cast("int")
    rows = counts.filter(F.col(n) > 0)
    taken, edge = 0, None
    for r in rows.groupBy(octave.alias("o")).agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("o")).collect():
        if taken + r["c"] > most:
            edge = r["o"]
            break
        taken += r["c"]
    if edge is None:
        return rows
    least = None
    for r in rows.filter(octave == edge).groupBy(n).agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc(n)).collect():
        if taken + r["c"] > most:
            least = r[n]
            break
        taken += r["c"]
    return rows.filter(F.col(n) > least)
