"""SimHash near-duplicates by meeting in the middle of two Hamming balls.

Two 64-bit fingerprints differ in at most three bits exactly if some value lies within one
flip of the one and two flips of the other. Every distinct fingerprint emits all 2,081 values
within two flips (half the radius, rounded up), but not as 2,081 rows: the values with at most
one flip in the upper half travel by that upper half (33 rows, the flips left for the lower
half are implied), those with two flips above share the lower half (one row). Fingerprints that
meet on such a key are verified by their true distance. Keys on which many fingerprints meet
are not paired: there the values are spelled out in full, and all that meet on one value are
linked to the smallest one that needs at most one flip, which is exact and linear.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.distribute import materialize, table_bytes
from .common import ascii_words, batch_texts, field_type, id_and_text, map_batches
from .graph import components

SHINGLE = 3
DISTANCE = 3
SEED = 42
# Pairing costs half of this many comparisons a row at most, spelling out up to 529 rows a row.
PAIRED_AT_ONCE = 256
_CHUNK = 50_000
GONE_BYTES = 16 * 1024 * 1024


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64 majority bits over the XXH64 values of all word shingles, repeats included; no words give zero."""
    words = ascii_words(text)
    if not words:
        return 0
    count = max(len(words) - shingle + 1, 1)
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, count, _CHUNK):
        part = words[at:at + _CHUNK + shingle - 1]
        rows = [part[i:] for i in range(shingle)] if len(words) >= shingle else None
        joined = map(b" ".join, zip(*rows)) if rows else [b" ".join(part)]
        h = np.fromiter((digest(s, seed) for s in joined), np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, mark, fp`` (bigint with the fingerprint's bits), one row per input row; ``mark`` is a hash of the text."""
    rows = id_and_text(docs, id_col, text_col).withColumn("mark", text_mark("text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array([fingerprint(t, shingle) for t in batch_texts(batch)], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("mark"), pa.array(found)], ["doc_id", "mark", "fp"])
    return map_batches(rows, run, f"doc_id {field_type(rows, 'doc_id')}, mark bigint, fp bigint")


def text_mark(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))


def _flips(bits: int, most: int) -> list[tuple[int, int]]:
    """(mask, number of flips) of all masks over ``bits`` low bits with at most ``most`` ones (up to two)."""
    one = [(1 << i, 1) for i in range(bits)] if most >= 1 else []
    two = [(1 << i | 1 << j, 2) for i in range(bits) for j in range(i)] if most >= 2 else []
    return [(0, 0), *one, *two]


def _masks(found: list[tuple[int, int]]) -> Column:
    return F.array(*(F.struct(F.lit(m).cast("bigint").alias("mask"), F.lit(n).alias("n")) for m, n in found))


LOW = 0xFFFFFFFF


def bundles(fps: DataFrame) -> DataFrame:
    """``fp, family, key, used``: a key stands for all variants that share this half of the value.

    ``used`` flips are spent on the key's half."""
    upper, lower = F.shiftrightunsigned("fp", 32), F.col("fp").bitwiseAND(F.lit(LOW).cast("bigint"))
    family = F.explode(F.array(
        F.struct(F.lit(0).alias("family"), _masks(_flips(32, 1)).alias("masks")),
        F.struct(F.lit(1).alias("family"), _masks([(0, 0)]).alias("masks"))))
    rows = fps.select("fp", family.alias("f")).select("fp", F.col("f.family").alias("family"), F.explode("f.masks").alias("m"))
    return rows.select("fp", "family", F.when(F.col("family") == 0, upper).otherwise(lower)
                       .bitwiseXOR(F.col("m.mask")).alias("key"), F.col("m.n").alias("used"))


def links(fps: DataFrame, distance: int = DISTANCE, paired: int = PAIRED_AT_ONCE) -> DataFrame:
    """Edges ``(a, b)`` between distinct fingerprints, each truly within ``distance``, that connect
    whatever all such pairs connect. Where up to ``paired`` fingerprints share a key all pairs are
    verified; beyond that each variant links what meets on it to one of its own."""
    if distance != 3:
        raise ValueError("the ball scheme is laid out for a distance of three bits")
    every = bundles(fps)
    sizes = materialize(every.groupBy("family", "key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1"))
    meeting = materialize(every.join(sizes, ["family", "key"]))
    few = meeting.filter(F.col("members") <= paired)
    left, right = few.select("family", "key", F.col("fp").alias("a")), few.select("family", "key", F.col("fp").alias("b"))
    pairs = left.join(right, ["family", "key"]).filter(
        (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)).select("a", "b")

    many = meeting.filter(F.col("members") > paired)
    upper = many.filter("family = 0").select(
        "fp", "used", "key", F.explode(F.when(F.col("used") == 0, _masks(_flips(32, 2))).otherwise(_masks(_flips(32, 1)))).alias("m"))
    low = F.col("fp").bitwiseAND(F.lit(LOW).cast("bigint")).bitwiseXOR(F.col("m.mask"))
    upper = upper.select("fp", F.shiftleft("key", 32).bitwiseOR(low).alias("z"), (F.col("used") + F.col("m.n")).alias("used"))
    lower = many.filter("family = 1").select("fp", F.explode(_masks(_flips(32, 2))).alias("m")).select(
        "fp", F.col("fp").bitwiseXOR(F.shiftleft(F.col("m.mask"), 32)).alias("z"), F.col("m.n").alias("used"))
    variants = upper.union(lower)
    centres = materialize(variants.groupBy("z").agg(
        F.min(F.when(F.col("used") <= 1, F.col("fp"))).alias("a"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1 AND a IS NOT NULL").select("z", "a"))
    stars = variants.join(centres, "z").filter("a <> fp").select("a", F.col("fp").alias("b"))
    return pairs.union(stars)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    distance: int = DISTANCE, paired: int = PAIRED_AT_ONCE) -> DataFrame:
    """One row per input row: ``doc_id, fp, component_id``, the smallest id reachable by links.

    Null and empty texts, and texts of white space only, have fingerprint zero and link like any
    other. Rows repeated with one id get a row each. A null id takes part; it is the component of
    a group only if all its ids are null. An empty table gives no rows."""
    return _grouped(docs, id_col, text_col, shingle, distance, paired).select("doc_id", "fp", "component_id")


def _grouped(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE, distance: int = DISTANCE,
             paired: int = PAIRED_AT_ONCE) -> DataFrame:
    """``doc_id, mark, fp, component, component_id``; ``component`` names the group also where ids are null."""
    rows = materialize(fingerprints(docs, id_col, text_col, shingle))
    fps = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    comp = components(links(fps.select("fp"), distance, paired))
    named = materialize(fps.join(comp.withColumnRenamed("v", "fp"), "fp", "left").select(
        "fp", "first_id", F.coalesce("component", "fp").alias("component")))
    smallest = materialize(named.groupBy("component").agg(F.min("first_id").alias("component_id")))
    told = materialize(named.join(smallest, "component").select("fp", "component", "component_id"))
    return rows.join(told, "fp").select("doc_id", "mark", "fp", "component", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", gone_bytes: int = GONE_BYTES) -> DataFrame:
    """One row of ``docs`` of each group, with all its columns: of those with the group's smallest id the one with the least
    hash of its text; a row without an id only where no row has one. Rows repeated with one id and text stay once.

    The texts stay where they are if the ids and hashes of the rows that go are within ``gone_bytes``."""
    found = materialize(_grouped(docs, id_col, text_col))
    last = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")
    stay = materialize(found.groupBy("component").agg(F.min(last).alias("m")).select(F.col("m.doc_id").alias("_keep_id"), F.col("m.mark").alias("_mark")))
    keyed = docs.withColumn("_text_mark", text_mark(text_col))
    staying = F.col("doc_id").eqNullSafe(F.col("_keep_id")) & (F.col("mark") == F.col("_mark"))
    gone = materialize(found.join(stay, staying, "left_anti").select(F.col("doc_id").alias("_keep_id"), F.col("mark").alias("_mark")).distinct())
    match = keyed[id_col].eqNullSafe(F.col("_keep_id")) & (F.col("_text_mark") == F.col("_mark"))
    kept = keyed.join(F.broadcast(gone), match, "left_anti") if table_bytes(gone) <= gone_bytes else keyed.join(stay, match, "left_semi")
    again = found.join(stay, staying, "left_semi")
    if again.groupBy("doc_id", "mark").count().filter("count > 1").limit(1).count():
        kept = kept.dropDuplicates([id_col, "_text_mark"])
    return kept.select(*docs.columns)
