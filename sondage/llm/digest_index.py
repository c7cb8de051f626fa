"""Exact deduplication against a persistent digest index.

The index is a table bucketed and sorted by the SHA-256 digest of the text. New rows are
grouped by digest first (map-side, so a group that holds a third of all rows is only a
counter per task), one sort-merge join with the index, which needs neither shuffle nor sort for it,
tells the groups that it knows from those that it does not (the anti-join), and these are appended.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.distribute import materialize, shared_folder
from .common import id_and_text

FIELDS = "text_sha256 string, keep_id {id}, group_size bigint, batch string"


def text_digest(text: str = "text"):
    """Digest of the unchanged text; null counts as empty."""
    return F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)


class DigestIndex:
    """A digest table at ``path``, in ``buckets`` buckets sorted by digest.

    The files are the state: a later session opens the same path, with the same number of
    buckets, and goes on. The name in the session catalog only tells Spark about them. A bucket
    is the work of one task; choose so many that one holds some ten million digests at most."""

    def __init__(self, spark: SparkSession, path: str, buckets: int, id_type: str = "bigint"):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.name = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(f"CREATE TABLE {self.name} ({FIELDS.format(id=id_type)}) USING parquet "
                  f"CLUSTERED BY (text_sha256) SORTED BY (text_sha256) INTO {buckets} BUCKETS LOCATION '{path}'")

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def meet(self, groups: DataFrame, batch: str) -> DataFrame:
        """``text_sha256, keep_id, group_size, batch, fresh`` of every group: what the index knows of its digest, or what it
        will once the group is appended. One sort-merge join, in which the index is read bucket by bucket, unshuffled."""
        known = self.table().select("text_sha256", F.col("keep_id").alias("_keep"), F.col("batch").alias("_batch")).hint("merge")
        fresh = F.col("_batch").isNull()
        return groups.join(known, "text_sha256", "left").select(
            "text_sha256", F.when(fresh, F.col("keep_id")).otherwise(F.col("_keep")).alias("keep_id"), "group_size",
            F.coalesce("_batch", F.lit(batch)).alias("batch"), fresh.alias("fresh"))

    def append(self, fresh: DataFrame) -> None:
        """Write groups whose digest is not there yet (the anti-join side of ``meet``): one file per bucket and append, as the
        rows are dealt by the bucket's own hash."""
        (fresh.select("text_sha256", "keep_id", "group_size", "batch").repartition(self.buckets, "text_sha256")
         .sortWithinPartitions("text_sha256").write.mode("append").format("parquet").bucketBy(self.buckets, "text_sha256")
         .sortBy("text_sha256").option("path", self.path).saveAsTable(self.name))
        self.spark.catalog.refreshTable(self.name)


def deduplicate(docs: DataFrame, index: DigestIndex | None = None, id_col: str = "doc_id",
                text_col: str = "text", batch: str = "") -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Of equal texts of this input the largest id stays (a null id only where all are null); if
    the index already knew the text, ``keep_id`` is the row of the earlier batch and no row of
    this input stays. ``group_size`` counts the rows of this input. Null texts count as empty;
    rows repeated with the same id are all marked alike, with ``kept`` true if theirs is the id
    that stays. Without an ``index`` a new one, with a bucket per shuffle partition of the session, is
    made in the shared folder. An empty table gives none."""
    spark = docs.sparkSession
    rows = id_and_text(docs, id_col, text_col).select("doc_id", text_digest().alias("text_sha256"))
    if index is None:
        index = DigestIndex(spark, f"{shared_folder(spark)}/index", int(spark.conf.get("spark.sql.shuffle.partitions")), id_type=rows.schema["doc_id"].dataType.simpleString())
    batch = batch or uuid.uuid4().hex
    groups = rows.groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    # Written before the append: a batch that is run again finds its own digests and adds nothing.
    met = materialize(index.meet(groups, batch))
    index.append(met.filter("fresh"))
    told = met.select("text_sha256", "keep_id", "group_size", "batch")
    return (rows.join(told, "text_sha256")
            .select("doc_id", "keep_id", "group_size",
                    (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("batch") == F.lit(batch))).alias("kept"),
                    "text_sha256"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all their columns; rows repeated with the same id and text stay once."""
    marked = deduplicate(docs, None, id_col, text_col).filter("kept").select(
        F.col("doc_id").alias("_keep_id"), F.col("text_sha256").alias("_digest")).distinct()
    keyed = docs.withColumn("_digest", text_digest(text_col))
    stay = keyed.join(marked, (keyed["_digest"] == marked["_digest"]) & keyed[id_col].eqNullSafe(marked["_keep_id"]),
                      "left_semi")
    return stay.dropDuplicates([id_col, "_digest"]).select(*docs.columns)
