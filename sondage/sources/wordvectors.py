"""Word vector text files: one ``word v1 v2 ...`` per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.distribute import materialize


def read_word_vectors(spark: SparkSession, path: str, max_words: int | None = None) -> DataFrame:
    """``word, vec array<float>``.

    Lines with fewer than two numbers or with an unreadable number are skipped;
    of a repeated word the last line counts. With ``max_words``, reading ends
    at the first kept line whose 0-based number reaches it.

    Lines are ordered by file, offset of the block and place in the block, so the
    file is read in parallel.
    """
    lines = spark.read.text(path).select(
        F.split(F.trim(F.regexp_replace("value", r"\s+", " ")), " ").alias("parts"),
        F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
        .alias("place"),
        F.monotonically_increasing_id().alias("line"))
    numbers = F.transform(F.slice("parts", F.lit(2), F.greatest(F.size("parts") - 1, F.lit(0))),
                          lambda x: x.try_cast("float"))
    parsed = lines.select("place", "line", F.get("parts", F.lit(0)).alias("word"), numbers.alias("vec"))
    usable = (F.size("vec") >= 2) & F.forall("vec", lambda x: x.isNotNull())
    if max_words is None:
        kept = parsed.filter(usable)
    else:
        # One row per block of the file.
        blocks = lines.groupBy("place").agg(F.count(F.lit(1)).alias("n"), F.min("line").alias("first"))
        run = Window.partitionBy(F.lit(0)).orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
        # Written, so that the planner knows its size and decides about the broadcast.
        blocks = materialize(blocks.withColumn("before", F.coalesce(F.sum("n").over(run), F.lit(0))))
        numbered = parsed.filter(usable).join(blocks, "place").withColumn(
            "number", F.col("line") - F.col("first") + F.col("before"))
        last = numbered.filter(F.col("number") >= max_words).agg(F.min("number").alias("m"))
        stop = F.coalesce(last.scalar(), F.lit(max_words))
        kept = numbered.filter(F.col("number") <= stop)
    return kept.groupBy("word").agg(F.max_by("vec", F.struct("place", "line")).alias("vec"))


def write_word_vectors(df: DataFrame, path: str, word: str = "word", vec: str = "vec") -> None:
    df.select(F.concat_ws(" ", F.col(word), F.array_join(F.col(vec).cast("array<string>"), " "))
              .alias("value")).write.mode("overwrite").text(path)
