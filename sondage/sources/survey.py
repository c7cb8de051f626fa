"""Survey tables: CSV scan and declared schema."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.fixed import NA_STRINGS
from ..operators.distribute import BROADCAST_BYTES, materialize, table_bytes
from ..operators.records import quoted


def string_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def missing_as_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Cells that spell a missing value become null."""
    columns = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.when(~F.col(quoted(c)).isin(*NA_STRINGS), F.col(quoted(c)))
                           for c in columns})


_CSV = {"quote": '"', "escape": '"', "mode": "FAILFAST"}


def read_survey(spark: SparkSession, path: str, schema: T.StructType | None = None,
                multiline: bool = False) -> DataFrame:
    """CSV with header and quoted cells, every column text, missing cells null.

    Files are split over tasks, with ``multiline`` also those whose quoted cells hold line breaks
    (see ``records_of``)."""
    if multiline:
        return missing_as_null(_read_records(spark, path, schema))
    reader = spark.read.option("header", True).options(**_CSV)
    raw = reader.schema(schema).csv(path) if schema is not None else reader.csv(path)
    return missing_as_null(raw)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, block, at, value``: the lines, the split of the file they begin in, and their order within it."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), "value")


WHOLE, REST, BEGUN = 0, 1, 2  # a record, the rest of one that an earlier block began, one that goes on in the next block


def _cut_into_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of the blocks of a partition, whose lines come in order; ``inside`` tells whether a block begins in a cell."""
    out: list[tuple] = []
    place, buffer, open_cell, own, seq = None, [], False, True, 0

    def cut(ended: bool) -> None:
        nonlocal buffer, own, seq
        out.append((*place, seq, (WHOLE if own else REST) if ended else (BEGUN if own else REST), ended, "\n".join(buffer)))
        buffer, own, seq = [], True, seq + 1

    def batch() -> pa.RecordBatch:
        columns = list(zip(*out))
        kinds = (pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.string())
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["file", "block", "seq", "part", "ended", "record"])
    for rows in batches:
        for file, block, line, inside in zip(*(rows.column(n).to_pylist() for n in ("file", "block", "value", "inside"))):
            if (file, block) != place:
                if buffer:
                    cut(ended=False)
                place, open_cell, own, seq = (file, block), inside, not inside, 0
            buffer.append(line)
            if line.count('"') % 2:
                open_cell = not open_cell
            if not open_cell:
                cut(ended=True)
        if out:
            yield batch()
    if buffer:
        cut(ended=False)
    if out:
        yield batch()


def records_of(spark: SparkSession, path: str) -> DataFrame:
    """``record, first``: the text of every CSV record, line breaks in quoted cells included, and whether it opens its file.

    A line break ends a record if the quotes before it are even in number. The quotes of each split of a file are counted in
    one pass, their running parity tells whether a split begins inside a cell, and the splits are then cut into records
    independently; only the pieces of records that cross a border between splits are brought together. Quotes must come in pairs,
    as in cells that are quoted whole."""
    lines = _lines(spark, path)
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    blocks = materialize(lines.groupBy("file", "block").agg((F.sum(quotes) % 2).alias("odd")))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row per split
    begins = materialize(blocks.select("file", "block", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias("inside")))
    if table_bytes(begins) <= BROADCAST_BYTES:
        marked = lines.join(F.broadcast(begins), ["file", "block"])  # the lines stay where they were read
    else:
        marked = lines.join(begins, ["file", "block"]).sortWithinPartitions("file", "block", "at")
    cut = materialize(marked.select("file", "block", "value", "inside").mapInArrow(
        _cut_into_records, "file string, block bigint, seq int, part int, ended boolean, record string"))
    opens = (F.col("block") == 0) & (F.col("seq") == 0)
    whole = cut.filter(F.col("part") == WHOLE).select("record", opens.alias("first"))
    # At most two pieces per split: each begun record and what follows until it ends.
    order = Window.partitionBy("file").orderBy("block", "seq")
    pieces = cut.filter(F.col("part") != WHOLE).withColumn("group", F.sum((F.col("part") == BEGUN).cast("int")).over(order))
    joined = pieces.groupBy("file", "group").agg(
        F.array_sort(F.collect_list(F.struct("block", "seq", "record"))).alias("p"), F.max(opens & (F.col("part") == BEGUN)).alias("first"))
    crossing = joined.select(F.array_join(F.transform("p", lambda x: x["record"]), "\n").alias("record"), "first")
    every = whole.union(crossing)
    return every.withColumn("record", F.regexp_replace("record", "\r$", "")).filter((F.col("record") != "") | F.col("first"))


def _header(record: str) -> list[str]:
    """Column names of a header record; missing ones by position, repeated ones with it."""
    names = next(csv.reader(io.StringIO(record.removeprefix("\ufeff"), newline="")), [])
    names = [n or f"_c{i}" for i, n in enumerate(names)]
    return [f"{n}{i}" if names.count(n) > 1 else n for i, n in enumerate(names)]


def _read_records(spark: SparkSession, path: str, schema: T.StructType | None) -> DataFrame:
    records = records_of(spark, path)
    if schema is None:
        head = records.filter("first").orderBy("record").limit(1).collect()
        schema = string_schema(_header(head[0]["record"]) if head else [])
    if not schema.fields:
        return spark.createDataFrame([], schema)
    ddl = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    parsed = records.filter(~F.col("first")).select(F.from_csv("record", ddl, {**_CSV, "multiLine": "true"}).alias("r"))
    return parsed.select(*[F.col("r")[f.name].alias(f.name) for f in schema.fields])


def write_survey(df: DataFrame, path: str) -> None:
    (df.write.mode("overwrite").option("header", True).option("quoteAll", True)
     .option("escape", '"').option("lineSep", "\n").csv(path))


def with_row_id(df: DataFrame, name: str = "row_id") -> DataFrame:
    """A unique id per row. The ids follow file order within one file only, so
    tables should bring their own key where the order matters."""
    return df.withColumn(name, F.monotonically_increasing_id())
