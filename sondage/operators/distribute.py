"""Building blocks that keep large inputs distributed.

* ``materialize``    cut lineage through a table in the shared checkpoint folder
* ``dense_index``    position in a global sort order, without a one-task sort
* ``first_ranked``   the first rows of an order with their rank
* ``lookup_join``    join with a fitted table: broadcast only under a checked
                     size, otherwise a shuffle join with salted hot keys
* ``order_cutoffs``  exact order statistics of a key, by quantile sketches
* ``hash_cutoffs``   exact order statistics of a hash, by histogram
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 * 1024 * 1024
ROWS_PER_SALT = 2_000_000
TOP_AT_ONCE = 5_000
MERGED_AT_ONCE = 200_000
SAMPLED_OF_HOT = 200
BUCKET_DIGITS = 4
_ROW_BITS = 33
NULL_KEY = "\x00null"


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder the session names; in local runs without one, a new one."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            shared = tempfile.mkdtemp(prefix="sondage-checkpoint-")
        context.setCheckpointDir(shared)
    return context.getCheckpointDir()


_WRITTEN: dict[str, list[str]] = {}


def shared_folder(spark: SparkSession) -> str:
    """Name of a new folder below the checkpoint folder, which all executors share."""
    path = f"{checkpoint_folder(spark)}/table-{uuid.uuid4().hex}"
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release(spark: SparkSession) -> int:
    """Delete the tables this session has written by ``materialize`` and ``shared_folder``, and forget what is
    persisted. To be called when no result that reads them is used any more; gives the number of folders."""
    spark.catalog.clearCache()
    paths = _WRITTEN.pop(spark.sparkContext.applicationId, [])
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    for path in paths:
        place = hadoop(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    return len(paths)


def pin(df: DataFrame) -> DataFrame:
    """Compute a table of bounded size once (``materialize`` for any other)."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into a table in the shared folder and read that afterwards.

    Cuts the lineage, survives lost executors, and later reads take only the
    columns they need."""
    spark = df.sparkSession
    path = shared_folder(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table_bytes(df: DataFrame) -> int:
    """Estimated size of a fitted table: its text and array payload plus 16 bytes a cell."""
    size = F.lit(16 * max(len(df.columns), 1)).cast("long")
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType):
            size = size + F.coalesce(F.octet_length(field.name), F.lit(0))
        elif isinstance(field.dataType, T.ArrayType):
            size = size + F.coalesce(F.size(field.name), F.lit(0)) * 8
    return df.agg(F.coalesce(F.sum(size), F.lit(0)).alias("b")).first()["b"]


def dense_index(df: DataFrame, order: Sequence[str], within: str | None = None,
                name: str = "idx") -> DataFrame:
    """Add the 0-based position of each row in the order of ``order``.

    With ``within`` the position restarts for each of its values. The rows are
    range-sorted in parallel; a per-partition count gives the offsets, so only
    one row per partition (and group) meets in one place. The sorted rows are
    materialized first because range bounds come from a sample.
    """
    keys = ([within] if within else []) + list(order)
    ordered = materialize(
        df.orderBy(*keys).withColumn("_pos", F.monotonically_increasing_id()))
    ordered = ordered.withColumn("_part", F.shiftrightunsigned("_pos", _ROW_BITS))
    group = [within] if within else []
    blocks = ordered.groupBy("_part", *group).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first"))
    run = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    before = (F.sum("_n").over(run.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)))
    # Written, so that the planner knows its size and decides about the broadcast.
    offsets = materialize(blocks.select(
        "_part", *group, (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift")))
    if within:
        offsets = offsets.withColumnRenamed(within, "_group")
        on = (F.col("_part") == F.col("_part_r")) & F.col(within).eqNullSafe(F.col("_group"))
    else:
        on = F.col("_part") == F.col("_part_r")
    offsets = offsets.withColumnRenamed("_part", "_part_r")
    return (ordered.join(offsets, on)
            .withColumn(name, (F.col("_pos") + F.col("_shift")).cast("long"))
            .drop("_pos", "_part", "_part_r", "_shift", "_group"))


def first_ranked(df: DataFrame, order: Sequence[Column], k: int, name: str = "idx",
                 at_once: int = TOP_AT_ONCE) -> DataFrame:
    """The first ``k`` rows in ascending ``order`` with their 0-based rank.

    Of a large table only the rows up to the k-th move, as found by rank selection on one key
    after the other; up to ``at_once`` of them are ranked together, more by the parallel sort of
    ``dense_index``."""
    keys = [f"_o{i}" for i in range(len(order))]
    keyed = materialize(df.withColumns(dict(zip(keys, order))))
    if keyed.count() > max(k, MERGED_AT_ONCE):
        keyed = up_to_rank(keyed, keys, k)
    if k > at_once:
        return dense_index(keyed, keys, name=name).filter(F.col(name) < k).drop(*keys)
    rank = Window.partitionBy(F.lit(0)).orderBy(*keys)  # k rows
    best = keyed.orderBy(*keys).limit(k)
    return pin(best.withColumn(name, F.row_number().over(rank).cast("long") - 1).drop(*keys))


def up_to_rank(df: DataFrame, keys: Sequence[str], k: int) -> DataFrame:
    """The rows of a written table up to the k-th in the order of ``keys``, and those equal to it in all keys
    that can be selected on (not structs, and not from the first key with nulls on)."""
    taken, inside, need = F.lit(False), F.lit(True), k
    for key in keys:
        part = df.filter(inside)
        if not selectable(df, key) or part.filter(F.col(key).isNull()).limit(1).count():
            break
        at = order_cutoffs(part, key, [need])
        if need not in at:
            break  # there are no more rows than wanted
        cut = F.lit(at[need]).cast(df.schema[key].dataType)
        counts = part.agg(F.count(F.when(F.col(key) < cut, True)).alias("below"), F.count(F.when(F.col(key) <= cut, True)).alias("upto")).first()
        taken = taken | (inside & (F.col(key) < cut))
        inside, need = inside & (F.col(key) == cut), need - counts["below"]
        if counts["upto"] - counts["below"] <= need:
            break
    return df.filter(taken | inside)


def lookup_join(facts: DataFrame, table: DataFrame, on: Sequence[str], spread: str,
                how: str = "inner",
                limit_bytes: int = BROADCAST_BYTES, rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """Join large ``facts`` with a fitted ``table`` that has unique ``on`` keys.

    A table within ``limit_bytes`` is broadcast. A larger one is shuffled; keys
    with more than ``rows_per_salt`` fact rows are spread over several tasks by
    a salt taken from column ``spread``. Which keys these are is told by the facts
    at hand (``hot_keys``): those that the table was fitted on may be others, and far fewer.
    """
    on = list(on)
    if table_bytes(table) <= limit_bytes:
        return facts.join(F.broadcast(table), on, how)
    hot = hot_keys(facts, on, rows_per_salt)
    if table_bytes(hot) <= BROADCAST_BYTES:
        hot = F.broadcast(hot)
    salt = F.pmod(F.xxhash64(spread), F.col("_salts")).cast("int")
    salted_facts = facts.join(hot, on, "left").withColumn("_salt", F.coalesce(salt, F.lit(0)))
    copies = F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)
    salted_table = table.join(hot, on, "left").withColumn("_salt", F.explode(copies))
    return salted_facts.drop("_salts").join(salted_table.drop("_salts"), [*on, "_salt"], how).drop("_salt")


def hot_keys(facts: DataFrame, on: Sequence[str], rows_per_salt: int) -> DataFrame:
    """``*on, _salts`` of every key with more than ``rows_per_salt`` rows, and how many tasks it is spread over.

    Rows are drawn at a rate at which such a key has ``SAMPLED_OF_HOT`` of them, whatever the total, and counted before
    they move. A key with half of the wanted number is taken as hot: that a key of ``rows_per_salt`` rows
    falls short of it has a probability below 1e-14, and a salted key that did not need it costs a few copies."""
    every = max(1, rows_per_salt // SAMPLED_OF_HOT)
    drawn = facts.select(*on) if every == 1 else facts.select(*on).sample(False, 1.0 / every, seed=7)
    counts = drawn.groupBy(*on).agg((F.count(F.lit(1)) * every).alias("_rows"))
    least = rows_per_salt if every == 1 else rows_per_salt / 2
    return materialize(counts.filter(F.col("_rows") > least).select(
        *on, F.ceil(F.col("_rows") / F.lit(float(rows_per_salt))).cast("int").alias("_salts")))


def hash_order(key: str, seed: int | str) -> Column:
    """Hex digest that orders rows like a seeded shuffle of their keys; null is a key of its own."""
    text = F.col(key).cast("string")
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(text, F.lit(NULL_KEY))))


_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_PREFIX = 7  # bytes of a string that a bigint holds in order


def selectable(df: DataFrame, key: str) -> bool:
    """Whether ``order_cutoffs`` can select on the type of a column."""
    return isinstance(df.schema[key].dataType, (*_WHOLE, T.FloatType, T.DoubleType, T.DecimalType, T.DateType, T.TimestampType, T.StringType))


def _projected(kind: T.DataType, depth: int) -> tuple[Column, str]:
    """A number that never falls as the key ``k`` rises, and the sketch that takes it."""
    if isinstance(kind, _WHOLE):
        return F.col("k").cast("bigint"), "bigint"
    if isinstance(kind, T.DateType):
        return F.unix_date("k").cast("bigint"), "bigint"
    if isinstance(kind, T.TimestampType):
        return F.unix_micros("k"), "bigint"
    if isinstance(kind, T.StringType):
        part = F.substring(F.col("k").cast("binary"), 1 + depth * _PREFIX, _PREFIX)
        return F.conv(F.rpad(F.hex(part), 2 * _PREFIX, "0"), 16, 10).cast("bigint"), "bigint"
    return F.col("k").cast("double"), "double"


def _brackets(part: DataFrame, p: Column, sketch: str, shares: Sequence[float], width: int) -> list[tuple]:
    """For each share of the rows two marks around it, with the rows below the first and up to the second; the marks are
    one if that cuts more.

    One mergeable sketch and one count; the sketches of many tasks are merged in two steps."""
    tools = {n: getattr(F, f"kll_{n}_{sketch}") for n in ("sketch_agg", "merge_agg", "sketch_get_quantile")}
    size = F.lit(min(max(8 * width, 200), 65535))
    first = part.groupBy(F.pmod(F.spark_partition_id(), F.lit(64)).alias("g")).agg(tools["sketch_agg"](p, size).alias("s"))
    asked = [x for share in shares for x in (max(0.0, share - 1.0 / width), share, min(1.0, share + 1.0 / width))]
    merged = first.agg(tools["merge_agg"]("s", size).alias("s"))
    marks = list(merged.select(*[tools["sketch_get_quantile"](F.col("s"), F.lit(x)).alias(f"q{i}") for i, x in enumerate(asked)]).first())
    counts = part.agg(*[F.count(F.when(p < F.lit(m), True)).alias(f"b{i}") for i, m in enumerate(marks)],
                      *[F.count(F.when(p <= F.lit(m), True)).alias(f"u{i}") for i, m in enumerate(marks)], F.count(F.lit(1)).alias("all")).first()
    every, out = counts["all"], []
    for i in range(0, len(marks), 3):
        wide = (marks[i], marks[i + 2], counts[f"b{i}"], counts[f"u{i + 2}"])
        narrow = (marks[i + 1], marks[i + 1], counts[f"b{i + 1}"], counts[f"u{i + 1}"])
        out.append(wide if wide[3] - wide[2] <= every // 2 else narrow)
    return out


def order_cutoffs(df: DataFrame, key: str, ranks: Sequence[int], at_once: int = 100_000, width: int = 512) -> dict:
    """Keys at given 1-based ranks of the order of ``key``, exactly; ranks past the end are left out.

    A quantile sketch brackets each rank within about ``2 / width`` of the rows, one pass counts the rows below and up to the
    bracket, and once at most ``at_once`` rows are left in it these are ordered; in between, the bracket is sketched again.
    The passes before that sort move a sketch and a few counters per task, and no keys."""
    kind = df.schema[key].dataType
    keys = df.select(F.col(key).alias("k")).filter("k IS NOT NULL")
    n, found = keys.count(), {}
    if isinstance(kind, (T.FloatType, T.DoubleType)):  # not a number comes last and is in no sketch
        keys = keys.filter(~F.isnan("k"))
        numbers = keys.count()
        found = {r: float("nan") for r in ranks if numbers < r <= n}
        n = numbers
    asked = sorted({r for r in ranks if 1 <= r <= n})
    if not asked:
        return found
    p, sketch = _projected(kind, 0)
    first = _brackets(keys, p, sketch, [r / n for r in asked], width) if n > at_once else [None] * len(asked)
    for rank, bracket in zip(asked, first):
        part, size, want, depth = keys, n, rank, 0
        while True:
            if size <= at_once:
                found[rank] = part.orderBy("k").limit(want).agg(F.max("k").alias("k")).first()["k"]
                break
            p, sketch = _projected(kind, depth)
            lo, hi, below, upto = bracket or _brackets(part, p, sketch, [want / size], width)[0]
            bracket = None
            if want <= below:
                part, size = part.filter(p < F.lit(lo)), below
            elif want > upto:
                part, size, want = part.filter(~(p <= F.lit(hi))), size - upto, want - upto
            else:
                part, size, want = part.filter((p >= F.lit(lo)) & (p <= F.lit(hi))), upto - below, want - below
                if lo == hi:
                    ends = part.agg(F.min("k").alias("a"), F.max("k").alias("b"), F.max(F.octet_length(F.col("k").cast("string"))).alias("bytes")).first()
                    if ends["a"] == ends["b"]:
                        found[rank] = ends["a"]
                        break
                    if not isinstance(kind, T.StringType) or (depth + 1) * _PREFIX >= ends["bytes"]:
                        # One double for several decimals, or strings that differ by closing zero bytes.
                        found[rank] = part.orderBy("k").limit(want).agg(F.max("k").alias("k")).first()["k"]
                        break
                    depth += 1
    return found


def hash_cutoffs(df: DataFrame, hashed: str, wanted: dict, by: str | None = None) -> dict:
    """Digest found at given 1-based ranks, exactly.

    ``wanted`` maps a group value (``None`` without ``by``) to a list of ranks;
    the result maps ``(group, rank)`` to the digest at this rank. Digests are
    uniform, so their 65,536 prefix buckets are balanced: a count per bucket finds the
    bucket that holds a rank, and only this bucket is ranked row by row.
    """
    spark = df.sparkSession
    group = F.col(by).cast("string") if by else F.lit("")
    rows = df.select(group.alias("g"), F.col(hashed).alias("h"),
                     F.substring(hashed, 1, BUCKET_DIGITS).alias("bucket"))
    asked = [("" if by is None else str(g), int(r)) for g, ranks in wanted.items()
             for r in sorted(set(ranks)) if r >= 1]
    if not asked:
        return {}
    asked_df = spark.createDataFrame(asked, "g string, r long")
    running = Window.partitionBy("g").orderBy("bucket")
    hist = (rows.groupBy("g", "bucket").agg(F.count(F.lit(1)).alias("n"))
            .withColumn("upto", F.sum("n").over(
                running.rowsBetween(Window.unboundedPreceding, 0))))
    place = (hist.join(asked_df, "g")
             .filter((F.col("r") <= F.col("upto")) & (F.col("r") > F.col("upto") - F.col("n")))
             .select("g", "bucket", "r", (F.col("r") - F.col("upto") + F.col("n")).alias("k"))
             .collect())  # one row per asked rank
    place_df = spark.createDataFrame(
        [tuple(p) for p in place], "g string, bucket string, r long, k long")
    inside = Window.partitionBy("g", "bucket", "r").orderBy("h")
    found = (rows.join(place_df, ["g", "bucket"])
             .withColumn("rn", F.row_number().over(inside))
             .filter(F.col("rn") == F.col("k")).select("g", "r", "h").collect())
    names = {("" if by is None else str(g)): g for g in wanted}
    return {(names[f["g"]], f["r"]): f["h"] for f in found}
