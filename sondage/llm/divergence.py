"""Divergence of the sources of a language by their term shares, on a K-squared quadtree.

The matrix of a language has a row per source and a column per kept term. It is cut into square
tiles, and each tile into a quadtree (two by two quadrants a level) that says which quadrants hold a
count. Two sources differ in a term by |p - q|. Where neither has it, both shares are those of a count
of zero, so that a quadrant that is zero for both row ranges costs its width times the difference of
these two shares, without a look at its columns. The trees of two tiles are walked together over all
pairs of their row ranges; only pairs with a quadrant that is not zero for both reach the leaves,
where the shares are laid out and compared.

On Spark the words of each text are counted in tasks, once by language, which tells the kept terms, and once by
source for these alone. The tiles of two row ranges meet in one task, which holds a tile at a time and leaves sums of many of
them. All sums are integers.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.distribute import BROADCAST_BYTES, dense_index, materialize, table_bytes
from .common import batch_texts, share as share_model

TILE = 256
LEAF = 32
TERMS_SHOWN = 50
LEAST_DOCUMENTS = 30
SMOOTHING = 5
SCALE = 1_000_000_000
_TOGETHER = 1_000_000  # words that are counted together in a task
_TERM = re.compile(rb"[a-z\x80-\xff]+")  # of lowered UTF-8: letters, and everything beyond ASCII


def _clean(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    return docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in (
        (lang_col, "lang"), (source_col, "source"), (text_col, "text"))))


class _Tally:
    """Words of one language, waiting to be counted together."""

    def __init__(self):
        self.words, self.sizes, self.groups = [], [], []

    def add(self, words: list[bytes], group: bytes) -> None:
        self.words += words
        self.sizes.append(len(words))
        self.groups.append(group)

    def counted(self, kept: pa.Array | None = None) -> tuple[list[bytes], np.ndarray, pa.Array, np.ndarray, np.ndarray]:
        """Distinct groups, then per (group, term): group number, term (or its place in ``kept``, all others left out),
        occurrences, documents."""
        coded = pa.array(self.words, pa.binary()).dictionary_encode()
        width = max(len(coded.dictionary), 1)
        number = {g: i for i, g in enumerate(dict.fromkeys(self.groups))}
        owner = np.array([number[g] for g in self.groups], np.int64)
        pairs, times = np.unique(np.repeat(np.arange(len(self.sizes)), self.sizes) * width + coded.indices.to_numpy(), return_counts=True)
        if kept is not None:
            place = pc.index_in(coded.dictionary, value_set=kept).fill_null(-1).to_numpy()
            known = place[pairs % width] >= 0 if len(pairs) else np.zeros(0, bool)
            pairs, times = pairs[known], times[known]
        keys, at = np.unique(owner[pairs // width] * width + pairs % width, return_inverse=True)
        n, documents = np.bincount(at, times, len(keys)).astype(np.int64), np.bincount(at, minlength=len(keys)).astype(np.int64)
        term = pa.array(place[keys % width], pa.int64()) if kept is not None else coded.dictionary.take(pa.array(keys % width)).cast(pa.string())
        return list(number), keys // width, term, n, documents


def _tallied(rows: DataFrame, by_source: bool, emit, schema: str) -> DataFrame:
    """``emit(lang, tally)`` for the words of every language, some ``_TOGETHER`` at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[bytes, _Tally] = {}
        held = 0
        for batch in batches:
            langs, texts = batch_texts(batch, "lang"), batch_texts(batch)
            for lang, group, text in zip(langs, batch_texts(batch, "source") if by_source else langs, texts):
                words = _TERM.findall(text.lower())
                if lang not in waiting:
                    waiting[lang] = _Tally()
                waiting[lang].add(words, group)
                held += len(words) + 1
                if held >= _TOGETHER:
                    for lang_, tally in waiting.items():
                        yield emit(lang_, tally)
                    waiting, held = {}, 0
        for lang, tally in waiting.items():
            yield emit(lang, tally)
    return rows.mapInArrow(run, schema)


def lang_counts(rows: DataFrame) -> DataFrame:
    """``lang, term, n, documents``, summed over the texts that a task counts together; sum again."""
    def emit(lang: bytes, tally: _Tally) -> pa.RecordBatch:
        _, group, term, n, documents = tally.counted()
        name = pa.array([lang.decode()], pa.string()).take(pa.array(group))
        return pa.RecordBatch.from_arrays([name, term, pa.array(n), pa.array(documents)], ["lang", "term", "n", "documents"])
    return _tallied(rows.select("lang", "text"), False, emit, "lang string, term string, n bigint, documents bigint")


def source_counts(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """``lang, source, t, n`` of the kept terms (``lang, term, t``).

    Kept terms of a checked size go to the tasks, which count nothing else; more of them are joined by shuffle."""
    if table_bytes(kept.select("lang", "term", "t")) > BROADCAST_BYTES:
        def every(lang: bytes, tally: _Tally) -> pa.RecordBatch:
            groups, group, term, n, _ = tally.counted()
            names = [pa.array(x, pa.binary()).cast(pa.string()).take(pa.array(group * f)) for x, f in (([lang], 0), (groups, 1))]
            return pa.RecordBatch.from_arrays([*names, term, pa.array(n)], ["lang", "source", "term", "n"])
        found = _tallied(rows, True, every, "lang string, source string, term string, n bigint")
        return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n")).join(kept.select("lang", "term", "t"), ["lang", "term"]).drop("term")
    terms: dict[bytes, list] = {}
    for r in kept.select("lang", "term").orderBy("lang", "t").collect():
        terms.setdefault(r["lang"].encode(), []).append(r["term"].encode())
    shared = share_model(rows.sparkSession, {lang: pa.array(words, pa.binary()) for lang, words in terms.items()})
    none = pa.array([], pa.binary())

    def emit(lang: bytes, tally: _Tally) -> pa.RecordBatch:
        groups, group, t, n, _ = tally.counted(shared().get(lang, none))
        names = [pa.array(x, pa.binary()).cast(pa.string()).take(pa.array(group * f)) for x, f in (([lang], 0), (groups, 1))]
        return pa.RecordBatch.from_arrays([*names, t, pa.array(n)], ["lang", "source", "t", "n"])
    return _tallied(rows, True, emit, "lang string, source string, t bigint, n bigint").groupBy("lang", "source", "t").agg(F.sum("n").alias("n"))


def share(n: str, total: str, terms: str) -> Column:
    """1 + floor(SCALE * (n + 5) / (total + 5 * terms)), exactly; null without terms."""
    return F.expr(f"CASE WHEN {terms} > 0 THEN 1 + (CAST({SCALE} AS DECIMAL(10, 0)) * CAST({n} + {SMOOTHING} AS DECIMAL(20, 0))) "
                  f"div CAST({total} + {SMOOTHING} * {terms} AS DECIMAL(20, 0)) END")


class Quadtree:
    """Which quadrants of a ``side`` x ``side`` tile hold a cell, from the whole tile down to ``leaf`` x ``leaf``."""

    def __init__(self, rows: np.ndarray, cols: np.ndarray, side: int = TILE, leaf: int = LEAF):
        self.levels = []
        size = side
        while size >= leaf:
            quadrant = np.zeros((side // size, side // size), bool)
            quadrant[rows // size, cols // size] = True
            self.levels.append(quadrant)
            size //= 2


def walk(a: Quadtree, b: Quadtree, same: bool, width: int, side: int = TILE, leaf: int = LEAF) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Columns of which the trees alone say that both rows are zero, for all pairs of leaf rows, and the leaves to compare.

    Only the first ``width`` columns exist. With ``same`` both tiles are one, and only pairs (i, j) with i <= j count."""
    per = side // leaf
    zero = np.zeros((per, per), np.int64)
    todo = np.zeros((1, 3), np.int64)  # row range of a, row range of b, column range
    for level, (left, right) in enumerate(zip(a.levels, b.levels)):
        size = side >> level
        i, j, k = todo.T
        todo = todo[np.maximum(width - k * size, 0) > 0]
        i, j, k = todo.T
        live = left[i, k] | right[j, k]
        cost = np.minimum(width - k * size, size)
        wide = size // leaf
        for x, y, c in zip(i[~live], j[~live], cost[~live]):
            zero[x * wide:(x + 1) * wide, y * wide:(y + 1) * wide] += c
        todo = todo[live]
        if size > leaf:
            step = np.array([(x, y, z) for x in (0, 1) for y in (0, 1) for z in (0, 1)])
            todo = (2 * todo[:, None, :] + step[None]).reshape(-1, 3)
            if same:
                todo = todo[todo[:, 0] <= todo[:, 1]]
    return zero, [tuple(t) for t in todo.tolist()]


def tile_sums(a: tuple, b: tuple, za: np.ndarray, zb: np.ndarray, same: bool, width: int, side: int = TILE, leaf: int = LEAF) -> np.ndarray:
    """Sum of |p - q| over the ``width`` columns of a tile for all pairs of the rows of ``a`` and ``b``.

    ``a`` and ``b`` are (rows, columns, shares) of the cells; ``za`` and ``zb`` the shares of a count of zero."""
    ra, ca, pa_ = a
    rb, cb, pb = b
    zero, leaves = walk(Quadtree(ra, ca, side, leaf), Quadtree(rb, cb, side, leaf), same, width, side, leaf)
    fill_a, fill_b = np.zeros(side, np.int64), np.zeros(side, np.int64)
    fill_a[:len(za)], fill_b[:len(zb)] = za, zb
    out = np.kron(zero, np.ones((leaf, leaf), np.int64)) * np.abs(fill_a[:, None] - fill_b[None, :])

    def block(cells: tuple, fill: np.ndarray, held: dict, row: int, col: int) -> np.ndarray:
        if (row, col) not in held:
            rows, cols, shares = cells
            dense = np.repeat(fill[row * leaf:(row + 1) * leaf, None], leaf, axis=1)
            mine = (rows // leaf == row) & (cols // leaf == col)
            dense[rows[mine] % leaf, cols[mine] % leaf] = shares[mine]
            held[row, col] = dense[:, :max(min(width - col * leaf, leaf), 0)]
        return held[row, col]
    held_a: dict = {}
    held_b: dict = held_a if same else {}
    for i, j, k in leaves:
        x, y = block(a, fill_a, held_a, i, k), block(b, fill_b, held_b, j, k)
        out[i * leaf:(i + 1) * leaf, j * leaf:(j + 1) * leaf] += np.abs(x[:, None, :] - y[None, :, :]).sum(axis=2)
    return out[:len(za), :len(zb)]


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Runs of rows with equal ``code``, whole, from rows that are sorted by it."""
    held, parts = None, []
    for batch in batches:
        code = batch.column("code").to_numpy()
        edges = [0, *(np.flatnonzero(code[1:] != code[:-1]) + 1).tolist(), batch.num_rows] if len(code) else []
        for at, end in zip(edges, edges[1:]):
            if held is not None and code[at] != held:
                yield pa.Table.from_batches(parts)
                parts = []
            held = code[at]
            parts.append(batch.slice(at, end - at))
    if parts:
        yield pa.Table.from_batches(parts)


_KEY = ["lang", "a", "b", "col_tile"]


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.Table]]:
    """Key and rows of every tile."""
    for run in _runs(batches):
        keys = run.select(_KEY).group_by(_KEY).aggregate([]).to_pylist()
        for key in keys:
            mine = run
            if len(keys) > 1:  # tiles with a hash in common
                mine = run.filter(functools.reduce(pc.and_, (pc.equal(run[n], key[n]) for n in _KEY)))
            yield tuple(key[n] for n in _KEY), mine


def _walked(batches: Iterator[pa.RecordBatch], tile: int, leaf: int) -> Iterator[pa.RecordBatch]:
    """What the tiles of a pair of row ranges add to it, a tile at a time; sums of some pairs of ranges are held."""
    held: dict[tuple, np.ndarray] = {}

    def left() -> Iterator[pa.RecordBatch]:
        for (lang, a, b), out in held.items():
            g, h = np.nonzero(np.triu(np.ones(out.shape, bool), 1) if a == b else np.ones(out.shape, bool))
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(g), pa.string()), pa.array(a * tile + g), pa.array(b * tile + h), pa.array(out[g, h])],
                                             ["lang", "g", "h", "value"])
        held.clear()
    for (lang, a, b, at), rows in _tiles(batches):
        heads = rows.filter(pc.is_valid(rows["zeros"]))
        zeros = dict(zip(heads["side"].to_pylist(), heads["zeros"].to_pylist()))
        same, terms = a == b, heads["terms"][0].as_py()
        za = np.array(zeros[0], np.int64)
        zb = za if same else np.array(zeros[1], np.int64)
        apart = np.abs(za[:, None] - zb[None, :])
        if at < 0:
            found = terms * apart  # the whole matrix, as if it were one zero quadrant
        else:
            cells = rows.filter(pc.is_null(rows["zeros"]))
            side, row, col, p = (cells[n].to_numpy().astype(np.int64) for n in ("side", "row", "col", "p"))
            first, second = ((row[side == w], col[side == w], p[side == w]) for w in (0, 1))
            width = min(tile, terms - at * tile)
            found = tile_sums(first, first if same else second, za, zb, same, width, tile, leaf) - width * apart
        held[lang, a, b] = held[lang, a, b] + found if (lang, a, b) in held else found
        if len(held) >= 64:
            yield from left()
    yield from left()


def pair_sums(cells: DataFrame, groups: DataFrame, tile: int = TILE, leaf: int = LEAF) -> DataFrame:
    """``lang, g, h, value`` for all g < h of a language.

    ``cells``: ``lang, g, t, p`` of the counts above zero; ``groups``: ``lang, g, z, terms`` with the share ``z`` of a count of
    zero, both numbered from 0 within a language. Every pair of row ranges is first priced as one zero quadrant; a tile of it
    adds what it comes to beyond that. A cell goes to every pair of row ranges that its own takes part in."""
    zero = F.lit(0).cast("bigint")
    ranges = materialize(groups.groupBy("lang", F.floor(F.col("g") / tile).alias("r")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("g", "z"))), lambda s: F.coalesce(s["z"], zero)).alias("zeros"),  # up to ``tile``
        F.max("terms").alias("terms")))
    count = ranges.groupBy("lang").agg((F.max("r") + 1).alias("ranges"))

    def paired(df: DataFrame) -> DataFrame:
        """Copies of the rows of range ``r`` for every pair it takes part in, as ``a`` (side 0) or ``b`` (side 1)."""
        other = df.join(count, "lang").withColumn("o", F.explode(F.sequence(zero, F.col("ranges") - 1)))
        return other.withColumns({"a": F.least("r", "o"), "b": F.greatest("r", "o"), "side": (F.col("r") > F.col("o")).cast("int")})
    nil = F.lit(None).cast("bigint")
    tiles = F.sequence(F.lit(-1).cast("bigint"), F.ceil(F.col("terms") / tile) - 1)
    heads = paired(ranges.withColumn("col_tile", F.explode(tiles))).select(
        *_KEY, "side", nil.alias("row"), nil.alias("col"), nil.alias("p"), "zeros", "terms")
    body = paired(cells.withColumn("r", F.floor(F.col("g") / tile))).withColumn("col_tile", F.floor(F.col("t") / tile)).select(
        *_KEY, "side", (F.col("g") % tile).alias("row"), (F.col("t") % tile).alias("col"), "p", F.lit(None).cast("array<bigint>").alias("zeros"), nil.alias("terms"))
    # One number to sort by, which needs no comparison of rows.
    dealt = heads.union(body).repartition(*_KEY).withColumn("code", F.xxhash64(*_KEY)).sortWithinPartitions("code")
    found = dealt.mapInArrow(lambda batches: _walked(batches, tile, leaf), "lang string, g bigint, h bigint, value bigint")
    return found.groupBy("lang", "g", "h").agg(F.sum("value").cast("bigint").alias("value"))


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          least_documents: int = LEAST_DOCUMENTS, shown: int = TERMS_SHOWN) -> DataFrame:
    """``lang, source, part, item, value, rank``: how far each source of a language is from each other one (part ``pair``,
    all of them), and the terms that it uses more than its language does (part ``term``, up to rank ``shown``).

    Null text, lang and source count as empty; every row is a document of its own, also one that repeats an id. A group
    without terms, and a language that keeps none (all values 0), have their pairs. A language with one source has none.
    Equal values rank by item. An empty table gives no rows."""
    rows = _clean(docs, text_col, lang_col, source_col)
    words = lang_counts(rows).groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("documents").alias("documents"))
    kept = materialize(dense_index(words.filter(F.col("documents") >= least_documents), ["term"], within="lang", name="t"))
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("lang_n").alias("lang_total"))
    found = materialize(source_counts(rows, kept))
    totals = found.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = dense_index(rows.select("lang", "source").distinct(), ["source"], within="lang", name="g")
    zero = F.lit(0).cast("bigint")
    groups = (groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").select(
        "lang", "source", "g", F.coalesce("total", zero).alias("total"), F.coalesce("terms", zero).alias("terms"),
        F.coalesce("lang_total", zero).alias("lang_total")).withColumn("none", zero))
    groups = materialize(groups.withColumn("z", share("none", "total", "terms")))
    cells = found.join(groups, ["lang", "source"]).join(kept.select("lang", "t", "term", "lang_n"), ["lang", "t"])
    cells = materialize(cells.select(
        "lang", "source", "g", "term", "t", share("n", "total", "terms").alias("p"), share("lang_n", "lang_total", "terms").alias("q")))

    sums = materialize(pair_sums(cells.select("lang", "g", "t", "p"), groups.select("lang", "g", "z", "terms")))
    both = sums.union(sums.select("lang", F.col("h").alias("g"), F.col("g").alias("h"), "value"))
    name = groups.select("lang", "g", "source")
    pairs = (both.join(name, ["lang", "g"]).join(name.select("lang", F.col("g").alias("h"), F.col("source").alias("item")), ["lang", "h"])
             .select("lang", "source", F.lit("pair").alias("part"), "item", "value"))
    terms = cells.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(order))
    terms = terms.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= shown)
    return pairs.union(terms)


SQL = f"""WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS words FROM documents),
c AS MATERIALIZED (SELECT r, lang, source, term, count(*) AS n FROM (SELECT r, lang, source, unnest(words) AS term FROM d) GROUP BY ALL),
kept AS MATERIALIZED (SELECT lang, term, sum(n) AS ln FROM c GROUP BY lang, term HAVING count(*) >= {LEAST_DOCUMENTS}),
langs AS (SELECT lang, count(*) AS v, sum(ln) AS ltotal FROM kept GROUP BY lang),
g AS MATERIALIZED (SELECT DISTINCT lang, source FROM d),
counted AS MATERIALIZED (SELECT lang, source, term, sum(n) AS n FROM c JOIN kept USING (lang, term) GROUP BY ALL),
totals AS (SELECT lang, source, sum(n) AS total FROM counted GROUP BY ALL),
cells AS MATERIALIZED (SELECT g.lang, g.source, k.term, coalesce(x.n, 0) AS n,
    1 + ({SCALE}::HUGEINT * (coalesce(x.n, 0) + {SMOOTHING})) // (coalesce(t.total, 0) + {SMOOTHING} * l.v) AS p,
    1 + ({SCALE}::HUGEINT * (k.ln + {SMOOTHING})) // (l.ltotal + {SMOOTHING} * l.v) AS q
  FROM g JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source
    LEFT JOIN counted x ON x.lang = g.lang AND x.source = g.source AND x.term = k.term),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM cells a JOIN cells b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM cells WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM every)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= {TERMS_SHOWN}"""
