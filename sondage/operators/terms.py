"""Vocabularies, bag of words and TF-IDF on long tables.

A term table has one row per (row, text column, term): ``row_id, col, term, tf``.
A vocabulary has one row per term: ``[col,] term, idx, n, doc_freq``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import ngrams, let, term_counts, tokens
from .distribute import dense_index, first_ranked, lookup_join, materialize, up_to_rank
from .records import quoted


def term_table(df: DataFrame, row_id: str, text_cols: Sequence[str], *,
               stop: Sequence[str] | None = None, min_len: int = 1, bigrams: bool = False,
               analyzer: Callable[[Column], Column] | None = None,
               keep: Sequence[str] = ()) -> DataFrame:
    """Terms with their counts, computed inside each row (no shuffle)."""
    words = (lambda c: analyzer(F.col(quoted(c)))) if analyzer is not None else cell_words(stop, bigrams, min_len)
    cells = term_cells(text_cols, words)
    return unfolded(df.select(F.col(row_id).alias("row_id"), *keep, cells.alias(CELLS)), keep)


CELLS = "_cells"


def cell_words(stop: Sequence[str] | None = None, bigrams: bool = False, min_len: int = 1) -> Callable[[str], Column]:
    """The words of a text column, with their pairs if wanted."""
    def words(c: str) -> Column:
        found = tokens(F.col(quoted(c)), stop, min_len)
        return let(found, lambda w: F.concat(w, ngrams(w, 2))) if bigrams else found
    return words


def term_cells(text_cols: Sequence[str], words: Callable[[str], Column]) -> Column:
    """All term counts of a row in one array, so that a prepared table keeps one row per row."""
    return F.array(*[F.struct(F.lit(c).alias("col"), F.lit(i).alias("ordinal"), term_counts(words(c)).alias("terms"))
                     for i, c in enumerate(text_cols)])


def unfolded(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The term table of rows that hold ``row_id`` and their cells."""
    # The plain explode would compute the cells twice, first to skip rows without any.
    return (df.select("row_id", *keep, F.explode_outer(CELLS).alias("cell"))
            .select("row_id", *keep, "cell.col", "cell.ordinal", F.inline("cell.terms")))


def count_terms(terms: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Occurrences and document frequency per term."""
    return terms.groupBy(*by, "term").agg(F.sum("tf").alias("n"),
                                          F.count(F.lit(1)).alias("doc_freq"))


def top_vocabulary(counts: DataFrame, top_k: int) -> DataFrame:
    """The ``top_k`` most frequent terms, indexed by rank (ties: by term)."""
    return first_ranked(counts, [-F.col("n"), F.col("term")], top_k)


def first_seen_vocabulary(df: DataFrame, order_key: str, text_cols: Sequence[str], top_k: int,
                          stop: Sequence[str] | None = None) -> DataFrame:
    """As ``top_vocabulary``, but ties keep the order of first appearance:
    by text column, then ``order_key``, then position in the cell.

    Words are counted first. Only those whose count is that of another word near the top are looked up, and only the
    cells where one of them comes first are read word by word. A prepared ``df`` also needs its text columns."""
    rows = df.withColumnRenamed(order_key, "row_id")
    terms = unfolded(rows) if CELLS in df.columns else term_table(df, order_key, text_cols, stop=stop)
    counts = materialize(terms.groupBy("term").agg(F.sum("tf").alias("n")).withColumn("_o", -F.col("n")))
    likely = materialize(up_to_rank(counts, ["_o"], top_k).drop("_o"))
    shared = likely.groupBy("n").agg(F.count(F.lit(1)).alias("_terms")).filter("_terms > 1")
    tied = materialize(likely.join(shared, "n", "left_semi").select("term"))
    at = lookup_join(terms.select("row_id", "ordinal", "term"), tied, ["term"], "row_id").groupBy("term").agg(
        F.min(F.struct("ordinal", "row_id")).alias("at"))
    at = materialize(at.select("term", "at.ordinal", F.col("at.row_id").alias("_row")))
    read = rows.join(at.select("_row").distinct(), F.col("row_id").eqNullSafe(F.col("_row")), "left_semi")
    cells = F.array(*[F.struct(F.lit(i).alias("_ordinal"), tokens(F.col(quoted(c)), stop).alias("words")) for i, c in enumerate(text_cols)])
    words = (read.select("row_id", F.explode_outer(cells).alias("cell"))
             .select("row_id", "cell._ordinal", F.posexplode_outer("cell.words").alias("pos", "_word")))
    here = (F.col("_word") == F.col("term")) & (F.col("_ordinal") == F.col("ordinal")) & F.col("row_id").eqNullSafe(F.col("_row"))
    first = words.join(at, here).groupBy("term").agg(F.min(F.struct("ordinal", "row_id", "pos")).alias("first"))
    return first_ranked(likely.join(first, "term", "left"), [-F.col("n"), F.col("first")], top_k).select("term", "idx", "n")


def full_vocabulary(counts: DataFrame, min_count: int = 1, by: str | None = None) -> DataFrame:
    """Every term with at least ``min_count`` occurrences, indexed alphabetically
    (by code point), separately for each value of ``by``."""
    kept = counts.filter(F.col("n") >= min_count) if min_count > 1 else counts
    return dense_index(kept, ["term"], within=by)


def document_vocabulary(counts: DataFrame, min_df: int, max_features: int | None = None) -> DataFrame:
    """Terms in at least ``min_df`` documents; of these the ``max_features`` most
    frequent; indexed alphabetically."""
    kept = counts.filter(F.col("doc_freq") >= min_df)
    if max_features is None:
        return dense_index(kept, ["term"])
    best = first_ranked(kept, [-F.col("n"), F.col("term")], max_features, "_rank").drop("_rank")
    return first_ranked(best, [F.col("term")], max_features)


def pooled_counts(df: DataFrame, text_cols: Sequence[str], stop: Sequence[str] | None = None,
                  bigrams: bool = False) -> DataFrame:
    """Occurrences per term over all text columns; summed before the shuffle."""
    def words(c: str) -> Column:
        found = tokens(F.col(quoted(c)), stop)
        return let(found, lambda w: F.concat(w, ngrams(w, 2))) if bigrams else found

    # The plain explode would evaluate the words twice, first to skip empty rows.
    every = F.explode_outer(F.flatten(F.array(*[words(c) for c in text_cols])))
    return (df.select(every.alias("term")).filter(F.col("term").isNotNull())
            .groupBy("term").agg(F.count(F.lit(1)).alias("n")))


def pooled_vocabulary(df: DataFrame, text_cols: Sequence[str], top_k: int | None = None,
                      stop: Sequence[str] | None = None) -> DataFrame:
    """One vocabulary over all text columns. ``top_k`` of ``None`` or 0: all terms."""
    counts = pooled_counts(df, text_cols, stop)
    return top_vocabulary(counts, top_k) if top_k else full_vocabulary(counts)


def add_idf(vocabulary: DataFrame, n_rows: int | Column) -> DataFrame:
    """Smoothed inverse document frequency ``ln((N + 1) / (df + 1)) + 1``."""
    n = n_rows if isinstance(n_rows, Column) else F.lit(n_rows)
    ratio = (n + 1).cast("double") / (F.col("doc_freq") + 1).cast("double")
    return vocabulary.withColumn("idf", F.log(ratio) + F.lit(1.0))


def bag_of_words(terms: DataFrame, vocabulary: DataFrame, width: int,
                 keep: Sequence[str] = ()) -> DataFrame:
    """Counts over a pooled vocabulary; each text column has its own block of
    ``width`` places. Unknown terms drop out."""
    known = lookup_join(terms, vocabulary.select("term", "idx"), ["term"], "row_id")
    return known.select("row_id", *keep, "col", "term",
                        (F.col("ordinal") * F.lit(width) + F.col("idx")).cast("long").alias("idx"),
                        F.col("tf").cast("double").alias("value"))


def term_weights(terms: DataFrame, vocabulary: DataFrame, *, by: str | None = None,
                 tf: str = "log1p", norm: str | None = None) -> DataFrame:
    """Weight of each known term.

    ``tf``: ``raw`` count, ``log1p`` = ln(1 + tf), ``sublinear`` = 1 + ln(tf).
    The result is multiplied by ``idf`` if the vocabulary has one; ``norm="l2"``
    divides by the length of the row's vector.
    """
    on = ([by] if by else []) + ["term"]
    extra = [c for c in ("idf",) if c in vocabulary.columns]
    known = lookup_join(terms, vocabulary.select(*on, "idx", *extra), on, "row_id")
    count = F.col("tf").cast("double")
    scaled = {"raw": count, "log1p": F.log1p(count), "sublinear": F.lit(1.0) + F.log(count)}[tf]
    weighted = known.withColumn("value", scaled * F.col("idf") if "idf" in extra else scaled)
    if norm == "l2":
        length = F.sqrt(F.sum(F.col("value") * F.col("value")).over(Window.partitionBy("row_id")))
        weighted = weighted.withColumn("value", F.col("value") / length)
    return weighted.drop(*extra)
