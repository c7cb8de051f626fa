"""Text expressions. Every function takes and returns a Column; no UDF."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed import CLEAN_STOP

# A word is a maximal run of letters, digits and underscores of any script.
WORD = r"[\p{L}\p{N}_]+"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times inside ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def empty_strings() -> Column:
    return F.array().cast("array<string>")


def english_stop_words() -> list[str]:
    """Spark's own English stop list."""
    return StopWordsRemover.loadDefaultStopWords("english")


def tokens(c: str | Column, stop: Sequence[str] | None = None, min_len: int = 1) -> Column:
    """Lowercased words of a cell; a missing cell has none."""
    words = F.coalesce(
        F.regexp_extract_all(F.lower(_col(c).cast("string")), F.lit(WORD), F.lit(0)),
        empty_strings(),
    )
    if min_len > 1:
        words = F.filter(words, lambda w: F.length(w) >= min_len)
    if stop:
        words = F.filter(words, lambda w: ~w.isin(*stop))
    return words


def nested_tokens(c: str | Column, stop: Sequence[str] | None = None) -> Column:
    """Words of an array cell, leaf by leaf."""
    leaves = F.coalesce(F.transform(_col(c), lambda leaf: tokens(leaf, stop)),
                        F.array().cast("array<array<string>>"))
    return F.flatten(leaves)


def ngrams(words: Column, n: int = 2) -> Column:
    """Space-joined runs of ``n`` words; empty when there are fewer than ``n``."""
    def runs(w: Column) -> Column:
        last = F.size(w) - n
        starts = F.sequence(F.lit(0), F.greatest(last, F.lit(0)))
        return F.when(
            last >= 0,
            F.transform(starts, lambda i: F.concat_ws(" ", *[F.get(w, i + k) for k in range(n)])),
        ).otherwise(empty_strings())
    return let(words, runs)


def tokens_and_bigrams(c: str | Column, stop: Sequence[str] | None = None) -> Column:
    return let(tokens(c, stop), lambda w: F.concat(w, ngrams(w, 2)))


def strip_suffix(word: Column) -> Column:
    """Drop one ending: ``ing``, else ``ed``, else a single ``s``."""
    cut = (F.when(word.endswith("ing"), 3)
           .when(word.endswith("ed"), 2)
           .when(word.endswith("s") & ~word.endswith("ss"), 1)
           .otherwise(0))
    return F.substring(word, F.lit(1), F.length(word) - cut)


def clean_words(c: str | Column, stop: Sequence[str] = CLEAN_STOP) -> Column:
    """Words of a-z, without stop words and short words, endings stripped."""
    lower = F.lower(F.coalesce(_col(c).cast("string"), F.lit("")))
    words = F.regexp_extract_all(lower, F.lit("[a-z]+"), F.lit(0))
    kept = F.filter(words, lambda w: (F.length(w) > 2) & ~w.isin(*stop))
    return F.filter(F.transform(kept, strip_suffix), lambda w: F.length(w) > 2)


def clean_text(c: str | Column, stop: Sequence[str] = CLEAN_STOP) -> Column:
    return F.array_join(clean_words(c, stop), " ")


def log_length(words: Column) -> Column:
    return F.log1p(F.size(words).cast("double"))


def term_counts(words: Column) -> Column:
    """``array<struct<term, tf>>`` of one cell.

    Counting inside the row (sort, then measure the runs) needs no shuffle, in
    contrast to exploding the words and grouping by row and word.
    """
    def runs(w: Column) -> Column:
        n = F.size(w)
        at = F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)))
        starts = F.filter(
            at, lambda i: (n > 0) & ((i == 0) | (F.get(w, i) != F.get(w, i - 1))))
        return let(starts, lambda s: F.transform(s, lambda p, k: F.struct(
            F.get(w, p).alias("term"),
            (F.coalesce(F.get(s, k + 1), n) - p).cast("long").alias("tf"))))
    return let(F.sort_array(words), runs)
