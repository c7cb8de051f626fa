"""Fit / transform of whole feature layouts.

``fit`` computes small tables (vocabulary, modes); ``transform`` applies them to
any rows, labelled or not, and returns the long feature table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass, field, replace
from itertools import combinations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed import OPTION_RULES, OPTIONS, SHORT_STOP
from ..functions.options import log_count, multi_hot, options_by_part, pair_flags
from ..functions.ratings import scaled_rating
from ..functions.text import let, log_length, tokens
from ..operators import answers, features as feats, terms as tt, vectors
from ..operators.distribute import materialize
from ..operators.records import quoted
from ..sources import artifacts


@dataclass(frozen=True)
class FeatureConfig:
    """Columns and blocks of a layout. Blocks follow each other in the order of the
    fields below; a block that is off has width 0."""

    row_id: str
    text_cols: Sequence[str]
    rating_cols: Sequence[str]
    multi_cols: Sequence[str]
    text: str = "counts"              # "counts" (pooled vocabulary), "tfidf" (per column) or "none"
    dict_len: int | None = None       # size of the pooled vocabulary; all words if None or 0
    ties: str = "term"                # equal counts at the end of the pooled vocabulary: by "term" or "first" appearance
    min_count: int = 5                # least occurrences per column for "tfidf"
    stop: Sequence[str] = ()
    bigrams: bool = False
    ratings: bool = True
    scale_ratings: bool = False
    modes_from: str = "train"         # or "self": modes of the rows being transformed
    multi: bool = True
    pairs: bool = False               # needs multi as well
    lengths: bool = False
    option_counts: bool = False
    embeddings: bool = False
    rules: Sequence[tuple[str, str]] = OPTION_RULES
    options: Sequence[str] = OPTIONS


def pooled_layout(row_id: str, text_cols: Sequence[str], rating_cols: Sequence[str],
                  multi_cols: Sequence[str], dict_len: int | None = 100, **more) -> FeatureConfig:
    """Word counts of a pooled vocabulary per text column, raw ratings, multi-hot."""
    return replace(FeatureConfig(row_id, text_cols, rating_cols, multi_cols, dict_len=dict_len), **more)


def tfidf_layout(row_id: str, text_cols: Sequence[str], rating_cols: Sequence[str],
                 multi_cols: Sequence[str], **more) -> FeatureConfig:
    """TF-IDF per text column, scaled ratings, multi-hot, text lengths, option counts."""
    base = FeatureConfig(row_id, text_cols, rating_cols, multi_cols, text="tfidf", stop=SHORT_STOP,
                         scale_ratings=True, lengths=True, option_counts=True)
    return replace(base, **more)


def _answer_columns(df: DataFrame, c: FeatureConfig, keep: Sequence[str]) -> DataFrame:
    """What the blocks without a lookup need of a row."""
    lengths = [log_length(tokens(F.col(quoted(x)), c.stop or None)) for x in c.text_cols]
    return df.select(
        c.row_id, *keep, *([F.array(*lengths).alias("_lengths")] if c.lengths and lengths else []),
        *[F.col(quoted(x)) for x in c.rating_cols if c.ratings],
        *[options_by_part(F.col(quoted(m)), c.rules).alias(f"_sel{i}") for i, m in enumerate(c.multi_cols)])


def prepared(df: DataFrame, config: FeatureConfig, keep: Sequence[str] = ()) -> DataFrame:
    """Read, join and tokenise ``df`` once for ``fit`` and ``transform``: a written table with one row per row
    that holds its term counts, ratings, chosen options and lengths. Use the ``keep`` columns, if any, in both."""
    c = config
    words = tt.cell_words(c.stop or None, c.bigrams)
    extra = [F.col(quoted(x)) for x in c.text_cols] if c.ties == "first" and c.text == "counts" else []
    cells = tt.term_cells(c.text_cols if c.text != "none" or c.embeddings else [], words) if c.text_cols else F.array()
    answer = _answer_columns(df.withColumn(tt.CELLS, cells), c, [*keep, tt.CELLS, *extra])
    return materialize(answer)


@dataclass
class FeatureModel:
    config: FeatureConfig
    vocabulary: DataFrame | None
    widths: dict[str, int] = field(default_factory=dict)   # text column -> vocabulary size
    modes: dict[str, int] | None = None
    embeddings: DataFrame | None = None
    dim: int = 0

    def feature_map(self) -> list[tuple[str, int, int]]:
        """Blocks as (name, offset, width), in order."""
        c = self.config
        n_opt = len(c.options)
        blocks = [(f"text:{t}", self.widths.get(t, 0) if c.text != "none" else 0) for t in c.text_cols]
        blocks += [
            ("ratings", len(c.rating_cols) if c.ratings else 0),
            ("multi", len(c.multi_cols) * n_opt if c.multi else 0),
            ("pairs", len(list(combinations(range(n_opt), 2))) if c.multi and c.pairs else 0),
            ("lengths", len(c.text_cols) if c.lengths else 0),
            ("option_counts", len(c.multi_cols) if c.option_counts else 0),
            ("embeddings", len(c.text_cols) * self.dim if c.embeddings else 0)]
        out, at = [], 0
        for name, width in blocks:
            out.append((name, at, width))
            at += width
        return out

    @property
    def width(self) -> int:
        _, at, width = self.feature_map()[-1]
        return at + width

    def _smaller(self, size: int):
        """Whether a place stays with the first ``size`` words only, the place it moves to, and the width."""
        if self.config.text != "counts":
            raise ValueError("only a pooled vocabulary is ordered by rank")
        full = next(iter(self.widths.values()), 0)
        size, n = min(size, full), len(self.config.text_cols)
        if size == full:
            return None, None, self.width

        def stays(idx: Column) -> Column:
            return (idx >= n * full) | (idx % full < size)

        def moved(idx: Column) -> Column:
            return F.when(idx < n * full, F.floor(idx / full) * size + idx % full).otherwise(idx - n * (full - size))
        return stays, moved, self.width - n * (full - size)

    def with_vocabulary_of(self, size: int, features: DataFrame) -> tuple[DataFrame, int]:
        """The features and their width that a pooled vocabulary of the first ``size`` words would give, from those of this
        layout: places of later words go, all others move up."""
        stays, moved, width = self._smaller(size)
        if stays is None:
            return features, width
        return features.filter(stays(F.col("idx"))).withColumn("idx", moved(F.col("idx")).cast("long")), width

    def cells_of(self, size: int, cells: Column) -> tuple[Column, int]:
        """As ``with_vocabulary_of`` for the cells of a row (``features.packed_cells``), which keep their order."""
        stays, moved, width = self._smaller(size)
        if stays is None:
            return cells, width
        kept = F.filter(cells, lambda p: stays(p["idx"]))
        return F.transform(kept, lambda p: F.struct(moved(p["idx"]).cast("int").alias("idx"), p["value"].alias("value"))), width

    def _terms(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        c = self.config
        if tt.CELLS in df.columns:
            return tt.unfolded(df.withColumnRenamed(c.row_id, "row_id"), keep)
        return tt.term_table(df, c.row_id, c.text_cols, stop=c.stop or None, bigrams=c.bigrams, keep=keep)

    def _text(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        offsets = {name[len("text:"):]: at for name, at, _ in self.feature_map() if name.startswith("text:")}
        if self.config.text == "counts":
            hits = tt.bag_of_words(self._terms(df, keep), self.vocabulary,
                                   next(iter(self.widths.values()), 0), keep)
            return hits.select("row_id", *keep, "idx", "value")
        hits = tt.term_weights(self._terms(df, keep), self.vocabulary, by="col", tf="log1p")
        base = F.lit(0)
        for col, at in offsets.items():
            base = F.when(F.col("col") == col, F.lit(at)).otherwise(base)
        return hits.select("row_id", *keep, (base + F.col("idx")).cast("long").alias("idx"), "value")

    def _answers(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        """All blocks that need no lookup, built side by side in one pass."""
        c = self.config
        at = {name: offset for name, offset, _ in self.feature_map()}
        chosen = {m: f"_sel{i}" for i, m in enumerate(c.multi_cols)}
        df = df if tt.CELLS in df.columns else _answer_columns(df, c, keep)
        rows = df.withColumnRenamed(c.row_id, "row_id")
        blocks = []
        if c.ratings and c.rating_cols:
            modes = self.modes if c.modes_from == "train" else answers.rating_modes(df, c.rating_cols)
            values = [answers.imputed_rating(x, modes).cast("double") for x in c.rating_cols]
            values = [scaled_rating(v) for v in values] if c.scale_ratings else values
            blocks.append(feats.places(F.array(*values), at["ratings"]))
        if c.multi and c.multi_cols:
            hot = F.concat(*[multi_hot(F.col(s), c.options) for s in chosen.values()])
            blocks.append(feats.places(hot, at["multi"]))
        if c.multi and c.pairs and c.multi_cols:
            union = F.array_distinct(F.concat(*[F.col(s) for s in chosen.values()]))
            blocks.append(let(union, lambda u: feats.places(pair_flags(u, c.options), at["pairs"])))
        if c.lengths and c.text_cols:
            blocks.append(feats.places(F.col("_lengths"), at["lengths"]))
        if c.option_counts and c.multi_cols:
            blocks.append(feats.places(F.array(*[log_count(F.col(s)) for s in chosen.values()]),
                                       at["option_counts"]))
        if not blocks:
            return df.select(F.col(c.row_id).alias("row_id"), *keep).limit(0).select(
                "row_id", *keep, F.lit(0).cast("long").alias("idx"), F.lit(0.0).alias("value"))
        # The plain inline would evaluate the blocks twice, first to skip empty rows.
        long = rows.select("row_id", *keep, F.inline_outer(F.concat(*blocks)))
        return long.filter(F.col("idx").isNotNull())

    def _averages(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        at = self.feature_map()[-1][1]
        means = vectors.average_vectors(self._terms(df, ()), self.embeddings, self.dim)
        cells = F.transform("vec", lambda v, i: F.struct(
            (F.lit(at) + F.col("ordinal") * self.dim + i).cast("long").alias("idx"), v.alias("value")))
        long = means.select("row_id", F.inline_outer(F.filter(cells, lambda p: p["value"] != 0)))
        long = long.filter(F.col("idx").isNotNull())
        if keep:
            long = long.join(df.select(F.col(self.config.row_id).alias("row_id"), *keep), "row_id")
        return long.select("row_id", *keep, "idx", "value")

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """``row_id, [keep,] idx, value`` of all non-zero features; ``df`` may be prepared (see ``prepared``)."""
        parts = [self._answers(df, keep)]
        if self.config.text != "none" and self.vocabulary is not None:
            parts.insert(0, self._text(df, keep))
        if self.config.embeddings and self.embeddings is not None and self.dim:
            parts.append(self._averages(df, keep))
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    def vectors(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """``row_id, [keep,] features`` as ML vectors, one per row."""
        rows = df.select(F.col(self.config.row_id).alias("row_id"), *keep)
        return feats.sparse_vectors(self.transform(df), self.width, rows)

    def dense(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """``row_id, [keep,] x array<double>``, one per row."""
        return self.vectors(df, keep).withColumn("x", vector_to_array("features")).drop("features")

    def save(self, path: str) -> None:
        spark = self.vocabulary.sparkSession if self.vocabulary is not None else SparkSession.active()
        if self.vocabulary is not None:
            artifacts.save_table(self.vocabulary, f"{path}/vocabulary")
        if self.embeddings is not None:
            artifacts.save_table(self.embeddings, f"{path}/embeddings")
        options = spark.createDataFrame(list(enumerate(self.config.options)), "idx int, option string")
        artifacts.save_table(options, f"{path}/options")
        artifacts.save_settings(spark, {
            "config": asdict(self.config), "widths": self.widths, "modes": self.modes, "dim": self.dim,
            "has_vocabulary": self.vocabulary is not None, "has_embeddings": self.embeddings is not None,
        }, f"{path}/settings")

    @staticmethod
    def load(spark: SparkSession, path: str) -> FeatureModel:
        s = artifacts.load_settings(spark, f"{path}/settings")
        config = dict(s["config"])
        config["rules"] = [tuple(r) for r in config["rules"]]
        return FeatureModel(
            FeatureConfig(**config),
            artifacts.load_table(spark, f"{path}/vocabulary") if s["has_vocabulary"] else None,
            s["widths"], s["modes"],
            artifacts.load_table(spark, f"{path}/embeddings") if s["has_embeddings"] else None, s["dim"])


@dataclass(frozen=True)
class FeaturePipeline:
    config: FeatureConfig

    def count_words(self, df: DataFrame) -> DataFrame:
        """Word counts of the pooled vocabulary; reusable for several ``dict_len``."""
        c = self.config
        if tt.CELLS in df.columns:
            return tt.count_terms(tt.unfolded(df.withColumnRenamed(c.row_id, "row_id")))
        return tt.pooled_counts(df, c.text_cols, c.stop or None, c.bigrams)

    def fit(self, df: DataFrame, counts: DataFrame | None = None, embeddings: DataFrame | None = None,
            dim: int = 0) -> FeatureModel:
        c = self.config
        vocabulary, widths = None, {}
        if c.text == "counts" and c.ties == "first":
            if not c.dict_len or c.bigrams:
                raise ValueError("first-appearance ties need a dict_len and single words")
            vocabulary = materialize(tt.first_seen_vocabulary(df, c.row_id, c.text_cols, c.dict_len, c.stop or None))
            size = vocabulary.count()
            widths = {t: size for t in c.text_cols}
        elif c.text == "counts":
            counts = self.count_words(df) if counts is None else counts
            vocabulary = tt.top_vocabulary(counts, c.dict_len) if c.dict_len else tt.full_vocabulary(counts)
            size = vocabulary.count()
            widths = {t: size for t in c.text_cols}
        elif c.text == "tfidf":
            terms = (tt.unfolded(df.withColumnRenamed(c.row_id, "row_id")) if tt.CELLS in df.columns else
                     tt.term_table(df, c.row_id, c.text_cols, stop=c.stop or None, bigrams=c.bigrams))
            vocabulary = tt.full_vocabulary(tt.count_terms(terms, ["col"]), c.min_count, by="col")
            vocabulary = materialize(tt.add_idf(vocabulary, df.count()))
            sizes = {r["col"]: r["n"] for r in vocabulary.groupBy("col").agg(F.count(F.lit(1)).alias("n")).collect()}
            widths = {t: sizes.get(t, 0) for t in c.text_cols}
        modes = None
        if c.ratings and c.rating_cols and c.modes_from == "train":
            modes = answers.rating_modes(df, c.rating_cols)
        if not (c.embeddings and embeddings is not None and dim):
            embeddings, dim = None, 0
        return FeatureModel(c, vocabulary, widths, modes, embeddings, dim)
