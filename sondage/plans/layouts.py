"""The other three feature layouts of the study, each as one plan.

* one document per response: all answers joined, TF-IDF, stratified split
* selected features: cleaned text, one-hot ratings, multi-hot, chi-square, Bayes
* small baseline: two ratings, four options per question, nearest neighbours
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed import BASELINE_TARGETS, DEFAULT_RATING, KEPT_FEATURES, OPTION_RULES
from ..functions.options import multi_hot, options_among, options_anywhere
from ..functions.ratings import one_hot, rating
from ..functions.text import clean_words, english_stop_words
from ..operators import bayes, features as feats, records, splits, terms as tt
from ..operators.answers import learned_options
from ..operators.distribute import materialize
from ..operators.records import quoted
from ..sources import artifacts


@dataclass
class DocumentModel:
    """Fitted one-document layout; ``scales`` is None without scaling."""

    vocabulary: DataFrame
    classes: list[str]
    width: int
    scales: DataFrame | None = None

    def save(self, path: str) -> None:
        spark = self.vocabulary.sparkSession
        artifacts.save_table(self.vocabulary, f"{path}/vocabulary")
        if self.scales is not None:
            artifacts.save_table(self.scales, f"{path}/scales")
        artifacts.save_settings(spark, {"classes": self.classes, "width": self.width,
                                        "scaled": self.scales is not None}, f"{path}/settings")

    @staticmethod
    def load(spark: SparkSession, path: str) -> DocumentModel:
        s = artifacts.load_settings(spark, f"{path}/settings")
        return DocumentModel(artifacts.load_table(spark, f"{path}/vocabulary"), s["classes"], s["width"],
                             artifacts.load_table(spark, f"{path}/scales") if s["scaled"] else None)


def document_features(docs: DataFrame, row_id: str, text: str, vocabulary: DataFrame,
                      stop: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    terms = (tt.unfolded(docs.withColumnRenamed(row_id, "row_id"), keep) if tt.CELLS in docs.columns else
             tt.term_table(docs, row_id, [text], stop=stop, min_len=2, keep=keep))
    return tt.term_weights(terms, vocabulary, tf="sublinear", norm="l2")


def document_layout(df: DataFrame, row_id: str, label: str = "label", max_features: int = 400,
                    min_df: int = 3, test_size: float = 0.2, seed: int = 42, scale: bool = False,
                    stop: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame, DocumentModel]:
    """Features and rows (``row_id, label, label_idx, split``) of the one-document layout.

    Vocabulary and IDF are fitted on all rows, before the split.
    """
    stop = english_stop_words() if stop is None else stop
    # Read, joined and tokenised once; everything below reads this table.
    cells = tt.term_cells(["text"], tt.cell_words(stop, min_len=2)).alias(tt.CELLS)
    docs = materialize(records.one_document(df, label, keep=[row_id]).select(F.col(row_id).alias("row_id"), label, cells))
    counts = tt.count_terms(tt.unfolded(docs))
    vocabulary = tt.document_vocabulary(counts, min_df, max_features)
    vocabulary = materialize(tt.add_idf(vocabulary, docs.count()))
    classes = records.label_classes(docs, label)
    rows = splits.split_stratified(docs.select("row_id", label), "row_id", label, test_size, seed)
    rows = records.encode_label(rows, classes, label)
    features = document_features(docs, "row_id", "text", vocabulary, stop).select("row_id", "idx", "value")
    scales = None
    if scale:
        train = rows.filter(F.col("split") == "train").select("row_id")
        scales = materialize(feats.fit_scale(features.join(train, "row_id", "left_semi"), train.count()))
        features = feats.scale_features(features, scales)
    return features, rows, DocumentModel(vocabulary, classes, vocabulary.count(), scales)


@dataclass
class SelectedModel:
    """Vocabulary with IDF, kept features and Bayes parameters."""

    vocabulary: DataFrame
    kept: DataFrame
    bayes: bayes.BayesModel
    width: int
    n_kept: int
    config: dict = field(default_factory=dict)

    def save(self, path: str) -> None:
        artifacts.save_table(self.vocabulary, f"{path}/vocabulary")
        artifacts.save_table(self.kept, f"{path}/kept")
        artifacts.save_table(self.bayes.priors(), f"{path}/priors")
        artifacts.save_table(self.bayes.table, f"{path}/table")
        artifacts.save_settings(self.vocabulary.sparkSession, {
            "classes": self.bayes.classes, "log_prior": self.bayes.log_prior, "unseen": self.bayes.unseen,
            "width": self.width, "n_kept": self.n_kept, "config": self.config}, f"{path}/settings")

    @staticmethod
    def load(spark: SparkSession, path: str) -> SelectedModel:
        s = artifacts.load_settings(spark, f"{path}/settings")
        model = bayes.BayesModel(s["classes"], s["log_prior"], s["unseen"],
                                 artifacts.load_table(spark, f"{path}/table"))
        return SelectedModel(artifacts.load_table(spark, f"{path}/vocabulary"),
                             artifacts.load_table(spark, f"{path}/kept"), model, s["width"], s["n_kept"],
                             s["config"])


def _clean_terms(words: Column, stop: Sequence[str]) -> Column:
    """Second pass of the vectorizer over cleaned words: its own stop list."""
    return F.filter(clean_words(words), lambda w: ~w.isin(*stop))


def selected_features(df: DataFrame, row_id: str, text: str, rating_cols: Sequence[str],
                      multi_cols: Sequence[str], vocabulary: DataFrame, n_words: int,
                      stop: Sequence[str], rules=OPTION_RULES, keep: Sequence[str] = ()) -> DataFrame:
    """``[TF-IDF | one-hot ratings | multi-hot]`` before selection."""
    options = sorted({o for _, o in rules})
    terms = (tt.unfolded(df.withColumnRenamed(row_id, "row_id"), keep) if tt.CELLS in df.columns else
             tt.term_table(df, row_id, [text], analyzer=lambda c: _clean_terms(c, stop), keep=keep))
    words = tt.term_weights(terms, vocabulary, tf="sublinear", norm="l2").select("row_id", *keep, "idx", "value")
    levels = [one_hot(rating(F.col(quoted(c)), DEFAULT_RATING)) for c in rating_cols]
    chosen = [multi_hot(options_anywhere(F.col(quoted(c)), rules), options) for c in multi_cols]
    cells = feats.places(F.concat(*levels, *[F.transform(m, lambda v: v.cast("double")) for m in chosen]), n_words)
    rest = df.select(F.col(row_id).alias("row_id"), *keep, F.inline_outer(cells)).filter(F.col("idx").isNotNull())
    return words.unionByName(rest)


def selected_layout(df: DataFrame, row_id: str, text: str, rating_cols: Sequence[str],
                    multi_cols: Sequence[str], label: str = "label", min_df: int = 2,
                    k: int = KEPT_FEATURES, alpha: float = 0.5, rules=OPTION_RULES,
                    stop: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame, SelectedModel]:
    """Selected features, labelled rows and the model fitted on all of them.

    Text weights and selection are fitted on all labelled rows, also when the
    result is cross-validated afterwards.
    """
    stop = english_stop_words() if stop is None else stop
    rows = records.label_as_text(records.drop_unlabelled(df, label), label)
    # Read, joined, cleaned and tokenised once; everything below reads this table.
    cells = tt.term_cells([text], lambda c: _clean_terms(F.col(quoted(c)), stop))
    rows = materialize(rows.select(row_id, label, cells.alias(tt.CELLS), *[F.col(quoted(c)) for c in (*rating_cols, *multi_cols)]))
    class_rows = dict(splits.class_sizes(rows, label))
    n_rows = sum(class_rows.values())
    counts = tt.count_terms(tt.unfolded(rows.withColumnRenamed(row_id, "row_id")))
    vocabulary = materialize(tt.add_idf(tt.document_vocabulary(counts, min_df), n_rows))
    n_words = vocabulary.count()
    width = n_words + 5 * len(rating_cols) + len({o for _, o in rules}) * len(multi_cols)
    # Scored, masked, counted and cross-validated afterwards: computed once.
    features = materialize(selected_features(rows, row_id, text, rating_cols, multi_cols, vocabulary, n_words,
                                             stop, rules, keep=[label]))
    shares = {c: n / n_rows for c, n in class_rows.items()}
    kept = feats.select_top(feats.chi2_scores(features, label, shares), k)
    chosen = feats.apply_mask(features, kept)
    n_kept = min(k, width)
    model = SelectedModel(vocabulary, kept, bayes.fit_bayes(chosen, label, class_rows, n_kept, alpha), width,
                          n_kept, {"k": k, "alpha": alpha, "min_df": min_df})
    return chosen, rows.select(F.col(row_id).alias("row_id"), label), model


def baseline_rows(df: DataFrame, row_id: str, rating_cols: Sequence[str], multi_cols: Sequence[str],
                  label: str = "label", targets: Sequence[str] = BASELINE_TARGETS) -> DataFrame:
    """``row_id, label, x``: two ratings and, per question, the targets that occur.

    Incomplete rows are dropped first; the option columns are learned from the
    remaining rows, before any split.
    """
    rows = records.drop_incomplete(df)
    parts = [F.array(*[rating(F.col(quoted(c))).cast("double") for c in rating_cols])]
    for c in multi_cols:
        selected = options_among(F.col(quoted(c)), targets)
        seen = learned_options(rows, selected)
        if seen:
            parts.append(F.transform(multi_hot(selected, seen), lambda v: v.cast("double")))
    return rows.select(F.col(row_id).alias("row_id"), label, F.concat(*parts).alias("x"))
