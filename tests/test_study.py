"""Fitted steps, layouts, models and saved state on a small survey."""

from __future__ import annotations

import json
import math

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from sondage.functions.fixed import CLASSES
from sondage.operators import answers, forest as forests, metrics, models, records, splits, terms as tt
from sondage.operators import vectors
from sondage.plans import layouts, predict, prepare, reports
from sondage.plans.pipeline import FeatureModel, FeaturePipeline, pooled_layout, tfidf_layout
from sondage.sources import artifacts, survey, wordvectors

TEXTS = ["text_1", "text_6", "text_9"]
RATINGS = ["rating_2", "rating_4", "rating_7", "rating_8"]
MULTI = ["multi_3", "multi_5"]


def long_rows(df):
    return sorted((r["row_id"], r["idx"], round(r["value"], 9)) for r in df.collect())


# --- vocabulary and weights --------------------------------------------------------

def test_vocabulary_ties(spark):
    df = spark.createDataFrame([(0, "b a b", None), (1, None, "a c")], "row_id long, x string, y string")
    def words(v):
        return [(r["term"], r["idx"]) for r in v.orderBy("idx").collect()]
    assert words(tt.pooled_vocabulary(df, ["x", "y"], 2)) == [("a", 0), ("b", 1)]
    assert words(tt.first_seen_vocabulary(df, "row_id", ["x", "y"], 2)) == [("b", 0), ("a", 1)]
    assert words(tt.pooled_vocabulary(df, ["x", "y"])) == [("a", 0), ("b", 1), ("c", 2)]
    assert words(tt.pooled_vocabulary(df, ["x", "y"], 0)) == [("a", 0), ("b", 1), ("c", 2)]
    assert words(tt.pooled_vocabulary(df, ["x", "y"], 5, stop=["b"])) == [("a", 0), ("c", 1)]


def test_idf_and_weight(spark):
    df = spark.createDataFrame([(0, "word word"), (1, "other"), (2, None)], "row_id long, t string")
    terms = tt.term_table(df, "row_id", ["t"])
    vocabulary = tt.add_idf(tt.full_vocabulary(tt.count_terms(terms, ["col"]), 1, by="col"), df.count())
    got = {r["term"]: r["idf"] for r in vocabulary.collect()}
    assert got["word"] == pytest.approx(1.693147, abs=1e-6)
    weights = {r["term"]: r["value"] for r in tt.term_weights(terms, vocabulary, by="col").collect()}
    assert weights["word"] == pytest.approx(1.860112, abs=1e-6)
    plain = tt.term_weights(terms, vocabulary.drop("idf"), by="col")  # without IDF
    assert {r["term"]: r["value"] for r in plain.collect()}["word"] == pytest.approx(math.log(3))


def test_average_vectors(spark):
    df = spark.createDataFrame([(0, "a a b zz"), (1, "zz"), (2, None)], "row_id long, t string")
    words = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [4.0, 8.0])], "word string, vec array<float>")
    means = vectors.average_vectors(tt.term_table(df, "row_id", ["t"]), words, 2)
    got = {r["row_id"]: r["vec"] for r in vectors.zero_filled(df, means, "row_id", 1, 2).collect()}
    assert got == {0: [2.0, 4.0], 1: [0.0, 0.0], 2: [0.0, 0.0]}


# --- answers -----------------------------------------------------------------------

def test_modes(spark):
    df = spark.createDataFrame([(v,) for v in ("2", "1 x", None, "2", "1", "3")], "r string")
    assert answers.rating_modes(df, ["r"]) == {"r": 1}
    assert [r["r"] for r in answers.impute_ratings(df, ["r"]).collect()] == [2, 1, 1, 2, 1, 3]
    scaled = [r["r"] for r in answers.impute_ratings(df, ["r"], scale=True).collect()]
    assert scaled == [0.25, 0.0, 0.0, 0.25, 0.0, 0.5]
    assert answers.impute_ratings(df, ["r"], {"r": 5}).collect()[2]["r"] == 5
    with pytest.raises(ValueError):
        answers.rating_modes(df.filter("r IS NULL"), ["r"])


# --- records ------------------------------------------------------------------------

def test_records(spark, survey_rows):
    with pytest.raises(ValueError):
        records.require_column(survey_rows, "nothing")
    kept = records.drop_unlabelled(survey_rows)
    assert records.label_classes(kept) == list(CLASSES)
    assert {r["label_idx"] for r in records.encode_label(kept, CLASSES).collect()} == {0, 1, 2}
    docs = records.one_document(survey_rows, keep=["row_id"]).orderBy("row_id").first()
    first = survey_rows.orderBy("row_id").first()
    assert docs["text"] == " ".join(first[c] or "" for c in survey_rows.columns[2:-1]) and docs["label"] == " "


# --- layouts --------------------------------------------------------------------------

def test_pooled_layout_by_hand(spark):
    df = spark.createDataFrame(
        [(0, "b a b", None, "3 x", "math computations", "label"), (1, None, "a c", None, "LaTeX, emails", "label"),
         (2, "", "q", "3", None, "label")],
        "row_id long, x string, y string, r string, m string, label string")
    config = pooled_layout("row_id", ["x", "y"], ["r"], ["m"], dict_len=2)
    model = FeaturePipeline(config).fit(df)
    assert model.width == 2 * 2 + 1 + 8
    assert long_rows(model.transform(df)) == sorted([
        (0, 0, 1.0), (0, 1, 2.0), (0, 4, 3.0), (0, 5, 1.0),
        (1, 2, 1.0), (1, 4, 3.0), (1, 5 + 6, 1.0), (1, 5 + 7, 1.0), (2, 4, 3.0)])


@pytest.mark.parametrize("more", [{}, {"pairs": True}, {"bigrams": True}, {"ratings": False}, {"multi": False, "pairs": True},
                                  {"text": "none"}, {"lengths": False, "option_counts": False}])
def test_layout_blocks(spark, survey_rows, more):
    model = FeaturePipeline(tfidf_layout("row_id", TEXTS, RATINGS, MULTI, **more)).fit(survey_rows)
    blocks = {name: (at, width) for name, at, width in model.feature_map()}
    assert blocks["ratings"][1] == (0 if more.get("ratings") is False else 4)
    assert blocks["multi"][1] == (0 if more.get("multi") is False else 16)
    assert blocks["pairs"][1] == (28 if more == {"pairs": True} else 0)
    assert blocks["embeddings"][1] == 0
    rows = long_rows(model.transform(survey_rows))
    assert len({(r, i) for r, i, _ in rows}) == len(rows)
    assert all(0 <= i < model.width and v != 0 for _, i, v in rows)
    for name, (at, width) in blocks.items():
        if width and name != "embeddings":
            assert any(at <= i < at + width for _, i, _ in rows), name


def test_layout_with_embeddings(spark, survey_rows):
    words = spark.createDataFrame([("code", [1.0, -1.0, 0.5]), ("search", [0.0, 2.0, 0.0])], "word string, vec array<float>")
    config = tfidf_layout("row_id", TEXTS, RATINGS, MULTI, embeddings=True)
    model = FeaturePipeline(config).fit(survey_rows, embeddings=words, dim=3)
    name, at, width = model.feature_map()[-1]
    assert (name, width) == ("embeddings", 9)
    assert any(i >= at for _, i, _ in long_rows(model.transform(survey_rows)))
    off = FeaturePipeline(config).fit(survey_rows)
    assert off.feature_map()[-1][2] == 0 and off.width == at


@pytest.mark.parametrize("make", [pooled_layout, tfidf_layout])
def test_saved_layout_is_the_same(spark, survey_rows, tmp_path, make):
    split = splits.split_by_group(survey_rows, "student_id")
    model = FeaturePipeline(make("row_id", TEXTS, RATINGS, MULTI)).fit(split.filter("split = 'train'"))
    model.save(str(tmp_path / "m"))
    back = FeatureModel.load(spark, str(tmp_path / "m"))
    test = split.filter("split = 'test'").drop("label")  # a label is not needed
    assert back.feature_map() == model.feature_map()
    assert long_rows(back.transform(test)) == long_rows(model.transform(test)) != []
    dense = model.dense(test).collect()
    assert len(dense) == test.count() and all(len(r["x"]) == model.width for r in dense)


def test_layout_with_question_texts(spark, survey_rows, tmp_path):
    """Column names with dots, commas and question marks."""
    from sondage.functions.fixed import MULTI_QUESTIONS, RATING_QUESTIONS, TASK_QUESTION
    names = {"text_1": TASK_QUESTION, "text_6": "Why? (e.g., a.b)", **dict(zip(RATINGS, RATING_QUESTIONS)),
             **dict(zip(MULTI, MULTI_QUESTIONS))}
    asked = survey_rows.withColumnsRenamed(names)
    for make in (pooled_layout, tfidf_layout):
        plain = FeaturePipeline(make("row_id", TEXTS, RATINGS, MULTI)).fit(survey_rows)
        model = FeaturePipeline(make("row_id", [names.get(t, t) for t in TEXTS], list(RATING_QUESTIONS),
                                     list(MULTI_QUESTIONS))).fit(asked)
        model.save(str(tmp_path / make.__name__))
        back = FeatureModel.load(spark, str(tmp_path / make.__name__))
        assert sorted(r[2] for r in long_rows(back.transform(asked))) == sorted(r[2] for r in long_rows(plain.transform(survey_rows)))
    rows = layouts.baseline_rows(asked, "row_id", RATING_QUESTIONS[:2], MULTI_QUESTIONS)
    assert rows.count() == records.drop_incomplete(survey_rows).count()
    kept, _, model = layouts.selected_layout(asked, "row_id", TASK_QUESTION, RATING_QUESTIONS, MULTI_QUESTIONS, k=10)
    assert model.n_kept == 10 and kept.count() > 0


def test_modes_of_the_transformed_rows(spark):
    df = spark.createDataFrame([(0, "1"), (1, "1"), (2, None)], "row_id long, r string")
    new = spark.createDataFrame([(5, "4"), (6, None)], "row_id long, r string")
    for source, value in (("train", 1.0), ("self", 4.0)):
        config = pooled_layout("row_id", [], ["r"], [], text="none", modes_from=source)
        got = FeaturePipeline(config).fit(df).transform(new).collect()
        assert {r["row_id"]: r["value"] for r in got}[6] == value


def test_document_layout(spark, survey_rows, tmp_path):
    features, rows, model = layouts.document_layout(survey_rows, "row_id", min_df=3, scale=True)
    assert model.classes == ["", " ", *CLASSES]
    assert rows.count() == 90 and rows.filter("split = 'val'").count() == 18
    model.save(str(tmp_path / "d"))
    back = layouts.DocumentModel.load(spark, str(tmp_path / "d"))
    assert back.classes == model.classes and back.scales.count() == model.scales.count()
    assert back.vocabulary.count() == model.width
    plain, _, _ = layouts.document_layout(survey_rows, "row_id", min_df=3)
    norms = plain.groupBy("row_id").agg(F.sum(F.col("value") * F.col("value")).alias("n")).collect()
    assert all(abs(r["n"] - 1) < 1e-9 for r in norms)


def test_selected_layout(spark, survey_rows, tmp_path):
    features, rows, model = layouts.selected_layout(survey_rows, "row_id", "text_1", RATINGS, MULTI, k=12)
    assert model.n_kept == 12 and {r["idx"] for r in features.select("idx").distinct().collect()} <= set(range(12))
    assert rows.count() == records.drop_unlabelled(survey_rows).count()
    model.save(str(tmp_path / "s"))
    back = layouts.SelectedModel.load(spark, str(tmp_path / "s"))
    def params(m):
        return sorted(map(tuple, m.bayes.parameters().collect()))
    assert params(back) == params(model) and back.bayes.log_prior == model.bayes.log_prior


def test_baseline(spark, survey_rows):
    rows = layouts.baseline_rows(survey_rows, "row_id", RATINGS[:2], MULTI)
    assert rows.count() == records.drop_incomplete(survey_rows).count()
    assert {len(r["x"]) for r in rows.collect()} == {2 + 2 + 2}  # two of the targets occur


# --- evaluation ------------------------------------------------------------------------

def test_metrics(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "b")], "y string, p string")
    assert metrics.accuracy_of(df, "y", "p") == 0.5
    assert metrics.macro_f1(df, "y", "p").first()[0] == pytest.approx(0.388889, abs=1e-6)
    assert metrics.weighted_f1(df, "y", "p").first()[0] == pytest.approx(0.458333, abs=1e-6)
    s = metrics.summary_metrics(df, "y", "p")
    assert s["accuracy"] == 0.5 and s["f1_macro"] == pytest.approx(0.388889, abs=1e-6)
    got = {(r["y"], r["p"]): r["n"] for r in metrics.confusion_matrix(df, "y", "p").collect()}
    assert [got["a", c] for c in "abc"] == [1, 1, 0] and [got["b", c] for c in "abc"] == [0, 1, 0]
    assert [got["c", c] for c in "abc"] == [0, 1, 0] and sum(got.values()) == 4
    f1 = {r["class"]: r["f1"] for r in metrics.classification_report(df, "y", "p").collect()}
    assert f1["a"] == pytest.approx(2 / 3) and f1["c"] == 0 and f1["weighted avg"] == pytest.approx(0.458333, abs=1e-6)
    assert [tuple(r) for r in metrics.error_pairs(df, "y", "p").collect()] == [("a", "b", 1), ("c", "b", 1)]
    usual = {r["y"]: (r["p"], r["n"]) for r in metrics.usual_confusion(df, "y", "p").collect()}
    assert usual == {"a": ("b", 1), "b": (None, None), "c": ("b", 1)}
    grid = spark.createDataFrame([(0, 0.5), (1, 0.7), (2, 0.7)], "position int, m double")
    assert metrics.best_setting(grid, "m", "position").first()["position"] == 1


# --- sources ------------------------------------------------------------------------------

def test_csv(spark, tmp_path):
    (tmp_path / "s.csv").write_text(
        'student_id,"What, really? (a.b)",rating,label\n'
        's1,"line one\nline ""two"", x",3 - a,Claude\ns2,NA,nan,\ns3,"  ",None,Gemini\n', encoding="utf-8")
    df = survey.read_survey(spark, str(tmp_path / "s.csv"), multiline=True)
    rows = [tuple(r) for r in df.orderBy("student_id").collect()]
    assert rows == [("s1", 'line one\nline "two", x', "3 - a", "Claude"), ("s2", None, None, None),
                    ("s3", "  ", None, "Gemini")]
    assert records.select_positions(df, [1]).columns == ["What, really? (a.b)"]
    assert records.fill_empty(df).filter("label = ''").count() == 1


def test_word_vectors(spark, tmp_path):
    path = str(tmp_path / "v.txt")
    open(path, "w").write("a 1 2 3\nbad x y z\nshort 1\na 4 5 6\n b  7 8\t9 \nc 1 1 1\n")
    def read(n=None):
        return {r["word"]: r["vec"] for r in wordvectors.read_word_vectors(spark, path, n).collect()}
    assert read() == {"a": [4, 5, 6], "b": [7, 8, 9], "c": [1, 1, 1]}
    assert read(0) == {"a": [1, 2, 3]}
    assert read(1) == {"a": [4, 5, 6]}           # lines 1 and 2 are skipped, so line 3 ends the scan
    assert read(4) == {"a": [4, 5, 6], "b": [7, 8, 9]}
    assert read(99) == read()


def test_word_vectors_over_many_blocks(spark, tmp_path):
    path = str(tmp_path / "v.txt")
    with open(path, "w") as f:
        for i in range(4000):
            f.write(f"w{i % 1000} {i} {i}.5\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        for limit, top in ((None, 3999), (2500, 2500)):
            got = {r["word"]: r["vec"][0] for r in wordvectors.read_word_vectors(spark, path, limit).collect()}
            assert got == {f"w{i}": float(max(j for j in range(i, top + 1, 1000))) for i in range(1000)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_vocabulary_json(spark, tmp_path):
    (tmp_path / "voc.json").write_text(json.dumps({"i": 0, "the": 1, "é": 2}, ensure_ascii=False, indent=2), encoding="utf-8")
    got = artifacts.vocabulary_of_json(spark, str(tmp_path / "voc.json")).collect()
    assert {r["term"]: r["idx"] for r in got} == {"i": 0, "the": 1, "é": 2}


# --- forests and models ---------------------------------------------------------------------

def test_forest_document(spark, tmp_path):
    tree = {"node_count": 3, "children_left": [1, -1, -1], "children_right": [2, -1, -1], "feature": [0, -2, -2],
            "threshold": [0.5, -2.0, -2.0], "value": [[3, 1, 2], [3, 1, 0], [0, 0, 2]]}
    (tmp_path / "f.json").write_text(json.dumps({"n_estimators": 1, "n_features": 1, "trees": [tree]}))
    (tmp_path / "g.json").write_text(json.dumps({"trees": [tree, tree]}, indent=1))
    rows = spark.createDataFrame([(0, [0.5]), (1, [0.6])], "id int, x array<double>")
    for name, multiline in (("f.json", False), ("g.json", True)):
        nodes = forests.nodes_of_json(spark, str(tmp_path / name), multiline)
        got = forests.score_forest(rows, nodes, CLASSES, "x").orderBy("id").collect()
        assert [r["prediction"] for r in got] == ["ChatGPT", "Gemini"]
        assert got[0]["probability"] == [0.75, 0.25, 0.0]
    forests.write_forest_json(nodes, str(tmp_path / "lines"))
    back = forests.nodes_of_json(spark, str(tmp_path / "lines"))
    assert sorted(map(str, back.collect())) == sorted(map(str, nodes.collect()))


@pytest.fixture(scope="module")
def blobs(spark):
    rows = spark.range(240).select(
        F.col("id").alias("row_id"), (F.col("id") % 3).alias("c"),
        *[((F.col("id") % 3 == j).cast("double") * 2 + F.rand(j) * 1.5).alias(f"x{j}") for j in range(3)])
    rows = rows.select("row_id", F.element_at(F.array(*[F.lit(c) for c in CLASSES]), (F.col("c") + 1).cast("int")).alias("label"),
                       F.array("x0", "x1", "x2").alias("x"))
    return splits.split_shuffled(rows, "row_id", ratios=(0.7, 0.15)).persist()


def test_exported_forest_predicts_like_the_model(spark, blobs, tmp_path):
    data = reports.ml_rows(blobs, "x", "label", CLASSES, ["row_id"])
    model = models.forest(12, 6, 2).fit(data)
    model.write().overwrite().save(str(tmp_path / "rf"))
    nodes = forests.nodes_of_model(spark, str(tmp_path / "rf"))
    want = {r["row_id"]: (CLASSES[int(r["prediction"])], r["p"]) for r in model.transform(data).select(
        "row_id", "prediction", vector_to_array("probability").alias("p")).collect()}
    for per_pass in (10 ** 6, 40):  # one pass, then several trees at a time
        got = forests.score_forest(blobs, nodes, CLASSES, "x", nodes_per_pass=per_pass).collect()
        assert len(got) == 240
        for r in got:
            assert r["prediction"] == want[r["row_id"]][0]
            assert r["probability"] == pytest.approx(want[r["row_id"]][1])


def test_layer_table_repeats_the_perceptron(spark, blobs):
    data = reports.ml_rows(blobs, "x", "label", CLASSES, ["row_id"])
    model = models.perceptron(3, 3, (4,), 30).fit(data)
    (_, w1, b1), (_, w2, b2) = [tuple(r) for r in models.layer_table(model, data).orderBy("layer").collect()]
    for r in model.transform(data).limit(20).collect():
        x = list(r["features"])
        hidden = [1 / (1 + math.exp(-(b1[o] + sum(x[i] * w1[i][o] for i in range(3))))) for o in range(4)]
        out = [b2[o] + sum(hidden[i] * w2[i][o] for i in range(4)) for o in range(3)]
        assert out.index(max(out)) == int(r["prediction"])


def test_report_and_comparison(spark, blobs):
    report = reports.full_report(blobs, "row_id", "x", "label", CLASSES, strengths=(1.0,), sizes=(5,), depths=(4,), ks=(1, 3))
    rows = report.summary.collect()
    assert [r["model"] for r in rows] == ["Logistic Regression", "Random Forest", "KNN"]
    assert report.best == max(rows, key=lambda r: (r["test_accuracy"], -r["position"]))["model"]
    assert all(r["test_accuracy"] > 0.6 for r in rows)
    assert sum(r["n"] for r in report.confusion().collect()) == report.predictions.count()
    compared = reports.compare_defaults(blobs, "row_id", "x", "label", CLASSES, trees=5, depth=4).collect()
    assert len(compared) == 3 and all(r["val_accuracy"] > 0.6 for r in compared)
    data = reports.ml_rows(blobs, "x", "label", CLASSES, ["split"])
    curve = models.learning_curve(data.filter("split = 'train'"), data.filter("split = 'val'"), 3, 3, (5,), 3).collect()
    assert [r["epoch"] for r in curve] == [1, 2, 3]


def test_predict_all(spark, survey_rows, tmp_path):
    config = pooled_layout("row_id", TEXTS, RATINGS, MULTI, dict_len=40)
    layout, model, classes = predict.train_forest(survey_rows, config, "label", str(tmp_path / "m"), trees=15, depth=5)
    assert classes == list(CLASSES)
    survey.write_survey(survey_rows.drop("label"), str(tmp_path / "in"))
    got = {int(r["row_id"]): r["prediction"] for r in
           predict.predict_all(spark, str(tmp_path / "in"), str(tmp_path / "m"), multiline=True).collect()}
    assert len(got) == 90
    known = survey_rows.filter(F.col("label").isin(*CLASSES)).select("row_id", "label").collect()
    assert sum(got[r["row_id"]] == r["label"] for r in known) / len(known) > 0.7
    same = model.transform(layout.vectors(survey_rows)).select("row_id", "prediction").collect()
    assert all(got[r["row_id"]] == CLASSES[int(r["prediction"])] for r in same)
    survey.write_survey(survey_rows.drop("row_id", "label"), str(tmp_path / "nokey"))
    assert predict.predict_all(spark, str(tmp_path / "nokey"), str(tmp_path / "m"), multiline=True).count() == 90


def test_vocabulary_size_sweep(spark, survey_rows):
    plan = FeaturePipeline(pooled_layout("row_id", TEXTS, RATINGS, MULTI))
    rows = records.drop_unlabelled(survey_rows)
    got = reports.vocabulary_size_sweep(rows, plan, "label", CLASSES, sizes=(5, 20), trees=(4,), depths=(3,), min_leaf=(1,))
    assert [r["dict_len"] for r in got.orderBy("position").collect()] == [5, 20]


def test_prepare(spark, survey_rows):
    names = [c for c in survey_rows.columns if c != "row_id"]
    config = prepare.config_by_position(names, "row_id", dict_len=20)
    assert (list(config.text_cols), list(config.rating_cols), list(config.multi_cols)) == (TEXTS, RATINGS, MULTI)
    features, model = prepare.prepare_training(survey_rows, config, "label",
                                               lambda r: splits.split_by_group(r, "student_id"))
    assert {r["split"] for r in features.select("split").distinct().collect()} == {"train", "val", "test"}
    train = splits.split_by_group(survey_rows, "student_id").filter("split = 'train'")
    assert long_rows(features.filter("split = 'train'")) == long_rows(FeaturePipeline(config).fit(train).transform(train))
    test, _ = prepare.prepare_shuffled_test(survey_rows, config, cuts=(60, 70))
    assert test.select("row_id").distinct().count() == 20
    whole, own = prepare.prepare_file(survey_rows.drop("label"), config)
    assert own.width == 3 * 20 + 4 + 16 and whole.select("row_id").distinct().count() == 90


def test_forest_reports(spark, blobs):
    data = reports.ml_rows(blobs, "x", "label", CLASSES, ["row_id", "split"])
    train, val, test = (data.filter(F.col("split") == s) for s in ("train", "val", "test"))
    model = models.forest(5, 4, 2).fit(train)
    scores, report = reports.evaluate(model, val, CLASSES)
    assert scores["accuracy"] == pytest.approx(models.accuracy(model, val)) and report.count() == 6
    acc, pairs, usual = reports.forest_errors(train, test, CLASSES, trees=5, depth=2)
    assert usual.count() == 3
    assert sum(r["n"] for r in pairs.collect()) == round((1 - acc) * test.count())
    folds = splits.kfold_stratified(train, "row_id", "label_idx", 3)
    best, setting, on_val = reports.tuned_forest(folds, val, CLASSES, n_folds=3, trees=(3,), depths=(1, 4), min_leaf=(1,))
    assert setting["depth"] in (1, 4) and 0.5 < best <= 1 and 0.5 < on_val["accuracy"] <= 1
