"""Mechanisms for large inputs: plans, record borders, rank selection, hot keys, nested fits, sparse scoring."""

from __future__ import annotations

import csv
import io
import random

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from sondage.operators import distribute, features as feats, forest as forests, models, neighbours, terms as tt
from sondage.operators.distribute import materialize
from sondage.plans import layouts, predict
from sondage.plans.pipeline import FeaturePipeline, pooled_layout, prepared
from sondage.sources import survey


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_terms_are_tokenised_once(spark):
    docs = spark.createDataFrame([(1, "a b a"), (2, None), (3, "")], "id long, t string")
    for df in (tt.term_table(docs, "id", ["t"]), tt.count_terms(tt.term_table(docs, "id", ["t"]))):
        plan = optimized(df)
        assert plan.count("regexp_extract_all") + plan.count("split(") == 1, plan
    assert sorted((r["row_id"], r["term"], r["tf"]) for r in tt.term_table(docs, "id", ["t"]).collect()) == [(1, "a", 2), (1, "b", 1)]


# --- CSV --------------------------------------------------------------------------------

def messy_rows(n: int) -> list[list[str]]:
    rng = random.Random(3)
    bits = ["plain", "with, comma", "line\nbreak", 'a "quoted" word', "\n\n", "trailing\n", "é\n日本", "x" * 300, "a\nb\nc\nd", " "]
    return [[str(i), rng.choice(bits) + str(i), rng.choice(bits)] for i in range(n)]


def write_csv(path, rows: list[list[str]], end: str = "\n") -> None:
    out = io.StringIO(newline="")
    writer = csv.writer(out, quoting=csv.QUOTE_ALL, lineterminator=end)
    writer.writerow(["id", "text, one", "b"])
    writer.writerows(rows)
    path.write_text(out.getvalue(), newline="")


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_line_breaks_in_cells_of_many_blocks(spark, tmp_path, end):
    """Every file is cut into many splits, many of them inside a cell; some records cross several."""
    rows = messy_rows(400)
    (tmp_path / "in").mkdir()
    write_csv(tmp_path / "in" / "a.csv", rows[:250], end)
    write_csv(tmp_path / "in" / "b.csv", rows[250:], end)
    keys = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "60"}
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        lines = survey._lines(spark, str(tmp_path / "in"))
        blocks = lines.select("file", "block").distinct().count()
        assert blocks > 40 and lines.rdd.getNumPartitions() > 20
        df = survey.read_survey(spark, str(tmp_path / "in"), multiline=True)
        assert df.columns == ["id", "text, one", "b"]
        got = sorted(map(tuple, df.collect()), key=lambda r: int(r[0]))
        assert got == [tuple(r) for r in rows]
        given = survey.read_survey(spark, str(tmp_path / "in"), survey.string_schema(["x", "y", "z"]), multiline=True)
        assert given.columns == ["x", "y", "z"] and given.count() == 400
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_small_csv_tables(spark, tmp_path):
    for name, text, want in (("only_header", "a,b\n", []), ("empty", "", []), ("blank_lines", "a,b\n\n1,\n\n\"x\ny\",NA\n\n", [("1", None), ("x\ny", None)]),
                             ("no_last_break", 'a,b\n"1\n",2', [("1\n", "2")])):
        (tmp_path / name).write_text(text)
        df = survey.read_survey(spark, str(tmp_path / name), multiline=True)
        assert sorted(map(tuple, df.collect())) == sorted(want), name
    assert survey._header('a,"",a,"b\nc"') == ["a0", "_c1", "a2", "b\nc"]


# --- rank selection and hot keys ----------------------------------------------------------

def test_cutoffs_move_no_keys(spark):
    """Skewed, repeated and string keys; sorting is left to the last few rows."""
    rng = random.Random(5)
    for values, kind in (([rng.choice([0, 0, 0, 7, rng.randrange(10**6)]) for _ in range(4000)], "long"),
                         ([f"the same beginning {rng.randrange(500):04d}" for _ in range(4000)], "string"),
                         ([rng.choice([float("nan"), -1.5, rng.random()]) for _ in range(4000)], "double")):
        df = materialize(spark.createDataFrame([(v,) for v in values], f"k {kind}"))
        order = sorted(values, key=lambda v: (v != v, v))
        ranks = [1, 10, 2000, 3999, 4000, 4001]
        got = distribute.order_cutoffs(df, "k", ranks, at_once=100, width=32)
        assert sorted(got) == ranks[:-1]
        assert [repr(got[r]) for r in ranks[:-1]] == [repr(order[r - 1]) for r in ranks[:-1]]


def test_first_rows_of_a_large_table(spark, monkeypatch):
    monkeypatch.setattr(distribute, "MERGED_AT_ONCE", 10)
    rows = [(i % 37, f"t{(i * 7919) % 3000:04d}") for i in range(3000)]
    df = materialize(spark.createDataFrame(rows, "n long, term string").withColumn("neg", -F.col("n")))
    want = sorted(((-n, t) for n, t in rows))[:200]
    moved = distribute.up_to_rank(df, ["neg", "term"], 200)
    assert sorted((r["neg"], r["term"]) for r in moved.collect()) == want  # and no other row
    got = distribute.first_ranked(df, [F.col("neg"), F.col("term")], 200).orderBy("idx").collect()
    assert [(r["neg"], r["term"]) for r in got] == want
    assert distribute.first_ranked(df, [F.col("neg")], 5000).count() == 3000


@pytest.mark.parametrize("rows", [30_000, 300_000, 1_500_000])
def test_hot_keys_at_every_total(spark, rows):
    """A key with half of the rows, one with just the wanted number, and many small ones: the threshold is that of a
    task, whatever the total."""
    facts = spark.range(rows).select(F.when(F.col("id") % 2 == 0, F.lit("half")).when(F.col("id") < 4800, F.lit("edge"))
                                     .otherwise(F.concat(F.lit("k"), F.col("id") % 5003)).alias("term"))
    hot = {r["term"]: r["_salts"] for r in distribute.hot_keys(facts, ["term"], 2000).collect()}
    assert set(hot) == {"half", "edge"}
    assert abs(hot["half"] - rows / 2 / 2000) <= 0.2 * rows / 2 / 2000 + 1 and hot["edge"] in (1, 2)


# --- forests ----------------------------------------------------------------------------

@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(240, 8))
    y = (x[:, 0] + x[:, 1] > 0).astype(int) + (x[:, 2] > 0.8)
    rows = [(i, v.tolist(), float(c), i % 3) for i, (v, c) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "row_id long, x array<double>, label_idx double, fold int")
    return materialize(df).withColumn("features", array_to_vector("x"))


def test_prefixes_of_a_forest(spark, vectors):
    model = models.forest(12, 5, 1, 7).fit(vectors)
    nodes = models.node_table(model)
    sizes = (3, 7, 12)
    got = forests.score_prefixes(vectors, nodes, 3, "x", sizes, nodes_per_pass=60).orderBy("row_id").collect()
    for i, s in enumerate(sizes):
        alone = forests.score_forest(vectors, nodes.filter(F.col("tree_id") < s), ["0", "1", "2"], "x").orderBy("row_id").collect()
        assert [str(r["predictions"][i]) for r in got] == [r["prediction"] for r in alone]
    whole = model.transform(vectors).orderBy("row_id").collect()
    assert [r["predictions"][2] for r in got] == [int(r["prediction"]) for r in whole]
    assert models.prefix_accuracies(vectors, nodes, sizes)[2] == pytest.approx(models.accuracy(model, vectors))


def test_trees_cut_at_a_depth(spark, vectors):
    nodes = models.node_table(models.forest(5, 6, 1, 7).fit(vectors))
    held = {(r["tree_id"], r["node_id"]): r for r in nodes.collect()}
    got = forests.score_prefixes(vectors, nodes, 3, "x", (2, 5), (0, 2, 9)).collect()

    def vote(x, size, depth):
        total = np.zeros(3)
        for t in range(size):
            at, level = 0, 0
            while held[t, at]["left"] >= 0 and level < depth:
                n = held[t, at]
                at, level = (n["left"] if x[n["feature"]] <= n["threshold"] else n["right"]), level + 1
            v = np.array(held[t, at]["value"])
            total += v / v.sum()
        return int(np.round(total, 12).argmax())
    for r in got[::11]:
        assert r["predictions"] == [vote(r["x"], s, d) for d in (0, 2, 9) for s in (2, 5)]


def test_rows_keep_their_node(spark, vectors):
    """Trees are not walked from the root at every step of a fit; the forest is that of a fit that does so."""
    learner = models.forest(4, 6, 1, 3)
    assert learner.getCacheNodeIds()
    trees = [learner.copy({learner.cacheNodeIds: kept}).fit(vectors).toDebugString.split("\n")[1:] for kept in (True, False)]
    assert trees[0] == trees[1]


def test_grid_from_few_fits(spark, vectors):
    fits = []
    learner = models.forest

    def counted(*args, **kwargs):
        fits.append(args)
        return learner(*args, **kwargs)
    models.forest = counted
    try:
        model, table = models.forest_cross_validation(vectors, n_folds=3, trees=(3, 6), depths=(4, 2), min_leaf=(1, 5))
    finally:
        models.forest = learner
    rows = table.orderBy("position").collect()
    assert len(rows) == 8 and len(fits) == 2 * 3 + 1
    assert [(r["depth"], r["min_leaf"], r["trees"]) for r in rows[:3]] == [(4, 1, 3), (4, 1, 6), (4, 5, 3)]
    best = max(rows, key=lambda r: (r["accuracy"], -r["position"]))
    assert model.getNumTrees == best["trees"] and all(0.3 < r["accuracy"] <= 1 for r in rows)


def test_sparse_rows_walk_like_dense_ones(spark):
    rng = np.random.default_rng(6)
    x = rng.poisson(0.3, size=(120, 40)).astype(float) * rng.choice([1.0, -2.0, 0.5], size=(120, 40))
    dense = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(500, [0.0] * 40)], "row_id long, x array<double>")
    long = spark.createDataFrame([(i, j, float(x[i, j])) for i in range(120) for j in range(40) if x[i, j]] + [(0, 10**9, 5.0)],
                                 "row_id long, idx long, value double")
    nodes = []
    for t in range(6):
        f = [int(a) for a in rng.choice(40, 3, replace=False)]
        nodes += [(t, 0, 1, 2, f[0], 0.0, [1.0, 1.0]), (t, 1, -1, -1, -2, -2.0, [3.0, float(t)]), (t, 2, 3, 4, f[1], 0.7, [1.0, 1.0]),
                  (t, 3, -1, -1, -2, -2.0, [1.0, 2.0]), (t, 4, -1, -1, -2, -2.0, [0.0, 2.0])]
    nodes = spark.createDataFrame(nodes, "tree_id int, node_id int, left int, right int, feature int, threshold double, value array<double>")
    want = {r["row_id"]: (r["probability"], r["prediction"]) for r in forests.score_forest(dense, nodes, ["a", "b"], "x").collect()}
    scored = forests.score_sparse(dense.select("row_id"), long, nodes, ["a", "b"], nodes_per_pass=12)
    got = {r["row_id"]: (r["probability"], r["prediction"]) for r in scored.collect()}
    assert got.keys() == want.keys() and len(got) == 121
    assert all(got[i][1] == want[i][1] and got[i][0] == pytest.approx(want[i][0]) for i in want)
    assert "vector" not in optimized(scored).lower()
    stump = nodes.filter("tree_id = 0 AND node_id = 1").withColumn("node_id", F.lit(0))  # a tree that is one leaf asks nothing
    assert {r["prediction"] for r in forests.score_sparse(dense.select("row_id"), long, stump, ["a", "b"]).collect()} == {"a"}


# --- layers and vocabularies ---------------------------------------------------------------

def test_layers_repeat_a_perceptron(spark, vectors):
    model = models.perceptron(8, 3, (5,), 20).fit(vectors)
    layers = models.layer_table(model, vectors)
    got = models.score_layers(vectors, layers, "x", "sigmoid").orderBy("row_id").collect()
    want = model.transform(vectors).orderBy("row_id").collect()
    assert [r["prediction"] for r in got] == [int(r["prediction"]) for r in want]
    assert np.allclose([r["probability"] for r in got], [r["probability"].toArray() for r in want])
    one = models.score_layers(spark.createDataFrame([(None,), ([1.0, -1.0],)], "x array<double>"),
                              spark.createDataFrame([(1, [[1.0, 0.0], [0.0, 1.0]], [0.0, 0.0]), (2, [[1.0, 2.0], [5.0, 0.0]], [0.0, 0.5])],
                                                    "layer int, w array<array<double>>, b array<double>"), "x").collect()
    assert one[0]["prediction"] is None and one[1]["probability"] == pytest.approx([1 / (1 + np.e ** 1.5), 1 - 1 / (1 + np.e ** 1.5)])
    with pytest.raises(ValueError, match="tanh"):
        models.score_layers(vectors, layers, "x", "tanh")


def test_a_smaller_vocabulary_is_a_prefix(spark, survey_rows):
    def layout(size):
        return pooled_layout("row_id", ["text_1", "text_6"], ["rating_2", "rating_4"], ["multi_3"], dict_len=size)
    large = FeaturePipeline(layout(12)).fit(survey_rows)
    features = materialize(large.transform(survey_rows))
    for size in (3, 7, 12, 500):
        cut, width = large.with_vocabulary_of(size, features)
        alone = FeaturePipeline(layout(min(size, 12))).fit(survey_rows)
        assert width == alone.width
        assert sorted(map(tuple, cut.collect())) == sorted(map(tuple, alone.transform(survey_rows).collect()))


def test_sizes_are_cut_inside_the_rows(spark, survey_rows):
    """The sweep brings the features of a row together once; the vectors of every size are those of the cut features."""
    config = pooled_layout("row_id", ["text_1", "text_6"], ["rating_2", "rating_4"], ["multi_3"], dict_len=12)
    model = FeaturePipeline(config).fit(survey_rows)
    features, rows = materialize(model.transform(survey_rows)), survey_rows.select("row_id")
    packed = feats.packed_cells(features, rows)
    for size in (3, 7, 12, 500):
        cut, width = model.with_vocabulary_of(size, features)
        cells, same = model.cells_of(size, F.col("cells"))
        assert same == width
        got, wanted = ({r["row_id"]: r["features"] for r in df.collect()} for df in
                       (feats.cell_vectors(packed, width, cells), feats.sparse_vectors(cut, width, rows)))
        assert got == wanted


# --- approximate neighbours ------------------------------------------------------------------

def test_recall_of_the_approximate_search(spark):
    """On clustered vectors a query sees few references; on the given vectors, which hardly cluster, more."""
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(60, 24)) * 3
    x = centres[rng.integers(0, 60, 3000)] + rng.normal(size=(3000, 24)) * 0.7
    x[:50] = x[0]  # copies
    df = materialize(spark.createDataFrame([(i, v.tolist(), i % 3) for i, v in enumerate(x)], "id long, v array<double>, y int"))
    names = {"query_id": "id", "ref_id": "id", "vec": "v", "label": "y"}
    given = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("v"), F.col("label").alias("y"))
    for rows, setting in ((df, {"tables": 8, "probes": 4, "bucket_rows": 64, "block_rows": 40}), (materialize(given), {"tables": 12, "probes": 8, "bucket_rows": 16})):
        queries = rows.filter("id % 5 = 0")
        want = {r["query_id"]: {n["ref_id"]: n["dist"] for n in r["neighbours"]} for r in neighbours.nearest(queries, rows, 10, **names).collect()}
        got = {r["query_id"]: [(n["ref_id"], n["dist"]) for n in r["neighbours"]]
               for r in neighbours.nearest_approximate(queries, rows, 10, **names, **setting).collect()}
        assert got.keys() == want.keys()
        hits = sum(len({i for i, _ in got[q]} & want[q].keys()) for q in want)
        assert hits >= 0.9 * 10 * len(want)
        for q, found in got.items():
            assert len(found) <= 10 and len({i for i, _ in found}) == len(found) and [d for _, d in found] == sorted(d for _, d in found)
            assert all(d == pytest.approx(want[q][i]) for i, d in found if i in want[q])


def test_an_approximate_search_without_a_hit(spark):
    refs = spark.createDataFrame([(i, [float(i), 0.0], "a") for i in range(8)], "id long, v array<double>, y string")
    far = spark.createDataFrame([(99, [3.0, 0.0])], "id long, v array<double>")
    got = neighbours.nearest_approximate(far, refs, 3, query_id="id", ref_id="id", vec="v", label="y", tables=1, probes=1, bucket_rows=1).collect()
    assert len(got) == 1 and got[0]["neighbours"] is not None


# --- texts are read once ------------------------------------------------------------------

def counted(spark, df, column: str):
    """``df`` whose ``column`` counts how often it is computed."""
    calls = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def through(x):
        calls.add(1)
        return x
    return df.withColumn(column, through.asNondeterministic()(column)), calls


def test_document_layout_reads_texts_once(spark, survey_rows):
    rows, calls = counted(spark, survey_rows, "text_1")
    features, _, model = layouts.document_layout(rows, "row_id", min_df=3, scale=True)
    assert features.count() > 0 and model.scales.count() > 0
    assert calls.value == 90


def test_batch_prediction_reads_texts_once(spark, survey_rows, tmp_path):
    config = pooled_layout("row_id", ["text_1", "text_6"], ["rating_2"], ["multi_3"], dict_len=20)
    rows, calls = counted(spark, survey_rows, "text_1")
    model, _, classes = predict.train_forest(rows, config, "label", str(tmp_path / "m"), trees=3, depth=3)
    assert calls.value == 90
    nodes = spark.read.parquet(str(tmp_path / "m/nodes"))
    assert predict.predict_rows(rows, model, nodes, classes).count() == 90
    assert calls.value == 180


def test_first_seen_words_of_odd_rows(spark):
    """Against a count in plain Python, with ids that repeat or are null; only the cells where a tied word comes first are read."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(40)]
    rows = [(None if i % 9 == 4 else i // 2, " ".join(rng.choices(words, k=rng.randint(0, 9))) if i % 7 else None,
             " ".join(rng.choices(words, k=3))) for i in range(60)]
    n, first = {}, {}
    for key, *cells in rows:
        for ordinal, cell in enumerate(cells):
            for pos, word in enumerate((cell or "").split()):
                n[word] = n.get(word, 0) + 1
                at = (ordinal, key is not None, key or 0, pos)
                first[word] = min(first.get(word, at), at)
    order = sorted(n, key=lambda w: (-n[w], first[w]))
    df = spark.createDataFrame(rows, "id long, x string, y string")
    config = pooled_layout("id", ["x", "y"], [], [], dict_len=20, ties="first")
    for k in (1, 20, 100):
        for given in (df, prepared(df, config)):
            got = tt.first_seen_vocabulary(given, "id", ["x", "y"], k).orderBy("idx").collect()
            assert [(r["n"], first[r["term"]]) for r in got] == [(n[w], first[w]) for w in order[:k]]
            assert all(n[r["term"]] == r["n"] for r in got)
    plain = spark.createDataFrame([(i, "a a a b b", "c") for i in range(50)] + [(50, "d " * 50, "")], "id long, x string, y string")
    held = materialize(prepared(plain, config))
    hidden = held.withColumn("x", F.when(F.col("id").isin(0, 50), F.col("x")))
    got = [[(r["term"], r["n"]) for r in tt.first_seen_vocabulary(d, "id", ["x", "y"], 4).orderBy("idx").collect()] for d in (held, hidden)]
    assert got[0] == got[1] == [("a", 150), ("b", 100), ("d", 50), ("c", 50)]
