"""Neighbours, Bayes, forests, fitted models and their evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.fixed import ENGLISH_STOP, NEIGHBOUR_COUNTS, SHORT_STOP
from ..operators import bayes, forest as forests, metrics, models, neighbours, records, splits, terms as tt
from ..operators.distribute import materialize
from ..plans import layouts, predict, reports
from ..plans.pipeline import FeaturePipeline, pooled_layout
from ..sources import artifacts, survey
from .layouts import COLUMNS, RULES, SQL_DOCUMENTS, SQL_POOLED, SQL_SELECTED, _pooled, responses, selected
from .registry import query, scratch, sql_tokens, table
from .text import two_text_columns

# --- neighbours: 30 % of the vectors look among the other 70 % ----------------------


def vector_split(spark, d):
    return splits.split_shuffled(table(spark, d, "embeddings"), "vec_id", ratios=[0.7], names=("train", "test"))


def _found(spark, d, k):
    e = vector_split(spark, d)
    test, train = e.filter("split = 'test'"), e.filter("split = 'train'")
    found = neighbours.nearest(test, train, k, query_id="vec_id", ref_id="vec_id", vec="embedding", label="label")
    return test.select("vec_id", "label").join(
        found.withColumnRenamed("query_id", "vec_id"), "vec_id")


SQL_NEIGHBOURS = (
    "e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v, row_number() OVER (ORDER BY md5('42:' || vec_id)) "
    "<= floor(0.7e0 * count(*) OVER ()) AS train FROM embeddings), "
    "nb AS (SELECT q.vec_id, q.label AS y, r.vec_id AS ref_id, r.label AS label, list_distance(q.v, r.v) AS dist, "
    "row_number() OVER (PARTITION BY q.vec_id ORDER BY list_distance(q.v, r.v), r.vec_id) AS rk "
    "FROM e q, e r WHERE NOT q.train AND r.train QUALIFY rk <= 30)")


def sql_vote(k: int | str, weights: str) -> str:
    w = "1.0e0" if weights == "uniform" else ("CASE WHEN min(dist) OVER (PARTITION BY vec_id) = 0 "
                                              "THEN CAST(dist = 0 AS DOUBLE) ELSE 1.0e0 / dist END")
    return (f"(SELECT vec_id, y, label AS p FROM (SELECT vec_id, y, label, round(sum(w), 9) AS w FROM "
            f"(SELECT vec_id, y, label, {w} AS w FROM nb WHERE rk <= {k}) GROUP BY ALL) "
            f"QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY w DESC, label) = 1)")


@query(f"WITH {SQL_NEIGHBOURS} SELECT vec_id, CAST(rk AS INTEGER) AS rk, ref_id, round(dist, 6) AS dist, label FROM nb WHERE rk <= 10")
def knn_neighbours(spark, d):
    found = _found(spark, d, 10).select("vec_id", F.posexplode("neighbours").alias("pos", "n"))
    return found.select("vec_id", (F.col("pos") + 1).alias("rk"), "n.ref_id", F.round("n.dist", 6).alias("dist"), "n.label")


def _uniform(spark, d):
    return _found(spark, d, 3).select("vec_id", F.col("label").alias("y"), neighbours.vote("neighbours", 3).alias("p"))


@query(f"WITH {SQL_NEIGHBOURS} SELECT * FROM {sql_vote(3, 'uniform')}")
def knn_uniform(spark, d):
    return _uniform(spark, d)


@query(f"WITH {SQL_NEIGHBOURS} SELECT * FROM {sql_vote(5, 'distance')}")
def knn_distance(spark, d):
    return _found(spark, d, 5).select(
        "vec_id", F.col("label").alias("y"), neighbours.vote("neighbours", 5, "distance").alias("p"))


def _sql_sweep() -> str:
    return " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS position, CAST({k} AS INTEGER) AS k, round(avg(CAST(y = p AS DOUBLE)), 6) AS accuracy "
        f"FROM {sql_vote(k, 'distance')}" for i, k in enumerate(NEIGHBOUR_COUNTS))


def _sweep(spark, d):
    found = _found(spark, d, max(NEIGHBOUR_COUNTS))
    return neighbours.k_sweep(found, "label", NEIGHBOUR_COUNTS).withColumn("accuracy", F.round("accuracy", 6))


@query(f"WITH {SQL_NEIGHBOURS} {_sql_sweep()}")
def knn_k_sweep(spark, d):
    return _sweep(spark, d)


@query(f"WITH {SQL_NEIGHBOURS}, sweep AS ({_sql_sweep()}) SELECT * FROM sweep ORDER BY accuracy DESC, position LIMIT 1")
def best_setting(spark, d):
    return metrics.best_setting(_sweep(spark, d), "accuracy", "position")


_BALLOTS = " UNION ALL ".join(f"SELECT vec_id, {k} AS k, p FROM {sql_vote(k, 'distance')}" for k in range(1, 6))


@query(f"WITH {SQL_NEIGHBOURS}, b AS ({_BALLOTS}), c AS (SELECT vec_id, bag, p, count(*) AS n FROM b, "
       "(SELECT CAST(unnest(range(1, 6)) AS INTEGER) AS bag) WHERE k <= bag GROUP BY ALL) "
       "SELECT vec_id, bag, p FROM c QUALIFY row_number() OVER (PARTITION BY vec_id, bag ORDER BY n DESC, p) = 1")
def knn_committee(spark, d):
    found = _found(spark, d, 5)
    bags = F.array(*[F.struct(F.lit(b).alias("bag"), neighbours.committee("neighbours", b, range(10)).alias("p"))
                     for b in range(1, 6)])
    return found.select("vec_id", F.inline(bags))


def _sql_standard(name: str, fitted_on: str) -> str:
    return (f"m{name} AS (SELECT i, avg(v) AS m, stddev_pop(v) AS s FROM x WHERE {fitted_on} GROUP BY i), "
            f"z{name} AS (SELECT vec_id, label, split, list((v - m) / CASE WHEN s > 0 THEN s ELSE 1 END ORDER BY i) AS z "
            f"FROM x JOIN m{name} USING (i) GROUP BY vec_id, label, split)")


def _sql_near(name: str, z: str, queries: str, refs: str) -> str:
    return (f"{name} AS (SELECT q.vec_id, q.label AS y, r.vec_id AS ref_id, r.label AS label, list_distance(q.z, r.z) AS dist, "
            f"row_number() OVER (PARTITION BY q.vec_id ORDER BY list_distance(q.z, r.z), r.vec_id) AS rk "
            f"FROM {z} q, {z} r WHERE q.{queries} AND r.{refs} QUALIFY rk <= 30)")


@query("WITH e AS (SELECT vec_id, label, embedding, row_number() OVER (ORDER BY md5('42:' || vec_id)) AS rn, count(*) OVER () AS n "
       "FROM embeddings), x AS (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS v, generate_subscripts(embedding, 1) AS i, "
       "CASE WHEN rn <= floor(n * 0.7e0) THEN 'train' WHEN rn <= floor(n * 0.7e0) + floor(n * 0.15e0) THEN 'val' ELSE 'test' END AS split "
       f"FROM e), {_sql_standard('1', 'split = ' + repr('train'))}, {_sql_near('nb', 'z1', 'split = ' + repr('val'), 'split = ' + repr('train'))}, "
       f"sweep AS ({_sql_sweep()}), best AS (SELECT k, accuracy FROM sweep ORDER BY accuracy DESC, position LIMIT 1), "
       f"{_sql_standard('2', 'split <> ' + repr('test'))}, {_sql_near('nb2', 'z2', 'split = ' + repr('test'), 'split <> ' + repr('test'))} "
       "SELECT k, accuracy AS val_accuracy, (SELECT round(avg(CAST(y = p AS DOUBLE)), 6) FROM "
       + sql_vote("(SELECT k FROM best)", "distance").replace("FROM nb", "FROM nb2") + ") AS test_accuracy FROM best")
def knn_tuned(spark, d):
    """The line of the tuning report for neighbours: best k on the validation rows, scored on the test rows."""
    k, val, voted = reports.tuned_neighbours(_vectors(spark, d), "vec_id", "embedding", "label")
    return metrics.accuracy(voted, "y", "p").select(F.lit(k).alias("k"), F.round(F.lit(val), 6).alias("val_accuracy"),
                                                    F.round("accuracy", 6).alias("test_accuracy"))


# --- evaluation of the three-neighbour vote -----------------------------------------------

_P = f"{SQL_NEIGHBOURS}, pr AS (SELECT CAST(y AS VARCHAR) AS y, CAST(p AS VARCHAR) AS p FROM {sql_vote(3, 'uniform')})"
_SCORES = (f"{_P}, cl AS (SELECT y AS c FROM pr UNION SELECT p FROM pr), "
           "sc AS (SELECT c, count(*) FILTER (y = c AND p = c) AS hit, count(*) FILTER (y = c) AS support, "
           "count(*) FILTER (p = c) AS predicted FROM cl, pr GROUP BY c), "
           "f AS (SELECT c, support, hit, CASE WHEN predicted = 0 THEN 0.0e0 ELSE hit * 1.0e0 / predicted END AS precision, "
           "CASE WHEN support = 0 THEN 0.0e0 ELSE hit * 1.0e0 / support END AS recall, "
           "2.0e0 * hit / (support + predicted) AS f1 FROM sc)")


@query(f"WITH {_P} SELECT round(avg(CAST(y = p AS DOUBLE)), 6) AS accuracy FROM pr")
def metric_accuracy(spark, d):
    return metrics.accuracy(_uniform(spark, d), "y", "p").select(F.round("accuracy", 6).alias("accuracy"))


@query(f"WITH {_SCORES} SELECT round(avg(f1), 6) AS macro_f1 FROM f")
def metric_macro_f1(spark, d):
    return metrics.macro_f1(_uniform(spark, d), "y", "p").select(F.round("macro_f1", 6).alias("macro_f1"))


@query(f"WITH {_SCORES} SELECT round(sum(f1 * support) / sum(support), 6) AS weighted_f1 FROM f")
def metric_weighted_f1(spark, d):
    return metrics.weighted_f1(_uniform(spark, d), "y", "p").select(F.round("weighted_f1", 6).alias("weighted_f1"))


_NAMES = ("precision", "recall", "f1")


@query(f"WITH {_SCORES} SELECT c AS class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, "
       "support FROM f UNION ALL SELECT 'accuracy', round(sum(hit) / sum(support), 6), round(sum(hit) / sum(support), 6), "
       "round(sum(hit) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM f UNION ALL "
       "SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM f "
       "UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), "
       "round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6), "
       "CAST(sum(support) AS BIGINT) FROM f")
def classification_report(spark, d):
    report = metrics.classification_report(_uniform(spark, d), "y", "p")
    return report.select("class", *[F.round(c, 6).alias(c) for c in _NAMES], "support")


@query(f"WITH {_P}, cl AS (SELECT y AS c FROM pr UNION SELECT p FROM pr) SELECT a.c AS y, b.c AS p, "
       "count(pr.y) AS n FROM cl a CROSS JOIN cl b LEFT JOIN pr ON pr.y = a.c AND pr.p = b.c GROUP BY a.c, b.c")
def confusion_matrix(spark, d):
    return metrics.confusion_matrix(_uniform(spark, d), "y", "p")


@query(f"WITH {_P} SELECT y, p, count(*) AS n FROM pr WHERE y <> p GROUP BY y, p ORDER BY n DESC, y, p LIMIT 10")
def error_pairs(spark, d):
    return metrics.error_pairs(_uniform(spark, d), "y", "p")


@query(f"WITH {_P}, w AS (SELECT y, p, count(*) AS n FROM pr WHERE y <> p GROUP BY y, p "
       "QUALIFY row_number() OVER (PARTITION BY y ORDER BY count(*) DESC, p) = 1) "
       "SELECT y, p, CAST(n AS DOUBLE) AS n FROM (SELECT DISTINCT y FROM pr) LEFT JOIN w USING (y)")
def error_usual(spark, d):
    usual = metrics.usual_confusion(_uniform(spark, d), "y", "p")
    return usual.withColumn("n", F.col("n").cast("double"))


# --- multinomial Bayes on word counts -----------------------------------------------------

def _word_features(spark, d):
    rows = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id")
    terms = tt.term_table(rows, "doc_id", ["text"], stop=SHORT_STOP, keep=["quality"])
    vocabulary = tt.document_vocabulary(tt.count_terms(terms), 2)
    features = tt.term_weights(terms, vocabulary.drop("doc_freq"), tf="raw")
    return features, rows.select(F.col("doc_id").alias("row_id"), "quality"), vocabulary.count()


_SQL_BAYES = (
    "w AS (SELECT doc_id, quality, unnest(" + sql_tokens("text", SHORT_STOP) + ") AS term FROM documents JOIN labels USING (doc_id)), "
    "v AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS idx FROM w GROUP BY term HAVING count(DISTINCT doc_id) >= 2), "
    "tf AS (SELECT doc_id, quality, idx, count(*) AS tf FROM w JOIN v USING (term) GROUP BY ALL), "
    "cls AS (SELECT quality, ln(count(*) * 1.0e0 / (SELECT count(*) FROM labels JOIN documents USING (doc_id))) AS prior "
    "FROM labels JOIN documents USING (doc_id) GROUP BY quality), "
    "o AS (SELECT quality, idx, sum(tf) AS o FROM tf GROUP BY ALL), "
    "mass AS (SELECT quality, sum(o) + 0.5e0 * (SELECT count(*) FROM v) AS m FROM o GROUP BY quality), "
    "lp AS (SELECT cls.quality, idx, ln((coalesce(o, 0) + 0.5e0) / m) AS lp FROM cls CROSS JOIN v "
    "LEFT JOIN o USING (quality, idx) JOIN mass ON mass.quality = cls.quality)")


def _fitted(spark, d):
    features, rows, width = _word_features(spark, d)
    sizes = {str(r["quality"]): r["count"] for r in rows.groupBy("quality").count().collect()}
    return features, rows, bayes.fit_bayes(features, "quality", sizes, width)


@query(f"WITH {_SQL_BAYES} SELECT CAST(quality AS VARCHAR) AS class, idx, round(lp, 6) AS log_prob FROM lp")
def nb_fit(spark, d):
    _, _, model = _fitted(spark, d)
    return model.parameters().withColumn("log_prob", F.round("log_prob", 6))


@query(f"WITH {_SQL_BAYES} SELECT CAST(quality AS VARCHAR) AS class, round(prior, 6) AS log_prior FROM cls")
def nb_priors(spark, d):
    _, _, model = _fitted(spark, d)
    return model.priors().withColumn("log_prior", F.round("log_prior", 6))


@query(f"WITH {_SQL_BAYES}, sc AS (SELECT doc_id, lp.quality, sum(tf * lp) AS s FROM tf JOIN lp USING (idx) GROUP BY ALL), "
       "al AS (SELECT l.doc_id, cls.quality, round(prior + coalesce(s, 0), 6) AS s FROM labels l JOIN documents USING (doc_id) "
       "CROSS JOIN cls LEFT JOIN sc ON sc.doc_id = l.doc_id AND sc.quality = cls.quality) "
       "SELECT doc_id, CAST(arg_min(quality, (-s, quality)) AS VARCHAR) AS prediction, max(s) AS score FROM al GROUP BY doc_id")
def nb_predict(spark, d):
    features, rows, model = _fitted(spark, d)
    scored = bayes.score_bayes(features, rows, model)
    return scored.select(F.col("row_id").alias("doc_id"), "prediction", F.round(F.array_max("scores"), 6).alias("score"))


@query(f"WITH {SQL_SELECTED}, fold AS (SELECT doc_id, label, CASE WHEN rn <= (n // 5 + 1) * (n % 5) THEN (rn - 1) // (n // 5 + 1) "
       "ELSE n % 5 + (rn - 1 - (n // 5 + 1) * (n % 5)) // (n // 5) END AS f FROM (SELECT doc_id, label, "
       "row_number() OVER (ORDER BY md5('42:' || doc_id)) AS rn, count(*) OVER () AS n FROM l)), "
       "cl AS (SELECT DISTINCT label AS c FROM l), fs AS (SELECT unnest(range(0, 5)) AS f), "
       "nk AS (SELECT least(420, (SELECT nv FROM n) + 26) AS w), "
       "pri AS (SELECT fs.f, c, ln(count(*) FILTER (fold.label = c) * 1.0e0 / count(*)) AS prior FROM fs, cl, fold "
       "WHERE fold.f <> fs.f GROUP BY fs.f, c), "
       "o AS (SELECT fs.f, m.label AS c, idx, sum(value) AS o FROM fs, masked m JOIN fold USING (doc_id) WHERE fold.f <> fs.f GROUP BY ALL), "
       "mass AS (SELECT f, c, sum(o) + 0.5e0 * (SELECT w FROM nk) AS m FROM o GROUP BY f, c), "
       "ix AS (SELECT DISTINCT idx FROM masked), "
       "lp AS (SELECT f, c, idx, ln((coalesce(o, 0) + 0.5e0) / m) AS lp FROM mass CROSS JOIN ix LEFT JOIN o USING (f, c, idx)), "
       "sc AS (SELECT doc_id, c, sum(value * lp) AS s FROM masked JOIN fold USING (doc_id) JOIN lp ON lp.f = fold.f AND lp.idx = masked.idx GROUP BY ALL), "
       "al AS (SELECT fold.doc_id, fold.f, fold.label AS y, pri.c, round(prior + coalesce(s, 0), 9) AS s FROM fold JOIN pri ON pri.f = fold.f "
       "LEFT JOIN sc ON sc.doc_id = fold.doc_id AND sc.c = pri.c), "
       "pr AS (SELECT f, y, c AS p FROM al QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY s DESC, c) = 1), "
       "cs AS (SELECT f, c, count(*) FILTER (y = c AND p = c) AS hit, count(*) FILTER (y = c) + count(*) FILTER (p = c) AS den "
       "FROM pr, cl GROUP BY f, c), "
       "ff AS (SELECT f, avg(2.0e0 * hit / den) AS f1 FROM cs WHERE den > 0 GROUP BY f), "
       "fa AS (SELECT f, avg(CAST(y = p AS DOUBLE)) AS acc FROM pr GROUP BY f) "
       "SELECT round(avg(f1), 6) AS f1_mean, round(stddev_pop(f1) * 2, 6) AS f1_spread, round(avg(acc), 6) AS accuracy "
       "FROM ff JOIN fa USING (f)")
def nb_cv(spark, d):
    """Five shuffled folds on features that were selected on all rows."""
    features, rows, model = selected(spark, d)
    folds = materialize(splits.kfold(rows, "row_id"))
    inside = features.join(folds.select("row_id", "fold"), "row_id")
    predicted = bayes.cross_predict(inside, folds, "label", "fold", 5, model.n_kept)
    scores = bayes.cross_scores(predicted, "label", "fold")
    return scores.select(*[F.round(c, 6).alias(c) for c in ("f1_mean", "f1_spread", "accuracy")])


@query(f"WITH {_SQL_BAYES} SELECT CAST(quality AS VARCHAR) AS class, idx, round(lp, 6) AS log_prob FROM lp")
def nb_saved(spark, d):
    """Parameter tables written and read back."""
    _, _, model = _fitted(spark, d)
    path = scratch(spark)
    artifacts.save_table(model.table, f"{path}/table")
    back = bayes.BayesModel(model.classes, model.log_prior, model.unseen, artifacts.load_table(spark, f"{path}/table"))
    return back.parameters().withColumn("log_prob", F.round("log_prob", 6))


# --- forests -----------------------------------------------------------------------------

FOREST_CLASSES = ("a", "b", "c")


def forest_rows(n_trees: int = 7, n_features: int = 64, step: int = 5) -> list[tuple]:
    """Trees of depth two by rule: node tables as an exporter would write them."""
    rows = []
    for t in range(n_trees):
        f = step * t
        def leaf(i, t=t):
            w = [0.0, 0.0, 0.0]
            w[(t + i) % 3] = 3.0
            w[(t + i + 1) % 3] += 1.0
            return w
        rows += [(t, 0, 1, 4, f % n_features, 0.0, [4.0, 4.0, 4.0]),
                 (t, 1, 2, 3, (f + 1) % n_features, -0.05, [2.0, 2.0, 2.0]),
                 (t, 2, -1, -1, -2, -2.0, leaf(0)), (t, 3, -1, -1, -2, -2.0, leaf(1)),
                 (t, 4, 5, 6, (f + 2) % n_features, 0.05, [2.0, 2.0, 2.0]),
                 (t, 5, -1, -1, -2, -2.0, leaf(2)), (t, 6, -1, -1, -2, -2.0, leaf(3))]
    return rows


def _sql_share(c: int, rows: list[tuple] | None = None, name=lambda f: f"v[{f + 1}]") -> str:
    nodes = {(r[0], r[1]): r for r in rows or forest_rows()}

    def walk(t, i):
        _, _, left, right, f, thr, value = nodes[t, i]
        if left < 0:
            return f"{value[c] / sum(value)}e0"
        return f"CASE WHEN {name(f)} <= {thr}e0 THEN {walk(t, left)} ELSE {walk(t, right)} END"
    n = len({t for t, _ in nodes})
    return "(" + " + ".join(walk(t, 0) for t in range(n)) + f") / {n}.0e0"


@query("WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings), "
       f"s AS (SELECT vec_id, {_sql_share(0)} AS a, {_sql_share(1)} AS b, {_sql_share(2)} AS c FROM e) "
       "SELECT vec_id, round(a, 6) AS a, round(b, 6) AS b, round(c, 6) AS c, "
       "CASE WHEN a >= b AND a >= c THEN 'a' WHEN b >= c THEN 'b' ELSE 'c' END AS prediction FROM s")
def forest_score(spark, d):
    """An exported forest, written as JSON, imported and applied."""
    nodes = spark.createDataFrame(forest_rows(), "tree_id int, node_id int, left int, right int, feature int, "
                                  "threshold double, value array<double>")
    path = scratch(spark)
    forests.write_forest_json(nodes, path)
    scored = forests.score_forest(table(spark, d, "embeddings"), forests.nodes_of_json(spark, path),
                                  FOREST_CLASSES, "embedding")
    return scored.select("vec_id", *[F.round(F.get("probability", F.lit(i)), 6).alias(c)
                                     for i, c in enumerate(FOREST_CLASSES)], "prediction")


_WIDE_FOREST = forest_rows(11, 218, 23)
_ASKED = sorted({r[4] for r in _WIDE_FOREST if r[2] >= 0})


@query(f"WITH {SQL_POOLED}, w AS (SELECT s.doc_id, " + ", ".join(
       f"coalesce(max(value) FILTER (idx = {f}), 0) AS f{f}" for f in _ASKED) + " FROM s LEFT JOIN feats USING (doc_id) GROUP BY s.doc_id), "
       "p AS (SELECT doc_id, " + ", ".join(f"{_sql_share(c, _WIDE_FOREST, lambda f: f'f{f}')} AS {n}" for c, n in enumerate("abc")) + " FROM w) "
       "SELECT doc_id, round(a, 6) AS a, round(b, 6) AS b, round(c, 6) AS c, "
       "CASE WHEN a >= b AND a >= c THEN 'a' WHEN b >= c THEN 'b' ELSE 'c' END AS prediction FROM p")
def forest_score_sparse(spark, d):
    """A given forest walked over the sparse features of the pooled layout, as batch prediction does."""
    rows, model = _pooled(spark, d)
    nodes = spark.createDataFrame(_WIDE_FOREST, "tree_id int, node_id int, left int, right int, feature int, "
                                  "threshold double, value array<double>")
    scored = forests.score_sparse(rows.select(F.col("doc_id").alias("row_id")), model.transform(rows), nodes, FOREST_CLASSES)
    return scored.select(F.col("row_id").alias("doc_id"), *[F.round(F.get("probability", F.lit(i)), 6).alias(c)
                                                            for i, c in enumerate(FOREST_CLASSES)], "prediction")


# --- saved layers -------------------------------------------------------------------------

def layer_rows(sizes: tuple[int, ...] = (64, 6, 3)) -> list[tuple]:
    """Weights by rule, a row per input: layers as they are saved."""
    return [(n + 1, [[((7 * i + 3 * j + n) % 11 - 5) / 10 for j in range(b)] for i in range(a)], [((5 * j + n) % 7 - 3) / 20 for j in range(b)])
            for n, (a, b) in enumerate(zip(sizes, sizes[1:]))]


def _sql_layer(row: tuple, inputs: str) -> list[str]:
    _, w, b = row
    return [f"list_dot_product({inputs}, [{', '.join(f'{r[j]}e0' for r in w)}]) + {b[j]}e0" for j in range(len(b))]


@query("WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings), h AS (SELECT vec_id, ["
       + ", ".join(f"greatest({u}, 0)" for u in _sql_layer(layer_rows()[0], "v")) + "] AS h FROM e), o AS (SELECT vec_id, "
       + ", ".join(f"{u} AS o{i}" for i, u in enumerate(_sql_layer(layer_rows()[1], "h"))) + " FROM h) "
       "SELECT vec_id, " + ", ".join(f"round(exp(o{i}) / (exp(o0) + exp(o1) + exp(o2)), 6) AS p{i}" for i in range(3))
       + ", CASE WHEN o0 >= o1 AND o0 >= o2 THEN 0 WHEN o1 >= o2 THEN 1 ELSE 2 END AS prediction FROM o")
def mlp_score(spark, d):
    """Saved layers, read back and applied with rectified units."""
    path = scratch(spark)
    artifacts.save_table(spark.createDataFrame(layer_rows(), "layer int, w array<array<double>>, b array<double>"), path)
    scored = models.score_layers(table(spark, d, "embeddings"), artifacts.load_table(spark, path), "embedding", "relu")
    return scored.select("vec_id", *[F.round(F.get("probability", F.lit(i)), 6).alias(f"p{i}") for i in range(3)], "prediction")


# --- fitted models ------------------------------------------------------------------------

DIGITS = [str(i) for i in range(10)]


def _vectors(spark, d, ratios=(0.7, 0.15)):
    return splits.split_shuffled(table(spark, d, "embeddings"), "vec_id", ratios=ratios)


def _parts(spark, d):
    data = reports.ml_rows(_vectors(spark, d), "embedding", "label", DIGITS, ["vec_id", "split"]).persist()
    return [data.filter(F.col("split") == s) for s in splits.SPLITS]


@query("WITH e AS (SELECT vec_id, label, embedding, row_number() OVER (ORDER BY md5('42:' || vec_id)) AS rn, count(*) OVER () AS n "
       "FROM embeddings), x AS (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS v, generate_subscripts(embedding, 1) AS i, "
       "CASE WHEN rn <= floor(n * 0.7e0) THEN 'train' WHEN rn <= floor(n * 0.7e0) + floor(n * 0.15e0) THEN 'val' ELSE 'test' END AS split FROM e), "
       "eps AS (SELECT max(s) * 1e-9 AS eps FROM (SELECT var_pop(v) AS s FROM x WHERE split = 'train' GROUP BY i)), "
       "st AS (SELECT label AS c, i, avg(v) AS m, var_pop(v) + any_value(eps) AS s FROM x, eps WHERE split = 'train' GROUP BY label, i), "
       "pr AS (SELECT label AS c, ln(count(*) * 1.0e0 / (SELECT count(*) FROM x WHERE i = 1 AND split = 'train')) AS p "
       "FROM x WHERE i = 1 AND split = 'train' GROUP BY label), "
       "sc AS (SELECT vec_id, c, sum(-0.5e0 * ln(2 * pi() * s) - (v - m) ** 2 / (2 * s)) AS s FROM x JOIN st USING (i) "
       "WHERE split = 'val' GROUP BY vec_id, c) "
       "SELECT vec_id, CAST(c AS DOUBLE) AS prediction FROM sc JOIN pr USING (c) "
       "QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY round(s + p, 9) DESC, c) = 1")
def gnb(spark, d):
    train, val, _ = _parts(spark, d)
    return models.gaussian_bayes().fit(train).transform(val).select("vec_id", "prediction")


@query()
def rf_fit_predict(spark, d):
    train, val, _ = _parts(spark, d)
    return models.forest(150, 10, 2).fit(train).transform(val).select("vec_id", "prediction")


@query()
def rf_node_table(spark, d):
    """Node table of a fitted forest, as exported for scoring."""
    train, _, _ = _parts(spark, d)
    path = scratch(spark)
    models.forest(20, 5, 2).fit(train).write().overwrite().save(path)
    nodes = forests.nodes_of_model(spark, path)
    return nodes.select("tree_id", "node_id", "left", "right", "feature", "threshold",
                        F.array_join(F.col("value").cast("array<string>"), " ").alias("value"))


@query()
def logreg_sweep(spark, d):
    train, val, _ = _parts(spark, d)
    return models.ridge_sweep(train, val)


@query()
def mlp_fit(spark, d):
    train, val, _ = _parts(spark, d)
    return models.perceptron(64, 10, (64,)).fit(train).transform(val).select("vec_id", "prediction")


@query()
def mlp_weights(spark, d):
    """Weights of a perceptron, written and read again. Five iterations give weights as well as two hundred do."""
    train, _, _ = _parts(spark, d)
    path = scratch(spark)
    artifacts.save_table(models.layer_table(models.perceptron(64, 10, (64,), 5).fit(train), train), path)
    layers = artifacts.load_table(spark, path)
    return layers.select("layer", F.size("w").alias("n_in"), F.size("b").alias("n_out"),
                         F.aggregate(F.flatten("w"), F.lit(0.0), lambda a, x: a + x).alias("w_sum"),
                         F.aggregate("b", F.lit(0.0), lambda a, x: a + x).alias("b_sum"))


@query()
def mlp_curve(spark, d):
    train, val, _ = _parts(spark, d)
    return models.learning_curve(train, val, 64, 10)


@query()
def rf_grid(spark, d):
    """All five sizes at all four depths."""
    train, val, _ = _parts(spark, d)
    return models.forest_sweep(train, val)


@query()
def rf_cv(spark, d):
    """All hundred settings, from twenty forests (the study's two minimum sizes for a split have no counterpart in Spark)."""
    folds = splits.kfold_stratified(table(spark, d, "embeddings"), "vec_id", "label")
    data = reports.ml_rows(folds, "embedding", "label", DIGITS, ["fold"]).persist()
    return models.forest_cross_validation(data)[1]


@query()
def rf_tuned(spark, d):
    """Grid search over all hundred settings on the training rows, scored on the validation rows."""
    vectors = _vectors(spark, d)
    train = splits.kfold_stratified(vectors.filter("split = 'train'"), "vec_id", "label")
    score, setting, val = reports.tuned_forest(
        reports.ml_rows(train, "embedding", "label", DIGITS, ["fold"]).persist(),
        reports.ml_rows(vectors.filter("split = 'val'"), "embedding", "label", DIGITS), DIGITS)
    row = (float(score), setting["trees"], setting["depth"], setting["min_leaf"],
           float(val["accuracy"]), float(val["f1_macro"]), float(val["f1_weighted"]))
    return spark.createDataFrame([row], "cv_accuracy double, trees int, depth int, min_leaf int, "
                                 "val_accuracy double, val_f1_macro double, val_f1_weighted double")


@query()
def knn_approximate(spark, d):
    """Ten neighbours by random-projection tables; the tests measure the recall."""
    e = vector_split(spark, d)
    found = neighbours.nearest_approximate(e.filter("split = 'test'"), e.filter("split = 'train'"), 10, query_id="vec_id", ref_id="vec_id",
                                           vec="embedding", label="label")
    return found.select(F.col("query_id").alias("vec_id"), neighbours.vote("neighbours", 5).alias("p"),
                        F.transform("neighbours", lambda n: n["ref_id"]).alias("found"))


@query()
def rf_errors(spark, d):
    """Most frequent mistakes of the forest on the test rows."""
    train, _, test = _parts(spark, d)
    return reports.forest_errors(train, test, DIGITS)[1]


@query()
def model_compare(spark, d):
    return reports.compare_defaults(_vectors(spark, d), "vec_id", "embedding", "label", DIGITS)


def _report(spark, d):
    """Two of six strengths, smaller forests of two sizes and one depth, all neighbour counts: ``logreg_sweep`` has all
    strengths, ``rf_grid`` all sizes, ``knn_tuned`` the line of the neighbours."""
    return reports.full_report(_vectors(spark, d), "vec_id", "embedding", "label", DIGITS,
                               strengths=(0.1, 1.0), sizes=(10, 20), depths=(5,))


@query()
def tune_report(spark, d):
    return _report(spark, d).summary


@query()
def tune_report_best(spark, d):
    """Classification report of the best model on the test rows."""
    return _report(spark, d).classes()


@query()
def vocab_size_sweep(spark, d):
    """All seven sizes, with one small setting of the grid each; the features are built once."""
    rows = records.drop_unlabelled(responses(spark, d))
    plan = FeaturePipeline(pooled_layout("doc_id", *COLUMNS, **RULES))
    return reports.vocabulary_size_sweep(rows, plan, "label", ["0", "1"], trees=(10,), depths=(5,), min_leaf=(1,))


@query()
def predict_all(spark, d):
    """Train on the labelled responses (a forest of 20 trees), save, then score a file of all responses."""
    rows = responses(spark, d)
    path = scratch(spark)
    config = pooled_layout("doc_id", *COLUMNS, **RULES)
    predict.train_forest(rows, config, "label", f"{path}/model", trees=20, depth=8)
    survey.write_survey(rows.drop("label"), f"{path}/in")
    return predict.predict_all(spark, f"{path}/in", f"{path}/model", multiline=True)


# --- saved state ---------------------------------------------------------------------------

@query("WITH w AS (SELECT unnest(" + sql_tokens("text") + ") AS term FROM "
       "(SELECT text FROM documents UNION ALL SELECT text FROM conversations)) "
       "SELECT term, row_number() OVER (ORDER BY count(*) DESC, term) - 1 AS idx FROM w GROUP BY term QUALIFY idx < 100")
def vocabulary_json_round_trip(spark, d):
    vocabulary = tt.pooled_vocabulary(two_text_columns(spark, d), ["a", "b"], 100)
    path = scratch(spark)
    artifacts.vocabulary_to_json(vocabulary, path)
    return artifacts.vocabulary_of_json(spark, path)


_SIZES_BY_LABEL = (
    "lab AS (SELECT doc_id, label, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || doc_id)) AS rn FROM docs), "
    "cnt AS (SELECT label, count(*) AS n, CAST(count(*) AS DOUBLE) * (t - ceil(round(t * 0.2e0, 9))) / t AS e, "
    "CAST(t - ceil(round(t * 0.2e0, 9)) AS BIGINT) AS n_train FROM docs, (SELECT count(*) AS t FROM docs) GROUP BY label, t), "
    "siz AS (SELECT label, n, CAST(floor(e) AS BIGINT) + CASE WHEN row_number() OVER "
    "(ORDER BY round(e - floor(e), 9) DESC, label) <= n_train - sum(CAST(floor(e) AS BIGINT)) OVER () THEN 1 ELSE 0 END AS n_tr "
    "FROM cnt), "
    "tr AS (SELECT doc_id FROM lab JOIN siz USING (label) WHERE rn > n - n_tr), nt AS (SELECT count(*) AS nt FROM tr), "
    "sc AS (SELECT idx, sum(value) / any_value(nt) AS mean, sqrt(greatest(sum(value * value) / any_value(nt) - "
    "(sum(value) / any_value(nt)) ** 2, 0)) AS sd FROM feats JOIN tr USING (doc_id), nt GROUP BY idx)")


@query(f"WITH {SQL_DOCUMENTS}, {_SIZES_BY_LABEL} SELECT term, idx, n, df AS doc_freq, round(idf, 6) AS idf, "
       "round(mean, 6) AS mean, round(CASE WHEN sd > 1e-9 THEN sd ELSE 1 END, 6) AS scale FROM v LEFT JOIN sc USING (idx)")
def document_layout_saved(spark, d):
    """Scaled one-document layout, saved and loaded: vocabulary with weights and scales."""
    _, _, model = layouts.document_layout(responses(spark, d), "doc_id", scale=True, stop=ENGLISH_STOP)
    path = scratch(spark)
    model.save(path)
    back = layouts.DocumentModel.load(spark, path)
    return (back.vocabulary.join(back.scales.select("idx", "mean", "scale"), "idx", "left")
            .select("term", "idx", "n", "doc_freq", F.round("idf", 6).alias("idf"), F.round("mean", 6).alias("mean"),
                    F.round("scale", 6).alias("scale")))
