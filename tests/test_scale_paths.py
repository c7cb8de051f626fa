"""The paths for large inputs, forced on small ones, against brute force."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from sondage.operators import bayes, features as feats, models, neighbours, splits, terms as tt
from sondage.operators import distribute, vectors
from sondage.operators.distribute import dense_index, hash_cutoffs, hash_order, lookup_join, materialize


def test_dense_index(spark):
    words = [f"w{(i * 7919) % 1000:04d}" for i in range(1000)] + ["é", "Z", "_", "zz"]
    got = dense_index(spark.createDataFrame([(w,) for w in words], "term string").repartition(7), ["term"])
    assert {r["term"]: r["idx"] for r in got.collect()} == {w: i for i, w in enumerate(sorted(words))}


def test_dense_index_within_a_hot_group(spark):
    rows = [("hot" if i % 3 else f"g{i % 9}", f"t{(i * 31) % 500:03d}") for i in range(500)]
    got = dense_index(spark.createDataFrame(rows, "g string, t string").repartition(5), ["t"], within="g")
    want = {}
    for g in {g for g, _ in rows}:
        want |= {(g, t): i for i, t in enumerate(sorted(t for h, t in rows if h == g))}
    assert {(r["g"], r["t"]): r["idx"] for r in got.collect()} == want


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_join_salts_hot_keys(spark, how):
    """A third of all rows share one key; the join is shuffled and salted."""
    facts = spark.range(3000).select(
        F.col("id").alias("row_id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("term"))
    table = facts.filter("term <> 'k7'").groupBy("term").agg(F.count(F.lit(1)).alias("n"), F.first("term").alias("v"))
    table = materialize(table)
    joined = lookup_join(facts, table, ["term"], "row_id", how, limit_bytes=0, rows_per_salt=100)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan
    want = lookup_join(facts, table, ["term"], "row_id", how)
    assert sorted(map(str, joined.select("row_id", "term", "n", "v").collect())) == \
        sorted(map(str, want.select("row_id", "term", "n", "v").collect()))


def test_weights_do_not_depend_on_the_join(spark, monkeypatch):
    docs = spark.createDataFrame([(i, " ".join(["the"] * (i % 4 + 1) + [f"w{i % 7}", f"v{i % 3}"])) for i in range(60)],
                                 "id long, t string")
    terms = tt.term_table(docs, "id", ["t"])
    vocabulary = materialize(tt.add_idf(tt.full_vocabulary(tt.count_terms(terms)), 60))

    def weights():
        got = tt.term_weights(terms, vocabulary, tf="log1p", norm="l2").collect()
        return {(r["row_id"], r["term"]): round(r["value"], 12) for r in got}
    small = weights()
    monkeypatch.setattr(distribute.lookup_join, "__defaults__", ("inner", 0, 10))
    assert weights() == small
    norms = {}
    for (row, _), v in small.items():
        norms[row] = norms.get(row, 0) + v * v
    assert all(abs(n - 1) < 1e-9 for n in norms.values())


def test_hash_cutoffs(spark):
    rows = spark.range(5000).withColumn("g", (F.col("id") % 3 == 0).cast("string")).withColumn("h", hash_order("id", 1))
    got = hash_cutoffs(rows, "h", {"true": [1, 700], "false": [3333]}, by="g")
    pdf = rows.toPandas()
    for (g, r), h in got.items():
        assert sorted(pdf[pdf.g == g]["h"])[r - 1] == h
    assert len(got) == 3


def brute(q, r, ids, k):
    d = np.sqrt(((q[:, None, :] - r[None, :, :]) ** 2).sum(2))
    return [sorted(zip(row, ids))[:k] for row in d]


@pytest.mark.parametrize("limit,block", [(1 << 30, 50), (0, 50), (0, 7), (0, 1000)])
def test_nearest_is_exact(spark, limit, block):
    """Copies (distance ties), a crowded region and single rows; both search ways."""
    rng = np.random.default_rng(5)
    refs = np.vstack([rng.normal(size=(150, 6)), np.repeat(rng.normal(size=(1, 6)), 80, 0),
                      rng.normal(size=(60, 6)) * 0.01 + 5])
    queries = np.vstack([rng.normal(size=(40, 6)), refs[155:160], rng.normal(size=(5, 6)) + 5])
    rdf = spark.createDataFrame([(i * 3, v.tolist(), i % 4) for i, v in enumerate(refs)], "id long, v array<double>, y int")
    qdf = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(queries)], "id long, v array<double>").repartition(3)
    got = neighbours.nearest(qdf, rdf, 9, query_id="id", ref_id="id", vec="v", label="y", limit_bytes=limit,
                             n_pivots=12, block_rows=block).collect()
    want = brute(queries, refs, [i * 3 for i in range(len(refs))], 9)
    assert len(got) == len(queries)
    for row in got:
        found = [(n["dist"], n["ref_id"]) for n in row["neighbours"]]
        assert [i for _, i in found] == [i for _, i in want[row["query_id"]]]
        assert np.allclose([d for d, _ in found], [d for d, _ in want[row["query_id"]]])
        assert all(n["label"] == (n["ref_id"] // 3) % 4 for n in row["neighbours"])


def test_nearest_with_fewer_references_than_k(spark):
    refs = spark.createDataFrame([(1, [0.0, 0.0], "a"), (2, [1.0, 0.0], "b")], "id long, v array<double>, y string")
    for limit in (1 << 30, 0):
        got = neighbours.nearest(refs, refs, 5, query_id="id", ref_id="id", vec="v", label="y", limit_bytes=limit)
        assert {r["query_id"]: [n["ref_id"] for n in r["neighbours"]] for r in got.collect()} == {1: [1, 2], 2: [2, 1]}


def test_votes(spark):
    rows = [(1, [(1, 1.0, "b"), (2, 2.0, "a"), (3, 3.0, "c")]), (2, [(1, 0.0, "c"), (2, 0.5, "a"), (3, 0.6, "a")]),
            (3, [(1, 1.0, "b"), (2, 1.1, "a"), (3, 1.2, "a")])]
    df = spark.createDataFrame(rows, "id int, neighbours array<struct<ref_id:int,dist:double,label:string>>")
    got = df.select("id", neighbours.vote("neighbours", 3).alias("u"), neighbours.vote("neighbours", 3, "distance").alias("d"),
                    neighbours.committee("neighbours", 3, ["c", "b", "a"]).alias("m")).orderBy("id").collect()
    assert [r["u"] for r in got] == ["a", "a", "a"]       # tie of three goes to the smallest label
    assert [r["d"] for r in got] == ["b", "c", "a"]       # a copy decides alone
    assert [r["m"] for r in got] == ["b", "c", "b"]       # ballots k=1,2,3


@pytest.mark.parametrize("n", [10, 97, 300])
def test_split_invariants(spark, n):
    df = spark.range(n).withColumn("g", F.col("id") % 17).withColumn("y", F.when(F.col("id") % 3 == 0, "a").otherwise("b"))
    folds = splits.kfold(df, "id").groupBy("fold").count().toPandas()["count"]
    assert folds.sum() == n and folds.max() - folds.min() <= 1
    strat = splits.kfold_stratified(df, "id", "y").groupBy("fold", "y").count().toPandas()
    per_fold = strat.groupby("fold")["count"].sum()
    assert per_fold.sum() == n and per_fold.max() - per_fold.min() <= 1
    for _, part in strat.groupby("y"):
        assert part["count"].max() - part["count"].min() <= 1
    grouped = splits.split_by_group(df, "g")
    assert grouped.count() == n
    assert grouped.select("g", "split").distinct().count() == grouped.select("g").distinct().count()
    two = splits.split_stratified(df, "id", "y").groupBy("split").count().toPandas().set_index("split")["count"]
    assert two["val"] == -(-n // 5) and two.sum() == n
    at = splits.split_by_position(df, "id", cuts=(5, 8)).orderBy("id").toPandas()["split"].tolist()
    assert at == ["train"] * 5 + ["val"] * 3 + ["test"] * (n - 8)


def test_cuts_past_the_end(spark):
    df = spark.range(20)
    for split in (splits.split_by_position(df, "id"), splits.split_shuffled(df, "id")):
        assert split.groupBy("split").count().collect() == [("train", 20)]
    halves = splits.split_by_position(df, "id", cuts=(0, 30)).select("split").distinct().collect()
    assert [r["split"] for r in halves] == ["val"]


def test_chi2_hand_rows(spark):
    rows = [(0, "0", 0, 1.0), (0, "0", 2, 2.0), (1, "0", 0, 2.0), (1, "0", 2, 1.0), (2, "1", 2, 3.0), (3, "2", 2, 1.0)]
    f = spark.createDataFrame(rows, "row_id long, label string, idx long, value double")
    scores = feats.chi2_scores(f, "label", {"0": 0.5, "1": 0.25, "2": 0.25})
    got = {r["idx"]: round(r["chi2"], 4) for r in scores.collect()}
    assert got == {0: 3.0, 2: 1.2857}
    kept = feats.select_top(scores, 1)
    assert [(r["idx"], r["new_idx"]) for r in kept.collect()] == [(0, 0)]
    assert feats.apply_mask(f, kept).count() == 2


def test_scale_counts_implied_zeros(spark):
    f = spark.createDataFrame([(0, 0, 2.0), (1, 0, 4.0), (0, 1, 3.0), (1, 1, 3.0), (2, 1, 3.0), (3, 1, 3.0)],
                              "row_id long, idx long, value double")
    scales = {r["idx"]: (r["mean"], r["scale"]) for r in feats.fit_scale(f, 4).collect()}
    col = np.array([2.0, 4.0, 0, 0])
    assert scales[0] == pytest.approx((col.mean(), col.std())) and scales[1] == (3.0, 1.0)


def test_bayes_folds_match_separate_fits(spark):
    rng = np.random.default_rng(3)
    x = rng.poisson(0.7, size=(40, 6))
    y = ["a" if i % 3 else "b" for i in range(40)]
    fold = [i % 4 for i in range(40)]
    f = spark.createDataFrame([(i, y[i], fold[i], j, float(x[i, j])) for i in range(40) for j in range(6) if x[i, j]],
                              "row_id long, label string, fold int, idx long, value double")
    rows = spark.createDataFrame([(i, y[i], fold[i]) for i in range(40)], "row_id long, label string, fold int")
    got = {r["row_id"]: r["scores"] for r in bayes.cross_predict(f, rows, "label", "fold", 4, 6).collect()}
    assert len(got) == 40
    for k in range(4):
        inside = [i for i in range(40) if fold[i] != k]
        for c, name in enumerate(("a", "b")):
            counts = x[[i for i in inside if y[i] == name]].sum(0)
            lp = np.log((counts + 0.5) / (counts.sum() + 3.0))
            prior = np.log(sum(y[i] == name for i in inside) / len(inside))
            for i in range(40):
                if fold[i] == k:
                    assert got[i][c] == pytest.approx(prior + (x[i] * lp).sum())


def test_bayes_scores_rows_without_known_features(spark):
    f = spark.createDataFrame([(0, "a", 0, 2.0), (1, "b", 1, 1.0), (2, "b", 1, 1.0)], "row_id long, label string, idx long, value double")
    model = bayes.fit_bayes(f, "label", {"a": 1, "b": 2}, width=3)
    new = spark.createDataFrame([(7, 2, 1.0)], "row_id long, idx long, value double")  # a feature no row had
    rows = spark.createDataFrame([(7,), (8,)], "row_id long")
    got = {r["row_id"]: (r["scores"], r["prediction"]) for r in bayes.score_bayes(new, rows, model).collect()}
    assert got[8][0] == pytest.approx([np.log(1 / 3), np.log(2 / 3)]) and got[8][1] == "b"
    assert got[7][0] == pytest.approx([np.log(1 / 3) + np.log(0.5 / 3.5), np.log(2 / 3) + np.log(0.5 / 3.5)])


@pytest.mark.parametrize("at_once", [1000, 0])
def test_first_ranked(spark, monkeypatch, at_once):
    monkeypatch.setattr(distribute.first_ranked, "__defaults__", ("idx", at_once))
    words = " ".join(f"w{i % 40}" for i in range(700)) + " a a a"
    df = spark.createDataFrame([(0, words), (1, "b c")], "row_id long, t string")
    got = tt.pooled_vocabulary(df, ["t"], 25).orderBy("idx").collect()
    counts = {}
    for w in (words + " b c").split():
        counts[w] = counts.get(w, 0) + 1
    want = sorted(counts, key=lambda w: (-counts[w], w))[:25]
    assert [(r["term"], r["idx"]) for r in got] == [(w, i) for i, w in enumerate(want)]


def test_nothing_is_lost_without_broadcast(spark):
    """The null group is a group like any other, also when offsets are not broadcast."""
    rows = [(None if i % 4 == 0 else f"g{i % 3}", f"t{i:03d}") for i in range(200)]
    df = spark.createDataFrame(rows, "g string, t string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for limit in (old, "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            got = {(r["g"], r["t"]): r["idx"] for r in dense_index(df, ["t"], within="g").collect()}
            assert len(got) == 200
            assert [got[None, f"t{i:03d}"] for i in range(0, 200, 4)] == list(range(50))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_hot_keys_are_found_in_the_facts(spark):
    """The table was fitted on one row in a hundred; half of the facts share a key."""
    facts = spark.range(20_000).select(
        F.col("id").alias("row_id"), F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 97)).alias("term"))
    table = materialize(facts.filter("row_id % 100 < 2").groupBy("term").agg(F.count(F.lit(1)).alias("n")))
    joined = lookup_join(facts, table, ["term"], "row_id", "left", limit_bytes=0, rows_per_salt=1000)
    assert joined.count() == 20_000
    salted = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "_salts" in salted
    hot = facts.groupBy("term").count().filter("count > 1000").collect()
    assert [r["term"] for r in hot] == ["hot"] and table.filter("term = 'hot'").first()["n"] <= 1000


def test_order_cutoffs(spark):
    rows = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"))
    assert distribute.order_cutoffs(rows, "k", [0, 1, 17, 2500, 5000, 5001], at_once=50, width=8) == {1: 0, 17: 16, 2500: 2499, 5000: 4999}
    texts = rows.select(F.format_string("%05d", "k").alias("k"))
    assert distribute.order_cutoffs(texts, "k", [3000], at_once=10, width=5) == {3000: "02999"}
    same = spark.range(300).select(F.lit(4).alias("k"))
    assert distribute.order_cutoffs(same, "k", [200], at_once=10) == {200: 4}


def test_a_null_group_is_a_group(spark):
    rows = spark.createDataFrame([(i, f"g{i % 10}" if i % 10 else None) for i in range(100)], "id long, g string")
    got = splits.split_by_group(rows, "g").select("g", "split").distinct().collect()
    parts = [r["split"] for r in got]
    assert len(got) == 10 and [parts.count(p) for p in ("train", "val", "test")] == [7, 1, 2]


def test_a_tree_deeper_than_possible_is_an_error():
    with pytest.raises(ValueError, match="40"):
        models.forest(5, 40)


def test_cells_of_the_neighbour_search(spark):
    """Clustered vectors see few groups; for others a query is copied once per group."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(20, 8)) * 30
    for rows, most in ((centres[rng.integers(0, 20, 2000)] + rng.normal(size=(2000, 8)), 0.3), (rng.normal(size=(2000, 8)), 1.0)):
        df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(rows)], "query_id long, vec array<double>, label int")
        refs = df.withColumnRenamed("query_id", "ref_id")
        _, cells = neighbours._search_groups(df, refs, 3, 8, 2000, 20, 100)
        groups = 2000 / 50 + 20  # rings of at most about twice the wanted number
        assert cells.agg(F.sum("queries")).first()[0] <= most * 2000 * groups


def test_memory_of_a_search_does_not_grow_with_the_references():
    """In tiles; the distances of 256 queries to all of these references would take 400 MB."""
    rng = np.random.default_rng(6)
    q, r = rng.normal(size=(256, 4)), rng.normal(size=(200_000, 4))
    r[150_000:150_050] = q[0]
    ids = rng.permutation(len(r))
    tracemalloc.start()
    rows, cols, dist = neighbours._top(q, r, ids, 7)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150e6
    for i in (0, 1, 255):
        want = brute(q[i:i + 1], r, ids, 7)[0]
        assert [ids[c] for c in cols[rows == i]] == [j for _, j in want]
        assert np.allclose(dist[rows == i], [d for d, _ in want])


def test_searches_do_not_send_copies_of_queries_through_the_driver(spark):
    """Queries are copied for every group or bucket that they see, which the size of their table does not tell."""
    rng = np.random.default_rng(7)
    df = spark.createDataFrame([(i, v.tolist(), i % 3) for i, v in enumerate(rng.normal(size=(400, 6)))], "id long, v array<double>, y int")
    names = {"query_id": "id", "ref_id": "id", "vec": "v", "label": "y"}
    for found, key in ((neighbours.nearest_approximate(df, df, 3, **names, bucket_rows=32), "bucket"),
                       (neighbours.nearest(df, df, 3, **names, limit_bytes=0, n_pivots=5, block_rows=40), "block")):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert f"SortMergeJoin [{key}" in plan and f"BroadcastHashJoin [{key}" not in plan


@pytest.mark.parametrize("limit", [1, 300, 1 << 30])
def test_average_vectors_beyond_a_broadcast(spark, limit):
    """Frequent words by broadcast, the others by shuffle, give the same means; a vector moves once per row and word."""
    rng = np.random.default_rng(8)
    texts = [" ".join(f"w{min(int(x), 29)}" for x in rng.zipf(1.3, 40)) for _ in range(60)] + ["none known", None]
    df = spark.createDataFrame(list(enumerate(texts)), "row_id long, t string")
    vecs = {f"w{i}": [float(i), 0.5 * i, -1.0 * i] for i in range(1, 25)}
    words = spark.createDataFrame(list(vecs.items()), "word string, vec array<float>")
    got = {r["row_id"]: r["vec"] for r in vectors.average_vectors(tt.term_table(df, "row_id", ["t"]), words, 3, limit_bytes=limit).collect()}
    want = {i: np.mean([vecs[w] for w in (t or "").split() if w in vecs], axis=0) for i, t in enumerate(texts)
            if any(w in vecs for w in (t or "").split())}
    assert got.keys() == want.keys() and all(np.allclose(got[i], want[i]) for i in want)


def test_a_forest_grown_over_several_fits(spark):
    """The driver holds the trees of one fit at a time; the votes of all of them count."""
    rng = np.random.default_rng(9)
    rows = [(float(i % 3), Vectors.dense(rng.normal(size=4) + i % 3 * 2)) for i in range(300)]
    data = spark.createDataFrame(rows, ["label_idx", "features"])
    parts = [models.forest_accuracy(data, data, 6, 30, at_once=n) for n in (1, 1300, 10_000)]
    assert all(p > 0.95 for p in parts)
    assert parts[2] == models.accuracy(models.forest(6, 30, 1).fit(data), data)
