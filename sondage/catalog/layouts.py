"""Feature assembly, scaling, selection and contrasts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.fixed import ENGLISH_STOP, SHORT_STOP
from ..functions.options import options_by_part
from ..operators import contrast, features as feats, splits, terms as tt
from ..operators.distribute import materialize
from ..plans import layouts, prepare
from ..plans.pipeline import FeatureModel, FeaturePipeline, pooled_layout, tfidf_layout, prepared
from .answers import PART_OPTIONS, PART_RULES, PART_TARGETS, sql_among, sql_anywhere, sql_by_part, sql_mode, sql_rating
from .registry import query, scratch, sql_list, sql_tokens, table
from .text import sql_clean


BROADCAST_ROWS = 200_000


def _joinable(df):
    """Spark judges by the size of the file whether to broadcast a table, and of the columns asked for: the keys of millions
    of rows in a few compressed MB would go through the driver. Tables of many rows are joined by merging."""
    return df.hint("merge") if df.count() > BROADCAST_ROWS else df


def responses(spark, d):
    """Survey-shaped rows: documents as one text, part names as another, order
    priorities and part sizes as ratings, part words as multi-select answers."""
    docs = table(spark, d, "documents").select("doc_id", "lang", F.col("text").alias("t1"))
    marks = table(spark, d, "labels").select("doc_id", F.col("quality").cast("string").alias("label"))
    orders = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("doc_id"), F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderpriority")).alias("r1"))
    parts = table(spark, d, "part").select(
        F.col("p_partkey").alias("doc_id"), F.col("p_name").alias("t2"),
        F.when(F.col("p_partkey") % 13 != 0, F.concat((F.col("p_size") % 5 + 1).cast("string"), F.lit(" - x"))).alias("r2"),
        F.when(F.col("p_partkey") % 17 != 0,
               F.concat(F.regexp_replace("p_name", " ", ", "), F.lit(", "), F.col("p_type"))).alias("m1"),
        F.when(F.col("p_partkey") % 7 != 0, F.concat("p_type", F.lit(", "), "p_name")).otherwise("").alias("m2"))
    return (docs.join(_joinable(marks), "doc_id", "left").join(_joinable(orders), "doc_id", "left")
            .join(_joinable(parts), "doc_id", "left"))


SQL_RESPONSES = (
    "s AS (SELECT d.doc_id, lang, d.text AS t1, p_name AS t2, CAST(quality AS VARCHAR) AS label, "
    "CASE WHEN o_orderkey % 11 <> 0 THEN o_orderpriority END AS r1, "
    "CASE WHEN p_partkey % 13 <> 0 THEN CAST(p_size % 5 + 1 AS VARCHAR) || ' - x' END AS r2, "
    "CASE WHEN p_partkey % 17 <> 0 THEN replace(p_name, ' ', ', ') || ', ' || p_type END AS m1, "
    "CASE WHEN p_partkey % 7 <> 0 THEN p_type || ', ' || p_name ELSE '' END AS m2 "
    "FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id LEFT JOIN orders ON o_orderkey = d.doc_id "
    "LEFT JOIN part ON p_partkey = d.doc_id)")
COLUMNS = (("t1", "t2"), ("r1", "r2"), ("m1", "m2"))
RULES = {"rules": PART_RULES, "options": PART_OPTIONS}
_OPTION_ROWS = "(SELECT unnest([" + sql_list(PART_OPTIONS) + "]) AS option, unnest(range(0, 8)) AS oi)"


def _sql_ratings(base: str, scale: bool = False, rows: str = "s") -> str:
    def value(c):
        v = f"coalesce({sql_rating(c)}, {sql_mode(c, rows)})"
        return f"({v} - 1) / 4.0e0" if scale else f"CAST({v} AS DOUBLE)"
    return (f"SELECT doc_id, {base} AS idx, {value('r1')} AS value FROM s UNION ALL "
            f"SELECT doc_id, {base} + 1, {value('r2')} FROM s")


def _sql_multi(base: str) -> str:
    return (f"SELECT doc_id, {base} + oi AS idx, 1.0e0 AS value FROM s, {_OPTION_ROWS} "
            f"WHERE list_contains({sql_by_part('m1')}, option) UNION ALL "
            f"SELECT doc_id, {base} + 8 + oi, 1.0e0 FROM s, {_OPTION_ROWS} WHERE list_contains({sql_by_part('m2')}, option)")


_POOLED_WORDS = (
    "x AS (SELECT doc_id, 0 AS ord, unnest(" + sql_tokens("t1") + ") AS term FROM s UNION ALL "
    "SELECT doc_id, 1, unnest(" + sql_tokens("t2") + ") FROM s), "
    "v AS (SELECT term, row_number() OVER (ORDER BY count(*) DESC, term) - 1 AS vi FROM x GROUP BY term)")
SQL_POOLED = (
    f"{SQL_RESPONSES}, {_POOLED_WORDS}, feats AS (SELECT doc_id, ord * 100 + vi AS idx, CAST(count(*) AS DOUBLE) AS value "
    "FROM x JOIN v USING (term) WHERE vi < 100 GROUP BY doc_id, ord, vi UNION ALL "
    f"{_sql_ratings('200')} UNION ALL {_sql_multi('202')})")


def _pooled(spark, d):
    rows = responses(spark, d)
    config = pooled_layout("doc_id", *COLUMNS, dict_len=100, **RULES)
    rows = prepared(rows, config)
    return rows, FeaturePipeline(config).fit(rows)


_SEEN_WORDS = (
    "y AS (SELECT doc_id, ord, generate_subscripts(w, 1) AS pos, unnest(w) AS term FROM (SELECT doc_id, 0 AS ord, "
    + sql_tokens("t1") + " AS w FROM s UNION ALL SELECT doc_id, 1, " + sql_tokens("t2") + " FROM s)), "
    "x AS (SELECT doc_id, ord, term FROM y), "
    "v AS (SELECT term, row_number() OVER (ORDER BY count(*) DESC, min({'a': ord, 'b': doc_id, 'c': pos})) - 1 AS vi "
    "FROM y GROUP BY term)")


@query(f"WITH {SQL_RESPONSES}, {_SEEN_WORDS}, feats AS (SELECT doc_id, ord * 60 + vi AS idx, CAST(count(*) AS DOUBLE) AS value "
       "FROM x JOIN v USING (term) WHERE vi < 60 GROUP BY doc_id, ord, vi UNION ALL "
       f"{_sql_ratings('120')} UNION ALL {_sql_multi('122')}) "
       "SELECT doc_id, CAST(idx AS BIGINT) AS idx, value FROM feats WHERE value <> 0")
def assemble_first_seen(spark, d):
    """The pooled layout whose equal counts keep the order of first appearance: column, row, position."""
    config = pooled_layout("doc_id", *COLUMNS, dict_len=60, ties="first", **RULES)
    rows = prepared(responses(spark, d), config)
    return FeaturePipeline(config).fit(rows).transform(rows).withColumnRenamed("row_id", "doc_id")


@query(f"WITH {SQL_POOLED} SELECT doc_id, CAST(idx AS BIGINT) AS idx, value FROM feats WHERE value <> 0")
def assemble_v1(spark, d):
    rows, model = _pooled(spark, d)
    return model.transform(rows).withColumnRenamed("row_id", "doc_id")


def _sql_column_words(c: str) -> str:
    return f"SELECT doc_id, '{c}' AS col, unnest({sql_tokens(c, SHORT_STOP)}) AS term FROM s"


_N_PAIRS = [(i, j) for i in range(8) for j in range(i + 1, 8)]
_SQL_PAIRS = ("SELECT doc_id, nv + 18 + unnest(range(0, 28)) AS idx, unnest([" + ", ".join(
    f"CAST(list_contains(u, '{PART_OPTIONS[i]}') AND list_contains(u, '{PART_OPTIONS[j]}') AS DOUBLE)"
    for i, j in _N_PAIRS) + "]) AS value FROM (SELECT doc_id, list_distinct("
    + sql_by_part("m1") + " || " + sql_by_part("m2") + ") AS u FROM s), n")
SQL_TFIDF_LAYOUT = (
    f"{SQL_RESPONSES}, x AS ({_sql_column_words('t1')} UNION ALL {_sql_column_words('t2')}), "
    "tf AS (SELECT doc_id, col, term, count(*) AS tf FROM x GROUP BY ALL), "
    "v0 AS (SELECT col, term, count(*) AS df FROM tf GROUP BY ALL HAVING sum(tf) >= 5), "
    "v AS (SELECT col, term, row_number() OVER (ORDER BY col, term) - 1 AS idx, "
    "ln(((SELECT count(*) FROM s) + 1.0e0) / (df + 1.0e0)) + 1.0e0 AS idf FROM v0), "
    "n AS (SELECT count(*) AS nv FROM v), "
    "feats AS (SELECT doc_id, idx, ln(1.0e0 + tf) * idf AS value FROM tf JOIN v USING (col, term) UNION ALL "
    + _sql_ratings("(SELECT nv FROM n)", True) + " UNION ALL " + _sql_multi("(SELECT nv + 2 FROM n)")
    + f" UNION ALL {_SQL_PAIRS} UNION ALL "
    f"SELECT doc_id, nv + 46, ln(1.0e0 + len({sql_tokens('t1', SHORT_STOP)})) FROM s, n UNION ALL "
    f"SELECT doc_id, nv + 47, ln(1.0e0 + len({sql_tokens('t2', SHORT_STOP)})) FROM s, n UNION ALL "
    f"SELECT doc_id, nv + 48, ln(1.0e0 + len({sql_by_part('m1')})) FROM s, n UNION ALL "
    f"SELECT doc_id, nv + 49, ln(1.0e0 + len({sql_by_part('m2')})) FROM s, n)")


def _tfidf(spark, d):
    rows = responses(spark, d)
    config = tfidf_layout("doc_id", *COLUMNS, pairs=True, **RULES)
    rows = prepared(rows, config)
    return rows, FeaturePipeline(config).fit(rows)


@query(f"WITH {SQL_TFIDF_LAYOUT} SELECT doc_id, CAST(idx AS BIGINT) AS idx, round(value, 6) AS value "
       "FROM feats WHERE value <> 0")
def assemble_v2(spark, d):
    rows, model = _tfidf(spark, d)
    return model.transform(rows).select(F.col("row_id").alias("doc_id"), "idx", F.round("value", 6).alias("value"))


@query("WITH " + SQL_RESPONSES + ", x AS (" + _sql_column_words("t1") + " UNION ALL " + _sql_column_words("t2") + "), "
       "w AS (SELECT col, term FROM x GROUP BY ALL HAVING count(*) >= 5), "
       "b(ord, block, width) AS (SELECT 0, 'text:t1', (SELECT count(*) FROM w WHERE col = 't1') UNION ALL "
       "SELECT 1, 'text:t2', (SELECT count(*) FROM w WHERE col = 't2') UNION ALL SELECT 2, 'ratings', 2 UNION ALL "
       "SELECT 3, 'multi', 16 UNION ALL SELECT 4, 'pairs', 28 UNION ALL SELECT 5, 'lengths', 2 UNION ALL "
       "SELECT 6, 'option_counts', 2 UNION ALL SELECT 7, 'embeddings', 0) "
       "SELECT block, CAST(coalesce(sum(width) OVER (ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) "
       "AS BIGINT) AS first, CAST(width AS BIGINT) AS width FROM b")
def feature_map(spark, d):
    _, model = _tfidf(spark, d)
    return spark.createDataFrame(model.feature_map(), "block string, first long, width long")


@query(f"WITH {SQL_TFIDF_LAYOUT} SELECT doc_id, CAST(idx AS BIGINT) AS idx, round(value, 6) AS value "
       "FROM feats WHERE value <> 0")
def saved_layout(spark, d):
    """A layout that was saved and loaded gives the same features."""
    rows, model = _tfidf(spark, d)
    path = scratch(spark)
    model.save(path)
    back = FeatureModel.load(spark, path).transform(rows)
    return back.select(F.col("row_id").alias("doc_id"), "idx", F.round("value", 6).alias("value"))


def _sql_prepared(cut: str) -> str:
    """Pooled layout with vocabulary and modes of the first part of the split ``g``."""
    train = "(SELECT s.* FROM s JOIN g USING (doc_id) WHERE split = 'train')"
    return (
        f"{SQL_RESPONSES}, g AS (SELECT doc_id, CASE WHEN rn <= 576 THEN 'train' WHEN rn <= 702 THEN 'val' ELSE 'test' END "
        f"AS split FROM (SELECT doc_id, row_number() OVER (ORDER BY {cut}) AS rn FROM s)), t AS {train}, "
        "x AS (SELECT doc_id, 0 AS ord, unnest(" + sql_tokens("t1") + ") AS term FROM s UNION ALL "
        "SELECT doc_id, 1, unnest(" + sql_tokens("t2") + ") FROM s), "
        "v AS (SELECT term, row_number() OVER (ORDER BY count(*) DESC, term) - 1 AS vi FROM x JOIN t USING (doc_id) GROUP BY term), "
        "feats AS (SELECT doc_id, ord * 100 + vi AS idx, CAST(count(*) AS DOUBLE) AS value FROM x JOIN v USING (term) "
        f"WHERE vi < 100 GROUP BY doc_id, ord, vi UNION ALL {_sql_ratings('200', rows='t')} UNION ALL {_sql_multi('202')})")


@query("WITH " + _sql_prepared("doc_id") + " SELECT doc_id, split, label, CAST(idx AS BIGINT) AS idx, value "
       "FROM feats JOIN g USING (doc_id) JOIN (SELECT doc_id, label FROM s) USING (doc_id) WHERE value <> 0")
def prepare_training(spark, d):
    """Cut by position, fit on the first part, features of all parts."""
    features, _ = prepare.prepare_training(
        responses(spark, d), pooled_layout("doc_id", *COLUMNS, dict_len=100, **RULES), "label",
        lambda rows: splits.split_by_position(rows, "doc_id"))
    return features.withColumnRenamed("row_id", "doc_id")


@query("WITH " + _sql_prepared("md5('42:' || doc_id)") + " SELECT doc_id, CAST(idx AS BIGINT) AS idx, value "
       "FROM feats JOIN g USING (doc_id) WHERE value <> 0 AND split = 'test'")
def prepare_shuffled_test(spark, d):
    """Shuffle, cut, fit on the first part, features of the last part."""
    features, _ = prepare.prepare_shuffled_test(
        responses(spark, d), pooled_layout("doc_id", *COLUMNS, dict_len=100, **RULES))
    return features.withColumnRenamed("row_id", "doc_id")


# --- one document per response ---------------------------------------------------

SQL_DOCUMENTS = (
    f"{SQL_RESPONSES}, docs AS (SELECT doc_id, coalesce(label, '') AS label, concat_ws(' ', coalesce(lang, ''), t1, "
    "coalesce(r1, ''), coalesce(t2, ''), coalesce(r2, ''), coalesce(m1, ''), coalesce(m2, '')) AS text FROM s), "
    "x AS (SELECT doc_id, unnest(" + sql_tokens("text", ENGLISH_STOP, 2) + ") AS term FROM docs), "
    "tf AS (SELECT doc_id, term, count(*) AS tf FROM x GROUP BY ALL), "
    "c AS (SELECT term, CAST(sum(tf) AS BIGINT) AS n, count(*) AS df FROM tf GROUP BY term HAVING count(*) >= 3 "
    "ORDER BY n DESC, term LIMIT 400), "
    "v AS (SELECT term, n, df, row_number() OVER (ORDER BY term) - 1 AS idx, "
    "ln(((SELECT count(*) FROM docs) + 1.0e0) / (df + 1.0e0)) + 1.0e0 AS idf FROM c), "
    "w AS (SELECT doc_id, idx, (1.0e0 + ln(tf)) * idf AS w FROM tf JOIN v USING (term)), "
    "feats AS (SELECT doc_id, idx, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS value FROM w)")


@query(f"WITH {SQL_DOCUMENTS} SELECT doc_id, idx, round(value, 6) AS value FROM feats")
def assemble_document(spark, d):
    features, _, _ = layouts.document_layout(responses(spark, d), "doc_id", stop=ENGLISH_STOP)
    return features.select(F.col("row_id").alias("doc_id"), "idx", F.round("value", 6).alias("value"))


# --- selected features -------------------------------------------------------------

_SORTED = ("(SELECT option, row_number() OVER (ORDER BY option) - 1 AS oi FROM (SELECT unnest(["
           + sql_list(PART_OPTIONS) + "]) AS option))")


def _sql_level(c: str, at: int) -> str:
    v = f"coalesce({sql_rating(c)}, 3)"
    return (f"SELECT doc_id, label, nv + {at} + {v} - 1 AS idx, 1.0e0 AS value FROM l, n WHERE {v} BETWEEN 1 AND 5")


def _sql_hot(c: str, at: int) -> str:
    return (f"SELECT doc_id, label, nv + {at} + oi, 1.0e0 FROM l, n, {_SORTED} "
            f"WHERE list_contains({sql_anywhere(c)}, option)")


SQL_SELECTED = (
    f"{SQL_RESPONSES}, l AS (SELECT * FROM s WHERE label IS NOT NULL), "
    "x AS (SELECT doc_id, label, unnest(list_filter(" + sql_clean("t1") + f", lambda w: w NOT IN ({sql_list(ENGLISH_STOP)}))) "
    "AS term FROM l), tf AS (SELECT doc_id, label, term, count(*) AS tf FROM x GROUP BY ALL), "
    "v AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS idx, ln(((SELECT count(*) FROM l) + 1.0e0) / "
    "(count(*) + 1.0e0)) + 1.0e0 AS idf FROM tf GROUP BY term HAVING count(*) >= 2), n AS (SELECT count(*) AS nv FROM v), "
    "w AS (SELECT doc_id, label, idx, (1.0e0 + ln(tf)) * idf AS w FROM tf JOIN v USING (term)), "
    "feats AS (SELECT doc_id, label, idx, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS value FROM w UNION ALL "
    + " UNION ALL ".join([_sql_level("r1", 0), _sql_level("r2", 5), _sql_hot("m1", 10), _sql_hot("m2", 18)]) + "), "
    "share AS (SELECT label, count(*) * 1.0e0 / (SELECT count(*) FROM l) AS p FROM l GROUP BY label), "
    "total AS (SELECT idx, sum(value) AS t FROM feats GROUP BY idx), "
    "obs AS (SELECT idx, label, sum(value) AS o FROM feats GROUP BY idx, label), "
    "chi AS (SELECT idx, sum((coalesce(o, 0) - p * t) ** 2 / (p * t)) AS chi2 FROM total CROSS JOIN share "
    "LEFT JOIN obs USING (idx, label) GROUP BY idx), "
    "kept AS (SELECT idx, chi2, row_number() OVER (ORDER BY idx) - 1 AS new_idx FROM "
    "(SELECT * FROM chi ORDER BY round(chi2, 9) DESC, idx LIMIT 420)), "
    "masked AS (SELECT doc_id, label, new_idx AS idx, value FROM feats JOIN kept USING (idx))")


def selected(spark, d):
    return layouts.selected_layout(responses(spark, d), "doc_id", "t1", ["r1", "r2"], ["m1", "m2"],
                                   rules=PART_RULES, stop=ENGLISH_STOP)


@query(f"WITH {SQL_SELECTED} SELECT CAST(idx AS BIGINT) AS idx, new_idx, round(chi2, 6) AS chi2 FROM kept")
def chi2_topk(spark, d):
    _, _, model = selected(spark, d)
    return model.kept.select("idx", "new_idx", F.round("chi2", 6).alias("chi2"))


@query(f"WITH {SQL_SELECTED} SELECT doc_id, label, idx, round(value, 6) AS value FROM masked")
def apply_mask(spark, d):
    features, _, _ = selected(spark, d)
    return features.select(F.col("row_id").alias("doc_id"), "label", "idx", F.round("value", 6).alias("value"))


# --- small baseline ------------------------------------------------------------------

@query(f"WITH {SQL_RESPONSES}, c AS (SELECT *, {sql_among('m1')} AS a, {sql_among('m2')} AS b FROM s "
       "WHERE label IS NOT NULL AND r1 IS NOT NULL AND r2 IS NOT NULL AND m1 IS NOT NULL AND m2 IS NOT NULL "
       "AND t2 IS NOT NULL), "
       "oa AS (SELECT o, row_number() OVER (ORDER BY o) AS i FROM (SELECT DISTINCT unnest(a) AS o FROM c)), "
       "ob AS (SELECT o, row_number() OVER (ORDER BY o) + (SELECT count(*) FROM oa) AS i FROM (SELECT DISTINCT unnest(b) AS o FROM c)) "
       f"SELECT doc_id, label, 0 AS idx, CAST({sql_rating('r1')} AS DOUBLE) AS value FROM c UNION ALL "
       f"SELECT doc_id, label, 1, CAST({sql_rating('r2')} AS DOUBLE) FROM c UNION ALL "
       "SELECT doc_id, label, i + 1, CAST(list_contains(a, o) AS DOUBLE) FROM c, oa UNION ALL "
       "SELECT doc_id, label, i + 1, CAST(list_contains(b, o) AS DOUBLE) FROM c, ob")
def assemble_baseline(spark, d):
    rows = layouts.baseline_rows(responses(spark, d), "doc_id", ["r1", "r2"], ["m1", "m2"], targets=PART_TARGETS)
    return rows.select(F.col("row_id").alias("doc_id"), "label", F.posexplode("x").alias("idx", "value")).select(
        "doc_id", "label", F.col("idx").cast("long").alias("idx"), "value")


# --- scaling ------------------------------------------------------------------------

@query(f"WITH {SQL_POOLED}, n AS (SELECT count(*) AS n FROM s), st AS (SELECT idx, sum(value) / any_value(n) AS m, "
       "sum(value * value) / any_value(n) AS q FROM feats, n WHERE value <> 0 GROUP BY idx), "
       "sc AS (SELECT idx, CASE WHEN q - m * m > 1e-12 THEN sqrt(q - m * m) ELSE 1 END AS sd FROM st) "
       "SELECT doc_id, CAST(idx AS BIGINT) AS idx, round(value / sd, 6) AS value FROM feats JOIN sc USING (idx) WHERE value <> 0")
def scale_std(spark, d):
    rows, model = _pooled(spark, d)
    features = materialize(model.transform(rows))
    scales = materialize(feats.fit_scale(features, rows.count()))
    return feats.scale_features(features, scales).select(
        F.col("row_id").alias("doc_id"), "idx", F.round("value", 6).alias("value"))


@query("WITH x AS (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS v, generate_subscripts(embedding, 1) - 1 AS idx "
       "FROM embeddings), st AS (SELECT idx, avg(v) AS m, stddev_pop(v) AS sd FROM x GROUP BY idx) "
       "SELECT vec_id, idx, round((v - m) / CASE WHEN sd > 0 THEN sd ELSE 1 END, 6) + 0.0e0 AS value FROM x JOIN st USING (idx)")
def standardize(spark, d):
    e = table(spark, d, "embeddings")
    scaled = feats.standardize(e, "embedding", feats.dense_moments(e, "embedding"))
    return scaled.select("vec_id", F.posexplode("embedding").alias("idx", "v")).select(
        "vec_id", F.col("idx").cast("long").alias("idx"), (F.round("v", 6) + 0.0).alias("value"))


@query(f"WITH {SQL_POOLED}, g AS (SELECT doc_id, CASE WHEN rn <= floor(n * 0.7e0) THEN 'train' "
       "WHEN rn <= floor(n * 0.7e0) + floor(n * 0.15e0) THEN 'val' ELSE 'test' END AS split FROM (SELECT doc_id, "
       "row_number() OVER (ORDER BY md5('666:' || doc_id)) AS rn, count(*) OVER () AS n FROM s)) "
       "SELECT split, count(*) AS n_rows, CAST(218 AS BIGINT) AS width, count(label) AS n_labels, CAST(sum(nz) AS BIGINT) AS nonzeros "
       "FROM s JOIN g USING (doc_id) JOIN (SELECT doc_id, count(*) AS nz FROM feats WHERE value <> 0 GROUP BY doc_id) "
       "USING (doc_id) GROUP BY split")
def matrix_shape(spark, d):
    rows = splits.split_by_group(responses(spark, d), "doc_id")
    model = FeaturePipeline(pooled_layout("doc_id", *COLUMNS, dict_len=100, **RULES)).fit(rows)
    return feats.matrix_shape(model.transform(rows, keep=["split"]), rows, model.width)


# --- contrasts --------------------------------------------------------------------------

@query("SELECT question, status, round(avg(r), 6) AS mean, round(stddev_samp(r), 6) AS std, count(r) AS n FROM ("
       f"SELECT 'answer' AS question, o_orderstatus AS status, {sql_rating('o_orderpriority')} AS r FROM orders "
       f"WHERE o_orderkey % 11 <> 0 UNION ALL SELECT 'other', o_orderstatus, {sql_rating('o_orderpriority')} FROM orders) "
       "WHERE status IN ('F', 'O') AND r IS NOT NULL GROUP BY ALL")
def contrast_rating(spark, d):
    rows = table(spark, d, "orders").select(
        F.col("o_orderstatus").alias("status"),
        F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderpriority")).alias("answer"),
        F.col("o_orderpriority").alias("other"))
    stats = contrast.rating_stats(rows, "status", ["F", "O"], ["answer", "other"])
    return stats.select("question", "status", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), "n")


def _rates(spark, d):
    parts = table(spark, d, "part").withColumn("q", F.when(
        F.col("p_partkey") % 17 != 0, F.concat(F.regexp_replace("p_name", " ", ", "), F.lit(", "), F.col("p_type"))))
    return contrast.option_rates(parts, "p_brand", "Brand#1", "Brand#2", options_by_part("q", PART_RULES), PART_OPTIONS)


_SQL_RATES = (
    "p AS (SELECT p_brand, CASE WHEN p_partkey % 17 <> 0 THEN replace(p_name, ' ', ', ') || ', ' || p_type END AS q FROM part "
    f"WHERE p_brand IN ('Brand#1', 'Brand#2')), x AS (SELECT p_brand, {sql_by_part('q')} AS sel FROM p), "
    "r AS (SELECT oi AS idx, option, "
    "coalesce(sum(CASE WHEN p_brand = 'Brand#1' AND list_contains(sel, option) THEN 1.0e0 ELSE 0.0e0 END) / "
    "nullif((SELECT count(*) FROM x WHERE p_brand = 'Brand#1' AND len(sel) > 0), 0), 0.0e0) AS a, "
    "coalesce(sum(CASE WHEN p_brand = 'Brand#2' AND list_contains(sel, option) THEN 1.0e0 ELSE 0.0e0 END) / "
    "nullif((SELECT count(*) FROM x WHERE p_brand = 'Brand#2' AND len(sel) > 0), 0), 0.0e0) AS b "
    f"FROM {_OPTION_ROWS} LEFT JOIN x ON true GROUP BY oi, option), "
    "rates AS (SELECT idx, option, round(a, 6) AS rate_a, round(b, 6) AS rate_b, a - b AS d FROM r)")


def _rounded(df, *cols):
    return df.select(*[c for c in df.columns if c not in cols], *[(F.round(c, 6) + 0.0).alias(c) for c in cols])


@query(f"WITH {_SQL_RATES} SELECT CAST(idx AS INTEGER) AS idx, option, rate_a, rate_b, round(d, 6) + 0.0e0 AS diff FROM rates")
def contrast_options(spark, d):
    return _rounded(_rates(spark, d), "rate_a", "rate_b", "diff")


@query(f"WITH {_SQL_RATES} SELECT CAST(idx AS INTEGER) AS idx, option, rate_a, rate_b, round(d, 6) + 0.0e0 AS diff FROM rates "
       "ORDER BY round(abs(d), 9) DESC, idx LIMIT 5")
def contrast_options_top5(spark, d):
    return _rounded(contrast.top_options(_rates(spark, d)), "rate_a", "rate_b", "diff")


@query("SELECT 'text' AS question, lang, round(avg(n), 6) AS mean, round(stddev_samp(n), 6) AS std, count(*) AS n FROM "
       "(SELECT lang, len(" + sql_tokens("text", SHORT_STOP) + ") AS n FROM documents WHERE lang IN ('en', 'de')) GROUP BY lang")
def contrast_length(spark, d):
    stats = contrast.length_stats(table(spark, d, "documents"), "lang", ["en", "de"], ["text"])
    return stats.select("question", "lang", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), "n")


_SQL_KEYWORDS = (
    "w AS (SELECT quality, unnest(" + sql_tokens("text", SHORT_STOP) + ") AS term FROM documents JOIN labels USING (doc_id)), "
    "c AS (SELECT term, count(*) FILTER (quality = 0) AS n_a, count(*) FILTER (quality = 1) AS n_b FROM w GROUP BY term), "
    "k AS (SELECT term, n_a, n_b, n_a * 1.0e0 / (SELECT sum(n_a) FROM c) AS fa, n_b * 1.0e0 / (SELECT sum(n_b) FROM c) AS fb "
    "FROM c WHERE n_a + n_b >= 5), "
    "kw AS (SELECT term, n_a, n_b, round(fa, 9) AS freq_a, round(fb, 9) AS freq_b, fa - fb AS d FROM k)")


def _keywords(spark, d):
    rows = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id")
    terms = tt.term_table(rows, "doc_id", ["text"], stop=SHORT_STOP, keep=["quality"])
    return contrast.keyword_contrast(terms, "quality", 0, 1)


def _round9(df):
    return df.select(*[c for c in df.columns if c not in ("freq_a", "freq_b", "diff")],
                     *[(F.round(c, 9) + 0.0).alias(c) for c in ("freq_a", "freq_b", "diff")])


@query(f"WITH {_SQL_KEYWORDS} SELECT term, n_a, n_b, freq_a, freq_b, round(d, 9) + 0.0e0 AS diff FROM kw")
def contrast_keywords(spark, d):
    return _round9(_keywords(spark, d))


@query(f"WITH {_SQL_KEYWORDS} (SELECT term, n_a, n_b, freq_a, freq_b, round(d, 9) + 0.0e0 AS diff, 'a' AS side FROM kw "
       "ORDER BY round(d, 12) DESC, term LIMIT 20) UNION ALL (SELECT term, n_a, n_b, freq_a, freq_b, round(d, 9) + 0.0e0, 'b' "
       "FROM kw ORDER BY round(d, 12), term LIMIT 20)")
def contrast_keywords_top20(spark, d):
    return _round9(contrast.top_keywords(_keywords(spark, d)))
