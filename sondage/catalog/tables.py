"""Scans, row clean-up, splits and folds."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import contrast, features as feats, records, splits
from ..sources import artifacts, survey
from .registry import query, scratch, table


def _messy_parts(spark, d):
    """Part rows with quotes, commas, line breaks and spelled-out missing cells."""
    p = table(spark, d, "part")
    name = (F.when(F.col("p_partkey") % 5 == 0, F.lit("NA"))
            .when(F.col("p_partkey") % 5 == 1, F.concat(F.lit('a "'), "p_name", F.lit('", b')))
            .when(F.col("p_partkey") % 5 == 2, F.concat("p_name", F.lit("\nnext line")))
            .otherwise(F.col("p_name")))
    kind = F.when(F.col("p_partkey") % 7 == 0, F.lit("nan")).otherwise(F.col("p_type"))
    return p.select(F.col("p_partkey").cast("string").alias("key"), name.alias("What name? (e.g., any)"),
                    kind.alias("kind"))


@query("SELECT CAST(p_partkey AS VARCHAR) AS key, CASE p_partkey % 5 WHEN 0 THEN NULL "
       "WHEN 1 THEN 'a \"' || p_name || '\", b' WHEN 2 THEN p_name || chr(10) || 'next line' ELSE p_name END AS answer, "
       "CASE WHEN p_partkey % 7 <> 0 THEN p_type END AS kind FROM part")
def csv_round_trip(spark, d):
    path = scratch(spark)
    rows = _messy_parts(spark, d)
    survey.write_survey(rows, path)
    back = survey.read_survey(spark, path, survey.string_schema(rows.columns), multiline=True)
    return records.select_positions(back, [0, 1, 2]).toDF("key", "answer", "kind")


@query("SELECT p_type, p_name FROM part")
def select_positions(spark, d):
    parts = table(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    return records.select_positions(parts, [3, 1])


def _gaps(spark, d):
    p = table(spark, d, "part")
    return p.select(
        "p_partkey", F.col("p_brand").alias("student_id"),
        F.when(F.col("p_partkey") % 3 != 0, F.col("p_name")).alias("name"), "p_size",
        F.when(F.col("p_partkey") % 4 != 0, F.col("p_type")).alias("label"))


_SQL_GAPS = ("g AS (SELECT p_partkey, p_brand AS student_id, CASE WHEN p_partkey % 3 <> 0 THEN p_name END AS name, p_size, "
             "CASE WHEN p_partkey % 4 <> 0 THEN p_type END AS label FROM part)")


@query(f"WITH {_SQL_GAPS} SELECT p_partkey, coalesce(name, '') || ' ' || CAST(p_size AS VARCHAR) AS text, "
       "coalesce(label, '') AS label FROM g")
def fillna_concat(spark, d):
    return records.one_document(_gaps(spark, d), keep=["p_partkey"])


@query(f"WITH {_SQL_GAPS} SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, student_id, coalesce(name, '') AS name, "
       "CAST(p_size AS VARCHAR) AS p_size, coalesce(label, '') AS label FROM g")
def fillna_all(spark, d):
    return records.fill_empty(records.require_column(_gaps(spark, d)))


@query(f"WITH {_SQL_GAPS} SELECT * FROM g WHERE name IS NOT NULL AND label IS NOT NULL")
def dropna_any(spark, d):
    return records.drop_incomplete(_gaps(spark, d))


def labelled(spark, d):
    """Documents with quality as text label: missing, blank, or given."""
    docs = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    label = F.when(F.col("doc_id") % 9 == 0, F.lit(" \t")).otherwise(F.col("quality").cast("string"))
    return docs.select("doc_id", "lang", "n_chars", "toxic", label.alias("label"))


_SQL_LABELLED = ("l AS (SELECT doc_id, lang, n_chars, toxic, CASE WHEN doc_id % 9 = 0 THEN ' ' || chr(9) "
                 "ELSE CAST(quality AS VARCHAR) END AS label FROM documents LEFT JOIN labels USING (doc_id))")


@query(f"WITH {_SQL_LABELLED} SELECT doc_id, label FROM l WHERE label IN ('0', '1')")
def drop_blank_label(spark, d):
    return records.drop_unlabelled(labelled(spark, d)).select("doc_id", "label")


@query(f"WITH {_SQL_LABELLED} SELECT doc_id, lang, label FROM l WHERE lang IN ('en', 'de')")
def label_filter(spark, d):
    return records.keep_labels(labelled(spark, d), ["en", "de"], "lang").select("doc_id", "lang", "label")


@query("SELECT doc_id, CAST(quality AS VARCHAR) AS quality FROM documents LEFT JOIN labels USING (doc_id)")
def label_text(spark, d):
    docs = table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels"), "doc_id", "left")
    return records.label_as_text(docs, "quality").select("doc_id", "quality")


@query(f"WITH c AS (SELECT lang, dense_rank() OVER (ORDER BY lang) - 1 AS i FROM (SELECT DISTINCT lang FROM documents)) "
       "SELECT doc_id, lang, CAST(i AS INTEGER) AS label_idx FROM documents JOIN c USING (lang)")
def label_encode(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang")
    return records.encode_label(docs, records.label_classes(docs, "lang"), "lang")


# --- splits ------------------------------------------------------------------

@query("SELECT o_orderkey, CASE WHEN rn <= 576 THEN 'train' WHEN rn <= 702 THEN 'val' ELSE 'test' END AS split "
       "FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS rn FROM orders)")
def split_positional(spark, d):
    return splits.split_by_position(table(spark, d, "orders").select("o_orderkey"), "o_orderkey")


@query("SELECT o_orderkey, CASE WHEN rn <= CAST(floor(0.7e0 * n) AS BIGINT) THEN 'train' ELSE 'test' END AS split "
       "FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS rn, count(*) OVER () AS n FROM orders)")
def split_ordered_70_30(spark, d):
    return splits.split_by_position(table(spark, d, "orders").select("o_orderkey"), "o_orderkey", ratios=[0.7],
                                    names=("train", "test"))


def sql_hash(key: str, seed: int) -> str:
    return f"md5('{seed}:' || {key})"


@query("SELECT o_orderkey, CASE WHEN rn <= 576 THEN 'train' WHEN rn <= 702 THEN 'val' ELSE 'test' END AS split FROM "
       f"(SELECT o_orderkey, row_number() OVER (ORDER BY {sql_hash('o_orderkey', 42)}) AS rn FROM orders)")
def split_hash(spark, d):
    return splits.split_shuffled(table(spark, d, "orders").select("o_orderkey"), "o_orderkey")


# Every seventh customer is taken as unknown: the rows without one are a group, too.
_SQL_GROUPS = ("o AS (SELECT o_orderkey, CASE WHEN o_custkey % 7 <> 0 THEN o_custkey END AS o_custkey FROM orders), "
               "g AS (SELECT o_custkey AS k, row_number() OVER (ORDER BY "
               + sql_hash("coalesce(CAST(o_custkey AS VARCHAR), chr(0) || 'null')", 666)
               + ") AS rn, count(*) OVER () AS n FROM (SELECT DISTINCT o_custkey FROM o))")


def _grouped_orders(spark, d):
    return table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_custkey") % 7 != 0, F.col("o_custkey")).alias("o_custkey"))


@query(f"WITH {_SQL_GROUPS} SELECT o_orderkey, coalesce(o_custkey, -1) AS o_custkey, CASE WHEN rn <= floor(n * 0.7e0) THEN 'train' "
       "WHEN rn <= floor(n * 0.7e0) + floor(n * 0.15e0) THEN 'val' ELSE 'test' END AS split "
       "FROM o JOIN g ON o.o_custkey IS NOT DISTINCT FROM g.k")
def split_group(spark, d):
    return splits.split_by_group(_grouped_orders(spark, d), "o_custkey").fillna({"o_custkey": -1})


_SIZES = ("c AS (SELECT quality, count(*) AS n, CAST(count(*) AS DOUBLE) * (t - ceil(round(t * 0.2e0, 9))) / t AS e, "
          "CAST(t - ceil(round(t * 0.2e0, 9)) AS BIGINT) AS n_train FROM labels, (SELECT count(*) AS t FROM labels) "
          "GROUP BY quality, t), "
          "s AS (SELECT quality, n, CAST(floor(e) AS BIGINT) + CASE WHEN row_number() OVER "
          "(ORDER BY round(e - floor(e), 9) DESC, quality) <= n_train - sum(CAST(floor(e) AS BIGINT)) OVER () "
          "THEN 1 ELSE 0 END AS n_tr FROM c)")


@query(f"WITH {_SIZES}, r AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY "
       f"{sql_hash('doc_id', 42)}) AS rn FROM labels) "
       "SELECT doc_id, quality, CASE WHEN rn <= n - n_tr THEN 'val' ELSE 'train' END AS split FROM r JOIN s USING (quality)")
def split_stratified(spark, d):
    return splits.split_stratified(table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "quality")


@query("SELECT doc_id, CAST(CASE WHEN rn <= (n // 5 + 1) * (n % 5) THEN (rn - 1) // (n // 5 + 1) "
       "ELSE n % 5 + (rn - 1 - (n // 5 + 1) * (n % 5)) // (n // 5) END AS INTEGER) AS fold FROM (SELECT doc_id, "
       f"row_number() OVER (ORDER BY {sql_hash('doc_id', 42)}) AS rn, count(*) OVER () AS n FROM labels)")
def kfold(spark, d):
    return splits.kfold(table(spark, d, "labels").select("doc_id"), "doc_id")


# Classes are laid end to end and dealt to the folds in turn.
SQL_STRATIFIED_FOLDS = (
    "dealt AS (SELECT quality, (row_number() OVER (ORDER BY quality) - 1) % 5 AS f FROM labels), "
    "quota AS (SELECT quality, f, sum(count(*)) OVER (PARTITION BY quality ORDER BY f) AS upto FROM dealt GROUP BY quality, f), "
    "ranked AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY "
    f"{sql_hash('doc_id', 42)}) AS rn FROM labels), "
    "folds AS (SELECT doc_id, quality, CAST(min(f) AS INTEGER) AS fold FROM ranked JOIN quota USING (quality) "
    "WHERE rn <= upto GROUP BY doc_id, quality)")


@query(f"WITH {SQL_STRATIFIED_FOLDS} SELECT * FROM folds")
def kfold_stratified(spark, d):
    return splits.kfold_stratified(table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "quality")


@query(f"WITH {_SQL_GROUPS} SELECT o_orderkey, coalesce(o_custkey, -1) AS o_custkey, CASE WHEN rn <= floor(n * 0.7e0) THEN 'train' ELSE 'val' END AS split "
       "FROM o JOIN g ON o.o_custkey IS NOT DISTINCT FROM g.k WHERE rn <= floor(n * 0.7e0) + floor(n * 0.15e0)")
def union_train_val(spark, d):
    return splits.train_and_val(split_group(spark, d))


@query("SELECT lang, count(*) AS n FROM documents GROUP BY lang")
def label_distribution(spark, d):
    return contrast.label_distribution(table(spark, d, "documents"), "lang")


# --- saved tables ---------------------------------------------------------------

@query("WITH w AS (SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS idx "
       "FROM embeddings), s AS (SELECT vec_id, CASE WHEN row_number() OVER (ORDER BY "
       f"{sql_hash('vec_id', 42)}) <= floor(0.7e0 * (SELECT count(*) FROM embeddings)) THEN 'train' ELSE 'test' END AS split "
       "FROM embeddings) SELECT vec_id, split, label, idx, round(CAST(x AS DOUBLE), 6) AS value "
       "FROM w JOIN s USING (vec_id) WHERE x <> 0")
def feature_table_round_trip(spark, d):
    """Feature rows saved by split and read back, split by split."""
    e = splits.split_shuffled(table(spark, d, "embeddings"), "vec_id", ratios=[0.7], names=("train", "test"))
    long = e.select("vec_id", "split", "label", F.inline(feats.places(F.col("embedding"), 0)))
    path = scratch(spark)
    artifacts.save_features(long, path)
    back = artifacts.load_features(spark, path, "train").unionByName(artifacts.load_features(spark, path, "test"))
    return back.select("vec_id", "split", "label", "idx", F.round("value", 6).alias("value"))
