"""Rating and multi-select queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import options as op, ratings as rt
from ..operators import answers
from .registry import query, sql_list, table

# Rules over part names; "old" also matches inside "cold", which tests the order.
PART_RULES = (
    ("small", "Small"), ("red", "Red"), ("ring", "Ring"), ("old", "Old or cold"),
    ("cold", "Cold"), ("gear", "Gear"), ("eco", "Economy"), ("promo", "Promo"),
)
PART_OPTIONS = tuple(o for _, o in PART_RULES)
PART_TARGETS = ("small", "red", "ECONOMY", "LARGE")


# --- ratings -----------------------------------------------------------------

def rated_orders(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 97 == 0, F.lit("99999999999 - beyond an int"))
        .when(F.col("o_orderkey") % 11 != 0, F.col("o_orderpriority")).alias("answer"),
        F.when(F.col("o_orderkey") % 5 != 0, F.concat("o_orderstatus", "o_orderpriority"))
        .otherwise(F.col("o_orderpriority")).alias("other"))


SQL_RATED = ("r AS (SELECT o_orderkey, CASE WHEN o_orderkey % 97 = 0 THEN '99999999999 - beyond an int' WHEN o_orderkey % 11 <> 0 THEN o_orderpriority END AS answer, "
             "CASE WHEN o_orderkey % 5 <> 0 THEN o_orderstatus || o_orderpriority ELSE o_orderpriority END AS other "
             "FROM orders)")


def sql_rating(c: str) -> str:
    return f"TRY_CAST(nullif(regexp_extract({c}, '^(\\d+)', 1), '') AS BIGINT)"


def sql_mode(c: str, rows: str) -> str:
    """Most frequent rating, the smallest on ties."""
    return (f"(SELECT m FROM (SELECT {sql_rating(c)} AS m FROM {rows}) WHERE m IS NOT NULL "
            f"GROUP BY m ORDER BY count(*) DESC, m LIMIT 1)")


@query(f"WITH {SQL_RATED} SELECT o_orderkey, CAST({sql_rating('answer')} AS DOUBLE) AS a, "
       f"CAST({sql_rating('other')} AS DOUBLE) AS b FROM r")
def rating_extract(spark, d):
    return rated_orders(spark, d).select("o_orderkey", *[
        rt.rating(c).cast("double").alias(n) for c, n in (("answer", "a"), ("other", "b"))])


@query(f"WITH {SQL_RATED} SELECT o_orderkey, coalesce({sql_rating('answer')}, 3) AS a, "
       f"coalesce({sql_rating('other')}, 3) AS b FROM r")
def rating_default3(spark, d):
    return rated_orders(spark, d).select(
        "o_orderkey", rt.rating_or_middle("answer").alias("a"), rt.rating_or_middle("other").alias("b"))


@query(f"WITH {SQL_RATED} SELECT 'answer' AS question, {sql_mode('answer', 'r')} AS mode "
       f"UNION ALL SELECT 'other', {sql_mode('other', 'r')}")
def rating_mode(spark, d):
    modes = answers.rating_modes(rated_orders(spark, d), ["answer", "other"])
    return spark.createDataFrame(list(modes.items()), "question string, mode bigint")


@query(f"WITH {SQL_RATED} SELECT o_orderkey, coalesce({sql_rating('answer')}, {sql_mode('answer', 'r')}) AS answer, "
       f"coalesce({sql_rating('other')}, {sql_mode('other', 'r')}) AS other FROM r")
def rating_mode_impute(spark, d):
    return answers.impute_ratings(rated_orders(spark, d), ["answer", "other"])


@query(f"WITH {SQL_RATED} SELECT o_orderkey, (coalesce({sql_rating('answer')}, {sql_mode('answer', 'r')}) - 1) / 4.0e0 "
       f"AS answer, (coalesce({sql_rating('other')}, {sql_mode('other', 'r')}) - 1) / 4.0e0 AS other FROM r")
def rating_scaled(spark, d):
    return answers.impute_ratings(rated_orders(spark, d), ["answer", "other"], scale=True)


@query(f"WITH {SQL_RATED} SELECT o_orderkey, level, CAST(CASE WHEN coalesce({sql_rating('answer')}, 3) = level "
       "THEN 1 ELSE 0 END AS DOUBLE) AS value FROM r, (SELECT CAST(unnest(range(1, 6)) AS INTEGER) AS level)")
def rating_onehot(spark, d):
    hot = rt.one_hot(rt.rating_or_middle("answer"))
    return (rated_orders(spark, d).select("o_orderkey", F.posexplode(hot).alias("pos", "value"))
            .select("o_orderkey", (F.col("pos") + 1).alias("level"), "value"))


# --- multi-select --------------------------------------------------------------

def part_answers(spark, d):
    return table(spark, d, "part").select(
        "p_partkey",
        F.when(F.col("p_partkey") % 17 != 0,
               F.concat(F.regexp_replace("p_name", " ", ", "), F.lit(", "), F.col("p_type"))).alias("q1"),
        F.when(F.col("p_partkey") % 7 != 0, F.concat(F.upper("p_name"), F.lit(",\n"), F.col("p_type")))
        .otherwise("").alias("q2"))


SQL_PARTS = ("p AS (SELECT p_partkey, CASE WHEN p_partkey % 17 <> 0 THEN replace(p_name, ' ', ', ') || ', ' || p_type "
             "END AS q1, CASE WHEN p_partkey % 7 <> 0 THEN upper(p_name) || ',' || chr(10) || p_type ELSE '' END AS q2 "
             "FROM part)")


def sql_by_part(c: str) -> str:
    rule = " ".join(f"WHEN contains(x, '{k}') THEN '{o}'" for k, o in PART_RULES)
    return (f"coalesce(list_sort(list_distinct(list_filter(list_transform(string_split(lower(replace(replace("
            f"{c}, chr(10), ' '), chr(13), ' ')), ','), lambda x: CASE {rule} END), "
            f"lambda x: x IS NOT NULL))), [])")


def sql_anywhere(c: str) -> str:
    hits = ", ".join(f"CASE WHEN contains(lower({c}), '{k}') THEN '{o}' END" for k, o in PART_RULES)
    return f"list_sort(list_distinct(list_filter([{hits}], lambda x: x IS NOT NULL)))"


def sql_among(c: str) -> str:
    return f"list_filter([{sql_list(PART_TARGETS)}], lambda t: coalesce(contains({c}, t), false))"


def _both(spark, d, parse):
    return part_answers(spark, d).select(
        "p_partkey", *[F.array_join(parse(q), "|").alias(q) for q in ("q1", "q2")])


def _sql_both(parse) -> str:
    return (f"WITH {SQL_PARTS} SELECT p_partkey, coalesce(array_to_string({parse('q1')}, '|'), '') AS q1, "
            f"coalesce(array_to_string({parse('q2')}, '|'), '') AS q2 FROM p")


@query(_sql_both(sql_by_part))
def multi_parse_parts(spark, d):
    return _both(spark, d, lambda q: op.options_by_part(q, PART_RULES))


@query(_sql_both(sql_anywhere))
def multi_parse_whole(spark, d):
    return _both(spark, d, lambda q: op.options_anywhere(q, PART_RULES))


@query(_sql_both(sql_among))
def multi_parse_targets(spark, d):
    return _both(spark, d, lambda q: op.options_among(q, PART_TARGETS))


_OPTION_ROWS = "(SELECT unnest([" + sql_list(PART_OPTIONS) + "]) AS option, unnest(range(0, 8)) AS idx)"


@query(f"WITH {SQL_PARTS}, s AS (SELECT unnest({sql_by_part('q1')}) AS option FROM p) "
       f"SELECT option, idx, count(s.option) AS n FROM {_OPTION_ROWS} LEFT JOIN s USING (option) GROUP BY option, idx")
def multi_option_vocabulary(spark, d):
    """Every listed option in its fixed place, with the number of answers that chose it."""
    hot = op.multi_hot(op.options_by_part("q1", PART_RULES), PART_OPTIONS)
    sums = part_answers(spark, d).select(hot.alias("h")).agg(
        *[F.sum(F.get("h", F.lit(i))).alias(f"n{i}") for i in range(len(PART_OPTIONS))])
    return sums.select(F.inline(F.array(*[
        F.struct(F.lit(o).alias("option"), F.lit(i).cast("long").alias("idx"), F.col(f"n{i}").alias("n"))
        for i, o in enumerate(PART_OPTIONS)])))


@query(f"WITH {SQL_PARTS}, s AS (SELECT p_partkey, 0 AS base, {sql_by_part('q1')} AS sel FROM p UNION ALL "
       f"SELECT p_partkey, 8, {sql_by_part('q2')} FROM p) SELECT p_partkey, base + idx AS idx, "
       f"CAST(list_contains(sel, option) AS INTEGER) AS value FROM s, {_OPTION_ROWS}")
def multi_hot(spark, d):
    hot = F.concat(*[op.multi_hot(op.options_by_part(q, PART_RULES), PART_OPTIONS) for q in ("q1", "q2")])
    return (part_answers(spark, d).select("p_partkey", F.posexplode(hot).alias("idx", "value"))
            .select("p_partkey", F.col("idx").cast("long").alias("idx"), "value"))


_SORTED_ROWS = ("(SELECT option, row_number() OVER (ORDER BY option) - 1 AS idx FROM (SELECT unnest(["
                + sql_list(PART_OPTIONS) + "]) AS option))")


@query(f"WITH {SQL_PARTS}, s AS (SELECT p_partkey, {sql_anywhere('q1')} AS sel FROM p) SELECT p_partkey, idx, "
       f"CAST(list_contains(sel, option) AS INTEGER) AS value FROM s, {_SORTED_ROWS}")
def multi_hot_sorted(spark, d):
    hot = op.multi_hot(op.options_anywhere("q1", PART_RULES), sorted(PART_OPTIONS))
    return (part_answers(spark, d).select("p_partkey", F.posexplode(hot).alias("idx", "value"))
            .select("p_partkey", F.col("idx").cast("long").alias("idx"), "value"))


@query(f"WITH {SQL_PARTS}, s AS (SELECT p_partkey, {sql_among('q1')} AS sel FROM p), "
       "o AS (SELECT option, row_number() OVER (ORDER BY option) - 1 AS idx FROM "
       "(SELECT DISTINCT unnest(sel) AS option FROM s)) "
       "SELECT p_partkey, idx, option, CAST(list_contains(sel, option) AS INTEGER) AS value FROM s, o")
def multi_hot_learned(spark, d):
    rows = part_answers(spark, d)
    seen = answers.target_options(rows, "q1", PART_TARGETS)
    hot = op.multi_hot(op.options_among("q1", PART_TARGETS), seen)
    names = F.array(*[F.lit(s) for s in seen])
    return (rows.select("p_partkey", F.posexplode(hot).alias("idx", "value"))
            .select("p_partkey", F.col("idx").cast("long").alias("idx"), F.get(names, F.col("idx")).alias("option"),
                    "value"))


_PAIRS = ", ".join(f"CAST(list_contains(u, '{PART_OPTIONS[i]}') AND list_contains(u, '{PART_OPTIONS[j]}') AS INTEGER)"
                   for i in range(8) for j in range(i + 1, 8))


@query(f"WITH {SQL_PARTS}, s AS (SELECT p_partkey, list_distinct({sql_by_part('q1')} || {sql_by_part('q2')}) AS u "
       f"FROM p) SELECT p_partkey, unnest(range(0, 28)) AS idx, unnest([{_PAIRS}]) AS value FROM s")
def multi_pairs(spark, d):
    union = F.array_union(*[op.options_by_part(q, PART_RULES) for q in ("q1", "q2")])
    rows = part_answers(spark, d).select("p_partkey", union.alias("u"))
    return (rows.select("p_partkey", F.posexplode(op.pair_flags(F.col("u"), PART_OPTIONS)).alias("idx", "value"))
            .select("p_partkey", F.col("idx").cast("long").alias("idx"), "value"))


@query(f"WITH {SQL_PARTS} SELECT p_partkey, round(ln(1 + len({sql_by_part('q1')})), 6) AS q1, "
       f"round(ln(1 + len({sql_by_part('q2')})), 6) AS q2 FROM p")
def multi_count_log1p(spark, d):
    return part_answers(spark, d).select("p_partkey", *[
        F.round(op.log_count(op.options_by_part(q, PART_RULES)), 6).alias(q) for q in ("q1", "q2")])
