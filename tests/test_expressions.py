"""Column expressions against hand rows and plain statements of the rules."""

from __future__ import annotations

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sondage.functions import options as op, ratings as rt, text as tx
from sondage.functions.fixed import (
    CLEAN_STOP, ENGLISH_STOP, OPTION_RULES, OPTIONS, POOLED_STOP, SHORT_STOP)


def column(spark, values, expression, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [r["r"] for r in rows.select("i", expression(F.col("c")).alias("r")).orderBy("i").collect()]


def test_fixed_lists():
    assert len(set(ENGLISH_STOP)) == 179 and len(set(POOLED_STOP)) == 186
    assert len(set(CLEAN_STOP)) == 188 and len(set(SHORT_STOP)) == 21
    assert len(OPTIONS) == 8 and len(OPTION_RULES) == 11


def test_tokens(spark):
    got = column(spark, ["Don't use résumés_2 naïve; 3.5", None, ""], tx.tokens)
    assert got == [["don", "t", "use", "résumés_2", "naïve", "3", "5"], [], []]
    assert column(spark, ["It is the best in class"], lambda c: tx.tokens(c, SHORT_STOP)) == [["best", "class"]]
    assert column(spark, [3.5, None], tx.tokens, "double") == [["3", "5"], []]


def test_nested_tokens(spark):
    got = column(spark, [["Ab c", None, "d"], None, []], tx.nested_tokens, "array<string>")
    assert got == [["ab", "c", "d"], [], []]


def test_ngrams(spark):
    got = column(spark, ["debugging code issues", "a", ""], lambda c: tx.ngrams(tx.tokens(c), 2))
    assert got == [["debugging code", "code issues"], [], []]
    assert column(spark, ["a b c d"], lambda c: tx.ngrams(tx.tokens(c), 3)) == [["a b c", "b c d"]]
    assert column(spark, ["a b"], tx.tokens_and_bigrams) == [["a", "b", "a b"]]


def test_clean_text(spark):
    stop = ["the", "and", "task", "use", "model"]
    rows = ["Debugging the codes, and résumés!", "tasks: class doing red eds", "used 3x models", None]
    assert column(spark, rows, lambda c: tx.clean_text(c, stop)) == ["debugg code sum", "task class", "model", ""]


def test_term_counts(spark):
    got = column(spark, ["b a b", "", None, "x"], lambda c: tx.term_counts(tx.tokens(c)))
    assert [[(t["term"], t["tf"]) for t in row] for row in got] == [[("a", 1), ("b", 2)], [], [], [("x", 1)]]


def test_log_length(spark):
    assert column(spark, ["a b", None], lambda c: F.round(tx.log_length(tx.tokens(c)), 6)) == [1.098612, 0.0]


def test_rating(spark):
    rows = ["3 - Sometimes", "10x", "4.0", " 3", "n/a", None, "-2", "99999999999"]
    assert column(spark, rows, rt.rating) == [3, 10, 4, None, None, None, None, 99999999999]
    assert column(spark, ["9" * 18, "9" * 30], rt.rating) == [10**18 - 1, None]
    assert column(spark, rows[:6], rt.rating_or_middle) == [3, 10, 4, 3, 3, 3]


def test_one_hot(spark):
    assert column(spark, [4, 7, None], rt.one_hot, "int") == [[0, 0, 0, 1, 0], [0] * 5, [0] * 5]


MATH, CODE, DRAFT, CONVERT = OPTIONS[0], OPTIONS[1], OPTIONS[6], OPTIONS[7]


@pytest.mark.parametrize("cell,parts,anywhere", [
    ("Math computations,Writing or debugging code", [MATH, CODE], [MATH, CODE]),
    (DRAFT, [DRAFT], [DRAFT]),
    (CONVERT, [CONVERT], [CONVERT]),
    ("math\ncomputations", [MATH], []),
    ("Math computations in LaTeX", [MATH], [CONVERT, MATH]),
    ("", [], []), (None, [], []), ("none of these,,", [], []),
])
def test_options(spark, cell, parts, anywhere):
    got = spark.createDataFrame([(cell,)], "c string").select(
        op.options_by_part("c").alias("a"), op.options_anywhere("c").alias("b")).first()
    assert got["a"] == sorted(parts) and got["b"] == sorted(anywhere)


def test_targets_and_pairs(spark):
    assert column(spark, ["math computations", "Math computations", None], op.options_among) == [[], [MATH], []]
    row = spark.createDataFrame([([OPTIONS[0], OPTIONS[2], OPTIONS[3]],)], "s array<string>")
    flags = row.select(op.pair_flags(F.col("s")).alias("p")).first()["p"]
    assert len(flags) == 28 and [i for i, f in enumerate(flags) if f] == [1, 2, 13]
    assert row.select(op.multi_hot(F.col("s")).alias("h")).first()["h"] == [1, 0, 1, 1, 0, 0, 0, 0]


# Characters on which the case rules of the two languages agree.
TEXT = st.text(alphabet=st.sampled_from(list("aBé_ñ9 ,.;'-\n\tЖß漢²½")), max_size=30)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(TEXT, min_size=1, max_size=20))
def test_tokens_like_word_pattern(spark, cells):
    assert column(spark, cells, tx.tokens) == [re.findall(r"\w+", c.lower()) for c in cells]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="0123 -xa.", max_size=6), min_size=1, max_size=20))
def test_rating_like_leading_digits(spark, cells):
    def lead(c):
        m = re.match(r"\d+", c)
        return int(m.group()) if m else None
    assert column(spark, cells, rt.rating) == [lead(c) for c in cells]


PIECES = [k for k, _ in OPTION_RULES] + ["other", " ", "LaTeX", ",", ",", "\n"]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=6).map("".join), min_size=1, max_size=20))
def test_options_by_part_like_first_rule(spark, cells):
    def first_rules(c):
        found = set()
        for part in c.lower().replace("\n", " ").split(","):
            found |= set([o for k, o in OPTION_RULES if k in part][:1])
        return sorted(found)
    assert column(spark, cells, op.options_by_part) == [first_rules(c) for c in cells]


def test_expressions_accept_a_stream(spark, tmp_path):
    spark.createDataFrame([("3 - a b",)], "c string").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("c string").parquet(str(tmp_path / "in")).select(
        rt.rating("c").alias("r"), tx.tokens("c").alias("t"))
    job = stream.writeStream.format("memory").queryName("once").trigger(availableNow=True).option(
        "checkpointLocation", str(tmp_path / "state")).start()
    job.awaitTermination(60)
    assert [tuple(r) for r in spark.table("once").collect()] == [(3, ["3", "a", "b"])]
