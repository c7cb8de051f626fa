from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
for path in (ROOT, os.path.join(ROOT, "tests")):
    if path not in sys.path:
        sys.path.insert(0, path)

#: Null id, null and empty texts, white space only, no letters, repeated rows, ties, one very long text.
TEXTS = [
    (1, "The cat sat on the mat and the dog sat on the rug", "en"), (2, "The cat sat on the mat and the dog sat on the rug", "en"),
    (2, "The cat sat on the mat and the dog sat on the rug", "en"), (3, None, "en"), (4, "", None), (5, " \n\t ", "de"), (6, "12345 !!! ???", "en"),
    (7, "Der Hund liegt auf der Matte und die Katze auf dem Teppich", "de"), (8, "Le chat est sur le tapis et le chien aussi", "fr"),
    (9, "x", "en"), (10, "a b", None), (None, "A row without an id", "en"), (11, "Ünïcödé \U0001f642 日本語 ſ K", None),
    (12, "very long words and lines " * 20_000, "en"), (13, "the cat sat on the mat and the dog sat on the rug", "en"),
]
EXTRA = "label string, score string, kept string, fp string, component_id string, key string, word string, row string, list string"


@pytest.fixture(scope="session")
def docs(spark):
    schema = f"doc_id long, text string, lang string, source string, {EXTRA}"
    return spark.createDataFrame([(*r, "s", *(["clash"] * 9)) for r in TEXTS], schema).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark, docs):
    return spark.createDataFrame([], docs.schema)
