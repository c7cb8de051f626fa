from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
for path in (ROOT, os.path.join(ROOT, "tests")):
    if path not in sys.path:
        sys.path.insert(0, path)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g")
        .config("spark.driver.host", "127.0.0.1").config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def survey_rows(spark):
    """30 students x 3 labels with missing cells, blank labels and odd texts."""
    labels = ("ChatGPT", "Claude", "Gemini")
    opts = ("Math computations", "Writing or debugging code", "Drafting professional text (e.g., résumés, emails)",
            "Converting content between formats (e.g., LaTeX)")
    words = ("debug code fast", "write essays, \"drafts\" and notes", "explain\nmaths résumés", "search the web")
    rows = []
    for i in range(90):
        who, lab = i // 3, labels[i % 3]
        rows.append((
            f"s{who:02d}", f"{words[i % 4]} {words[(i // 2) % 4]} {lab.lower()}", None if i % 10 == 3 else f"{i % 5 + 1} - x",
            None if i % 7 == 0 else ",".join({opts[i % 4], opts[(i * 3 + 1) % 4]}), f"{(i * 3) % 5 + 1} - y",
            opts[(i + 1) % 4] if i % 6 else "", None if i % 8 == 5 else words[(i + 1) % 4], f"{i % 4 + 1}", f"{(i + 2) % 5 + 1} z",
            f"note {i % 9}", lab if i % 15 else (None if i % 2 else " ")))
    names = ["student_id", "text_1", "rating_2", "multi_3", "rating_4", "multi_5", "text_6", "rating_7", "rating_8",
             "text_9", "label"]
    schema = "row_id long, " + ", ".join(f"{n} string" for n in names)
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], schema)
