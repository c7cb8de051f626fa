"""The corpus pipeline as a whole and stage by stage."""

from __future__ import annotations

import corpus_pipeline
from compare import SF_DIR
from sondage.operators.distribute import materialize


def test_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "exact dedup", "simhash near-dedup", "mixing", "bpe"]
    source = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = {r["doc_id"] for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").filter("quality = 1 AND toxic = 0").collect()}
    docs, sizes = source, [source.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"] for r in docs.select("doc_id").collect()}
        docs = materialize(stage(spark, docs, SF_DIR))
        assert docs.columns == source.columns
        after = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert after <= before
        if name in ("language", "mixing"):
            assert len(after & labels) >= 0.9 * len(before & labels)
        sizes.append(docs.count())
    assert docs.count() == docs.select("doc_id").distinct().count() == docs.select("text").distinct().count()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert last.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and last.count() == sizes[-1] and sizes == sorted(sizes, reverse=True)


def test_messy_tables(spark, tmp_path, docs):
    """Null, empty, repeated and very long texts, null and repeated ids, clashing columns; then no rows at all."""
    labels = spark.createDataFrame([(1, 1, 0), (7, 1, 0), (8, 0, 1), (None, 1, None), (9, None, None)], "doc_id long, quality int, toxic int")
    for name, rows, marked in (("some", docs, labels), ("no_labels", docs, labels.limit(0)), ("none", docs.limit(0), labels)):
        folder = str(tmp_path / name)
        rows.write.parquet(f"{folder}/documents.parquet")
        marked.write.parquet(f"{folder}/labels.parquet")
        step = spark.read.parquet(f"{folder}/documents.parquet")
        for _, stage in corpus_pipeline.STAGES[:-1]:
            before = {(r["doc_id"], r["text"]) for r in step.collect()}
            step = materialize(stage(spark, step, folder))
            assert step.columns == docs.columns and {(r["doc_id"], r["text"]) for r in step.collect()} <= before
        assert step.count() == step.select("doc_id", "text").distinct().count()
        got = corpus_pipeline.run(spark, folder).collect()
        assert len(got) == step.count() and (len(got) > 0) == (name != "none")
