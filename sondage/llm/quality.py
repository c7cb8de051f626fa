"""Quality by votes of the nearest labelled documents in a latent-semantic space.

A document is counted as byte trigrams (hashed) and trigrams of character classes, weighed by
logarithm and inverse document frequency, and projected on the leading singular vectors of the
labelled sample. The labelled vectors, a table of stated size, go to every task; each document
is compared with all of them in blocks of exact cosine products and takes the labels of its
nearest neighbours, weighed by similarity.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batch_texts, field_type, held_out, id_and_text, map_batches, sample_per_class, share

PER_CLASS = 1200          # labelled documents per class that are fitted on and compared with, at most
DIMENSIONS = 64
NEIGHBOURS = 25
HASHED, CLASSED = 4096, 4096
_CHUNK = 1 << 20
_BLOCK = 256


def _byte_classes() -> np.ndarray:
    """Sixteen kinds of bytes: controls, line ends, blanks, digits, lower, upper, lead and following
    bytes of longer characters, and the common punctuation by itself."""
    kind = np.zeros(256, np.uint8)
    kind[[10, 13]], kind[[9, 32]] = 1, 2
    kind[48:58], kind[97:123], kind[65:91] = 3, 4, 5
    kind[128:192], kind[192:256] = 6, 7
    punctuation = [i for i in range(33, 127) if not kind[i]]
    kind[punctuation] = 15
    for i, c in enumerate(".,!?|'\"", start=8):
        kind[ord(c)] = i
    return kind


_KIND = _byte_classes().astype(np.uint32)
_LOWER = np.array([b + 32 if 65 <= b < 91 else b for b in range(256)], np.uint32)


def counts(text: bytes) -> np.ndarray:
    """Trigram counts of a whole text, the hashed ones first; long texts are counted piece by piece."""
    total = np.zeros(HASHED + CLASSED, np.int64)
    for at in range(0, max(len(text) - 2, 0), _CHUNK):
        raw = np.frombuffer(text[at:at + _CHUNK + 2], np.uint8)
        low, kind = _LOWER[raw], _KIND[raw]
        code = (low[:-2] << 16) | (low[1:-1] << 8) | low[2:]
        total[:HASHED] += np.bincount((code * np.uint32(2654435761)) >> np.uint32(20), minlength=HASHED)
        total[HASHED:] += np.bincount((kind[:-2] << 8) | (kind[1:-1] << 4) | kind[2:], minlength=CLASSED)
    return total


def _normal(rows: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, size, out=np.zeros_like(rows), where=size > 0)


class Model:
    """Projection, labelled vectors and their labels."""

    def __init__(self, vectors: np.ndarray, labels: np.ndarray, dimensions: int = DIMENSIONS, seed: int = 11):
        n = len(vectors)
        seen = (vectors > 0).sum(axis=0)
        self.idf = np.log((n + 1) / (seen + 1)).astype(np.float32) + 0.1
        weighed = self.weigh(vectors)
        rank = min(dimensions, *weighed.shape) if n else 0
        rng = np.random.default_rng(seed)
        # Randomised range finder with two power steps, then the singular vectors within the range.
        basis = weighed.T @ rng.standard_normal((n, min(rank + 16, n))).astype(np.float32)
        for _ in range(2):
            basis, _ = np.linalg.qr(basis)
            basis = weighed.T @ (weighed @ basis)
        basis, _ = np.linalg.qr(basis)
        if n:
            _, _, right = np.linalg.svd(weighed @ basis, full_matrices=False)
            basis = basis @ right[:rank].T
        self.basis = np.ascontiguousarray(basis, np.float32)
        self.latent = _normal(weighed @ self.basis).astype(np.float32)
        self.labels = labels.astype(np.float32)
        self.prior = float(labels.mean()) if n else 0.5

    def weigh(self, vectors: np.ndarray) -> np.ndarray:
        """Logarithm, inverse document frequency, and unit length for each of the two kinds of trigrams."""
        rows = np.log1p(vectors.astype(np.float32)) * self.idf
        return np.concatenate([_normal(rows[:, :HASHED]), _normal(rows[:, HASHED:])], axis=1)

    def score(self, vectors: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
        """Weighted share of label 1 among the nearest labelled vectors; the share of all where nothing is alike."""
        out = np.full(len(vectors), self.prior)
        if not len(self.labels):
            return out
        alike = _normal(self.weigh(vectors) @ self.basis) @ self.latent.T
        k = min(neighbours, len(self.labels))
        near = np.argpartition(-alike, k - 1, axis=1)[:, :k]
        weight = np.clip(np.take_along_axis(alike, near, 1), 0, None).astype(np.float64)
        total = weight.sum(axis=1)
        some = total > 1e-9
        out[some] = (weight * self.labels[near]).sum(axis=1)[some] / total[some]
        return np.clip(out, 0.0, 1.0)


def _sparse(texts: list[bytes]) -> tuple[list[bytes], list[bytes]]:
    places, values = [], []
    for t in texts:
        c = counts(t)
        at = np.flatnonzero(c)
        places.append(at.astype(np.uint16).tobytes())
        values.append(c[at].astype(np.int32).tobytes())
    return places, values


def train(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", per_class: int = PER_CLASS) -> Model:
    """Fit on at most ``per_class`` documents of each label (0, 1) among the label rows where ``learn`` holds.

    Contradicting labels of one id count as 0. The counting runs where the texts are; only the
    sparse counts of the sample reach the driver."""
    marked = (labels.filter(learn).select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label"))
              .filter("doc_id IS NOT NULL AND label IN (0, 1)").groupBy("doc_id").agg(F.min("label").alias("label")))
    chosen = sample_per_class(marked, "doc_id", "label", per_class, "quality")
    rows = id_and_text(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        places, values = _sparse(batch_texts(batch))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(places, pa.binary()),
                                           pa.array(values, pa.binary())], ["doc_id", "label", "places", "values"])
    found = map_batches(rows, run, f"doc_id {field_type(rows, 'doc_id')}, label int, places binary, values binary")
    found = sorted(found.dropDuplicates(["doc_id", "places", "values"]).collect(), key=lambda r: (r["doc_id"], r["places"], r["values"]))
    vectors = np.zeros((len(found), HASHED + CLASSED), np.int32)
    for row, r in zip(vectors, found):
        row[np.frombuffer(r["places"], np.uint16)] = np.frombuffer(r["values"], np.int32)
    return Model(vectors, np.array([r["label"] for r in found], np.float32))


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, score, predicted``.

    Null, empty and two-character texts have no trigrams: their score is the share of label 1 in
    the sample. Rows repeat as they come; whole texts are counted; an empty table gives no rows."""
    rows = id_and_text(docs, id_col, text_col)
    model_of = share(docs.sparkSession, model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, score = batch_texts(batch), []
        for at in range(0, len(texts), _BLOCK):
            score.append(model_of().score(np.stack([counts(t) for t in texts[at:at + _BLOCK]])))
        score = np.concatenate(score)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                                          ["doc_id", "score", "predicted"])
    return map_batches(rows, run, f"doc_id {field_type(rows, 'doc_id')}, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame, folds: int = 3, fold: int = 1, label_col: str = "quality") -> DataFrame:
    """``doc_id, held_out, score, predicted``: learn from the labels outside one fold, score every document."""
    model = train(docs, labels, ~held_out("doc_id", folds, fold), label_col=label_col)
    return predict(docs, model).withColumn("held_out", held_out("doc_id", folds, fold)).select("doc_id", "held_out", "score", "predicted")
