"""Mixing domains to target weights when documents belong to domains only to a degree.

A softmax classifier, fitted on labelled documents, gives each document posteriors over the
domains. Document rates (how often a document is taken, on average) are then fitted by projected
gradient least squares, so that the expected tokens of each domain, rate x tokens x posterior
summed over all documents, come to given targets. Every step is one aggregation over a small
table of posteriors; the driver sees sums per domain only. Rates are not stored between steps:
a document's rate follows from the short history of steps, each a value per domain.
"""

from __future__ import annotations

import warnings
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.distribute import materialize
from .common import batch_texts, field_type, id_and_text, map_batches, sample_per_class, share

PER_DOMAIN = 1200         # labelled documents per domain that are fitted on, at most
FEATURES = 3_000          # words of the sample that the classifier looks at, at most: those that tell domains apart,
LEAST_CHI2 = 20.0         # by the chi-square of their presence, which chance alone hardly reaches
STEPS = 30
_LEAST_DOCS = 5
LONGEST_WORD = 100        # bytes of a word that can be a feature
TOLERANCE = 1e-4

#: Domains of the labelled table: what a label row says about its document.
DOMAINS = {"clean": "quality = 1 AND coalesce(toxic, 0) = 0", "poor": "quality = 0", "toxic": "toxic = 1 AND quality = 1"}


#: Outer and inner punctuation to blanks, A-Z to a-z.
_PLAIN = bytes(b + 32 if 65 <= b < 91 else 32 if b < 128 and not chr(b).isalnum() else b for b in range(256))


def word_set(text: bytes) -> tuple[int, set[bytes]]:
    """Number of words, and the distinct ones: as they are written, and in lower case without punctuation."""
    words = text.split()
    return len(words), set(words).union(text.translate(_PLAIN).split())


def _shape(text: bytes) -> tuple[float, float, float]:
    """Shares of capitals among ASCII letters, of punctuation and digits among all bytes."""
    raw = np.frombuffer(text, np.uint8)
    if not len(raw):
        return 0.0, 0.0, 0.0
    n = np.bincount(raw, minlength=256)
    upper, lower = n[65:91].sum(), n[97:123].sum()
    marks = n[33:48].sum() + n[58:65].sum() + n[91:97].sum() + n[123:127].sum()
    return float(upper / max(upper + lower, 1)), float(marks / len(raw)), float(n[48:58].sum() / len(raw))


class Classifier:
    """Softmax regression on the presence of words and the shape of a text."""

    def __init__(self, words: list[bytes], ids: list[np.ndarray], shape: np.ndarray, labels: list[str], domains: list[str],
                 epochs: int = 30, seed: int = 2, shares: dict[str, float] | None = None):
        """Fit on documents that hold the words numbered ``ids`` among ``words`` and have the given ``shape`` and label."""
        self.domains = list(domains)
        self.number = {w: i for i, w in enumerate(words)}
        k, n = len(self.domains), len(labels)
        gold = np.array([self.domains.index(d) for d in labels], np.int64)
        self.weights, self.bias, self.shape = np.zeros((len(words), k)), np.zeros(k), np.zeros((3, k))
        self.prior = np.zeros(k)
        if not n:
            return
        # The sample has about as many documents of each domain; posteriors are turned to the true shares.
        self.prior = np.log(np.array([(shares or {}).get(d, 0.0) + 1e-6 for d in domains]) / (np.bincount(gold, minlength=k) / len(gold) + 1e-6)) \
            if shares else np.zeros(k)
        held = [np.full(a.shape, 1e-3) for a in (self.weights, self.bias, self.shape)]
        rng = np.random.default_rng(seed)
        for _ in range(epochs):
            order = rng.permutation(n)
            for at in range(0, n, 128):
                batch = order[at:at + 128]
                flat = np.concatenate([ids[i] for i in batch])
                size = np.array([len(ids[i]) for i in batch])
                p = self._posterior(flat, size, shape[batch])
                p[np.arange(len(batch)), gold[batch]] -= 1
                p /= len(batch)
                spread = np.repeat(p, size, axis=0)
                gw = np.stack([np.bincount(flat, spread[:, j], len(words)) for j in range(k)], axis=1) + 1e-5 * self.weights
                for value, grad, total in zip((self.weights, self.bias, self.shape), (gw, p.sum(axis=0), shape[batch].T @ p), held):
                    total += grad * grad
                    value -= 0.2 * grad / np.sqrt(total)

    def _posterior(self, flat: np.ndarray, size: np.ndarray, shape: np.ndarray, prior: np.ndarray | float = 0.0) -> np.ndarray:
        total = np.zeros((len(size), len(self.domains)))
        some = size > 0
        if len(flat):
            total[some] = np.add.reduceat(self.weights[flat], (np.cumsum(size) - size)[some], axis=0)
        total = total + self.bias + shape @ self.shape + prior
        e = np.exp(total - total.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def posteriors(self, texts: list[bytes]) -> tuple[list[int], np.ndarray]:
        """Words and posteriors of each text."""
        known, number = self.number.keys(), self.number
        sets = [word_set(t) for t in texts]
        ids = [[number[w] for w in sorted(known & s)] for _, s in sets]
        return [n for n, _ in sets], self._posterior(np.array([i for row in ids for i in row], np.int64), np.array([len(r) for r in ids]),
                                                     np.array([_shape(t) for t in texts]).reshape(-1, 3), self.prior)


def train(docs: DataFrame, labels: DataFrame, domains: dict[str, str] = DOMAINS, id_col: str = "doc_id", text_col: str = "text",
          per_domain: int = PER_DOMAIN) -> Classifier:
    """Fit on at most ``per_domain`` labelled documents of each domain. A document that the labels put in
    several domains counts for the one named last."""
    place = F.lit(None).cast("int")
    for i, condition in enumerate(domains.values()):
        place = F.when(F.expr(condition), i).otherwise(place)
    marked = labels.select(F.col(id_col).alias("doc_id"), place.alias("place")).filter("doc_id IS NOT NULL AND place IS NOT NULL")
    marked = marked.groupBy("doc_id").agg(F.max("place").alias("place"))
    marked = materialize(marked)
    names = list(domains)
    counts = {names[r["place"]]: r["n"] for r in marked.groupBy("place").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = sample_per_class(marked, "doc_id", "place", per_domain, "domain")
    sample = materialize(id_and_text(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id", "text"]))
    size = {r["place"]: r["n"] for r in sample.groupBy("place").agg(F.count(F.lit(1)).alias("n")).collect()}
    words = telling_words(sample, [size.get(i, 0) for i in range(len(names))])
    words_of = share(docs.sparkSession, {w: i for i, w in enumerate(words)})

    def look(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, number = batch_texts(batch), words_of()
        ids = [sorted(number[w] for w in number.keys() & word_set(t)[1]) for t in texts]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("place"), pa.array(ids, pa.list_(pa.int32())), pa.array([list(_shape(t)) for t in texts], pa.list_(pa.float64())),
             pa.array([zlib.crc32(t) for t in texts], pa.int64())], ["doc_id", "place", "ids", "shape", "mark"])
    seen = map_batches(sample, look, f"doc_id {field_type(sample, 'doc_id')}, place int, ids array<int>, shape array<double>, mark bigint").collect()
    seen = sorted(seen, key=lambda r: (r["doc_id"], r["mark"], r["ids"]))
    return Classifier(words, [np.array(r["ids"], np.int64) for r in seen], np.array([r["shape"] for r in seen]).reshape(-1, 3),
                      [names[r["place"]] for r in seen], names, shares={d: n / sum(counts.values()) for d, n in counts.items()})


def telling_words(sample: DataFrame, size: list[int]) -> list[bytes]:
    """Up to ``FEATURES`` words whose presence tells the domains of ``sample`` (``text, place``) apart, by chi-square; ``size``
    is the number of its documents per place. Words are counted in tasks; of the words only the chosen ones move on."""
    def present(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [[w for w in word_set(t)[1] if len(w) <= LONGEST_WORD] for t in batch_texts(batch)]
        flat = pa.array([w for s in sets for w in s], pa.binary())
        return pa.RecordBatch.from_arrays([flat, batch.column("place").take(pa.array(np.repeat(np.arange(len(sets)), [len(s) for s in sets])))],
                                          ["word", "place"])
    n = [F.coalesce(F.sum((F.col("place") == i).cast("bigint")), F.lit(0)) for i in range(len(size))]
    counts = map_batches(sample.select("text", "place"), present, "word binary, place int").groupBy("word").agg(
        F.count(F.lit(1)).alias("n"), *[c.alias(f"n{i}") for i, c in enumerate(n)]).filter(F.col("n") >= _LEAST_DOCS)
    share_of = F.col("n") / F.lit(float(max(sum(size), 1)))
    strength = sum(((F.col(f"n{i}") - share_of * m) * (F.col(f"n{i}") - share_of * m) / F.greatest(share_of * (1 - share_of) * m, F.lit(1e-9))
                    for i, m in enumerate(size)), F.lit(0.0))
    best = counts.select("word", strength.alias("s")).filter(F.col("s") >= LEAST_CHI2).orderBy(F.desc("s"), "word").limit(FEATURES)
    return [bytes(r["word"]) for r in best.collect()]


def posteriors(docs: DataFrame, classifier: Classifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, posterior`` (an array in the order of the domains); words are split at white space."""
    rows = id_and_text(docs, id_col, text_col)
    model = share(docs.sparkSession, classifier)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch_texts(batch)
        found = [model().posteriors(texts[i:i + 256]) for i in range(0, len(texts), 256)]
        p = np.concatenate([p for _, p in found])
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([n for counts, _ in found for n in counts], pa.int64()),
                                           pa.array(list(p), pa.list_(pa.float64()))], ["doc_id", "n_tokens", "posterior"])
    return map_batches(rows, run, f"doc_id {field_type(rows, 'doc_id')}, n_tokens bigint, posterior array<double>")


def _rate(history: list[list[float]], most: float | None) -> Column:
    """Rate of a document after the steps taken: each subtracts posterior . step and projects on the allowed range."""
    def moved(r: Column, step: Column) -> Column:
        change = F.aggregate(F.zip_with("posterior", step, lambda p, s: p * s), F.lit(0.0), lambda a, x: a + x)
        low = F.greatest(F.lit(0.0), r - change)
        return F.least(F.lit(float(most)), low) if most is not None else low
    if not history:
        return F.lit(1.0)
    steps = F.array(*(F.array(*(F.lit(float(v)) for v in step)) for step in history))
    return F.aggregate(steps, F.lit(1.0), moved)


def fit_rates(table: DataFrame, targets: dict[str, float], domains: list[str], relative: bool = True, most: float | None = None,
              steps: int = STEPS) -> tuple[Column, dict]:
    """Rates as a column of ``table`` (``n_tokens, posterior``), and a report: the expected tokens of each domain that were
    wanted and reached, the steps, and whether any is ``missed`` by more than ``TOLERANCE`` of all tokens.

    ``targets`` are shares of all tokens, or multiples of each domain's expected tokens if not
    ``relative``. Steps are taken in the metric in which a document weighs its tokens, so that a long
    document is not bent more than a short one, and scaled by the domains' Gram matrix."""
    k = len(domains)
    weight = F.col("n_tokens").cast("double")
    sums = [F.sum(weight * F.col("posterior")[i]) for i in range(k)]
    gram = [F.sum(weight * F.col("posterior")[i] * F.col("posterior")[j]) for i in range(k) for j in range(k)]
    first = [x or 0.0 for x in table.agg(*sums, *gram).first()]
    have, total = np.array(first[:k]), sum(first[:k])
    wanted = np.array([float(targets.get(d, 0.0)) for d in domains])
    want = wanted / max(wanted.sum(), 1e-12) * total if relative else wanted * have
    if not total:
        return F.lit(1.0), {"targets": want.tolist(), "reached": have.tolist(), "steps": 0, "missed": False}
    g = np.array(first[k:]).reshape(k, k)
    scale = np.linalg.pinv(g + 1e-9 * np.trace(g) * np.eye(k))
    history: list[list[float]] = []
    reached = have
    for _ in range(steps):
        gap = reached - want
        if np.abs(gap).max() <= TOLERANCE * total:
            break
        history.append((scale @ gap).tolist())
        rate = _rate(history, most)
        reached = np.array([x or 0.0 for x in table.agg(*(F.sum(rate * weight * F.col("posterior")[i]) for i in range(k))).first()])
    return _rate(history, most), {"targets": want.tolist(), "reached": reached.tolist(), "steps": len(history),
                                    "missed": bool(np.abs(reached - want).max() > TOLERANCE * total)}


def copies(rate: Column, key: str, seed: str) -> Column:
    """Whole number of copies whose mean over documents is the rate; the fraction is decided by a seeded hash."""
    draw = F.pmod(F.xxhash64(F.lit(seed), F.coalesce(F.col(key).cast("string"), F.lit(""))), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return (F.floor(rate) + (draw < rate - F.floor(rate)).cast("long")).cast("long")


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float], domains: dict[str, str] = DOMAINS, relative: bool = True,
        most: float | None = None, id_col: str = "doc_id", text_col: str = "text", seed: str = "mix") -> DataFrame:
    """One row per input row: ``doc_id, n_tokens``, the posterior of each domain, ``rate, copies``.

    Null and empty texts have no tokens: their rate follows their posterior but moves no total. Rows
    repeat as they come. Without labelled documents all domains are equally likely. An empty table
    gives no rows. Targets that the rates cannot reach (``missed`` in the report of ``fit_rates``) are told by a warning."""
    classifier = train(docs, labels, domains, id_col, text_col)
    table = materialize(posteriors(docs, classifier, id_col, text_col))
    rate, report = fit_rates(table, targets, list(domains), relative, most)
    if report["missed"]:
        warnings.warn(f"expected tokens of the domains {list(domains)} come to {report['reached']}, not to {report['targets']}", stacklevel=2)
    return (table.withColumn("rate", rate).withColumn("copies", copies(F.col("rate"), "doc_id", seed))
            .select("doc_id", "n_tokens", *(F.col("posterior")[i].alias(f"p_{d}") for i, d in enumerate(domains)), "rate", "copies"))


def keep_mixed(docs: DataFrame, labels: DataFrame, targets: dict[str, float], domains: dict[str, str] = DOMAINS,
               id_col: str = "doc_id", text_col: str = "text", seed: str = "mix") -> DataFrame:
    """Rows of ``docs``, all their columns, taken at most once each so that the domains come to ``targets``
    (multiples of what each has): a rate is the probability to stay. Rows that share an id go together."""
    found = materialize(mix(docs, labels, targets, domains, relative=False, most=1.0, id_col=id_col, text_col=text_col, seed=seed))
    gone = found.filter("copies = 0").select(F.col("doc_id").alias("_gone_id")).distinct()
    return docs.join(materialize(gone), F.col(id_col).eqNullSafe(F.col("_gone_id")), "left_anti").select(*docs.columns)
