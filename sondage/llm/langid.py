"""Language of code-switched text by a linear-chain conditional random field.

Every word is a position, every language a state. A word's potentials come from its affixes,
character n-grams and lexicon entry; transitions between the languages of neighbouring words
are learned with them. Forward-backward gives each word's posterior, and a document gets the
language with the largest expected number of words.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batch_texts, field_type, held_out, id_and_text, map_batches, sample_per_class, share

TRAIN_DOCS = 100          # at most so many labelled documents per language are fitted on,
TRAIN_CHARS = 20_000      # none of them longer than this,
LONG_DOCS = 10            # but so many longer ones, by pieces of them, where a language has no others
LEXICON = 20_000
BITS = 17
SEQUENCE = 64
EPOCHS = 25
BLOCK = 256
UNDECIDED = "und"
_WORD = re.compile(r"[^\W\d_]+")
_TOGETHER = 600_000     # words of the documents that one pass works on
_CACHED = 400_000


def words_of(text: str) -> list[str]:
    """Runs of letters, lowered. The pattern also takes numbers that are no digits (superscripts, fractions, Roman ones)."""
    found = _WORD.findall(text.lower())
    if all(map(str.isalpha, found)):
        return found
    return [w for run in found for w in ([run] if run.isalpha() else "".join(c if c.isalpha() else " " for c in run).split())]


def spread_out(text: str, most: int, piece: int = 400) -> str:
    """Pieces at even distances over a whole long text, ``most`` characters in all."""
    if len(text) <= most:
        return text
    count = max(most // piece, 1)
    return " ".join(text[at:at + piece] for at in (i * (len(text) - piece) // max(count - 1, 1) for i in range(count)))


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed character n-grams (2, 3; with word boundaries, so affixes of one and two letters too)
    and affixes of three letters. Returns feature ids and where each word's begin."""
    code = np.frombuffer("".join([f"\x02{w}\x03" for w in words]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    opens, closes = code == 2, code == 3
    owner = np.cumsum(opens) - 1

    def hashed(n: int, kind: int) -> np.ndarray:
        h = np.full(len(code) - n + 1, kind * 0x9E3779B9 + 1, np.uint64)
        for i in range(n):
            h = (h ^ code[i:len(code) - n + 1 + i]) * np.uint64(0x100000001B3)
        return (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - BITS)

    ids, at = [], []
    for n, kind in ((2, 1), (3, 2), (4, 3)):
        if len(code) < n:
            continue
        inside = owner[:len(code) - n + 1] == owner[n - 1:]
        if n == 4:
            inside &= opens[:len(code) - 3] | closes[3:]
        place = np.flatnonzero(inside)
        ids.append(hashed(n, kind)[place].astype(np.int64))
        at.append(owner[place])
    ids, at = np.concatenate(ids), np.concatenate(at)
    order = np.argsort(at, kind="stable")
    return ids[order], np.searchsorted(at[order], np.arange(len(words)))


class Model:
    """States, weights of hashed features and lexicon words, transitions and start."""

    def __init__(self, labels: list[str], lexicon: dict[str, int], weights, lexical, transition, start):
        self.labels, self.lexicon = labels, lexicon
        self.weights, self.lexical, self.transition, self.start = weights, lexical, transition, start

    def potentials(self, words: list[str]) -> np.ndarray:
        """exp of the summed weights of each word, scaled to at most one."""
        ids, begin = word_features(words)
        total = np.add.reduceat(self.weights[ids], begin, axis=0) if len(words) else np.zeros((0, len(self.labels)), np.float32)
        known = [self.lexicon.get(w, -1) for w in words]
        total = total + self.lexical[known]  # the last row is zero
        return np.exp(total - total.max(axis=1, keepdims=True)).astype(np.float32) + np.float32(1e-6)


def _unit(a: np.ndarray) -> np.ndarray:
    return a / a.sum(axis=-1, keepdims=True)


def posterior_sums(ids: np.ndarray, sizes: np.ndarray, psi: np.ndarray, step: np.ndarray, start: np.ndarray,
                   block: int = BLOCK) -> np.ndarray:
    """Summed word posteriors of each document; ``ids`` points into the potentials ``psi``, document by document.

    Documents are cut into blocks that step together. The product of a block's transfer matrices
    carries the exact message across it, so the cut changes nothing but the order of work."""
    docs, states = len(sizes), psi.shape[1]
    count = -(-sizes // block)
    owner = np.repeat(np.arange(docs), count)
    order = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    begin = np.repeat(np.cumsum(sizes) - sizes, count) + order * block
    size = np.minimum(block, np.repeat(sizes, count) - order * block)
    by_size = np.argsort(-size, kind="stable")
    place = np.empty_like(by_size)
    place[by_size] = np.arange(len(by_size))  # block -> position in the order of size
    begin, size, owner, order = begin[by_size], size[by_size], owner[by_size], order[by_size]
    active = [int(np.searchsorted(-size, -t, "left")) for t in range(int(size.max(initial=0)) + 1)]  # blocks longer than t
    into = np.broadcast_to(start, (len(size), states)).astype(np.float32)
    after = np.ones((len(size), states), np.float32)

    many = np.flatnonzero(count > 1)
    if len(many):
        longer = np.repeat(count > 1, count)[by_size]
        which = np.flatnonzero(longer)
        back = np.full(len(size), -1)
        back[which] = np.arange(len(which))
        moved = np.broadcast_to(np.eye(states, dtype=np.float32), (len(which), states, states)).copy()
        for t in range(int(size[which].max())):
            a = int(np.searchsorted(-size[which], -t, "left"))
            now = moved[:a] if t == 0 else (moved[:a].reshape(-1, states) @ step).reshape(a, states, states)
            now = now * psi[ids[begin[which[:a]] + t]][:, None, :]
            moved[:a] = now / now.sum(axis=(1, 2), keepdims=True)
        first = (np.cumsum(count) - count)[many]
        most = int(count[many].max())
        for k in range(1, most):
            go = first[count[many] > k] + k
            b, prev = place[go], place[go - 1]
            carried = np.einsum("ni,nij->nj", into[prev], moved[back[prev]]) @ step
            into[b] = _unit(carried)
        for k in range(most - 1, 0, -1):
            go = first[count[many] > k] + k
            b, prev = place[go], place[go - 1]
            after[prev] = _unit(np.einsum("nij,nj->ni", moved[back[b]], after[b]) @ step.T)

    forward = np.empty((len(ids), states), np.float32)
    alpha = into
    for t in range(len(active) - 1):
        a = active[t]
        alpha = alpha[:a] if t == 0 else alpha[:a] @ step
        alpha = _unit(alpha * psi[ids[begin[:a] + t]])
        forward[begin[:a] + t] = alpha
    total = np.zeros((len(size), states), np.float64)
    beta = after.copy()
    for t in range(len(active) - 2, -1, -1):
        a, longer = active[t], active[t + 1] if t + 1 < len(active) - 1 else 0
        if longer:
            beta[:longer] = _unit((beta[:longer] * psi[ids[begin[:longer] + t + 1]]) @ step.T)
        total[:a] += _unit(forward[begin[:a] + t] * beta[:a])
    return np.stack([np.bincount(owner, total[:, s], docs) for s in range(states)], axis=1)


def _sequences(texts: list[list[int]], marks: list[int], rng) -> tuple[np.ndarray, np.ndarray]:
    """Training sequences of equal length: half of them plain runs, half switch languages every few words."""
    plain, mixed = [], []
    for words, mark in zip(texts, marks):
        for at in range(0, len(words) - SEQUENCE + 1, SEQUENCE):
            plain.append(([*words[at:at + SEQUENCE]], [mark] * SEQUENCE))
        at = 0
        while at < len(words):
            n = int(rng.integers(4, 25))
            mixed.append((words[at:at + n], mark))
            at += n
    rng.shuffle(mixed)
    flat = [(w, m) for part, m in mixed for w in part]
    rows = [([w for w, _ in flat[i:i + SEQUENCE]], [m for _, m in flat[i:i + SEQUENCE]])
            for i in range(0, len(flat) - SEQUENCE + 1, SEQUENCE)]
    rows = plain + rows
    if not rows:  # hardly any words: one sequence that repeats them
        flat = (flat * SEQUENCE)[:SEQUENCE] or [(0, 0)] * SEQUENCE
        rows = [([w for w, _ in flat], [m for _, m in flat])]
    return np.array([r[0] for r in rows]), np.array([r[1] for r in rows])


def fit(texts: list[tuple[str, str]], epochs: int = EPOCHS, seed: int = 7, rate: float = 0.3) -> Model:
    """Maximise the penalised likelihood of word labels over ``(text, language)`` pairs."""
    rng = np.random.default_rng(seed)
    labels = sorted({lang for _, lang in texts})
    states = len(labels)
    spelled = [words_of(t) for t, _ in texts]
    tally: dict[str, int] = {}
    for words in spelled:
        for w in words:
            tally[w] = tally.get(w, 0) + 1
    vocabulary = list(tally)
    number = {w: i for i, w in enumerate(vocabulary)}
    common = sorted((w for w in vocabulary if tally[w] >= 3), key=lambda w: (-tally[w], w))[:LEXICON]
    lexicon = {w: i for i, w in enumerate(common)}
    weights = np.zeros((1 << BITS, states), np.float32)
    lexical = np.zeros((len(lexicon) + 1, states), np.float32)
    trans, start = np.zeros((states, states)), np.zeros(states)
    if not vocabulary:
        return Model(labels, lexicon, weights, lexical, trans, start)
    seq, gold = _sequences([[number[w] for w in words] for words in spelled], [labels.index(lang) for _, lang in texts], rng)
    ids, begin = word_features(vocabulary)
    per_word = np.diff(np.append(begin, len(ids)))
    entry = np.array([lexicon.get(w, len(lexicon)) for w in vocabulary])
    held = [np.zeros_like(p, np.float64) for p in (weights, lexical, trans, start)]
    n = seq.size
    gold_words = np.stack([np.bincount(seq.ravel(), gold.ravel() == s, len(vocabulary)) for s in range(states)], axis=1)
    gold_moves = np.zeros((states, states))
    np.add.at(gold_moves, (gold[:, :-1].ravel(), gold[:, 1:].ravel()), 1)
    gold_start = np.bincount(gold[:, 0], minlength=states).astype(float)
    for _ in range(epochs):
        score = np.add.reduceat(weights[ids], begin, axis=0) + lexical[entry]
        psi = np.exp(score - score.max(axis=1, keepdims=True)) + 1e-6
        step, first = np.exp(trans - trans.max()), np.exp(start - start.max())
        p = psi[seq]  # sequences x length x states
        alpha = np.empty_like(p)
        alpha[:, 0] = _unit(first * p[:, 0])
        for t in range(1, seq.shape[1]):
            alpha[:, t] = _unit((alpha[:, t - 1] @ step) * p[:, t])
        beta = np.ones_like(p[:, 0])
        moves, expected = np.zeros((states, states)), np.empty_like(p)
        for t in range(seq.shape[1] - 1, -1, -1):
            expected[:, t] = _unit(alpha[:, t] * beta)
            if t:
                pair = alpha[:, t - 1][:, :, None] * step * (p[:, t] * beta)[:, None, :]
                moves += (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
                beta = _unit((beta * p[:, t]) @ step.T)
        flat = expected.reshape(-1, states)
        model_words = np.stack([np.bincount(seq.ravel(), flat[:, s], len(vocabulary)) for s in range(states)], axis=1)
        change = (gold_words - model_words) / n
        grads = [np.stack([np.bincount(ids, np.repeat(change[:, s], per_word), 1 << BITS) for s in range(states)], axis=1) - 1e-7 * weights,
                 np.stack([np.bincount(entry, change[:, s], len(lexicon) + 1) for s in range(states)], axis=1) - 1e-7 * lexical,
                 (gold_moves - moves) / n, (gold_start - expected[:, 0].sum(axis=0)) / n]
        grads[1][-1] = 0
        for value, grad, seen in zip((weights, lexical, trans, start), grads, held):
            seen += grad * grad
            value += (rate * grad / (np.sqrt(seen) + 1e-8)).astype(value.dtype)
    return Model(labels, lexicon, weights, lexical, trans, start)


class Tagger:
    """Applies a model to texts; remembers the potentials of a bounded number of words."""

    def __init__(self, model: Model):
        self.model = model
        self.step = np.exp(model.transition - model.transition.max(initial=0)).astype(np.float32)
        self.start = np.exp(model.start - model.start.max(initial=0)).astype(np.float32)
        self._clear()

    def _clear(self) -> None:
        self.number: dict[str, int] = {}
        self.psi = np.zeros((0, len(self.model.labels)), np.float32)

    def _group(self, spelled: list[list[str]]) -> tuple[list[str], list[float]]:
        if not self.model.labels:  # nothing could be learned
            return [UNDECIDED] * len(spelled), [0.0] * len(spelled)
        if len(self.number) > _CACHED:
            self._clear()
        new = list(set().union(*spelled) - self.number.keys())
        if new:
            self.number.update(zip(new, range(len(self.number), len(self.number) + len(new))))
            self.psi = np.concatenate([self.psi, self.model.potentials(new)])
        sizes = np.array([len(w) for w in spelled], np.int64)
        ids = np.fromiter((i for w in spelled for i in map(self.number.__getitem__, w)), np.int64, int(sizes.sum()))
        some = np.flatnonzero(sizes)
        names, scores = [UNDECIDED] * len(spelled), [0.0] * len(spelled)
        if len(some):
            mean = posterior_sums(ids, sizes[some], self.psi, self.step, self.start) / sizes[some][:, None]
            for d, best, share in zip(some.tolist(), mean.argmax(axis=1).tolist(), mean.max(axis=1).tolist()):
                names[d], scores[d] = self.model.labels[best], min(max(share, 0.0), 1.0)
        return names, scores

    def tag(self, texts: list[bytes]) -> tuple[list[str], list[float]]:
        names, scores, group, held = [], [], [], 0
        for text in [*texts, None]:
            if text is not None:
                group.append(words_of(text.decode("utf-8", "replace")))
                held += len(group[-1])
            if group and (text is None or held > _TOGETHER):
                n, s = self._group(group)
                names, scores, group, held = names + n, scores + s, [], 0
        return names, scores


def train(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_language: int = TRAIN_DOCS, most_chars: int = TRAIN_CHARS) -> Model:
    """Fit on a bounded sample of the rows where ``learn`` holds and text and language are given."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       F.col(lang_col).cast("string").alias("lang"), learn.alias("learn"))
    size = F.length("text")
    given = rows.filter(F.col("learn") & F.col("lang").isNotNull() & (size > 0))

    def drawn(fit_on: DataFrame, most: int) -> DataFrame:
        chosen = sample_per_class(fit_on.select("doc_id", "lang", F.xxhash64("text").alias("mark")), "doc_id", "lang", most, "lang")
        picked = fit_on.withColumn("mark", F.xxhash64("text")).join(F.broadcast(chosen), ["doc_id", "lang", "mark"], "left_semi")
        return picked.select("doc_id", "lang", "text").dropDuplicates()
    found = drawn(given.filter(size <= most_chars), per_language).collect()
    long = given.filter((size > most_chars) & ~F.col("lang").isin(sorted({r["lang"] for r in found})))
    if long.limit(1).count():
        def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
            parts = pa.array([spread_out(t.decode("utf-8", "replace"), most_chars) for t in batch_texts(batch)])
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("lang"), parts], ["doc_id", "lang", "text"])
        found += map_batches(drawn(long, LONG_DOCS), cut, f"doc_id {field_type(rows, 'doc_id')}, lang string, text string").collect()
    return fit([(r["text"], r["lang"]) for r in sorted(found, key=lambda r: (r["lang"], r["doc_id"] is None, r["doc_id"], r["text"]))])


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, lang_pred, score``.

    A null text or one without letters is ``und`` with score 0; so is any text if nothing could
    be learned. Ties go to the language first in the alphabet. Rows repeat as they come, whole
    texts of any length are read, an empty table gives no rows."""
    rows = id_and_text(docs, id_col, text_col)
    tag = _tagging(docs, model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, scores = tag(batch_texts(batch))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                          ["doc_id", "lang_pred", "score"])
    return map_batches(rows, run, f"doc_id {field_type(rows, 'doc_id')}, lang_pred string, score double")


def _tagging(docs: DataFrame, model: Model):
    """A function for tasks that tags texts."""
    tagger = share(docs.sparkSession, Tagger(model))
    return lambda texts: tagger().tag(texts)


def identify(docs: DataFrame, folds: int = 5, fold: int = 0, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang") -> DataFrame:
    """``doc_id, held_out, lang_pred, score``: learn outside one fold, predict every row."""
    model = train(docs, ~held_out(id_col, folds, fold), id_col, text_col, lang_col)
    return predict(docs, model, id_col, text_col).withColumn("held_out", held_out("doc_id", folds, fold)).select(
        "doc_id", "held_out", "lang_pred", "score")


def keep_identified(docs: DataFrame, least: float, folds: int = 5, fold: int = 0, id_col: str = "doc_id",
                    text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows, with all their columns, that get a language with a score of at least ``least``."""
    tag = _tagging(docs, train(docs, ~held_out(id_col, folds, fold), id_col, text_col, lang_col))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, scores = tag(batch_texts(batch, text_col))
        return batch.filter(pa.array([n != UNDECIDED and s >= least for n, s in zip(names, scores)], pa.bool_()))
    return map_batches(docs, run, docs.schema)
