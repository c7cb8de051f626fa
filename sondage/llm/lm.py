"""Log-bilinear language model trained by noise-contrastive estimation.

The most frequent words and the end of a text are classes of their own; one class is for the words below them, as many as
tasks can hold, and one for all others, where a word gets its share by its count. The score of a class after two others
is bilinear, s(c | u, v) = (C1 * r_v + C2 * r_u) . q_c + b_c with diagonal position weights. Held words without a class are
cut by frequency into bands of a bounded size: p(w | context) = p(class | context) p(band | class) p(w | band, v), the band
by its share, the word within it again by vectors, s(w | v) = a_v . t_w + b_w after the class before it. Training never
normalises: a logistic unit tells a true class, or word, from noise drawn from the frequencies, of all classes or of the
words of a band. Scoring does: batched matrix products over all context classes give the logarithm of every normaliser, tables
whose size does not depend on the corpus, so that every token's log-probability is exact and sums to one.

All counts run over all texts. Replicas of the network are trained side by side, each on all tokens of a share of the
texts, and averaged after every round. How many shares there are grows with the tokens, and which one a text belongs to
is told by its hash.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.distribute import materialize
from .common import ascii_words, batch_texts, field_type, held_out, id_and_text, most_frequent, share

CLASSES = 1024            # words with an own class, the end and the rest included
KNOWN_WORDS = 40_000      # words that every task holds, with their counts and vectors: these at least, and one in
KNOWN_SHARE = 8           # so many of the distinct ones,
KNOWN_AT_MOST = 80_000    # these at most; the others are looked up by a join
LONGEST_WORD = 200        # bytes of a word that tasks hold
BAND = 256                # words of a frequency class
DIMENSIONS = 24
BAND_DIMENSIONS = 12
SHARE_TOKENS = 4_000_000  # tokens of a share, about
ROUNDS = 2
NOISE = 64
BAND_NOISE = 12
BAND_BATCH = 2048
BAND_RATE = 0.2           # of the one round in which words within their classes are trained
BATCH = 512
_COUNTED_AT_ONCE = 300_000
_TOGETHER = 1_500_000      # tokens whose contexts are counted at once in training
_TEXTS_AT_ONCE = 256
END = b""                 # no word is empty, so the end of a text can be counted under this
REST, STOP = 0, 1         # class of all other words; class of the end, also what precedes a text


def word_counts(rows: DataFrame) -> DataFrame:
    """``word, n`` over all tokens, the ends of texts included under the empty word; words are bytes."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(seen.keys()), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])
            seen.clear()
            return out
        for batch in batches:
            for text in batch_texts(batch):
                seen.update(ascii_words(text))
                seen[END] += 1
                if len(seen) > _COUNTED_AT_ONCE:
                    yield flush()
        if seen:
            yield flush()
    return rows.select("text").mapInArrow(count, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


class Network:
    """Parameters as one flat vector, so that replicas can be averaged."""

    def __init__(self, counts: np.ndarray, dimensions: int = DIMENSIONS, seed: int = 3):
        self.k, self.d = len(counts), dimensions
        share_of = (counts + 0.5) / (counts + 0.5).sum()
        self.noise = share_of
        rng = np.random.default_rng(seed)
        self.r = (rng.standard_normal((self.k, dimensions)) * 0.1).astype(np.float32)
        self.q = (rng.standard_normal((self.k, dimensions)) * 0.1).astype(np.float32)
        self.c = np.ones((2, dimensions), np.float32)
        self.b = np.log(share_of).astype(np.float32)

    PARTS = ("r", "q", "c", "b")

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, p).ravel() for p in self.PARTS])

    def load(self, flat: np.ndarray) -> Network:
        at = 0
        for p in self.PARTS:
            old = getattr(self, p)
            setattr(self, p, flat[at:at + old.size].reshape(old.shape).astype(np.float32))
            at += old.size
        return self

    def predicted(self, far: np.ndarray, near: np.ndarray) -> np.ndarray:
        """Predicted representation after classes ``far, near``."""
        return self.c[0] * self.r[near] + self.c[1] * self.r[far]

    def train(self, far: np.ndarray, near: np.ndarray, target: np.ndarray, weight: np.ndarray, rng, rate: float, held: list[np.ndarray]) -> None:
        """One pass over weighted samples: AdaGrad on the noise-contrastive objective, the noise shared by a batch."""
        log_noise = np.log(self.noise).astype(np.float32)
        cumulative = np.cumsum(self.noise)
        for at in rng.permutation(np.arange(0, len(target), BATCH)):
            u, v, w, n = (a[at:at + BATCH] for a in (far, near, target, weight))
            drawn = np.minimum(np.searchsorted(cumulative, rng.random(NOISE)), self.k - 1)
            p = self.predicted(u, v)
            true = (p * self.q[w]).sum(axis=1) + self.b[w] - log_noise[w] - np.log(np.float32(NOISE))
            false = p @ self.q[drawn].T + self.b[drawn] - log_noise[drawn] - np.log(np.float32(NOISE))
            up = n / (1 + np.exp(np.clip(true, -30, 30)))                     # d/ds of log sigmoid(true)
            down = -n[:, None] / (1 + np.exp(np.clip(-false, -30, 30)))      # of log(1 - sigmoid(false))
            total = n.sum()
            gp = (up[:, None] * self.q[w] + down @ self.q[drawn]) / total
            gq = _scatter(np.concatenate([w, drawn]), np.concatenate([up[:, None] * p, down.T @ p]), self.k) / total
            gr = _scatter(np.concatenate([v, u]), np.concatenate([gp * self.c[0], gp * self.c[1]]), self.k)
            gc = np.stack([(gp * self.r[v]).sum(axis=0), (gp * self.r[u]).sum(axis=0)])
            gb = np.bincount(np.concatenate([w, drawn]), np.concatenate([up, down.sum(axis=0)]), self.k) / total
            for value, grad, seen in zip((self.r, self.q, self.c, self.b), (gr, gq, gc, gb), held):
                seen += grad * grad
                value += (rate * grad / (np.sqrt(seen) + 1e-7)).astype(np.float32)

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``near[v, w]`` with the bias, ``far[u, w]`` and the log normaliser of every context ``(u, v)``."""
        near = (self.c[0] * self.r) @ self.q.T + self.b
        far = (self.c[1] * self.r) @ self.q.T
        top = near.max(axis=1), far.max(axis=1)
        # sum_w exp(near[v, w] + far[u, w]) of all pairs at once is a matrix product of exponentials.
        z = np.exp((far - top[1][:, None]).astype(np.float64)) @ np.exp((near - top[0][:, None]).astype(np.float64)).T
        return near, far, (np.log(z) + top[1][:, None] + top[0]).astype(np.float32)


class Bands:
    """Words within frequency classes: ``BAND`` of them after the other, most frequent first."""

    PARTS = ("t", "b")

    def __init__(self, counts: np.ndarray, contexts: int, dimensions: int = BAND_DIMENSIONS, band: int = BAND, seed: int = 4):
        self.h, self.k, self.d, self.band = len(counts), contexts, dimensions, band
        self.starts = np.arange(0, self.h, band)
        share_of = np.asarray(counts, np.float64) + 0.5
        if self.h:
            share_of = share_of / np.repeat(np.add.reduceat(share_of, self.starts), np.diff([*self.starts, self.h]))
        self.noise = share_of
        rng = np.random.default_rng(seed)
        self.a = (rng.standard_normal((contexts, dimensions)) * 0.1).astype(np.float32)
        self.t = (rng.standard_normal((self.h, dimensions)) * 0.1).astype(np.float32)
        self.b = np.log(share_of).astype(np.float32)

    def train(self, near: np.ndarray, word: np.ndarray, weight: np.ndarray, rng, rate: float, held: list[np.ndarray]) -> None:
        """One pass over weighted (context, word) pairs, class by class; the noise comes from the class."""
        order = np.argsort(word // self.band, kind="stable")
        near, word, weight = near[order], word[order], weight[order]
        edges = np.searchsorted(word // self.band, np.arange(len(self.starts) + 1))
        for g in rng.permutation(np.flatnonzero(np.diff(edges))):
            low, high = g * self.band, min((g + 1) * self.band, self.h)
            if high - low < 2:
                continue
            log_noise = np.log(self.noise[low:high]).astype(np.float32) + np.log(np.float32(BAND_NOISE))
            cumulative = np.cumsum(self.noise[low:high])
            for at in range(edges[g], edges[g + 1], BAND_BATCH):
                part = slice(at, min(at + BAND_BATCH, edges[g + 1]))
                v, w, n = near[part], word[part] - low, weight[part]
                drawn = np.minimum(np.searchsorted(cumulative, rng.random(BAND_NOISE)), high - low - 1)
                p, t, b = self.a[v], self.t[low:high], self.b[low:high]
                up = n / (1 + np.exp(np.clip((p * t[w]).sum(axis=1) + b[w] - log_noise[w], -30, 30)))
                down = -n[:, None] / (1 + np.exp(np.clip(-(p @ t[drawn].T + b[drawn] - log_noise[drawn]), -30, 30)))
                total = n.sum()
                ga = _scatter(v, (up[:, None] * t[w] + down @ t[drawn]) / total, self.k)
                gt = _scatter(np.concatenate([w, drawn]), np.concatenate([up[:, None] * p, down.T @ p]), high - low) / total
                gb = np.bincount(np.concatenate([w, drawn]), np.concatenate([up, down.sum(axis=0)]), high - low) / total
                for value, grad, seen in ((self.a, ga, held[0]), (self.t[low:high], gt, held[1][low:high]), (self.b[low:high], gb, held[2][low:high])):
                    seen += grad * grad
                    value += (rate * grad / (np.sqrt(seen) + 1e-7)).astype(np.float32)

    def normalisers(self) -> np.ndarray:
        """Logarithm of the sum over the words of each class, after each context class."""
        out = np.zeros((self.k, len(self.starts)))
        for g, low in enumerate(self.starts):
            scores = (self.a @ self.t[low:low + self.band].T).astype(np.float64) + self.b[low:low + self.band]
            top = scores.max(axis=1, keepdims=True)
            out[:, g] = np.log(np.exp(scores - top).sum(axis=1)) + top[:, 0]
        return out.astype(np.float32)


def _scatter(rows: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    order = np.argsort(rows, kind="stable")
    key = rows[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    out = np.zeros((size, values.shape[1]), np.float64)
    out[key[first]] = np.add.reduceat(values[order], first, axis=0)
    return out


def _contexts(classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The classes before each position and two before; texts follow each other, each closed by STOP."""
    near = np.concatenate([[STOP], classes[:-1]])
    far = np.concatenate([[STOP, STOP], classes[:-2]])[:len(classes)]
    return np.where(near == STOP, STOP, far), near


def _flows(classes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (far, near, target) with how often each occurs, in a mixed order that depends on them alone."""
    far, near = _contexts(classes)
    code, n = np.unique((far * k + near) * k + classes, return_counts=True)
    mixed = np.argsort((code.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), kind="stable")
    code, n = code[mixed], n[mixed]
    return code // (k * k), code // k % k, code % k, n.astype(np.float32)


def _pieces(network: Network, bands: Bands, tokens: float, seen: np.ndarray) -> Iterator[tuple[int, bytes, bytes]]:
    """(number, weights, values times weights) of the parameters: those of the classes and contexts weigh by the tokens of a
    replica, those of a word by how often the replica met it."""
    flat = np.concatenate([network.flat(), bands.a.ravel()])
    step = 4096
    for i, at in enumerate(range(0, len(flat), step)):
        yield i, np.array([tokens]).tobytes(), (flat[at:at + step].astype(np.float64) * tokens).astype(np.float32).tobytes()
    first, rows = -(-len(flat) // step), np.concatenate([bands.t, bands.b[:, None]], axis=1).astype(np.float64)
    for i, at in enumerate(bands.starts.tolist()):
        n = seen[at:at + bands.band].astype(np.float64)
        if n.any():
            yield first + i, n.tobytes(), (rows[at:at + bands.band] * n[:, None]).astype(np.float32).tobytes()


def _load(network: Network, bands: Bands, parts: dict[int, tuple[np.ndarray, np.ndarray]]) -> None:
    """Parameters from summed pieces; a word that no replica met keeps its own."""
    flat, step = np.concatenate([network.flat(), bands.a.ravel()]), 4096
    for i, at in enumerate(range(0, len(flat), step)):
        if i in parts:
            flat[at:at + step] = parts[i][1] / parts[i][0][0]
    network.load(flat[:len(network.flat())])
    bands.a = flat[len(network.flat()):].reshape(bands.a.shape).astype(np.float32)
    for i, at in enumerate(bands.starts.tolist()):
        weights, sums = parts.get(-(-len(flat) // step) + i, (None, None))
        if weights is not None:
            met = weights > 0
            rows = sums.reshape(len(weights), -1)[met] / weights[met, None]
            bands.t[at:at + bands.band][met], bands.b[at:at + bands.band][met] = rows[:, :-1], rows[:, -1]


def _band_pairs(classes: np.ndarray, ids: np.ndarray, head: int, h: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (class before, word) of the words in frequency classes, with how often each occurs, mixed."""
    at = np.flatnonzero(classes >= head)
    near = np.where(at > 0, classes[np.maximum(at, 1) - 1], STOP)
    code, n = np.unique(near * h + ids, return_counts=True)
    mixed = np.argsort((code.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), kind="stable")
    return code[mixed] // h, code[mixed] % h, n[mixed].astype(np.float32)


def fit(encoded: DataFrame, lexicon: Lexicon, rounds: int = ROUNDS, share_tokens: int = SHARE_TOKENS) -> tuple[Network, Bands]:
    """Train on the packed classes and words of the rows of ``encoded`` that are not held out. In every round each replica goes
    through all tokens of its share once; the replicas are averaged in two steps, a group of shares at a time."""
    network, bands = Network(lexicon.class_counts), Bands(lexicon.word_counts, len(lexicon.class_counts), band=lexicon.band)
    spark, head = encoded.sparkSession, lexicon.head
    shares = max(1, -(-lexicon.total // share_tokens))
    group = max(1, int(np.ceil(np.sqrt(shares))))
    # The order within a share follows from the texts, so that the result does not depend on how they are laid out.
    mark = F.xxhash64("classes", "ids")
    rows = materialize(encoded.filter("NOT held_out").select("classes", "ids", mark.alias("mark")).withColumn("share", F.pmod("mark", F.lit(shares)))
                       .repartition(min(shares, 20_000), "share").sortWithinPartitions("share", "mark", "classes").select("share", "classes", "ids"))
    for step in range(rounds):
        shared = share(spark, (network, bands, step))

        def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            state: dict = {}

            def begin(which: int) -> None:
                start, inner, at = shared()
                own = Network(start.noise, start.d)
                own.noise = start.noise
                own.load(start.flat())
                words = Bands.__new__(Bands)
                words.__dict__.update(inner.__dict__, a=inner.a.copy(), t=inner.t.copy(), b=inner.b.copy())
                state.update(share=which, own=own, words=words, at=at, tokens=0, seen=np.zeros(words.h), waiting=[], length=0,
                             rng=np.random.default_rng([at + 1, which]), held=[np.full(x.shape, 1e-6) for x in (own.r, own.q, own.c, own.b)],
                             inside=[np.full(x.shape, 1e-6) for x in (words.a, words.t, words.b)])

            def go() -> None:
                classes = np.frombuffer(b"".join(c for c, _ in state["waiting"]), np.uint16).astype(np.int64)
                ids = np.frombuffer(b"".join(i for _, i in state["waiting"]), np.uint32).astype(np.int64)
                own, words, rate = state["own"], state["words"], 0.1 / (state["at"] + 1)
                own.train(*_flows(classes, own.k), state["rng"], rate, state["held"])
                if len(ids) and state["at"] == 0:
                    near, word, n = _band_pairs(classes, ids, head, words.h)
                    words.train(near, word, n, state["rng"], BAND_RATE, state["inside"])
                    state["seen"] += np.bincount(ids, minlength=words.h)
                state.update(tokens=state["tokens"] + len(classes), waiting=[], length=0)

            def end() -> pa.RecordBatch:
                if state["length"]:
                    go()
                columns = list(zip(*_pieces(state["own"], state["words"], float(state["tokens"]), state["seen"])))
                return pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.int32()), pa.array([state["share"] % group] * len(columns[0]), pa.int32()),
                     pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.binary())], ["part", "fan", "weights", "sums"])
            for batch in batches:
                for which, classes, ids in zip(*(batch.column(n).to_pylist() for n in ("share", "classes", "ids"))):
                    if state.get("share") != which:
                        if state:
                            yield end()
                        begin(which)
                    state["waiting"].append((classes, ids))
                    state["length"] += len(classes) // 2
                    if state["length"] >= _TOGETHER:
                        go()
            if state:
                yield end()

        def added(group_: pa.Table) -> pa.Table:  # of a group of shares, then of the groups
            weights = np.sum([np.frombuffer(x, np.float64) for x in group_.column("weights").to_pylist()], axis=0)
            sums = np.sum([np.frombuffer(x, np.float32).astype(np.float64) for x in group_.column("sums").to_pylist()], axis=0)
            return pa.table({"part": group_.column("part")[:1], "weights": pa.array([weights.tobytes()], pa.binary()),
                             "sums": pa.array([sums.astype(np.float32).tobytes()], pa.binary())})
        kind = "part int, weights binary, sums binary"
        parts = rows.mapInArrow(learn, "part int, fan int, weights binary, sums binary").groupBy("part", "fan").applyInArrow(added, kind)
        parts = parts.groupBy("part").applyInArrow(added, kind) if group > 1 else parts
        _load(network, bands, {r["part"]: (np.frombuffer(r["weights"], np.float64), np.frombuffer(r["sums"], np.float32).astype(np.float64))
                               for r in parts.collect()})
    return network, bands


def _lexicon(counts: DataFrame, known: int) -> list[tuple[bytes, int]]:
    """The most frequent words of a bounded length with their counts, in order."""
    size = F.octet_length("word")
    top = most_frequent(counts.filter((size > 0) & (size <= LONGEST_WORD)), known).collect()
    return sorted(((bytes(r["word"]), r["n"]) for r in top), key=lambda x: (-x[1], x[0]))


class Lexicon:
    """Held words: those with a class of their own, then those in frequency classes; sizes of the corpus they come from."""

    def __init__(self, top: list[tuple[bytes, int]], total: int, distinct: int, ends: int, classes: int = CLASSES, band: int = BAND):
        own, rest = top[:classes - 2], top[classes - 2:]
        self.total, self.distinct, self.ends, self.head, self.band = total, distinct, ends, len(own) + 2, band
        self.held = dict(top)
        self.place = {w: (i + 2, -1) for i, (w, _) in enumerate(own)} | {w: (self.head, i) for i, (w, _) in enumerate(rest)}
        self.word_counts = np.array([n for _, n in rest], np.float64)
        self.band_counts = np.add.reduceat(self.word_counts, np.arange(0, len(rest), band)) if rest else np.zeros(0)
        self.rest_tokens = total - ends - sum(n for _, n in top)
        rest_words = distinct - len(top) - (1 if ends else 0)
        self.class_counts = np.array([self.rest_tokens, ends, *(n for _, n in own), *([self.band_counts.sum()] if rest else [])], np.float64)
        # log10 of the share of a word within the last class is log10(c + 0.5) less this; the 1 is for unseen words.
        self.rest_size = float(np.log10(self.rest_tokens + 0.5 * (max(rest_words, 0) + 1)))
        self.size = float(np.log10(total + 0.5 * (distinct + 1)))


class Model:
    """Tables that score texts."""

    def __init__(self, network: Network, bands: Bands, lexicon: Lexicon):
        self.share = np.log(lexicon.band_counts / max(lexicon.band_counts.sum(), 1.0))
        head = lexicon.head
        self.near, self.far, self.normal = network.tables()
        self.a, self.t, self.b, self.inner, self.band, self.head = bands.a, bands.t, bands.b, bands.normalisers(), bands.band, head

    def log10(self, classes: np.ndarray, ids: np.ndarray) -> float:
        """Of the classes of a text, and of its words in frequency classes given these."""
        u, v = _contexts(classes)
        total = (self.near[v, classes].astype(np.float64) + self.far[u, classes] - self.normal[u, v]).sum()
        if len(ids):
            before = v[classes >= self.head]
            total += self.share[ids // self.band].sum()
            total += ((self.a[before] * self.t[ids]).sum(axis=1, dtype=np.float64) + self.b[ids] - self.inner[before, ids // self.band]).sum()
        return float(total / np.log(10))


def score(docs: DataFrame, folds: int = 5, fold: int = 1, id_col: str = "doc_id", text_col: str = "text", classes: int = CLASSES,
          known: int | None = None, rounds: int = ROUNDS) -> DataFrame:
    """One row per input row: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Rows of one fold of crc32 of the id are held out, all others are learned from. A null or empty
    text is the end alone. Rows repeat as they come and count as often in training; texts of any
    length are read whole; without training rows every token has the probability of an unseen one;
    an empty table gives no rows."""
    spark = docs.sparkSession
    rows = id_and_text(docs, id_col, text_col).withColumn("held_out", held_out("doc_id", folds, fold))
    counts = materialize(word_counts(rows.filter("NOT held_out")))
    lexicon = learned_lexicon(counts, classes, known)
    total, size, rest_size = lexicon.total, lexicon.size, lexicon.rest_size
    encoded = encoded_rows(rows, lexicon)
    # The other words, joined with their counts; what remains is one small row per text and task.
    rare = encoded.select("row", F.explode(F.arrays_zip("words", "times")).alias("w")).select("row", F.col("w.words").alias("word"), F.col("w.times").alias("times"))
    told = rare.join(counts, "word", "left").withColumn("n", F.coalesce("n", F.lit(0))).groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.col("n") + 0.5)).alias("rare"), F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("rare_known"))
    told = materialize(told)

    network, bands = fit(encoded, lexicon, rounds)
    model = share(spark, Model(network, bands, lexicon))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            values = [model().log10(np.frombuffer(c, np.uint16).astype(np.int64), np.frombuffer(i, np.uint32).astype(np.int64))
                      for c, i in zip(batch.column("classes").to_pylist(), batch.column("ids").to_pylist())]
            keep = [n for n in batch.schema.names if n not in ("classes", "ids")]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in keep), pa.array(values)], [*keep, "net"])
    names = ["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "n_rest"]
    judged = encoded.select(*names, "classes", "ids").mapInArrow(judge, ", ".join(f"{n} {field_type(encoded, n)}" for n in names) + ", net double")
    extra = F.coalesce("rare", F.lit(0.0))
    return judged.join(told, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"), (F.col("base") + extra - F.col("n_tokens") * F.lit(size)).alias("base_score"),
        (F.col("net") + extra - F.col("n_rest") * F.lit(rest_size)).alias("score"))


def learned_lexicon(counts: DataFrame, classes: int = CLASSES, known: int | None = None, band: int = BAND) -> Lexicon:
    """From ``word, n`` of all training tokens; the words held grow with the distinct ones unless ``known`` is given."""
    sums = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count(F.lit(1)).alias("distinct"),
                      F.coalesce(F.sum(F.when(F.octet_length("word") == 0, F.col("n"))), F.lit(0)).alias("ends")).first()
    known = known or int(np.clip(sums["distinct"] // KNOWN_SHARE, KNOWN_WORDS, KNOWN_AT_MOST))
    return Lexicon(_lexicon(counts, known), sums["tokens"], sums["distinct"], sums["ends"], classes, band)


def encoded_rows(rows: DataFrame, lexicon: Lexicon) -> DataFrame:
    """Classes (``classes``) and words in frequency classes (``ids``) of every text, what the held counts give for it, and its other
    words with their counts in the text."""
    shared = share(rows.sparkSession, (lexicon.place, lexicon.held, lexicon.ends))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held, ends = shared()
        log_end = np.log10(ends + 0.5)
        number = {w: i for i, w in enumerate(held)}
        # The last row stands for words that are not held.
        class_of, id_of = (np.array([*(place[w][j] for w in held), missing]) for j, missing in ((0, REST), (1, -1)))
        logs = np.log10(np.array([*held.values(), 0.5]) + 0.5)
        for batch in (b.slice(at, _TEXTS_AT_ONCE) for b in batches for at in range(0, b.num_rows, _TEXTS_AT_ONCE)):
            out = []
            for text in batch_texts(batch):
                words = ascii_words(text)
                listed = [number.get(w, -1) for w in words]
                found = np.array(listed, np.int64)
                rare = Counter([w for w, f in zip(words, listed) if f < 0]) if -1 in listed else {}
                n_rare = sum(rare.values())
                ids = id_of[found]
                line = np.append(class_of[found], STOP).astype(np.uint16)
                out.append((line.tobytes(), ids[ids >= 0].astype(np.uint32).tobytes(), len(words) + 1, len(words) - n_rare + (ends > 0),
                            float(log_end + logs[found].sum()), n_rare, list(rare), list(rare.values())))
            columns = list(zip(*out))
            kinds = (pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.list_(pa.binary()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                ["doc_id", "held_out", "classes", "ids", "n_tokens", "n_known", "base", "n_rest", "words", "times"])
    return materialize(rows.mapInArrow(
        encode, f"doc_id {field_type(rows, 'doc_id')}, held_out boolean, classes binary, ids binary, n_tokens bigint, n_known bigint, base double, "
                "n_rest bigint, words array<binary>, times array<bigint>").withColumn("row", F.monotonically_increasing_id()))
