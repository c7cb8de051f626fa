"""Byte-pair encoding and decoding with a lexicon automaton.

The most frequent words of the corpus are merged once, compiled into a minimal acyclic
automaton whose common suffixes are shared and whose arcs carry numbers that add up to the
place of a word in the list of id sequences, and written as one file of NumPy arrays. Tasks
memory-map the file. Words that are not in the automaton are merged exactly, pair by pair.
"""

from __future__ import annotations

import hashlib
import io
import json
import os
import re
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.distribute import materialize
from .common import batch_texts, field_type, id_and_text, map_batches, most_frequent, worker_cache

LEXICON_WORDS = 60_000
LEXICON_BYTES = 40
_COUNTED_AT_ONCE = 400_000
_MEMO = 300_000
_TABLE_BITS = 18
_SIDE_BY_SIDE = 48
_NO_MERGE = np.iinfo(np.int64).max

# The split pattern of byte-level vocabularies of this family.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


# The same split for texts of plain and Latin-1 letters alone, where it can be told without character tables.
_PLAIN_ONLY = re.compile("[^\\t-\\r\\x20-\\x7eÀ-ÖØ-öø-ÿ]")
_PLAIN_SPLIT = re.compile("'(?:[stmd]|re|ve|ll)| ?[A-Za-zÀ-ÖØ-öø-ÿ]+| ?[0-9]+| ?[^\\t-\\r A-Za-z0-9À-ÖØ-öø-ÿ]+"
                          "|[\\t-\\r ]+(?![^\\t-\\r ])|[\\t-\\r ]+")
_SPLIT = regex.compile(SPLIT)


def split(text: str) -> list[str]:
    """Pretokens of a text."""
    return _SPLIT.findall(text) if _PLAIN_ONLY.search(text) else _PLAIN_SPLIT.findall(text)


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies, as character to byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(rest)}}


class Vocabulary:
    """Ids, byte strings, merge ranks and special strings of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        to_byte = byte_alphabet()
        model, added = spec["model"], spec.get("added_tokens") or []
        self.special = {t["content"]: t["id"] for t in added}
        self.bytes = {i: bytes(map(to_byte.__getitem__, t)) for t, i in model["vocab"].items() if t not in self.special}
        self.bytes.update({i: t.encode() for t, i in self.special.items()})
        ids = model["vocab"]
        self.byte_id = [ids[c] for c, _ in sorted(to_byte.items(), key=lambda x: x[1])]
        # (left id, right id) -> (rank, merged id), as one number each
        self.merges = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if not isinstance(pair, str) else pair.split(" ")
            self.merges[ids[left] << 32 | ids[right]] = rank << 32 | ids[left + right]
        self._tables = self._hashed()

    def _hashed(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Hash tables of the pairs: what finds its place taken in one goes to the next."""
        keys = np.fromiter(self.merges.keys(), np.int64)
        values = np.fromiter(self.merges.values(), np.int64)
        tables = []
        while len(keys):
            at = self._slot(keys, len(tables))
            _, first = np.unique(at, return_index=True)
            key, value = np.full(1 << _TABLE_BITS, -1, np.int64), np.full(1 << _TABLE_BITS, _NO_MERGE, np.int64)
            key[at[first]], value[at[first]] = keys[first], values[first]
            tables.append((key, value))
            keys, values = np.delete(keys, first), np.delete(values, first)
        return tables

    @staticmethod
    def _slot(keys: np.ndarray, table: int) -> np.ndarray:
        mixed = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15 + 2 * table)
        return ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)

    def _ranked(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """rank << 32 | merged id of each pair, ``_NO_MERGE`` where there is none."""
        keys = np.ascontiguousarray(left.astype(np.int64) << 32 | right)
        out = np.full(keys.shape, _NO_MERGE, np.int64)
        for i, (key, value) in enumerate(self._tables):
            at = self._slot(keys, i)
            hit = key[at] == keys
            out[hit] = value[at[hit]]
        return out

    def merge_all(self, words: list[bytes]) -> list[tuple[int, ...]]:
        """``merge`` of many words: in each step every word merges its own best pair."""
        out: list[tuple[int, ...]] = [()] * len(words)
        by_size: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            if len(w) > _SIDE_BY_SIDE or not w:
                out[i] = self.merge(w)
            else:
                by_size.setdefault(-(-len(w) // 4) * 4, []).append(i)
        byte_id = np.array(self.byte_id, np.int32)
        for width, chosen in by_size.items():
            for at in range(0, len(chosen), 20_000):
                rows = np.array(chosen[at:at + 20_000])
                size = np.array([len(words[i]) for i in rows])
                raw = np.frombuffer(b"".join([words[i].ljust(width, b"\0") for i in rows]), np.uint8).reshape(-1, width)
                ids = byte_id[raw]
                columns = np.arange(width)
                pairs = np.full(ids.shape, _NO_MERGE, np.int64)
                pairs[:, :-1] = np.where(columns[1:] < size[:, None], self._ranked(ids[:, :-1], ids[:, 1:]), _NO_MERGE)
                while len(rows):
                    best = pairs.argmin(axis=1)
                    line = np.arange(len(rows))
                    value = pairs[line, best]
                    over = value == _NO_MERGE
                    if over.any():
                        for i, n, found in zip(rows[over].tolist(), size[over].tolist(), ids[over].tolist()):
                            out[i] = tuple(found[:n])
                        go = ~over
                        rows, size, ids, pairs, best, value = rows[go], size[go], ids[go], pairs[go], best[go], value[go]
                        line = np.arange(len(rows))
                        if not len(rows):
                            break
                    # What follows the merged pair moves one place to the left.
                    source = np.minimum(columns + (columns > best[:, None]), width - 1)
                    ids = np.take_along_axis(ids, source, 1)
                    ids[line, best] = value & 0xFFFFFFFF
                    source = np.minimum(columns + (columns >= best[:, None]), width - 1)
                    pairs = np.take_along_axis(pairs, source, 1)
                    pairs[:, -1] = _NO_MERGE
                    size = size - 1
                    after = best + 1 < size
                    pairs[line, best] = _NO_MERGE
                    r, b = line[after], best[after]
                    pairs[r, b] = self._ranked(ids[r, b], ids[r, b + 1])
                    r, b = line[best > 0], best[best > 0]
                    pairs[r, b - 1] = self._ranked(ids[r, b - 1], ids[r, b])
        return out

    def merge(self, word: bytes) -> tuple[int, ...]:
        """Ids of one word: the pair of lowest rank is merged until none is left."""
        ids = [self.byte_id[b] for b in word]
        if len(ids) > 64:
            return self._merge_long(ids)
        get = self.merges.get
        found = [get(a << 32 | b) for a, b in zip(ids, ids[1:])]
        while True:
            best, at = None, -1
            for i, m in enumerate(found):
                if m is not None and (best is None or m < best):
                    best, at = m, i
            if best is None:
                return tuple(ids)
            new = best & 0xFFFFFFFF
            ids[at:at + 2] = [new]
            del found[at]
            if at < len(found):
                found[at] = get(new << 32 | ids[at + 1])
            if at:
                found[at - 1] = get(ids[at - 1] << 32 | new)

    def _merge_long(self, ids: list[int]) -> tuple[int, ...]:
        """The same for long words in n log n: a heap of pairs over a linked list."""
        import heapq
        get, n = self.merges.get, len(ids)
        before, after, alive = list(range(-1, n - 1)), list(range(1, n + 1)), [True] * n
        heap = [(m >> 32, i, ids[i], ids[i + 1], m & 0xFFFFFFFF) for i in range(n - 1)
                if (m := get(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, left, right, new = heapq.heappop(heap)
            j = after[i] if alive[i] else n
            if not alive[i] or ids[i] != left or j >= n or ids[j] != right:
                continue
            ids[i], alive[j], after[i] = new, False, after[j]
            if after[j] < n:
                before[after[j]] = i
            for a in (before[i], i):
                b = after[a] if a >= 0 else n
                if a >= 0 and b < n and (m := get(ids[a] << 32 | ids[b])) is not None:
                    heapq.heappush(heap, (m >> 32, a, ids[a], ids[b], m & 0xFFFFFFFF))
        return tuple(t for t, live in zip(ids, alive) if live)


class Lexicon:
    """Minimal acyclic automaton over bytes with additive outputs, in flat arrays.

    State s has the arcs ``first[s] .. first[s + 1]``, sorted by byte. Following a word adds up
    the arc numbers to its rank in sorted order, under which ``start`` points into ``ids``."""

    FIELDS = ("first", "final", "label", "target", "add", "start", "ids")

    def __init__(self, arrays: dict[str, np.ndarray]):
        for name in self.FIELDS:
            setattr(self, name, arrays[name].view(np.ndarray))
        # One sorted key per arc finds the arcs of many words at once.
        states = np.repeat(np.arange(len(self.final), dtype=np.int64), np.diff(self.first))
        self.key = states << 8 | np.asarray(self.label, np.int64)

    @staticmethod
    def compile(entries: dict[bytes, tuple[int, ...]]) -> dict[str, np.ndarray]:
        """Arrays of the minimal automaton, built word by word in sorted order: as soon as a
        branch can no longer grow its states are replaced by equal ones that exist."""
        words = sorted(entries)
        known: dict[tuple, int] = {}
        arcs_of: list[tuple] = []
        final_of: list[bool] = []
        count_of: list[int] = []

        def freeze(node: list) -> int:
            final, arcs = node
            shape = (final, tuple(arcs))
            if (state := known.get(shape)) is None:
                state = known[shape] = len(arcs_of)
                arcs_of.append(shape[1])
                final_of.append(final)
                count_of.append(final + sum(count_of[t] for _, t in arcs))
            return state

        path: list[list] = [[False, []]]
        last = b""
        for word in words:
            same = len(os.path.commonprefix([last, word]))
            while len(path) - 1 > same:
                child = freeze(path.pop())
                path[-1][1].append((last[len(path) - 1], child))
            for _ in word[same:]:
                path.append([False, []])
            path[-1][0] = True
            last = word
        while len(path) > 1:
            child = freeze(path.pop())
            path[-1][1].append((last[len(path) - 1], child))
        root = freeze(path[0])
        n = len(arcs_of)  # states in post-order; reversed, the root comes first
        first, label, target, add = [0], [], [], []
        for state in range(n - 1, -1, -1):
            before = int(final_of[state])
            for byte, child in arcs_of[state]:
                label.append(byte)
                target.append(n - 1 - child)
                add.append(before)
                before += count_of[child]
            first.append(len(label))
        assert root == n - 1
        lengths = [len(entries[w]) for w in words]
        return {"first": np.array(first, np.int64), "final": np.array(final_of[::-1], bool), "label": np.array(label, np.uint8),
                "target": np.array(target, np.int32), "add": np.array(add, np.int32),
                "start": np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64),
                "ids": np.array([i for w in words for i in entries[w]], np.int32)}

    @staticmethod
    def pack(arrays: dict[str, np.ndarray]) -> bytes:
        """One file: a JSON line with types and places, then the arrays."""
        head, body, at = {}, io.BytesIO(), 0
        for name, a in arrays.items():
            head[name] = [a.dtype.str, len(a), at]
            body.write(a.tobytes() + bytes(-a.nbytes % 8))
            at = body.tell()
        line = json.dumps(head).encode()
        return line + b" " * (-(len(line) + 1) % 8) + b"\n" + body.getvalue()

    @classmethod
    def map(cls, path: str) -> Lexicon:
        """Memory-map a packed file; its pages are shared by all tasks of a machine."""
        with open(path, "rb") as f:
            line = f.readline()
        places = json.loads(line)
        return cls({name: np.memmap(path, np.dtype(kind), "r", len(line) + at, (n,)) if n else np.zeros(0, np.dtype(kind))
                    for name, (kind, n, at) in places.items()})

    def find(self, words: list[bytes]) -> np.ndarray:
        """Rank of each word, -1 where the automaton does not accept it; all words step together."""
        size = np.array([len(w) for w in words], np.int64)
        flat = np.frombuffer(b"".join(words), np.uint8)
        begin = np.concatenate([[0], np.cumsum(size)[:-1]]) if len(words) else size
        rank = np.zeros(len(words), np.int64)
        state = np.zeros(len(words), np.int64)
        live = np.flatnonzero(size <= LEXICON_BYTES)
        out = np.full(len(words), -1, np.int64)
        for step in range(LEXICON_BYTES + 1):
            done = live[size[live] == step]
            done = done[self.final[state[done]]]
            out[done] = rank[done]
            live = live[size[live] > step]
            if not len(live) or not len(self.key):
                break
            key = state[live] << 8 | flat[begin[live] + step]
            arc = np.searchsorted(self.key, key)
            arc[arc == len(self.key)] = 0
            hit = self.key[arc] == key
            live, arc = live[hit], arc[hit]
            rank[live] += self.add[arc]
            state[live] = self.target[arc]
        return out

    def outputs(self, ranks: np.ndarray) -> list[list[int]]:
        """Id sequences of words by rank."""
        begin, end = self.start[ranks], self.start[np.asarray(ranks) + 1]
        most = int((end - begin).max(initial=0))
        rows = self.ids[np.minimum(begin[:, None] + np.arange(most), len(self.ids) - 1)].tolist() if most else []
        return [row[:n] for row, n in zip(rows, (end - begin).tolist())]


class Encoder:
    """Encodes and decodes texts in a task; remembers a bounded number of recent words."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon | None):
        self.vocabulary, self.lexicon = vocabulary, lexicon
        self.names = {i: str(i) for i in vocabulary.bytes}
        special = sorted(vocabulary.special, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        self.memo: dict[str, str] = {}  # word to its ids, joined by commas
        self.odd: dict[str, bytes] = {}  # what a word decodes to, where that is not the word itself

    def _learn(self, words: list[str]) -> None:
        raw = [w.encode("utf-8") for w in words]
        ranks = self.lexicon.find(raw) if self.lexicon is not None else np.full(len(raw), -1)
        merged = iter(self.vocabulary.merge_all([raw[i] for i in np.flatnonzero(ranks < 0)]))
        known = iter(self.lexicon.outputs(ranks[ranks >= 0]) if self.lexicon is not None else [])
        spell, name, memo = self.vocabulary.bytes, self.names, self.memo
        for word, data, found in zip(words, raw, (ranks >= 0).tolist()):
            ids = next(known) if found else next(merged)
            memo[word] = ",".join([name[i] for i in ids])
            if (decoded := b"".join([spell[i] for i in ids])) != data:
                self.odd[word] = decoded

    def encode_batch(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """``(number of ids, digest of the ids, digest of the decoded text)`` of each text."""
        out: list[tuple[int, str, str]] = []
        group, held = [], 0
        for text in texts:  # groups bound the memory whatever the batch size
            group.append(text)
            held += len(text)
            if held > 2_000_000:
                out += self._encode(group)
                group, held = [], 0
        return out + self._encode(group)

    def _pieces(self, text: str) -> list[str]:
        if self.special is None or not self.special.search(text):
            return split(text)
        out = []
        for part in self.special.split(text):
            out += [part] if part in self.vocabulary.special else split(part)
        return out

    def _encode(self, texts: list[str]) -> list[tuple[int, str, str]]:
        if len(self.memo) > _MEMO:
            self.memo.clear()
            self.odd.clear()
        for token, i in self.vocabulary.special.items():
            self.memo[token] = str(i)
        pieces = [self._pieces(t) for t in texts]
        memo = self.memo
        self._learn(list(set().union(*pieces) - memo.keys()))
        out = []
        for words in pieces:
            ids = ",".join(map(memo.__getitem__, words))
            decoded = b"".join([self.odd.get(w) or w.encode() for w in words]) if self.odd else "".join(words).encode()
            out.append((ids.count(",") + 1 if ids else 0, hashlib.sha256(ids.encode()).hexdigest(),
                        hashlib.sha256(decoded.decode("utf-8", "replace").encode() if self.odd else decoded).hexdigest()))
        return out

    def ids(self, text: str) -> list[int]:
        self._encode([text])
        return [int(i) for w in self._pieces(text) for i in self.memo[w].split(",")]

    def decode(self, ids: list[int]) -> str:
        return b"".join([self.vocabulary.bytes[i] for i in ids]).decode("utf-8", "replace")


def frequent_words(docs: DataFrame, most: int = LEXICON_WORDS, id_col: str = "doc_id", text_col: str = "text") -> list[bytes]:
    """The most frequent pretokens over all whole texts, at most ``most`` of them (of equally frequent ones all or none)."""
    rows = id_and_text(docs, id_col, text_col).select("text")

    def count(batches):
        seen: Counter = Counter()

        def flush():
            kept = [(w, n) for w, n in seen.items() if len(w) <= LEXICON_BYTES]
            seen.clear()
            return pa.RecordBatch.from_arrays([pa.array([w for w, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())],
                                              ["word", "n"])
        for batch in batches:
            for text in batch_texts(batch):
                seen.update(split(text.decode("utf-8", "replace")))
                if len(seen) > _COUNTED_AT_ONCE:
                    yield flush()
        yield flush()
    counted = rows.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    top = most_frequent(materialize(counted.filter("n > 1")), most).select("word").collect()
    return sorted(r["word"].encode() for r in top)


def publish(spark: SparkSession, data: bytes, name: str) -> str:
    """Hand a file to all executors, those that start later too; ``SparkFiles.get`` finds it in a task."""
    import tempfile
    unique = f"{name}-{hashlib.sha256(data).hexdigest()[:16]}-{uuid.uuid4().hex[:8]}"
    path = os.path.join(tempfile.mkdtemp(prefix="sondage-"), unique)
    with open(path, "wb") as f:
        f.write(data)
    spark.sparkContext.addFile(path)
    return unique


def _encoder(vocabulary: str, lexicon: str) -> Encoder:
    cache, key = worker_cache(), f"encoder-{vocabulary}-{lexicon}"
    if key not in cache:
        for old in [k for k in cache if k.startswith("encoder-")]:
            del cache[old]
        cache[key] = Encoder(Vocabulary(SparkFiles.get(vocabulary)), Lexicon.map(SparkFiles.get(lexicon)))
    return cache[key]


def encode(docs: DataFrame, tokenizer_path: str, words: int = LEXICON_WORDS, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_tokens, ids_sha256, decoded_sha256``.

    Ids are those of the tokenizer file without added special tokens; strings of special tokens
    in a text become their ids. Null and empty texts have no ids (the digest of nothing); texts of
    any length are encoded whole; rows repeat as they come; an empty table gives no rows."""
    spark = docs.sparkSession
    vocabulary = Vocabulary(tokenizer_path)
    entries = {w: vocabulary.merge(w) for w in frequent_words(docs, words, id_col, text_col)}
    with open(tokenizer_path, "rb") as f:
        spec = publish(spark, f.read(), "vocabulary")
    lexicon = publish(spark, Lexicon.pack(Lexicon.compile(entries)), "lexicon")
    rows = id_and_text(docs, id_col, text_col)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = _encoder(spec, lexicon).encode_batch([t.decode("utf-8", "replace") for t in batch_texts(batch)])
        n, ids, decoded = zip(*found)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return map_batches(rows, run, f"doc_id {field_type(rows, 'doc_id')}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
