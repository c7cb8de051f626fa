"""Secret scan: three fixed patterns, and literals that reach a sensitive name by assignment.

The lexer reads source and configuration syntax (``name = "x"``, ``name: x``, ``"name": "x"``,
``name => "x"``, ``obj["name"] = "x"``, ``export NAME=x``, ``<name>x</name>``, ``--name x``),
joins neighbouring and ``+``-joined literals, and follows constants: after ``A = "x"`` and
``password = A`` the literal ``x`` counts for ``password``. A literal is reported if the most
sensitive name it reaches, weighed with how random the literal looks, passes a threshold.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import batch_texts, field_type, id_and_text, map_batches, sha256_hex

# The base patterns and the least number of characters of what they find.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_ASSIGN, LEAST_ACCESS = 6, 20
KINDS = ("assign", "access", "hex", "literal")
_ORDER = {k: i for i, k in enumerate(KINDS)}
_BASE_HINTS = ("passw", "secret", "token", "api")

# How sensitive the parts of a name are; the strongest part counts.
NAME_WEIGHTS = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "pass": 0.7, "secret": 1.0, "secrets": 1.0, "token": 0.9,
    "apikey": 1.0, "credential": 0.9, "credentials": 0.9, "cred": 0.8, "creds": 0.9, "auth": 0.7, "authorization": 0.8,
    "bearer": 0.9, "private": 0.6, "privatekey": 1.0, "accesskey": 1.0, "secretkey": 1.0, "signing": 0.6, "salt": 0.6,
    "key": 0.6, "dsn": 0.6, "pin": 0.9, "otp": 0.9, "jwt": 0.9, "cookie": 0.6, "session": 0.6,
}
THRESHOLD = 0.55
_STEMS = ("pass", "pwd", "secret", "token", "key", "cred", "auth", "bearer", "private", "signing", "salt", "dsn", "otp", "jwt", "cookie",
          "session", "pin")
# Values that stand for a secret rather than being one.
PLACEHOLDERS = frozenset(("changeme", "change_me", "example", "placeholder", "password", "passwd", "secret", "token", "none",
                          "null", "true", "false", "undefined", "redacted", "xxxxxx", "yourpassword", "your_password", "string"))
LEAST_LITERAL = 6
# Bits of a random literal (length times those of a character of its alphabet) that score least and in full.
LEAST_BITS, FULL_BITS = 19.9, 48.0
_LEAST_SCORE = 0.62  # six random digits pass at the names that weigh 0.9

_NAME = r"(?<![\w$.\-])[A-Za-z_$][\w$.\-]*+"  # possessive and only at its first character: linear on any text
_QUOTED = r'"""(?:[^"\\]|\\.|"(?!""))*"""|\'\'\'(?:[^\'\\]|\\.|\'(?!\'\'))*\'\'\'|"(?:[^"\\\n]|\\.)*"|\'(?:[^\'\\\n]|\\.)*\'|`[^`\n]*`'
_TARGET = re.compile(
    rf"""(?:(?<![\w\-])--(?P<flag>[A-Za-z][\w\-]*+)(?:=|\x20++))"""
    rf"""|(?:<(?P<tag>[A-Za-z_][\w.\-]*+)>)"""
    rf"""|(?:\[\s*(?P<item>"[^"\n]*"|'[^'\n]*')\s*\]|(?P<quoted>"[\w$.\- ]++"|'[\w$.\- ]++')|(?P<name>{_NAME}))"""
    rf"""(?:\x20*:\x20*[\w<>\[\], ]{{1,40}}?)?\x20*+(?P<op>:=|=>|=(?!=)|:(?!:|//))[\x20\t]*""", re.A)
_VALUE = re.compile(rf"(?P<lit>{_QUOTED})|(?P<ref>[A-Za-z_$][\w$.\-]*+)(?P<call>\x20*\()?|(?P<bare>[^\s\"'`,;{{}}()\[\]<>#]+)", re.S | re.A)
_JOIN = re.compile(r"[\x20\t]*(?:\+|\.\.)?[\x20\t\n]*", re.A)
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")


def name_weight(name: str) -> float:
    """Weight of the most sensitive part of a name, split at case changes and punctuation."""
    parts = [p.lower() for p in _PARTS.findall(name)]
    both = [a + b for a, b in zip(parts, parts[1:])]
    return max((NAME_WEIGHTS.get(p, 0.0) for p in [*parts, *both]), default=0.0)


_RUNS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_UNSPOKEN = re.compile(r"[^aeiouy]{5}|[aeiouy]{4}")


def _like_words(value: str) -> bool:
    """Whether most characters are in runs of letters that can be spoken, as words and names of code are."""
    least = 4 if any(map(str.isdigit, value)) else 3
    spoken = 0
    for run in map(str.lower, _RUNS.findall(value)):
        vowels = sum(map(run.count, "aeiouy"))
        if len(run) >= least and 0.25 <= vowels / len(run) <= 0.67 and not _UNSPOKEN.search(run):
            spoken += len(run)
    return spoken > len(value) / 2


@lru_cache(10_000)
def _expected_entropy(n: int, size: int) -> float:
    """Mean bits per character that ``n`` random draws from ``size`` characters show."""
    chance, odds, total = (1 - 1 / size) ** n, 1 / (size - 1), 0.0
    for k in range(1, n + 1):
        chance *= (n - k + 1) / k * odds
        total -= chance * k / n * math.log2(k / n)
    return total * size


def _drawn(value: str, entropy: float, kinds: list[bool]) -> float:
    """0 to 1: how far the literal looks like random draws from its own alphabet, and how many bits it then has.
    Words, names of code and ascending or repeated characters score nothing."""
    n = len(value)
    size = 16 if kinds[0] and re.fullmatch("[0-9a-f]+|[0-9A-F]+", value) and any(kinds[1:3]) else sum(
        c for c, there in zip((10, 26, 26, 8), kinds) if there)
    steps = [abs(ord(b) - ord(a)) for a, b in zip(value, value[1:])]
    bits = n * math.log2(size)
    if bits < LEAST_BITS or sum(s <= 1 for s in steps) > 0.6 * len(steps) or (size != 16 and _like_words(value)):
        return 0.0
    even = min(1.0, entropy / (0.85 * _expected_entropy(min(n, 256), size)))
    return even ** 2 * (_LEAST_SCORE + (1 - _LEAST_SCORE) * min(1.0, (bits - LEAST_BITS) / (FULL_BITS - LEAST_BITS)))


def randomness(value: str) -> float:
    """0 to 1: bits per character against 4, with a bonus for mixed kinds of characters, or if that is more the
    bits against what random draws from the literal's own alphabet show."""
    n = len(value)
    if n < LEAST_LITERAL or value.lower() in PLACEHOLDERS or len(set(value)) < 4 or value[:2] in ("${", "{{", "<%") or " " in value:
        return 0.0
    entropy = -sum(c / n * math.log2(c / n) for c in map(value.count, set(value)))
    kinds = [any(f(ch) for ch in value) for f in (str.isdigit, str.islower, str.isupper)] + [any(not ch.isalnum() for ch in value)]
    mixed = min(1.0, entropy / 4) * (0.45 + 0.275 * min(sum(kinds) - 1, 2))
    return max(mixed, _drawn(value, entropy, kinds) if any(kinds[:3]) else 0.0)


def _operands(text: str, at: int) -> tuple[list[tuple[str, int, int]], int]:
    """Literals ``("lit", start, end)`` and references of one value, with where it ends."""
    found: list[tuple[str, int, int]] = []
    while True:
        m = _VALUE.match(text, at)
        if m is None:
            return found, at
        if m["lit"] is not None:
            width = 3 if m["lit"][:3] in ('"""', "'''") else 1
            found.append(("lit", m.start() + width, m.end() - width))
        elif m["ref"] is not None and not m["call"]:
            found.append(("ref", m.start("ref"), m.end("ref")))
        elif m["bare"] is not None:
            found.append(("lit", m.start(), m.end()))
        at = m.end()
        joint = _JOIN.match(text, at)
        following = text[joint.end():joint.end() + 1]
        plus = "+" in joint[0] or ".." in joint[0]
        if not (plus or (m["lit"] is not None and following in ("'", '"') and "\n" not in joint[0])):
            return found, at
        at = joint.end()


def name_literal_pairs(text: str) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """``(name, operands)`` of every assignment-like construct, in text order."""
    pairs, at = [], 0
    while (m := _TARGET.search(text, at)) is not None:
        name = m["flag"] or m["tag"] or (m["item"] or m["quoted"] or "").strip("\"'[] ") or m["name"] or ""
        operands, end = _operands(text, m.end())
        pairs.append((name, operands))
        at = max(end if operands and operands[-1][0] == "lit" else m.end(), m.start() + 1)
    return pairs


def assigned_literals(text: str) -> list[tuple[int, int]]:
    """Spans of the literals that reach a sensitive name and look random enough."""
    low = text.lower()
    if not any(s in low for s in _STEMS):
        return []
    pairs = name_literal_pairs(text)
    weight = {}
    for name, _ in pairs:
        weight.setdefault(name, name_weight(name))
    # Sensitivity flows from a target to the constants assigned to it, through any number of names. The most
    # sensitive names go first, so that no name is visited twice.
    flows: dict[str, set[str]] = {}
    for name, operands in pairs:
        for kind, start, end in operands:
            if kind == "ref" and text[start:end] != name and text[start:end] in weight:
                flows.setdefault(name, set()).add(text[start:end])
    reached: set[str] = set()
    for first in sorted(flows, key=weight.__getitem__, reverse=True):
        waiting = [first]
        while waiting:
            name = waiting.pop()
            if name not in reached:
                reached.add(name)
                weight[name] = max(weight[name], weight[first])
                waiting.extend(flows.get(name, ()))
    spans = set()
    for name, operands in pairs:
        if not weight[name]:
            continue
        whole = "".join(text[s:e] for k, s, e in operands if k == "lit")
        for kind, start, end in operands:
            value = text[start:end]
            if kind == "ref":  # an unquoted value, as in name=value
                if value in weight:
                    continue
                whole = value
            if weight[name] * randomness(whole) >= THRESHOLD and end > start:
                spans.add((start, end))
    return sorted(spans)


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """``(start, kind, end)`` of the three fixed patterns."""
    found = []
    low = text.lower()
    if any(h in low for h in _BASE_HINTS):
        found += [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    if "AKIA" in text:
        found += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [(m.start(), "hex", m.end()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], _ORDER[s[1]], s[2]))


def scan_text(text: str) -> tuple[list[tuple[int, str, int]], list[tuple[int, str, int]]]:
    """Base spans, and all spans; a literal that a base span covers is not repeated."""
    base = base_spans(text)
    starts, reach = [b for b, _, _ in base], list(accumulate((e for _, _, e in base), max))

    def covered(start: int, end: int) -> bool:
        before = bisect_right(starts, start)
        return before > 0 and reach[before - 1] >= end
    extra = [(s, "literal", e) for s, e in assigned_literals(text) if not covered(s, e)]
    return base, sorted(base + extra, key=lambda s: (s[0], _ORDER[s[1]], s[2]))


def _listed(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in spans)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_assign, n_access, n_hex, n_literal, base, spans``.

    ``base`` and ``spans`` list ``kind:start:end`` (code points, end exclusive), by start and
    kind. Null texts count as empty and have none; rows repeat as they come; a text of any length
    is read whole; an empty table gives no rows."""
    rows = id_and_text(docs, id_col, text_col)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, base, spans = [], [], []
        for text in batch_texts(batch):
            fixed, every = scan_text(text.decode("utf-8", "replace"))
            kinds = [k for _, k, _ in every]
            counts.append([kinds.count(k) for k in KINDS])
            base.append(_listed(fixed))
            spans.append(_listed(every))
        columns = [pa.array(list(c), pa.int64()) for c in zip(*counts)]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *columns, pa.array(base, pa.string()), pa.array(spans, pa.string())],
            ["doc_id", *(f"n_{k}" for k in KINDS), "base", "spans"])
    return map_batches(rows, run, f"doc_id {field_type(rows, 'doc_id')}, n_assign bigint, n_access bigint, n_hex bigint, "
                                  "n_literal bigint, base string, spans string")


def digest(base: str) -> str:
    return sha256_hex(base.encode())
