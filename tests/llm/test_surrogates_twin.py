"""The surrogates again in plain Python: detection, draws, collisions and formats, compared text by text."""

from __future__ import annotations

import hashlib
import random

import regex
from compare import SF_DIR

from sondage.llm import pii

KEY = "twin key"
LUHN = {c: (c, 2 * c - (9 if c > 4 else 0)) for c in range(10)}
# In these patterns digits and word characters are those of ASCII, letters all there are.
ANY = regex.compile(pii.ANY.replace("[\\w", "[A-Za-z0-9_").replace("[\\d", "[0-9").replace("\\w", "[A-Za-z0-9_]").replace("\\d", "[0-9]"))
LIKE = regex.compile(pii._LIKE, regex.ASCII)
OCTET = pii._OCTET


def digits(s):
    return "".join(c for c in s if c in "0123456789")


def luhn(s):
    return sum(LUHN[int(c)][i % 2] for i, c in enumerate(reversed(s))) % 10


def mod97(account):
    r = 0
    for c in account[4:] + account[:4]:
        r = (r * 10 + int(c)) % 97 if c.isdigit() else (r * 100 + ord(c) - 55) % 97
    return r


def kind_of(m):
    if "@" in m:
        return "email"
    if regex.fullmatch(rf"{OCTET}(\.{OCTET}){{3}}", m, regex.ASCII):
        return "ip"
    if regex.fullmatch(r"\d{3}-\d{2}-\d{4}", m, regex.ASCII):
        return "ssn"
    if regex.match(r"[A-Z]{2}\d{2}", m, regex.ASCII):
        return "iban" if mod97(m.replace(" ", "")) == 1 else None
    if m[0].isalpha():
        return "person"
    if m[0] in "+(" or regex.fullmatch(r"\d{3}[ .-]\d{3}[ .-]\d{4}", m, regex.ASCII):
        return "phone"
    return "card" if len(digits(m)) >= 13 and luhn(digits(m)) == 0 else None


def inside(run):
    parts, done = [], 0
    for start in [m.start() for m in regex.finditer(r"\d+[ -]*", run, regex.ASCII)]:
        if start < done:
            continue
        ahead, free = run[start:start + 40], start == 0 or run[start - 1] != "-"
        hit = None
        for kind, pattern in (("ssn", r"\d{3}-\d{2}-\d{4}(?![\d-])"), ("phone", r"\d{3}[ -]\d{3}[ -]\d{4}(?![\d-])")):
            m = regex.match(pattern, ahead, regex.ASCII)
            if hit is None and free and m:
                hit = kind, m[0]
        for n in range(18, 11, -1):
            m = regex.match(rf"\d(?:[ -]?\d){{{n}}}(?!\d)", ahead, regex.ASCII)
            if hit is None and m and LIKE.fullmatch(m[0]) and luhn(digits(m[0])) == 0:
                hit = "card", m[0]
        if hit:
            parts += ([(None, run[done:start])] if start > done else []) + [hit]
            done = start + len(hit[1])
    if parts:
        return parts + ([(None, run[done:])] if done < len(run) else [])
    odd = regex.fullmatch(r"\d(?:[ -]?\d){12,18}", run, regex.ASCII) and luhn(digits(run)) == 0
    return [("card" if odd else None, run)]


def found(m):
    kind = kind_of(m)
    return inside(m) if kind == "card" or (kind is None and regex.fullmatch(r"\d[\d -]*", m, regex.ASCII)) else [(kind, m)]


def script(w):
    return "cyrillic" if regex.search(r"\p{Cyrillic}", w) else "greek" if regex.search(r"\p{Greek}", w) else "latin"


def tokens(kind, m):
    if kind != "person":
        norm = {"email": m.lower(), "ip": m, "iban": m.replace(" ", ""), "phone": regex.sub(r"^1(\d{10})$", r"\1", digits(m))}.get(kind, digits(m))
        return [(kind, norm, m)]
    words = regex.findall(r"\p{L}+|\P{L}+", m)
    named = {g: {n for (_, h), names in pii.GIVEN.items() if h == g for n in names} for g in "mf"}
    gender = next((g for g in "mf" if words[0] in pii.TITLES[g]), "x")
    first = 2 if gender != "x" else 0
    out = []
    for i, w in enumerate(words):
        role = (None if not w[0].isalpha() or (i == 0 and first == 2) else "m" if w in named["m"] else "f" if w in named["f"]
                else gender if i == first and len(words) > first + 1 else "s")
        out.append((role and f"{role}_{script(w)}", w.lower(), w))
    return out


def candidate(kind, norm, draw, host):
    seed = f"{KEY}:{kind}:{norm}:{draw}"
    stream = "".join(hashlib.sha512(f"{seed}:{i}".encode()).hexdigest() for i in range(3))

    def number(i):
        return int(stream[i % 96 * 4:i % 96 * 4 + 4], 16)

    def spelled(text):
        return "".join(chr(number(i) % 26 + 97) if "a" <= c <= "z" else chr(number(i) % 26 + 65) if "A" <= c <= "Z"
                       else chr(number(i) % 10 + 48) if "0" <= c <= "9" else c for i, c in enumerate(text))

    def numbered(text, low):
        return "".join(c if low(i) < 0 else str(low(i) + number(i) % (10 - low(i))) for i, c in enumerate(text))
    longer = (draw - 8 + 3) // 4 if draw > 8 else 0
    more = [number(96 - i) for i in range(1, longer + 1)]
    letters = "".join(chr(n % 26 + 97) for n in more)
    if kind == "host":
        name, last = norm.rsplit(".", 1)
        return f"{spelled(name)}{letters}.{last}"
    if kind == "email":
        return f"{spelled(norm.split('@')[0])}{letters}@{host}"
    if kind == "phone":
        ahead = max(len(norm) - 10, 0)
        return numbered(norm, lambda i: -1 if i < ahead else 2 if i in (ahead, ahead + 3) else 0) + "".join(str(n % 10) for n in more)
    if kind == "card":
        body = numbered(norm[:-1], lambda i: -1 if i == 0 else 0)
        return body + str((10 - luhn(body + "0")) % 10)
    if kind == "ssn":
        out = numbered(norm, lambda i: 1 if i in (3, 5, 8) else 2 if i == 0 else 0)
        return out[0].translate(str.maketrans("6789", "1234")) + out[1:]
    if kind == "ip":
        return ".".join(str(a + number(i) % (b - a + 1)) for i, (a, b) in enumerate(((11, 126), (0, 255), (0, 255), (1, 254))))
    if kind == "iban":
        tail = spelled(norm[4:])
        return f"{norm[:2]}{98 - mod97(norm[:2] + '00' + tail):02d}{tail}"
    role, of = kind.split("_")
    words = pii.SYLLABLES[of]
    names = pii.GIVEN.get((of, role)) or (pii.GIVEN[of, "m"] + pii.GIVEN[of, "f"] if role == "x" else None)
    if names and draw < pii.LISTED_DRAWS:
        return names[number(4) % len(names)].lower()
    return "".join(words[number(i) % len(words)] for i in range(3)) + "".join(words[n % len(words)] for n in more) + pii.ENDINGS[of, role]


def settled(entities):
    """(kind, norm) -> surrogate for (kind, norm, host)."""
    taken, out, waiting = {(k, n) for k, n, _ in entities}, {}, sorted(entities, key=str)
    for draw in range(pii.ROUNDS):
        won = {}
        for kind, norm, host in waiting:
            core = candidate(kind, norm, draw, host)
            if (kind, core) not in taken:
                won[kind, core] = min(won.get((kind, core), norm), norm)
        out |= {(kind, norm): core for (kind, core), norm in won.items()}
        taken |= set(won)
        waiting = [e for e in waiting if e[:2] not in out]
        if not waiting:
            return out
    raise AssertionError


def filled(raw, core, allowed):
    chars = iter(core)
    return "".join(next(chars, "") if regex.match(allowed, c) else c for c in raw)


def rendered(kind, raw, core):
    if core is None:
        return raw
    if kind == "phone":
        dialled = ("1" if regex.fullmatch(r"1\d{10}", digits(raw)) else "") + core
        return filled(raw, dialled, "[0-9]") + dialled[len(digits(raw)):]
    if kind in ("card", "ssn", "iban"):
        return filled(raw, core, "[A-Z0-9]" if kind == "iban" else "[0-9]")
    if kind in ("email", "ip"):
        return core
    if raw == raw.upper() and len(raw) > 1:
        return core.upper()
    return core[:1].upper() + core[1:] if raw == raw[:1].upper() + raw[1:].lower() else core


def twin(texts):
    parts = {t: [[(kind, tokens(kind, m)) for kind, m in found(hit[0])] for hit in ANY.finditer(t)] for t in set(texts) if t}
    entities = {(k, n) for hits in parts.values() for hit in hits for _, ts in hit for k, n, _ in ts if k}
    hosts = settled({("host", n.split("@")[1], None) for k, n in entities if k == "email"})
    cores = settled({(k, n, hosts["host", n.split("@")[1]] if k == "email" else None) for k, n in entities})
    out = []
    for t in texts:
        if not t:
            out.append((0, "", t))
            continue
        kinds = [kind for hit in parts[t] for kind, _ in hit if kind]
        made = iter(["".join(rendered(k, raw, cores.get((k, n))) for _, ts in hit for k, n, raw in ts) for hit in parts[t]])
        out.append((len(kinds), ",".join(kinds), ANY.sub(lambda _: next(made), t)))
    return out


def test_surrogates_equal_their_twin(spark):
    rng = random.Random(7)
    bits = ["ann.42@mail8.example.com", "Bob@a.com", "c@b.com", "x@c.com", "555-123-4567", "+1 (988) 555-2485", "+49 30 1234567", "4337166598464399",
            "4337 1665 9846 4399", "123-45-6789", "987-65-4321", "42.144.35.254", "GB82 WEST 1234 5698 7654 32", "GB00WEST12345698765432",
            "Mr. John Smith", "Mrs Anna Smith", "MARY JONES", "Mary Jones-Brown", "Господин Иван Петров", "Νίκος Παππάς", "Frau Müller", "2024", "77", "no one",
            "3782 822463 10005", "v1.2.3.4.5", "12", "$5.00", "and", "\n", "Herr Klaus"]
    texts = [" ".join(rng.choice(bits) for _ in range(rng.randint(1, 9))) for _ in range(250)] + [None, "", " ", "Mr"]
    texts += [r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").orderBy("doc_id").collect()]
    got = {r["doc_id"]: r for r in pii.replace(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), KEY).collect()}
    want = twin(texts)
    assert sum(n > 0 for n, _, _ in want) > 200
    for i, (n, kinds, text) in enumerate(want):
        assert (got[i]["n_entities"], got[i]["kinds"], got[i]["text"]) == (n, kinds, text), texts[i]
