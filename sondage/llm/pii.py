"""Surrogates for personal data, in DataFrame functions alone.

Found entities (mail addresses, phone, card and social security numbers, IP addresses, account
numbers, names of persons) are replaced by keyed surrogates of the same type and format: digits
for digits, valid check digits, first names of the same gender and script. The same entity gets
the same surrogate everywhere, also when it is written in another format (coreference). All
distinct entities are brought together to check that no two of one type get the same surrogate
and that none is the value of a real entity; the losers draw again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.distribute import materialize
from .common import id_and_text

KINDS = ("email", "iban", "ssn", "phone", "card", "ip", "person")  # in the order in which they are tried at a place
ROUNDS = 64
LISTED_DRAWS = 3
_PLAIN_DRAWS = 8  # later draws are longer

# Given names by script and gender, and syllables of other names.
GIVEN = {
    ("latin", "m"): ("James", "John", "Robert", "Michael", "William", "David", "Thomas", "Daniel", "Paul", "Peter", "Hans", "Jürgen",
                     "Klaus", "Pierre", "Jean", "Luc", "Carlos", "Juan", "Miguel", "Pablo"),
    ("latin", "f"): ("Mary", "Patricia", "Jennifer", "Linda", "Elizabeth", "Susan", "Sarah", "Karen", "Anna", "Laura", "Ursula", "Sabine",
                     "Monika", "Marie", "Sophie", "Claire", "Carmen", "Lucía", "Isabel", "Elena"),
    ("cyrillic", "m"): ("Иван", "Сергей", "Дмитрий", "Алексей", "Николай", "Павел", "Михаил", "Андрей"),
    ("cyrillic", "f"): ("Анна", "Мария", "Ольга", "Елена", "Наталья", "Ирина", "Татьяна", "Светлана"),
    ("greek", "m"): ("Γιώργος", "Νίκος", "Κώστας", "Δημήτρης", "Γιάννης", "Παύλος"),
    ("greek", "f"): ("Μαρία", "Ελένη", "Κατερίνα", "Σοφία", "Άννα", "Δέσποινα"),
}
TITLES = {
    "m": ("Mr", "Mister", "Herr", "Sr", "Señor", "Monsieur", "Господин", "Κύριος"),
    "f": ("Mrs", "Ms", "Miss", "Frau", "Sra", "Señora", "Mme", "Madame", "Mlle", "Госпожа", "Κυρία"),
}
SYLLABLES = {
    "latin": ("ba", "be", "bo", "da", "del", "do", "fa", "fen", "ga", "gor", "ha", "hel", "ka", "kin", "la", "lo", "mar", "mi", "na", "nor",
              "pa", "per", "ra", "ro", "sa", "sel", "ta", "ten", "va", "vel", "wa", "win"),
    "cyrillic": ("ба", "ве", "го", "да", "же", "за", "ка", "ла", "ми", "но", "па", "ро", "са", "те", "фо", "ха"),
    "greek": ("βα", "γε", "δο", "ζα", "θε", "κα", "λα", "μι", "νο", "πα", "ρο", "σα", "τε", "φο", "χα", "ψε"),
}
ENDINGS = {("latin", "m"): "o", ("latin", "f"): "a", ("cyrillic", "m"): "й", ("cyrillic", "f"): "я", ("greek", "m"): "ς", ("greek", "f"): "α",
           ("latin", "s"): "son", ("cyrillic", "s"): "енко", ("greek", "s"): "ίδης", ("latin", "x"): "e", ("cyrillic", "x"): "а", ("greek", "x"): "η"}

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_NAME = r"\p{Lu}\p{Ll}++"
_GIVEN_WORDS = "|".join(sorted({n for names in GIVEN.values() for n in names}))
_TITLE_WORDS = "|".join(sorted({t for titles in TITLES.values() for t in titles}))
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    # All digits that blanks and hyphens join, if they are enough for a card; ``_found`` looks for what is in them.
    "card": r"(?<![\w.+-])(?=\d(?:[ -]?\d){12})\d[\d -]*(?<=\d)(?![\w-]|(?<!\d{4})\.\d{1,3}\.\d|[.%+][A-Za-z0-9._%+-]*+@\w|@\w)",
    "phone": r"(?<![\w+.-])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\w-])|(?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,4}(?!\d)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "ip": rf"(?<![\w.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\w|\.\d)",
    "person": rf"(?<!\p{{L}})(?:(?:{_TITLE_WORDS})\.? {_NAME}(?:[ -]{_NAME}){{0,2}}|(?:{_GIVEN_WORDS}) {_NAME}(?:-{_NAME})?)(?!\p{{L}}|[A-Za-z0-9._%+-]*+@\w)",
}
ANY = "|".join(f"(?:{PATTERNS[k]})" for k in KINDS)
NUMBERED = "|".join(f"(?:{PATTERNS[k]})" for k in KINDS if k != "person")
# Groups of digits of like format: one group, equal ones of which the last may be shorter, 4-6-5 or 4-6-4.
_LIKE = "|".join([r"\d+", *(rf"\d{{{n}}}(?:{sep}\d{{{n}}})+(?:{sep}\d{{1,{n}}})?" for sep in " -" for n in range(1, 10)),
                  *(rf"\d{{4}}{sep}\d{{6}}{sep}\d{{4,5}}" for sep in " -")])
_STREAM = 96


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _chars(c: Column) -> Column:
    return F.split(c, "")


def _luhn(digits: Column) -> Column:
    """Luhn sum modulo 10 of a string of digits."""
    values = F.transform(_chars(F.reverse(digits)), lambda c, i: F.when(
        i % 2 == 0, c.cast("int")).otherwise(c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(values, F.lit(0), lambda a, x: a + x) % 10


def _mod97(account: Column) -> Column:
    """Remainder by which account numbers are checked: letters count 10 to 35, the first four characters last."""
    turned = F.concat(F.substr(account, F.lit(5)), F.substr(account, F.lit(1), F.lit(4)))
    return F.aggregate(_chars(turned), F.lit(0).cast("bigint"), lambda a, c: F.when(
        c.rlike("[0-9]"), (a * 10 + c.cast("bigint")) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97))


def kind_of(match: Column) -> Column:
    """Type of a found string; null where a check digit shows that it is something else."""
    digits, packed = _digits(match), F.regexp_replace(match, " ", "")
    return (F.when(match.contains("@"), "email")
            .when(match.rlike(rf"^{_OCTET}(\.{_OCTET}){{3}}$"), "ip")
            .when(match.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
            .when(match.rlike(r"^[A-Z]{2}\d{2}"), F.when(_mod97(packed) == 1, F.lit("iban")))
            .when(match.rlike(r"^\p{L}"), "person")
            .when(match.rlike(r"^\+|^\(|^\d{3}[ .-]\d{3}[ .-]\d{4}$"), "phone")
            .when((F.length(digits) >= 13) & (_luhn(digits) == 0), "card"))


def _inside(run: Column) -> Column:
    """``kind, match`` of the parts of a run of digits, blanks and hyphens, in order; what is none has a null kind.

    At every group of digits the numbers of social security and phones are tried, then the longest card of like
    format whose check digit holds. A run in which nothing is found may be one card in any format."""
    def longest(c: Column, at: Column) -> Column:
        ahead = F.substr(run, at, F.lit(40))
        before = F.when(at > 1, F.substr(run, at - 1, F.lit(1))).otherwise(" ")
        ssn = F.when(before != "-", F.regexp_extract(ahead, r"^\d{3}-\d{2}-\d{4}(?![\d-])", 0))
        phone = F.when(before != "-", F.regexp_extract(ahead, r"^\d{3}[ -]\d{3}[ -]\d{4}(?![\d-])", 0))
        card = F.filter(F.array(*(F.regexp_extract(ahead, rf"^\d(?:[ -]?\d){{{n}}}(?!\d)", 0) for n in range(18, 11, -1))),
                        lambda m: (m != "") & m.rlike(f"^(?:{_LIKE})$") & (_luhn(_digits(m)) == 0))
        return (F.when(ssn != "", F.struct(F.lit("ssn").alias("kind"), at.alias("at"), ssn.alias("match")))
                .when(phone != "", F.struct(F.lit("phone").alias("kind"), at.alias("at"), phone.alias("match")))
                .when(F.size(card) > 0, F.struct(F.lit("card").alias("kind"), at.alias("at"), F.get(card, F.lit(0)).alias("match"))))
    groups = F.regexp_extract_all(run, F.lit(r"(\d+[ -]*)"), F.lit(1))
    none = F.array().cast("array<struct<kind:string,match:string>>")
    part = "struct<kind:string,match:string>"

    def raw(start: Column, end: Column) -> Column:
        return F.when(end > start, F.array(F.struct(F.lit(None).cast("string").alias("kind"), F.substr(run, start, end - start).alias("match"))
                                           .cast(part))).otherwise(none)
    starts = F.aggregate(groups, F.struct(F.lit(1).alias("next"), F.array().cast("array<int>").alias("starts")), lambda s, g: F.struct(
        (s["next"] + F.length(g)).alias("next"), F.concat(s["starts"], F.array(s["next"])).alias("starts")))["starts"]
    found = F.filter(F.transform(starts, lambda at: longest(run, at)), lambda c: c.isNotNull())
    done = F.aggregate(found, F.struct(F.lit(1).alias("next"), none.alias("parts")), lambda s, c: F.when(c["at"] < s["next"], s).otherwise(F.struct(
        (c["at"] + F.length(c["match"])).alias("next"),
        F.concat(s["parts"], raw(s["next"], c["at"]), F.array(F.struct(c["kind"].alias("kind"), c["match"].alias("match")).cast(part))).alias("parts"))),
        lambda s: F.concat(s["parts"], raw(s["next"], F.length(run) + 1)))
    odd = run.rlike(r"^\d(?:[ -]?\d){12,18}$") & (_luhn(_digits(run)) == 0)
    whole = F.array(F.struct(F.when(odd, F.lit("card")).alias("kind"), run.alias("match")).cast(part))
    return F.when(F.exists(done, lambda p: p["kind"].isNotNull()), done).otherwise(whole)


def _found(match: Column) -> Column:
    """``kind, match`` of the parts of a found string: one, but for a run of digits, which may hold several."""
    run = match.rlike(r"^\d[\d -]*$") & kind_of(match).isNull() | (kind_of(match) == "card")
    return F.when(run, _inside(match)).otherwise(F.array(F.struct(kind_of(match).alias("kind"), match.alias("match"))))


def _script(c: Column) -> Column:
    return F.when(c.rlike(r"\p{IsCyrillic}"), "cyrillic").when(c.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _listed(c: Column, words) -> Column:
    return c.isin(*words)


def _tokens(match: Column, kind: Column) -> Column:
    """``(kind, norm, raw)`` of the parts of a match: one for most, one per word for persons. ``norm`` is what
    equal entities share whatever their format; parts without a kind stay as they are."""
    words = F.regexp_extract_all(match, F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    males, females = ([n for (_, g), names in GIVEN.items() if g == want for n in names] for want in ("m", "f"))
    titles = [t for ts in TITLES.values() for t in ts]
    gender = F.when(_listed(words[0], TITLES["m"]), "m").when(_listed(words[0], TITLES["f"]), "f").otherwise("x")
    first = F.when(_listed(words[0], titles), F.lit(2)).otherwise(F.lit(0))
    total = F.size(words)

    def part(w: Column, i: Column) -> Column:
        own = (F.when(~w.rlike(r"^\p{L}") | ((i == 0) & (first == 2)), F.lit(None).cast("string"))
               .when(_listed(w, males), F.concat(F.lit("m_"), _script(w))).when(_listed(w, females), F.concat(F.lit("f_"), _script(w)))
               .when((i == first) & (total > first + 1), F.concat(gender, F.lit("_"), _script(w)))
               .otherwise(F.concat(F.lit("s_"), _script(w))))
        return F.struct(own.alias("kind"), F.lower(w).alias("norm"), w.alias("raw"))
    norm = (F.when(kind == "email", F.lower(match)).when(kind == "ip", match)
            .when(kind == "iban", F.regexp_replace(match, " ", ""))
            # A North American number is the same with and without its country code.
            .when(kind == "phone", F.regexp_replace(_digits(match), "^1([0-9]{10})$", "$1")).otherwise(_digits(match)))
    return F.when(kind == "person", F.transform(words, part)).otherwise(
        F.array(F.struct(kind.alias("kind"), norm.alias("norm"), match.alias("raw"))))


def candidate(key: str, kind: Column, norm: Column, draw: Column, host: Column | None = None) -> Column:
    """Surrogate of an entity in its normal form, a function of key, type, entity and number of the draw. A mail address
    is at the surrogate ``host`` of its domain; a domain keeps its last label."""
    seed = F.concat_ws(":", F.lit(key), kind, norm, draw.cast("string"))
    stream = F.concat(*(F.sha2(F.concat(seed, F.lit(f":{i}")).cast("binary"), 512) for i in range(3)))

    def number(i: Column) -> Column:
        return F.conv(F.substr(stream, F.pmod(i, F.lit(_STREAM)) * 4 + 1, F.lit(4)), 16, 10).cast("int")

    def pick(words, i: int) -> Column:
        return F.element_at(F.array(*map(F.lit, words)), number(F.lit(i)) % len(words) + 1)

    def spelled(text: Column) -> Column:
        return F.array_join(F.transform(_chars(text), lambda c, i: F.when(c.rlike("[a-z]"), F.chr(number(i) % 26 + 97))
                                        .when(c.rlike("[A-Z]"), F.chr(number(i) % 26 + 65))
                                        .when(c.rlike("[0-9]"), F.chr(number(i) % 10 + 48)).otherwise(c)), "")

    def digits(text: Column, low: Callable[[Column], Column]) -> Column:
        """Digit by digit; ``low`` tells the least digit at a place, -1 to keep it."""
        return F.array_join(F.transform(_chars(text), lambda c, i: F.when(low(i) < 0, c).otherwise(
            (low(i) + number(i) % (F.lit(10) - low(i))).cast("string"))), "")
    longer = F.when(draw > _PLAIN_DRAWS, F.floor((draw - _PLAIN_DRAWS + 3) / 4)).otherwise(0).cast("int")  # so that no set runs out
    more = F.transform(F.sequence(F.lit(1), F.greatest(longer, F.lit(1))), lambda i: number(F.lit(_STREAM) - i))
    size = F.length(norm)
    ahead = F.greatest(size - 10, F.lit(0))  # digits of the country
    phone = digits(norm, lambda i: F.when(i < ahead, -1).when((i == ahead) | (i == ahead + 3), 2).otherwise(0))
    phone = F.when(longer > 0, F.concat(phone, F.array_join(F.transform(more, lambda n: (n % 10).cast("string")), ""))).otherwise(phone)
    body = digits(F.substr(norm, F.lit(1), size - 1), lambda i: F.when(i == 0, -1).otherwise(0))
    card = F.concat(body, ((10 - _luhn(F.concat(body, F.lit("0")))) % 10).cast("string"))
    ssn = digits(norm, lambda i: F.when(i.isin(3, 5, 8), 1).when(i == 0, 2).otherwise(0))
    ssn = F.concat(F.translate(F.substr(ssn, F.lit(1), F.lit(1)), "6789", "1234"), F.substr(ssn, F.lit(2)))
    ip = F.concat_ws(".", *((low + number(F.lit(i)) % (high - low + 1)).cast("string") for i, (low, high) in enumerate(
        ((11, 126), (0, 255), (0, 255), (1, 254)))))
    letters = F.when(longer > 0, F.array_join(F.transform(more, lambda n: F.chr(n % 26 + 97)), "")).otherwise("")
    email = F.concat(spelled(F.regexp_extract(norm, "^([^@]*)@", 1)), letters, F.lit("@"),
                     host if host is not None else F.regexp_extract(norm, "@(.*)$", 1))
    domain = F.concat(spelled(F.regexp_extract(norm, r"^(.*)\.[^.]+$", 1)), letters, F.regexp_extract(norm, r"(\.[^.]+)$", 1))
    tail = spelled(F.substr(norm, F.lit(5)))
    bare = F.concat(F.substr(norm, F.lit(1), F.lit(2)), F.lit("00"), tail)
    iban = F.concat(F.substr(norm, F.lit(1), F.lit(2)), F.lpad((98 - _mod97(bare)).cast("string"), 2, "0"), tail)
    out = (F.when(kind == "email", email).when(kind == "host", domain).when(kind == "phone", phone).when(kind == "card", card).when(kind == "ssn", ssn)
           .when(kind == "ip", ip).when(kind == "iban", iban))
    for script, syllables in SYLLABLES.items():
        for role in "mfxs":
            listed = F.array(*map(F.lit, syllables))
            tail = F.when(longer > 0, F.array_join(F.transform(more, lambda n: F.element_at(listed, n % F.size(listed) + 1)), "")).otherwise("")
            made = F.concat(pick(syllables, 0), pick(syllables, 1), pick(syllables, 2), tail, F.lit(ENDINGS[script, role]))
            names = GIVEN.get((script, role)) or (GIVEN[script, "m"] + GIVEN[script, "f"] if role == "x" else None)
            value = F.when(draw < LISTED_DRAWS, F.lower(pick(names, 4))).otherwise(made) if names else made
            out = out.when(kind == f"{role}_{script}", value)
    return out


def render(kind: Column, raw: Column, core: Column) -> Column:
    """The surrogate in the format of what it replaces: its punctuation, spaces and case."""
    def filled(allowed: str, core: Column = core) -> Column:
        empty = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))
        return F.aggregate(_chars(raw), empty, lambda s, c: F.when(c.rlike(allowed), F.struct(
            F.concat(s["out"], F.substr(core, s["at"], F.lit(1))).alias("out"), (s["at"] + 1).alias("at"))).otherwise(
            F.struct(F.concat(s["out"], c).alias("out"), s["at"].alias("at"))))["out"]
    dialled = F.concat(F.regexp_extract(_digits(raw), "^(1)[0-9]{10}$", 1), core)
    name = F.when((raw == F.upper(raw)) & (F.length(raw) > 1), F.upper(core)).when(raw == F.initcap(raw), F.initcap(core)).otherwise(core)
    return (F.when(core.isNull(), raw).when(kind == "phone", F.concat(filled("[0-9]", dialled), F.substr(dialled, F.length(_digits(raw)) + 1)))
            .when(kind.isin("card", "ssn"), filled("[0-9]")).when(kind == "iban", filled("[A-Z0-9]"))
            .when(kind.isin("email", "ip"), core).otherwise(name))


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """``kind, norm, core`` for distinct ``kind, norm``: drawn again until no two entities of a kind share a
    surrogate and no surrogate is a real entity. Of several that draw alike the first by ``norm`` keeps it. The domains of
    mail addresses are entities as well and drawn first, so that two domains stay two."""
    entities = materialize(entities.select("kind", "norm").distinct())
    domain = F.when(F.col("kind") == "email", F.regexp_extract("norm", "@(.*)$", 1))
    nothing = F.lit(None).cast("string").alias("host")
    hosts = entities.select(F.lit("host").alias("kind"), domain.alias("norm"), nothing).filter("norm IS NOT NULL").distinct()
    named = _settled(hosts, key).select(F.col("norm").alias("_domain"), F.col("core").alias("host"))
    return _settled(entities.withColumn("_domain", domain).join(named, "_domain", "left").drop("_domain"), key)


def _settled(entities: DataFrame, key: str) -> DataFrame:
    """``kind, norm, core`` of distinct ``kind, norm, host``."""
    entities = materialize(entities.select("kind", "norm", "host"))
    real = entities.select("kind", F.col("norm").alias("core"))
    settled, waiting = None, entities
    for draw in range(ROUNDS):
        drawn = materialize(waiting.withColumn("core", candidate(key, F.col("kind"), F.col("norm"), F.lit(draw), F.col("host"))))
        taken = real if settled is None else real.union(settled.select("kind", "core"))
        free = drawn.join(taken, ["kind", "core"], "left_anti")
        won = materialize(free.groupBy("kind", "core").agg(F.min("norm").alias("norm")).select("kind", "norm", "core"))
        settled = won if settled is None else settled.union(won)
        waiting = drawn.select("kind", "norm", "host").join(won.select("kind", "norm"), ["kind", "norm"], "left_anti")
        waiting = materialize(waiting)
        if waiting.limit(1).count() == 0:
            return settled
    raise ValueError(f"after {ROUNDS} draws some entities still have no surrogate of their own")


def replace(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_entities, kinds, text``.

    ``kinds`` lists the types found in the order of the text; a null text stays null and has none. Rows
    repeat as they come; equal texts get equal results. Whole texts are searched. An empty table gives no rows."""
    rows = id_and_text(docs, id_col, text_col)
    # Whether ANY occurs; all but names need a digit or an at sign, which is quick to tell.
    has = F.coalesce((F.col("text").rlike("[@0-9]") & F.col("text").rlike(NUMBERED)) | F.col("text").rlike(PATTERNS["person"]), F.lit(False))
    digest = F.sha2(F.col("text").cast("binary"), 256)
    found = (rows.filter(has).select(digest.alias("digest"), F.posexplode(F.regexp_extract_all("text", F.lit(f"({ANY})"), F.lit(1))).alias("pos", "match"))
             .groupBy("digest", "pos").agg(F.first("match").alias("match"))
             .select("digest", "pos", F.posexplode(_found(F.col("match"))).alias("part", "p"))
             .select("digest", "pos", "part", F.col("p.kind").alias("found"), F.col("p.match").alias("match")))
    parts = materialize(found.select("digest", "pos", "part", "found", F.posexplode(_tokens(F.col("match"), F.col("found"))).alias("at", "t"))
                        .select("digest", "pos", "part", "found", "at", "t.kind", "t.norm", "t.raw"))
    mapping = materialize(surrogates(parts.filter("kind IS NOT NULL"), key))
    written = materialize(parts.join(mapping, ["kind", "norm"], "left").select(
        "digest", "pos", "part", "found", "at", render(F.col("kind"), F.col("raw"), F.col("core")).alias("out")))
    matches = written.groupBy("digest", "pos").agg(F.array_sort(F.collect_list(F.struct("part", "at", "found", "out"))).alias("outs"))
    told = F.transform(F.filter("outs", lambda x: (x["at"] == 0) & x["found"].isNotNull()), lambda x: x["found"])
    texts = materialize(matches.select("digest", "pos", told.alias("found"), F.array_join(F.transform("outs", lambda x: x["out"]), "").alias("out"))
                        .groupBy("digest").agg(F.array_sort(F.collect_list(F.struct("pos", "found", "out"))).alias("list"))
                        .select("digest", F.transform("list", lambda x: x["out"]).alias("outs"),
                                F.flatten(F.transform("list", lambda x: x["found"])).alias("kinds")))
    pieces = F.split("text", ANY, -1)
    told = (rows.filter(has).withColumn("digest", digest).join(texts, "digest")
            .select("doc_id", F.size("kinds").cast("bigint").alias("n_entities"), F.array_join("kinds", ",").alias("kinds"),
                    F.array_join(F.transform(pieces, lambda p, i: F.concat(p, F.coalesce(F.get("outs", i), F.lit("")))), "").alias("text")))
    plain = rows.filter(~has).select("doc_id", F.lit(0).cast("bigint").alias("n_entities"), F.lit("").alias("kinds"), "text")
    return told.unionByName(plain)
