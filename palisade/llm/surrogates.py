"""Surrogates for personal data: detected entities become other entities of their kind, by a secret key.

A replacement is a keyed permutation of the entity's own space, so it is the same wherever the entity appears, two entities of
one shape never meet, and no table of the corpus's people is needed: digits stay digits, letters stay vowels or consonants of their script, case and
punctuation stay where they were. Card numbers and IBANs keep their check-sum state, first names are exchanged within the names of
their gender and script: a list, and all first names that stand behind a title anywhere in the corpus, gathered as a table with
the gender that the titles tell. People are found behind a title and as a listed or gathered first name before another name. What a permutation can't rule out (an entity mapped on itself, IBANs that differ in their check digits
only) is checked over the corpus: all distinct entities are grouped by surrogate in Spark, and all but the smallest of a group
take their next permutation until every surrogate is unique.

Defined cases: null texts stay null, empty ones empty; texts without entities are unchanged; spellings of one entity (case of
an e-mail address, punctuation of a number) share one surrogate in their own format; repeated rows get the same result; extra
columns are kept, but those with the names of the two new ones are replaced; no documents give no rows.
"""

from __future__ import annotations

import hashlib
import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palisade.llm.common import small_side
from palisade.session import written

KEY = "change-me"
KEY_ROWS = 1_000_000
# Broadcast bound: gathered first names, and texts that hold some.
NAME_ROWS = 100_000
ROUNDS = 6

EMAIL = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}(?![A-Za-z0-9])")
IP = re.compile(r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\w|\.\d)")
IBAN = re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")
CARD = re.compile(r"(?<![\w+-])\d(?:[ -]?\d){12,18}(?![\w-])")
SSN = re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])")
PHONE = re.compile(
    r"(?<![\w.-])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}|\(\d{2,4}\) ?\d{3,4}[ -]?\d{3,4}|\d{3}-\d{3}-\d{4})(?!\w)")
# Country calling codes of one and two digits; all others have three.
CALLING_CODES = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86"
                          " 90 91 92 93 94 95 98".split())
NUMERIC = [("iban", IBAN), ("ssn", SSN), ("phone", PHONE), ("ip", IP), ("card", CARD)]



def _letters(*categories: str) -> str:
    """A regex class body of all characters of the categories."""
    runs: list[list[int]] = []
    for c in range(sys.maxunicode + 1):
        if unicodedata.category(chr(c)) in categories:
            if runs and runs[-1][1] == c - 1:
                runs[-1][1] = c
            else:
                runs.append([c, c])
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in runs)


# A name begins with a capital or a letter without case; letters, marks and inner capitals follow, also behind an apostrophe or
# a hyphen, but not a possessive s.
_BEGIN, _INNER = _letters("Lu", "Lt", "Lo"), _letters("Lu", "Ll", "Lt", "Lo", "Lm", "Mn", "Mc")
_NAME = rf"[{_BEGIN}](?:['’](?!s(?!\w))[{_INNER}]|-[{_BEGIN}]|[{_INNER}])+(?![\w{_letters('Mn', 'Mc')}])"
_TITLES = "Mr|Mrs|Ms|Miss|Mister|Herr|Frau|Señora|Señor|Sra|Sr|Monsieur|Madame|Mme|Dr|Prof|Господин|Госпожа"
_SMALL = "(?:(?:de|del|della|di|da|dos|du|la|le|von|van|der|den|ten|ter|zu|al|bin|ibn) )*"
TITLED = re.compile(rf"\b((?:(?:{_TITLES})\.? )+){_SMALL}(?!(?:{_TITLES})\b)({_NAME})(?: {_SMALL}({_NAME}))?")
# Pairs overlap, so a name behind another capital is one.
CAPITALS = re.compile(rf"(?<![\w'’-])({_NAME})(?= {_SMALL}({_NAME}))")
WORD = re.compile(rf"(?<!\w){_NAME}")

# First names by gender and script, and the gender a title tells.
FIRST_NAMES = {
    ("f", "latin"): "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Nancy Margaret Claudia Ursula Monika"
                    " Sabine Petra Carmen Dolores Lucia Isabel Pilar Sylvie Nathalie Isabelle Monique Brigitte Françoise".split(),
    ("m", "latin"): "James Robert Michael William David Richard Joseph Thomas Charles Daniel Matthew Anthony Wolfgang Klaus Jürgen"
                    " Dieter Stefan Carlos Javier Miguel Antonio Manuel Pierre Philippe Laurent Olivier Jacques François".split(),
    ("f", "cyrillic"): "Анна Мария Елена Ольга Наталья Татьяна Светлана Ирина Екатерина Людмила".split(),
    ("m", "cyrillic"): "Александр Сергей Дмитрий Андрей Алексей Иван Николай Михаил Владимир Павел".split(),
}
TITLE_GENDER = {"Mr": "m", "Mister": "m", "Herr": "m", "Señor": "m", "Sr": "m", "Monsieur": "m", "Господин": "m",
                "Mrs": "f", "Ms": "f", "Miss": "f", "Frau": "f", "Señora": "f", "Sra": "f", "Madame": "f", "Mme": "f", "Госпожа": "f"}
GENDER_OF = {name: (gender, script) for (gender, script), names in FIRST_NAMES.items() for name in names}
LISTED = re.compile(r"\b(?=[A-ZÀ-ÖØ-ÞА-Я])(?:" + "|".join(sorted(GENDER_OF)) + r") ")
A_TITLE = re.compile(rf"\b(?:{_TITLES})\b")

# Alphabets in which a character is exchanged; any other character stays.
ALPHABETS = ["0123456789", "aeiou", "bcdfghjklmnpqrstvwxyz", "àáâäèéêëìíîïòóôöùúûü", "аеиоуыэюя", "бвгджзклмнпрстфхцчшщ"]
ALPHABET_OF = {c: a for a in ALPHABETS for c in a}


def _other_alphabets() -> list[str]:
    """The letters beyond ``ALPHABETS`` by script, the Latin ones as vowels and consonants; case must be reversible."""
    groups: dict[str, list[str]] = {}
    for c in map(chr, range(0x80, 0x10000)):
        if c in ALPHABET_OF or unicodedata.category(c) not in ("Ll", "Lo") or c.upper().lower() != c or len(c.upper()) != 1:
            continue
        script = unicodedata.name(c, "").split(" ")[0].split("-")[0]
        if script == "LATIN":
            base = unicodedata.normalize("NFD", c)[0]
            script += (" vowel" if base in "aeiou" else " consonant") if c < "\u0180" else " other"
        groups.setdefault(script, []).append(c)
    return ["".join(g) for g in groups.values() if len(g) > 1]


ALPHABETS += _other_alphabets()
ALPHABET_OF = {c: a for a in ALPHABETS for c in a}


def _digest(key: str, *parts) -> int:
    return int.from_bytes(hashlib.blake2b(repr(parts).encode(), key=key.encode()[:64], digest_size=32).digest(), "big")


def permuted(symbols: list[int], sizes: list[int], key: str, tweak: str) -> list[int]:
    """A keyed permutation of the number with the given digits and digit sizes: two halves shift each other in turn."""
    if not symbols:
        return []
    half = (len(symbols) + 1) // 2
    left = right = 0
    a = b = 1
    for s, n in zip(symbols[:half], sizes[:half], strict=True):
        left, a = left * n + s, a * n
    for s, n in zip(symbols[half:], sizes[half:], strict=True):
        right, b = right * n + s, b * n
    for r in range(ROUNDS):
        left = (left + _digest(key, tweak, r, 0, right)) % a
        right = (right + _digest(key, tweak, r, 1, left)) % b
    out = []
    for n in reversed(sizes[half:]):
        right, s = divmod(right, n)
        out.append(s)
    for n in reversed(sizes[:half]):
        left, s = divmod(left, n)
        out.append(s)
    return out[::-1]


def reshaped(text: str, key: str, tweak: str, fixed: int = 0) -> str:
    """Every character behind the first ``fixed`` to another of its alphabet, as one permutation of texts of this shape."""
    low = text.lower()
    if len(low) != len(text):
        low = text
    places = [k for k in range(fixed, len(text)) if low[k] in ALPHABET_OF]
    alphabets = [ALPHABET_OF[low[k]] for k in places]
    shape = "".join(a[0] for a in alphabets)
    new = permuted([a.index(low[k]) for k, a in zip(places, alphabets, strict=True)], [len(a) for a in alphabets], key, f"{tweak}|{shape}")
    out = list(text)
    for k, a, s in zip(places, alphabets, new, strict=True):
        out[k] = a[s].upper() if text[k] != low[k] else a[s]
    return "".join(out)


def _luhn(digits: str) -> int:
    """The check digit behind ``digits``."""
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (2 if k % 2 == 0 else 1)
        total += n - 9 if n > 9 else n
    return -total % 10


def _country(phone: str) -> int:
    """The characters of a canonical number that say its country: the plus sign and the calling code."""
    if not phone.startswith("+"):
        return 0
    return next((1 + n for n in (1, 2) if phone[1 : 1 + n] in CALLING_CODES), 4)


@lru_cache(maxsize=64)
def _shuffled(key: str, gender: str, script: str, attempt: int) -> dict[str, str]:
    names = sorted(FIRST_NAMES[gender, script], key=lambda n: _digest(key, "name", attempt, n))
    return dict(zip(names, names[1:] + names[:1], strict=True))


def surrogate(kind: str, canon: str, key: str, attempt: int = 0) -> str:
    """The replacement of an entity in canonical form (see :func:`canonical`)."""
    # Later attempts are permutations of the entity's own, so a group that met in one surrogate parts at once.
    tweak = f"{kind}|{attempt}|{canon}" if attempt else kind
    if kind == "ip":
        o = [int(x) for x in canon.split(".")]
        return ".".join(map(str, permuted(o, [256] * 4, key, tweak)))
    if kind == "card":
        body = reshaped(canon[:-1], key, tweak, fixed=1)
        return body + str((_luhn(body) + int(canon[-1]) - _luhn(canon[:-1])) % 10)
    if kind == "iban":
        body = reshaped(canon[4:], key, tweak)
        check = 98 - int("".join(str(int(c, 36)) for c in f"{body}{canon[:2]}00")) % 97
        return f"{canon[:2]}{check:02d}{body}"
    if kind == "email":
        where = canon.rindex(".")
        return reshaped(canon[:where], key, tweak) + canon[where:]
    if kind == "phone":
        return reshaped(canon, key, tweak, fixed=_country(canon))
    if kind == "first":
        return _shuffled(key, *GENDER_OF[canon], attempt)[canon]
    return reshaped(canon, key, tweak)


def canonical(kind: str, text: str) -> str:
    """What spellings of one entity share."""
    if kind == "email":
        return text.lower()
    if kind in ("phone", "card", "ssn"):
        return "+" * (kind == "phone" and text.startswith("+")) + re.sub(r"\D", "", text)
    return text.replace(" ", "") if kind == "iban" else text


def formatted(kind: str, text: str, new: str) -> str:
    """The canonical surrogate in the format of ``text``."""
    if kind == "email":
        return "".join(n.upper() if t != t.lower() else n for t, n in zip(text, new, strict=True))
    if kind in ("phone", "card", "ssn", "iban"):
        left = iter(new.removeprefix("+"))
        return "".join(next(left) if t.isalnum() else t for t in text)
    return new


def titled(text: str) -> list[tuple[str, str | None, str | None]]:
    """(name, second name, gender) of the people behind a title."""
    if not A_TITLE.search(text):
        return []
    return [(m[2], m[3], next((g for t in A_TITLE.findall(m[1]) if (g := TITLE_GENDER.get(t))), None)) for m in TITLED.finditer(text)]


def script_of(name: str) -> str | None:
    """latin or cyrillic if all letters are; None for others."""
    scripts = {unicodedata.name(c, "").split(" ")[0].lower() for c in name if c.isalpha()}
    return scripts.pop() if len(scripts) == 1 and scripts <= {"latin", "cyrillic"} else None


def detected(text: str, known: dict[str, tuple[str, str | None]] | None = None) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the entities, in order, none inside another.

    ``known`` are first names gathered over the corpus: (gender, or x where no title tells it, surrogate).
    """
    found: list[tuple[int, int, str]] = []
    if "@" in text:
        found += [(m.start(), m.end(), "email") for m in EMAIL.finditer(text)]
    if re.search(r"\d[\d .()-]{5}", text):
        for kind, pattern in NUMERIC:
            found += [(m.start(), m.end(), kind) for m in pattern.finditer(text)]
    known = known or {}

    def gender(name: str) -> str | None:
        return known[name][0] if name in known else GENDER_OF.get(name, (None,))[0]

    people: dict[str, str] = {}
    for first, last, said in titled(text):
        if last:
            own = gender(first)
            people[first] = "first" if own in ("f", "m") and own == (said or own) else "name"
            people[last] = "name"
        else:
            people[first] = "name"
    if known or LISTED.search(text):
        for m in CAPITALS.finditer(text):
            own = gender(m[1])
            if own and not gender(m[2]) and m[1] != m[2]:
                people[m[1]], people[m[2]] = "name" if own == "x" else "first", "name"
    people = {name: kind for name, kind in people.items() if any(c in ALPHABET_OF for c in name.lower())}
    if people:
        found += [(m.start(), m.end(), people[m[0]]) for m in WORD.finditer(text) if m[0] in people]
    found.sort(key=lambda f: (f[0], -f[1]))
    kept: list[tuple[int, int, str]] = []
    for f in found:
        if not kept or f[0] >= kept[-1][1]:
            kept.append(f)
    return kept


def rewritten(text: str, key: str, attempts: dict[tuple[str, str], int],
              known: dict[str, tuple[str, str | None]] | None = None) -> tuple[str, list[tuple[int, int, str]]]:
    found = detected(text, known)
    out, at = [], 0
    for start, end, kind in found:
        own = text[start:end]
        canon = canonical(kind, own)
        gathered = known[own][1] if kind == "first" and known and own in known else None
        out += [text[at:start], gathered or formatted(kind, own, surrogate(kind, canon, key, attempts.get((kind, canon), 0)))]
        at = end
    return "".join([*out, text[at:]]), found


def _mark(text: str) -> str:
    return hashlib.blake2b(text.encode(), digest_size=16).hexdigest()


def first_names(docs: DataFrame, key: str) -> DataFrame:
    """(name, gender, new): the unlisted first names behind titles of the whole corpus, with the gender that most of them tell.

    With the listed names of their gender and script they are exchanged along one circle in the order of keyed hashes. Gender x
    has no surrogate of its own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(first, said if said and script_of(first) else "x", script_of(first) or "other")
                    for t in batch.column(0).to_pylist() if t for first, last, said in titled(t) if last and first not in GENDER_OF]
            columns = list(zip(*rows, strict=True)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], ["name", "gender", "script"])

    told = docs.select("text").mapInArrow(run, "name string, gender string, script string").groupBy("name", "script").agg(
        *[F.count_if(F.col("gender") == g).alias(g) for g in "fm"])
    gathered = written(told.select(
        "name", "script", F.when(F.col("f") + F.col("m") == 0, "x").when(F.col("f") >= F.col("m"), "f").otherwise("m").alias("gender")), "first_names")
    listed = docs.sparkSession.createDataFrame([(n, script, gender) for n, (gender, script) in GENDER_OF.items()], gathered.schema)
    circle = gathered.where("gender <> 'x'").unionByName(
        listed.join(F.broadcast(gathered.select("script", "gender").where("gender <> 'x'").distinct()), ["script", "gender"], "left_semi"))
    order = Window.partitionBy("script", "gender").orderBy(F.sha2(F.concat(F.lit(key + "|name|"), "name"), 256), "name")
    whole = Window.partitionBy("script", "gender").orderBy(F.sha2(F.concat(F.lit(key + "|name|"), "name"), 256), "name").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    turned = circle.select("name", "gender", F.coalesce(F.lead("name").over(order), F.first("name").over(whole)).alias("new"))
    return turned.unionByName(gathered.where("gender = 'x'").select("name", "gender", F.lit(None).cast("string").alias("new")))


def _known(docs: DataFrame, names: DataFrame) -> DataFrame:
    """(mark, known): the gathered first names that stand in a text before another name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = {(_mark(t), first) for t in batch.column(0).to_pylist() if t
                    for first in {m[1] for m in CAPITALS.finditer(t)} | {f for f, last, _ in titled(t) if last}}
            columns = list(zip(*sorted(rows), strict=True)) or [[], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], ["mark", "name"])

    seen = docs.select("text").mapInArrow(run, "mark string, name string")
    return seen.join(small_side(names, NAME_ROWS), "name").groupBy("mark").agg(
        F.collect_set(F.struct("name", "gender", "new")).alias("known"))


def _as_known(rows) -> dict[str, tuple[str, str | None]]:
    return {r["name"]: (r["gender"], r["new"]) for r in rows or []}


def _mapped(entities: DataFrame, key: str) -> DataFrame:
    """(kind, canon, attempt) with the surrogate of that attempt."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("kind", "canon", "attempt")), strict=True)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([surrogate(k, c, key, a) for k, c, a in rows], pa.string())], ["kind", "canon", "attempt", "new"])

    return entities.select("kind", "canon", "attempt").mapInArrow(run, "kind string, canon string, attempt int, new string")


def exceptions(entities: DataFrame, key: str) -> DataFrame:
    """The distinct ``entities`` (kind, canon) whose first surrogate isn't theirs alone, with the attempt to take instead."""
    settled = written(_mapped(entities.withColumn("attempt", F.lit(0)), key), "surrogates")
    while True:
        owner = settled.groupBy("kind", "new").agg(F.min(F.struct("attempt", "canon")).alias("first"), F.count(F.lit(1)).alias("n"))
        clash = written(settled.join(owner.where("n > 1"), ["kind", "new"]).where("struct(attempt, canon) > first")
                        .select("kind", "canon", "attempt").union(settled.where("new = canon").select("kind", "canon", "attempt")).distinct(), "clash")
        if clash.isEmpty():
            return settled.where("attempt > 0").select("kind", "canon", "attempt")
        again = _mapped(clash.withColumn("attempt", F.col("attempt") + 1), key)
        settled = written(settled.join(clash.select("kind", "canon"), ["kind", "canon"], "left_anti").unionByName(again), "surrogates")


def replaced(docs: DataFrame, key: str = KEY) -> DataFrame:
    """``docs`` with surrogates in ``text``, and the columns n_entities and entities (kind:start:end in the old text)."""
    docs = docs.drop("n_entities", "entities")
    place, width = docs.columns.index("text"), len(docs.columns)
    schema = docs.select("*", F.lit(0).cast("long").alias("n_entities"), F.lit("").alias("entities")).schema
    names = schema.names

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_mark(t) if t else None for t in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], [*batch.schema.names, "_mark"])

    def with_mark() -> DataFrame:
        return docs.mapInArrow(marked, docs.select("*", F.lit(None).cast("string").alias("_mark")).schema)

    gathered = written(first_names(docs, key), "name_circle")
    known = None if gathered.isEmpty() else written(_known(docs, gathered), "known")
    if known is None:
        texts = docs.select("text", F.lit(None).cast("array<struct<name:string,gender:string,new:string>>").alias("known"))
    else:
        texts = with_mark().join(small_side(known.withColumnRenamed("mark", "_mark"), NAME_ROWS), "_mark", "left").select("text", "known")

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = {(_mark(t), kind, canonical(kind, t[a:b])) for t, k in zip(*(c.to_pylist() for c in batch.columns), strict=True) if t
                    for a, b, kind in detected(t, _as_known(k))}
            columns = list(zip(*sorted(rows), strict=True)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], ["mark", "kind", "canon"])

    entities = written(texts.mapInArrow(listed, "mark string, kind string, canon string"), "entities")
    # First names are exchanged along a circle, where none meets another.
    odd = written(exceptions(entities.where("kind <> 'first'").select("kind", "canon").distinct(), key), "exceptions")
    # Texts that hold an exception carry its attempts; usually there is none.
    by_text = entities.join(odd, ["kind", "canon"]).groupBy("mark").agg(F.collect_set(F.struct("kind", "canon", "attempt")).alias("attempts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts, said = [], [], []
            given = [c.to_pylist() for c in batch.columns[width:]] or [[None] * batch.num_rows] * 2
            for text, attempts, own in zip(batch.column(place).to_pylist(), *given, strict=True):
                new, found = rewritten(text, key, {(a["kind"], a["canon"]): a["attempt"] for a in attempts or []}, _as_known(own)) if text else (text, [])
                texts.append(new)
                counts.append(len(found))
                said.append(",".join(f"{kind}:{a}:{b}" for a, b, kind in found))
            columns = list(batch.columns[:width])
            columns[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64()), pa.array(said, pa.string())], names)

    rare = not odd.isEmpty()
    if not rare and known is None:
        return docs.mapInArrow(run, schema)
    none = "CAST(NULL AS array<struct<{}>>)"
    carried = with_mark()
    if rare:
        marks = written(by_text, "attempts")
        carried = carried.join(small_side(marks.withColumnRenamed("mark", "_mark"), KEY_ROWS), "_mark", "left").withColumnRenamed("attempts", "_attempts")
    else:
        carried = carried.withColumn("_attempts", F.expr(none.format("kind:string,canon:string,attempt:int")))
    if known is not None:
        carried = carried.join(small_side(known.withColumnRenamed("mark", "_mark").withColumnRenamed("known", "_known"), NAME_ROWS), "_mark", "left")
    else:
        carried = carried.withColumn("_known", F.expr(none.format("name:string,gender:string,new:string")))
    return carried.select(*docs.columns, "_attempts", "_known").mapInArrow(run, schema)
