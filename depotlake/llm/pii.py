"""Personal data: found and replaced by surrogates of the same type, script, gender and format.

A surrogate is a keyed function of the entity, so an entity has the same surrogate wherever it is
mentioned, in any spelling of its format. Numbers and addresses are permuted by a small Feistel
network over their digits and letters, each within its kind; card numbers keep how their check
digit relates to the rest. Names are built of syllables of their script, with endings by gender.
All surrogates of the corpus are compared: where two entities would share one, or a surrogate is
itself an entity of the corpus, it is drawn again until all are distinct.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotlake.llm.tables import Scratch, row_key

# Words before a name, by gender.
MALE = ("Mr", "Mister", "Sir", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "Signor", "Господин", "господин", "Κύριος")
FEMALE = ("Mrs", "Ms", "Miss", "Madam", "Lady", "Frau", "Fräulein", "Madame", "Mme", "Mademoiselle", "Mlle", "Señora", "Sra", "Señorita", "Srta", "Signora", "Госпожа", "госпожа", "Κυρία")
EITHER = ("Dr", "Prof", "Professor", "Доктор", "доктор")
MALE_AFTER, FEMALE_AFTER = "先生", "女士"

_GENDER = {**dict.fromkeys(MALE, "m"), **dict.fromkeys(FEMALE, "f"), **dict.fromkeys(EITHER, "n")}
#: Between the parts of a name, left as they are.
PARTICLES = ("von", "vom", "van", "zu", "zum", "zur", "de", "der", "den", "des", "del", "della", "di", "da", "do", "dos", "das", "du", "la", "le", "las", "los", "ten", "ter", "te", "af", "av", "bin", "ibn", "al", "el", "y", "e", "фон", "де")
#: After a name.
SUFFIXES = ("Jr", "II", "III", "IV")

_TITLE = "|".join(sorted(_GENDER, key=len, reverse=True))
_NAME = r"(?:\p{Lu}['’])?\p{Lu}[\p{L}\p{M}]+(?:[-'’]\p{Lu}[\p{L}\p{M}]+)*"
_PART = rf"(?!(?:{_TITLE}|{'|'.join(SUFFIXES)})(?![\p{{L}}\p{{M}}]))(?:[dl]['’])?"
#: Titles, then given names, initials and particles in any number; the last name is the family's.
_PERSON = regex.compile(
    rf"(?<!\w)({_TITLE})\.?[  ](?:(?:{_TITLE})\.?[  ]){{0,3}}"
    rf"(?:(?P<initial>\p{{Lu}})(?:\.(?:-|[  ])?|[  ])|(?:{'|'.join(PARTICLES)})[  ]|{_PART}(?P<given>{_NAME})[  ])*"
    rf"{_PART}(?P<family>{_NAME})"
)
_HAN = regex.compile(rf"(\p{{Han}}{{2,3}})({MALE_AFTER}|{FEMALE_AFTER})")
_DOMAIN = regex.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.\p{L}{2,}")
_LOCAL = regex.compile(r"[\w.%+-]")
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
#: Kinds and patterns, the more certain first.
_PATTERNS = [
    ("iban", regex.compile(r"(?<!\w)[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")),
    ("card", regex.compile(r"(?<!\w)(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){2,3}(?:[ -][0-9]{1,4})?)(?!\w)")),
    ("ssn", regex.compile(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])")),
    ("ip", regex.compile(rf"(?<![\w.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\w|\.\d)")),
    ("phone", regex.compile(r"(?<![\w+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-]?[0-9]{3,4}(?!\w)")),
    ("phone", regex.compile(r"(?<![\w+])\+[0-9]{8,15}(?!\w)")),
    # France in pairs, Spain, and other countries (8 to 15 digits), after + or 00
    ("phone", regex.compile(r"(?<![\w+])(?:(?:\+|00)33[ .-]?(?:\(0\)[ .-]?)?[1-9]|0[1-9])(?:[ .-]?[0-9]{2}){4}(?!\w)")),
    ("phone", regex.compile(r"(?<![\w+])(?:\+|00)34(?:[ .-]?[0-9]){9}(?!\w)")),
    ("phone", regex.compile(r"(?<![\w+])(?:\+|00)(?!1|33|34)[1-9](?:[ ./()-]{0,2}[0-9]){7,14}(?!\w)")),
    # Spain in pairs; an area code with 0, of 8 to 13 digits with the number; ten digits or more without signs
    ("phone", regex.compile(r"(?<![\w+])(?:[6-9][0-9]{2}[ .-][0-9]{2}|[89][0-9][ .-][0-9]{3})(?:[ .-][0-9]{2}){2}(?!\w)")),
    ("phone", regex.compile(r"(?<![\w+])(?=(?:[ /()-]*[0-9]){8,13}(?!\w|[/-]?[0-9]))\(?0[1-9][0-9]{1,4}\)?(?: ?[/-] ?| )[0-9]{3,9}(?:-[0-9]{1,5}|(?: [0-9]{2,4}){1,3})?(?!\w)")),
    ("phone", regex.compile(r"(?<![\w+])(?:1?[2-9][0-9]{9}|0[1-9][0-9]{7,10})(?!\w)")),
]
#: Java pattern of all texts in which something can be found.
_ASCII = "|".join(t for t in (*MALE, *FEMALE, *EITHER) if t[0].isascii())
_OTHER = "|".join(t for t in (*MALE, *FEMALE, *EITHER, MALE_AFTER, FEMALE_AFTER) if not t[0].isascii())
POSSIBLE = f"[@0-9]|(?<![A-Za-z])(?:{_ASCII})|{_OTHER}"

LATIN_1 = "àáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿß"
ALPHABETS = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", LATIN_1, "".join(map(chr, range(0x430, 0x450))), "".join(map(chr, range(0x3B1, 0x3CA))))
_PLACE = {c: (number, place) for number, letters in enumerate(ALPHABETS) for place, c in enumerate(letters)}
ROUNDS = 8
#: Draws of a surrogate before giving up; names grow longer with each.
MOST_DRAWS = 40

DIGITS = ("card", "ssn", "phone", "iban")


def _small(text: str) -> str:
    """Lower case that keeps the length."""
    return "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def find(text: str) -> list[tuple[int, int, str, str]]:
    """Mentions (start, end, kind, entity) in order, not overlapping."""
    found = []
    for match in _DOMAIN.finditer(text):
        start = match.start()
        while start and match.start() - start < 64 and _LOCAL.match(text[start - 1]):
            start -= 1
        while start < match.start() and text[start] in ".%+-":
            start += 1
        if start < match.start():
            found.append((start, match.end(), "email", _small(text[start : match.end()])))
    for kind, pattern in _PATTERNS:
        for match in pattern.finditer(text):
            entity = match.group()
            if kind in DIGITS:
                country = regex.match(r"\+([0-9]{1,3})[ .-]", entity)  # stays
                entity = "".join(c for c in entity[country.end() if country else 0 :] if c.isalnum())
                if kind == "phone" and entity.startswith("0"):  # stays too
                    entity = f"0|{entity[1:]}"
                entity = f"{country.group(1)}|{entity}" if country else entity
            found.append((match.start(), match.end(), kind, entity))
    names: dict[str, str] = {}
    for match in _PERSON.finditer(text):
        gender = _GENDER[match.group(1)]
        for group, kind in (("given", f"given-{gender}"), ("family", "family")):
            for start, end in match.spans(group):
                found.append((start, end, kind, _small(text[start:end])))
                names.setdefault(text[start:end], kind)
        found += [(start, end, "initial", _small(text[start:end])) for start, end in match.spans("initial")]
    for match in _HAN.finditer(text):
        kind = "han-m" if match.group(2) == MALE_AFTER else "han-f"
        found.append((match.start(1), match.end(1), kind, match.group(1)))
        names.setdefault(match.group(1), kind)
    if names:  # later mentions without a title
        listed = "|".join(map(regex.escape, sorted(names, key=len, reverse=True)))
        for match in regex.finditer(rf"(?<![\p{{L}}\p{{M}}])(?:{listed})(?![\p{{L}}\p{{M}}])", text):
            found.append((match.start(), match.end(), names[match.group()], _small(match.group())))
    kept, end = [], 0
    for mention in sorted(set(found), key=lambda m: (m[0], -m[1], m[2] != "email", m[2])):
        if mention[0] >= end:
            kept.append(mention)
            end = mention[1]
    return kept


def _numbers(key: bytes, *parts: str) -> Iterator[int]:
    """Endless pseudo-random numbers, keyed."""
    count = 0
    while True:
        block = hashlib.blake2b("\x1f".join((*parts, str(count))).encode(), key=key, digest_size=64).digest()
        for start in range(0, 64, 4):
            yield int.from_bytes(block[start : start + 4], "little")
        count += 1


def permuted(text: str, key: bytes, tweak: str) -> str:
    """Each letter and digit replaced within its alphabet: a permutation of the strings of one shape."""
    at = [n for n, c in enumerate(text) if c in _PLACE]
    letters = [ALPHABETS[_PLACE[text[n]][0]] for n in at]
    values = [_PLACE[text[n]][1] for n in at]
    shape = "".join(f"{c}" if c not in _PLACE else f"\x00{_PLACE[c][0]}" for c in text)
    half = len(values) // 2
    for number in range(ROUNDS):
        moved, other = (range(half), values[half:]) if number % 2 else (range(half, len(values)), values[:half])
        stream = _numbers(key, tweak, shape, str(number), ",".join(map(str, other)))
        for n in moved:
            values[n] = (values[n] + next(stream)) % len(letters[n])
    out = list(text)
    for n, alphabet, value in zip(at, letters, values):
        out[n] = alphabet[value]
    return "".join(out)


def _check_digit(digits: str) -> int:
    """The last digit that makes digits a number by the Luhn rule."""
    total = 0
    for n, d in enumerate(reversed(digits)):
        value = int(d) * (2 if n % 2 == 0 else 1)
        total += value - 9 * (value > 9)
    return -total % 10


def _iban_check(country: str, account: str) -> str:
    """The two check digits of an account number, by the remainder modulo 97."""
    number = int("".join(str(int(c, 36)) for c in f"{account}{country}00"))
    return f"{98 - number % 97:02d}"


SYLLABLES = {
    "latin": ("bdfghjklmnprstvwz", "aeiou", {"m": ("n", "s", "rd", "ck"), "f": ("a", "ia", "elle"), "n": ("y", "e"), "": ("son", "er", "ini", "ard", "ez", "man")}),
    "cyrillic": ("бвгдзклмнпрст", "аеио", {"m": ("н", "р", "й"), "f": ("на", "ия"), "n": ("а", "й"), "": ("ов", "ин", "ев", "енко")}),
    "greek": ("βγδκλμνπρστ", "αεηιο", {"m": ("ος", "ης"), "f": ("α", "η"), "n": ("ις",), "": ("ιδης", "ακης", "οπουλος")}),
}


def _script(name: str) -> str:
    first = name[:1]
    return "cyrillic" if "Ѐ" <= first < "԰" else "greek" if "Ͱ" <= first < "Ѐ" else "latin"


def surrogate(kind: str, entity: str, key: bytes, draw: int = 0) -> str:
    """The surrogate of an entity, in the entity's plain form."""
    tweak = f"{kind}/{draw}"
    if kind == "card":
        changed = permuted(entity[:-1], key, tweak)
        return changed + str((_check_digit(changed) + int(entity[-1]) - _check_digit(entity[:-1])) % 10)
    if kind == "ip":
        value = 0
        for octet in entity.split("."):
            value = value << 8 | int(octet)
        left, right = value >> 16, value & 0xFFFF
        for number in range(ROUNDS):
            left, right = right, (left + next(_numbers(key, tweak, str(number), str(right)))) & 0xFFFF
        return f"{left >> 8}.{left & 255}.{right >> 8}.{right & 255}"
    if kind == "iban":
        if _iban_check(entity[:2], entity[4:]) != entity[2:4]:
            return entity[:2] + permuted(entity[2:], key, tweak + entity[:2])
        changed = permuted(entity[4:], key, tweak + entity[:2])
        return entity[:2] + _iban_check(entity[:2], changed) + changed
    if kind == "phone":
        country, line, number = entity.rpartition("|")
        return country + line + permuted(number, key, tweak + country)
    if kind == "email":
        head, dot, top = entity.rpartition(".")
        return permuted(head, key, tweak) + dot + top
    if kind in DIGITS:
        return permuted(entity, key, tweak)
    if kind == "initial":  # another letter of the alphabet
        number, place = _PLACE.get(entity, (1, 0))
        letters = ALPHABETS[number]
        return letters[(place + 1 + next(_numbers(key, kind)) % (len(letters) - 1)) % len(letters)]
    stream = _numbers(key, tweak, entity)
    if kind.startswith("han"):
        return "".join(chr(0x4E00 + next(stream) % 0x4000) for _ in entity)
    consonants, vowels, endings = SYLLABLES[_script(entity)]
    gender = kind[-1] if kind.startswith("given") else ""
    built = "".join(consonants[next(stream) % len(consonants)] + vowels[next(stream) % len(vowels)] for _ in range(2 + draw // 2))
    built += endings[gender][next(stream) % len(endings[gender])]
    return built + "а" if not gender and _script(entity) == "cyrillic" and entity.endswith("а") else built


def rendered(kind: str, mention: str, plain: str) -> str:
    """The surrogate in the format of a mention: its separators and its capitals."""
    if kind in DIGITS:
        signs = (c for c in plain if c != "|")
        return "".join(next(signs) if c.isalnum() else c for c in mention)
    if kind == "email":
        return "".join(p.upper() if m.isupper() and len(p.upper()) == 1 else p for m, p in zip(mention, plain))
    if kind.startswith(("given", "family", "initial")):
        return plain.upper() if mention.isupper() else plain[:1].upper() + plain[1:]
    return plain


def _mapped(df: DataFrame, make: Callable[[dict], Sequence[tuple]], fields: pa.Schema, schema: str, size: int = 256) -> DataFrame:
    """The rows that make gives for each row."""

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in given:
            for start in range(0, whole.num_rows, size):
                rows = [made for row in whole.slice(start, size).to_pylist() for made in make(row)]
                columns = list(zip(*rows)) if rows else [[] for _ in fields]
                yield pa.RecordBatch.from_arrays([pa.array(values, f.type) for values, f in zip(columns, fields)], fields.names)

    return df.mapInArrow(run, schema)


def mentions(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, start, end, kind, entity of each mention, from docs with doc_id, text_key, text."""
    kind = docs.schema["doc_id"].dataType
    fields = pa.schema([
        ("doc_id", pa.int64() if kind.simpleString() == "bigint" else pa.string() if kind.simpleString() == "string" else pa.int32()),
        ("text_key", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("entity", pa.string()),
    ])

    def make(row: dict) -> list[tuple]:
        return [(row["doc_id"], row["text_key"], *found) for found in find(row["text"])]

    return _mapped(docs, make, fields, f"doc_id {kind.simpleString()}, text_key long, start int, end int, kind string, entity string")


_CHOSEN = pa.schema([("kind", pa.string()), ("entity", pa.string()), ("surrogate", pa.string())])


def _drawn(entities: DataFrame, key: bytes, draw: int) -> DataFrame:
    def make(row: dict) -> list[tuple]:
        return [(row["kind"], row["entity"], surrogate(row["kind"], row["entity"], key, draw))]

    return _mapped(entities.select("kind", "entity"), make, _CHOSEN, "kind string, entity string, surrogate string")


def distinct_surrogates(entities: DataFrame, key: bytes, scratch: Scratch) -> DataFrame:
    """kind, entity, surrogate: within a kind no two entities share one, and none is an entity.

    Initials are too few for that: theirs are other letters only.
    """
    initials = _drawn(entities.where("kind = 'initial'"), key, 0)
    entities = entities.where("kind <> 'initial'")
    chosen = scratch.put(_drawn(entities, key, 0), "draw-0")
    for draw in range(1, MOST_DRAWS):
        shared = chosen.groupBy("kind", "surrogate").agg(F.min("entity").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
        again = chosen.join(shared, ["kind", "surrogate"]).where("entity <> first").select("kind", "entity")
        known = entities.select("kind", F.col("entity").alias("surrogate"))
        taken = chosen.join(known, ["kind", "surrogate"], "left_semi").select("kind", "entity")
        redrawn = scratch.put(again.unionByName(taken).distinct(), f"again-{draw}")
        if redrawn.isEmpty():
            return chosen.unionByName(initials)
        rest = chosen.join(redrawn, ["kind", "entity"], "left_anti")
        chosen = scratch.put(rest.unionByName(_drawn(redrawn, key, draw)), f"draw-{draw}")
    raise RuntimeError(f"surrogates still clash after {MOST_DRAWS} draws")


def replace_private(docs: DataFrame, key: bytes) -> DataFrame:
    """For each row: doc_id, n_mentions, n_entities, spans (kind:start:end in the input), text with surrogates.

    key is a secret of 1 to 64 bytes; with another key all surrogates change. Null texts stay null,
    with no mentions. Rows of equal doc_id are rows of their own. Other columns are not read. Only
    texts that have a sign of an entity (a digit, an @, a title) are looked at and shuffled.
    """
    scratch = Scratch(docs.sparkSession, "pii")
    named = docs.select(*row_key(docs), "text")
    possible = F.coalesce(F.col("text").rlike(POSSIBLE), F.lit(False))
    some = named.where(possible)
    found = scratch.put(mentions(some), "mentions")
    entities = scratch.put(found.select("kind", "entity").distinct(), "entities")
    chosen = distinct_surrogates(entities, key, scratch)
    told = found.join(chosen, ["kind", "entity"]).groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("start", "end", "kind", "surrogate")).alias("changes"))
    told = told.withColumnsRenamed({"doc_id": "its_id", "text_key": "its_key"})
    same = some["doc_id"].eqNullSafe(told["its_id"]) & (some["text_key"] == told["its_key"])
    joined = some.join(told, same, "left").select("doc_id", "text", "changes")
    kind = joined.schema["doc_id"].dataType.simpleString()

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in given:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                rows = [_applied(*row) for row in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
                types = [pa.int64(), pa.int64(), pa.string(), pa.string()]
                columns = [pa.array(values, of) for values, of in zip(zip(*rows), types)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "n_mentions", "n_entities", "spans", "text"])

    changed = joined.mapInArrow(run, f"doc_id {kind}, n_mentions long, n_entities long, spans string, text string")
    zero = F.lit(0).cast("long")
    rest = named.where(~possible).select("doc_id", zero.alias("n_mentions"), zero.alias("n_entities"), F.lit("").alias("spans"), "text")
    return changed.unionByName(rest)


def _applied(text: str, changes: list[dict] | None) -> tuple[int, int, str, str]:
    ordered = sorted(changes or [], key=lambda c: c["start"])
    parts, place = [], 0
    for change in ordered:
        parts += [text[place : change["start"]], rendered(change["kind"], text[change["start"] : change["end"]], change["surrogate"])]
        place = change["end"]
    spans = ",".join(f"{c['kind']}:{c['start']}:{c['end']}" for c in ordered)
    return len(ordered), len({(c["kind"], c["surrogate"]) for c in ordered}), spans, "".join([*parts, text[place:]])
