"""Surrogates: type, format, script, gender, distinctness, coreference."""

import re

import pytest
from corpora import edge_docs, edge_rows, empty_docs
from pyspark.sql import functions as F

from depotlake.llm import pii
from depotlake.llm.tables import Scratch

KEY = b"test"
TEXT = (
    "Mr. John Smith wrote to Mrs. Anna Smith (a.smith@Mail.Example.com, A.SMITH@mail.example.com). Smith paid with"
    " 4111 1111 1111 1111 and 4111111111111111, called +1 (017) 555-7713 or 017-555-7713 from 97.51.17.173; ssn"
    " 123-45-6789. IBAN DE89 3704 0044 0532 0130 00. Госпожа Иванова и господин Пётр Иванов. 王小明先生 says 王小明."
    " Frau MÜLLER. 9807915762804490 2353820953013749 und.34@mail7.example.com*** version 3.0, 12 of 345."
)


def replaced(spark, *texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.text for r in pii.replace_private(docs, KEY).orderBy("doc_id").collect()]


def luhn(number):
    digits = [int(c) for c in number if c.isdigit()]
    return sum(d if n % 2 == 0 else sum(divmod(2 * d, 10)) for n, d in enumerate(reversed(digits))) % 10 == 0


def test_kinds_and_places():
    found = [(kind, TEXT[a:b]) for a, b, kind, _ in pii.find(TEXT)]
    assert found == [
        ("given-m", "John"), ("family", "Smith"), ("given-f", "Anna"), ("family", "Smith"),
        ("email", "a.smith@Mail.Example.com"), ("email", "A.SMITH@mail.example.com"), ("family", "Smith"),
        ("card", "4111 1111 1111 1111"), ("card", "4111111111111111"), ("phone", "+1 (017) 555-7713"),
        ("phone", "017-555-7713"), ("ip", "97.51.17.173"), ("ssn", "123-45-6789"), ("iban", "DE89 3704 0044 0532 0130 00"),
        ("family", "Иванова"), ("given-m", "Пётр"), ("family", "Иванов"), ("han-m", "王小明"), ("han-m", "王小明"),
        ("family", "MÜLLER"), ("card", "9807915762804490"), ("card", "2353820953013749"), ("email", "und.34@mail7.example.com"),
    ]


def test_nothing_private_is_left_and_formats_stay(spark):
    (out,) = replaced(spark, TEXT)
    private = {TEXT[a:b] for a, b, *_ in pii.find(TEXT)}
    assert not any(p in out for p in private)
    spaced = re.search(r"with (\d{4} \d{4} \d{4} \d{4}) and", out).group(1)
    cards = re.findall(r"(?<!\d)\d{16}(?!\d)", out)
    assert spaced.replace(" ", "") == cards[0] and luhn(cards[0])  # one entity in two formats
    assert [luhn(c) for c in cards[1:]] == [luhn("9807915762804490"), luhn("2353820953013749")]
    assert re.search(r"\+1 \(\d{3}\) \d{3}-\d{4} or \d{3}-\d{3}-\d{4} from \d+\.\d+\.\d+\.\d+; ssn \d{3}-\d{2}-\d{4}\.", out)
    iban = re.search(r"DE\d{2} \d{4} \d{4} \d{4} \d{4} \d{2}", out).group().replace(" ", "")
    assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1
    mails = re.findall(r"[\w.]+@[\w.]+\.com", out)
    assert mails[0].lower() == mails[1].lower() and mails[1].split("@")[0].isupper()
    names = re.match(r"Mr\. (\w+) (\w+) wrote to Mrs\. (\w+) (\w+) \(.*\)\. (\w+) paid", out).groups()
    assert names[1] == names[3] == names[4] and names[0][-1] not in "aeiou" and names[2][-1] in "ae"
    people = re.search(r"Госпожа (\w+) и господин (\w+) (\w+)\.", out).groups()
    assert all(re.fullmatch("[А-Я][а-я]+", p) for p in people) and people[0].endswith("а")
    assert re.search(r"Frau [A-Z]+\.", out) and "version 3.0, 12 of 345." in out


@pytest.mark.parametrize("text", ["0000", "a1", "Zz-9é", "user.name77@mail", "абв1", "no digits"])
def test_permutation_keeps_the_shape(text):
    changed = pii.permuted(text, KEY, "t")
    assert [pii._PLACE.get(c, (c,))[0] for c in changed] == [pii._PLACE.get(c, (c,))[0] for c in text]


def test_permutation_is_one_to_one():
    assert len({pii.permuted(f"{n:04d}", KEY, "t") for n in range(10_000)}) == 10_000
    assert len({pii.surrogate("card", f"{n:013d}", KEY) for n in range(3000)}) == 3000
    assert len({pii.surrogate("ip", f"10.{a}.0.{b}", KEY) for a in range(60) for b in range(60)}) == 3600
    assert pii.permuted("1234", KEY, "t") != pii.permuted("1234", b"other", "t")


def test_names_of_a_corpus_stay_distinct(spark):
    """Far more names than short ones can be built, so many are drawn again."""
    entities = spark.range(40_000).select(F.lit("given-f").alias("kind"), F.concat(F.lit("n"), F.col("id").cast("string")).alias("entity"))
    first = {pii.surrogate("given-f", f"n{n}", KEY) for n in range(40_000)}
    assert len(first) < 40_000
    chosen = pii.distinct_surrogates(entities, KEY, Scratch(spark, "test"))
    assert chosen.count() == chosen.select("surrogate").distinct().count() == 40_000


def test_surrogates_are_no_entities(spark):
    """An entity that is the surrogate of another: that one is drawn again."""
    taken = pii.surrogate("ssn", "123456789", KEY)
    entities = spark.createDataFrame([("ssn", "123456789"), ("ssn", taken)], "kind string, entity string")
    chosen = {r.entity: r.surrogate for r in pii.distinct_surrogates(entities, KEY, Scratch(spark, "test")).collect()}
    assert len(chosen) == 2 and not set(chosen) & set(chosen.values())


def test_same_surrogate_in_all_documents(spark):
    one, two = replaced(spark, "mail to x.y@z.org now", "and x.y@z.org again")
    assert re.search(r"\S+@\S+\.org", one).group() == re.search(r"\S+@\S+\.org", two).group()


def test_no_backtracking_on_long_runs():
    assert pii.find("a" * 200_000 + "@" + "1" * 100_000) == []


def test_edge_rows(spark):
    found = pii.replace_private(edge_docs(spark), KEY).collect()
    assert len(found) == len(edge_rows())
    assert sum(r.text is None for r in found) == 2
    assert all(r.n_mentions == len([s for s in r.spans.split(",") if s]) for r in found)
    plain = {text for _, text, *_ in edge_rows()}
    assert {r.text for r in found} == plain  # nothing private in them
    assert pii.replace_private(empty_docs(spark), KEY).count() == 0


def test_repeated_rows_with_entities(spark):
    docs = spark.createDataFrame([(1, "call 017-555-7713"), (1, "call 017-555-7713"), (None, "call 017-555-7713")], "doc_id long, text string")
    found = pii.replace_private(docs, KEY).collect()
    assert len(found) == 3 and len({r.text for r in found}) == 1 and all(r.n_mentions == 1 for r in found)


@pytest.mark.parametrize("text, wanted", [
    ("Dr. Martin Luther King spoke. King left.", ["given-n:Martin", "given-n:Luther", "family:King", "family:King"]),
    ("Mr. J. Smith, then Smith", ["initial:J", "family:Smith", "family:Smith"]),
    ("Prof. J.R.R. Tolkien and Dr J Doe", ["initial:J", "initial:R", "initial:R", "family:Tolkien", "initial:J", "family:Doe"]),
    ("Frau von Stein kam; Frau Anna von der Leyen", ["family:Stein", "given-f:Anna", "family:Leyen"]),
    ("Herr Dr. Hans Müller ging", ["given-m:Hans", "family:Müller"]),
    ("Mr. O'Brien, Monsieur d'Artagnan", ["family:O'Brien", "family:Artagnan"]),
    ("Mr. John Smith Jr. met Mrs. Smith", ["given-m:John", "family:Smith", "family:Smith"]),
    ("Господин Иван Петрович Сидоров", ["given-m:Иван", "given-m:Петрович", "family:Сидоров"]),
])
def test_names_of_any_number_of_parts(text, wanted):
    assert [f"{kind}:{text[a:b]}" for a, b, kind, _ in pii.find(text)] == wanted


PHONES = [
    "01 23 45 67 89", "01.23.45.67.89", "0123456789", "+33 1 23 45 67 89", "+33 (0)1 23 45 67 89", "0033 1 23 45 67 89",
    "030/1234567", "030 / 123 45 67", "(030) 1234567", "0171-12345678", "+49 (0)30 1234567", "+49 30/1234567",
    "5551234567", "15551234567", "612 34 56 78", "91 234 56 78", "+34 612 34 56 78", "+34 912 345 678",
]


@pytest.mark.parametrize("number", PHONES)
def test_national_phone_formats(number):
    text = f"tel: {number}, thanks"
    assert [(kind, text[a:b]) for a, b, kind, _ in pii.find(text)] == [("phone", number)]


@pytest.mark.parametrize("text", ["on 01/02/2024", "012/2024", "2024-01-02 10:20", "1700000000 s", "10 20 30 40 50", "0.12345678", "part 123456789"])
def test_other_numbers_are_no_phones(text):
    assert pii.find(text) == []


def test_new_forms_are_replaced_in_their_format(spark):
    (out,) = replaced(spark, "Dr. Martin Luther King and Mr. J. Smith at 01 23 45 67 89 or 030/1234567. King spoke to Smith.")
    found = re.fullmatch(r"Dr\. (\w+) (\w+) (\w+) and Mr\. ([A-Z])\. (\w+) at 0\d \d\d \d\d \d\d \d\d or 0\d\d/\d{7}\. (\w+) spoke to (\w+)\.", out).groups()
    assert not {"Martin", "Luther", "King", "J", "Smith"} & set(found) and found[2] == found[5] and found[4] == found[6]


def test_long_runs_of_titles_and_digits():
    assert pii.find("Mr. " * 50_000 + "de " * 50_000 + "00" + "1 " * 50_000) == []
