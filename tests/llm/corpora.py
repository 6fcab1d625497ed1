"""Small corpora with everything that may go wrong in a row."""

from __future__ import annotations

import random

#: Names that operators use inside, with other types.
CLASHING = {
    "kept": "'x'", "size": "true", "row": "1", "copies": "'c'", "text_key": "'t'", "digest": "2.5", "node": "'n'",
    "key": "array(1)", "hash": "'h'", "first": "'f'", "score": "'s'", "packed": "'p'", "row_id": "'r'", "spans": "7",
    "n_shingles": "'n'", "component": "'c'", "block": "'b'", "content": "3", "class": "'k'", "number": "'n'", "target": "'t'", "form": "'f'", "output": "8", "n": "'n'", "links": "'l'",
    "labels": "9", "words": "'w'", "pair": "'p'", "copies_of": "1", "total": "'t'", "place": "'p'",
}

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(seed: int, count: int, size: int = 400) -> str:
    pick = random.Random(seed)
    return " ".join(f"w{pick.randrange(size)}" for _ in range(count))


def edge_rows() -> list[tuple]:
    long = words(1, 9000)
    rows = [
        (1, words(2, 60), "en", "a", 1),
        (1, words(2, 60), "en", "a", 1),  # the same row again
        (1, words(3, 50), "en", "b", 1),  # the same id, another text
        (2, words(2, 60).replace(" ", "\t "), "en", None, 1),
        (3, "", None, "a", 0),
        (4, None, "en", "b", None),
        (5, "   \n\t ", "en", "b", 5),
        (6, "one", "en", "c", 3),
        (7, long, "en", "c", 1),
        (8, long + " end", "en", "c", 1),
        (None, words(2, 60), "de", "a", 1),
        (None, None, None, None, None),
        (9, "naïve café   \U0001f642 中文 \x1c x\x85y", "fr", "d", 20),
        (10, "x" * 3000, "en", "d", 3000),
        (11, "A b c D e F g. " * 40, "en", "d", 600),
        (12, "a B c d E f G. " * 40, "en", "e", 600),
    ]
    return rows


def edge_docs(spark, clashing: bool = True):
    docs = spark.createDataFrame(edge_rows(), SCHEMA).repartition(3)
    if not clashing:
        return docs
    return docs.selectExpr("*", *[f"{value} AS {name}" for name, value in CLASHING.items()])


def empty_docs(spark):
    return edge_docs(spark).limit(0)


def as_rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)
