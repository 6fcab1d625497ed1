"""Licence scans: a positional index of licence texts, looked up by each file's rarest licence words.

The index holds where each word stands in each licence text. Of the words that a file shares with a
licence text, the rarest ones (by the number of all documents that have them) say where the licence
text would begin in the file: place in the file less place in the text. Beginnings on which several
of them agree are candidates, and a candidate counts if the key phrases of its licence stand there.
A text whose key words the file lacks is not looked up, as it could not pass.
"""

from __future__ import annotations

import operator
import re
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Digits, letters a to z and all characters beyond ASCII, of a text in lower case.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Rarest words of a file and a licence text that are looked up.
RARE = 16
#: Looked-up words that must agree on a beginning.
VOTES = 3
#: Words by which a key phrase may stand before or after the licence text's place.
SLACK = 8
#: Rows handled at once.
ROWS = 256


def words_of(text: str) -> list[bytes]:
    return WORD.findall(text.encode().lower())


@dataclass(frozen=True)
class Template:
    """A licence text (or a part of one) under a label, with phrases that must stand in the file."""

    label: str
    text: str
    keys: tuple[str, ...]
    #: A base phrase counts only where all its words stand one after another.
    base: bool = False

    @cached_property
    def words(self) -> list[bytes]:
        return words_of(self.text)

    @cached_property
    def places(self) -> dict[bytes, np.ndarray]:
        found = defaultdict(list)
        for place, word in enumerate(self.words):
            found[word].append(place)
        return {word: np.array(places) for word, places in found.items()}

    @cached_property
    def phrases(self) -> list[list[bytes]]:
        return [words_of(key) for key in self.keys]


def _phrase(label: str, text: str) -> Template:
    return Template(label, text, (text,), base=True)


#: Phrases that name a licence by themselves.
BASE = (
    _phrase("mit", "under the mit license"),
    _phrase("apache-2", "apache license version 2"),
    _phrase("cc-by-nc", "cc by nc"),
)

#: Public licence notices, as their licences give them (fixed values).
NOTICES = (
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the Software), to deal in the Software without restriction, including without limitation"
        " the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        ("permission is hereby granted free of charge", "without restriction"),
    ),
    Template(
        "apache-2",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software"
        " distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND",
        ("www apache org licenses license 2 0", "in compliance with the license"),
    ),
    Template(
        "bsd-2",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
        " following conditions are met: Redistributions of source code must retain the above copyright notice, this list of"
        " conditions and the following disclaimer",
        ("redistribution and use in source and binary forms", "must retain the above copyright notice"),
    ),
    Template(
        "bsd-3",
        "may be used to endorse or promote products derived from this software without specific prior written permission",
        ("endorse or promote products derived from this software",),
    ),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
        " granted, provided that the above copyright notice and this permission notice appear in all copies",
        ("with or without fee is hereby granted",),
    ),
    Template("gpl-2", "licensed under the GNU General Public License, version 2", ("gnu general public license version 2",)),
    Template("gpl-3", "licensed under the GNU General Public License, version 3", ("gnu general public license version 3",)),
    Template(
        "gpl-2",
        "under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of"
        " the License, or (at your option) any later version",
        ("gnu general public license as published", "version 2 of the license"),
    ),
    Template(
        "gpl-3",
        "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of"
        " the License, or (at your option) any later version",
        ("gnu general public license as published", "version 3 of the license"),
    ),
    Template(
        "lgpl",
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version",
        ("gnu lesser general public license",),
    ),
    Template(
        "agpl-3",
        "under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3",
        ("gnu affero general public license",),
    ),
    Template(
        "mpl-2",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not"
        " distributed with this file, You can obtain one at",
        ("mozilla public license v 2 0",),
    ),
    Template(
        "unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,"
        " compile, sell, or distribute this software",
        ("free and unencumbered software", "public domain"),
    ),
    Template(
        "boost",
        "Distributed under the Boost Software License, Version 1.0",
        ("boost software license version 1 0",),
    ),
    Template(
        "cc0",
        "the person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or"
        " her rights to the work worldwide under copyright law",
        ("dedicated the work to the public domain",),
    ),
    Template("cc-by", "licensed under a Creative Commons Attribution 4.0 International License", ("creative commons attribution 4 0",)),
    Template(
        "cc-by-sa",
        "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
        ("creative commons attribution sharealike",),
    ),
    Template(
        "cc-by-nc",
        "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
        ("creative commons attribution noncommercial",),
    ),
)

FOUND = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("matched", pa.int32()), ("size", pa.int32()), ("base", pa.bool_())]))
FOUND_SCHEMA = "array<struct<label:string,start:long,matched:int,size:int,base:boolean>>"


class Index:
    """Licence texts by their words' places, with the number of documents that have each word."""

    def __init__(self, templates: Sequence[Template], documents: dict[bytes, int]):
        for t in templates:
            if len(t.places) < VOTES or any(word not in t.places for phrase in t.phrases for word in phrase):
                raise ValueError(f"{t.label}: too few words, or a key phrase with a word that its text lacks")
        self.templates = templates
        self.documents = documents
        self.needed = [frozenset(word for phrase in t.phrases for word in phrase) for t in templates]
        self.vocabulary = frozenset(word for t in templates for word in t.places)

    def scan(self, words: list[bytes]) -> Iterator[tuple[str, int, int, int, bool]]:
        """Label, beginning, words that agree, size and whether it is a base phrase, of each licence text found."""
        present = self.vocabulary.intersection(words)
        looked_up = [t for t, needed in zip(self.templates, self.needed) if needed <= present]
        if not looked_up:
            return
        wanted = {word for t in looked_up for word in t.places} & present
        places = defaultdict(list)
        for place, word in enumerate(words):
            if word in wanted:
                places[word].append(place)
        in_file = {word: np.array(found) for word, found in places.items()}
        standing: dict[tuple[bytes, ...], np.ndarray] = {}
        for t in looked_up:
            rarest = sorted(t.places.keys() & present, key=lambda w: (self.documents.get(w, 0), w))[:RARE]
            begins = np.concatenate([(in_file[w][:, None] - t.places[w]).ravel() for w in rarest])
            begins, votes = np.unique(begins, return_counts=True)
            size = len(t.words)
            for begin in begins[votes >= VOTES].tolist():
                here = words[max(begin, 0) : begin + size]
                matched = sum(map(operator.eq, here, t.words[max(-begin, 0) :]))
                if t.base:
                    passes = matched == size
                else:
                    passes = all(self._stands(p, begin, size, words, in_file, standing) for p in t.phrases)
                if passes:
                    yield t.label, begin, matched, size, t.base

    def _stands(self, phrase, begin, size, words, in_file, standing) -> bool:
        """Whether a key phrase stands within SLACK words of the licence text's place."""
        starts = standing.get(tuple(phrase))
        if starts is None:
            rarest = min(range(len(phrase)), key=lambda k: len(in_file[phrase[k]]))
            tried = (in_file[phrase[rarest]] - rarest).tolist()
            starts = np.array([s for s in tried if s >= 0 and words[s : s + len(phrase)] == phrase], np.int64)
            standing[tuple(phrase)] = starts
        after = np.searchsorted(starts, begin - SLACK)
        return after < len(starts) and starts[after] <= begin + size + SLACK - len(phrase)


def _texts(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[list[bytes]]]]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            part = batch.slice(start, ROWS)
            yield part, [words_of(text or "") for text in part.column(column).to_pylist()]


def document_counts(docs: DataFrame, vocabulary: frozenset[bytes]) -> dict[bytes, int]:
    """How many rows of docs have each word of the vocabulary, whose size bounds the result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = defaultdict(int)
        for _, texts in _texts(batches, 0):
            for words in texts:
                for word in vocabulary.intersection(words):
                    counts[word] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    counted = docs.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {bytes(r["word"]): r["n"] for r in counted.collect()}


def find_licenses(docs: DataFrame, notices: Sequence[Template] = NOTICES, base: Sequence[Template] = BASE) -> DataFrame:
    """doc_id, n_words and found of each row: each licence text that stands in the text.

    found has label, start (the word of the file, from 0, where the licence text begins; negative if
    its beginning is missing), matched (its words that stand at their places), size (its words) and
    base. Base phrases are found wherever all their words stand one after another. Null texts count as
    empty; texts without words, or without licences, have an empty list. Repeated rows and null
    doc_ids stay, and each row counts for the rarity of words. Other columns are not read. An empty
    table gives an empty result. Texts are read twice; only counts of licence words are shuffled.
    """
    templates = (*base, *notices)
    index = Index(templates, document_counts(docs, Index(templates, {}).vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _texts(batches, 1):
            names = [field.name for field in FOUND.value_type]
            found = [[dict(zip(names, f)) for f in index.scan(words)] for words in texts]
            counts = pa.array(list(map(len, texts)), pa.int64())
            yield pa.RecordBatch.from_arrays([part.column(0), counts, pa.array(found, FOUND)], ["doc_id", "n_words", "found"])

    kind = docs.select("doc_id").schema[0].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_words long, found {FOUND_SCHEMA}")


def license_labels(found: DataFrame) -> DataFrame:
    """From find_licenses, per row: base places, labels, and the largest share of a licence text found."""
    base = F.filter("found", lambda f: f["base"])
    starts = F.transform(base, lambda f: f["start"])

    def labels(column):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(column, lambda f: f["label"]))), ",")

    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("found")).alias("labels"),
        F.coalesce(F.array_max(F.transform("found", lambda f: f["matched"] / f["size"])), F.lit(0.0)).alias("score"),
    )
