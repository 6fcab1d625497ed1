"""Fill-in-the-middle: a text cut at two of its unit boundaries, its parts put in another order.

The places where a text may be cut are a set of byte offsets, kept as a Roaring set: one container
for each 65,536 places, as sorted numbers, as a bitmap or as runs, whichever is smallest. Running
totals of the containers' sizes find the container of the k-th boundary, a select inside finds the
offset. So a text of many megabytes is cut without a list of its boundaries, and plain ASCII, where
each byte is a boundary, takes one run for each container.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPAN = 1 << 16
#: Rows handled at once.
ROWS = 256


class Numbers:
    """Places of a container as sorted numbers, two bytes each."""

    def __init__(self, places: np.ndarray):
        self.places = places.astype(np.uint16)

    @staticmethod
    def size(count: int, runs: int) -> int:
        return 2 * count

    def select(self, k: int) -> int:
        return int(self.places[k])


class Bitmap:
    """Places of a container as bits of 1024 words, with the number of bits before each word."""

    def __init__(self, places: np.ndarray):
        bits = np.zeros(SPAN, np.uint8)
        bits[places] = 1
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    @staticmethod
    def size(count: int, runs: int) -> int:
        return SPAN // 8

    def select(self, k: int) -> int:
        word = int(np.searchsorted(self.before, k, "right")) - 1
        bits = np.unpackbits(self.words[word : word + 1].view(np.uint8), bitorder="little")
        return 64 * word + int(np.flatnonzero(bits)[k - int(self.before[word])])


class Runs:
    """Places of a container as runs of neighbours: where each starts, and the places before it."""

    def __init__(self, places: np.ndarray):
        self.before = np.flatnonzero(np.diff(places, prepend=-2) != 1)
        self.starts = places[self.before]

    @staticmethod
    def size(count: int, runs: int) -> int:
        return 4 * runs

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.before, k, "right")) - 1
        return int(self.starts[run]) + k - int(self.before[run])


class Boundaries:
    """A set of byte offsets that gives its k-th smallest."""

    def __init__(self, keys: np.ndarray, before: np.ndarray, containers: list[Numbers | Bitmap | Runs]):
        """Containers of the spans with some offset, the numbers of these spans, and the offsets before each."""
        self.keys, self.before, self.containers = keys, before, containers

    @classmethod
    def of(cls, offsets: np.ndarray) -> Boundaries:
        """A set of offsets that ascend."""
        keys, firsts = np.unique(offsets // SPAN, return_index=True)
        ends = [*firsts[1:].tolist(), len(offsets)]
        parts = [offsets[a:b] % SPAN for a, b in zip(firsts.tolist(), ends)]
        return cls(keys, np.array([0, *ends], np.int64), [cls._smallest(p) for p in parts])

    @classmethod
    def up_to(cls, last: int) -> Boundaries:
        """All offsets from 0 to last: a run in each container."""
        keys = np.arange(last // SPAN + 1)
        run = Runs(np.zeros(1, np.int64))  # one run from 0, whose end is the set's or the container's
        return cls(keys, np.minimum(np.arange(len(keys) + 1) * SPAN, last + 1), [run] * len(keys))

    @staticmethod
    def _smallest(places: np.ndarray) -> Numbers | Bitmap | Runs:
        runs = 1 + int(np.count_nonzero(np.diff(places) != 1))
        return min((Runs, Numbers, Bitmap), key=lambda kind: kind.size(len(places), runs))(places)

    def __len__(self) -> int:
        return int(self.before[-1])

    def select(self, k: int) -> int:
        """The boundary that k others come before."""
        if not 0 <= k < len(self):
            raise IndexError(f"no boundary {k} of {len(self)}")
        at = int(np.searchsorted(self.before, k, "right")) - 1
        return int(self.keys[at]) * SPAN + self.containers[at].select(k - int(self.before[at]))


def boundaries(data: bytes, units: regex.Pattern | None = None) -> Boundaries:
    """The byte offsets that units of a UTF-8 text end at, and 0.

    Units are code points, or the matches of a pattern from left to right. What stands between
    matches belongs to the next one, what stands after the last to the last.
    """
    if units is None and data.isascii():
        return Boundaries.up_to(len(data))
    starts = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
    offsets = np.append(starts, len(data))
    if units is not None:
        ends = [m.end() for m in units.finditer(data.decode()) if m.end() > m.start()]
        offsets = offsets[[0, *ends[:-1], len(offsets) - 1]] if ends else offsets[:1]
    return Boundaries.of(offsets)


@dataclass(frozen=True)
class Signs:
    """What stands before the prefix, the suffix and the middle. None may be part of another."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def all(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


def draws(seed: str, doc_id: object) -> list[int]:
    """Four numbers of 32 bits from the seed and the document's id (none: the seed alone)."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]


def reorder(data: bytes, doc_id: object, seed: str, units, plain: int, spm: int, signs: Signs) -> tuple:
    """n, form, units of prefix and middle (None if plain), and the output, of one text."""
    allowed = boundaries(data, units)
    n = len(allowed) - 1
    h1, h2, h3, h4 = draws(seed, doc_id)
    marks = [s.encode() for s in signs.all()]
    if not n or any(mark in data for mark in marks) or h3 % 100 >= 100 - plain:
        return n, "plain", None, None, data
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = allowed.select(first), allowed.select(second)
    before, after, inside = marks
    if h4 % 100 < spm:
        return n, "spm", first, second - first, b"".join([after, data[b:], before, data[:a], inside, data[a:b]])
    return n, "psm", first, second - first, b"".join([before, data[:a], after, data[b:], inside, data[a:b]])


FIELDS = pa.schema([
    ("n", pa.int64()), ("form", pa.string()), ("prefix_units", pa.int64()), ("middle_units", pa.int64()), ("output", pa.binary()),
])


def fill_in_middle(
    docs: DataFrame, seed: str = "1", units: str | None = None, plain: int = 10, spm: int = 20, signs: Signs = Signs()
) -> DataFrame:
    """doc_id, n, form, prefix_units, middle_units and output of each row.

    The middle lies between two boundaries drawn from seed and doc_id, each of the n + 1 alike.
    form is plain (the text itself) in about plain of 100 documents, for empty texts, texts without
    a unit and texts that contain one of the signs; else spm (suffix first) in about spm of 100, else
    psm. Null texts count as empty. Rows of equal doc_id, or of null doc_id, are cut by the same
    draws. Other columns are not read. An empty table gives an empty result. Nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = regex.compile(units) if units is not None else None
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                texts = part.column(1).cast(pa.binary()).to_pylist()
                made = [reorder(t or b"", i, seed, pattern, plain, spm, signs) for i, t in zip(part.column(0).to_pylist(), texts)]
                arrays = [pa.array(values, field.type) for values, field in zip(zip(*made), FIELDS)]
                yield pa.RecordBatch.from_arrays([part.column(0), *arrays[:-1], arrays[-1].cast(pa.string())], ["doc_id", *FIELDS.names])

    kind = docs.select("doc_id").schema[0].dataType.simpleString()
    schema = f"doc_id {kind}, n long, form string, prefix_units long, middle_units long, output string"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def restored(output: Column, form: Column, signs: Signs = Signs()) -> Column:
    """The text that output was made from."""
    parts = F.split(output, "|".join(f"\\Q{s}\\E" for s in signs.all()), -1)
    psm = F.concat(parts[1], parts[3], parts[2])
    spm = F.concat(parts[2], parts[3], parts[1])
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
