"""Document fingerprints: one-permutation MinHash, densified, of a few bits for each bin.

Each shingle of five words is hashed once. The first bits of the hash choose a bin, and a bin keeps
its least hash. Empty bins are filled by optimal densification: a hash of the bin and the number of
the attempt names another bin, until that one is not empty, the same for all documents. Of each bin
the lowest bits are stored, packed. Two bins agree by chance with probability 2**-BITS, for which
the likeness is corrected.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from depotlake.llm.tables import Scratch, row_key
from depotlake.llm.words import CHUNK, mix, shingles, word_hashes

BINS_LOG2 = 9
BINS = 1 << BINS_LOG2
BITS = 4
WIDTH = 5
_EMPTY = np.uint64(2**64 - 1)


def _attempt(number: int) -> np.ndarray:
    """The bin that each empty bin looks at in an attempt."""
    return (mix(np.arange(BINS, dtype=np.uint64) + np.uint64(number * BINS + 1)) >> np.uint64(64 - BINS_LOG2)).astype(np.int64)


@cache
def _attempts() -> tuple[np.ndarray, np.ndarray]:
    """The bins looked at in attempts 0, 1, ..., and the first attempt in which each bin looks at each other."""
    looked, first = [], np.full((BINS, BINS), -1, np.int32)
    while (first < 0).any():
        source = _attempt(len(looked))
        new = np.flatnonzero(first[np.arange(BINS), source] < 0)
        first[new, source[new]] = len(looked)
        looked.append(source)
    return np.array(looked[:64]), first


#: With fewer full bins, the attempts of an empty one are looked up instead of made.
FEW = 64


def densified(bins: np.ndarray) -> np.ndarray:
    """Rows of bins with the empty ones filled; a row without any full bin stays empty."""
    looked, first = _attempts()
    out = bins.copy()
    for row in out:
        full = row != _EMPTY
        left = np.flatnonzero(~full)
        if not len(left) or len(left) == BINS:
            continue
        for source in looked if BINS - len(left) >= FEW else ():
            found = full[source[left]]
            row[left[found]] = row[source[left[found]]]
            left = left[~found]
            if not len(left):
                break
        if len(left):
            known = np.flatnonzero(full)
            row[left] = row[known[first[np.ix_(left, known)].argmin(axis=1)]]
    return out


def fingerprints(texts: Sequence[bytes]) -> list[bytes]:
    """The fingerprint of each text, BINS * BITS / 8 bytes; empty for a text without words."""
    out: list[bytes] = []
    start = 0
    while start < len(texts):
        end, held = start + 1, len(texts[start])
        while end < len(texts) and held + len(texts[end]) <= CHUNK:
            held += len(texts[end])
            end += 1
        out += _some(texts[start:end])
        start = end
    return out


def _some(texts: Sequence[bytes]) -> list[bytes]:
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
    hashes, begins = shingles(*word_hashes(data, offsets), WIDTH)
    bins = np.full((len(texts), BINS), _EMPTY, np.uint64)
    row = np.repeat(np.arange(len(texts)), np.diff(begins))
    np.minimum.at(bins.reshape(-1), row * BINS + (hashes >> np.uint64(64 - BINS_LOG2)).astype(np.int64), hashes)
    low = (densified(bins) & np.uint64((1 << BITS) - 1)).astype(np.uint8)
    packed = np.packbits(((low[:, :, None] >> np.arange(BITS, dtype=np.uint8)) & 1).reshape(len(texts), -1), axis=1, bitorder="little")
    return [packed[n].tobytes() if counted else b"" for n, counted in enumerate(np.diff(begins) > 0)]


def likeness(left: bytes, right: bytes) -> float:
    """Estimated share of common shingles, 0 to 1. Texts without words are alike, and unlike any other."""
    if not left or not right:
        return float(left == right)
    differ = np.unpackbits(np.frombuffer(left, np.uint8) ^ np.frombuffer(right, np.uint8)).reshape(BINS, BITS).any(axis=1)
    chance = 2.0**-BITS
    return float(min(1.0, max(0.0, (1 - differ.mean() - chance) / (1 - chance))))


FIELDS = pa.schema([
    ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.binary()),
    ("edited_fingerprint", pa.binary()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
])
SCHEMA = "n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"


def edited(text: str, following: str) -> str:
    """The text with its last half (rounded down) replaced by as much of the start of another."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compared(texts: Sequence[str], following: Sequence[str]) -> list[list]:
    """The columns of FIELDS for texts and the documents after them."""
    changed = [edited(a, b).encode() for a, b in zip(texts, following)]
    # mostly the document after one is the next text here
    inside = all(a is b for a, b in zip(following, texts[1:]))
    more = following[-1:] if inside else following
    found = fingerprints([t.encode() for t in (*texts, *more)])
    own, after = found[: len(texts)], found[1:] if inside else found[len(texts) :]
    other = fingerprints(changed)
    return [
        [len(t) for t in texts],
        [hashlib.sha256(c).hexdigest() for c in changed],
        own,
        other,
        [likeness(a, b) for a, b in zip(own, other)],
        [likeness(a, b) for a, b in zip(own, after)],
    ]


def _arrays(columns: list[list]) -> list[pa.Array]:
    return [pa.array(values, field.type) for values, field in zip(columns, FIELDS)]


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """For each row: doc_id and the columns of SCHEMA, against its edited text and the next document.

    The next document has the next smaller doc_id; null doc_ids come last, and rows of equal doc_id
    stand in order of a hash of the text. The first follows the last, and a single row itself. Null
    texts count as empty. Other columns are not read. Rows are dealt by doc_id ranges; where a range
    ends, its last row meets the first of the next range in a second step.
    """
    spark = docs.sparkSession
    order = [F.col("doc_id").desc_nulls_last(), F.col("text_key")]
    ordered = docs.select(*row_key(docs), "text").repartitionByRange(*order).sortWithinPartitions(*order)
    kind = docs.select("doc_id").schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, type_of = TaskContext.get().partitionId(), None, None

        def edge(side: str, name, text: str) -> pa.RecordBatch:
            row = [pa.array([part], pa.int32()), pa.array([side]), pa.array([name], type_of), pa.array([text])]
            return pa.RecordBatch.from_arrays([*row, *[pa.nulls(1, f.type) for f in FIELDS]], ["part", "side", "doc_id", "text", *FIELDS.names])

        for batch in batches:
            type_of = batch.column(0).type
            for begin in range(0, batch.num_rows, 128):
                some = batch.slice(begin, 128)
                names, texts = some.column(0).to_pylist(), [t or "" for t in some.column(2).to_pylist()]
                if held is None:
                    yield edge("first", names[0], texts[0])
                else:
                    names, texts = [held[0], *names], [held[1], *texts]
                held = (names[-1], texts[-1])
                if len(texts) > 1:
                    n = len(texts) - 1
                    outer = [pa.array([part] * n, pa.int32()), pa.nulls(n, pa.string()), pa.array(names[:-1], type_of), pa.nulls(n, pa.string())]
                    yield pa.RecordBatch.from_arrays([*outer, *_arrays(_compared(texts[:-1], texts[1:]))], ["part", "side", "doc_id", "text", *FIELDS.names])
        if held is not None:
            yield edge("last", *held)

    made = ordered.select("doc_id", "text_key", "text").mapInArrow(run, f"part int, side string, doc_id {kind}, text string, {SCHEMA}")
    made = Scratch(spark, "fingerprints").put(made, "rows")
    done = made.where("side is null").select("doc_id", *FIELDS.names)
    # a row for each range
    firsts, lasts = (made.where(F.col("side") == side).select("part", "doc_id", "text") for side in ("first", "last"))
    by_part = Window.orderBy("part")
    next_part = F.coalesce(F.lead("part").over(by_part), F.min("part").over(Window.partitionBy()))
    linked = firsts.select("part").select(F.col("part").alias("of_part"), next_part.alias("next_part"))
    after = firsts.select(F.col("part").alias("next_part"), F.col("text").alias("following"))
    pairs = lasts.join(linked, lasts["part"] == linked["of_part"]).join(after, "next_part").select("doc_id", "text", "following")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                one = batch.slice(n, 1)
                yield pa.RecordBatch.from_arrays([one.column(0), *_arrays(_compared(one.column(1).to_pylist(), one.column(2).to_pylist()))], ["doc_id", *FIELDS.names])

    return done.unionByName(pairs.mapInArrow(compare, f"doc_id {kind}, {SCHEMA}"))
