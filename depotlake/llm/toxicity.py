"""Toxicity: a factorization machine over hashed terms.

Terms are words and their beginnings, in lower case, hashed to BUCKETS. From a bounded sample of
labelled rows, the terms are kept whose document counts tell the classes apart beyond chance. The
machine then learns a weight and a vector for each, so that a pair of terms can count for more than
both alone. It is a small table; scoring is one pass over the texts, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotlake.llm.tables import text_of
from depotlake.llm.words import batches, buffer, prefix_hash, release, runs, span_hash

BUCKETS = 1 << 20
#: Bytes of the beginnings of words that are terms of their own.
BEGINNINGS = (4, 5, 6, 7)
#: Labelled rows of each class that the machine is fitted on, at most about this many.
SAMPLE_ROWS = 6000
#: Terms of the machine at most, and the least log-likelihood statistic (G) of a term.
TERMS = 4096
LEAST_G = 20.0
FACTORS = 8
#: Passes over the sample, and steps at least.
EPOCHS = 30
LEAST_STEPS = 600
RATE = 0.02
DECAY = 1e-4
#: Score from which a document is rejected.
CUT = 0.7

_LETTER = np.zeros(256, bool)
_LETTER[ord("a") : ord("z") + 1] = True
_LETTER[0x80:] = True  # all bytes of other scripts' letters


@dataclass(frozen=True)
class Machine:
    """buckets (ascending) of the terms, bias, a weight and a vector for each term."""

    buckets: np.ndarray
    bias: float
    weights: np.ndarray
    vectors: np.ndarray

    def scores(self, row: np.ndarray, term: np.ndarray, rows: int) -> np.ndarray:
        """Probabilities of rows that have terms (places in buckets); each pair of row and term once."""
        sums = np.zeros((rows, self.vectors.shape[1]))
        np.add.at(sums, row, self.vectors[term])
        squares = np.bincount(row, (self.vectors[term] ** 2).sum(axis=1), rows)
        linear = np.bincount(row, self.weights[term], rows)
        raw = self.bias + linear + ((sums**2).sum(axis=1) - squares) / 2
        return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))


def term_buckets(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of each term of each text, each once; nulls have none."""
    column = pa.array([(t or "").lower() for t in texts], pa.large_string())
    found_rows, found_buckets, base = [], [], 0
    for part in batches(pa.RecordBatch.from_arrays([column], ["text"])):
        data, offsets = buffer(part.column(0))
        starts, ends = runs(_LETTER[data], offsets)
        prefix = prefix_hash(data)
        row = np.searchsorted(offsets, starts, "right") - 1 + base
        hashes, rows = [span_hash(prefix, starts, ends)], [row]
        for length in BEGINNINGS:
            longer = ends - starts > length
            hashes.append(span_hash(prefix, starts[longer], starts[longer] + length) ^ np.uint64(length))
            rows.append(row[longer])
        pairs = np.unique(np.concatenate(rows).astype(np.int64) * BUCKETS + (np.concatenate(hashes) % np.uint64(BUCKETS)).astype(np.int64))
        found_rows.append(pairs // BUCKETS)
        found_buckets.append(pairs % BUCKETS)
        base += part.num_rows
    empty = np.zeros(0, np.int64)
    return (np.concatenate(found_rows), np.concatenate(found_buckets)) if found_rows else (empty, empty)


def _places(texts: list[str | None], buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and place in buckets of each known term of each text, by row."""
    row, bucket = term_buckets(texts)
    if not len(buckets):
        return row[:0], bucket[:0]
    place = np.minimum(np.searchsorted(buckets, bucket), len(buckets) - 1)
    known = buckets[place] == bucket
    return row[known], place[known]


def _slices(given: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Batches of a few rows: a worker holds the terms of these only."""
    for batch in given:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
        del batch


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are not learned from: crc32 of the id as text has the remainder 1 by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """text and toxic of a bounded number of labelled rows, chosen by a hash of doc_id in each class.

    Repeated labels of a document count as toxic if one does; null labels and ids are left out.
    """
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic")).where(~held_out(F.col("doc_id")))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}  # two rows
    share = [int(1_000_000 * min(1.0, rows / max(counts.get(toxic, 0), 1))) for toxic in (False, True)]
    part = F.when(F.col("toxic"), share[1]).otherwise(share[0])
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < part)
    # about 2 * rows ids by construction, whatever the corpus is
    texts = docs.select("doc_id", text_of(docs).alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic")


def train(sample: DataFrame, terms: int = TERMS, seed: int = 7) -> Machine:
    """The machine fitted on a bounded sample (doc_id, text, toxic). Without both classes it scores 0.5 or less."""
    sample = sample.repartition(8, F.xxhash64("doc_id")).select("doc_id", "text", "toxic")

    def term_rows(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, BUCKETS), np.int32)
        for batch in _slices(given):
            toxic = np.array(batch.column(2).to_pylist(), bool)
            row, bucket = term_buckets(batch.column(1).to_pylist())
            for side in (0, 1):
                np.add.at(counts[side], bucket[toxic[row] == side], 1)
        seen = np.flatnonzero(counts.sum(axis=0))
        for start in range(0, len(seen), 50_000):
            some = seen[start : start + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[0, some].astype(np.int64)), pa.array(counts[1, some].astype(np.int64))], ["bucket", "clean", "toxic"])

    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    clean, toxic = (float(max(sizes.get(side, 0), 1)) for side in (False, True))
    counted = sample.mapInArrow(term_rows, "bucket long, clean long, toxic long").groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    both, share = F.col("toxic") + F.col("clean"), toxic / (toxic + clean)

    def surprise(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    g = 2 * (
        surprise(F.col("toxic"), both * share)
        + surprise(F.col("clean"), both * (1 - share))
        + surprise(toxic - F.col("toxic"), toxic - both * share)
        + surprise(clean - F.col("clean"), clean - both * (1 - share))
    )
    best = counted.select("bucket", g.alias("g")).where(F.col("g") >= LEAST_G).orderBy(F.desc("g"), "bucket").limit(terms)
    buckets = np.sort(np.array([r["bucket"] for r in best.collect()], np.int64))  # TERMS at most

    def known_terms(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(given):
            row, place = _places(batch.column(1).to_pylist(), buckets)
            ends = np.searchsorted(row, np.arange(batch.num_rows + 1))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(place, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), lists], ["doc_id", "toxic", "places"])

    def fitted(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for batch in given for r in batch.to_pylist()]
        rows.sort(key=lambda r: (r["doc_id"], r["toxic"], r["places"]))  # the same in any partitioning
        if rows:
            row = np.repeat(np.arange(len(rows)), [len(r["places"]) for r in rows])
            place = np.array([p for r in rows for p in r["places"]], np.int64)
            bias, weights, vectors = _fit(row, place, np.array([r["toxic"] for r in rows], float), len(buckets), seed)
            yield pa.RecordBatch.from_arrays([pa.array([bias]), pa.array([weights.tolist()], pa.list_(pa.float64())), pa.array([vectors.reshape(-1).tolist()], pa.list_(pa.float64()))], ["bias", "weights", "vectors"])

    kind = sample.schema["doc_id"].dataType.simpleString()
    terms_of = sample.mapInArrow(known_terms, f"doc_id {kind}, toxic boolean, places array<int>")
    fit = terms_of.repartition(1).mapInArrow(fitted, "bias double, weights array<double>, vectors array<double>").collect()
    if not fit:
        return Machine(buckets, 0.0, np.zeros(len(buckets)), np.zeros((len(buckets), FACTORS)))
    return Machine(buckets, fit[0]["bias"], np.array(fit[0]["weights"]), np.array(fit[0]["vectors"]).reshape(len(buckets), FACTORS))


def _fit(row: np.ndarray, term: np.ndarray, toxic: np.ndarray, terms: int, seed: int) -> tuple[float, np.ndarray, np.ndarray]:
    """Adam over the logistic loss, both classes with equal weight in sum."""
    random = np.random.default_rng(seed)
    rows = len(toxic)
    order = np.lexsort((term, row))
    row, term = row[order], term[order]
    begins = np.searchsorted(row, np.arange(rows + 1))
    share = max(min(toxic.mean(), 1 - 1 / rows), 1 / rows) if rows else 0.5
    weight = np.where(toxic > 0, 0.5 / share, 0.5 / (1 - share))
    table = np.concatenate([np.zeros((terms, 1)), random.normal(0, 0.01, (terms, FACTORS))], axis=1)
    bias = 0.0
    first, second = np.zeros_like(table), np.zeros_like(table)
    moment = np.zeros(2)
    step = 0
    for _ in range(max(EPOCHS, -(-LEAST_STEPS * 256 // max(rows, 1)))):
        mixed = random.permutation(rows)
        for start in range(0, rows, 256):
            step += 1
            chosen = mixed[start : start + 256]
            counts = begins[chosen + 1] - begins[chosen]
            inner = np.repeat(np.arange(len(chosen)), counts)
            used = term[np.repeat(begins[chosen] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())]
            vectors = table[used, 1:]
            sums = np.zeros((len(chosen), FACTORS))
            np.add.at(sums, inner, vectors)
            raw = bias + np.bincount(inner, table[used, 0], len(chosen)) + ((sums**2).sum(axis=1) - np.bincount(inner, (vectors**2).sum(axis=1), len(chosen))) / 2
            error = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - toxic[chosen]) * weight[chosen] / len(chosen)
            slope = DECAY * table
            np.add.at(slope[:, 0], used, error[inner])
            np.add.at(slope[:, 1:], used, error[inner, None] * (sums[inner] - vectors))
            first = 0.9 * first + 0.1 * slope
            second = 0.999 * second + 0.001 * slope**2
            table -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
            moment = np.array([0.9 * moment[0] + 0.1 * error.sum(), 0.999 * moment[1] + 0.001 * error.sum() ** 2])
            bias -= RATE * (moment[0] / (1 - 0.9**step)) / (np.sqrt(moment[1] / (1 - 0.999**step)) + 1e-8)
    return float(bias), table[:, 0], table[:, 1:]


def scored(docs: DataFrame, machine: Machine, *carried: Column) -> DataFrame:
    """The carried columns and score of each row. Null texts count as empty and get the score of no terms."""
    given = docs.select(*carried, docs["text"].alias("scored_text"))
    shown = given.drop("scored_text").schema

    def run(given_batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _slices(given_batches):
            row, place = _places(some.column(some.num_columns - 1).to_pylist(), machine.buckets)
            scores = machine.scores(row, place, some.num_rows)
            yield pa.RecordBatch.from_arrays([*some.columns[:-1], pa.array(scores)], [*some.schema.names[:-1], "score"])
            del some
        release()

    return given.mapInArrow(run, shown.add("score", "double"))


def score_documents(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """For each row: doc_id, held_out, score, predicted.

    Labels are learned only from rows that are not held out; a score depends on the text alone.
    Rows of null doc_id are scored and not held out. Other columns are not read.
    """
    machine = train(labelled_sample(docs, labels, rows))
    found = scored(docs, machine, docs["doc_id"].alias("doc_id"))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of docs that score below CUT, all columns. A worker gets each row once and gives back those that stay."""
    machine = train(labelled_sample(docs, labels, rows))
    text = docs.columns.index("text")

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _slices(given):
            row, place = _places(some.column(text).to_pylist(), machine.buckets)
            yield some.filter(pa.array(machine.scores(row, place, some.num_rows) < CUT))
            del some
        release()

    return docs.mapInArrow(run, docs.schema)
