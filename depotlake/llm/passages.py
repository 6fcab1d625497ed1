"""Repeated byte strings of LENGTH: column-wise construction over many strings at once.

Removed is each byte that a LENGTH-byte string covers which starts at another place too, in any
document. The same rounds also find repeated strings of SHORTER bytes (some 50 words), which are
counted only. The work is dealt out by anchors. The anchor of a string is the place of the least hash of
eight bytes among its first SPREAD places, so equal strings have their anchors at the same distance.
The places that share an anchor make one segment, and a segment's key is a hash of the bytes that
all its strings hold. Only segments whose key occurs again can hold repeated strings.

The segments of one key are aligned at their anchors, and equal strings start in equal columns.
Columns are inserted from the last to the first, one symbol for each segment and round (the
multi-document construction of Bauer, Cox and Rosone, with its common prefixes). A round reads the
order of the suffixes and their common prefixes with the one before, and writes the next: suffixes
by their new symbol, in the old order within a symbol; common prefixes as one more than the least
since the symbol was last seen. As suffixes of different columns need no comparing here, a round
replaces the last one's arrays instead of inserting into arrays of all columns: the work is linear
in the text, where those would make it grow with the square of the segment. Large arrays are files.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from depotlake.llm.tables import Scratch, row_key
from depotlake.llm.words import batches, buffer, prefix_hash, span_hash

LENGTH = 400
#: Repeated strings of so many bytes are counted.
SHORTER = 250
#: Places among which a string's anchor is chosen.
SPREAD = 192
GRAM = 8
#: Places looked at in one piece of a long text.
PIECE = 1 << 20
#: Strings and bytes of the segments that are ordered at once; a key is never split between two.
GROUP_ROWS, GROUP_BYTES = 50_000, 24_000_000
#: Arrays of more bytes are files.
IN_MEMORY = 256_000_000
#: Keys with more different segments are dealt anew by PART places of the string's start, under longer keys.
MANY_SEGMENTS, PART = 2000, 32
#: Groups that still have more different parts are dealt anew by fewer places, at last by single strings.
FEWER_PLACES = (8, 1)
#: A key is hot if this part of a sample of documents has it, and HOT_LEAST of them; one in HOT_SAMPLE is looked at.
HOT_SHARE, HOT_LEAST, HOT_SAMPLE, SALTS = 0.01, 10, 50, 1024

_HASH_PLACE = np.uint64((1 << 22) - 1)


def anchors(data: np.ndarray, offsets: np.ndarray, shorter: int, spread: int, most: int) -> tuple[np.ndarray, ...]:
    """Row, first place, last place, anchor and key of the segments of some rows, places in data; of strings that start below most."""
    n = len(data)
    row_of = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    starts = np.flatnonzero(np.arange(n) + shorter <= offsets[1:][row_of]) if n else np.zeros(0, np.int64)
    starts = starts[starts < most]
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none, none, none, none, none
    prefix = prefix_hash(data)
    grams = np.full(-(-n // spread) * spread + spread, np.uint64(2**64 - 1))
    places = np.arange(n - GRAM + 1)
    grams[: len(places)] = (span_hash(prefix, places, places + GRAM) & ~_HASH_PLACE) | places.astype(np.uint64)
    rows = grams.reshape(-1, spread)
    before = np.minimum.accumulate(rows, axis=1).reshape(-1)
    after = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    anchor = (np.minimum(after[starts], before[starts + spread - 1]) & _HASH_PLACE).astype(np.int64)
    row = row_of[starts]
    new = np.flatnonzero((np.diff(anchor, prepend=-1) != 0) | (np.diff(row, prepend=-1) != 0))
    low, high = starts[new], starts[np.append(new[1:], len(starts)) - 1]
    anchor = anchor[new]
    key = span_hash(prefix, anchor, anchor + shorter - spread + 1)
    return row[new], low, high, anchor, key.view(np.int64)


def _names(data: np.ndarray, low: np.ndarray, high: np.ndarray, ends: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """64 bits of a cryptographic hash of each segment's bytes, its anchor's place in it and its starts."""
    view, digest = memoryview(np.ascontiguousarray(data)), hashlib.blake2b
    salts = np.stack([anchor - low, high - low], axis=1).astype("<i8").tobytes()
    names = [digest(view[a:b], digest_size=8, salt=salts[16 * k : 16 * k + 16]).digest() for k, (a, b) in enumerate(zip(low.tolist(), ends.tolist()))]
    return np.frombuffer(b"".join(names), "<i8")


def segments(docs: DataFrame, length: int, shorter: int, spread: int) -> DataFrame:
    """A row for each different segment of each row of docs, with all its places there (first bytes).

    A segment holds strings of shorter bytes that share an anchor, and what follows them up to length.
    """
    named = docs.select(*row_key(docs), "text")
    kind = named.schema["doc_id"].dataType.simpleString()

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in given:
            for batch in batches(whole, size=PIECE):
                data, offsets = buffer(batch.column(2))
                single = batch.num_rows == 1  # may be long: piece by piece, which share length - 1 bytes
                for first in range(0, len(data), PIECE) if single else [0]:
                    part = data[first : first + PIECE + length - 1] if single else data
                    at = np.array([0, len(part)]) if single else offsets
                    row, low, high, anchor, key = anchors(part, at, shorter, spread, PIECE if single else len(part))
                    if len(row):
                        ends = np.minimum(high + length, at[1:][row])
                        segment = _names(part, low, high, ends, anchor)
                        yield _collapsed(batch, at, first, row, low, high, anchor, key, segment, ends - low)

    schema = f"doc_id {kind}, text_key long, key long, segment long, place long, places binary, n_places int, starts int, anchor int, size int"
    return named.mapInArrow(run, schema)


def _collapsed(batch, offsets, first, row, low, high, anchor, key, segment, size) -> pa.RecordBatch:
    order = np.lexsort((low, segment, key, row))
    row, low, high, anchor, key, segment, size = (x[order] for x in (row, low, high, anchor, key, segment, size))
    new = np.flatnonzero((np.diff(row, prepend=-1) != 0) | (np.diff(key, prepend=0) != 0) | (np.diff(segment, prepend=0) != 0))
    ends = np.append(new[1:], len(row))
    inside = (low - offsets[row] + first).astype("<i8")
    packed = inside.tobytes()
    places = [packed[8 * a : 8 * b] for a, b in zip(new.tolist(), ends.tolist())]
    taken = pa.array(row[new])
    return pa.RecordBatch.from_arrays(
        [
            batch.column(0).take(taken), batch.column(1).take(taken), pa.array(key[new]), pa.array(segment[new]), pa.array(inside[new]), pa.array(places, pa.binary()),
            pa.array((ends - new).astype(np.int32)), pa.array((high - low + 1)[new].astype(np.int32)), pa.array((anchor - low)[new].astype(np.int32)),
            pa.array(size[new].astype(np.int32)),
        ],
        ["doc_id", "text_key", "key", "segment", "place", "places", "n_places", "starts", "anchor", "size"],
    )


def repeated_segments(docs: DataFrame, length: int, shorter: int, spread: int, scratch: Scratch) -> DataFrame:
    """The rows of segments whose key has several places. Hot keys, found in a sample, are spread over tasks."""
    share = F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(HOT_SAMPLE))
    sample = docs.where(share == 0)
    least = max(HOT_LEAST, int(HOT_SHARE * sample.count()))
    hot = segments(sample, length, shorter, spread).groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    hot = scratch.put(hot.select("key", F.lit(True).alias("hot")), "hot-keys")
    found = segments(docs, length, shorter, spread)
    # at most (segments of a document) / HOT_SHARE keys are hot
    marked = found.join(F.broadcast(hot), "key", "left") if not hot.isEmpty() else found.withColumn("hot", F.lit(None).cast("boolean"))
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(SALTS))).otherwise(0)
    members = F.sum("n_places").over(Window.partitionBy("key", "salt"))
    kept = marked.withColumn("salt", salt).withColumn("members", members).where("hot or members > 1")
    return kept.drop("hot", "salt", "members")


def packed_texts(docs: DataFrame) -> DataFrame:
    """doc_id, text_key and the compressed bytes of the text."""
    named = docs.select(*row_key(docs), "text")
    kind = named.schema["doc_id"].dataType.simpleString()

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for whole in given:
            for batch in batches(whole):
                column = pa.array([pack(t) for t in batch.column(2).to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), column], ["doc_id", "text_key", "packed"])

    return named.mapInArrow(run, f"doc_id {kind}, text_key long, packed binary")


CUT = pa.schema([
    ("group", pa.int64()), ("key", pa.int64()), ("segment", pa.int64()), ("weight", pa.int64()),
    ("shift", pa.int32()), ("starts", pa.int32()), ("anchor", pa.int32()), ("data", pa.binary()),
])
CUT_SCHEMA = "group long, key long, segment long, weight long, shift int, starts int, anchor int, data binary"


def cut_segments(places: DataFrame, docs: DataFrame, length: int, shorter: int) -> DataFrame:
    """The bytes of segments, from one place of each: rows of CUT."""
    wanted = places.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("key", "segment", "weight", "place", "starts", "anchor", "variants")).alias("wanted"))
    texts = packed_texts(docs)
    wanted = wanted.withColumnsRenamed({"doc_id": "its_id", "text_key": "its_key"})
    same = texts["doc_id"].eqNullSafe(wanted["its_id"]) & (texts["text_key"] == wanted["its_key"])
    both = texts.join(wanted, same).select("packed", "wanted")
    most, part = MANY_SEGMENTS, PART

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for whole in given:
            for number in range(whole.num_rows):
                text = unpack(whole.column(0)[number].as_py())
                rows = [cut for asked in whole.column(1)[number].as_py() for cut in _cut(text, asked, length, shorter, most, part)]
                columns = [pa.array(values, field.type) for values, field in zip(zip(*rows), CUT)]
                yield pa.RecordBatch.from_arrays(columns, CUT.names)

    return both.mapInArrow(run, CUT_SCHEMA)


def _cut(text: bytes, asked: dict, length: int, shorter: int, most: int, part: int) -> Iterator[tuple]:
    key, segment, weight, place, starts, anchor = (asked[c] for c in ("key", "segment", "weight", "place", "starts", "anchor"))
    data = text[place : place + starts - 1 + length]
    if asked["variants"] <= most:
        yield key, key, segment, weight, 0, starts, anchor, data
    else:
        yield from _parts(data, key, segment, weight, starts, anchor, part, length, shorter)


def _parts(text: bytes, key: int, segment: int, weight: int, starts: int, anchor: int, size: int, length: int, shorter: int) -> Iterator[tuple]:
    """By distance to the anchor, in parts of size places; the bytes that all strings of a part hold are its key."""
    size = min(size, shorter)
    shift = 0
    while shift < starts:
        part = (anchor - shift) // size
        end = min(starts, anchor - part * size + 1)
        held = text[anchor - part * size : anchor - part * size - size + 1 + shorter]
        group = int.from_bytes(hashlib.blake2b(held, digest_size=8, key=(key ^ part).to_bytes(8, "little", signed=True)).digest(), "little", signed=True)
        yield group, key, segment, weight, shift, end - shift, anchor - shift, text[shift : end - 1 + length]
        shift = end


def _room(n: int, kind) -> np.ndarray:
    """An array, in a file of its own where it is large. The file has no name and goes with the array."""
    size = n * np.dtype(kind).itemsize
    return np.empty(n, kind) if size <= IN_MEMORY else np.memmap(tempfile.TemporaryFile(), kind, "w+", shape=(n,))


def repeated_starts(
    group: np.ndarray, strings: list[bytes], anchor: np.ndarray, starts: np.ndarray, weight: np.ndarray, lengths: Sequence[int]
) -> list[list[np.ndarray]]:
    """For each length and segment, whether the string of that length at each start occurs at another place.

    group ascends; the segments of a group are different, and weight counts the places of each.
    """
    many = len(strings)
    sizes = np.array([len(s) for s in strings], np.int64)
    flat = _room(int(sizes.sum()), np.uint8)
    begin = np.cumsum(sizes) - sizes
    for at, string in zip(begin.tolist(), strings):
        flat[at : at + len(string)] = np.frombuffer(string, np.uint8)
    first, last = -anchor.astype(np.int64), sizes - anchor  # columns, the anchor's is 0
    base = begin - first
    flag_base = np.cumsum(starts, dtype=np.int64) - starts
    flags = np.zeros((len(lengths), int(starts.sum())), bool)
    number = np.cumsum(np.diff(group, prepend=group[:1]) != 0)
    order, common = np.arange(many), _room(many, np.int32)
    common[:] = 0
    for column in range(int(last.max()) - 1, int(first.min()) - 1, -1):
        gone = first[order] > column
        if gone.any():
            kept = np.flatnonzero(~gone)
            if not len(kept):
                break
            common = np.minimum.reduceat(common[: kept[-1] + 1], np.append(0, kept[:-1] + 1))
            order = order[kept]
        begun = column < last[order]
        symbol = np.zeros(len(order), np.int64)  # 0: the segment has not begun
        symbol[begun] = flat[base[order[begun]] + column].astype(np.int64) + 1
        code = number[order] * 257 + symbol
        rises = code[1:] >= code[:-1]
        moved = None if rises.all() else np.argsort(code, kind="stable")
        grown = common + 1
        if moved is not None:
            code, symbol, order = code[moved], symbol[moved], order[moved]
            grown = common[moved] + 1
            apart = np.flatnonzero(np.diff(moved) != 1) + 1
            apart = apart[code[apart] == code[apart - 1]]
            if len(apart):  # the least since the symbol was last seen
                edges = np.stack([moved[apart - 1] + 1, moved[apart] + 1], axis=1).reshape(-1)
                least = np.minimum.reduceat(np.append(common, 0), edges)[::2]
                grown[apart] = least + 1
        follows = np.zeros(len(order), bool)
        follows[1:] = (code[1:] == code[:-1]) & (symbol[1:] > 0)
        common = np.where(follows, grown, 0)
        at = column - first[order]
        counted = at < starts[order]
        if counted.any():
            for length, found in zip(lengths, flags):
                # only starts count: what follows a segment's strings may be the strings of another one
                whole = counted & (at + length <= sizes[order])
                apart = common < length
                if apart.all():
                    hit = whole & (weight[order] > 1)
                else:
                    alike = np.cumsum(apart) - 1
                    hit = whole & (np.bincount(alike, np.where(whole, weight[order], 0)) > 1)[alike]
                found[flag_base[order[hit]] + at[hit]] = True
    return [np.split(found, flag_base[1:]) for found in flags]


RANGES = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _runs(flags: np.ndarray, shift: int) -> list[dict]:
    edges = np.flatnonzero(np.diff(flags.astype(np.int8), prepend=0, append=0))
    return [{"start": int(a) + shift, "end": int(b) + shift} for a, b in zip(edges[::2], edges[1::2])]


TOLD = "key long, segment long, ranges array<struct<start:int,end:int>>, shorter array<struct<start:int,end:int>>"


def ordered_segments(cut: DataFrame, length: int, shorter: int) -> DataFrame:
    """key, segment and the ranges of its starts (from, before) whose strings occur at another place, of both lengths."""

    def solved(rows: list[tuple]) -> pa.RecordBatch:
        group, key, segment, weight, shift, starts, anchor, data = zip(*rows)
        long, short = repeated_starts(np.array(group), list(data), np.array(anchor), np.array(starts, np.int64), np.array(weight), (length, shorter))
        # what is repeated at the full length is at the shorter
        told = [(k, s, _runs(a, by), ranges) for k, s, a, b, by in zip(key, segment, long, short, shift) if (ranges := _runs(b, by))]
        columns = [[t[n] for t in told] for n in range(4)]
        arrays = [pa.array(values, kind) for values, kind in zip(columns, (pa.int64(), pa.int64(), RANGES, RANGES))]
        return pa.RecordBatch.from_arrays(arrays, ["key", "segment", "ranges", "shorter"])

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for whole in given:
            for row in zip(*[column.to_pylist() for column in whole.columns]):
                if (len(held) >= GROUP_ROWS or size >= GROUP_BYTES) and row[0] != held[-1][0]:
                    yield solved(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[-1])
        if held:
            yield solved(held)

    ordered = cut.repartition("group").sortWithinPartitions("group")
    return ordered.mapInArrow(run, TOLD)


def shorter_parts(cut: DataFrame, size: int, length: int, shorter: int) -> DataFrame:
    """The rows of cut in parts of size places: rows of CUT."""

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in given:
            for start in range(0, whole.num_rows, 1024):
                asked = zip(*[column.to_pylist() for column in whole.slice(start, 1024).columns])
                rows = [part for data, *row in asked for part in _parts(data, *row, size, length, shorter)]
                columns = [pa.array(values, field.type) for values, field in zip(zip(*rows), CUT)]
                yield pa.RecordBatch.from_arrays(columns, CUT.names)

    return cut.select("data", "key", "segment", "weight", "starts", "anchor").mapInArrow(run, CUT_SCHEMA)


def _all_starts(length: int) -> Column:
    """The starts at which a segment of one string only holds strings of length bytes."""
    end = F.least(F.col("starts"), F.col("size") - length + 1)
    return F.when(end > 0, F.array(F.struct(F.lit(0).alias("start"), end.cast("int").alias("end")))).otherwise(F.array().cast("array<struct<start:int,end:int>>"))


def repeated_parts(cut: DataFrame, length: int, shorter: int, fewer: tuple[int, ...], scratch: Scratch) -> DataFrame:
    """What ordered_segments gives, for segments cut in parts, with no bound on the rows of a group.

    Parts of equal bytes at one distance from the anchor are one with a weight. A group that still
    has more than MANY_SEGMENTS different parts is dealt anew by the next of fewer places; after the
    last, parts are single strings: the group's weight decides for the shorter length, which all its
    parts share, the part's own weight for the full length.
    """
    level = len(fewer)
    known = cut.withColumn("part", F.xxhash64("anchor", "starts", F.sha2("data", 256)))
    owners = scratch.put(known.select("group", "part", "key", "segment", "shift"), f"owners-{level}")
    alike = known.groupBy("group", "part", "anchor", "starts", "data").agg(F.sum("weight").alias("weight"))
    named = {"key": F.col("group"), "segment": F.col("part"), "shift": F.lit(0)}
    parts = scratch.put(alike.withColumns(named).select(*CUT.names), f"parts-{level}")
    sizes = parts.groupBy("group").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("places"))
    if not fewer:
        weighed = parts.withColumn("size", F.octet_length("data")).select("group", "key", "segment", "weight", "starts", "size")
        long = F.when(F.col("weight") > 1, _all_starts(length)).otherwise(F.array().cast("array<struct<start:int,end:int>>"))
        told = weighed.join(sizes.where("places > 1"), "group").select("key", "segment", long.alias("ranges"), _all_starts(shorter).alias("shorter"))
    else:
        crowded = scratch.put(sizes.where(F.col("n") > MANY_SEGMENTS).select("group"), f"crowded-{level}")
        told = ordered_segments(parts.join(crowded, "group", "left_anti").select(*CUT.names), length, shorter)
        if not crowded.isEmpty():
            again = shorter_parts(parts.join(crowded, "group", "left_semi"), fewer[0], length, shorter)
            told = told.unionByName(repeated_parts(again, length, shorter, fewer[1:], scratch))
    told = told.withColumnsRenamed({"key": "group", "segment": "part"})
    moved = [
        F.transform(c, lambda r: F.struct((r["start"] + F.col("shift")).alias("start"), (r["end"] + F.col("shift")).alias("end"))).alias(c)
        for c in ("ranges", "shorter")
    ]
    return owners.join(told, ["group", "part"]).select("key", "segment", *moved)


def repeated_ranges(docs: DataFrame, length: int, shorter: int, spread: int, scratch: Scratch) -> DataFrame:
    """doc_id, text_key and hits: for each segment there its places and the ranges of repeated starts."""
    found = scratch.put(repeated_segments(docs, length, shorter, spread, scratch), "repeated-segments")
    one = F.min(F.struct("doc_id", "text_key", "place", "starts", "anchor", "size")).alias("one")
    whole = found.groupBy("key", "segment").agg(F.sum("n_places").alias("weight"), one)
    whole = scratch.put(whole.select("key", "segment", "weight", "one.*"), "segments")
    variants = whole.groupBy("key").agg(F.count(F.lit(1)).alias("variants"))
    counted = whole.join(variants, "key")
    # places of one string only: all its starts are repeated
    equal = counted.where("variants = 1 and weight > 1").select("key", "segment", _all_starts(length).alias("ranges"), _all_starts(shorter).alias("shorter"))
    cut = cut_segments(counted.where("variants > 1"), docs, length, shorter)
    if variants.where(F.col("variants") > MANY_SEGMENTS).isEmpty():
        told = ordered_segments(cut, length, shorter)
    else:
        cut = scratch.put(cut, "cut")
        told = ordered_segments(cut.where("group = key"), length, shorter)
        told = told.unionByName(repeated_parts(cut.where("group <> key"), length, shorter, FEWER_PLACES, scratch))
    ranges = scratch.put(equal.unionByName(told), "ranges")
    hits = found.select("doc_id", "text_key", "key", "segment", "places").join(ranges, ["key", "segment"])
    return hits.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("places", "ranges", "shorter")).alias("hits"))


def covered(hits: list[dict] | None, length: int, ranges: str = "ranges") -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of covered bytes of a text."""
    begins: list[int] = []
    ends: list[int] = []
    for hit in hits or ():
        places = np.frombuffer(hit["places"], "<i8").tolist()
        for part in hit[ranges]:
            first, after = part["start"], part["end"] - 1 + length
            begins += [p + first for p in places]
            ends += [p + after for p in places]
    if not begins:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.argsort(begins)
    first, after = np.array(begins)[order], np.maximum.accumulate(np.array(ends)[order])
    new = first[1:] > after[:-1]
    return first[np.append(True, new)], after[np.append(new, True)]


def without_repeats(docs: DataFrame, length: int = LENGTH, shorter: int | None = None, spread: int | None = None) -> DataFrame:
    """For each row of docs: doc_id, text_key, n_bytes, n_removed, n_spans, spans, kept (the bytes left), n_repeated.

    n_repeated counts the bytes that repeated strings of shorter bytes cover, by default SHORTER, or
    length where that is less. They stay.

    Null texts count as empty; texts shorter than length lose nothing. Rows that repeat are places
    of their own, so they lose what is long enough in all of them. Other columns are not read. An
    empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "passages")
    shorter = min(shorter or SHORTER, length)
    spread = spread or max(1, min(SPREAD, shorter - 2 * GRAM))
    hits = scratch.put(repeated_ranges(docs, length, shorter, spread, scratch), "hits")
    hits = hits.withColumnsRenamed({"doc_id": "its_id", "text_key": "its_key"})
    texts = packed_texts(docs)
    same = texts["doc_id"].eqNullSafe(hits["its_id"]) & (texts["text_key"] == hits["its_key"])
    kind = texts.schema["doc_id"].dataType.simpleString()
    names = ["n_bytes", "n_removed", "n_spans", "spans", "kept", "n_repeated"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), RANGES, pa.binary(), pa.int64()]

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for whole in given:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                rows = []
                for packed, found in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                    text = unpack(packed)
                    begins, ends = covered(found, length)
                    left = zip([0, *ends.tolist()], [*begins.tolist(), len(text)])
                    kept = b"".join(text[a:b] for a, b in left)
                    spans = [{"start": a, "end": b} for a, b in zip(begins.tolist(), ends.tolist())]
                    begins, ends = covered(found, shorter, "shorter")
                    rows.append((len(text), len(text) - len(kept), len(spans), spans, kept, int((ends - begins).sum())))
                columns = [pa.array(values, of) for values, of in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["doc_id", "text_key", *names])

    joined = texts.join(hits, same, "left").select("doc_id", "text_key", "packed", "hits")
    schema = f"doc_id {kind}, text_key long, n_bytes long, n_removed long, n_spans long, spans array<struct<start:int,end:int>>, kept binary, n_repeated long"
    return joined.mapInArrow(run, schema)
