"""Token ids in files of fixed-width bits.

A shard holds whole documents, in order. Its ids are packed with the fewest bits that hold any id
of the vocabulary, lowest bit first, in blocks of BLOCK ids. Each block starts on a byte, and the
shard lists where. So any run of ids is read by unpacking the blocks it touches, with numpy:

    magic 'TOKP', version, bits, BLOCK      4 bytes and three 32-bit numbers
    documents, ids, blocks                  three 64-bit numbers
    ends of the documents, in ids           64-bit numbers
    starts of the blocks, in bytes          64-bit numbers
    packed ids

Numbers are little-endian. Shards are stored as rows of Parquet files, whose tasks Spark commits:
a lost executor leaves no half-written shard. Rows are in ascending doc_id order: by part (the
place of the task's doc_id range), then by the place of the shard's first id in its part.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from depotlake.llm.pieces import Memory, Pieces
from depotlake.llm.tables import Scratch, row_key

MAGIC, VERSION = b"TOKP", 1
#: Ids of a block; a multiple of 8.
BLOCK = 4096
#: A shard ends with the document that reaches this many ids.
SHARD_IDS = 1 << 20
#: Bytes that a worker remembers of pieces of text, and a quarter as many of words.
MEMORY = 304 << 20
#: Bytes of text that a worker cuts into pieces at once.
PART_BYTES = 4 << 20
WHOLE_BYTES = {8: "u1", 16: "<u2", 32: "<u4"}
_HEAD = struct.Struct("<4s3I3Q")


def bits_for(vocabulary: int) -> int:
    """Bits that hold any id below vocabulary."""
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> np.ndarray:
    """Ids as a stream of bits, lowest first, padded to whole groups of eight ids (bits bytes each)."""
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"an id needs more than {bits} bits")
    groups = -(-len(ids) // 8)
    if bits in WHOLE_BYTES:  # the same bytes, without shifting
        plain = np.zeros(8 * groups, WHOLE_BYTES[bits])
        plain[: len(ids)] = ids
        return plain.view(np.uint8)
    eight = np.zeros((groups, 8), np.uint64)
    eight.reshape(-1)[: len(ids)] = ids
    out = np.zeros((groups, bits), np.uint8)
    for j in range(8):
        first, shift = divmod(j * bits, 8)
        value = eight[:, j] << np.uint64(shift)
        for k in range(-(-(shift + bits) // 8)):
            out[:, first + k] |= (value >> np.uint64(8 * k)).astype(np.uint8)
    return out.reshape(-1)


def unpack(data: np.ndarray, bits: int, count: int) -> np.ndarray:
    """The first count ids of packed groups."""
    if bits in WHOLE_BYTES:
        return np.ascontiguousarray(data).view(WHOLE_BYTES[bits])[:count].astype(np.uint32)
    groups = data.reshape(-1, bits)
    out = np.empty((len(groups), 8), np.uint32)
    mask = np.uint64((1 << bits) - 1)
    for j in range(8):
        first, shift = divmod(j * bits, 8)
        value = np.zeros(len(groups), np.uint64)
        for k in range(-(-(shift + bits) // 8)):
            value |= groups[:, first + k].astype(np.uint64) << np.uint64(8 * k)
        out[:, j] = (value >> np.uint64(shift)) & mask
    return out.reshape(-1)[:count]


def write_shard(documents: Sequence[np.ndarray], bits: int) -> bytes:
    ends = np.cumsum([len(d) for d in documents], dtype="<u8")
    ids = np.concatenate(documents) if documents else np.zeros(0, np.uint32)
    packed = pack(ids, bits)  # blocks are whole groups, so each starts on a byte
    starts = np.arange(0, len(packed), BLOCK // 8 * bits, dtype="<u8")
    head = _HEAD.pack(MAGIC, VERSION, bits, BLOCK, len(documents), len(ids), len(starts))
    return b"".join([head, ends.tobytes(), starts.tobytes(), packed.tobytes()])


class Shard:
    """Random access to the ids of a shard; the bytes may be a memory map."""

    def __init__(self, data):
        magic, version, self.bits, self.block, self.documents, self.ids, blocks = _HEAD.unpack_from(data)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a shard of token ids")
        at = _HEAD.size
        self.ends = np.frombuffer(data, "<u8", self.documents, at)
        at += 8 * self.documents
        self.starts = np.frombuffer(data, "<u8", blocks, at)
        self.data = np.frombuffer(data, np.uint8, offset=at + 8 * blocks)

    def read(self, start: int, end: int) -> np.ndarray:
        """Ids start to end; only the blocks that hold them are unpacked."""
        if start >= end:
            return np.zeros(0, np.uint32)
        first, last = start // self.block, (end - 1) // self.block
        begin = int(self.starts[first])
        stop = int(self.starts[last + 1]) if last + 1 < len(self.starts) else len(self.data)
        base = first * self.block
        return unpack(self.data[begin:stop], self.bits, end - base)[start - base :]

    def document(self, n: int) -> np.ndarray:
        return self.read(int(self.ends[n - 1]) if n else 0, int(self.ends[n]))


class Words:
    """Ids by a byte-level BPE tokenizer of the tokenizers library, each word encoded once and remembered.

    Texts hold no added tokens (see Texts), or they are ordinary text. The pattern cuts text as the byte-level
    pre-tokenizer does. As versions of Unicode may differ about letters, texts with characters
    beyond the Latin blocks go through the whole tokenizer instead.
    """

    def __init__(self, path: str, pattern: str, memory: int = MEMORY // 4, special: bool = True):
        """special: added tokens in a text get their own ids, as the library does by default."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = not special
        model = Tokenizer.from_file(path).model
        model._resize_cache(0)  # new words only: its own memory of them would cost more than it saves
        self.bpe = model.tokenize
        letters = ByteLevel.alphabet()
        plain = [b for b in range(256) if chr(b) in letters]
        others = [b for b in range(256) if chr(b) not in letters]
        self.letter = {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(others)}
        self.number = {n: n.to_bytes(4, "little") for n in self.whole.get_vocab().values()}
        self.words = regex.compile(pattern).findall
        self.known = Memory(memory)

    def __call__(self, texts: Sequence[str]) -> list[bytes]:
        out = []
        young, old = self.known.young, self.known.old
        fresh: dict[str, bytes] = {}

        def made(word: str) -> bytes:
            ids = old.get(word)
            if ids is None:
                letters = word.encode().decode("latin-1").translate(self.letter)
                ids = b"".join([self.number[t.id] for t in self.bpe(letters)])
            young[word] = fresh[word] = ids
            return ids

        for text in texts:
            if not text.isascii() and max(text) > "\u024f":
                out.append(np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes())
            elif text[1:].isalpha() and text[0] == " ":  # a word as it is
                out.append(young.get(text) or made(text))
            else:
                out.append(b"".join([young.get(word) or made(word) for word in self.words(text)]))
        self.known.keep(fresh)
        return out


class Texts(Pieces):
    """Texts by their pieces; those with the content of an added token go whole through the library, as it does by default."""

    def __init__(self, words: Words, memory: int):
        super().__init__(words, memory)
        self.whole = words.whole
        self.added = [token.content for token in self.whole.get_added_tokens_decoder().values()]

    def _has_added(self, text: str) -> bool:
        return any(token in text for token in self.added)

    def _by_library(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> Iterator[bytes]:
        return iter([self._by_library(text)]) if self._has_added(text) else super().encode(text)

    def encode_all(self, texts: Sequence[str]) -> list[bytes]:
        whole = {n: self._by_library(text) for n, text in enumerate(texts) if self._has_added(text)}
        if not whole:
            return super().encode_all(texts)
        rest = iter(super().encode_all([text for n, text in enumerate(texts) if n not in whole]))
        return [whole[n] if n in whole else next(rest) for n in range(len(texts))]


    def encode_column(self, texts: pa.Array, aside: pa.Array | None = None) -> list[np.ndarray]:
        for token in self.added:
            found = pc.fill_null(pc.match_substring(texts, token), False)
            aside = found if aside is None else pc.or_(aside, found)
        return super().encode_column(texts, aside)


_loaded: dict[str, Texts] = {}


def tokenizer(path: str, pattern: str) -> Texts:
    """The encoder of a tokenizer file, once in each worker."""
    if path not in _loaded:
        _loaded[path] = Texts(Words(path, pattern), MEMORY)
    return _loaded[path]


def vocabulary_size(path: str) -> int:
    return Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True)


def parts_of(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about PART_BYTES of one column, a row at least."""
    part = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy().astype(np.int64)) // PART_BYTES
    begins = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for begin, end in zip(begins, begins[1:]):
        yield batch.slice(begin, end - begin)


def write_tokens(docs: DataFrame, path: str, pattern: str, target: str, end_id: int) -> None:
    """Encodes whole texts, ends each with end_id, and writes shards under target.

    Texts are dealt by ranges of doc_id and sorted; null doc_ids come first, rows of equal doc_id
    in order of a hash of the text. Null and empty texts have the end id only. Other columns are
    not read.
    """
    bits = bits_for(max(vocabulary_size(path), end_id + 1))
    named = docs.select(*row_key(docs), "text")
    ordered = named.repartitionByRange("doc_id", "text_key").sortWithinPartitions("doc_id", "text_key")
    kind = docs.select("doc_id").schema[0].dataType.simpleString()
    end = np.array([end_id], "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_column = tokenizer(path, pattern).encode_column
        part, first, held, ids, kind_of = TaskContext.get().partitionId(), 0, 0, [], None
        documents: list[np.ndarray] = []

        def shard() -> pa.RecordBatch:
            row = [[part], [first], [held], [pa.array(ids, kind_of)], [write_shard(documents, bits)]]
            types = [pa.int32(), pa.int64(), pa.int64(), pa.list_(kind_of), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types)], ["part", "first_id", "n_ids", "doc_ids", "data"])

        for batch in batches:
            kind_of = batch.column(0).type
            for some in parts_of(batch, 2):
                for name, data in zip(some.column(0).to_pylist(), encode_column(some.column(2))):
                    found = np.append(data, end)
                    documents.append(found)
                    ids.append(name)
                    held += len(found)
                    if held >= SHARD_IDS:
                        yield shard()
                        first, held, ids, documents = first + held, 0, [], []
        if documents:
            yield shard()

    schema = f"part int, first_id long, n_ids long, doc_ids array<{kind}>, data binary"
    ordered.select("doc_id", "text_key", "text").mapInArrow(run, schema).write.option("compression", "none").parquet(target)


def read_tokens(spark: SparkSession, target: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32, from the shards under target."""
    shards = spark.read.parquet(target)
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("n_ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # a row for each partition that wrote, so its size is bounded by their number
    starts = parts.select("part", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("part_start"))
    placed = shards.join(F.broadcast(starts), "part").select((F.col("part_start") + F.col("first_id")).alias("start"), "doc_ids", "data")
    kind = shards.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, ids, data in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                shard = Shard(data.as_buffer())
                ends = shard.ends.astype(np.int64)
                counts = np.diff(ends, prepend=0)
                whole = shard.read(0, shard.ids).astype("<u4", copy=False)
                checks = [zlib.crc32(whole[a:b]) for a, b in zip((ends - counts).tolist(), ends.tolist())]
                arrays = [ids.values, pa.array(start + ends - counts), pa.array(counts), pa.array(checks, pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "n_tokens", "ids_crc32"])

    return placed.mapInArrow(run, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, path: str, pattern: str, end_id: int) -> DataFrame:
    """Writes the token files of docs to the shared folder and reads them back."""
    scratch = Scratch(docs.sparkSession, "tokens")
    write_tokens(docs, path, pattern, scratch.path("shards"), end_id)
    return read_tokens(docs.sparkSession, scratch.path("shards"))
