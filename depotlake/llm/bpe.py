"""Byte-level BPE by rank files: exact merges in linear time, and decoding.

Bytes are mapped to Latin-1 characters, so that one Aho-Corasick automaton holds all tokens. Of a
string, the encoder takes the longest token at each place and goes back to a shorter one where it
can't stand after the token before it. A sequence is what the merges give if and only if each two
neighbours are what the merges make of their joined bytes; that is remembered for each pair.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator, Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from depotlake.llm.pieces import MEMORY, Memory, Pieces
from depotlake.llm.words import release

#: What a remembered pair of tokens takes.
_PAIR_BYTES = 128
_RANK_BITS = 32


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and their ranks, from lines of a token in base 64 and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Bpe:
    """Encoder and decoder for one rank file and the pattern that cuts text into words."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, memory: int = MEMORY // 2):
        """memory: bytes for words and, half of it, for pairs."""
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.shown = {rank: str(rank) for rank in ranks.values()}
        self.words = regex.compile(pattern)
        self.size = {rank: len(token) for rank, token in self.tokens.items()}
        self.most_pairs = memory // 2 // _PAIR_BYTES
        self.pairs: dict[int, bool] = {}  # by the two ranks in one number
        self.encoded = Memory(memory // 2)
        self.shorter: dict[int, int] = {}
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            if self.merged(token) == [rank]:  # others are found as whole words only
                self.automaton.add_word(token.decode("latin-1"), (rank, len(token)))
        self.automaton.make_automaton()

    def merged(self, data: bytes) -> list[int]:
        """The definition: while two neighbours join to a token, join those of the lowest rank, leftmost first."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            ranked = [self.ranks.get(a + b, -1) for a, b in zip(parts, parts[1:])]
            best = min((r for r in ranked if r >= 0), default=-1)
            if best < 0:
                break
            at = ranked.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def compatible(self, left: int, right: int) -> bool:
        """Whether two tokens can stand side by side."""
        pair = left << _RANK_BITS | right
        known = self.pairs.get(pair)
        if known is None:
            if len(self.pairs) >= self.most_pairs:
                self.pairs.clear()
            known = self.pairs[pair] = self.merged(self.tokens[left] + self.tokens[right]) == [left, right]
        return known

    def prefix(self, token: int) -> int:
        """The longest token that the token's bytes begin with, itself left out; -1 if there is none."""
        found = self.shorter.get(token)
        if found is None:
            text = self.tokens[token].decode("latin-1")
            begins = (text[:n] for n in range(len(text) - 1, 0, -1))
            found = self.shorter[token] = next((self.automaton.get(t)[0] for t in begins if t in self.automaton), -1)
        return found

    def word(self, data: bytes) -> list[int]:
        """The ids of one word."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        count, size, known = len(data), self.size, self.pairs.get
        longest = [-1] * count
        for end, (token, length) in self.automaton.iter(data.decode("latin-1")):
            longest[end + 1 - length] = token  # longer tokens at a place end later
        dead: set[int] = set()  # places that no valid sequence passes
        ids: list[int] = []
        last, place, token = -1, 0, longest[0]
        while place < count:
            while token >= 0:
                end = place + size[token]
                if end not in dead:
                    if last < 0:
                        break
                    fits = known(last << _RANK_BITS | token)
                    if fits or fits is None and self.compatible(last, token):
                        break
                token = self.prefix(token)
            if token >= 0:
                ids.append(token)
                last, place = token, end
                token = longest[place] if place < count else -1
            else:
                dead.add(place)
                token = self.prefix(ids[-1])
                place -= size[ids.pop()]
                last = ids[-1] if ids else -1
        return ids

    def encode_many(self, texts: Sequence[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        out = []
        young, old = self.encoded.young, self.encoded.old
        fresh: dict[str, bytes] = {}
        for text in texts:
            parts = []
            for word in self.words.findall(text):
                ids = young.get(word)
                if ids is None and (ids := fresh.get(word)) is None:
                    ids = old.get(word)
                    fresh[word] = ids = np.array(self.word(word.encode()), "<u4").tobytes() if ids is None else ids
                parts.append(ids)
            out.append(b"".join(parts))
        self.encoded.put(fresh)
        return out

    def decode(self, ids: Sequence[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


_loaded: dict[tuple[str, str, int], tuple[Bpe, Pieces]] = {}


def loaded(path: str, pattern: str, memory: int = MEMORY) -> tuple[Bpe, Pieces]:
    """The encoder of a rank file, once in each worker."""
    if (path, pattern, memory) not in _loaded:
        bpe = Bpe(read_ranks(path), pattern, memory // 2)
        _loaded[path, pattern, memory] = bpe, Pieces(bpe.encode_many, memory // 2)
    return _loaded[path, pattern, memory]


def _rows(docs: DataFrame, column: str, make: Callable[[str], tuple], schema: str, fields: pa.Schema, size: int = 256) -> DataFrame:
    """doc_id and what make gives for the text of each row, in batches of a few rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, size):
                part = batch.slice(start, size)
                made = [make(value) for value in part.column(1).to_pylist()]
                columns = list(zip(*made)) if made else [[] for _ in fields]
                arrays = [pa.array(values, field.type) for values, field in zip(columns, fields)]
                yield pa.RecordBatch.from_arrays([part.column(0), *arrays], ["doc_id", *fields.names])
            batch = part = None
        release()

    kind = docs.select("doc_id").schema[0].dataType.simpleString()
    return docs.select("doc_id", column).mapInArrow(run, f"doc_id {kind}, {schema}")


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids: the ids of each whole text. Null and empty texts have no ids."""

    def make(text: str | None) -> tuple:
        ids = np.frombuffer(b"".join(loaded(path, pattern)[1].encode(text or "")), "<u4")
        return len(ids), ids

    fields = pa.schema([("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32()))])
    return _rows(docs, "text", make, "n_tokens long, ids array<int>", fields, 16)


def decode_documents(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and data, the bytes that the ids stand for."""

    def make(ids: list[int] | None) -> tuple:
        return (loaded(path, pattern)[0].decode(ids or []),)

    return _rows(encoded, "ids", make, "data binary", pa.schema([("data", pa.binary())]), 16)


def token_digests(docs: DataFrame, path: str, pattern: str, memory: int = MEMORY) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids, joined by commas), decoded_sha256.

    One row for each row, also where doc_ids repeat or are null; null texts count as empty. Long
    texts are encoded, decoded and hashed part by part. Other columns are not read. memory is
    how many bytes a worker remembers; fewer take longer. An empty table gives an empty result.
    """

    def make(text: str | None) -> tuple:
        bpe, pieces = loaded(path, pattern, memory)
        count, ids_hash, data_hash = 0, hashlib.sha256(), hashlib.sha256()
        for part in pieces.encode(text or ""):
            ids = np.frombuffer(part, "<u4").tolist()
            if ids:
                ids_hash.update((("," if count else "") + ",".join(map(bpe.shown.__getitem__, ids))).encode())
                data_hash.update(bpe.decode(ids))
                count += len(ids)
        return count, ids_hash.hexdigest(), data_hash.hexdigest()

    fields = pa.schema([("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
    return _rows(docs, "text", make, "n_tokens long, ids_sha256 string, decoded_sha256 string", fields)
