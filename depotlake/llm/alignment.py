"""Which tokens of two tokenizers stand for the same bytes, over a whole corpus.

Texts are shuffled by the full text, so each distinct text is encoded and aligned once; the copies
it has are the weight of its links. Both tokenizers cut " " + text. Where tokens of both end at the
same byte, a group of tokens ends, and the two tokens that end it are linked.

A task gathers the links of some texts as a block, one row: the block's distinct pairs of ids once,
and for each link the place of its pair among them. So counting and scoring shuffle a pair once for
each block that has it, not for each link or text, and a pair that is in every text (of two tokens
" the") is one row of many in each block.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotlake.llm.packing import Words
from depotlake.llm.pieces import CHUNK, Memory, Pieces, cuts
from depotlake.llm.tables import Scratch, text_of

#: A block ends with the text that reaches this many links.
BLOCK_LINKS = 1 << 17
#: Bytes that a worker remembers of aligned pieces, and half as many of words of tokenizer A.
MEMORY = 128 << 20
#: In a stream of codes: the token's id, whether it is of tokenizer B, whether it ends its group.
_ID, _B, _LAST = 2, 2, 1
#: Instead of codes, where the tokens of a piece do not give its bytes.
UNLIKE = 0xFFFFFFFF
_HALF = 32


class Aligner:
    """Encodes strings that begin with a space by both tokenizers, into one stream of codes."""

    def __init__(self, path_a: str, path_b: str, pattern: str, memory: int = MEMORY):
        self.a = Words(path_a, pattern, memory // 2, special=False)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        bytes_of = {letter: byte for byte, letter in self.a.letter.items()}
        whole = self.a.whole
        names = [whole.id_to_token(i) or "" for i in range(whole.get_vocab_size(with_added_tokens=True))]
        self.bytes_a = [bytes(map(bytes_of.get, name)) if all(c in bytes_of for c in name) else name.encode() for name in names]
        self.bytes_b = [_piece_bytes(self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())]
        self.sizes = np.array([*map(len, self.bytes_a)]), np.array([*map(len, self.bytes_b)])
        if min(map(len, self.bytes_b)) == 0:
            raise ValueError("a token without bytes cannot be aligned")
        #: Tokens never hold a space after another character, so tokens never cross a single space.
        self.by_pieces = not any(re.search("[^▁]▁", self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))

    def __call__(self, texts: Sequence[str]) -> list[bytes]:
        ids_a = [np.frombuffer(found, "<u4") for found in self.a(texts)]
        ids_b = [np.array(found, np.uint32) for found in self.b.encode([t[1:] for t in texts], num_threads=1)]
        same = [
            b"".join(map(self.bytes_a.__getitem__, a.tolist())) == data == b"".join(map(self.bytes_b.__getitem__, b.tolist()))
            for a, b, data in zip(ids_a, ids_b, (t.encode() for t in texts))
        ]
        made = iter(self._codes([a for a, fits in zip(ids_a, same) if fits], [b for b, fits in zip(ids_b, same) if fits]))
        unlike = np.array([UNLIKE], "<u4").tobytes()
        return [next(made) if fits else unlike for fits in same]

    def _codes(self, ids_a: list[np.ndarray], ids_b: list[np.ndarray]) -> list[bytes]:
        """The groups of each text in order; in a group, the tokens of A come before those of B."""
        if not ids_a:
            return []
        a, b = np.concatenate(ids_a), np.concatenate(ids_b)
        ends_a, ends_b = np.cumsum(self.sizes[0][a]), np.cumsum(self.sizes[1][b])  # in all texts, one after another
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)  # texts end there, too
        group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        out = np.empty(len(a) + len(b), "<u4")
        out[np.arange(len(a)) + np.searchsorted(group_b, group_a)] = a << _ID | (common[group_a] == ends_a)
        out[np.arange(len(b)) + np.searchsorted(group_a, group_b, "right")] = b << _ID | _B | (common[group_b] == ends_b)
        ends = np.cumsum([len(x) + len(y) for x, y in zip(ids_a, ids_b)]).tolist()
        return [out[start:end].tobytes() for start, end in zip([0, *ends], ends)]


def _piece_bytes(piece: str) -> bytes:
    """A SentencePiece token's bytes; U+2581 is a space, <0xHH> the byte HH."""
    byte = re.fullmatch("<0x([0-9A-F]{2})>", piece)
    return bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()


class Shown(dict):
    """Decimal ids of codes, each with what follows it: a comma, or | or ; at the end of its part of a group."""

    def __missing__(self, code: int) -> str:
        end = (";" if code & _B else "|") if code & _LAST else ","
        shown = self[code] = f"{code >> _ID}{end}"
        return shown


class AlignedText:
    """What the codes of a text, given part by part, say about it."""

    def __init__(self, parts: Iterable[bytes], shown: Shown):
        self.n_a = self.n_b = 0
        digest, links, held = hashlib.sha256(), [], ""
        for part in parts:
            codes = np.frombuffer(part, "<u4")
            if (codes == UNLIKE).any():
                self.n_a = self.n_b = 0
                links, held = [], ""
                break
            of_b = (codes & _B) > 0
            count_b = int(np.count_nonzero(of_b))
            self.n_b += count_b
            self.n_a += len(codes) - count_b
            ends = codes[(codes & _LAST) > 0] >> _ID  # of A and of B in turn
            links.append(ends[::2].astype(np.int64) << _HALF | ends[1::2])
            digest.update(held.encode())
            held = "".join(map(shown.__getitem__, codes.tolist()))
        self.links = np.concatenate(links) if links else np.zeros(0, np.int64)
        digest.update(held[:-1].encode())  # without the last semicolon
        self.groups_sha256 = digest.hexdigest() if len(self.links) else ""


class Texts(Pieces):
    """Aligned texts, by their pieces between single spaces, or at once where tokens may cross these."""

    def __init__(self, aligner: Aligner, memory: int = MEMORY):
        super().__init__(aligner, memory)
        self.by_pieces = aligner.by_pieces
        self.shown = Shown()

    def _parts(self, text: str) -> Iterator[tuple[bool, str]]:
        """The text after a space, cut at single spaces, as Pieces takes it."""
        if text[0].isspace():
            yield from cuts(" " + text, CHUNK)
        else:  # as if a piece stood before the space
            for n, (after_space, part) in enumerate(cuts(text, CHUNK)):
                yield after_space or not n, part

    def aligned(self, texts: Sequence[str]) -> list[AlignedText]:
        """Each text aligned; what is new in the short ones is encoded at once."""
        if not self.by_pieces:
            return [AlignedText(self.encode_many([" " + text]) if text else [], self.shown) for text in texts]
        short = [n for n, text in enumerate(texts) if 0 < len(text) < CHUNK]
        at_once = dict(zip(short, self._encoded([part for n in short for part in self._parts(texts[n])])))
        out = []
        for n, text in enumerate(texts):
            parts = [at_once[n]] if n in at_once else (self._encoded([p])[0] for p in self._parts(text)) if text else ()
            out.append(AlignedText(parts, self.shown))
        return out


_loaded: dict[tuple[str, str, str], Texts] = {}


def loaded(path_a: str, path_b: str, pattern: str) -> Texts:
    """The encoders of two tokenizers, once in each worker."""
    key = path_a, path_b, pattern
    if key not in _loaded:
        _loaded[key] = Texts(Aligner(*key))
    return _loaded[key]


BLOCK_FIELDS = pa.schema([
    ("block", pa.int64()),
    ("pairs", pa.list_(pa.int64())),  # id of A in the upper half, of B in the lower; ascending
    ("counts", pa.list_(pa.int64())),  # links of each pair in the block, copies of texts counted
    ("digests", pa.list_(pa.binary())),  # of the texts
    ("n_a", pa.list_(pa.int64())),
    ("n_b", pa.list_(pa.int64())),
    ("n_links", pa.list_(pa.int64())),
    ("groups", pa.list_(pa.string())),  # sha256
    ("places", pa.binary()),  # of each link's pair among pairs, 32 bits each, text after text
])
BLOCK_SCHEMA = (
    "block long, pairs array<long>, counts array<long>, digests array<binary>, n_a array<long>, n_b array<long>,"
    " n_links array<long>, groups array<string>, places binary"
)


def _block(number: int, digests: list[bytes], copies: list[int], texts: list[AlignedText]) -> pa.RecordBatch:
    links = np.concatenate([t.links for t in texts])
    sizes = [len(t.links) for t in texts]
    pairs, places = np.unique(links, return_inverse=True)
    counts = np.zeros(len(pairs), np.int64)
    np.add.at(counts, places, np.repeat(np.array(copies, np.int64), sizes))
    n_a, n_b, groups = [t.n_a for t in texts], [t.n_b for t in texts], [t.groups_sha256 for t in texts]
    row = [number, pairs, counts, digests, n_a, n_b, sizes, groups, places.astype("<u4").tobytes()]
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, BLOCK_FIELDS)], schema=BLOCK_FIELDS)


def aligned_blocks(docs: DataFrame, path_a: str, path_b: str, pattern: str) -> DataFrame:
    """A row for each block of distinct texts (see BLOCK_FIELDS). Write it before reading it more than once."""
    text = text_of(docs).alias("content")
    distinct = docs.select(text).where("content <> ''").groupBy("content").agg(F.count(F.lit(1)).alias("copies"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = loaded(path_a, path_b, pattern).aligned
        number, held = TaskContext.get().partitionId() << _HALF, 0
        digests: list[bytes] = []
        copies: list[int] = []
        texts: list[AlignedText] = []
        for batch in batches:
            for start in range(0, batch.num_rows, 128):
                part = batch.slice(start, 128)
                for digest, times, found in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), align(part.column(2).to_pylist())):
                    digests.append(digest)
                    copies.append(times)
                    texts.append(found)
                    held += len(found.links)
                    if held >= BLOCK_LINKS:
                        yield _block(number, digests, copies, texts)
                        number, held, digests, copies, texts = number + 1, 0, [], [], []
        if texts:
            yield _block(number, digests, copies, texts)

    digest = F.unhex(F.sha2("content", 256)).alias("digest")
    return distinct.select(digest, "copies", "content").mapInArrow(run, BLOCK_SCHEMA)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """a_id, b_id, links: how many links of the corpus join two ids; a row for each pair that occurs."""
    pairs = blocks.select(F.explode(F.arrays_zip("pairs", "counts")).alias("pair"))
    counted = pairs.groupBy("pair.pairs").agg(F.sum("pair.counts").alias("links"))
    a_id = F.shiftright("pairs", _HALF).cast("int")
    return counted.select(a_id.alias("a_id"), F.col("pairs").bitwiseAND((1 << _HALF) - 1).cast("int").alias("b_id"), "links")


MEASURES = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums over each text's links from the scores of its block's pairs, which stand in the pairs' order."""
    for batch in batches:
        for n in range(batch.num_rows):
            row = {name: batch.column(name)[n] for name in batch.schema.names}
            sizes = row["n_links"].values.to_numpy()
            places = np.frombuffer(row["places"].as_buffer(), "<u4")
            links = row["scores"].values.field("links").to_numpy()[places]
            best = row["scores"].values.field("best").to_numpy(zero_copy_only=False)[places]
            ends = np.cumsum(sizes)
            sums = [np.concatenate([[0], np.cumsum(x, dtype=np.int64)]) for x in (best, links)]
            n_best, count_sum = (pa.array(x[ends] - x[ends - sizes]) for x in sums)
            columns = [row["digests"].values, row["n_a"].values, row["n_b"].values, row["n_links"].values, row["n_links"].values]
            columns += [n_best, count_sum, row["groups"].values]
            names = ["digest", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
            yield pa.RecordBatch.from_arrays(columns, names)


def align_documents(docs: DataFrame, path_a: str, path_b: str, pattern: str, scratch: Scratch | None = None) -> DataFrame:
    """doc_id and the columns of MEASURES for each row.

    n_a, n_b: tokens; n_groups: runs of bytes at whose end tokens of both end; n_links: pairs of
    tokens that end together; n_best: links whose pair of ids is linked as often in the corpus as any
    pair of its B id; count_sum: sum over links of the links of their pair in the corpus; groups_sha256:
    of the ids, group by group (a1,a2|b1;a3|b2). Texts that are null or empty, or whose tokens' bytes
    differ from a space and the text, have zeros and an empty string. Equal texts have equal rows;
    repeated rows and null doc_ids stay, each copy counts. Other columns are not read. An empty table
    gives an empty result.
    """
    scratch = scratch or Scratch(docs.sparkSession, "alignment")
    blocks = scratch.put(aligned_blocks(docs, path_a, path_b, pattern), "blocks")
    counted = scratch.put(pair_counts(blocks), "pair-counts")
    # a row for each id of B that occurs, so at most its vocabulary
    most = F.broadcast(counted.groupBy("b_id").agg(F.max("links").alias("most")))
    pair = F.shiftleft(F.col("a_id").cast("long"), _HALF).bitwiseOR(F.col("b_id").cast("long"))
    scored = counted.join(most, "b_id").select(pair.alias("pair"), "links", (F.col("links") == F.col("most")).alias("best"))
    wanted = blocks.select("block", F.posexplode("pairs").alias("place", "pair"))
    scores = wanted.join(scored, "pair").groupBy("block").agg(F.sort_array(F.collect_list(F.struct("place", "links", "best"))).alias("scores"))
    by_text = blocks.drop("pairs", "counts").join(scores, "block", "left")
    no_scores = F.array().cast("array<struct<place:int,links:bigint,best:boolean>>")
    measured = by_text.withColumn("scores", F.coalesce("scores", no_scores)).mapInArrow(_measured, f"digest binary, {MEASURES}")
    named = docs.select("doc_id", F.unhex(F.sha2(text_of(docs), 256)).alias("digest"))
    names = [field.split() for field in MEASURES.split(", ")]
    shown = [F.coalesce(F.col(name), F.lit("" if kind == "string" else 0).cast(kind)).alias(name) for name, kind in names]
    return named.join(scratch.put(measured, "texts"), "digest", "left").select("doc_id", *shown)
