"""Token ids, their files, and decoding, against the tokenizer libraries."""

import hashlib
import random
import sys
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from corpora import edge_docs, edge_rows, empty_docs
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from depotlake.llm import bpe, packing, pieces

PATTERN = public_tokenizers.PATTERN
WHOLE = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SIGNS = " \n\t\x0b\x1c\x85  abcdé'sñ!?.,1290中文🙂ABC  's't<|endoftext|>"


@pytest.fixture(scope="module")
def library():
    ranks = bpe.read_ranks(RANKS)
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def tokenizer():
    whole = Tokenizer.from_file(WHOLE)
    whole.encode_special_tokens = True
    return whole


def odd_texts(count, seed=1):
    pick = random.Random(seed)
    return ["".join(pick.choice(SIGNS) for _ in range(pick.randrange(40))) for _ in range(count)]


def ids(data):
    return np.frombuffer(data, "<u4").tolist()


def test_bpe_is_the_library(library):
    own = bpe.loaded(RANKS, PATTERN)[1]
    for text in [*odd_texts(4000), "aaaa" * 500, "ab" * 700, "x" * 5000, *[t or "" for _, t, *_ in edge_rows()]]:
        assert ids(b"".join(own.encode(text))) == library.encode_ordinary(text)


def test_small_vocabulary_against_the_merges():
    """Tokens that no merge reaches, ties, and long overlaps; all strings of a small alphabet."""
    tokens = [b"a", b"b", b"c", b"ab", b"bc", b"abc", b"aa", b"aab", b"ca", b"cab", b"bcab"]
    own = bpe.Bpe({t: n for n, t in enumerate(tokens)}, r"[a-c]+")
    texts = [""]
    for _ in range(8):
        texts = [t + c for t in texts for c in "abc"]
        for text in texts:
            data = text.encode()
            wanted = [own.ranks[data]] if data in own.ranks else own.merged(data)
            assert own.word(data) == wanted, text


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80))
def test_any_text_goes_there_and_back(text):
    own, encoder = bpe.loaded(RANKS, PATTERN)
    text = text.encode("utf-8", "ignore").decode()
    assert own.decode(ids(b"".join(encoder.encode(text)))) == text.encode()


def test_words_are_the_library(tokenizer):
    own = packing.tokenizer(WHOLE, PATTERN)
    texts = [*odd_texts(4000, 2), *[t or "" for _, t, *_ in edge_rows()]]
    whole = tokenizer.encode_batch(texts, add_special_tokens=False)
    assert [ids(i) for i in own.encode_all(texts)] == [w.ids for w in whole]


def test_long_texts_are_cut_at_single_spaces(monkeypatch, tokenizer):
    monkeypatch.setattr(pieces, "CHUNK", 17)
    own = pieces.Pieces(packing.Words(WHOLE, PATTERN), memory=50_000)
    texts = odd_texts(1500, 3)
    whole = tokenizer.encode_batch(texts, add_special_tokens=False)
    assert [ids(i) for i in own.encode_all(texts)] == [w.ids for w in whole]
    own.encode_all(["some more words"])
    assert 0 < len(own.memory.young) + len(own.memory.old) <= 250


def test_memory_is_bounded_in_bytes():
    """Unspaced texts, each a piece of its own, and many short ones."""
    own = bpe.Bpe(bpe.read_ranks(RANKS), PATTERN, memory=1 << 20)
    encoder = pieces.Pieces(own.encode_many, memory=1 << 20)
    pick = random.Random(5)
    for n in range(300):
        encoder.encode_all(["".join(pick.choice("天地玄黄宇宙洪荒") for _ in range(2000)), " ".join(f"{n}x{k}" for k in range(300))])
        for memory in (encoder.memory, own.encoded):
            held = [sum(map(sys.getsizeof, [*part, *part.values()])) + sys.getsizeof(part) for part in (memory.young, memory.old)]
            assert sum(held) <= 1 << 20 and memory.held <= memory.limit // 2
            assert max(map(len, [*memory.young, *memory.old]), default=0) <= pieces.LONGEST


def test_what_is_used_stays_remembered():
    """Words that are used again and again are encoded once, others may be forgotten."""
    asked = []
    own = pieces.Pieces(lambda texts: [asked.append(t) or b"1234" for t in texts], memory=20 * 1024)
    for n in range(2000):
        own.encode_all([f"x often rare{n}"])
    assert asked.count(" often") == 1 and " rare1" in asked
    assert "rare1" not in own.memory.young and "rare1999" in own.memory.young


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 32), st.integers(0, 3 * packing.BLOCK), st.integers(0, 2**31))
def test_packing_goes_there_and_back(bits, count, seed):
    pick = np.random.default_rng(seed)
    values = pick.integers(0, 1 << bits, count, dtype=np.uint64).astype(np.uint32)
    documents = np.split(values, np.sort(pick.integers(0, count + 1, 3)))
    shard = packing.Shard(packing.write_shard(documents, bits))
    assert (shard.bits, shard.ids) == (bits, count)
    assert all((shard.document(n) == d).all() for n, d in enumerate(documents))
    start, end = sorted(pick.integers(0, count + 1, 2).tolist())
    assert (shard.read(start, end) == values[start:end]).all()


def test_packing_needs_enough_bits():
    assert [packing.bits_for(n) for n in (1, 2, 3, 256, 257, 50257, 65536, 65537)] == [1, 1, 2, 8, 9, 16, 16, 17]
    with pytest.raises(ValueError):
        packing.pack(np.array([8], np.uint32), 3)
    with pytest.raises(ValueError):
        packing.Shard(b"x" * 100)


def test_token_files(spark, tokenizer, tmp_path):
    """In ascending order, nulls first; starts count all ids before."""
    found = packing.token_files(edge_docs(spark), WHOLE, PATTERN, 2).orderBy("start").collect()
    wanted = {}
    for doc_id, text, *_ in edge_rows():
        values = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        wanted.setdefault(doc_id, []).append((len(values), zlib.crc32(np.array(values, "<u4").tobytes())))
    names = [r.doc_id for r in found]
    assert names == sorted(names, key=lambda i: (i is not None, i or 0)) and len(names) == len(edge_rows())
    start = 0
    for r in found:
        assert r.start == start
        wanted[r.doc_id].remove((r.n_tokens, r.ids_crc32))
        start += r.n_tokens
    assert packing.token_files(empty_docs(spark), WHOLE, PATTERN, 2).count() == 0


def test_token_digests(spark, library):
    found = {}
    for r in bpe.token_digests(edge_docs(spark), RANKS, PATTERN).collect():
        found.setdefault(r.doc_id, []).append((r.n_tokens, r.ids_sha256, r.decoded_sha256))
    wanted = {}
    for doc_id, text, *_ in edge_rows():
        values = library.encode_ordinary(text or "")
        shown = hashlib.sha256(",".join(map(str, values)).encode()).hexdigest()
        wanted.setdefault(doc_id, []).append((len(values), shown, hashlib.sha256((text or "").encode()).hexdigest()))
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in wanted.items()}
    assert bpe.token_digests(empty_docs(spark), RANKS, PATTERN).count() == 0


def test_ids_as_columns(spark):
    docs = edge_docs(spark).where("doc_id > 1")
    encoded = bpe.encode_documents(docs, RANKS, PATTERN)
    decoded = {r.doc_id: bytes(r.data) for r in bpe.decode_documents(encoded, RANKS, PATTERN).collect()}
    assert decoded == {r.doc_id: (r.text or "").encode() for r in docs.collect()}


def test_added_tokens_are_the_library():
    """Without any flag: the content of an added token has the token's id."""
    own, plain = packing.tokenizer(WHOLE, PATTERN), Tokenizer.from_file(WHOLE)
    texts = ["foo <|endoftext|> bar", "no token", "<|endoftext|>", "a<|endoftext|> <|endoftext|>  b 中文", "word " * 60_000 + "<|endoftext|> x", ""]
    wanted = [plain.encode(text, add_special_tokens=False).ids for text in texts]
    assert wanted[0].count(50256) == 1
    assert [ids(i) for i in own.encode_all(texts)] == wanted
    assert [ids(b"".join(own.encode(text))) for text in texts] == wanted


def test_columns_are_the_library(tokenizer):
    """Texts with white space next to spaces, long ones and nulls among others, again and again."""
    own = pieces.Pieces(packing.Words(WHOLE, PATTERN, special=False), memory=100_000)
    texts = [*odd_texts(3000, 7), None, "", " ", "a", " a", "a ", "a  b", "a\n b", "a \nb", "x é" * (pieces.CHUNK // 2)]
    wanted = [e.ids for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    for kind in (pa.string(), pa.large_string()):
        column = pa.array(["left out", *texts], kind).slice(1)
        assert [i.tolist() for i in own.encode_column(column)] == wanted
    assert own.encode_column(pa.array([], pa.string())) == []
    assert [i.tolist() for i in own.encode_column(pa.array([None], pa.string()))] == [[]]


def test_columns_with_added_tokens_are_the_library():
    own, plain = packing.tokenizer(WHOLE, PATTERN), Tokenizer.from_file(WHOLE)
    texts = ["foo <|endoftext|> bar", "no token", None, "a<|endoftext|> <|endoftext|>  b 中文"]
    wanted = [plain.encode(text or "", add_special_tokens=False).ids for text in texts]
    assert [i.tolist() for i in own.encode_column(pa.array(texts))] == wanted


def test_a_piece_of_a_column_is_looked_up_once():
    asked = []

    class Asked(dict):
        def get(self, key, default=None):
            asked.append(key)
            return super().get(key, default)

    own = pieces.Pieces(lambda texts: [b"1234" for _ in texts])
    own.memory.young = Asked()
    assert [len(i) for i in own.encode_column(pa.array(["a b c b", "c b b", "b"]))] == [4, 3, 1]
    assert sorted(asked) == ["b", "c"]


def test_batches_are_cut_by_bytes(monkeypatch):
    monkeypatch.setattr(packing, "PART_BYTES", 10)
    texts = ["abc", None, "x" * 35, "", "abcdef", "abcdef", "é" * 5]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    parts = [part.column(0).to_pylist() for part in packing.parts_of(batch, 0)]
    assert [t for part in parts for t in part] == texts and len(parts) > 3
    assert all(sum(len((t or "").encode()) for t in part[1:]) <= 20 for part in parts)
