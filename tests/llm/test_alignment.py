"""Aligned tokens against whole texts encoded by the libraries and plain loops."""

import functools
import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from corpora import edge_docs, edge_rows, empty_docs
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from depotlake.llm import alignment, pieces
from depotlake.llm.queries import QUERIES
from depotlake.llm.tables import Scratch

A, B = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
PATHS = A, B, public_tokenizers.PATTERN
ODD = [" ", "  ", "\n", "a", " a", "a ", "a  b", "\ta b\n c", "a▁b", "▁", "<0x41> <s> </s> <unk>", "<|endoftext|> x", "中文字 中 文", "\x00 \x1c\x85", "ﬁ Ａ é ¨", "🙂🙂 🙂", "don't  stop", "x" * 300]


def letters():
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


class Whole:
    """Both tokenizers over whole texts, links found by comparing all pairs of ends."""

    def __init__(self):
        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        self.letters = letters()

    def b_bytes(self, i):
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def groups(self, text):
        if not text:
            return []
        data = (" " + text).encode()
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        b = self.b.encode(text)
        bytes_a = [bytes(self.letters[c] for c in self.a.id_to_token(i)) for i in a]
        bytes_b = [self.b_bytes(i) for i in b]
        if b"".join(bytes_a) != data or b"".join(bytes_b) != data:
            return []
        out, ends_b, at, last_a = [], {}, 0, 0
        for n, part in enumerate(bytes_b):
            at += len(part)
            ends_b[at] = n
        at, last_b = 0, 0
        for n, part in enumerate(bytes_a):
            at += len(part)
            if at in ends_b:
                out.append((a[last_a : n + 1], b[last_b : ends_b[at] + 1]))
                last_a, last_b = n + 1, ends_b[at] + 1
        return out

    def measures(self, texts):
        """The columns of MEASURES for each text."""
        all_groups = [self.groups(t) for t in texts]
        counts = Counter((x[-1], y[-1]) for groups in all_groups for x, y in groups)
        most = {}
        for (_, b), n in counts.items():
            most[b] = max(most.get(b, 0), n)
        for groups in all_groups:
            links = [(x[-1], y[-1]) for x, y in groups]
            shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
            yield (
                sum(len(x) for x, _ in groups),
                sum(len(y) for _, y in groups),
                len(groups),
                len(links),
                sum(counts[p] == most[p[1]] for p in links),
                sum(counts[p] for p in links),
                hashlib.sha256(shown.encode()).hexdigest() if groups else "",
            )


@functools.cache
def shared():
    return Whole()


@pytest.fixture
def whole():
    return shared()


def check_texts(whole, texts):
    own = alignment.loaded(*PATHS).aligned(texts)
    for text, found in zip(texts, own):
        groups = whole.groups(text)
        shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        assert found.groups_sha256 == (hashlib.sha256(shown.encode()).hexdigest() if groups else ""), text
        assert found.links.tolist() == [x[-1] << 32 | y[-1] for x, y in groups]
        assert (found.n_a, found.n_b) == (sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups))


def test_odd_texts(whole):
    check_texts(whole, ["", *ODD, *[t or "" for _, t, *_ in edge_rows()]])
    pick = random.Random(2)
    signs = " \n\t\x0b\x1c\x85  abcdé'sñ!?.,1290中文🙂ABC  's't▁"
    check_texts(whole, ["".join(pick.choice(signs) for _ in range(pick.randrange(40))) for _ in range(3000)])


@settings(deadline=None, max_examples=150)
@given(st.text(max_size=60))
def test_any_text(text):
    check_texts(shared(), [text.encode("utf-8", "ignore").decode()])


def test_long_texts_part_by_part(monkeypatch, whole):
    monkeypatch.setattr(alignment, "CHUNK", 23)
    pick = random.Random(4)
    words = ["alpha", "naïve", "中文", "x\ny", "it's", "1234", ""]
    texts = [" ".join(pick.choice(words) for _ in range(pick.randrange(60))) for _ in range(300)]
    check_texts(whole, [*texts, "a " * 40 + "▁"])


def test_tokenizers_whose_tokens_cross_spaces(monkeypatch, whole):
    """Without the shortcut by pieces."""
    own = alignment.Texts(alignment.loaded(*PATHS).encode_many)
    own.by_pieces = False
    for text, found in zip(ODD, own.aligned(ODD)):
        assert len(found.links) == len(whole.groups(text))


@pytest.mark.parametrize("block_links", [1, 50, 1 << 17])
def test_rows_with_everything_in_them(spark, whole, monkeypatch, block_links):
    monkeypatch.setattr(alignment, "BLOCK_LINKS", block_links)  # tasks get it with their function's module
    rows = [(i, t) for i, t, *_ in edge_rows()] + [(50 + n, t) for n, t in enumerate(ODD)] + [(90 + n, ODD[6]) for n in range(5)]
    docs = edge_docs(spark).select("doc_id", "text", "links", "pair")
    more = spark.createDataFrame([(i, t, "l", "p") for i, t in rows[len(edge_rows()) :]], docs.schema)
    found = alignment.align_documents(docs.unionByName(more), *PATHS).collect()
    wanted = [(i, *m) for (i, _), m in zip(rows, whole.measures([t for _, t in rows]))]
    assert sorted(map(tuple, found), key=repr) == sorted(wanted, key=repr)


def test_pairs_of_the_corpus(spark, whole):
    texts = ["The cat sat.", "The cat sat.", "A cat's hat  was flat", None, "中文 cat"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    blocks = Scratch(spark, "test").put(alignment.aligned_blocks(docs, *PATHS), "blocks")
    counts = Counter((x[-1], y[-1]) for t in texts for x, y in whole.groups(t))
    assert {(r.a_id, r.b_id): r.links for r in alignment.pair_counts(blocks).collect()} == counts


def test_empty_tables(spark):
    assert alignment.align_documents(empty_docs(spark), *PATHS).collect() == []
    blank = spark.createDataFrame([(1, None), (2, ""), (None, "")], "doc_id long, text string")
    assert {tuple(r)[1:] for r in alignment.align_documents(blank, *PATHS).collect()} == {(0, 0, 0, 0, 0, 0, "")}


def test_query(spark, whole):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    wanted = [(r.doc_id, *m) for r, m in zip(docs, whole.measures([r.text for r in docs]))]
    assert sorted(map(tuple, QUERIES["op11_tokenizer_alignment"](spark, folder).collect())) == sorted(wanted)
