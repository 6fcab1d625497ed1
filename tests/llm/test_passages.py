"""Repeated byte strings against counting all of them."""

import hashlib
import os
import random
from collections import Counter

import numpy as np
import pytest
from corpora import edge_docs, empty_docs
from pyspark.sql import functions as F

from depotlake.llm import passages


def covers(texts, length):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    for text in texts:
        cover = [False] * len(text)
        for i in range(len(text) - length + 1):
            if seen[text[i : i + length]] > 1:
                cover[i : i + length] = [True] * length
        yield cover


def brute(texts, length, shorter):
    out = []
    for text, cover, more in zip(texts, covers(texts, length), covers(texts, shorter)):
        kept = bytes(b for b, c in zip(text, cover) if not c)
        runs = sum(c and not before for c, before in zip(cover, [False, *cover]))
        out.append((len(text), sum(cover), runs, hashlib.sha256(kept).hexdigest(), sum(more)))
    return out


def check(docs, length, shorter=None):
    rows = [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]
    wanted = zip([d for d, _ in rows], brute([t.encode() for _, t in rows], length, shorter or min(length, passages.SHORTER)))
    found = passages.without_repeats(docs, length, shorter)
    shown = found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256), "n_repeated").collect()
    assert sorted(((r[0], tuple(r)[1:]) for r in shown), key=repr) == sorted(wanted, key=repr)
    for r in found.collect():
        assert sum(s.end - s.start for s in r.spans) == r.n_removed == r.n_bytes - len(r.kept)


@pytest.fixture(scope="module")
def corpus(spark):
    """Shared pieces at odd places, periodic texts, repeated rows, null ids."""
    pick = random.Random(5)

    def signs(n, alphabet):
        return "".join(pick.choice(alphabet) for _ in range(n))

    shared = [signs(300, "abc "), signs(200, "abé"), "x" * 150, "ab" * 90]
    rows = []
    for n in range(50):
        text = ""
        for _ in range(pick.randrange(5)):
            piece = pick.choice(shared)
            start = pick.randrange(len(piece))
            text += piece[start : start + pick.randrange(1, 200)] + signs(pick.randrange(30), "abcdef")
        rows.append((n, text))
    rows += [(100, None), (101, ""), (None, shared[0]), (5, shared[0]), (5, shared[0])]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


@pytest.mark.parametrize("length, shorter", [(24, None), (64, None), (40, 24), (64, 41), (100, 30)])
def test_small_lengths(corpus, length, shorter):
    check(corpus, length, shorter)


def test_pieces_hot_keys_and_small_groups(corpus, monkeypatch):
    """The values that a run takes from its driver."""
    for name, value in (("PIECE", 64), ("GROUP_ROWS", 5), ("HOT_SAMPLE", 2), ("HOT_LEAST", 2)):
        monkeypatch.setattr(passages, name, value)
    check(corpus, 40, 30)


def test_edge_rows(spark):
    check(edge_docs(spark), passages.LENGTH)
    assert passages.without_repeats(empty_docs(spark)).count() == 0


def test_production_length(spark):
    pick = random.Random(8)
    shared = "".join(pick.choice("abcdefgh ") for _ in range(900))
    rows = []
    for n in range(12):
        own = "".join(pick.choice("abcdefgh ") for _ in range(500))
        cut = pick.randrange(500)
        rows.append((n, own[:200] + shared[cut : cut + pick.choice([399, 400, 401, 600])] + own[200:]))
    check(spark.createDataFrame(rows, "doc_id long, text string"), 400)


@pytest.mark.parametrize("in_memory", [1 << 20, 0])
def test_columns_against_counting(monkeypatch, in_memory):
    monkeypatch.setattr(passages, "IN_MEMORY", in_memory)
    pick = random.Random(3)
    for _ in range(600):
        length, more = pick.randrange(2, 7), pick.randrange(4)
        rows = {}
        for group in range(pick.randrange(1, 4)):
            for _ in range(pick.randrange(1, 7)):
                starts = pick.randrange(1, 6)
                text = "".join(pick.choice("ab") for _ in range(starts - 1 + length + pick.randrange(more + 1))).encode()
                rows[group, text, min(pick.randrange(5), len(text) - 1), starts] = pick.choice([1, 1, 1, 2])
        rows = dict(sorted(rows.items(), key=lambda r: r[0][0]))
        seen = Counter()
        for (group, text, anchor, starts), weight in rows.items():
            for i in range(starts):
                for n in {length, length + more}:
                    seen[group, i - anchor, n, text[i : i + n]] += weight * (i + n <= len(text))
        group, text, anchor, starts = zip(*rows)
        found = passages.repeated_starts(
            np.array(group), list(text), np.array(anchor), np.array(starts, np.int64), np.array(list(rows.values())), (length, length + more)
        )
        for n, by_length in zip((length, length + more), found):
            for (g, t, a, s), flags in zip(rows, by_length):
                assert flags.tolist() == [i + n <= len(t) and seen[g, i - a, n, t[i : i + n]] > 1 for i in range(s)]


def test_parts_of_a_segment():
    for n in range(200):
        text, starts, place = os.urandom(70), n % 19 + 1, n % 7
        asked = {"key": n - 100, "segment": 9, "weight": 1, "place": place, "starts": starts, "anchor": 19, "variants": 5}
        parts = list(passages._cut(text, asked, 31, 25, 0, 3))
        assert sum(p[5] for p in parts) == starts and len(parts) >= starts / 3
        for _, key, _, _, shift, many, anchor, data in parts:
            assert key == n - 100 and anchor == 19 - shift
            assert data == text[place + shift : place + shift + many - 1 + 31]


@pytest.mark.parametrize("fewer", [(3, 1), (1,)])
@pytest.mark.parametrize("shorter", [64, 50])
def test_crowded_groups_are_dealt_until_they_are_small(spark, monkeypatch, fewer, shorter):
    """A notice in all documents, with different text around it: no group holds all documents."""
    pick = random.Random(9)

    def signs(n):
        return "".join(pick.choice("abcdefgh ") for _ in range(n))

    notice = signs(80)
    rows = [(n, signs(100) + notice[: pick.choice([63, 64, 70, 80])] + signs(100)) for n in range(60)]
    docs = spark.createDataFrame(rows + rows[:2], "doc_id long, text string")
    monkeypatch.setattr(passages, "MANY_SEGMENTS", 4)
    monkeypatch.setattr(passages, "PART", 16)
    monkeypatch.setattr(passages, "FEWER_PLACES", fewer)
    sizes, ordered = [], passages.ordered_segments

    def noted(cut, *lengths):
        sizes.extend(r["count"] for r in cut.groupBy("group").count().collect())
        return ordered(cut, *lengths)

    monkeypatch.setattr(passages, "ordered_segments", noted)
    check(docs, 64, shorter)
    assert 1 < max(sizes) <= 4


def test_crowded_groups_of_odd_texts(corpus, monkeypatch):
    for name, value in (("MANY_SEGMENTS", 1), ("PART", 8)):
        monkeypatch.setattr(passages, name, value)
    check(corpus, 40, 31)
