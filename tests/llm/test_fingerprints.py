"""Fingerprints against exact sets and the definition of densification."""

import hashlib

import numpy as np
import pytest
from corpora import edge_docs, edge_rows, empty_docs, words

from depotlake.llm import fingerprints as f


def similarity(a, b):
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (a.split(), b.split())]
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def test_densification_is_the_definition():
    pick = np.random.default_rng(0)
    bins = np.full((30, f.BINS), f._EMPTY, np.uint64)
    for row in bins[1:]:
        places = pick.choice(f.BINS, pick.integers(1, f.BINS), replace=False)
        row[places] = pick.integers(0, 1 << 60, len(places), dtype=np.uint64)
    wanted, full = bins.copy(), bins != f._EMPTY
    for row, there in zip(wanted, full):
        for n in np.flatnonzero(~there) if there.any() else ():
            attempt = 0
            while not there[source := f._attempt(attempt)[n]]:
                attempt += 1
            row[n] = row[source]
    assert (f.densified(bins) == wanted).all()


@pytest.mark.parametrize("length", [60, 300, 3000])
def test_likeness_is_near_the_similarity(length):
    """Bias corrected: on average the error is small, and no estimate is far off."""
    errors = []
    for n in range(60):
        left = words(n, length, 5000)
        cut = len(left) * (n % 10 + 1) // 11
        right = left[:cut] + " " + words(n + 1000, length // 2, 5000)
        a, b = f.fingerprints([left.encode(), right.encode()])
        errors.append(f.likeness(a, b) - similarity(left, right))
    assert abs(np.mean(errors)) < 0.02 and max(map(abs, errors)) < 0.15


def test_texts_without_words():
    blank, other = f.fingerprints([b" \n", b"a b"])
    assert blank == b"" and len(other) == f.BINS * f.BITS // 8
    assert [f.likeness(blank, blank), f.likeness(blank, other), f.likeness(other, other)] == [1.0, 0.0, 1.0]


@pytest.mark.parametrize("partitions", ["1", "4"])
def test_next_documents(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        found = f.fingerprint_documents(edge_docs(spark)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(found) == len(edge_rows())
    own = {}
    for doc_id, text, *_ in edge_rows():
        own.setdefault(doc_id, []).append(text or "")
    order = sorted((i for i in own if i is not None), reverse=True) + [None]
    for r in found:
        after = order[(order.index(r.doc_id) + 1) % len(order)]
        options = {}
        for text in own[r.doc_id]:
            for following in [*own[after], *own[r.doc_id]]:  # rows of one id stand in any order
                changed = f.edited(text, following).encode()
                prints = f.fingerprints([text.encode(), changed, following.encode()])
                key = (len(text), hashlib.sha256(changed).hexdigest(), *prints[:2])
                options.setdefault(key, set()).add((f.likeness(*prints[:2]), f.likeness(prints[0], prints[2])))
        key = (r.n_chars, r.edited_sha256, bytes(r.fingerprint), bytes(r.edited_fingerprint))
        assert (r.near_edited, r.near_next) in options[key]


def test_one_row_and_no_row(spark):
    one = edge_docs(spark).where("doc_id = 7")
    r = f.fingerprint_documents(one).collect()
    assert len(r) == 1 and r[0].near_next == 1.0
    assert f.fingerprint_documents(empty_docs(spark)).count() == 0


def test_equal_texts_have_equal_fingerprints(spark):
    docs = spark.createDataFrame([(n, words(n % 5, 40)) for n in range(40)], "doc_id long, text string")
    found = f.fingerprint_documents(docs).collect()
    assert len({(r.doc_id % 5, bytes(r.fingerprint)) for r in found}) == 5
