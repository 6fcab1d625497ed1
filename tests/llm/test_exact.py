"""Exact deduplication against grouping by normalised text."""

import hashlib
import re
from collections import defaultdict

import pytest
from corpora import as_rows, edge_docs, edge_rows, empty_docs

from depotlake.llm import exact


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def expected():
    groups = defaultdict(list)
    for doc_id, text, *_ in edge_rows():
        groups[normal(text)].append(doc_id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        out += [(i, keep, len(ids), hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return sorted(out, key=repr)


@pytest.mark.parametrize("digest_bytes", [32, 1, 0])
def test_groups(spark, digest_bytes):
    """Also where all digests collide: then only the bytes tell texts apart."""
    found = exact.exact_duplicates(edge_docs(spark), digest_bytes)
    assert as_rows(found, "doc_id", "keep_id", "group_size", "text_sha256") == expected()
    kept = [r.text_sha256 for r in found.collect() if r.kept]
    assert len(kept) == len(set(kept)) == len({e[3] for e in expected()})


def test_many_batches_keep_state(spark):
    docs = edge_docs(spark).repartition(6)
    found = exact.exact_duplicates(docs, files_per_batch=1)
    assert as_rows(found, "doc_id", "keep_id", "group_size", "text_sha256") == expected()


def test_dropping_keeps_one_row_and_all_columns(spark):
    docs = edge_docs(spark)
    left = exact.drop_exact_duplicates(docs)
    assert left.columns == docs.columns
    texts = [normal(r.text) for r in left.collect()]
    assert sorted(texts) == sorted({normal(t) for _, t, *_ in edge_rows()})
    assert sum(r.doc_id == 1 for r in left.collect()) == 2  # one of the repeated rows, and the other text


def test_empty_table(spark):
    assert exact.exact_duplicates(empty_docs(spark)).count() == 0
    assert exact.drop_exact_duplicates(empty_docs(spark)).count() == 0


def test_state_settings_are_put_back(spark):
    key = f"{exact.STATE}.providerClass"
    before = spark.conf.get(key)
    exact.exact_duplicates(edge_docs(spark))
    assert spark.conf.get(key) == before


def test_state_has_bounded_memory(spark, monkeypatch):
    """The stores of all partitions share one bounded memory while the stream runs; later the session is as before."""
    bounded, seen = f"{exact.STATE}.rocksdb.boundedMemoryUsage", []
    path = exact.Scratch.path

    def noted(self, name):
        if name.startswith("updates/batch"):
            seen.append(spark.conf.get(bounded, None))
        return path(self, name)

    monkeypatch.setattr(exact.Scratch, "path", noted)
    exact.exact_duplicates(edge_docs(spark)).count()
    assert seen and set(seen) == {"true"}
    assert spark.conf.get(bounded, None) is None
