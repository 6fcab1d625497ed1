"""Mixing against the definition in plain Python."""

import re
from collections import Counter
from fractions import Fraction

from corpora import as_rows, edge_docs, edge_rows, empty_docs, words
from pyspark.sql import functions as F

from depotlake.llm import mixing


def shares(sizes, weights=(1, 2, 3), most=3):
    """Targets by resharing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[n % len(weights)] for n, s in enumerate(names)}
    target, free, rest = {}, set(names), Fraction(sum(sizes.values()))
    while True:
        total = sum(weight[s] for s in free)
        over = [s for s in free if rest * weight[s] / total > most * sizes[s]] if total else []
        if not over:
            break
        for s in over:
            target[s] = Fraction(most * sizes[s])
            free.remove(s)
        rest = sum(sizes.values()) - sum(target.values())
    for s in free:
        target[s] = rest * weight[s] / sum(weight[x] for x in free)
    return target


def test_targets(spark):
    for sizes in (
        {"a": 10, "b": 400, "c": 5, None: 1000},
        {"a": 1, "b": 1, "c": 1, "d": 10_000},
        {"a": 100, "b": 100, "c": 100},
        {"a": 0, "b": 7, "c": 0},
        {"only": 9},
    ):
        rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        found = {r.source: r.target for r in mixing.source_targets(rows).collect()}
        wanted = shares(sizes)
        assert found.keys() == wanted.keys()
        assert all(abs(found[s] - float(wanted[s])) < 1e-6 * (1 + float(wanted[s])) for s in found), sizes


def test_edge_rows(spark):
    mixed = mixing.mix_sources(edge_docs(spark))
    rows = mixed.collect()
    size = {(d, t): len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t, *_ in edge_rows()}
    assert len(rows) == len(edge_rows())
    total = Counter()
    for doc_id, text, _, source, _ in edge_rows():
        total[source] += size[doc_id, text]
    wanted = shares(dict(total))
    for r in rows:
        assert r["size"] == size[r.doc_id, r.row.text] and r.source_size == total[r.row.source]
        assert abs(r.target - float(wanted[r.row.source])) < 1e-6 * (1 + r.target)
        assert r.taken == r.copies * r["size"] <= 3 * r["size"]
    documents = mixing.mixed_documents(edge_docs(spark))
    assert documents.columns == edge_docs(spark).columns
    assert documents.count() == sum(r.copies for r in rows)


def corpus(spark):
    rows = [(n, words(n, 1 + n * 7 % 90), "en", f"s{n * n % 5}", 0) for n in range(1500)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_words_come_near_targets(spark):
    mixed = mixing.mix_sources(corpus(spark), carry=False)
    by_source = mixed.groupBy("target", "source_size").agg(F.sum("taken").alias("taken"))
    assert all(abs(r.taken - r.target) <= 0.02 * r.target + 100 for r in by_source.collect())


def test_blocks_and_partitions_change_nothing(spark):
    columns = ["doc_id", "size", "source_size", "target", "copies"]
    one = as_rows(mixing.mix_sources(corpus(spark), carry=False), *columns)
    small = mixing.mix_sources(corpus(spark).repartition(7), carry=True, block_rows=3)
    assert as_rows(small, *columns) == one
    other = mixing.mix_sources(corpus(spark), carry=False, seed="other")
    assert as_rows(other, *columns) != one


def test_empty_table(spark):
    assert mixing.mix_sources(empty_docs(spark)).count() == 0
    assert mixing.mixed_documents(empty_docs(spark)).count() == 0


def test_main_path_is_native(spark):
    plan = mixing.mixed_documents(corpus(spark))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
