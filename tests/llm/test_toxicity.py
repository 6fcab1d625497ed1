"""Toxicity on held-out rows, and what the factorization machine adds."""

import random
import zlib

import numpy as np
import pytest
from corpora import CLASHING, edge_docs, edge_rows, empty_docs, words
from pyspark.sql import functions as F

from depotlake.llm import toxicity


def accuracy(docs, labels):
    found = toxicity.score_documents(docs, labels).join(labels, "doc_id").where("held_out").collect()
    return np.mean([(r.score >= toxicity.CUT) == (r.toxic == 1) for r in found]), found


def test_given_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    right, found = accuracy(docs, labels)
    clean = [r.predicted for r in found if r.toxic == 0]
    toxic = [r.predicted for r in found if r.toxic == 1]
    assert right > 0.95 and np.mean(clean) < 0.02 and np.mean(toxic) > 0.75


@pytest.fixture(scope="module")
def pairs(spark):
    """An insult alone and a group alone are clean; together they are toxic."""
    pick = random.Random(2)
    rows, labels = [], []
    for n in range(1500):
        insult, group = pick.random() < 0.5, pick.random() < 0.5
        extra = ["blorgish"] * insult + ["zanthians"] * group
        text = words(n, 30, 3000).split() + extra
        pick.shuffle(text)
        rows.append((n, " ".join(text)))
        labels.append((n, 1, int(insult and group)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_pairs_of_terms(pairs):
    right, _ = accuracy(*pairs)
    assert right > 0.98


def test_held_out_rows_are_not_learned_from(spark, pairs):
    docs, labels = pairs
    held = {n for n in range(1500) if zlib.crc32(str(n).encode()) % 3 == 1}
    assert {r.doc_id for r in toxicity.labelled_sample(docs, labels).collect()} == set(range(1500)) - held
    wrong = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, other = (dict(toxicity.score_documents(docs, given).select("doc_id", "score").collect()) for given in (labels, wrong))
    assert one == other


def test_scores_depend_on_the_text_alone(spark, pairs):
    docs, labels = pairs
    machine = toxicity.train(toxicity.labelled_sample(docs, labels))
    moved = docs.withColumn("doc_id", F.col("doc_id") + 7).repartition(5)
    one = sorted(r.score for r in toxicity.scored(docs, machine, docs["doc_id"]).collect())
    assert one == sorted(r.score for r in toxicity.scored(moved, machine, moved["doc_id"]).collect())


def test_sample_is_bounded(spark, pairs):
    docs, labels = pairs
    sizes = {r.toxic: r["count"] for r in toxicity.labelled_sample(docs, labels, rows=100).groupBy("toxic").count().collect()}
    assert all(60 < n < 140 for n in sizes.values())


def test_edge_rows(spark, pairs):
    labels = pairs[1].unionByName(spark.createDataFrame([(None, 1, 1), (3, 1, None), (3, 1, 1), (3, 0, 0)], "doc_id long, quality int, toxic int"))
    found = toxicity.score_documents(edge_docs(spark), labels).collect()
    assert len(found) == len(edge_rows()) and all(0 <= r.score <= 1 for r in found)
    assert all(not r.held_out for r in found if r.doc_id is None)
    kept = toxicity.drop_toxic(edge_docs(spark), labels)
    assert kept.columns == edge_docs(spark).columns and set(CLASHING) <= set(kept.columns)
    assert toxicity.score_documents(empty_docs(spark), labels).count() == 0
    assert toxicity.score_documents(edge_docs(spark), labels.limit(0)).count() == len(edge_rows())


def test_machine_is_the_formula():
    pick = np.random.default_rng(1)
    machine = toxicity.Machine(np.arange(5), 0.3, pick.normal(size=5), pick.normal(size=(5, 3)))
    row, term = np.array([0, 0, 0, 2]), np.array([0, 2, 4, 1])
    raw = [
        0.3 + machine.weights[[0, 2, 4]].sum() + sum(machine.vectors[a] @ machine.vectors[b] for a, b in ((0, 2), (0, 4), (2, 4))),
        0.3,
        0.3 + machine.weights[1],
    ]
    assert np.allclose(machine.scores(row, term, 3), 1 / (1 + np.exp(-np.array(raw))))


def test_the_filter_sends_each_row_once(spark, pairs):
    docs, labels = pairs
    docs = docs.withColumn("more", F.create_map(F.lit("a"), F.array("doc_id"))).repartition(3)
    left = toxicity.drop_toxic(docs, labels)
    plan = left._jdf.queryExecution().analyzed()
    while plan.nodeName() != "MapInArrow":
        plan = plan.children().head()
    assert plan.children().head().schema().simpleString() == docs.schema.simpleString()
    stays = {r.doc_id for r in toxicity.score_documents(docs, labels).where("predicted = 0").collect()}
    rows = left.collect()
    assert left.schema.simpleString() == docs.schema.simpleString() and 0 < len(rows) < docs.count()
    assert {r.doc_id for r in rows} == stays and len(rows) == len(stays)
    assert all(r.more == {"a": [r.doc_id]} for r in rows)
