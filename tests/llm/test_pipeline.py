"""The pipeline's stages on their own inputs, and all queries of this part."""

import hashlib
import os
import sys

import public_tokenizers
import pytest
import tiktoken
from corpora import edge_docs, empty_docs

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
import __spark_entry__ as entries  # noqa: E402
import corpus_pipeline  # noqa: E402
from comparing import differences  # noqa: E402
from depotlake.llm import bpe, exact, mixing, near, toxicity  # noqa: E402
from depotlake.llm.oracle import ORACLE_SQL  # noqa: E402
from depotlake.llm.queries import QUERIES  # noqa: E402

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    import duckdb

    with duckdb.connect() as connection:
        for name in ("documents", "labels"):
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
        yield connection


@pytest.mark.parametrize("name", ORACLE_SQL)
def test_against_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, FOLDER), duck, ORACLE_SQL[name]) == []


def test_all_are_registered():
    assert set(QUERIES) <= set(entries.queries()) and set(ORACLE_SQL) <= set(entries.oracle_sql())
    assert [n.split("_")[0] for n in QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert entries.queries()["pipeline"] is corpus_pipeline.run


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLE_SQL])
def test_every_document_has_its_row(spark, name):
    small = "/root/testdata/sf0.001"
    found = QUERIES[name](spark, small)
    ids = sorted(r.doc_id for r in found.select("doc_id").collect())
    assert ids == sorted(r.doc_id for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id").collect())


def test_run(spark):
    """Every stage against what its operator says of its input, one after the other."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    machine = toxicity.train(toxicity.labelled_sample(docs, labels))
    clean = {r.doc_id for r in toxicity.scored(docs, machine, docs["doc_id"]).collect() if r.score < toxicity.CUT}
    marked = {r.doc_id for r in labels.collect() if r.toxic == 0}
    assert len(marked & clean) == len(marked & set(rows))
    first = {}
    for i in sorted(clean):
        first.setdefault(" ".join(split_spaces(rows[i].text)), i)
    given = docs.where(docs["doc_id"].isin(sorted(first.values())))
    unlike = {r.doc_id for r in near.near_duplicates(given).collect() if r.first}
    mixed = mixing.mix_sources(docs.where(docs["doc_id"].isin(sorted(unlike)))).collect()
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, special_tokens={},
        mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")),
    )
    wanted = []
    for r in mixed:
        ids = library.encode_ordinary(r.row.text)
        data = hashlib.sha256(r.row.text.encode()).hexdigest()
        wanted += [(r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), data)] * r.copies
    found = corpus_pipeline.run(spark, FOLDER)
    assert sorted(map(tuple, found.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect())) == sorted(wanted)


def split_spaces(text):
    import re

    return re.split(r"[\x20\x09-\x0D]+", text)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_on_edge_rows(spark, name, stage):
    docs = edge_docs(spark)
    left = stage(spark, docs, FOLDER)
    if name != "byte_bpe":
        assert left.columns == docs.columns and 0 < left.count()
    else:
        assert left.count() == docs.count()
    assert stage(spark, empty_docs(spark), FOLDER).count() == 0


def test_stages_keep_what_they_should(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "source_mixing", "byte_bpe"]
    docs = edge_docs(spark)
    assert exact.drop_exact_duplicates(docs).count() < docs.count()


@pytest.mark.parametrize("stage", ["toxicity", "near_dedup", "byte_bpe"])
def test_workers_get_few_rows_at_once(spark, stage):
    """An executor and its worker never hold a whole file of texts; a smaller limit of the session stays."""
    limit = "spark.sql.execution.arrow.maxRecordsPerBatch"
    small = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{small}/documents.parquet")
    before = spark.conf.get(limit)
    try:
        for given, then in ((10000, 1000), (0, 1000), (7, 7)):
            spark.conf.set(limit, given)
            dict(corpus_pipeline.STAGES)[stage](spark, docs, small)
            assert int(spark.conf.get(limit)) == then
    finally:
        spark.conf.set(limit, before)
