"""Fill-in-the-middle against cuts of Python strings, and the set of boundaries against lists."""

import hashlib
import random

import numpy as np
import pytest
import regex
from corpora import edge_docs, edge_rows, empty_docs
from hypothesis import given, settings
from hypothesis import strategies as st

from depotlake.llm import infill
from depotlake.llm.infill import SPAN, Boundaries, Signs
from depotlake.llm.queries import QUERIES


def plain_version(text, doc_id, units=None):
    """By lists of units, without offsets."""
    text = text or ""
    if units is None:
        parts = list(text)
    else:
        ends = [m.end() for m in regex.finditer(units, text) if m.group()]
        ends = [*ends[:-1], len(text)] if ends else []
        parts = [text[a:b] for a, b in zip([0, *ends], ends)]
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(parts)
    if not n or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(parts[:a]), "".join(parts[a:b]), "".join(parts[b:])
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def kinds(found):
    return [type(c).__name__ for c in found.containers]


def places_of_each_kind():
    pick = np.random.default_rng(1)
    yield "Numbers", np.sort(pick.choice(SPAN, 3000, replace=False))
    yield "Bitmap", np.sort(pick.choice(SPAN, 30000, replace=False))
    yield "Runs", np.concatenate([np.arange(5, 4000), np.arange(9000, 60000)])
    yield "Numbers", np.array([SPAN - 1])
    yield "Runs", np.arange(SPAN)


def test_each_kind_of_container():
    for kind, places in places_of_each_kind():
        found = Boundaries.of(places)
        assert kinds(found) == [kind]
        assert [found.select(k) for k in range(0, len(places), 7)] == places[::7].tolist()
        assert found.select(len(places) - 1) == places[-1] and len(found) == len(places)


def test_containers_with_empty_spans_between():
    parts = list(places_of_each_kind())
    offsets = np.concatenate([places + SPAN * 3 * n for n, (_, places) in enumerate(parts)])
    found = Boundaries.of(offsets)
    assert kinds(found) == [kind for kind, _ in parts]
    assert [found.select(k) for k in range(0, len(offsets), 101)] == offsets[::101].tolist()
    for k in (-1, len(offsets)):
        with pytest.raises(IndexError):
            found.select(k)


@pytest.mark.parametrize("last", [0, 1, SPAN - 1, SPAN, SPAN + 1, 3 * SPAN + 7])
def test_all_offsets(last):
    found = Boundaries.up_to(last)
    assert len(found) == last + 1 and set(kinds(found)) == {"Runs"}
    assert [found.select(k) for k in (0, last // 2, last)] == [0, last // 2, last]


@settings(deadline=None, max_examples=60)
@given(st.sets(st.integers(0, 4 * SPAN), min_size=1))
def test_any_set(places):
    ordered = sorted(places)
    found = Boundaries.of(np.array(ordered))
    assert [found.select(k) for k in range(len(ordered))] == ordered


@settings(deadline=None)
@given(st.text(), st.integers(0, 10**9), st.sampled_from([None, r"\S+\s*", r"[^\n]*\n", r"\p{L}"]))
def test_cuts(text, doc_id, units):
    pattern = regex.compile(units) if units else None
    found = infill.reorder(text.encode(), doc_id, "1", pattern, 10, 20, Signs())
    assert (*found[:4], found[4].decode()) == plain_version(text, doc_id, units)


def test_long_text_of_many_scripts():
    pick = random.Random(3)
    text = "".join(pick.choice("ab é中🙂\n") for _ in range(300_000))
    for doc_id in range(12):
        found = infill.reorder(text.encode(), doc_id, "1", None, 10, 20, Signs())
        assert (*found[:4], found[4].decode()) == plain_version(text, doc_id)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("units", [None, r"\S+\s*"])
def test_rows_with_everything_in_them(spark, units):
    texts = [(r[0], r[1]) for r in edge_rows()] + [(20 + n, t) for n, t in enumerate(["<P>", "a<S>b", "x <M>", "<", "<<S", "P>"])]
    docs = edge_docs(spark).select("doc_id", "text", "kept", "form", "row")
    more = spark.createDataFrame([(i, t, "k", "f", 1) for i, t in texts[len(edge_rows()) :]], docs.schema)
    made = infill.fill_in_middle(docs.unionByName(more), units=units)
    assert rows(made) == sorted([(i, *plain_version(t, i, units)) for i, t in texts], key=repr)
    back = made.select("doc_id", infill.restored(made["output"], made["form"]))
    assert rows(back) == sorted([(i, t or "") for i, t in texts], key=repr)


def test_other_signs_and_shares(spark):
    docs = spark.createDataFrame([(n, f"text {n} <P> (p) {'+' * (n % 3)}" if n % 9 else "a[s|b") for n in range(300)], "doc_id long, text string")
    signs = Signs("[p", "[s|", "++(")
    made = infill.fill_in_middle(docs, seed="x", plain=0, spm=100, signs=signs)
    forms = {r["form"] for r in made.collect()}
    assert forms == {"plain", "spm"}  # plain only where a sign stands in the text
    back = made.select("doc_id", infill.restored(made["output"], made["form"], signs).alias("text"))
    assert rows(back) == rows(docs)


def test_empty_table_and_other_ids(spark):
    assert infill.fill_in_middle(empty_docs(spark)).collect() == []
    named = spark.createDataFrame([("a", "some text"), (None, "other")], "doc_id string, text string")
    assert {r["doc_id"]: r["n"] for r in infill.fill_in_middle(named).collect()} == {"a": 9, None: 5}


def test_query_restores_all_texts(spark):
    folder = "/root/testdata/sf0.001"
    made = QUERIES["op13_fill_in_middle"](spark, folder).collect()
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert len(made) == len(docs)
    for r in made:
        n, form, prefix, middle, output = plain_version(docs[r["doc_id"]], r["doc_id"])
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"]) == (n, form, prefix, middle)
        assert r["output_sha256"] == hashlib.sha256(output.encode()).hexdigest()
        assert r["restored_sha256"] == hashlib.sha256(docs[r["doc_id"]].encode()).hexdigest()
