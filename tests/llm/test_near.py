"""Near-duplicates against all pairs of whole sets."""

import random
import re

import numpy as np
import pytest
from corpora import as_rows, edge_docs, edge_rows, empty_docs

from depotlake.llm import near
from depotlake.llm.components import components
from depotlake.llm.tables import Scratch


def shingle_set(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if 0 < len(words) < width:
        return {tuple(words)}
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def brute(rows, width):
    sets = [shingle_set(text, width) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if a and 100 * common >= 80 * (len(a) + len(sets[j]) - common) and sets[j]:
                root[find(i)] = find(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        component = min(ids) if ids else None
        out.append((doc_id, len(sets[i]), component, doc_id == component))
    return sorted(out, key=repr)


def copies():
    """A large group of near copies of which many link only through others, pairs, and strangers."""
    pick = random.Random(4)
    rows = []
    base = [f"w{pick.randrange(300)}" for _ in range(120)]
    for n in range(90):
        words = list(base)
        for _ in range(pick.randrange(0, 16)):
            words[pick.randrange(len(words))] = f"e{pick.randrange(10_000)}"
        rows.append((n, " ".join(words)))
    for n in range(100, 160):
        words = [f"w{pick.randrange(300)}" for _ in range(pick.randrange(1, 60))]
        rows.append((n, " ".join(words)))
        if n % 3 == 0:
            rows.append((n + 200, " ".join([*words, "end"])))
        if n % 4 == 0:
            rows.append((n + 400, " ".join(words).upper()))
    for n in range(500, 530):  # small sets around the bound
        rows.append((n, " ".join(f"s{k}" for k in range(n % 10 + 1))))
    return rows


@pytest.mark.parametrize("width", [1, 2, 5])
def test_components(spark, width, monkeypatch):
    monkeypatch.setattr(near, "BLOCK", 8)  # so that groups have several blocks
    monkeypatch.setattr(near, "HOT_SAMPLE", 2)  # and some keys are hot
    docs = spark.createDataFrame(copies(), "doc_id long, text string").repartition(5)
    found = near.near_duplicates(docs, width)
    assert as_rows(found, "doc_id", "n_shingles", "component_id", "kept") == brute(copies(), width)


def test_edge_rows(spark):
    found = near.near_duplicates(edge_docs(spark), 2)
    rows = [(doc_id, text) for doc_id, text, *_ in edge_rows()]
    alone = [r for r in found.collect() if r.n_shingles == 0]
    assert len(alone) == 4 and all(r.component_id == r.doc_id and r.kept for r in alone)
    some = [r for r in brute(rows, 2) if r[1]]
    assert as_rows(found.where("n_shingles > 0"), "doc_id", "n_shingles", "component_id", "kept") == some
    assert near.near_duplicates(empty_docs(spark), 2).count() == 0


def test_dropping_keeps_one_row_of_each_group(spark):
    docs = edge_docs(spark)
    left = near.drop_near_duplicates(docs, 2)
    assert left.columns == docs.columns
    kept = sorted((r.doc_id, len(shingle_set(r.text, 2))) for r in left.collect() if shingle_set(r.text, 2))
    groups = {(c, n) for i, n, c, _ in brute([(d, t) for d, t, *_ in edge_rows()], 2) if n and i == c}
    assert kept == sorted(groups)  # two texts of doc_id 1 are two groups
    assert near.drop_near_duplicates(empty_docs(spark)).count() == 0


def test_signatures_within_the_distance_share_a_key():
    pick = random.Random(1)
    for _ in range(500):
        wrong = set(pick.sample(range(near.SYMBOLS), near.DISTANCE))
        per_chunk = [sum(c * near.CHUNK_SYMBOLS <= w < (c + 1) * near.CHUNK_SYMBOLS for w in wrong) for c in range(near.CHUNKS)]
        assert min(per_chunk) <= near.ERRORS


def test_chain_of_links(spark, tmp_path):
    links = [(n, n + 1) for n in range(60)] + [(100, 90), (90, 95), (7, 7)]
    df = spark.createDataFrame(links, "a long, b long")
    found = dict(components(df, Scratch(spark, "test"), "chain").collect())
    assert found == {**dict.fromkeys(range(61), 0), 90: 90, 95: 90, 100: 90}
    assert components(df.limit(0), Scratch(spark, "test"), "none").count() == 0


def complement_words(rounds=10):
    """Two words of 2**rounds letters whose sums of letter times power are equal for any odd base, modulo 2**64."""
    one, two = "a", "b"
    for _ in range(rounds):
        one, two = one + two, two + one
    return one, two


def test_words_that_collide_in_polynomial_hashes(spark):
    one, two = complement_words(11)
    rows = [(1, f"{one} x y"), (2, f"{two} x y"), (3, one), (4, two), (5, f"{one}  x\ty")]
    found = near.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2)
    assert {r.doc_id: r.component_id for r in found.collect()} == {1: 1, 2: 2, 3: 3, 4: 4, 5: 1}


def test_links_are_confirmed_on_words(monkeypatch):
    """Also where the hashes of all words are equal."""
    monkeypatch.setattr(near.xxhash, "xxh3_64_intdigest", lambda word: 7)
    texts = [b"a b c d e f g", b"a b c d e f g h", b"p q r s t u v", b"", b"a", b"a a a"]
    sets = near.exact_sets(texts, 2)
    assert [len(s) for s in sets] == [6, 7, 6, 0, 1, 1]
    assert len(np.intersect1d(sets[0], sets[1])) == 6 and not len(np.intersect1d(sets[0], sets[2]))
    assert sets[4].tolist() != sets[5].tolist()


@pytest.mark.parametrize("width", [1, 2, 3, 5])
def test_exact_sets(width):
    pick = random.Random(width)
    texts = [" ".join(pick.choice("aAbc") for _ in range(pick.randrange(12))) for _ in range(60)]
    sets = near.exact_sets([t.encode() for t in texts], width)
    for a, left in zip(texts, sets):
        for b, right in zip(texts, sets):
            assert len(np.intersect1d(left, right)) == len(shingle_set(a, width) & shingle_set(b, width))


@pytest.mark.parametrize("hot_keys", [0, 40])
def test_pairs_across_groups(spark, monkeypatch, hot_keys):
    """Groups whose members are within the distance, single nodes too; all pairs compared here."""
    monkeypatch.setattr(near, "BLOCK", 4)
    pick = np.random.default_rng(3)
    base = pick.integers(0, 1 << 16, near.SYMBOLS)
    rows = []
    for node in range(90):
        symbols = base.copy()
        changed = pick.choice(near.SYMBOLS, pick.integers(0, 45), replace=False)
        symbols[changed] = pick.integers(0, 1 << 16, len(changed))
        group = int(node if node % 3 else node % 5)
        rows.append((node, int(pick.integers(10, 14)), symbols.astype("<u2").tobytes(), group, int(group if node % 7 else -1)))
    placed = spark.createDataFrame(rows, "node long, n long, signature binary, near_group long, component long")
    keys = sorted({r["key"] for r in near.chunk_keys(placed, "node").collect()})
    hot = np.array(sorted(pick.choice(keys, hot_keys, replace=False).tolist()), np.int64)
    found = near._pairs_across(placed, hot, Scratch(spark, "test")).collect()
    signatures = {r[0]: np.frombuffer(r[2], "<u2") for r in rows}
    wanted = set()
    for a, n_a, _, group_a, c_a in rows:
        for b, n_b, _, group_b, c_b in rows:
            close = (signatures[a] != signatures[b]).sum() <= near.DISTANCE
            if a < b and group_a != group_b and c_a != c_b and close and 100 * min(n_a, n_b) >= 80 * max(n_a, n_b):
                wanted.add((a, b))
    assert {tuple(sorted((r.a, r.b))) for r in found} == wanted and len(wanted) > 100
