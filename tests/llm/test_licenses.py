"""Licence scans against loops over all beginnings, and texts that were changed."""

import random
import re
from collections import Counter

import pytest
from corpora import edge_docs, edge_rows, empty_docs

from depotlake.llm import licenses
from depotlake.llm.licenses import BASE, NOTICES, RARE, SLACK, VOTES, Template

ALL = (*BASE, *NOTICES)
BY_LABEL = {t.label: t.text for t in reversed(NOTICES)}


def plain_words(text):
    lower = "".join(c.lower() if c.isascii() else c for c in text or "")
    return re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)


def plain_version(texts, templates=ALL):
    """For each text: (label, start, matched, size, base) of what is found, by trying each beginning."""
    words = [plain_words(t) for t in texts]
    counts = Counter(w for ws in words for w in set(ws))
    for ws in words:
        found = []
        for t in templates:
            own = plain_words(t.text)
            keys = [plain_words(k) for k in t.keys]
            rare = sorted(set(own) & set(ws), key=lambda w: (counts[w], w.encode()))[:RARE]
            for start in range(-len(own), len(ws)):
                same = [w for i, w in enumerate(own) if 0 <= start + i < len(ws) and ws[start + i] == w]
                if sum(w in rare for w in same) < VOTES:
                    continue
                near = range(max(start - SLACK, 0), start + len(own) + SLACK)
                if t.base and len(same) == len(own) or not t.base and all(
                    any(ws[s : s + len(k)] == k and s + len(k) <= start + len(own) + SLACK for s in near) for k in keys
                ):
                    found.append((t.label, start, len(same), len(own), t.base))
        yield len(ws), sorted(found)


def scanned(spark, rows, **how):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    return {r.doc_id: (r.n_words, sorted(map(tuple, r.found))) for r in licenses.find_licenses(docs, **how).collect()}


def noise(pick, count):
    return [pick.choice("the of software and license under mit copy free terms version cc by nc x1 é".split()) for _ in range(count)]


def test_every_notice_is_found_as_itself(spark):
    rows = [(n, f"Some file.\n\n# {t.text.upper()}\n# more") for n, t in enumerate(NOTICES)]
    found = scanned(spark, rows)
    for n, t in enumerate(NOTICES):
        size = len(t.words)
        assert (t.label, 2, size, size, False) in found[n][1]
        assert {label for label, *_ in found[n][1]} == {t.label}


def test_changed_notices_and_noise(spark):
    """Words left out, put in and changed; notices next to each other; words of licences in any order."""
    pick = random.Random(1)
    texts = []
    for _ in range(120):
        words = noise(pick, pick.randrange(30))
        for t in pick.sample(ALL, pick.randrange(3)):
            own = [w.decode() for w in t.words]
            for _ in range(pick.randrange(4)):
                place = pick.randrange(len(own))
                own[place : place + pick.randrange(2)] = noise(pick, pick.randrange(2))
            words += own[pick.choice([0, 0, 0, 3]) :] + noise(pick, pick.randrange(5))
        texts.append(" ".join(words))
    wanted = list(plain_version(texts))
    assert scanned(spark, list(enumerate(texts))) == dict(enumerate(wanted))
    assert sum(bool(f) for _, f in wanted) > 50


def test_rows_with_everything_in_them(spark):
    docs = edge_docs(spark).select("doc_id", "text", "words", "labels", "n")
    found = licenses.find_licenses(docs).collect()
    wanted = [(i, n, f) for (i, *_), (n, f) in zip(edge_rows(), plain_version([r[1] for r in edge_rows()]))]
    assert sorted([(r.doc_id, r.n_words, sorted(map(tuple, r.found))) for r in found], key=repr) == sorted(wanted, key=repr)
    assert licenses.license_labels(licenses.find_licenses(empty_docs(spark))).collect() == []


def labelled(spark, texts, **how):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = licenses.license_labels(licenses.find_licenses(docs, **how)).orderBy("doc_id").collect()
    return [tuple(r)[1:] for r in rows]


def test_columns(spark):
    mit = "Released under the MIT License."
    found = labelled(spark, [mit, f"cc-by-nc {mit} {mit} CC BY NC", None, "mit license", BY_LABEL["bsd-2"] + " " + mit])
    assert found[0] == (5, 1, 1, 1, "mit", "mit", 1.0)
    assert found[1] == (16, 4, 0, 13, "cc-by-nc,mit", "cc-by-nc,mit", 1.0)
    assert found[2] == (0, 0, None, None, "", "", 0.0) and found[3] == (2, 0, None, None, "", "", 0.0)
    assert found[4][4:] == ("mit", "bsd-2,mit", 1.0)


def test_key_phrases_are_needed(spark):
    text = BY_LABEL["isc"]
    found = labelled(spark, [text, text.replace("without fee", "without any fee"), text.replace("any purpose", "all purposes")])
    assert [f[5] for f in found] == ["isc", "", "isc"]
    assert 0.5 < found[2][6] < 1


def test_long_text_of_frequent_words(spark):
    """Half a million words that all stand in licences, with two notices in them; no beginning is left out."""
    pick = random.Random(2)
    words = noise(pick, 250_000) + plain_words(BY_LABEL["isc"]) + noise(pick, 250_000) + "under the mit license".split()
    found = labelled(spark, [" ".join(words)])[0]
    places = [s for s in range(len(words)) if words[s : s + 4] == ["under", "the", "mit", "license"]]
    nc = [s for s in range(len(words)) if words[s : s + 3] == ["cc", "by", "nc"]]
    assert found[1] == len(places) + len(nc) and found[2] == min(places + nc) and found[3] == max(places + nc)
    assert "isc" in found[5].split(",")


def test_own_licences(spark):
    own = Template("house", "for the use of members of the house only", ("members of the house",))
    found = labelled(spark, ["this is for the use of members of the house only", "members only"], notices=[own], base=[])
    assert [f[5] for f in found] == ["house", ""]
    with pytest.raises(ValueError):
        licenses.Index([Template("x", "two words", ("two words",))], {})
    with pytest.raises(ValueError):
        licenses.Index([Template("x", "some more words here", ("other words",))], {})
