"""Licence notices: phrases against plain patterns, notices against plain edit distances."""

import random
import re

import pytest
from pyspark.sql import functions as F

from orderloom.llm import license_notices as ln
from orderloom.llm import registry

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def _plain_base(text):
    words = _words(text)
    out = []
    for phrase, label in ln.PHRASES.items():
        wanted = phrase.split()
        out += [(i, label) for i in range(len(words)) if words[i : i + len(wanted)] == wanted]
    return len(words), sorted(out)


def _least_edits(notice, text):
    """Smallest edit distance of `notice` to any part of `text`."""
    row = list(range(len(notice) + 1))
    best = row[-1]
    for c in text:
        above, row = row, [0]
        for j, n in enumerate(notice, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (c != n)))
        best = min(best, row[-1])
    return best


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        above, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (x != y)))
    return row[-1]


def _wrong(rng, notice, edits):
    for _ in range(edits):
        i = rng.randrange(len(notice))
        kind = rng.randrange(3)
        notice = notice[:i] + (rng.choice("abz 0é") if kind < 2 else "") + notice[i + (kind != 1) :]
    return notice


def _noise(rng, n):
    return " ".join("".join(rng.choice("the license of an rights to software") for _ in range(rng.randrange(1, 9))) for _ in range(n))


def test_all_alike_notices_are_found():
    """Recall and precision against the plain distance, errors at the bound and beyond it."""
    rng = random.Random(5)
    all_notices = [(label, n) for label, wordings in ln.NOTICES.items() for n in wordings]
    reached = 0
    for label, notice in all_notices * 4:
        text = f"{_noise(rng, 6)} {_wrong(rng, notice, rng.randrange(ln.edits_for(notice) + 3))} {_noise(rng, 6)}"
        joined = " ".join(_words(text))
        found = ln.notices_in(joined)
        for f in found:
            wordings = [n for n in ln.NOTICES[f.label] if len(n) == f.length]
            assert min(_distance(n, joined[f.start : f.end]) for n in wordings) <= f.edits <= ln.edits_for("x" * f.length)
        within = {lab for lab, n in all_notices if _least_edits(n, joined) <= ln.edits_for(n)}
        assert {f.label for f in found} <= within
        if label in within:
            reached += 1
            assert found and (label in {f.label for f in found} or min(f.edits / f.length for f in found) <= ln.edits_for(notice) / len(notice))
    assert reached > len(all_notices) * 2


def test_every_window_holds_its_match():
    """Without the choice among overlapping notices: a notice within its bound always has a match."""
    rng = random.Random(6)
    notices, patterns, _ = ln._prepared()
    for number, (_, notice, edits) in enumerate(notices):
        for _ in range(6):
            joined = " ".join(_words(f"{_noise(rng, 3)} {_wrong(rng, notice, edits)} {_noise(rng, 3)}"))
            if _least_edits(notice, joined) <= edits:
                windows = ln._windows(joined).get(number, [])
                assert any(patterns[number].search(joined, a, b) for a, b in windows), (notice, joined)


def test_spans_lie_in_the_text():
    text = "Ünder — Copyright (c) 2020.\nReleased under\n\tthe  M.I.T... MIT Licence!\r\n(All Rigths Reserved) 𝒳 “Licensed under CC-BY-SA 4.0”"
    n, base, found = ln.find(text)
    assert n == len(_words(text)) and base == [("cc-by", 19)]
    got = {f.label: text[f.start : f.end] for f in found}
    assert got["all-rights-reserved"].startswith("All Rigths") and got["cc-by-sa"] == "Licensed under CC-BY-SA 4.0"
    assert "cc-by-nc" not in got
    found = ln.find("Relaesed under the MIT-License")[2]
    assert [(f.label, f.start, f.end) for f in found] == [("mit", 0, 30)] and found[0].edits == 2


@pytest.mark.parametrize("text", ["", " .,- ", "a", "cc", "by cc", "mit licenses", "gnu general public licence", "permit license", "mitlicense", "ccby", "apache\x85license"])
def test_no_phrase(text):
    assert ln.find(text)[:2] == (len(_words(text)), [])


def test_other_language_prose_is_left_alone():
    prose = "The rights of the people are reserved for all of them. Software is licensed to anyone under terms. Die Lizenz ist frei. " * 40
    assert ln.find(prose)[2] == []


def test_odd_rows(spark):
    long = "word " * 300_000 + "MIT\nLicense " + "é " * 10 + "cc by " * 3 + "all rights reserved"
    rows = [(1, "The MIT License, the MIT license."), (1, "CC BY CC-BY"), (None, "Apache License"), (2, None), (3, ""), (4, long), (5, "GNU General Public License GNU GENERAL public license")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"base": F.lit(1), "labels": F.lit("x"), "notices": F.lit(2)})
    got = ln.summary(ln.scan(docs)).collect()
    assert len(got) == len(rows)
    for (i, text), r in zip(rows, got):
        n, base = _plain_base(text)
        at = [w for w, _ in base]
        assert (r.doc_id, r.n_words, r.n_base) == (i, n, len(base))
        assert (r.first_word, r.last_word) == ((min(at), max(at)) if at else (None, None))
        assert r.base_labels == ",".join(sorted({x for _, x in base})) and set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1
    assert "all-rights-reserved" in got[5].labels and got[3].score == 0
    assert ln.summary(ln.scan(docs.limit(0))).count() == 0


def test_query_on_given_documents(spark):
    sf_dir = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = registry.queries()["op13_license_scan"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, base = _plain_base(texts[r.doc_id])
        at = [w for w, _ in base]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (n, len(base), min(at, default=None), max(at, default=None))
        assert r.base_labels == ",".join(sorted({x for _, x in base}))
        joined = " ".join(_words(texts[r.doc_id]))
        exact = {label for label, wordings in ln.NOTICES.items() for w in wordings if w in joined}
        assert exact <= set(r.labels.split(","))
