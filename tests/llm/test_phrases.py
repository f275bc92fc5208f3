"""Collocations: against plain counting, with tries that burst and spill, and odd rows."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderloom.llm import collocations
from orderloom.llm.collocations import HatTrie

SCHEMA = "doc_id long, text string, lang string"
CAPITALS = re.compile("[A-Z]")


def _plain(rows, longest=3, least=10, percent=50, top=2000):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        text = CAPITALS.sub(lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang or "und" if lang is None else lang] += len(words)
            for m in range(1, longest + 1):
                for i in range(len(words) - m + 1):
                    f["und" if lang is None else lang][tuple(words[i : i + m])] += 1
    out = []
    for lang, counts in f.items():
        kept = []
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        for p, a in candidates.items():
            cuts = [(1000000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            longer = [b for q, b in candidates.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if not any(100 * b >= percent * a for b in longer):
                kept.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def _rows(seed=1, size=250):
    rng = random.Random(seed)
    words = ["a", "b", "C", "d", "the", "of", "É", "é", "x-y", "\x1c", "\x85", " ", "𝒳", "'", "(e)", "ß"]
    ends = [" ", " ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", "\r\n", ";"]
    rows = [(i, "".join(rng.choice(words) + rng.choice(ends) for _ in range(rng.randrange(40))), rng.choice(["en", "en", "de", None, ""])) for i in range(size)]
    return rows + [(1, "Hot Pair here " * 400, "en")] * 2 + [(None, None, "en"), (None, "", None), (3, "...", "fr"), (4, "a b " * 12, "xx"), (5, "und und und", "und")]


@pytest.mark.parametrize("held, words", [(600_000, 400_000), (7, 400_000), (600_000, 3), (5, 5)])
def test_against_plain_counting(spark, held, words):
    rows = _rows()
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({"n": F.lit("x"), "w1": F.lit(1), "phrase": F.lit(2), "rank": F.lit(3)}).repartition(4)
    got = collocations.collocations(spark, docs, held=held, words=words)
    assert sorted(map(tuple, got.collect())) == _plain(rows)


def test_other_limits(spark):
    rows = _rows(2, 60)
    docs = spark.createDataFrame(rows, SCHEMA)
    for options in ({"least": 3, "percent": 90, "top": 7}, {"longest": 2, "least": 1}):
        wanted = _plain(rows, **options)
        assert sorted(map(tuple, collocations.collocations(spark, docs, **options).collect())) == wanted and wanted
    assert len(collocations.collocations(spark, docs, top=None, least=1).collect()) == len(_plain(rows, least=1, top=None))
    with pytest.raises(ValueError):
        collocations.collocations(spark, docs, longest=4)


def test_empty_table(spark):
    docs = spark.createDataFrame(_rows(), SCHEMA)
    assert collocations.collocations(spark, docs.limit(0)).count() == 0
    assert collocations.collocations(spark, docs.where("text is null or text = '...'")).count() == 0


def test_very_long_text(spark):
    rng = random.Random(4)
    text = " ".join(rng.choice(["aa", "bb", "cc", "dd", "e" * 300, "f."]) for _ in range(90_000))
    assert len(text) > 2 * collocations.BLOCK
    rows = [(1, text, "en"), (2, "e" * (2 * collocations.BLOCK), "en")]
    got = collocations.collocations(spark, spark.createDataFrame(rows, SCHEMA))
    assert sorted(map(tuple, got.collect())) == _plain(rows)


def test_exact_scores_beyond_64_bits(spark):
    a, left, right = 3_000_000_000_000, 3_000_000_000_007, 4_000_000_000_001
    frequent = spark.createDataFrame([("en", 2, "x y", a), ("en", 1, "x", left), ("en", 1, "y", right)], "lang string, width int, phrase string, a long")
    totals = spark.createDataFrame([("en", 9 * 10**12)], "lang string, total long")
    row = collocations._ranked(frequent, totals, 50, None).first()
    assert row.score == 1000000 * a * a // (left * right) and (row.l, row.r, row.n) == (left, right, 9 * 10**12)


def _packed(phrases):
    out = np.zeros(len(phrases), np.int64)
    for column in np.array(phrases).T:
        out = out << 21 | column
    return out


@pytest.mark.parametrize("width", [1, 2, 3])
def test_trie_bursts_and_spills_whole_subtrees(width):
    rng = random.Random(width)
    trie, total, taken, spills = HatTrie(width, burst=5), Counter(), Counter(), 0
    for _ in range(60):
        batch = Counter(tuple(min(rng.randrange(2, 3000), rng.randrange(2, 3000)) for _ in range(width)) for _ in range(100))
        phrases = list(batch)
        trie.add(_packed(phrases), np.array([batch[p] for p in phrases]))
        total.update({int(k): batch[p] for k, p in zip(_packed(phrases), phrases)})
        if trie.size > 700:
            assert isinstance(trie.root, collocations.Node)
            keys, counts = trie.take(350)
            spills += 1
            assert len(set(keys.tolist())) == len(keys) and trie.size <= 350
            # No phrase is left whose first word agrees in the first digits with a spilled one.
            assert not set((keys >> 21 * (width - 1) & 63).tolist()) & set(trie.root.children)
            taken.update(dict(zip(keys.tolist(), counts.tolist())))
    assert spills > 2 and any(isinstance(c, collocations.Node) for c in trie.root.children.values())
    keys, counts = trie.take(0)
    taken.update(dict(zip(keys.tolist(), counts.tolist())))
    assert taken == total and trie.size == 0


def test_container_grows_and_keeps_counts():
    rng, box, total = random.Random(9), collocations.Box(4), Counter()
    for _ in range(50):
        batch = Counter(rng.choice([rng.randrange(50), rng.randrange(1 << 62)]) for _ in range(rng.randrange(1, 200)))
        box.add(np.array(list(batch), np.int64), np.array(list(batch.values()), np.int64))
        total.update(batch)
    keys, counts = box.entries()
    assert dict(zip(keys.tolist(), counts.tolist())) == total and box.size == len(total)
