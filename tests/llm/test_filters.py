"""The filter audit: against a plain version over all orders, with hash clashes and odd rows."""

import random
import re
from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from orderloom.llm import filter_audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string"


def _plain_masks(rows):
    first = {}
    for i, text, _ in rows:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    for i, text, lang in rows:
        text = text or ""
        words = WORD.findall(text)
        fails = [
            len(words) < 100,
            100 * len(set(words)) < 80 * len(words),
            100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            bool(re.search(r"[#$%&*|]", text)),
            i is not None and i > first[text],
        ]
        yield i, lang or "", frozenset(x for x, f in zip("ABCDE", fails) if f)


def _plain(rows, labels):
    quality = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    masks = list(_plain_masks(rows))
    out = []
    for part in {m[1] for m in masks}:
        own = [m for m in masks if m[1] == part]
        shapley = Counter()
        steps = []
        for order in permutations("ABCDE"):
            left = own
            for step, x in enumerate(order, 1):
                removed = [m for m in left if x in m[2]]
                left = [m for m in left if x not in m[2]]
                shapley[x] += len(removed)
                redundant = sum(x in m[2] for m in own) - len(removed)
                unique = sum(m[2] == {x} for m in own)
                steps.append((part, "".join(order), step, len(left), len(removed), redundant, unique, sum(m[0] in quality for m in removed), sum(m[0] in toxic for m in removed), x))
        out += [(*s[:-1], shapley[s[-1]]) for s in steps]
    return sorted(out)


def _rows():
    rng = random.Random(3)
    long = " ".join(f"w{i}" for i in range(120))
    texts = [long, long + " #", "Aa " * 150, "BIG WORDS", "", None, "w\tw w", long.upper(), "é" * 5, "a b", " ", "𝒳 " * 101, "x|y"]
    rows = [(i, rng.choice(texts), rng.choice(["en", "de", None, ""])) for i in range(400)]
    rows += [(7, "a b", "en"), (7, "a b", "en"), (900, "twice", "fr"), (900, "twice", "fr"), (None, "a b", "en"), (None, "alone", "de"), (None, "later", "de"), (901, "later", "de"), (902, long + " word" * 500_000, "en")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 400, 3)] + [(7, 1, 0), (7, 0, 1), (None, 1, 1), (5000, 1, 1)]
    return rows, labels


@pytest.mark.parametrize("bits", [64, 2, 0])
def test_every_order_against_a_plain_version(spark, bits):
    rows, labels = _rows()
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({"mask": F.lit("x"), "hash": F.lit(1), "part": F.lit(2), "n": F.lit(3)}).repartition(5)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("part", F.lit("y"))
    few = F.xxhash64 if bits == 64 else lambda c: F.xxhash64(c) % (1 << bits)  # weak hashes: different texts clash
    masks = filter_audit.document_masks(spark, docs, hash_text=few)
    got = filter_audit.every_order(filter_audit.mask_counts(masks, known), "ABCDE")
    assert sorted(tuple(r) for r in got.collect()) == _plain(rows, labels)


def test_masks_of_rows(spark):
    rows, _ = _rows()
    got = filter_audit.document_masks(spark, spark.createDataFrame(rows, SCHEMA)).collect()
    wanted = [(i, p, sum(1 << "ABCDE".index(x) for x in m)) for i, p, m in _plain_masks(rows)]
    assert Counter(map(tuple, got)) == Counter(wanted)


def test_other_filters_and_no_labels_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "ab", "x"), (2, "ab", "x"), (3, "a", "x")], SCHEMA)
    masks = filter_audit.document_masks(spark, docs, failed=lambda t: int("b" in t), filters=1)
    assert sorted((r.doc_id, r.mask) for r in masks.collect()) == [(1, 1), (2, 3), (3, 0)]
    rows = filter_audit.every_order(filter_audit.mask_counts(masks, None), "BE").orderBy("filter_order", "step").collect()
    assert [(r.filter_order, r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.shapley) for r in rows] == [
        ("BE", 1, 2, 0, 1, 0, 3), ("BE", 1, 0, 1, 0, 0, 1), ("EB", 2, 1, 0, 0, 0, 1), ("EB", 1, 1, 1, 1, 0, 3),
    ]
    assert filter_audit.audit(spark, docs.limit(0)).count() == 0


def test_unique_texts_are_cleared_by_the_sketch(spark):
    hashes = spark.range(40_000).select(F.xxhash64(F.when(F.col("id") < 100, F.col("id") % 10).otherwise(F.col("id"))).alias("hash")).repartition(6)
    segments = -(-40_000 * filter_audit.CELLS_PER_ROW // filter_audit.SEGMENT)
    shared = filter_audit.shared_cells(hashes, segments)
    found = {r.hash for r in filter_audit.possible_repeats(hashes, shared, segments).collect()}
    repeated = {r.hash for r in hashes.groupBy("hash").count().where("count > 1").collect()}
    assert segments == 3 and repeated <= found and len(found) < 0.05 * 40_000
