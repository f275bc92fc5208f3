"""Language, exact and near duplicates, repeated lines: against plain versions and known answers."""

import hashlib
import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from orderloom.llm import components, digest_dedup, jaccard, language, line_dedup, registry
from orderloom.llm.common import Staged

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ---- language ---------------------------------------------------------------------------


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang")
    found = registry.queries()["op2_language_id"](spark, SF_DIR).join(docs, "doc_id").collect()
    assert len(found) == 200
    held = [r for r in found if r.held_out]
    assert held and sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in found)


def test_language_of_odd_rows(spark):
    rows = [(1, "the cat and the dog", "en"), (2, "der hund und die katze", "de"), (3, None, "en"), (4, "123 !?", "de"), (5, "", None), (None, "und der", None), (7, "the " * 50_000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("x"))
    model = language.train(language.training_rows(docs, "text", "lang", F.lit(True), F.col("doc_id")))
    got = {r.doc_id: r.lang_pred for r in language.predict(spark, docs, model).collect()}
    assert got == {1: "en", 2: "de", 3: "und", 4: "und", 5: "und", None: "de", 7: "en"}
    assert language.predict(spark, docs.limit(0), model).count() == 0
    nothing = language.train(language.training_rows(docs.limit(0), "text", "lang", F.lit(True), F.col("doc_id")))
    assert {r.lang_pred for r in language.predict(spark, docs, nothing).collect()} == {"und"}


def test_training_sample_is_bounded(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"), F.when(F.col("id") < 2900, "x").otherwise("y").alias("lang"))
    counts = {r["lang"]: r["count"] for r in language.training_rows(docs, "text", "lang", F.lit(True), F.col("doc_id"), 200).groupBy("lang").count().collect()}
    assert 120 < counts["x"] < 280 and counts["y"] == 100


# ---- exact duplicates -------------------------------------------------------------------


@pytest.mark.parametrize("rounds", [1, 2])
@pytest.mark.parametrize("keep", ["max", "min"])
def test_exact_duplicates(spark, rounds, keep):
    rng = random.Random(rounds)
    rows = [(i, rng.choice(["a", "b", "", None, "a ", "é" * 5, "hot", "hot", "hot"])) for i in range(300)] + [(7, "twice"), (7, "twice"), (None, "b"), (None, "alone")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("digest", F.lit(1)).repartition(7)
    got = digest_dedup.mark_duplicates(spark, docs, keep=keep, rounds=rounds).collect()
    assert len(got) == len(rows)
    by_text = defaultdict(list)
    for i, t in rows:
        by_text[hashlib.sha256((t or "").encode()).hexdigest()].append(i)
    for digest, ids in by_text.items():
        own = [r for r in got if r.text_sha256 == digest]
        known = [i for i in ids if i is not None]
        wanted = (max if keep == "max" else min)(known) if known else None
        assert {r.group_size for r in own} == {len(ids)} and {r.keep_id for r in own} == {wanted}
        assert sum(r.kept for r in own) == 1 and next(r.doc_id for r in own if r.kept) == wanted
    assert digest_dedup.mark_duplicates(spark, docs.limit(0)).count() == 0


# ---- near duplicates --------------------------------------------------------------------


def _shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def _plain_classes(rows):
    sets = {i: _shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            holders[g].append(i)
    for i, s in sets.items():
        for j, common in Counter(j for g in s for j in holders[g] if j < i).items():
            if 100 * common >= 75 * (len(s) + len(sets[j]) - common):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def _near_copies():
    rng = random.Random(4)
    vocabulary = ["w%d" % i for i in range(400)]
    rows, passage = [], [rng.choice(vocabulary) for _ in range(40)]
    for size in (1, 2, 3, 60):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([30, 120]))]
        for _ in range(size):
            words = list(base)
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append(" ".join(words))
    # Unrelated documents that share a passage, exact copies, short and empty texts, and a chain of small steps.
    rows += [" ".join([rng.choice(vocabulary) for _ in range(60)] + passage) for _ in range(40)]
    rows += ["same text of a few words"] * 30 + [None, "", "  \n", "one", "One", "two words", "two  WORDS", "Ünï cöde", "ünï cöde"]
    chain = [rng.choice(vocabulary) for _ in range(60)]
    for step in range(8):
        chain[step * 7] = "x%d" % step
        rows.append(" ".join(chain))
    return list(enumerate(rows))


@pytest.mark.parametrize("short", [24, 3])
def test_near_duplicates_equal_a_plain_join(spark, short):
    rows = _near_copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("node", F.lit("x")).repartition(4)
    got = jaccard.document_classes(jaccard.similar(spark, docs, short=short)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == _plain_classes(rows) and len(got) == len(rows)


def test_near_duplicates_with_tiny_tiles_and_salted_columns(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "TILE", 5)
    rows = _near_copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = jaccard.document_classes(jaccard.similar(spark, docs, short=2)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == _plain_classes(rows)


def test_near_duplicates_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.document_classes(jaccard.similar(spark, docs)).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(20)] + [(100, 101), (101, 102), (200, 200)] + [(500, 500 + k) for k in range(1, 40)]
    found = components.components(Staged(spark), spark.createDataFrame(edges, "a long, b long"), "c")
    got = {r.node: r.component for r in found.collect()}
    assert got == {**{i: 0 for i in range(21)}, 100: 100, 101: 100, 102: 100, **{500 + k: 500 for k in range(40)}}


# ---- repeated lines ---------------------------------------------------------------------


def _edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[-1] + 1))
        row = new
    return row[-1]


def _edited(rng, line, letters, most):
    line = list(line)
    for _ in range(rng.randint(0, most)):
        kind, at = rng.randrange(3), rng.randrange(len(line) + 1)
        if kind == 0:
            line.insert(at, rng.choice(letters))
        elif at < len(line):
            line[at : at + 1] = [] if kind == 1 else [rng.choice(letters)]
    return "".join(line)


def test_banded_edit_distance():
    rng = random.Random(5)
    left = ["".join(rng.choice("abé") for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    right = [_edited(rng, s, "abé", 4) for s in left]
    for edits in (1, 2, 3):
        assert line_dedup.within(left, right, edits).tolist() == [_edits(a, b) <= edits for a, b in zip(left, right)]


def test_segments_miss_no_pair():
    rng = random.Random(6)
    for _ in range(1500):
        a = "".join(rng.choice("abc") for _ in range(rng.randint(6, 30)))
        b = _edited(rng, a, "abc", 3)
        if len(b) < 6 or _edits(a, b) > 2:
            continue
        keys, rows, own = line_dedup.postings([a, b], 2, 6)
        of = lambda row, mine: {k for k, r, o in zip(keys.tolist(), rows.tolist(), own.tolist()) if r == row and (o or not mine)}
        assert of(0, True) & of(1, False) or of(0, False) & of(1, True)


@pytest.mark.parametrize("short", [24, 4])
def test_repeated_lines_equal_a_plain_version(spark, short):
    rng = random.Random(7)
    base = "The quick brown fox jumps over the lazy dog"
    rows = []
    for i in range(90):
        lines = [_edited(rng, base, "xyz", 3), "word%d %s tail%d" % (rng.randint(0, 5), base, rng.randint(0, 20)), "short", "", "unique line of document number %d %d" % (i, rng.random() * 1e9)]
        rows.append((i, "\n".join(lines[: rng.randint(1, 5)])))
    rows += [(90, None), (91, ""), (92, "  %s \r" % base), (93, "\n\n")]
    docs = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, node string").repartition(3)
    got = {r.doc_id: (r.text, r._lines_seen, r._lines_dropped) for r in line_dedup.drop_repeated_lines(spark, docs, short=short).collect()}
    places = defaultdict(list)
    for i, text in rows:
        for number, line in line_dedup.lines_of(text or ""):
            places[line].append((i, number))
    lines, root = list(places), list(range(len(places)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(lines):
        for j in range(i):
            if abs(len(a) - len(lines[j])) <= 2 and find(i) != find(j) and _edits(a, lines[j]) <= 2:
                root[find(i)] = find(j)
    classes = defaultdict(list)
    for i, line in enumerate(lines):
        classes[find(i)] += places[line]
    drop = defaultdict(set)
    for own in classes.values():
        for i, number in sorted(own)[1:]:
            drop[i].add(number)
    for i, text in rows:
        kept = text and "\n".join(line for k, line in enumerate(text.split("\n")) if k not in drop[i])
        assert got[i] == (kept, len(line_dedup.lines_of(text or "")), len(drop[i]))
    assert len(got) == len(rows)


def test_short_lines_go_where_they_are_repeated_exactly(spark):
    licence = "All rights reserved."
    near = ["x" * 23, "x" * 22 + "y"]  # within two edits, but too short for edits to count
    texts = [f"{licence}\nfirst\n\n{near[0]}", f"  {licence}\r\nsecond\n\n\n{near[1]}", f"third\n{licence}\nthird", licence, f"{near[0]}\n\n "]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.text, r._lines_seen, r._lines_dropped) for r in line_dedup.drop_repeated_lines(spark, docs).collect()}
    assert got == {0: (texts[0], 3, 0), 1: (f"second\n\n\n{near[1]}", 3, 1), 2: ("third", 3, 2), 3: ("", 1, 1), 4: ("\n ", 1, 1)}


def test_lines_of_one_template_are_dealt_to_several_tasks(spark, monkeypatch):
    rng = random.Random(11)
    template = "entry %s of the very long common template that all of these lines share"
    lines = [template % "".join(rng.choice("0123456789") for _ in range(n)) for n in (8, 8, 8, 9) for _ in range(60)]
    lines += [_edited(rng, x, "xyz", 3) for x in lines[:80]]
    docs = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "doc_id long, text string").repartition(3)
    read = lambda: sorted((r.doc_id, r.text, r._lines_dropped) for r in line_dedup.drop_repeated_lines(spark, docs).collect())
    whole = read()
    monkeypatch.setattr(line_dedup, "HOT", 40)
    monkeypatch.setattr(line_dedup, "TILE", 30)
    plain = line_dedup._Hot(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), {})

    def largest(*args):
        posted = line_dedup._posted(docs.select("text"), 2, 24, 6, *args)
        counts = Counter()
        for r in posted.collect():
            for key in np.frombuffer(r.key, np.uint64).tolist():
                counts[r.block, key] += 1
        return max(counts.values())

    slim = docs.select("doc_id", "text", F.xxhash64("text").alias("version"))
    assert largest(plain) > 200
    # With a sample the count is only roughly known; the result is the same.
    monkeypatch.setattr(line_dedup, "SAMPLE", 4)
    hot = line_dedup._hot(line_dedup._survey(slim, 2, 24))
    assert len(hot.keys) and hot.salts.max() > 1
    assert largest(hot) < 100
    assert read() == whole
    # Shares without a known centre, or without a line that posted, lose nothing.
    monkeypatch.setattr(line_dedup, "_hot", lambda survey: line_dedup._Hot(hot.keys, hot.salts, hot.before, {}))
    assert read() == whole


def test_repeated_lines_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert line_dedup.drop_repeated_lines(spark, docs).count() == 0


def test_a_block_of_the_product_takes_little_memory():
    """A full block, whose columns have eight rows each: what one Python worker holds beside its input."""
    n = jaccard.BLOCK
    shingle = np.repeat(np.arange(n // 8, dtype=np.uint64), 8)
    node = np.random.default_rng(1).integers(0, n // 60, len(shingle))
    size = np.full(len(node), 100, np.int32)
    block = pa.table({"salted": [False], "shingle": [shingle.tobytes()], "node": [node.tobytes()], "size": [size.tobytes()]})
    tracemalloc.start()
    found = jaccard._multiply(75, 24)(None, block)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found.num_rows > n and peak < 300 * 2**20


def test_rows_of_the_product_grow_with_its_entries():
    """A column of near copies gives two rows an entry at most, whatever its length."""
    for rows in (2, 3, 5, 6, 12, 24, 200):
        node = np.arange(rows, dtype=np.int64)
        columns = {"shingle": np.full(rows, 7, np.uint64), "node": node, "size": np.full(rows, 100, np.int32)}
        block = pa.table({"salted": [False], **{k: [v.tobytes()] for k, v in columns.items()}})
        assert rows - 1 <= jaccard._multiply(75, jaccard.SHORT)(None, block).num_rows <= 2 * rows


def test_sets_are_moved_only_where_sketches_allow_a_link(spark, monkeypatch):
    """Unrelated documents that share a passage need no set outside their own task, and one place each in the tiles."""
    rng = random.Random(8)
    passage = ["p%d" % i for i in range(12)]
    rows = [" ".join([f"u{n}x{i}" for i in range(60)] + passage) for n in range(30)]
    near = ["v%d" % i for i in range(80)]
    rows += [" ".join(near), " ".join([*near[:40], rng.choice("abc"), *near[41:]])]
    monkeypatch.setattr(jaccard, "_buckets", lambda documents: 2)  # a table that cannot tell: shared shingles come first
    written, write = {}, jaccard.Staged.write
    monkeypatch.setattr(jaccard.Staged, "write", lambda self, name, df: written.setdefault(name, write(self, name, df)))
    monkeypatch.setattr(jaccard, "_PARTS", 2)
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(3)
    got = jaccard.document_classes(jaccard.similar(spark, docs, short=2)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == _plain_classes(list(enumerate(rows)))
    assert written["mixed-2"].count() > 30
    moved = [df.select("node") for name, df in written.items() if "shingles" in df.columns]
    assert sum(df.count() for df in moved) == 2


def test_sketches_tell_large_sets_apart_and_fold():
    rng = np.random.default_rng(3)
    for n in (0, 1, 900, 1024, 1025, 9_000):
        one, other = (np.unique(rng.integers(0, 2**64, n, np.uint64)) for _ in range(2))
        sketches = [jaccard._parity(s) for s in (one, other)]
        apart = int(np.bitwise_count(jaccard._fold(sketches[0], len(sketches[0])) ^ jaccard._fold(sketches[1], len(sketches[0]))).sum())
        assert apart <= 2 * n and (n < 2 or 175 * apart > 25 * 2 * n)
        plain = np.packbits(np.bincount(one % np.uint64(jaccard._SKETCH), minlength=jaccard._SKETCH) & 1).tobytes()
        assert jaccard._fold(sketches[0], jaccard._SKETCH // 8).tobytes() == plain
