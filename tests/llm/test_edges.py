"""Cases at the edge: missing and repeated identifiers, clashing columns, very long texts, plans that must not grow."""

import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

from orderloom.llm import bpe, digest_dedup, jaccard, line_dedup, packing, topk

RANKS = P.path("byte_bpe_50k.tiktoken")
SCHEMA = "doc_id long, text string"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---- near duplicates --------------------------------------------------------------------


def _chain():
    """Three texts of which the first two and the last two are alike, but not the outer ones."""
    first = [f"w{i}" for i in range(40)]
    middle = first[:-3] + ["x", "y", "z"]
    return " ".join(first), " ".join(middle), " ".join(["p", "q", "r"] + middle[3:])


@pytest.mark.parametrize("short", [24, 1])
@pytest.mark.parametrize("bridge", [None, 1, 2, 50])
def test_links_lead_through_any_identifier(spark, bridge, short):
    a, n, b = _chain()
    other = " ".join(f"u{i}" for i in range(30))
    rows = [(1, a), (bridge, n), (2, b), (2, b), (60, other), (60, a), (None, other), (None, None), (None, "alone in the world today"), (70, None)]
    found = jaccard.document_classes(jaccard.similar(spark, spark.createDataFrame(rows, SCHEMA).repartition(3), short=short)).collect()
    got = sorted((r.n_shingles, r.doc_id or 0, r.component_id or 0) for r in found)
    linked = [(36, i or 0, 1) for i in (1, bridge, 2, 2, 60)]
    assert got == sorted([*linked, (26, 60, 60), (26, 0, 60), (0, 0, 0), (0, 70, 70), (1, 0, 0)])


# ---- repeated lines -----------------------------------------------------------------------


def test_lines_beside_columns_of_any_name(spark):
    long = "this is a line of more than twenty-four characters"
    rows = [(1, f"{long}\nkept in the first"), (2, f"{long}!\nonly here"), (2, f"{long}!\nonly here"), (None, f"x{long}\nno identifier"), (3, None), (None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    plain = line_dedup.drop_repeated_lines(spark, docs)
    names = ["_drop", "drop", "_version", "version", "n_lines", "_plan_id", "node", "number", "stays"]
    wide = docs.withColumns({n: F.lit(f"own {n}") for n in names} | {"_lines_seen": F.lit("x"), "_lines_dropped": F.lit("y")})
    got = line_dedup.drop_repeated_lines(spark, wide)
    assert got.columns == ["doc_id", "text", *names, "_lines_seen", "_lines_dropped"]
    key = lambda r: (r.doc_id or 0, r.text or "", r._lines_seen, r._lines_dropped)
    assert sorted(map(key, got.collect())) == sorted(map(key, plain.collect()))
    assert {getattr(r, n) for r in got.collect() for n in names} == {f"own {n}" for n in names}
    # The first place stays; rows that repeat identifier and text are treated alike; null identifiers come last.
    texts = sorted((r.doc_id or 0, r.text or "") for r in plain.collect())
    assert texts == sorted([(1, f"{long}\nkept in the first"), (2, "only here"), (2, "only here"), (0, "no identifier"), (3, ""), (0, "")])


# ---- very long texts ----------------------------------------------------------------------


@pytest.fixture(scope="module")
def long_texts():
    """Texts beyond what is handled at once: words, one slice without an end, and lines."""
    rng = random.Random(7)
    words = " ".join(rng.choice(["alpha", "beta", "é", "12", "γδ", "it's"]) + str(rng.randrange(3000)) for _ in range(160_000))
    slice_ = "a" * 1_200_000
    lines = "\n".join(f"line number {i % 30_000} of a long text with enough characters {i % 30_000}" for i in range(36_000))
    assert min(map(len, (words, slice_, lines))) > 1_000_000
    return [words, slice_, lines]


def test_very_long_texts_are_encoded_and_packed(spark, long_texts):
    import base64

    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = [long_texts[0], long_texts[2], "short"]  # the library takes minutes for one endless slice
    docs = spark.createDataFrame(list(enumerate([*texts, long_texts[1]])), SCHEMA)
    got = {r.doc_id: r for r in bpe.round_trip(docs, RANKS).collect()}
    for i, text in enumerate(texts):
        assert np.frombuffer(got[i].ids, "<u4").tolist() == library.encode_ordinary(text)
    assert all(bytes(got[i].decoded).decode() == t for i, t in enumerate([*texts, long_texts[1]]))
    placed = packing.place(spark, packing.pieces(docs, RANKS)).groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("m")).collect()
    assert all(r.n == r.m == got[r.doc_id].n_tokens + 1 for r in placed) and len(placed) == 4


def test_very_long_texts_are_compared(spark, long_texts):
    near = long_texts[0].replace("alpha1 ", "omega1 ")
    assert near != long_texts[0]
    docs = spark.createDataFrame([(1, long_texts[0]), (2, near), (3, long_texts[2]), (4, long_texts[1])], SCHEMA)
    got = {r.doc_id: r.component_id for r in jaccard.document_classes(jaccard.similar(spark, docs)).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4}


def test_lines_of_a_very_long_text(spark, long_texts):
    distinct = [f"entry {''.join(random.Random(i).choices('abcdefghijklmnop', k=30))}" for i in range(30_000)]
    text = "\n".join(distinct + distinct[:5])
    row = line_dedup.drop_repeated_lines(spark, spark.createDataFrame([(1, text)], SCHEMA)).first()
    assert len(text) > 1_000_000 and row.text == "\n".join(distinct) and (row._lines_seen, row._lines_dropped) == (30_005, 5)


# ---- offsets of slices ----------------------------------------------------------------------


def test_decoding_fails_where_an_offset_is_wrong():
    words = bpe.Vocabulary(RANKS)
    text = "it's  a é🙂 日本 test 123\n"
    ids, starts, counts = next(iter(words.encode([text])))
    assert words.decode_slices(ids, starts, counts).decode() == text
    for at in range(len(starts)):
        one = np.eye(len(starts), dtype=np.int64)[at]
        wrong = [(starts + one, counts), (starts, counts + one)]
        if at:  # an id that is said to belong to the slice before
            wrong.append((starts, counts + np.eye(len(starts), dtype=np.int64)[at - 1] - one))
        for bad_starts, bad_counts in wrong:
            with pytest.raises(ValueError):
                words.decode_slices(ids, bad_starts, bad_counts)


def test_slices_move_between_generations_of_the_cache(monkeypatch):
    monkeypatch.setattr(bpe.Vocabulary, "CACHE", 40)
    words, rng, merged = bpe.Vocabulary(RANKS), random.Random(2), []
    plain = words.merge_many
    monkeypatch.setattr(words, "merge_many", lambda pieces: merged.extend(pieces) or plain(pieces))
    for _ in range(400):
        text = " ".join(["so"] + [rng.choice(["often", "seen", f"rare{rng.randrange(10**6)}"]) for _ in range(12)])
        ids, starts, counts = next(iter(words.encode([text])))
        assert words.decode_slices(ids, starts, counts).decode() == text
    assert merged.count(b" often") == 1 and len(words.cache) <= 40  # kept through every change of generation


# ---- plans ------------------------------------------------------------------------------


def test_vectors_are_never_broadcast(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES", 20)
    monkeypatch.setattr(topk, "QUERIES", 10)
    rng = np.random.default_rng(3)
    values = rng.integers(-50, 50, (300, 8))
    table = spark.createDataFrame([(i, (v / 256).tolist()) for i, v in enumerate(values)], "vec_id long, embedding array<double>").repartition(5)
    found = topk.top_k(spark, table, F.col("vec_id") % 7 == 0, k=3)
    assert "BroadcastHashJoin" not in _plan(found) and "BroadcastExchange" not in _plan(found)
    rows = sorted(map(tuple, found.collect()))
    assert "BroadcastExchange" not in _plan(found)  # nor once sizes are known
    scores = values @ values.T
    wanted = []
    for q in range(0, 300, 7):
        best = sorted((-int(scores[q, x]), x) for x in range(300) if x != q)[:3]
        wanted += [(q, i, x, -s) for i, (s, x) in enumerate(best, 1)]
    assert rows == sorted(wanted)


def test_a_round_of_digest_runs_moves_each_entry_once(spark):
    docs = spark.createDataFrame([(i, f"t{i % 7}") for i in range(50)], SCHEMA)
    seen = []
    plain = digest_dedup.Staged.write

    def write(self, name, df):
        if name == "merged":
            seen.append(_plan(df))
        return plain(self, name, df)

    digest_dedup.Staged.write = write
    try:
        assert digest_dedup.mark_duplicates(spark, docs, rounds=2).where("kept").count() == 7
    finally:
        digest_dedup.Staged.write = plain
    exchanges = [line for line in seen[0].splitlines() if "Exchange" in line]
    assert len(exchanges) == 2 and all("hashpartitioning(at#" in line and "digest" not in line for line in exchanges), exchanges
