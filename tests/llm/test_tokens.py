"""Byte-level BPE and packing against the public libraries."""

import base64
import random
import tracemalloc
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from orderloom.llm import bpe, packing

RANKS = P.path("byte_bpe_50k.tiktoken")
TEXTS = [
    None, "", " ", "  ", "a", "it's", "'s", " 's", "!'s", "''s", "x'rest 'll'd", "\n\n a", " \n", "a \n\tb", "a\xa0b", "1 2  3",
    "é  ñ?!", "日本語です 123", "🙂🙂 ok", "<|endoftext|> x", "a\x00b", "٣x²½", "ab" * 300, "aaaa" * 700, "a\r\n\r\nHi  there ",
]


@pytest.fixture(scope="module")
def tiktoken_encoding():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _random_texts(n):
    rng = random.Random(1)
    letters = "ab'srvelmtd  \n\t1!é\xa0?"
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_ids_are_those_of_the_library(tiktoken_encoding):
    words = bpe.Vocabulary(RANKS)
    texts = [t or "" for t in TEXTS] + _random_texts(5000)
    got = [np.frombuffer(ids, "<u4").tolist() for ids, _, _ in words.encode(texts)]
    assert got == [tiktoken_encoding.encode_ordinary(t) for t in texts]
    assert [words.decode(np.array(x, "<u4").tobytes()).decode() for x in got] == texts


def test_cache_may_be_emptied_at_any_time(tiktoken_encoding, monkeypatch):
    monkeypatch.setattr(bpe.Vocabulary, "CACHE", 3)
    words = bpe.Vocabulary(RANKS)
    for text in _random_texts(300):
        ids = next(iter(words.encode([text])), (b"",))[0]
        assert np.frombuffer(ids, "<u4").tolist() == tiktoken_encoding.encode_ordinary(text)


def test_encoding_many_texts_takes_little_memory():
    """What a Python worker holds while it encodes a batch of a million characters."""
    rng = random.Random(2)
    texts = [" ".join(f"{rng.randrange(16**8):08x}" for _ in range(1000)) for _ in range(110)]
    words = bpe.Vocabulary(RANKS)
    list(words.encode(texts[:1]))
    tracemalloc.start()
    tokens = sum(int(counts.sum()) for _, _, counts in words.encode(texts))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert tokens > 300_000 and peak < 50 * 2**20


def test_tables_with_nulls_repeats_and_further_columns(spark, tiktoken_encoding):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, "a b", "y"), (1, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    encoded = bpe.encode(docs, RANKS, offsets=True)
    got = bpe.decode(encoded, RANKS, keep=("n_tokens",)).collect()
    assert sorted((r.doc_id or -1, bytes(r.decoded)) for r in got) == sorted((i or -1, (t or "").encode()) for i, t, _ in rows)
    for row in encoded.collect():
        assert sum(row.slice_tokens) == row.n_tokens and len(row.slice_starts) == len(row.slice_tokens)
    whole = bpe.round_trip(docs, RANKS).collect()
    assert sorted((bytes(r.ids), r.n_tokens, bytes(r.decoded)) for r in whole) == sorted(
        (bytes(r.ids), r.n_tokens, d) for r in encoded.collect() for d in [bpe.Vocabulary.decode(bpe.vocabulary(RANKS), bytes(r.ids))]
    )
    assert bpe.round_trip(docs.limit(0), RANKS).count() == 0


def test_patterns_hold_every_piece_once():
    rng = random.Random(2)
    for _ in range(50):
        histogram = {rng.randint(1, 64): rng.randint(1, 200) for _ in range(rng.randint(1, 30))}
        found = packing.patterns(histogram, 64)
        held = {}
        for pattern, packs in found:
            assert sum(length * copies for length, copies in pattern) <= 64 and packs > 0
            for length, copies in pattern:
                held[length] = held.get(length, 0) + copies * packs
        assert held == histogram
        assert len(found) <= 3 * len(histogram)
    assert packing.patterns({}, 64) == []


def test_packing_is_gapless_and_whole(spark):
    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    texts = TEXTS + [" ".join(["word"] * n) for n in (3, 3, 3, 40, 90, 200)] + ["same text here"] * 40
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, sequence_id int").repartition(5)
    placed = packing.place(spark, packing.pieces(docs, RANKS, max_tokens=32), max_tokens=32)
    rows = placed.collect()
    by_sequence, by_doc = {}, {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append(r)
        by_doc.setdefault(r.doc_id, []).append(r)
    for parts in by_sequence.values():
        parts.sort(key=lambda r: r.offset)
        assert [p.offset for p in parts] == [sum(q.length for q in parts[:i]) for i in range(len(parts))]
        assert sum(p.length for p in parts) <= 32
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for i, text in enumerate(texts):
        parts = sorted(by_doc[i], key=lambda r: r.start)
        ids = np.frombuffer(b"".join(bytes(p.ids) for p in parts), "<u4").tolist()
        assert ids == tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        assert [p.start for p in parts] == [sum(q.length for q in parts[:k]) for k in range(len(parts))]
    used = sum(r.length for r in rows)
    assert used / (32 * len(by_sequence)) > 0.9
    packed = packing.sequences(placed, 32).collect()
    assert sum(r.used for r in packed) == used and all(len(r.ids) == 128 for r in packed)
    assert packing.place(spark, packing.pieces(docs.limit(0), RANKS)).count() == 0


def test_queries_match_added_tokens_as_the_library_does(spark, tmp_path):
    import corpus_pipeline
    from orderloom.llm import registry

    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    mark = "<|endoftext|>"
    texts = [f"a {mark} x", mark, f"{mark}{mark} b's", f"\n {mark}\n{mark[:-1]}", f"{mark}é" * 600, f"<{mark}>", "plain", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    ids = {i: np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4") for i, t in enumerate(texts)}
    assert ids[0].tolist() == [64, 220, 50256, 2124, 1]
    for placed in (registry.queries()["op1_packing"](spark, str(tmp_path)), corpus_pipeline.pack(spark, docs, "")):
        rows = placed.collect()
        assert all(zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes()) == r.ids_crc32 for r in rows)
        assert all(r.doc_tokens == len(ids[r.doc_id]) for r in rows) and sum(r.length for r in rows) == sum(map(len, ids.values()))


def test_query_agrees_with_the_library(spark):
    from orderloom.llm import registry

    sf_dir = "/root/testdata/sf0.001"
    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = registry.queries()["op1_packing"](spark, sf_dir).collect()
    ids = {i: np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4") for i, t in texts.items()}
    assert all(zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes()) == r.ids_crc32 for r in rows)
    assert sum(r.length for r in rows) == sum(map(len, ids.values()))
