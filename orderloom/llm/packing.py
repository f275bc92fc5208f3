"""Packing of tokenised documents into sequences of a fixed length, by the length histogram.

Documents are cut into pieces of at most the sequence length. Pieces are counted by length: that
histogram has one entry per length whatever the size of the corpus, and it alone goes to the driver.
There patterns are built, longest pieces first; a piece goes on the shortest pack that it fits on,
and all equal packs are extended at once by counting. A pattern says which lengths a sequence holds.
Pieces are numbered within their length, in two steps (within the task that cut them, then over tasks,
so that no task holds a whole length), and the number tells the sequence and the place in it.
"""

from __future__ import annotations

import heapq
import json
import re
from collections import defaultdict
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderloom.llm.bpe import AT_ONCE, Vocabulary, vocabulary
from orderloom.llm.common import Staged, chunks, id_text, texts_of

SEQUENCE = 2048
END_ID = 1

#: One run of equal pieces in a pattern: pieces of this length, numbered from rank_from to rank_to, lie in
#: sequences from sequence_from on, `copies` of them in each, the first of them at offset_from.
SLOTS = "length long, rank_from long, rank_to long, sequence_from long, offset_from long, copies long"


def added_tokens(json_path: str) -> dict[str, int]:
    """Text and id of the added tokens of a `tokenizers` file, which that library matches in texts before all else."""
    found = json.loads(Path(json_path).read_text(encoding="utf-8"))["added_tokens"]
    for token in found:
        if token["single_word"] or token["lstrip"] or token["rstrip"]:
            raise ValueError(f"added token {token['content']!r} asks for more than a plain match")
    return {token["content"]: token["id"] for token in found}


def _encode(words: Vocabulary, texts: list[str], added: dict[str, int]) -> Iterator[bytes]:
    """The ids of every text; added tokens get their own id, and what lies between them is encoded by itself."""
    if not added:
        yield from (packed for packed, _, _ in words.encode(texts))
        return
    marks = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")")
    cuts = [marks.split(text) for text in texts]
    packed = (ids for ids, _, _ in words.encode([part for cut in cuts for part in cut[::2]]))
    for cut in cuts:
        yield b"".join(np.uint32(added[part]).tobytes() if i % 2 else next(packed) for i, part in enumerate(cut))


def pieces(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text", max_tokens: int = SEQUENCE, end_id: int = END_ID, added: dict[str, int] | None = None) -> DataFrame:
    """Every document's ids, ended by `end_id` and cut into pieces of at most `max_tokens`.

    Texts of the tokens in `added` become their ids; without it they are encoded as ordinary text.

    Columns: doc_id, start, length, doc_tokens, ids (binary, little-endian unsigned 32-bit), and task and
    nth, which number the pieces of a length within the task. A null or empty text gives the end id alone.
    """
    source = id_text(docs, id_col, text_col)
    kind = source.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "start", "length", "doc_tokens", "ids", "task", "nth"]
    size = max_tokens * 4

    def run(batches):
        words = vocabulary(ranks_path)
        task, seen = TaskContext.get().partitionId(), defaultdict(int)
        last = np.uint32(end_id).tobytes()
        for batch in batches:
            texts = texts_of(batch.column("text"))
            row = 0
            for start, end in chunks(texts, AT_ONCE):
                rows, cut = [], []
                for packed in _encode(words, texts[start:end], added or {}):
                    packed += last
                    for at in range(0, len(packed), size):
                        part = packed[at : at + size]
                        length = len(part) // 4
                        cut.append((at // 4, length, len(packed) // 4, part, task, seen[length]))
                        seen[length] += 1
                        rows.append(row)
                    row += 1
                columns = [batch.column("doc_id").take(pa.array(rows, pa.int64()))]
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
                columns += [pa.array(x, k) for x, k in zip(zip(*cut), kinds)]
                yield pa.RecordBatch.from_arrays(columns, names)

    return source.mapInArrow(run, f"doc_id {kind}, start long, length long, doc_tokens long, ids binary, task long, nth long")


def patterns(histogram: dict[int, int], max_tokens: int = SEQUENCE) -> list[tuple[list[tuple[int, int]], int]]:
    """Patterns ([(length, copies), ...], number of packs) that hold every piece of the histogram once.

    There are at most about two patterns per length: each length splits one pattern at most and opens two.
    """
    by_room: dict[int, list[tuple[list[tuple[int, int]], int]]] = defaultdict(list)
    rooms: list[int] = []

    def put(room: int, pattern: list[tuple[int, int]], packs: int) -> None:
        if not by_room[room]:
            heapq.heappush(rooms, -room)
        by_room[room].append((pattern, packs))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left and rooms and -rooms[0] >= length:
            room = -rooms[0]
            pattern, packs = by_room[room].pop()
            if not by_room[room]:
                heapq.heappop(rooms)
            used = min(left, packs)
            if packs > used:
                put(room, pattern, packs - used)
            more = [*pattern[:-1], (length, pattern[-1][1] + 1)] if pattern[-1][0] == length else [*pattern, (length, 1)]
            put(room - length, more, used)
            left -= used
        if left:
            full, rest = divmod(left, max_tokens // length)
            if full:
                put(max_tokens - length * (max_tokens // length), [(length, max_tokens // length)], full)
            if rest:
                put(max_tokens - length * rest, [(length, rest)], 1)
    return [x for room in sorted(by_room) for x in by_room[room]]


def slots(found: list[tuple[list[tuple[int, int]], int]]) -> list[tuple[int, ...]]:
    """Rows of SLOTS: ranks of a length are dealt to the patterns in order."""
    rank: dict[int, int] = defaultdict(int)
    sequence, rows = 0, []
    for pattern, packs in found:
        offset = 0
        for length, copies in pattern:
            first = rank[length]
            rank[length] += copies * packs
            rows.append((length, first, rank[length], sequence, offset, copies))
            offset += length * copies
        sequence += packs
    return rows


def place(spark: SparkSession, cut: DataFrame, max_tokens: int = SEQUENCE) -> DataFrame:
    """The pieces of `pieces()`, with sequence_id and offset in place of task and nth; other columns stay.

    Offsets in a sequence are gapless from 0. An empty table stays empty. The number of a sequence depends
    on how rows were dealt to tasks; which lengths a sequence holds does not.
    """
    staged = Staged(spark)
    cut = staged.write("pieces", cut)
    counts = staged.write("counts", cut.groupBy("length", "task").agg(F.count("*").alias("n")))
    # Bounded by the sequence length: one row per length.
    histogram = {row["length"]: row["n"] for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    dealt = spark.createDataFrame(slots(patterns(histogram, max_tokens)), SLOTS)
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before"))
    # The counts grow with the number of tasks: never broadcast, whatever their file size suggests.
    ranked = cut.join(before.hint("merge"), ["length", "task"]).withColumn("_rank", F.col("_before") + F.col("nth"))
    # The slots depend on the sequence length only, so they are small on any corpus.
    slot = F.broadcast(dealt.withColumnRenamed("length", "_length"))
    inside = F.col("_rank") - F.col("rank_from")
    return (
        ranked.join(slot, (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("rank_from")) & (F.col("_rank") < F.col("rank_to")))
        .withColumn("sequence_id", F.col("sequence_from") + F.expr("(_rank - rank_from) div copies"))
        .withColumn("offset", F.col("offset_from") + (inside % F.col("copies")) * F.col("length"))
        .drop("task", "nth", "_before", "_rank", "_length", "rank_from", "rank_to", "sequence_from", "offset_from", "copies")
    )


def sequences(placed: DataFrame, max_tokens: int = SEQUENCE, pad_id: int = 0) -> DataFrame:
    """One row per sequence: sequence_id, its ids (binary, padded with `pad_id`), doc_ids and how many ids are used."""
    part = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "length", "ids")))
    whole = placed.groupBy("sequence_id").agg(part.alias("parts"), F.sum("length").alias("used"))
    ids = F.expr("aggregate(parts, cast('' as binary), (a, x) -> concat(a, x.ids))")
    pad = F.expr(f"unhex(repeat('{np.uint32(pad_id).tobytes().hex()}', cast({max_tokens} - used as int)))")
    return whole.select("sequence_id", F.concat(ids, pad).alias("ids"), F.col("parts.doc_id").alias("doc_ids"), "used")
