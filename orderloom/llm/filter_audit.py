"""What each filter of a sequence removes, in every order of the filters, and what the filters share.

Each text fails a set of filters, noted as a mask. Masks add up: the counts of documents by mask answer every
question about every order, so the corpus is read for masks only and the orders are worked out on 32 counts.

The filter for repeats asks for the smallest identifier among equal texts, over the whole table. A prepass with a
counting Bloom filter spares most texts that question: every task counts the cells of its texts' hashes, the
sketches are merged segment by segment, and a text with a cell that only one row counted is unique for certain.
The segments grow in number with the rows, each of a fixed size, so that the filter clears as well at any size.
Only texts that may occur again are shuffled, in full and summed up before it; equal hashes are never taken for
equal texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm.common import Staged, ship, texts_of
from orderloom.llm.membership import bitmap, probably_in
from orderloom.llm.shingles import mix

#: Cells of a segment of the counting filter, and cells for each row of the table.
SEGMENT, CELLS_PER_ROW = 1 << 18, 16
#: Hashes that a task counts before it hands on a partial sketch.
HELD = 1 << 20

_CAPITALS = bytes(range(65, 91))
# Fixed values of the contract: characters of the filter for symbols.
_SYMBOLS = b"#$%&*|"


def failed_filters(text: str) -> int:
    """Bits 0 to 3 for the filters A to D that a text fails: short, repetitive, shouting, with symbols.

    A: under 100 words. B: under 80 % distinct words. C: over 10 % capitals A to Z. D: any of #$%&*|.
    """
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # at the six ASCII blanks
    return (
        (len(words) < 100)
        | (100 * len(set(words)) < 80 * len(words)) << 1
        | (100 * (len(raw) - len(raw.translate(None, _CAPITALS))) > 10 * len(text)) << 2
        | (len(raw) != len(raw.translate(None, _SYMBOLS))) << 3
    )


def _surveyed(rows: DataFrame, failed: Callable[[str], int], keep_text: bool = False) -> DataFrame:
    """doc_id, part, hash, mask of every row of `rows` (doc_id, part, hash, text); and the text, where asked for."""
    names = ["doc_id", "part", "hash"] + ["text"] * keep_text
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}

    def run(batches):
        for batch in batches:
            masks = pa.array([failed(t) for t in texts_of(batch.column("text"))], pa.int32())
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), masks], [*names, "mask"])

    return rows.mapInArrow(run, ", ".join(f"{n} {kinds[n]}" for n in names) + ", mask int")


def _cells(hashes: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """The two cells of each hash, both in one segment, numbered over all segments."""
    scattered = mix(hashes.view(np.uint64) ^ np.uint64(0x5851F42D4C957F2D))
    base = (mix(scattered) % np.uint64(segments)) * np.uint64(SEGMENT)
    low = scattered & np.uint64(SEGMENT - 1)
    step = (scattered >> np.uint64(32)) % np.uint64(SEGMENT - 1) + np.uint64(1)  # the cells of a hash differ
    return (base + low).astype(np.int64), (base + (low + step) % np.uint64(SEGMENT)).astype(np.int64)


def shared_cells(hashes: DataFrame, segments: int) -> DataFrame:
    """cell: those that rows of `hashes` (hash) counted at least twice, from sketches merged by segment.

    A partial sketch is the cells that a task met, with counts up to 2; however often a text occurs in it, a task
    hands on its two cells once. A segment holds about SEGMENT / CELLS_PER_ROW different texts.
    """

    def count(batches):
        held: list[np.ndarray] = []

        def flush():
            cell, times = np.unique(np.concatenate([c for h in held for c in _cells(h, segments)]), return_counts=True)
            cuts = np.flatnonzero(np.diff(cell // SEGMENT)) + 1
            parts = list(zip(np.split(cell, cuts), np.split(np.minimum(times, 2), cuts)))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([int(c[0]) // SEGMENT for c, _ in parts], pa.int64()),
                    pa.array([(c % SEGMENT).astype(np.uint32).tobytes() for c, _ in parts], pa.binary()),
                    pa.array([t.astype(np.uint8).tobytes() for _, t in parts], pa.binary()),
                ],
                ["segment", "cells", "times"],
            )

        for batch in batches:
            held.append(batch.column("hash").to_numpy(zero_copy_only=False).astype(np.int64))
            if sum(map(len, held)) >= HELD:
                yield flush()
                held = []
        if sum(map(len, held)):
            yield flush()

    def merge(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SEGMENT, np.uint8)
        for batch in batches:
            for cells, times in zip(batch.column("cells"), batch.column("times")):
                at = np.frombuffer(cells.as_buffer(), np.uint32)
                total[at] = np.minimum(total[at] + np.frombuffer(times.as_buffer(), np.uint8), 2)
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(total == 2) + key[0].as_py() * SEGMENT, pa.int64())], ["cell"])

    partial = hashes.select("hash").mapInArrow(count, "segment long, cells binary, times binary")
    return partial.groupBy("segment").applyInArrow(merge, "cell long")


def possible_repeats(hashes: DataFrame, shared: DataFrame, segments: int) -> DataFrame:
    """hash: distinct ones of `hashes` both of whose cells are shared; all others are of unique texts."""

    def run(batches):
        for batch in batches:
            own = np.unique(batch.column("hash").to_numpy(zero_copy_only=False).astype(np.int64))
            first, second = _cells(own, segments)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (own, first, second)], ["hash", "first", "second"])

    probes = hashes.select("hash").mapInArrow(run, "hash long, first long, second long")
    for name in ("first", "second"):
        probes = probes.join(shared.select(F.col("cell").alias(name)), name, "left_semi")
    return probes.select("hash").distinct()


def document_masks(
    spark: SparkSession,
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
    failed: Callable[[str], int] = failed_filters,
    filters: int = 4,
    hash_text: Callable = F.xxhash64,
) -> DataFrame:
    """One row per row of `docs`: doc_id, part, mask (bit i: fails filter i; bit `filters`: repeats a text).

    A row repeats a text if a row with a smaller identifier has the same text, in any part. Rows with equal
    identifiers do not repeat each other. A null identifier is neither smaller nor larger than another: such a row
    repeats nothing and is repeated by nothing. Null texts and parts count as empty. Further columns do not matter.
    """
    ship(spark)
    staged = Staged(spark)
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    ).withColumn("hash", hash_text("text"))
    surveyed = staged.write("surveyed", _surveyed(rows, failed))
    segments = max(1, -(-surveyed.count() * CELLS_PER_ROW // SEGMENT))
    shared = staged.write("shared", shared_cells(surveyed, segments))
    repeats = staged.write("repeats", possible_repeats(surveyed, shared, segments))
    # Full texts are shuffled of these alone, copies within a task as one.
    doubtful = probably_in(rows, "hash", bitmap(repeats, "hash")).join(repeats, "hash", "left_semi")
    smallest = doubtful.groupBy("hash", "text").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"))
    by_hash = smallest.groupBy("hash").agg(F.count("*").alias("texts"), F.min("least").alias("least"), F.sum("n").alias("n"))
    found = staged.write("found", by_hash.where("n > 1"))
    repeat = F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False)).cast("int") * (1 << filters)
    masked = lambda df: df.select("doc_id", "part", F.col("mask").bitwiseOR(repeat).alias("mask"))
    clashing = found.where("texts > 1").select("hash")
    if clashing.isEmpty():
        return masked(surveyed.join(found, "hash", "left"))
    # Different texts under one hash: these rows are told apart by their full texts.
    apart = _surveyed(doubtful.join(clashing, "hash", "left_semi"), failed, keep_text=True)
    exact = apart.join(smallest.join(clashing, "hash", "left_semi").drop("n"), ["hash", "text"], "left")
    return masked(surveyed.join(clashing, "hash", "left_anti").join(found, "hash", "left")).union(masked(exact))


def mask_counts(masks: DataFrame, labels: DataFrame | None, id_col: str = "doc_id") -> DataFrame:
    """part, mask, n, good, toxic: documents, and those labelled quality=1 and toxic=1, by part and mask.

    Of several labels of a document, any that says so counts; a null identifier has no label.
    """
    if labels is None:
        marked = masks.withColumns({"good": F.lit(0), "toxic": F.lit(0)})
    else:
        flag = lambda name: F.max(F.coalesce(F.col(name) == 1, F.lit(False)).cast("int")).alias(f"_{name}")
        known = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("doc_id")).agg(flag("quality"), flag("toxic"))
        marked = masks.join(known, "doc_id", "left").select("part", "mask", F.col("_quality").alias("good"), F.col("_toxic").alias("toxic"))
    sums = [F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("good", "toxic")]
    return marked.groupBy("part", "mask").agg(F.count("*").alias("n"), *sums)


_STEPS = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def every_order(counts: DataFrame, letters: str) -> DataFrame:
    """One row per part, order of the filters and step: what the step's filter removes after those before it.

    A part has at most 2^filters counts, whatever its size. kept: documents left after the step. redundant: removed
    earlier, but failing this filter too. unique_fails: failing this filter alone. shapley: what the filter removes,
    added up over all orders.
    """
    orders = ["".join(p) for p in permutations(letters)]
    bit = {letter: 1 << i for i, letter in enumerate(letters)}

    def run(key, table):
        mask = np.array(table.column("mask").to_pylist(), np.int64)
        n, good, toxic = (np.array(table.column(c).to_pylist(), np.int64) for c in ("n", "good", "toxic"))
        rows, total = [], dict.fromkeys(letters, 0)
        for order in orders:
            before = 0
            for step, letter in enumerate(order, 1):
                fails, gone = mask & bit[letter] != 0, mask & before != 0
                removed = fails & ~gone
                before |= bit[letter]
                total[letter] += int(n[removed].sum())
                rows.append(
                    (order, step, letter, n[mask & before == 0].sum(), n[removed].sum(), n[fails & gone].sum(), n[mask == bit[letter]].sum(), good[removed].sum(), toxic[removed].sum())
                )
        order, step, letter, *sums = zip(*rows)
        columns = [[key[0].as_py()] * len(rows), order, step, *(list(map(int, s)) for s in sums), [total[x] for x in letter]]
        kinds = [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * 7]
        names = [f.split()[0] for f in _STEPS.split(", ")]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return counts.groupBy("part").applyInArrow(run, _STEPS)


def audit(spark: SparkSession, docs: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """The audit of the filters A to E (E: repeats) over `docs`, by language; no documents give no rows."""
    counts = mask_counts(document_masks(spark, docs), labels)
    return every_order(counts, "ABCDE")
