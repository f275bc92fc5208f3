"""Repeated lines across documents, exact or within a few edits, by a segment-partition join.

Two lines within EDITS edits of each other agree in one of EDITS + 1 segments of the shorter one, at a place that
differs by little. Every distinct line posts its segments under (length, number, content), and probes, for
its own length and each length down to EDITS less, the few substrings that can match such a segment. Postings
are hashed and dealt to blocks by the hash; lines that meet are candidates, and candidates are verified with
a banded, bit-parallel edit distance, many pairs at once.

A segment that very many lines share (a passage with one changed word in each copy) is not multiplied out. Its
lines are linked to one of them; of the lines that lie in different classes afterwards, pairs are looked at in
tiles of bounded size, where counts of characters rule most of them out before they are verified. The lines of a
segment with more than HOT of them are dealt to several tasks. Such segments are told from the lines whose hash is a
multiple of SAMPLE; a wrong count makes a task larger or smaller and never loses a link.

Lines are compared without surrounding white space. Lines of fewer than LEAST characters, of which two edits are a
large part, are the same only if they are equal: they are grouped by their hash and take no part in the join. Lines
of white space alone are left alone.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm.common import CHUNK_CHARS, Staged, ship, texts_of
from orderloom.llm.components import components
from orderloom.llm.shingles import mix, powers

#: Edits within which lines are the same, and characters from which edits are allowed.
EDITS, LEAST = 2, 24
#: Lines of a segment that are paired one by one; postings in a block; lines on a side of a tile; pairs verified at once.
SHORT, BLOCK, TILE, AT_ONCE = 24, 1_500_000, 2_000, 4096
#: Lines of a segment in one task, and of how many lines one is counted to find the segments with more.
HOT, SAMPLE = 500_000, 256
_BITS = 1 << 24
_BINS = 32


def node_of(line: str) -> int:
    return xxhash.xxh3_64_intdigest(line.encode("utf-8", "surrogatepass")) - (1 << 63)


def lines_of(text: str, least: int = 1) -> list[tuple[int, str]]:
    """Number and stripped text of the lines of so many characters, by default of all that are not blank."""
    return [(i, s) for i, line in enumerate(text.split("\n")) if len(s := line.strip()) >= least]


def segments(length, edits: int = EDITS):
    """Start and size of the segments of lines of these lengths; the last ones are longer by one where needed."""
    parts = edits + 1
    base, longer = length // parts, length % parts
    return [(i * base + np.maximum(0, i - (parts - longer)), base + (i >= parts - longer)) for i in range(parts)]


def postings(lines: list[str], edits: int = EDITS, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Key, row and whether it is a segment of the line itself (else a probe), for all lines."""
    lengths = np.array([len(s) for s in lines])
    points = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    total = np.zeros(len(points) + 1, np.uint64)
    np.cumsum((points + np.uint64(1)) * powers(len(points)), out=total[1:])
    inverse = powers(len(points) + 1, inverse=True)
    offset = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    keys, rows, own = [], [], []
    for shorter in range(edits + 1):
        target = lengths - shorter
        for i, (start, size) in enumerate(segments(target, edits)):
            low, high = max(-i, shorter - (edits - i)), min(i, shorter + (edits - i))
            for shift in range(low, high + 1):
                at = start + shift
                fits = np.flatnonzero((target >= least) & (at >= 0) & (at + size <= lengths))
                first = offset[fits] + at[fits]
                value = (total[first + size[fits]] - total[first]) * inverse[first]
                keys.append(mix(value ^ mix((target[fits] * (edits + 1) + i).astype(np.uint64))))
                rows.append(fits)
                own.append(np.full(len(fits), shorter == 0 and shift == 0))
    return np.concatenate(keys), np.concatenate(rows), np.concatenate(own)


def within(left: list[str], right: list[str], edits: int = EDITS) -> np.ndarray:
    """Whether each pair of lines is within so many edits.

    Bit d of a mask stands for the diagonal d - edits of the distance matrix. One mask per number of errors
    tells which diagonals of the band can be reached; all pairs advance together, one character of `left` a step.
    """
    result = np.zeros(len(left), bool)
    size, other = np.array([len(s) for s in left]), np.array([len(s) for s in right])
    order = np.flatnonzero(np.abs(size - other) <= edits)
    order = order[np.argsort(size[order], kind="stable")]
    width, full = 2 * edits + 1, np.uint32((1 << (2 * edits + 1)) - 1)
    step = 0
    while step < len(order):
        # Lines of like length go together, within a bounded matrix.
        room = max(1, min(AT_ONCE, 4_000_000 // max(1, int(size[order[step]]) + width)))
        rows = order[step : step + room]
        longest = int(size[rows[0]]) * 2 + 64
        rows = rows[: max(1, int(np.searchsorted(size[rows], longest, side="right")))]
        step += len(rows)
        m, n = size[rows], other[rows]
        a = np.full((len(rows), int(m.max()) + 1), 0x110000, np.uint32)
        b = np.full((len(rows), int(max(m.max(), n.max())) + 2 * width), 0x110001, np.uint32)
        for k, r in enumerate(rows.tolist()):
            a[k, : m[k]] = np.frombuffer(left[r].encode("utf-32-le", "surrogatepass"), "<u4")
            b[k, edits : edits + n[k]] = np.frombuffer(right[r].encode("utf-32-le", "surrogatepass"), "<u4")
        live = np.arange(len(rows))
        reach = [np.full(len(rows), ((1 << (e + 1)) - 1) << edits & int(full), np.uint32) for e in range(edits + 1)]
        for i in range(int(m.max()) + 1):
            ended = m[live] == i
            if ended.any():
                done = live[ended]
                last = (reach[edits][ended] >> (n[done] - m[done] + edits).astype(np.uint32)) & 1
                result[rows[done]] = last.astype(bool)
            if i % 16 == 0 or ended.any():
                stay = ~ended & (reach[edits] != 0)
                live, reach = live[stay], [r[stay] for r in reach]
                if not len(live):
                    break
            char = a[live, i]
            match = np.zeros(len(live), np.uint32)
            for d in range(width):
                match |= (char == b[live, i + d]).astype(np.uint32) << np.uint32(d)
            moved = [reach[0] & match]
            for e in range(1, edits + 1):
                before = reach[e - 1]
                moved.append((reach[e] & match) | before | (before >> np.uint32(1)) | ((moved[e - 1] << np.uint32(1)) & full))
            reach = moved
    return result


_SAMPLED = pa.struct([("key", pa.int64()), ("node", pa.int64()), ("own", pa.bool_())])


def _survey(docs: DataFrame, edits: int, least: int) -> DataFrame:
    """doc_id, version (hash of the text), numbers and nodes of the lines looked at, and the postings of sampled lines."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "version", "numbers", "nodes", "sampled"]
    every = SAMPLE

    def run(batches):
        for batch in batches:
            numbers, nodes, sampled = [], [], []
            lines, at = [], []
            for row, text in enumerate(texts_of(batch.column("text"))):
                found = lines_of(text)
                numbers.append([i for i, _ in found])
                nodes.append([node_of(s) for _, s in found])
                sampled.append([])
                for (_, line), node in zip(found, nodes[-1]):
                    if node % every == 0 and len(line) >= least:
                        lines.append(line)
                        at.append((row, node))
            if lines:
                for key, k, own in zip(*(x.tolist() for x in postings(lines, edits, least))):
                    row, node = at[k]
                    sampled[row].append({"key": key - (1 << 64) if key >> 63 else key, "node": node, "own": own})
            columns = [pa.array(numbers, pa.list_(pa.int32())), pa.array(nodes, pa.list_(pa.int64())), pa.array(sampled, pa.list_(_SAMPLED))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("version"), *columns], names)

    return docs.mapInArrow(run, f"doc_id {kind}, version long, numbers array<int>, nodes array<long>, sampled array<struct<key long, node long, own boolean>>")


@dataclass
class _Hot:
    """Segments with very many lines, by key: tasks of each, tasks of those before it, and a line that posted it, if known."""

    keys: np.ndarray
    salts: np.ndarray
    before: np.ndarray
    centres: dict[int, int]


def _hot(survey: DataFrame) -> _Hot:
    """At most one segment per HOT postings: a small part of the table of segments."""
    seen = survey.select(F.explode("sampled").alias("s")).select("s.*").groupBy("key", "node").agg(F.max("own").alias("own"))
    counted = seen.groupBy("key").agg(F.count("*").alias("n"), F.min(F.when(F.col("own"), F.col("node"))).alias("centre"))
    rows = sorted((r["key"] % (1 << 64), -(-r["n"] * SAMPLE // HOT), r["centre"]) for r in counted.where(F.col("n") * SAMPLE > HOT).collect())
    salts = np.array([r[1] for r in rows], np.int64)
    return _Hot(np.array([r[0] for r in rows], np.uint64), salts, np.cumsum(salts) - salts, {r[0]: r[2] for r in rows if r[2] is not None})


def _posted(docs: DataFrame, edits: int, least: int, blocks: int, hot: _Hot) -> DataFrame:
    """Postings of the distinct lines of each task by block, as parallel arrays. Blocks from `blocks` on hold a share of one hot segment."""

    def run(batches):
        seen: set[int] = set()
        lines: list[str] = []
        nodes: list[int] = []
        held = 0

        def flush():
            key, row, own = postings(lines, edits, least)
            node = np.array(nodes, np.int64)[row]
            block = (key >> np.uint64(33)).astype(np.int64) % blocks
            if len(hot.keys):
                place = np.minimum(np.searchsorted(hot.keys, key), len(hot.keys) - 1)
                share = (mix(node.view(np.uint64)) % hot.salts[place].astype(np.uint64)).astype(np.int64)
                block = np.where(hot.keys[place] == key, blocks + hot.before[place] + share, block)
            order = np.argsort(block, kind="stable")
            cuts = np.flatnonzero(np.diff(block[order])) + 1
            parts = np.split(order, cuts)
            return pa.RecordBatch.from_arrays(
                [pa.array([int(block[p[0]]) for p in parts], pa.int64()), *(pa.array([c[p].tobytes() for p in parts], pa.binary()) for c in (key, node, own))],
                ["block", "key", "node", "own"],
            )

        for batch in batches:
            for text in texts_of(batch.column("text")):
                for _, line in lines_of(text, least):
                    node = node_of(line)
                    if node in seen:
                        continue
                    if len(seen) < 1_000_000:
                        seen.add(node)
                    lines.append(line)
                    nodes.append(node)
                    held += len(line)
                    if held > 2 * CHUNK_CHARS:
                        yield flush()
                        lines, nodes, held = [], [], 0
        if lines:
            yield flush()

    return docs.select("text").mapInArrow(run, "block long, key binary, node binary, own binary")


_FOUND = "kind int, a long, b long, own boolean"
_PAIR, _LONG = 0, 1


def _meet(short: int, blocks: int, hot: _Hot):
    """Candidates of one block. Rows: _PAIR a, b; _LONG a (key), b (line), own for segments with many lines.

    The tasks of a hot segment link their lines to the same centre where one is known, and give all of them as _LONG.
    """

    def run(key, table):
        join = lambda name, kind: np.frombuffer(b"".join(table.column(name).to_pylist()), kind)
        segment, node, own = join("key", np.uint64), join("node", np.int64), join("own", np.bool_)
        order = np.lexsort((~own, node, segment))
        segment, node, own = segment[order], node[order], own[order]
        fresh = np.ones(len(node), bool)
        fresh[1:] = (segment[1:] != segment[:-1]) | (node[1:] != node[:-1])
        segment, node, own = segment[fresh], node[fresh], own[fresh]
        start = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
        length = np.diff(np.concatenate([start, [len(node)]]))
        used = (length > 1) & np.logical_or.reduceat(own, start)
        most = short
        if key[0].as_py() >= blocks:
            used, most = np.ones(len(start), bool), 0
        out = [np.zeros((0, 2), np.int64)]
        for r in np.unique(length[used & (length <= most)]).tolist():
            left, right = np.triu_indices(r, 1)
            at = start[used & (length == r), None]
            i, j = (at + left).ravel(), (at + right).ravel()
            fits = own[i] | own[j]
            out.append(np.stack([node[i[fits]], node[j[fits]]], axis=1))
        longs = [np.zeros(0, np.int64)]
        for head, size in zip(start[used & (length > most)].tolist(), length[used & (length > most)].tolist()):
            # The smallest line of the segment is its centre; lines that only probe must meet one that posted.
            rows = np.arange(head, head + size)
            longs.append(rows)
            posted = rows[own[rows]]
            centre = hot.centres.get(int(segment[head])) if not most else None
            if centre is None:
                if not len(posted):
                    continue
                centre = node[posted[0]]
            others = node[rows][node[rows] != centre]
            out.append(np.sort(np.stack([np.full(len(others), centre, np.int64), others], axis=1), axis=1))
        pairs = np.unique(np.concatenate(out), axis=0)
        rows = np.concatenate(longs)
        count, more = len(pairs), len(rows)
        return pa.table(
            {
                "kind": pa.array(np.repeat(np.array([_PAIR, _LONG], np.int32), [count, more])),
                "a": pa.array(np.concatenate([pairs[:, 0], segment[rows].view(np.int64)])),
                "b": pa.array(np.concatenate([pairs[:, 1], node[rows]])),
                "own": pa.array(np.concatenate([np.zeros(count, bool), own[rows]])),
            }
        )

    return run


def _texts(spark: SparkSession, docs: DataFrame, wanted: DataFrame, least: int) -> DataFrame:
    """node, line of the wanted nodes. A bitmap of fixed size keeps most other lines in their task."""
    place = F.expr(f"node & {_BITS - 1}")
    parts = wanted.select(place.alias("p")).groupBy(F.expr("p div 32768").alias("bucket")).agg(F.expr("bitmap_construct_agg(p % 32768)").alias("bits")).collect()
    bitmap = np.zeros((_BITS // 32768, 4096), np.uint8)
    for row in parts:  # at most 512 rows of 4 KB
        bitmap[row["bucket"]] = np.frombuffer(row["bits"], np.uint8)
    shared = spark.sparkContext.broadcast(np.unpackbits(bitmap.ravel(), bitorder="little").astype(bool))

    def run(batches):
        wished, seen = shared.value, set()
        for batch in batches:
            nodes, lines = [], []
            for text in texts_of(batch.column("text")):
                for _, line in lines_of(text, least):
                    node = node_of(line)
                    if wished[node & (_BITS - 1)] and node not in seen:
                        if len(seen) < 1_000_000:
                            seen.add(node)
                        nodes.append(node)
                        lines.append(line)
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(lines, pa.string())], ["node", "line"])

    found = docs.select("text").mapInArrow(run, "node long, line string")
    return found.join(wanted, "node").groupBy("node").agg(F.first("line").alias("line"))


def _verify(pairs: DataFrame, lines: DataFrame, edits: int) -> DataFrame:
    """The pairs (a, b) of nodes whose lines are within so many edits."""
    left, right = (lines.select(F.col("node").alias(n), F.col("line").alias(f"line_{n}")) for n in "ab")

    def run(batches):
        for batch in batches:
            keep = within(batch.column("line_a").to_pylist(), batch.column("line_b").to_pylist(), edits)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep))

    return pairs.select("a", "b").join(right, "b").join(left, "a").select("a", "b", "line_a", "line_b").mapInArrow(run, "a long, b long")


def _counts(lines: DataFrame) -> DataFrame:
    """node, and how many characters of its line fall in each of a few bins (one byte each, modulo 256)."""

    def run(batches):
        for batch in batches:
            texts = texts_of(batch.column("line"))
            points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
            bins = (mix(points.astype(np.uint64)) % np.uint64(_BINS)).astype(np.int64)
            owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
            table = np.bincount(owner * _BINS + bins, minlength=len(texts) * _BINS).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array([r.tobytes() for r in table.reshape(-1, _BINS)], pa.binary())], ["node", "counts"])

    return lines.mapInArrow(run, "node long, counts binary")


def _across(left: DataFrame, edits: int) -> DataFrame:
    """Pairs of a segment's lines in different classes that their character counts do not rule out, tile by tile."""
    side = F.greatest(F.lit(1), F.expr(f"(rows + {TILE - 1}) div {TILE}"))
    dealt = left.withColumn("side", side).withColumn("mine", F.pmod(F.xxhash64("node"), F.col("side")))
    tiles = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("side") - 1)))
    tiles = tiles.select("run", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "node", "own", "label", "counts")

    def run(key, table):
        first, second = key[1].as_py(), key[2].as_py()
        mine, node, label = (table.column(c).to_numpy() for c in ("mine", "node", "label"))
        own = np.array(table.column("own").to_pylist(), bool)
        counts = np.frombuffer(b"".join(table.column("counts").to_pylist()), np.int8).reshape(len(node), _BINS)
        x, y = np.flatnonzero(mine == first), np.flatnonzero(mine == second)
        out = [np.zeros((0, 2), np.int64)]
        theirs = counts[y]
        for i in x:
            # An edit moves two counts by one at most; differences modulo 256 are never above the true ones.
            apart = np.abs((theirs - counts[i]).astype(np.int16)).sum(axis=1)
            fits = (apart <= 2 * edits) & (label[y] != label[i]) & (own[y] | own[i])
            j = y[fits & (y > i)] if first == second else y[fits]
            out.append(np.stack([np.full(len(j), node[i]), node[j]], axis=1))
        a, b = np.sort(np.concatenate(out), axis=1).T
        return pa.table({"a": a, "b": b})

    return tiles.groupBy("run", "i", "j").applyInArrow(run, "a long, b long").distinct()


def repeated_lines(spark: SparkSession, docs: DataFrame, staged: Staged, edits: int = EDITS, least: int = LEAST, short: int = SHORT) -> DataFrame:
    """doc_id, version, drop (numbers of the lines to leave out, null if none), n_lines, of (doc_id, text, version)."""
    survey = staged.write("survey", _survey(docs, edits, least))
    spots = survey.select("doc_id", "version", F.explode(F.arrays_zip("numbers", "nodes")).alias("z")).select("doc_id", "version", F.col("z.numbers").alias("number"), F.col("z.nodes").alias("node"))
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "version", "number")
    first = staged.write("first", spots.groupBy("node").agg(F.min(place).alias("first"), F.count("*").alias("n")))
    probes = (edits + 1) * (edits + 2)
    blocks = max(6, -(-first.count() * probes // BLOCK))
    hot = _hot(survey)
    found = staged.write("found", _posted(docs, edits, least, blocks, hot).groupBy("block").applyInArrow(_meet(short, blocks, hot), _FOUND))
    longs = staged.write("long", found.where(F.col("kind") == _LONG).groupBy(F.col("a").alias("run"), F.col("b").alias("node")).agg(F.max("own").alias("own")))
    pairs = staged.write("pairs-1", found.where(F.col("kind") == _PAIR).select("a", "b").distinct())
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).union(longs.select("node")).distinct()
    lines = staged.write("lines", _texts(spark, docs, staged.write("wanted", wanted), least))
    links = staged.write("links-1", _verify(pairs, lines, edits))
    classes = components(staged, links, "classes-1")
    labelled = longs.join(classes, "node", "left").withColumn("label", F.coalesce("component", "node")).drop("component")
    mixed = labelled.groupBy("run").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("rows"), F.max("own").alias("posted")).where("low <> high and posted")
    left = staged.write("mixed", labelled.join(mixed.select("run", "rows"), "run").join(_counts(lines), "node"))
    if not left.isEmpty():
        more = staged.write("pairs-2", _across(left, edits).join(pairs, ["a", "b"], "left_anti"))
        links = links.union(staged.write("links-2", _verify(more, lines, edits)))
        classes = components(staged, links, "classes-2")
    # Of each class of lines the first place stays: by doc_id, then version, then number.
    whole = first.join(classes, "node", "left").withColumn("class", F.coalesce("component", "node"))
    kept = whole.groupBy("class").agg(F.min("first").alias("stays"), F.sum("n").alias("places")).where("places > 1")
    kept = staged.write("kept", whole.join(kept, "class").select("node", "stays"))
    drops = spots.join(kept, "node").where(~place.eqNullSafe(F.col("stays"))).groupBy("doc_id", "version").agg(F.sort_array(F.collect_set("number")).alias("drop"))
    drops = staged.write("drops", drops)
    counted = survey.groupBy("doc_id", "version").agg(F.first(F.size("numbers")).alias("n_lines"))
    same = counted["doc_id"].eqNullSafe(drops["doc_id"]) & (counted["version"] == drops["version"])
    return staged.write("plan", counted.join(drops, same, "left").select(counted["doc_id"], counted["version"], "n_lines", "drop"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int = EDITS, least: int = LEAST, short: int = SHORT) -> DataFrame:
    """`docs` without lines that another document, or an earlier line of the same one, has within `edits` edits.

    Lines of fewer than `least` characters go only where they are repeated exactly; blank lines stay.
    All columns stay, in order, whatever their names, and _lines_seen and _lines_dropped (in place of such columns) are
    added: lines that were looked at and lines left out. Of each class of linked lines the first place stays, by identifier, then number in the text. Null and empty texts stay as
    they are. Rows that repeat both identifier and text are treated alike. An empty table stays empty.
    """
    ship(spark)
    staged = Staged(spark)
    version = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), version.alias("version"))
    plan = repeated_lines(spark, slim, staged, edits, least, short)
    # Names that no column of the documents can have.
    own = {n: f"_{n}_{uuid.uuid4().hex}" for n in ("doc_id", "version", "n_lines", "drop", "this")}
    plan = plan.select(*(F.col(n).alias(own[n]) for n in ("doc_id", "version", "n_lines", "drop")))
    same = F.col(id_col).eqNullSafe(F.col(own["doc_id"])) & (F.col(own["this"]) == F.col(own["version"]))
    joined = docs.withColumn(own["this"], version).join(plan, same)
    without = F.array_join(F.filter(F.split(F.col(text_col), "\n", -1), lambda x, i: ~F.array_contains(own["drop"], i)), "\n")
    text = F.when(F.col(own["drop"]).isNull(), F.col(text_col)).otherwise(without)
    added = {"_lines_seen": F.col(own["n_lines"]), "_lines_dropped": F.coalesce(F.size(own["drop"]), F.lit(0))}
    columns = [text.alias(c) if c == text_col else F.col(c) for c in docs.columns if c not in added]
    return joined.select(*columns, *(c.cast("long").alias(n) for n, c in added.items()))
