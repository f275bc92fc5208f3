"""Near-duplicate documents: Jaccard similarity of word shingles by a blocked sparse matrix product.

The incidence matrix of documents by shingles is cut into blocks of columns (ranges of the shingle hash).
Each block task multiplies its block by its own transpose: it counts, for every pair of documents, the
shingles of the block that both have. Counts of a pair are added up over the blocks, and a pair is dropped
as soon as the sizes of the two sets prove that it cannot reach the threshold.

What keeps this linear and exact:

* Documents with equal sets are one row of the matrix. Rows are named by a 64-bit digest of the set.
* A row only needs its rarest shingles: a set of n that reaches the threshold with another one shares one of
  its n - ceil(0.75 n) + 1 first shingles in any fixed order. The order is by frequency, told from a
  count table of fixed size over the whole corpus, then by hash. Passages that many documents share end up
  behind. The table only orders: a wrong count costs time and never a link.
* If two rows have c common shingles among those first ones, they have at most
  c + max(rest of one, rest of the other) in common. Unrelated documents that share a passage fail this bound.
* A column with many rows (a large group of near copies) is not multiplied out. It links its rows to one of
  them; what is linked is one component, and only pairs that lie in different components afterwards are
  looked at, in tiles of bounded size. Columns of one passage have nearly the same rows; those with the same
  smallest row are one group, in which a row is dealt out once. Columns with very many rows are dealt to
  several tasks.
* Every pair first has to pass by parity sketches, 32 times smaller than a large set, which rule out sets that differ too much.

Pairs that pass are compared exactly, set against set; only their sets are moved.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm.common import Staged, id_text, only, texts_of
from orderloom.llm.components import components
from orderloom.llm.membership import bitmap, probably_in
from orderloom.llm.shingles import sets

#: Words in a shingle, and the similarity in percent from which documents are linked.
WIDTH, PERCENT = 5, 75
#: Rows of a column that are multiplied out, into two pairs an entry at most; a longer column, whose pairs would grow
#: with the square of its rows, is linked through one of its rows.
SHORT = 5
#: Entries of the matrix in a block, rows of a column in one task, and rows on a side of a tile.
BLOCK, HOT, TILE = 750_000, 1_000_000, 2_000
_PARTS = 64
_SKETCH = 2048


@dataclass
class Similar:
    """members: doc_id, n_shingles, node (null for an empty set); links: pairs of nodes found to be similar;
    classes: node, component (its smallest member's node) for nodes with a link."""

    members: DataFrame
    links: DataFrame
    classes: DataFrame


def _first(n: np.ndarray | int, percent: int):
    """How many of its first shingles a set of n must show."""
    return n - (n * percent + 99) // 100 + 1


def _node(found: np.ndarray) -> int | None:
    """Name of a row of the matrix: a digest of its set; none for an empty set."""
    return xxhash.xxh3_64_intdigest(found.tobytes()) - (1 << 63) if len(found) else None


def _buckets(documents: int) -> int:
    """Entries of the count table: four per document, within bounds that a broadcast can bear."""
    return 1 << min(24, max(20, (4 * documents).bit_length()))


def _survey(docs: DataFrame, width: int, buckets: int) -> DataFrame:
    """Per document its set's size and digest (part is null); per task its count table, in parts."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "at", "n", "node", "part", "task", "counts"]

    def run(batches):
        from pyspark import TaskContext

        counts, ids = np.zeros(buckets, np.int64), None
        for batch in batches:
            ids = batch.column("doc_id").type
            sizes, nodes, seen, held = [], [], [], 0
            for found in sets(texts_of(batch.column("text")), width):
                sizes.append(len(found))
                nodes.append(_node(found))
                seen.append(found)
                held += len(found)
                if held > 1_000_000:
                    counts += np.bincount(np.concatenate(seen) & np.uint64(buckets - 1), minlength=buckets)
                    seen, held = [], 0
            if held:
                counts += np.bincount(np.concatenate(seen) & np.uint64(buckets - 1), minlength=buckets)
            none = pa.nulls(len(sizes), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("at"), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), none, none, pa.nulls(len(sizes), pa.binary())], names)
        if ids is not None:
            parts = np.minimum(counts, 65535).astype(np.uint16).reshape(_PARTS, -1)
            task = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.nulls(_PARTS, ids), pa.nulls(_PARTS, pa.int64()), pa.nulls(_PARTS, pa.int64()), pa.nulls(_PARTS, pa.int64()), pa.array(range(_PARTS), pa.int32()), pa.array([task] * _PARTS, pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], names)

    return docs.mapInArrow(run, f"doc_id {kind}, at long, n long, node long, part int, task int, counts binary")


def _count_table(survey: DataFrame, buckets: int) -> np.ndarray:
    """The tasks' count tables added up, 64 at a time; the sum is of fixed size and goes to the driver."""

    def add(key, table):
        total = np.zeros(buckets // _PARTS, np.int64)
        for blob in table.column("counts"):
            part = np.frombuffer(blob.as_py(), np.uint16 if len(blob.as_py()) == 2 * len(total) else np.uint32)
            total += part
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "task": pa.array([key[1].as_py()], pa.int32()), "counts": pa.array([np.minimum(total, 2**32 - 1).astype(np.uint32).tobytes()], pa.binary())})

    parts = survey.where("part is not null").select("part", "task", "counts")
    tasks = only(parts.agg(F.max("task")).collect()) + 1
    while True:
        parts = parts.withColumn("task", F.expr("task div 64").cast("int"))
        parts = parts.groupBy("part", "task").applyInArrow(add, "part int, task int, counts binary")
        tasks = -(-tasks // 64)
        if tasks <= 1:
            break
    table = np.zeros((_PARTS, buckets // _PARTS), np.uint32)
    for row in parts.collect():
        table[row["part"]] = np.frombuffer(row["counts"], np.uint32)
    return table.ravel()


def _entries(docs: DataFrame, width: int, percent: int, table, blocks: int) -> DataFrame:
    """The matrix by blocks: block, salted, and entries as three parallel arrays (shingle, node, set size)."""

    def run(batches):
        counts = table.value
        mask = np.uint64(len(counts) - 1)
        seen: set[int] = set()
        held: list[tuple[np.ndarray, int, int]] = []
        total = 0

        def flush():
            shingle = np.concatenate([h[0] for h in held])
            lengths = [len(h[0]) for h in held]
            node = np.repeat(np.array([h[1] for h in held], np.int64), lengths)
            size = np.repeat(np.array([h[2] for h in held], np.int32), lengths)
            often = counts[shingle & mask].astype(np.int64)
            salts = -(-often // HOT)
            salt = np.where(salts > 1, (node.view(np.uint64) % np.maximum(salts, 1).astype(np.uint64)).astype(np.int64), 0)
            block = (shingle >> np.uint64(33)).astype(np.int64) % blocks
            group = ((block * 2 + (salts > 1)) << 20) + salt
            order = np.argsort(group, kind="stable")
            cuts = np.flatnonzero(np.diff(group[order])) + 1
            rows: dict[str, list] = {"block": [], "salted": [], "shingle": [], "node": [], "size": []}
            for part in np.split(order, cuts):
                rows["block"].append(int(group[part[0]]))
                rows["salted"].append(bool(salts[part[0]] > 1))
                for name, column in (("shingle", shingle), ("node", node), ("size", size)):
                    rows[name].append(column[part].tobytes())
            kinds = [pa.int64(), pa.bool_(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(rows.values(), kinds)], list(rows))

        for batch in batches:
            for found in sets(texts_of(batch.column("text")), width):
                n = len(found)
                node = _node(found)
                if node is None or node in seen:
                    continue
                if len(seen) < 1_000_000:
                    seen.add(node)
                need = _first(n, percent)
                rank = (np.minimum(counts[found & mask], 0xFFFFF).astype(np.uint64) << np.uint64(44)) | (found >> np.uint64(20))
                if need < n:
                    found = found[rank <= np.partition(rank, need - 1)[need - 1]]
                held.append((found, node, n))
                total += len(found)
            if total > 2_000_000:
                yield flush()
                held, total = [], 0
        if held:
            yield flush()

    return docs.select("text").mapInArrow(run, "block long, salted boolean, shingle binary, node binary, size binary")


_FOUND = "kind int, a long, na int, b long, nb int, c int"
PAIR, STAR, LONG = 0, 1, 2


def _table(kind: int, a, na, b, nb, c) -> pa.Table:
    full = np.full(len(a), kind, np.int32)
    columns = [full, a.astype(np.int64), na.astype(np.int32), b.astype(np.int64), nb.astype(np.int32), c.astype(np.int32)]
    return pa.table(columns, names=[f.split()[0] for f in _FOUND.split(", ")])


def _multiply(percent: int, short: int):
    """One block's product. Rows: PAIR a < b in (size, node) with c common columns; STAR pairs of long columns;
    LONG the entries (a: shingle, b: node) of long columns."""

    def run(key, table):
        join = lambda name, kind: np.frombuffer(b"".join(table.column(name).to_pylist()), kind)
        shingle, node, size = join("shingle", np.uint64), join("node", np.int64), join("size", np.int32)
        salted = table.column("salted")[0].as_py()
        names, first, row = np.unique(node, return_index=True, return_inverse=True)
        # Rows are numbered by set size and name, so that of two rows the smaller number has the smaller set.
        by_size = np.lexsort((names, size[first]))
        names, sizes = names[by_size], size[first][by_size].astype(np.int64)
        row = np.argsort(by_size)[row]
        order = np.lexsort((row, shingle))
        shingle, row = shingle[order], row[order]
        fresh = np.ones(len(row), bool)
        fresh[1:] = (shingle[1:] != shingle[:-1]) | (row[1:] != row[:-1])
        shingle, row = shingle[fresh], row[fresh]
        start = np.flatnonzero(np.concatenate([[True], shingle[1:] != shingle[:-1]]))
        length = np.diff(np.concatenate([start, [len(row)]]))
        out, keys, counts = [], np.zeros(0, np.int64), np.zeros(0, np.int64)
        pending: list[np.ndarray] = []

        def collapse():
            nonlocal keys, counts, pending
            new, times = np.unique(np.concatenate(pending), return_counts=True) if pending else (keys[:0], counts[:0])
            both, at = np.unique(np.concatenate([keys, new]), return_inverse=True)
            counts = np.bincount(at, np.concatenate([counts, times]), len(both)).astype(np.int64)
            keys, pending = both, []

        if not salted:
            waiting = 0
            for r in np.unique(length[(length > 1) & (length <= short)]).tolist():
                left, right = np.triu_indices(r, 1)
                heads = start[length == r]
                step = max(1, 500_000 // len(left))
                for k in range(0, len(heads), step):
                    at = heads[k : k + step, None]
                    i, j = row[at + left].ravel(), row[at + right].ravel()
                    fits = 100 * sizes[i] >= percent * sizes[j]
                    pending.append(i[fits].astype(np.int64) * len(names) + j[fits])
                    waiting += len(pending[-1])
                    if waiting > 1_500_000:
                        collapse()
                        waiting = 0
            collapse()
            i, j = keys // max(1, len(names)), keys % max(1, len(names))
            out.append(_table(PAIR, names[i], sizes[i], names[j], sizes[j], counts))
        many = np.flatnonzero(length > (0 if salted else short))
        if len(many):
            inside = np.zeros(len(row), bool)
            mark = np.zeros(len(row) + 1, np.int64)
            mark[start[many]] += 1
            mark[start[many] + length[many]] -= 1
            inside = np.cumsum(mark)[:-1] > 0
            member, column = row[inside], shingle[inside]
            out.append(_table(LONG, column, np.zeros(len(column)), names[member], sizes[member], np.zeros(len(column))))
            # The centre is the row with the smallest name: names are digests, so it is the same in most columns.
            named = names[member]
            heads = np.flatnonzero(np.concatenate([[True], column[1:] != column[:-1]]))
            reach = np.diff(np.concatenate([heads, [len(column)]]))
            least = np.repeat(np.minimum.reduceat(named, heads), reach)
            centre = np.searchsorted(np.sort(names), least)
            centre = np.argsort(names)[centre]
            low, high = np.minimum(centre, member), np.maximum(centre, member)
            fits = (low < high) & (100 * sizes[low] >= percent * sizes[high])
            pair = np.unique(low[fits].astype(np.int64) * len(names) + high[fits])
            i, j = pair // len(names), pair % len(names)
            out.append(_table(STAR, names[i], sizes[i], names[j], sizes[j], np.zeros(len(i))))
        return pa.concat_tables(out)

    return run


def _enough(common, percent: int):
    """Whether so many common shingles can reach the threshold; a, b have na, nb."""
    return (F.lit(100) + percent) * common >= F.lit(percent) * (F.col("na") + F.col("nb"))


def _bound(percent: int):
    """The most shingles that a and b can have in common outside what was counted."""
    rest = lambda n: F.expr(f"{n} - ({n} - ({n} * {percent} + 99) div 100 + 1)")
    return F.greatest(rest("na"), rest("nb"))


def _parity(found: np.ndarray) -> bytes:
    """For each value of the hash's last bits, whether the set has an odd number of such shingles, in bits.

    Two of them differ in at most as many bits as the sets differ in shingles. A set of more than 1,024 has twice its size
    in bits at least, as a power of two, else unlike sets of many shingles could not be told; see `_fold`.
    """
    bits = max(_SKETCH, 1 << (2 * len(found) - 1).bit_length())
    return np.packbits(np.bincount(found % np.uint64(bits), minlength=bits) & 1).tobytes()


def _fold(sketch: bytes, size: int) -> np.ndarray:
    """The sketch that the same set has in `size` bytes, as 64-bit words."""
    return np.bitwise_xor.reduce(np.frombuffer(sketch, np.uint64).reshape(-1, size // 8), axis=0)


def _of_sets(docs: DataFrame, wanted: DataFrame, width: int, column: str, made) -> DataFrame:
    """node, n and `made` of its set, for the nodes in `wanted` (node, at), each from the text of a row that has it.

    Rows are told by `at`, a hash of identifier and text; a filter of fixed size keeps most others out before their sets
    are computed. A set is taken for a node only if its digest says so, from whichever row.
    """
    kept = probably_in(docs, "at", bitmap(wanted, "at")).select("text")

    def run(batches):
        given: set[int] = set()
        for batch in batches:
            rows: dict[str, list] = {"node": [], "n": [], column: []}
            for found in sets(texts_of(batch.column("text")), width):
                node = _node(found)
                if node is None or node in given:
                    continue
                if len(given) < 1_000_000:
                    given.add(node)
                for name, value in (("node", node), ("n", len(found)), (column, made(found))):
                    rows[name].append(value)
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(rows.values(), (pa.int64(), pa.int64(), pa.binary()))], list(rows))

    computed = kept.mapInArrow(run, f"node long, n long, {column} binary")
    return computed.join(wanted.select("node"), "node", "left_semi").groupBy("node").agg(F.first("n").alias("n"), F.first(column).alias(column))


def _alike(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that the sizes and sketches of their sets allow to reach the threshold."""
    left = sketches.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    right = sketches.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))

    def run(batches):
        for batch in batches:
            apart = np.zeros(batch.num_rows, np.int64)
            for i, (x, y) in enumerate(zip(batch.column("sa").to_pylist(), batch.column("sb").to_pylist())):
                size = min(len(x), len(y))
                apart[i] = np.bitwise_count(_fold(x, size) ^ _fold(y, size)).sum(dtype=np.int64)
            keep = (100 + percent) * apart <= (100 - percent) * (batch.column("na").to_numpy() + batch.column("nb").to_numpy())
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    fits = 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")
    return pairs.select("a", "b").join(right, "b").join(left, "a").where(fits).select("a", "b", "na", "nb", "sa", "sb").mapInArrow(run, "a long, b long")


def _compare(pairs: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets reach the threshold."""
    left = rows.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = rows.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))

    def run(batches):
        for batch in batches:
            keep = []
            for sa, sb in zip(batch.column("sa"), batch.column("sb")):
                x, y = np.frombuffer(sa.as_buffer(), np.uint64), np.frombuffer(sb.as_buffer(), np.uint64)
                both = np.sort(np.concatenate([x, y]))
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                keep.append((100 + percent) * common >= percent * (len(x) + len(y)))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("a", "b").join(right, "b").join(left, "a").select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def similar(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT, short: int = SHORT) -> Similar:
    """All documents whose sets of `width`-word shingles have a Jaccard similarity of `percent` or more.

    A text of fewer words is one shingle, a text without words has an empty set and is linked with nothing;
    null counts as empty. Equal texts are members of one node. Rows with a null identifier, and different texts under
    one identifier, are rows like any other, and links lead through them. An empty table gives empty results.
    """
    staged = Staged(spark)
    docs = id_text(docs, id_col, text_col).withColumn("at", F.xxhash64("doc_id", "text"))
    buckets = _buckets(docs.count())
    survey = staged.write("survey", _survey(docs, width, buckets))
    table = spark.sparkContext.broadcast(_count_table(survey, buckets))
    rows_seen = survey.where("part is null").select("doc_id", "at", F.col("n").alias("n_shingles"), "node")
    members = rows_seen.drop("at")
    nodes = staged.write("nodes", rows_seen.where("node is not null").groupBy("node").agg(F.min("at").alias("at"), F.first("n_shingles").alias("n")))
    entries = only(nodes.agg(F.sum(F.expr(f"n - (n * {percent} + 99) div 100 + 1"))).collect())
    blocks = max(6, -(-entries // BLOCK))
    product = _entries(docs, width, percent, table, blocks).groupBy("block").applyInArrow(_multiply(percent, short), _FOUND)
    found = staged.write("found", product)
    longs = found.where(F.col("kind") == LONG).select(F.col("a").alias("run"), F.col("b").alias("node"), F.col("nb").alias("n"))
    in_long = longs.groupBy("node").agg(F.count("*").alias("k"))
    counted = found.where(F.col("kind") == PAIR).groupBy("a", "b").agg(F.first("na").alias("na"), F.first("nb").alias("nb"), F.sum("c").alias("c"))
    uncounted = counted.join(in_long.select(F.col("node").alias("a"), F.col("k").alias("ka")), "a", "left").join(
        in_long.select(F.col("node").alias("b"), F.col("k").alias("kb")), "b", "left"
    )
    hidden = F.coalesce(F.least("ka", "kb"), F.lit(0))
    hidden = F.when(F.col("ka").isNull() | F.col("kb").isNull(), 0).otherwise(hidden)
    passing = uncounted.where(_enough(F.col("c") + hidden + _bound(percent), percent)).select("a", "b")
    stars = found.where(F.col("kind") == STAR).select("a", "b").distinct()
    pairs = staged.write("pairs-1", passing.union(stars).distinct())

    wanted = staged.write("wanted", nodes.join(_ends(pairs).union(longs.select("node")).distinct(), "node").select("node", "at"))
    sketches = staged.write("sketches", _of_sets(docs, wanted, width, "sketch", _parity))

    def compared(pairs: DataFrame, step: int) -> DataFrame:
        """The links among these pairs; a set is computed and moved only if its sketch has passed in one of them."""
        possible = staged.write(f"possible-{step}", _alike(pairs, sketches, percent))
        ends = wanted.join(_ends(possible).distinct(), "node", "left_semi")
        rows = staged.write(f"sets-{step}", _of_sets(docs, ends, width, "shingles", np.ndarray.tobytes))
        return staged.write(f"links-{step}", _compare(possible, rows, percent))

    links = compared(pairs, 1)
    classes = components(staged, links, "classes-1")
    tried = pairs

    for step in (2, 3):
        # Columns whose rows are not all in one component: first through one row of each, then all that is left.
        label = F.coalesce("component", "node")
        labelled = longs.join(classes, "node", "left").select("run", "node", "n", label.alias("label"))
        mixed = labelled.groupBy("run").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.min("node").alias("group")).where("low <> high")
        left = staged.write(f"mixed-{step}", labelled.join(mixed.select("run", "group"), "run"))
        if left.isEmpty():
            break
        more = _through_one(left) if step == 2 else _all_across(left, sketches, percent)
        if step == 3:
            more = more.join(counted.select("a", "b", F.col("c").alias("before")), ["a", "b"], "left").where(
                _enough(F.col("c") + F.coalesce("before", F.lit(0)) + _bound(percent), percent)
            )
        fits = 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")
        pairs = staged.write(f"pairs-{step}", more.where(fits).select("a", "b").distinct().join(tried, ["a", "b"], "left_anti"))
        tried = tried.union(pairs)
        links = links.union(compared(pairs, step))
        classes = components(staged, links, f"classes-{step}")
    return Similar(members, links, classes)


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node")))


def _ordered(pairs: DataFrame) -> DataFrame:
    """a and b by (size, node), as the blocks have them."""
    swap = (F.col("na") > F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") > F.col("b")))
    one, two = F.struct("a", "na"), F.struct(F.col("b").alias("a"), F.col("nb").alias("na"))
    low, high = F.when(swap, two).otherwise(one), F.when(swap, one).otherwise(two)
    rest = [c for c in pairs.columns if c not in ("a", "na", "b", "nb")]
    return pairs.select(low["a"].alias("a"), low["na"].alias("na"), high["a"].alias("b"), high["na"].alias("nb"), *rest)


def _through_one(left: DataFrame) -> DataFrame:
    """In each column, one row of every component against one row of the first component."""
    one = left.groupBy("run", "label").agg(F.min(F.struct("node", "n")).alias("x"))
    centre = one.groupBy("run").agg(F.min(F.struct("label", "x")).alias("first"))
    pairs = one.join(centre, "run").where(F.col("label") != F.col("first.label"))
    return _ordered(pairs.select(F.col("first.x.node").alias("a"), F.col("first.x.n").alias("na"), F.col("x.node").alias("b"), F.col("x.n").alias("nb")))


def _short(sketches: DataFrame) -> DataFrame:
    """node and its sketch in the fewest bits, as the tiles take them."""

    def run(batches):
        for batch in batches:
            found = [_fold(x, _SKETCH // 8).tobytes() for x in batch.column("sketch").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(found, pa.binary())], ["node", "sketch"])

    return sketches.select("node", "sketch").mapInArrow(run, "node long, sketch binary")


def _all_across(left: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Pairs of a group of columns in different components that sizes and sketches allow, and how many columns they share at most.

    A pair may be in several groups: it is given in the first that holds both rows alone.
    """
    places = left.groupBy("group", "node").agg(F.first("n").alias("n"), F.first("label").alias("label"), F.count("*").alias("columns"))
    sizes = places.groupBy("group").agg(F.count("*").alias("rows"))
    own = places.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("group", "columns"))).alias("groups"))
    side = F.greatest(F.lit(1), F.expr(f"(rows + {TILE - 1}) div {TILE}"))
    dealt = places.join(own, "node").join(_short(sketches), "node").join(sizes, "group")
    dealt = dealt.withColumn("side", side).withColumn("own", F.pmod(F.xxhash64("node"), F.col("side")))
    tiles = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("side") - 1)))
    tiles = tiles.select("group", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "n", "label", "sketch", "groups")

    def run(key, table):
        group, first, second = (k.as_py() for k in key)
        own, node, n, label = (table.column(c).to_numpy() for c in ("own", "node", "n", "label"))
        sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint64).reshape(len(node), _SKETCH // 64)
        groups = [{g["group"]: g["columns"] for g in r} for r in table.column("groups").to_pylist()]
        x, y = np.flatnonzero(own == first), np.flatnonzero(own == second)
        theirs, found = sketch[y], []
        for i in x.tolist():
            fits = label[y] != label[i]
            if first == second:
                fits &= y > i
            apart = np.bitwise_count(theirs ^ sketch[i]).sum(axis=1, dtype=np.int64)
            for j in y[fits & ((100 + percent) * apart <= (100 - percent) * (n[y] + n[i]))].tolist():
                common = groups[i].keys() & groups[j].keys()
                if min(common) == group:
                    found.append((i, j, sum(min(groups[i][g], groups[j][g]) for g in common)))
        i, j, c = np.array(found, np.int64).reshape(-1, 3).T
        return pa.table({"a": node[i], "na": n[i].astype(np.int32), "b": node[j], "nb": n[j].astype(np.int32), "c": c})

    return _ordered(tiles.groupBy("group", "i", "j").applyInArrow(run, "a long, na int, b long, nb int, c long"))


def document_classes(found: Similar) -> DataFrame:
    """doc_id, n_shingles, component_id: the smallest doc_id that a document reaches by links, itself included.

    A row without an identifier that reaches none has a null component.
    """
    least = found.members.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"))
    whole = least.join(found.classes, "node", "left").withColumn("class", F.coalesce("component", "node"))
    smallest = whole.groupBy("class").agg(F.min("least").alias("component_id"))
    by_node = whole.join(smallest, "class").select("node", "component_id")
    return found.members.join(by_node, "node", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
