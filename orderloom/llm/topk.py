"""Exact nearest vectors by inner product, pruned with segment statistics from coarse to fine.

A vector is cut into 1, 4 and 16 segments; a segment is described by its mean and its deviation from it. The
distance of two vectors is at least what the means and deviations alone make it, so their inner product is at
most sum(size * mean * mean + deviation * deviation). For a block of queries and a block of candidates the
coarsest bound is one small matrix product. The best few by bound are scored and give each query a score
to beat; pairs whose bound is below it are dropped level by level, and what is left is scored exactly.

Vectors travel as blocks of bounded size. A block of queries meets each block of candidates under a key of
its own; no task, and not the driver, ever holds more than one block of each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderloom.llm.common import Staged, only, ship

SCALE, LEVELS = 256, (1, 4, 16)
#: Queries and candidates in a block, and queries that are bounded at once.
QUERIES, CANDIDATES, AT_ONCE = 8192, 2048, 512
#: Bytes of a block, and blocks of candidates that a block of queries meets in one task at most.
BLOCK_BYTES, TOGETHER = 1 << 22, 16
#: Share of pairs left from which a level is computed for all pairs at once.
DENSE = 0.05


def _blocks(vectors: DataFrame, size: int) -> DataFrame:
    """Blocks of at most `size` vectors of one length and BLOCK_BYTES: block, length, ids and values (binary)."""
    names = ["part", "length", "ids", "values"]

    def run(batches):
        held: dict[int, list] = {}

        def pack(length):
            ids, rows = zip(*held.pop(length))
            return pa.RecordBatch.from_arrays(
                [pa.array([0], pa.int32()), pa.array([length], pa.int32()), pa.array([np.array(ids, "<i8").tobytes()]), pa.array([np.array(rows, "<f8").tobytes()])], names
            )

        for batch in batches:
            for name, values in zip(batch.column("vec_id").to_pylist(), batch.column("v").to_pylist()):
                rows = held.setdefault(len(values), [])
                rows.append((name, values))
                if len(rows) >= min(size, max(1, BLOCK_BYTES // (8 * max(1, len(values))))):
                    yield pack(len(values))
        for length in list(held):
            yield pack(length)

    found = vectors.mapInArrow(run, "part int, length int, ids binary, values binary")
    return found.withColumn("block", F.monotonically_increasing_id()).drop("part")


def _statistics(values: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations by segment, scaled so that the bound of two vectors is the product of their rows."""
    n, length = values.shape
    edges = np.unique(np.linspace(0, length, segments + 1).astype(int))[:-1] if length else np.zeros(0, int)
    if not len(edges):
        return np.zeros((n, 0))
    sizes = np.diff(np.r_[edges, length])
    total = np.add.reduceat(values, edges, axis=1)
    square = np.add.reduceat(values * values, edges, axis=1)
    return np.hstack([total / np.sqrt(sizes), np.sqrt(np.maximum(square - total * total / sizes, 0))])


def best(queries: np.ndarray, query_ids: np.ndarray, values: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each query its k best candidates in this block, as (query row, candidate row, score); fewer if there are fewer.

    Rows hold whole numbers. Candidates under the query's own identifier are left out.
    """
    pick_q, pick_x, picked = [], [], []
    fine = [_statistics(values, m) for m in LEVELS]
    small = len(values) == 0 or float(np.abs(values).max(initial=0)) ** 2 * max(1, values.shape[1]) < 2**53
    exact = values if small else values.astype(np.int64)
    norm = np.sqrt((values * values).sum(axis=1)).max(initial=0)
    for low in range(0, len(queries), AT_ONCE):
        part = queries[low : low + AT_ONCE]
        whole = part if small and float(np.abs(part).max(initial=0)) ** 2 * max(1, part.shape[1]) < 2**53 else part.astype(np.int64)
        stats = [_statistics(part, m) for m in LEVELS]
        slack = 1e-9 * norm * np.sqrt((part * part).sum(axis=1)) + 1e-6
        bound = stats[0] @ fine[0].T
        bound[query_ids[low : low + AT_ONCE, None] == ids[None, :]] = -np.inf
        beat = np.full((len(part), 1), -np.inf)
        alive = bound > -np.inf
        # While many pairs are left, a level is one matrix product; then only the pairs left are bounded.
        level = 0
        while True:
            if len(values) > k:
                seeds = np.argpartition(-np.where(alive, bound, -np.inf), k - 1, axis=1)[:, :k]
                scores = np.einsum("ij,ikj->ik", whole, exact[seeds]).astype(np.float64)
                scores[~np.take_along_axis(alive, seeds, axis=1)] = -np.inf
                beat = np.maximum(beat, scores.min(axis=1, keepdims=True))
            alive &= bound >= beat - slack[:, None]
            level += 1
            if level == len(LEVELS) or np.count_nonzero(alive) < DENSE * alive.size:
                break
            bound = stats[level] @ fine[level].T
        many = np.count_nonzero(alive) >= DENSE * alive.size
        if many:
            # Scores of all pairs; those from a query's k-th best on are kept, ties included.
            scores = whole @ exact.T
            least = -np.inf if scores.dtype.kind == "f" else np.iinfo(scores.dtype).min
            scores = np.where(alive, scores, least)
            if len(values) > k:
                alive &= scores >= np.partition(scores, len(values) - k, axis=1)[:, len(values) - k, None]
        q, x = np.nonzero(alive)
        for mine, theirs in zip(stats[level:], fine[level:]):
            keep = np.concatenate([np.zeros(0, bool)] + [
                np.einsum("ij,ij->i", mine[q[i : i + 100_000]], theirs[x[i : i + 100_000]]) >= (beat[:, 0] - slack)[q[i : i + 100_000]] for i in range(0, len(q), 100_000)
            ])
            q, x = q[keep], x[keep]
        if many:
            score = scores[q, x].astype(np.int64)
        else:
            score = np.concatenate([np.zeros(0, np.int64)] + [
                np.einsum("ij,ij->i", whole[q[i : i + 100_000]], exact[x[i : i + 100_000]]).astype(np.int64) for i in range(0, len(q), 100_000)
            ])
        order = np.lexsort((ids[x], -score, q))
        q, x, score = q[order], x[order], score[order]
        first = np.searchsorted(q, q, side="left")
        top = np.arange(len(q)) - first < k
        pick_q.append(q[top] + low)
        pick_x.append(x[top])
        picked.append(score[top])
    join = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)
    return join(pick_q, np.int64), join(pick_x, np.int64), join(picked, np.int64)


def top_k(spark: SparkSession, table: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k largest inner products with all other vectors.

    Components become floor(scale * x). Ties go to the smaller identifier. Vectors that are null or hold a null
    or non-finite component take no part, nor do rows without an identifier; vectors are compared with those
    of their own length. A query is not compared with rows under its own identifier; a query row that occurs
    twice counts once. Scores must fit 64 bits. An empty table gives an empty result.
    """
    ship(spark)
    x = F.col(vector_col)
    sound = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    vectors = table.where(F.col(id_col).isNotNull() & x.isNotNull() & sound).select(
        F.col(id_col).cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("double")).alias("v"), is_query.alias("_query")
    )
    staged = Staged(spark)
    candidates = staged.write("candidates", _blocks(vectors.select("vec_id", "v"), CANDIDATES))
    queries = vectors.where("_query").select("vec_id", "v").distinct()
    queries = staged.write("queries", _blocks(queries, QUERIES))
    # Candidate blocks are dealt to shares, enough to keep all tasks busy; every block of queries goes to every share.
    found = max(1, candidates.count())
    shares = max(min(found, 4 * spark.sparkContext.defaultParallelism), -(-found // TOGETHER))
    blocks = max(1, only(queries.agg(F.count("*")).collect()))
    left = candidates.select("length", "ids", "values", F.pmod(F.xxhash64("block"), F.lit(shares)).alias("share"))
    numbered = queries.select("length", F.col("ids").alias("qids"), F.col("values").alias("qvalues"), F.pmod(F.xxhash64("block"), F.lit(blocks)).alias("to"), "block")
    left = left.withColumn("to", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    right = numbered.withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shares - 1).cast("long"))))
    # The copies are not seen in the size of the stored blocks, so that Spark must not choose to broadcast them.
    met = left.hint("merge").join(right, ["length", "to", "share"]).select("length", "ids", "values", "qids", "qvalues", "block")

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                read = lambda name, kind: np.frombuffer(batch.column(name)[i].as_buffer(), kind)  # noqa: E731, B023
                length, ids, query_ids = batch.column("length")[i].as_py(), read("ids", "<i8"), read("qids", "<i8")
                values, queries = read("values", "<f8").reshape(len(ids), length), read("qvalues", "<f8").reshape(len(query_ids), length)
                q, at, score = best(queries, query_ids, values, ids, k)
                block = np.full(len(q), batch.column("block")[i].as_py(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (block, q, query_ids[q], ids[at], score)], ["block", "row", "query_id", "vec_id", "score"])

    scored = met.mapInArrow(run, "block long, row long, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("block", "row").orderBy(F.desc("score"), "vec_id"))
    return scored.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
