"""Language identification: multinomial naive Bayes over hashed character n-grams.

N-grams of one to three code points of the lower-cased text are hashed into a fixed number of buckets.
Training counts buckets by language on a bounded sample of labelled rows; the smoothed log-probabilities
(buckets x languages, float32) are broadcast, their size does not depend on the corpus. A batch of texts is
a sparse matrix of documents by buckets; its product with the dense matrix gives all scores of the batch.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.common import chunks, id_text, ship, texts_of

#: Buckets of the hash, lengths of the n-grams, and the added count that smooths them.
BUCKETS, ORDERS, SMOOTHING = 1 << 16, (1, 2, 3), 0.1
#: Most labelled rows of one language that are learnt from; the rest of the corpus is only predicted.
TRAIN_ROWS = 4000
UNKNOWN = "und"
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)


def features(texts: list[str], buckets: int = BUCKETS, orders: tuple[int, ...] = ORDERS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of the texts, and the number of n-grams in each text.

    Runs of anything but letters count as one space, so that digits, marks and layout say nothing.
    """
    spans = [f" {t.lower()} " for t in texts]
    points = np.frombuffer("".join(spans).encode("utf-32-le", "surrogatepass"), "<u4").copy()
    owner = np.repeat(np.arange(len(spans)), [len(t) for t in spans])
    points[~_letters()[points]] = 32
    keep = np.ones(len(points), bool)
    keep[1:] = (points[1:] != 32) | (points[:-1] != 32) | (owner[1:] != owner[:-1])
    points, owner = points[keep], owner[keep]
    shift = np.uint32(32 - (buckets - 1).bit_length())
    found, owners = [], []
    for order in orders:
        if len(points) < order:
            continue
        n = len(points) - order + 1
        mixed = np.full(n, order * 0x5BD1E995 & 0xFFFFFFFF, np.uint32)
        for i in range(order):
            mixed = (mixed ^ points[i : i + n]) * _FACTORS[i % 4]
            mixed ^= mixed >> np.uint32(15)
        same = owner[:n] == owner[order - 1 :]
        if order == 1:
            same &= points != 32
        found.append((mixed * np.uint32(0x9E3779B1) >> shift)[same])
        owners.append(owner[:n][same])
    who = np.concatenate(owners) if owners else np.zeros(0, np.int64)
    order = np.argsort(who, kind="stable")
    bucket = np.concatenate(found)[order] if found else np.zeros(0, np.uint32)
    return bucket, np.bincount(who, minlength=len(texts))


_table: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Which code points are letters."""
    if not _table:
        _table.append(np.fromiter((chr(p).isalpha() for p in range(0x110000)), bool, 0x110000))
    return _table[0]


def training_rows(docs: DataFrame, text_col: str, lang_col: str, allowed: Column, order_by: Column, rows_per_language: int = TRAIN_ROWS) -> DataFrame:
    """text and lang of about `rows_per_language` allowed rows of each language at most, taken by the hash of `order_by`."""
    usable = docs.where(allowed & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    # One row per language.
    counts = {row["lang"]: row["n"] for row in usable.groupBy(F.col(lang_col).alias("lang")).agg(F.count("*").alias("n")).collect()}
    place = F.pmod(F.xxhash64(order_by.cast("string")), F.lit(1_000_000)) / 1_000_000
    share = F.lit(1.0)
    for lang, n in counts.items():
        if n > rows_per_language:
            share = F.when(F.col(lang_col) == lang, F.lit(rows_per_language / n)).otherwise(share)
    return usable.where(place < share).select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))


def train(rows: DataFrame, buckets: int = BUCKETS, orders: tuple[int, ...] = ORDERS) -> tuple[list[str], np.ndarray]:
    """Languages in order, and the matrix of log-probabilities (buckets x languages, float32).

    Tasks count; the counts are summed by bucket and language, so that at most buckets x languages rows
    reach the driver. Languages are taken as equally likely beforehand.
    """
    ship(rows.sparkSession)

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            texts, langs = texts_of(batch.column("text")), batch.column("lang").to_pylist()
            for start, end in chunks(texts):
                bucket, sizes = features(texts[start:end], buckets, orders)
                for lang in set(langs[start:end]):
                    mine = np.repeat([x == lang for x in langs[start:end]], sizes)
                    counted = np.bincount(bucket[mine], minlength=buckets)
                    sums[lang] = sums[lang] + counted if lang in sums else counted
        for lang, counted in sums.items():
            at = np.flatnonzero(counted)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(at), pa.string()), "bucket": pa.array(at, pa.int64()), "n": pa.array(counted[at], pa.int64())})

    counted = rows.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(set(counted.column("lang").to_pylist()))
    matrix = np.zeros((buckets, len(langs)))
    if langs:
        column = np.searchsorted(langs, counted.column("lang").to_pylist())
        matrix[counted.column("bucket").to_numpy(), column] = counted.column("n").to_numpy()
        matrix += SMOOTHING
        matrix = np.log(matrix / matrix.sum(axis=0))
    return langs, matrix.astype(np.float32)


def _scorer(langs: list[str], shared, orders: tuple[int, ...]):
    """A function from texts to their languages and scores."""

    def score_all(texts: list[str]) -> tuple[list[str], list[float]]:
        weights, names, scores = shared.value, [], []
        for start, end in chunks(texts):
            bucket, sizes = features(texts[start:end], len(weights), orders)
            if not langs or not len(bucket):
                names += [UNKNOWN] * (end - start)
                scores += [0.0] * (end - start)
                continue
            some = np.flatnonzero(sizes)
            first = np.concatenate([[0], np.cumsum(sizes[some])[:-1]])
            total = np.stack([np.add.reduceat(weights[:, k][bucket], first, dtype=np.float64) for k in range(len(langs))], axis=1)
            mean = total / sizes[some, None]
            best = np.argmax(total, axis=1)
            odds = np.exp(10 * (mean - mean[np.arange(len(some)), best][:, None]))
            name = np.full(end - start, UNKNOWN, object)
            score = np.zeros(end - start)
            name[some], score[some] = np.array(langs, object)[best], 1 / odds.sum(axis=1)
            names += name.tolist()
            scores += score.tolist()
        return names, scores

    return score_all


def predict(spark: SparkSession, docs: DataFrame, model: tuple[list[str], np.ndarray], id_col: str = "doc_id", text_col: str = "text", orders: tuple[int, ...] = ORDERS) -> DataFrame:
    """doc_id, lang_pred and score of every row, from its whole text alone.

    `und` with score 0 for a text that is null or has no letter, and for all rows if nothing was learnt. The
    score is the posterior probability with evidence taken per n-gram to the power 10, so that it neither
    saturates with length nor depends on it; ties go to the language that sorts first.
    """
    source = id_text(docs, id_col, text_col)
    kind = source.schema["doc_id"].dataType.simpleString()
    score_all = _scorer(model[0], spark.sparkContext.broadcast(model[1]), orders)

    def run(batches):
        for batch in batches:
            names, scores = score_all(texts_of(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    return source.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def predict_into(spark: SparkSession, docs: DataFrame, model: tuple[list[str], np.ndarray], lang_col: str, score_col: str, text_col: str = "text", orders: tuple[int, ...] = ORDERS) -> DataFrame:
    """`docs` with the predicted language in `lang_col`, in place of what it holds, and the score added as the last column."""
    ship(spark)
    score_all = _scorer(model[0], spark.sparkContext.broadcast(model[1]), orders)
    names = docs.columns
    schema = T.StructType([T.StructField(lang_col, T.StringType()) if f.name == lang_col else f for f in docs.schema] + [T.StructField(score_col, T.DoubleType())])

    def run(batches):
        for batch in batches:
            langs, scores = score_all(texts_of(batch.column(names.index(text_col))))
            columns = [pa.array(langs, pa.string()) if n == lang_col else c for n, c in zip(names, batch.columns)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(scores, pa.float64())], [*names, score_col])

    return docs.mapInArrow(run, schema)
