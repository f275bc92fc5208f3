"""The corpus pipeline: language identification, line dedup, near duplicates, secrets, packing.

Each stage is a function of (spark, docs, sf_dir); its result is written and read again as the next one's docs.
All but the last return the columns of documents. A stage works on every row that its predecessor kept.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import jaccard, language, line_dedup, packing, secrets, spans
from orderloom.llm.common import Staged
from orderloom.llm.registry import held_out

#: Documents whose most likely language is less likely than this are not taken for text.
LEAST_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised language, which replaces `lang`; those that are null or without a letter go."""
    model = language.train(language.training_rows(docs, "text", "lang", ~held_out(), F.col("doc_id")))
    found = language.predict_into(spark, docs, model, "lang", "_score")
    return found.where((F.col("lang") != language.UNKNOWN) & (F.col("_score") >= LEAST_SCORE)).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that they repeat; a document that consisted of such lines alone goes."""
    cleaned = line_dedup.drop_repeated_lines(spark, docs)
    emptied = (F.col("_lines_dropped") > 0) & (F.length(F.trim(F.regexp_replace("text", r"\s+", " "))) == 0)
    return cleaned.where(~emptied).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest doc_id; rows without one stay."""
    classes = jaccard.document_classes(jaccard.similar(spark, docs))
    going = classes.where(F.col("component_id") < F.col("doc_id")).select("doc_id").distinct()
    return docs.join(going, "doc_id", "left_anti").select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret replaced by a mark of its kind."""
    masked = spans.replace_spans(docs, secrets.find, secrets.mask)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    cut = packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), added=packing.added_tokens(public_tokenizers.path("byte_bpe_50k.json")))
    digest = cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.place(spark, digest).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", drop_near_duplicates),
    ("secret_scan", mask_secrets),
    ("packing", pack),
]

#: Language models, edit distances and tokenisers are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written to the shared folder and read again."""
    staged = Staged(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged.write(name, stage(spark, docs, sf_dir))
    return docs
