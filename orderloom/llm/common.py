"""What the operators share: the shared work folder, staged tables and bounded batches of texts."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters handled at once by numpy code: temporaries stay at a few hundred MB.
CHUNK_CHARS = 1_000_000


def work_dir(spark: SparkSession) -> str:
    """A new folder that driver and executors share.

    Under `spark.checkpoint.dir` where the cluster names one, else beside the warehouse.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or (
        spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"
    )
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def ship(spark: SparkSession) -> None:
    """Let Spark hand this package to the Python workers of every executor, once per application.

    The archive is made in the driver's own folder; Spark's file server takes it from there.
    """
    context = spark.sparkContext
    if getattr(context, "_orderloom_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp()) / "orderloom_code.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._orderloom_shipped = True


class Staged:
    """Tables written once to the shared folder and read from there, so that a lost executor costs no rework.

    They live as long as the results that read them; `drop` removes what is no longer read.
    """

    def __init__(self, spark: SparkSession):
        ship(spark)
        self.spark, self.root = spark, work_dir(spark)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(name))
        return self.read(name, df)

    def read(self, name: str, like: DataFrame) -> DataFrame:
        return self.spark.read.schema(like.schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Identifier and text alone, so that no further column can clash with what an operator adds."""
    ship(docs.sparkSession)
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def or_empty(text: Column | str) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def chunks(texts: list[str], limit: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of `texts` of at most `limit` characters each; a longer text is a range of its own."""
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def texts_of(column) -> list[str]:
    """The texts of an Arrow column, null read as empty."""
    return [x or "" for x in column.to_pylist()]


def partitions_for(spark: SparkSession, rows: int, rows_per_task: int) -> int:
    """Tasks for so many rows: as many as the session asks for, or more where tasks would get too large."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // rows_per_task))


def only(rows: Iterable, default=0):
    """The single value of a one-row, one-column result."""
    for row in rows:
        return row[0] if row[0] is not None else default
    return default
