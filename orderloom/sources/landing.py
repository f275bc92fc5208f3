"""Landing raw rows in Bronze: from CSV files, from literal rows, from any string table."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.schemas import BRONZE, CORRUPT, INGEST_TS
from orderloom.session import filesystem
from orderloom.sources.catalog import quoted
from orderloom.sources.lake import Lake


def to_bronze(df: DataFrame, table: str) -> DataFrame:
    """`df` in the landing shape: all strings, missing columns NULL.

    Further columns of the source are kept after the known ones, as text: what is not landed
    cannot be got back. Rows without an ingest time are stamped with the time of the load.
    """
    present = set(df.columns)
    columns = []
    for f in BRONZE[table]:
        value = F.col(f.name) if f.name in present else F.lit(None)
        if f.name == INGEST_TS:
            value = F.coalesce(value.cast("timestamp"), F.current_timestamp())
        columns.append(value.cast(f.dataType).alias(f.name))
    further = [f for f in df.schema if f.name not in BRONZE[table].names]
    return df.select(*columns, *[_as_text(f).alias(f.name) for f in further])


def _as_text(field: T.StructField) -> Column:
    """The column as a string; nested values as JSON."""
    value = F.col(quoted(field.name))
    if isinstance(field.dataType, T.StructType | T.ArrayType | T.MapType):
        return F.to_json(value)
    return value.cast("string")


def from_rows(spark: SparkSession, table: str, columns: list[str], rows: list[tuple]) -> DataFrame:
    """Literal rows for the listed columns."""
    schema = T.StructType([BRONZE[table][c] for c in columns])
    return to_bronze(spark.createDataFrame(rows, schema), table)


def string_schema(table: str) -> T.StructType:
    """The source's own columns: the landing shape without the ingest time."""
    return T.StructType([f for f in BRONZE[table] if f.name != INGEST_TS])


def csv_schema(spark: SparkSession, *paths: str) -> T.StructType:
    """The columns that the header of these files names, in its order, and one for rows that do not fit."""
    names = spark.read.csv(list(paths), header=True, **_QUOTING).columns
    return T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT]])


def csv_files(spark: SparkSession, path: str) -> list[str]:
    """The files under `path`; none of them is opened."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
    return sorted(r[0] for r in found.collect())


def by_header(spark: SparkSession, files: list[str]) -> list[list[str]]:
    """The files in groups that share their first line; files without one are left out.

    Only the beginning of each file is read, many files at a time. A header is one line, also where values may hold
    line breaks.
    """
    with ThreadPoolExecutor(_READERS) as pool:
        headers = pool.map(lambda file: _first_line(spark, file), files)
        groups: dict[str, list[str]] = {}
        for header, file in zip(headers, files):
            if header is not None:
                groups.setdefault(header, []).append(file)
    return [groups[header] for header in sorted(groups)]


def _first_line(spark: SparkSession, file: str) -> str | None:
    """First line of a text file, compressed or not."""
    jvm = spark._jvm
    fs, path = filesystem(spark, file)
    stream = fs.open(path)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration()).getCodec(path)
        plain = codec.createInputStream(stream) if codec else stream
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8")).readLine()
    finally:
        stream.close()


def from_csv(spark: SparkSession, table: str, path: str | list[str], multi_line: bool = False) -> DataFrame:
    """CSV files with a header each, in any order and with any further columns; a folder or a list of files.

    Files need not have the same header: each group of files with one is a scan of its own, and a
    column that some of them lack is NULL in their rows. Everything stays text; blanks around
    values are kept, and quotes are doubled inside quoted text. A row with more or fewer values
    than its header is kept, with its text in `_corrupt_record`. `multi_line` allows line breaks
    inside quotes; such files are not split, so a large one is read by one task.
    """
    scans = []
    for files in by_header(spark, csv_files(spark, path) if isinstance(path, str) else path):
        reader = spark.read.schema(csv_schema(spark, files[0])).options(**CSV_OPTIONS)
        scans.append(from_parsed(reader.csv(files, multiLine=multi_line), table))
    if not scans:  # no file, or no line in any
        return to_bronze(spark.createDataFrame([], string_schema(table)), table)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)


def from_parsed(rows: DataFrame, table: str) -> DataFrame:
    """Rows read with CSV_OPTIONS: quoted empty text is text, nothing at all is NULL."""
    columns = [
        F.when(F.col(quoted(c)) == _EMPTY, "").otherwise(F.col(quoted(c))).alias(c) for c in rows.columns
    ]
    return to_bronze(rows.select(*columns), table)


#: Files whose first lines are read at a time.
_READERS = 32
# How text is quoted. Quoted empty text is told from no text by a mark.
_EMPTY = "\ue000empty"
_QUOTING = {"quote": '"', "escape": '"'}
# Blanks are data until Silver trims them; `enforceSchema` off checks the header's names.
CSV_OPTIONS = {
    **_QUOTING,
    "header": True,
    "enforceSchema": False,
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "emptyValue": _EMPTY,
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
    # A row is judged by all its values, also where only some columns are asked for.
    "columnPruning": False,
}


def load(
    lake: Lake, table: str, rows: DataFrame, replace: bool = False, batch: str | None = None
) -> None:
    """Append rows to a landing table, or empty it first (`replace`).

    Rows that come again under the name of an earlier `batch` take its place.
    """
    if replace:
        lake.publish(table, rows)
    else:
        lake.append(table, rows, batch)
