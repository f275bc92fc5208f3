"""Stored versions as tables of the session's catalog, each shown under its table's name by a view.

A version is a Spark table over its folder, with the schema noted at the write and its partitions added one by one:
no file is opened to infer a schema, and what an append costs does not depend on how many came before. The view makes
the step from one version to the next a single change, which readers see wholly or not at all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable
from urllib.parse import unquote

from pyspark.sql import SparkSession
from pyspark.sql import types as T

#: Partitions named in one statement.
_AT_ONCE = 500
# Fixed value: the folder name Spark gives to a NULL partition value.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
# Version that each view shows, by application and view; only spares statements that would change nothing.
_shown: dict[tuple[str, str], str] = {}


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def version_name(table: str, path: str) -> str:
    """Name of the table over one version's folder."""
    return f"{table}__{hashlib.sha256(path.encode()).hexdigest()[:12]}"


def show(
    spark: SparkSession,
    qualified: Callable[[str], str],
    table: str,
    path: str,
    schema: T.StructType,
    folder: str | None,
    folders: Callable[[], Iterable[str]],
    changed: Iterable[str] | None = None,
) -> None:
    """Show the version at `path` under the name of `table`.

    `folder` is the column whose values are folders, if any; `folders` lists them, and is asked only where the
    version is new to this catalog. Otherwise the `changed` folders are brought up to date, or all if it is None.
    """
    stored, view = qualified(version_name(table, path)), qualified(table)
    key = (spark.sparkContext.applicationId, view)
    known = spark.catalog.tableExists(stored)
    fresh = not known
    if fresh:
        hidden = [] if folder is None or folder in schema.names else [T.StructField(folder, T.StringType())]
        columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in [*schema, *hidden])
        by = f" PARTITIONED BY ({quoted(folder)})" if folder else ""
        location = path.replace("'", "\\'")
        spark.sql(f"CREATE TABLE {stored} ({columns}) USING parquet{by} LOCATION '{location}'")
    else:
        there = spark.table(stored).columns
        added = [f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema if f.name not in there]
        if added:
            fresh = True
            spark.sql(f"ALTER TABLE {stored} ADD COLUMNS ({', '.join(added)})")
    if folder:
        names = list(changed if known and changed is not None else folders())
        for i in range(0, len(names), _AT_ONCE):
            specs = " ".join(f"PARTITION ({_spec(n)})" for n in names[i : i + _AT_ONCE])
            spark.sql(f"ALTER TABLE {stored} ADD IF NOT EXISTS {specs}")
    if known:
        spark.sql(f"REFRESH TABLE {stored}")
    if fresh or _shown.get(key) != stored:
        listed = ", ".join(quoted(f.name) for f in schema)
        spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {listed} FROM {stored}")
        _shown[key] = stored


def _spec(folder: str) -> str:
    """`column=value` as a partition in SQL."""
    column, value = folder.split("=", 1)
    if value == NULL_FOLDER:
        return f"{quoted(column)}=NULL"
    text = unquote(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"{quoted(column)}='{text}'"


def forget(spark: SparkSession, qualified: Callable[[str], str], table: str, path: str) -> None:
    """Drop the table over a version that is deleted; its files are not the catalog's."""
    spark.sql(f"DROP TABLE IF EXISTS {qualified(version_name(table, path))}")
