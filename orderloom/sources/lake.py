"""Parquet tables under one root folder, shown in the session catalog.

A rebuild writes a new `v=<n>` folder and readers move to it once its `_SUCCESS` file is
there; nothing is overwritten while it is being read, and a failed job leaves the table as it
was. Smaller changes replace whole partitions inside the current version: their files are
written beside it and moved in. Tables that only grow (landing tables, quarantines, key indexes) hold a
folder per batch inside the version, whoever writes it: a batch that is written again
replaces itself.
"""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.config import LakeNames
from orderloom.schemas import required
from orderloom.session import filesystem, new_work_path, tune
from orderloom.sources import catalog
from orderloom.sources.catalog import quoted

_SCHEMA_FILE = "_schema.json"
_BATCH = "_batch"
#: Folders whose files are moved at a time: each move waits for the file system.
MOVERS = 16


@dataclass(frozen=True)
class Replacement:
    """Rows that become the whole content of the partitions `values`; the others are left alone."""

    rows: DataFrame
    column: str
    values: list[dt.date | None]
    sort_by: str | None = None
    #: The rows come in tasks by `column` already.
    dealt: bool = False


@dataclass(frozen=True)
class Lake:
    spark: SparkSession
    root: str
    names: LakeNames = field(default_factory=LakeNames)
    in_catalog: bool = True
    #: How long a version stays after a newer one has taken its place: the longest job that may still read it.
    keep_for: dt.timedelta = dt.timedelta(days=2)

    def __post_init__(self) -> None:
        tune(self.spark)

    # ---- names -------------------------------------------------------------------------

    def schema_of(self, table: str) -> str:
        """The layer of a table follows from its prefix."""
        layer = table.split("_", 1)[0]
        return {"bronze": self.names.bronze, "silver": self.names.silver, "gold": self.names.gold}[
            layer
        ]

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{self.schema_of(table)}/{table}"

    def _qualified(self, *parts: str) -> str:
        first = [self.names.catalog] if self.names.catalog else []
        return ".".join(quoted(p) for p in [*first, *parts])

    def view_name(self, table: str) -> str:
        return self._qualified(self.schema_of(table), table)

    def create_schema(self, *tables: str) -> None:
        for schema in {self.schema_of(t) for t in tables}:
            self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {self._qualified(schema)}")

    def use_schema_of(self, table: str) -> None:
        """Make the layer of `table` the current schema, for SQL with plain table names."""
        self.create_schema(table)
        if self.names.catalog:
            self.spark.catalog.setCurrentCatalog(self.names.catalog)
        self.spark.catalog.setCurrentDatabase(self.schema_of(table))

    @staticmethod
    def grows(table: str) -> bool:
        """Landing tables, quarantines, key indexes and closed weeks only get further rows, batch by batch."""
        return table.startswith("bronze_") or table.endswith(("_rejected", "_orphans", "_keys", "_closed", "_late"))

    def batches(self, table: str) -> int:
        """Batch folders in the current version of a table that grows."""
        return len(self._folders(self.current_path(table)))

    def _folders(self, path: str) -> list[str]:
        """Names of the partition folders under `path`."""
        fs, pattern = filesystem(self.spark, f"{path}/*=*")
        return sorted(s.getPath().getName() for s in fs.globStatus(pattern) or [])

    def stored_files(self, table: str, column: str) -> dict[dt.date | None, list[int]]:
        """Sizes of the files in each folder of a table that is stored by a date."""
        fs, pattern = filesystem(self.spark, f"{self.current_path(table)}/{column}=*/*")
        sizes: dict[dt.date | None, list[int]] = {}
        for status in fs.globStatus(pattern) or []:
            name = status.getPath().getParent().getName().split("=", 1)[1]
            value = None if name == catalog.NULL_FOLDER else dt.date.fromisoformat(name)
            sizes.setdefault(value, []).append(status.getLen())
        return sizes

    # ---- reading -----------------------------------------------------------------------

    def versions(self, table: str) -> list[int]:
        """Versions that were written to the end, oldest first."""
        fs, pattern = filesystem(self.spark, f"{self.path(table)}/v=*/_SUCCESS")
        found = fs.globStatus(pattern) or []
        return sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in found)

    def exists(self, table: str) -> bool:
        return bool(self.versions(table))

    def current_path(self, table: str) -> str:
        versions = self.versions(table)
        if not versions:
            raise FileNotFoundError(f"table {table} has not been written under {self.root}")
        return f"{self.path(table)}/v={versions[-1]}"

    def read(self, table: str) -> DataFrame:
        return self._parquet(self.current_path(table))

    def _parquet(self, path: str) -> DataFrame:
        """Read with the schema noted at the write: no file is opened to infer it."""
        schema = self._noted_schema(path)
        rows = self.spark.read.schema(schema).parquet(path)
        return rows.select(*[F.col(quoted(c)) for c in schema.names])

    def _noted_schema(self, path: str) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.text_of(f"{path}/{_SCHEMA_FILE}")))

    def text_of(self, path: str) -> str:
        fs, hadoop_path = filesystem(self.spark, path)
        stream = fs.open(hadoop_path)
        text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        return text

    def is_file(self, path: str) -> bool:
        fs, hadoop_path = filesystem(self.spark, path)
        return fs.exists(hadoop_path)

    def put_text(self, path: str, text: str) -> None:
        fs, hadoop_path = filesystem(self.spark, path)
        stream = fs.create(hadoop_path, True)
        stream.write(bytearray(text, "utf-8"))
        stream.close()

    def _note_schema(self, path: str, schema: T.StructType, folder: str | None) -> None:
        """Keep the schema beside the files, and which column is stored as folders."""
        fields = [T.StructField(f.name, f.dataType, f.nullable, {"folder": True} if f.name == folder else {}) for f in schema]
        self.put_text(f"{path}/{_SCHEMA_FILE}", T.StructType(fields).json())

    # ---- writing -----------------------------------------------------------------------

    def publish(
        self,
        table: str,
        df: DataFrame,
        partition_by: str | None = None,
        sort_by: str | None = None,
        dealt: bool = False,
    ) -> None:
        """Write `df` as the new whole content of the table, whatever its schema was before."""
        self.publish_parts(table, [df], partition_by, sort_by, dealt)

    def publish_parts(
        self,
        table: str,
        parts: Iterable[DataFrame],
        partition_by: str | None = None,
        sort_by: str | None = None,
        dealt: bool = False,
    ) -> None:
        """Write a new version part by part, each with jobs of its own; shown once all are there."""
        fs, found = filesystem(self.spark, f"{self.path(table)}/v=*")
        begun = [int(s.getPath().getName()[2:]) for s in fs.globStatus(found) or []]
        path = f"{self.path(table)}/v={max(begun, default=0) + 1}"
        for n, df in enumerate(parts):
            into = f"{path}/{_BATCH}=published-{n}" if self.grows(table) else path
            write_parquet(required(df, table), into, partition_by, sort_by, add=n > 0, dealt=dealt)
            if n == 0:
                self._note_schema(path, df.schema, partition_by)
        self.put_text(f"{path}/_SUCCESS", "")
        self._register(table, path)
        self._forget_old_versions(table)

    def _forget_old_versions(self, table: str) -> None:
        """Delete versions that were replaced longer ago than `keep_for`."""
        versions = self.versions(table)
        for old, newer in zip(versions, versions[1:]):
            fs, done = filesystem(self.spark, f"{self.path(table)}/v={newer}/_SUCCESS")
            age = time.time() - fs.getFileStatus(done).getModificationTime() / 1000
            if age > self.keep_for.total_seconds():
                if self.in_catalog:
                    catalog.forget(self.spark, self._in_schema_of(table), table, f"{self.path(table)}/v={old}")
                self._delete(f"{self.path(table)}/v={old}")

    def append(
        self,
        table: str,
        df: DataFrame,
        batch: str | None = None,
        partition_by: str | None = None,
        sort_by: str | None = None,
    ) -> None:
        """Add rows to a table that grows. Under the name of an earlier batch they replace it.

        Columns that the table does not have yet are added to it; earlier rows have NULL there.
        """
        if not self.exists(table):
            self.publish_parts(table, [df.where("false")], partition_by, sort_by)
        path = self.current_path(table)
        known = self._noted_schema(path)
        new = [f for f in df.schema if f.name not in known.names]
        folder = f"{_BATCH}={quote(batch or uuid.uuid4().hex, safe='')}"
        write_parquet(df, f"{path}/{folder}", partition_by, sort_by)
        if new:
            self._note_schema(path, T.StructType([*known, *new]), None)
        self._register(table, path, [folder])

    def replace_partitions(
        self,
        table: str,
        df: DataFrame,
        column: str,
        values: list[dt.date | None],
        sort_by: str | None = None,
        dealt: bool = False,
    ) -> None:
        """Make `df`, which may read the table itself, the whole content of the partitions `values`."""
        self.replace({table: Replacement(df, column, values, sort_by, dealt)})

    def replace(self, changes: dict[str, Replacement]) -> None:
        """Replace partitions of several tables, all of them or none.

        The new rows are written beside the tables first and then noted. From there on the change will be made:
        should the driver be lost while their files are moved in, `recover` moves the rest.
        """
        self.recover(*changes)
        steps = []
        try:
            for table, change in changes.items():
                rows = f"{table}-rows-{uuid.uuid4().hex}"
                step = {"table": table, "path": self.current_path(table), "rows": rows}
                steps.append(step | {"values": [_partition_folder(change.column, v) for v in change.values]})
                write_parquet(required(change.rows, table), self.kept_path(rows), change.column, change.sort_by, dealt=change.dealt)
            for step in steps:
                step["files"] = self._files_by_folder(self.kept_path(step["rows"]))
        except BaseException:
            for step in steps:
                self.drop_kept(step["rows"])
            raise
        self._carry_out(self.note("replace", steps), steps)

    def recover(self, *tables: str) -> None:
        """Make changes that were noted and cut short. For the tables' one writer, before it reads."""
        for note, steps in self.notes("replace").items():
            if any(step["table"] in tables for step in steps):
                if any("files" not in step for step in steps):  # noted before files were listed: none has been moved
                    steps = [step | {"files": self._files_by_folder(self.kept_path(step["rows"]))} for step in steps]
                    self.put_text(f"{self.root.rstrip('/')}/_notes/{note}", json.dumps(steps))
                self._carry_out(note, steps)

    def _carry_out(self, note: str, steps: list[dict]) -> None:
        for step in steps:
            if step["path"] == self.current_path(step["table"]):  # a rebuild since then has made up for it
                self._overwrite(step)
        self.forget([note])
        for step in steps:
            self.drop_kept(step["rows"])

    def _overwrite(self, step: dict) -> None:
        """One table's part of a change; may be repeated.

        Files are moved one by one, those of several folders at a time. The note lists them all: one that is not beside the table any more has been moved.
        """
        path, source = step["path"], self.kept_path(step["rows"])
        fs, cut_short = filesystem(self.spark, f"{path}/.spark-staging-*")
        for status in fs.globStatus(cut_short) or []:
            fs.delete(status.getPath(), True)
        for folder in set(step["values"]) - set(step["files"]):
            self._delete(f"{path}/{folder}")
        with ThreadPoolExecutor(MOVERS) as pool:
            moves = [pool.submit(self._make_content, f"{path}/{f}", f"{source}/{f}", files) for f, files in step["files"].items()]
        for move in moves:
            move.result()
        self._register(step["table"], path, list(step["files"]))

    def _make_content(self, folder: str, source: str, files: list[str]) -> None:
        """Make these files, which are in `source` or here already, all that the folder holds."""
        fs, there = filesystem(self.spark, folder)
        path_class = self.spark._jvm.org.apache.hadoop.fs.Path
        fs.mkdirs(there)
        for status in fs.listStatus(there):
            if status.getPath().getName() not in files:
                fs.delete(status.getPath(), True)
        for name in files:
            to, waiting = path_class(f"{folder}/{name}"), path_class(f"{source}/{name}")
            if fs.exists(waiting):
                fs.delete(to, True)  # half a copy, where a store moves by copying
                if not fs.rename(waiting, to):
                    raise OSError(f"could not move {waiting} to {to}")
            elif not fs.exists(to):
                raise FileNotFoundError(f"{name} is neither in {source} nor in {folder}")

    def _files_by_folder(self, path: str) -> dict[str, list[str]]:
        """Names of the files in each partition folder under `path`."""
        fs, pattern = filesystem(self.spark, f"{path}/*=*/*")
        found: dict[str, list[str]] = {}
        for status in fs.globStatus(pattern) or []:
            file = status.getPath()
            found.setdefault(file.getParent().getName(), []).append(file.getName())
        return {folder: sorted(found[folder]) for folder in sorted(found)}

    def show_in_catalog(self, table: str) -> None:
        """Make a stored table known to this session's catalog, with all that others have added to it."""
        self._register(table, self.current_path(table))

    def _in_schema_of(self, table: str) -> Callable[[str], str]:
        return lambda name: self._qualified(self.schema_of(table), name)

    def _register(self, table: str, path: str, changed: list[str] | None = None) -> None:
        """Show the version in the catalog; `changed` names the folders that are new or replaced, None: any."""
        if not self.in_catalog or table.endswith("_keys"):
            return
        self.create_schema(table)
        schema = self._noted_schema(path)
        folder = _BATCH if self.grows(table) else next((f.name for f in schema if f.metadata.get("folder")), None)
        catalog.show(self.spark, self._in_schema_of(table), table, path, schema, folder, lambda: self._folders(path), changed)

    # ---- notes that outlive the driver -------------------------------------------------

    def note(self, kind: str, content: object) -> str:
        """Keep a small note under the lake's root; returns its name."""
        name = f"{kind}-{uuid.uuid4().hex}"
        self.put_text(f"{self.root.rstrip('/')}/_notes/{name}", json.dumps(content))
        return name

    def notes(self, kind: str) -> dict[str, object]:
        """All notes of a kind by name."""
        folder = f"{self.root.rstrip('/')}/_notes"
        fs, pattern = filesystem(self.spark, f"{folder}/{kind}-*")
        names = sorted(s.getPath().getName() for s in fs.globStatus(pattern) or [])
        return {n: json.loads(self.text_of(f"{folder}/{n}")) for n in names}

    def forget(self, names: Iterable[str]) -> None:
        for name in names:
            self._delete(f"{self.root.rstrip('/')}/_notes/{name}")

    def kept_path(self, name: str) -> str:
        """Folder under the root for rows that a note refers to."""
        return f"{self.root.rstrip('/')}/_kept/{name}"

    def drop_kept(self, name: str) -> None:
        self._delete(self.kept_path(name))

    def _delete(self, path: str) -> None:
        fs, hadoop_path = filesystem(self.spark, path)
        fs.delete(hadoop_path, True)


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: str | None = None,
    sort_by: str | None = None,
    add: bool = False,
    dealt: bool = False,
) -> None:
    """Write to a fresh path, or `add` to it. Partitioned output gets few files per partition.

    The rebalance hint sends rows of one partition value to few tasks, and lets adaptive
    execution split a value that is too large for one task. Sorted files let a
    filter on `sort_by` skip most of what it reads. Rows that were `dealt` to tasks by `partition_by`
    are written where they are. Spark's own mark of success is left out:
    the caller knows when a version is complete.
    """
    if partition_by is not None:
        if not dealt:
            df = df.hint("rebalance", F.col(partition_by))
        if sort_by:
            df = df.sortWithinPartitions(partition_by, sort_by)
    writer = df.write.mode("append" if add else "overwrite")
    writer = writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


class Scratch:
    """Intermediate results written to the work folder, and removed when the block ends.

    A staged result is computed once, however many plans read it, and cuts lineage: a lost
    executor costs its running tasks, not the joins before the written table.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self._paths: list[str] = []

    def stage(self, df: DataFrame, label: str) -> DataFrame:
        path = new_work_path(self.spark, label)
        self._paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        for path in self._paths:
            fs, hadoop_path = filesystem(self.spark, path)
            fs.delete(hadoop_path, True)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the work folder for the rest of the session, and read it back."""
    return Scratch(df.sparkSession).stage(df, label)


def _partition_folder(column: str, value: dt.date | None) -> str:
    return f"{column}={catalog.NULL_FOLDER if value is None else value}"
