"""Keyed upsert into a table stored as plain Parquet, and into formats that can merge."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions.periods import ordered
from orderloom.operators.key_index import KeyIndex
from orderloom.sources.lake import Lake, Scratch


@dataclass(frozen=True)
class UpsertResult:
    """Partitions that were rewritten, the keys whose rows changed partition, and what the changed rows refer to.

    `moved` and `changed` are tables under `_kept` of the lake's root, or None; whoever asked for them by
    `keep_moved` and `keep` removes them once they are dealt with.
    """

    touched: list[dt.date | None]
    moved: str | None = None
    changed: str | None = None


def merged_rows(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """All source rows, and the target rows whose key the source does not hold."""
    kept = target.join(source.select(*keys), keys, "left_anti")
    return kept.unionByName(source)


def upsert(
    lake: Lake,
    table: str,
    source: DataFrame,
    keys: list[str],
    partition_by: str | None = None,
    newest: str | None = None,
    before_swap: Callable[[UpsertResult], None] | None = None,
    keep_moved: bool = False,
    keep: str | None = None,
    stored: bool = False,
) -> UpsertResult:
    """Update rows whose key exists, insert the others; `source` has one row per key.

    `source` is written once, since several plans read it; `stored` says that it is a plain read of files already.

    A source row always replaces the target's row. With `newest` the row with the higher
    value of that column stays, and equal ones are decided as `latest_by_key` does: batches
    may then arrive late, twice, and in any order. Rows that the target has already change
    nothing. Of a partitioned table, only the partitions that its key index names for the
    source's keys are read, and only those with changes are rewritten. `before_swap` is told
    what is about to change before any of it can be seen; with `keep_moved` that includes a
    table of the keys that change partition, with `keep` one of the values that the changed
    rows have and had in that column.
    """
    tell = before_swap or (lambda _: None)
    lake.recover(table)
    if not lake.exists(table):
        with Scratch(lake.spark) as scratch:
            rows = source if stored else scratch.stage(source, f"{table}-first")
            changed = _keep(lake, table, rows.select(keep)) if keep and not rows.isEmpty() else None
            result = UpsertResult(partition_values(rows, partition_by), changed=changed)
            tell(result)
            lake.publish(table, rows, partition_by)
        return result

    with Scratch(lake.spark) as scratch:
        target = lake.read(table)
        source = source.select(*target.columns)
        source = source if stored else scratch.stage(source, f"{table}-source")
        index = KeyIndex(lake, table, keys, partition_by) if partition_by else None
        near = in_partitions(target, partition_by, index.partitions(source)) if index else target
        changes = _changes(near, source, keys, partition_by, newest, scratch, table, keep)
        if changes.isEmpty():
            return UpsertResult([])
        rows = changes.select(*target.columns)
        if partition_by is None:
            tell(UpsertResult([]))
            lake.publish(table, merged_rows(target, rows, keys))
            return UpsertResult([])

        old = F.col(f"_old_{partition_by}")
        left = changes.where(F.col("_hit") & ~old.eqNullSafe(F.col(partition_by)))
        both = changes.select(partition_by).union(left.select(old))
        touched = partition_values(both, partition_by)
        moved = changed = None
        if keep_moved and not left.isEmpty():
            moved = f"{table}-moved-{uuid.uuid4().hex}"
            left.select(*keys, partition_by, old).write.parquet(lake.kept_path(moved))
        if keep:
            values = changes.select(keep)
            if keep not in keys:
                values = values.union(changes.where("_hit").select(f"_old_{keep}"))
            changed = _keep(lake, table, values)
        result = UpsertResult(touched, moved, changed)
        tell(result)
        index.add(changes.where(F.col("_hit").isNull() | ~old.eqNullSafe(F.col(partition_by))))
        rewritten = in_partitions(target, partition_by, touched)
        lake.replace_partitions(table, merged_rows(rewritten, rows, keys), partition_by, touched)
        return result


def _keep(lake: Lake, table: str, values: DataFrame) -> str:
    name = f"{table}-changed-{uuid.uuid4().hex}"
    values.distinct().write.parquet(lake.kept_path(name))
    return name


def _changes(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    partition_by: str | None,
    newest: str | None,
    scratch: Scratch,
    table: str,
    keep: str | None = None,
) -> DataFrame:
    """Source rows that will stand in the table and do not yet, written out once.

    They carry `_hit` (the key exists), the old partition and the old value of `keep`. Of the target only keys, the
    partition, the time and a hash of the row are joined; whole rows are read for keys whose
    versions have the same time and differ, which is rare.
    """
    others = [c for c in target.columns if c not in keys and c != newest]
    content = F.xxhash64(*[F.col(c) for c in target.columns if c not in keys])
    carried = [c for c in dict.fromkeys((partition_by, newest, keep)) if c and c not in keys]
    present = near_keys(target, source, keys).select(
        *keys,
        *[F.col(c).alias(f"_old_{c}") for c in carried],
        content.alias("_old_content"),
        F.lit(True).alias("_hit"),
    )
    joined = source.withColumn("_content", content).join(present, keys, "left")
    news = joined.where(F.col("_hit").isNull() | (F.col("_content") != F.col("_old_content")))
    if not newest:
        return scratch.stage(news, f"{table}-changes")
    old, new = F.col(f"_old_{newest}"), F.col(newest)
    newer = F.col("_hit").isNull() | (old.isNull() & new.isNotNull()) | (old < new)
    news = news.withColumn("_newer", F.coalesce(newer, F.lit(False)))
    decided = scratch.stage(news.where(F.col("_newer") | old.eqNullSafe(new)), f"{table}-changes")
    tied = decided.where(~F.col("_newer"))
    if tied.isEmpty():
        return decided
    # Equal times: the larger row in the order of the columns wins, as in `latest_by_key`.
    rows = target
    if partition_by:
        rows = in_partitions(target, partition_by, partition_values(tied, f"_old_{partition_by}"))
    standing = rows.select(*keys, F.struct(*others).alias("_standing"))
    won = tied.join(standing, keys).where(F.struct(*others) > F.col("_standing"))
    won = scratch.stage(won.select(*decided.columns), f"{table}-ties")
    return decided.where("_newer").unionByName(won)


def near_keys(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Target rows between the lowest and the highest source key.

    Keys mostly grow with time, so for a recent batch the range filter skips old row groups
    by their statistics. It only narrows what the join has to look at.
    """
    first = keys[0]
    low, high = source.agg(F.min(first), F.max(first)).first()
    return target.where(F.col(first).between(F.lit(low), F.lit(high)))


def partition_values(df: DataFrame, column: str | None) -> list[dt.date | None]:
    """Distinct values of a partition column: calendar periods, so a short list."""
    if column is None:
        return []
    return ordered(r[0] for r in df.select(column).distinct().collect())


def in_partitions(df: DataFrame, column: str, values: list[dt.date | None]) -> DataFrame:
    """Rows of the given partitions, as a filter that prunes folders."""
    wanted = F.col(column).isin([v for v in values if v is not None])
    return df.where(wanted | F.col(column).isNull() if None in values else wanted)


def merge_into_table(source: DataFrame, table: str, keys: list[str]) -> None:
    """The same upsert by MERGE, for catalog tables whose format has row-level operations."""
    incoming = source.alias("s")
    same_key = [F.col(f"{table}.{k}") == F.col(f"s.{k}") for k in keys]
    condition = same_key[0]
    for c in same_key[1:]:
        condition = condition & c
    incoming.mergeInto(table, condition).whenMatched().updateAll().whenNotMatched().insertAll().merge()
