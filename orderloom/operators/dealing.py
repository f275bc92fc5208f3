"""Rows dealt to tasks as they will be stored, so that they are added up and written in the same task."""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Stored bytes of a folder that one task takes; larger folders are dealt to several.
SLICE_BYTES = 8 * 1024 * 1024
#: Files that a folder may hold beyond those that its bytes account for, before all its rows are dealt anew.
FEW_FILES = 8
_SLICE = "_slice"


def crowded(stored: dict[dt.date | None, list[int]]) -> bool:
    """Whether a folder has come to hold many files for its bytes; `stored` has the sizes of the files in each."""
    return any(len(sizes) > FEW_FILES + sum(sizes) / SLICE_BYTES for sizes in stored.values())


def slices_of(stored: dict[dt.date | None, list[int]]) -> dict[dt.date | None, int]:
    """Folders that are too large for one task by the sizes of their files, and the tasks that each asks for."""
    wanted = {value: math.ceil(sum(sizes) / SLICE_BYTES) for value, sizes in stored.items()}
    return {value: n for value, n in wanted.items() if n > 1}


def add_up_by_folder(
    rows: DataFrame, keys: list[str], folder: str, sums: list[Column], large: dict[dt.date | None, int]
) -> DataFrame:
    """Sums per `keys`, in the order of tasks in which they are stored: one shuffle, by `folder`.

    `folder` follows from the keys. The `large` ones are dealt to several tasks by the first key, whose rows within a
    folder must be few: they meet in one task without being added up before.
    """
    by = [folder]
    if large:
        slices = F.lit(1)
        for value, n in large.items():
            slices = F.when(F.col(folder).eqNullSafe(F.lit(value).cast("date")), n).otherwise(slices)
        rows = rows.withColumn(_SLICE, F.pmod(F.xxhash64(keys[0]), slices))
        by.append(_SLICE)
    return rows.repartition(*by).groupBy(*dict.fromkeys([*by, *keys])).agg(*sums).drop(_SLICE)


def as_stored(rows: DataFrame, folder: str) -> DataFrame:
    """Rows shuffled as a write by `folder` would do it, which is then to be told that they are."""
    return rows.hint("rebalance", F.col(folder))
