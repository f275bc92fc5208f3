"""Consecutive numbers for all rows in the order of their values."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.sources.lake import stage

# Fixed value: monotonically_increasing_id() holds the partition above its lower 33 bits.
_ROW_BITS = 33


def number_rows(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Number rows 1..n by `order`, whose values should tell all rows apart.

    A range partitioning with a local sort puts the rows in order without a common task for
    any key; a row's number is its place in its partition plus the rows of the partitions
    before it. The ordered rows are written once, since both numbers must come from the same
    partitioning, and so are the few counts: the result is cheap to read again and need not be stored.
    """
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    placed = stage(placed, "numbering").withColumn("_part", F.shiftright("_place", _ROW_BITS))
    # One row per partition of the sort: as many rows as tasks, whatever the data holds.
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    offsets = stage(offsets, "numbering-offsets")
    in_part = F.col("_place").bitwiseAND((1 << _ROW_BITS) - 1)
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + in_part + 1)
        .drop("_part", "_place", "_before")
    )
