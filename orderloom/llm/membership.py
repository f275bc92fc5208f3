"""Filters of a fixed size that keep most rows in their task before an exact join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of a filter: 2 MB, whatever the input; a filter that is full lets more rows through, never fewer.
BITS = 1 << 24


def bitmap(hashes: DataFrame, column: str) -> DataFrame:
    """bucket, bits: at most 512 rows of 4 KB with a bit set for each 64-bit hash in `column`."""
    place = hashes.select(F.col(column).bitwiseAND(F.lit(BITS - 1)).alias("p"))
    return place.groupBy(F.expr("p div 32768").alias("bucket")).agg(F.expr("bitmap_construct_agg(p % 32768)").alias("bits"))


def probably_in(df: DataFrame, column: str, bits: DataFrame) -> DataFrame:
    """The rows of `df` whose hash may be among those of the bitmap. Uses the column names _p, bucket and bits."""
    return (
        df.withColumn("_p", F.col(column).bitwiseAND(F.lit(BITS - 1)))
        .withColumn("bucket", F.expr("_p div 32768"))
        .join(F.broadcast(bits), "bucket")
        .where(F.expr("(cast(conv(hex(substring(bits, cast((_p % 32768) div 8 as int) + 1, 1)), 16, 10) as int) & shiftleft(1, cast(_p % 8 as int))) <> 0"))
        .drop("_p", "bucket", "bits")
    )
