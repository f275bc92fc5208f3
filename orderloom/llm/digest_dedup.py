"""Exact duplicates by a tree of digest runs, in DataFrame operations alone.

Every row belongs to a run, dealt by a hash of its identifier. A run holds one entry per digest: how many
rows it stands for and which of them stays. The runs then exchange entries in rounds. In a round, FAN
runs that differ in one digit of their number meet, and each of them takes over the entries whose digest has
that digit in its place; equal digests of the FAN runs meet there and are merged, keeping one entry. After
the last round a digest has one entry, and the entries are spread over all runs. No run ever gets more than
its share, however many copies a text has: a third of all rows is one entry per run after the first step.

The way back is by run as well: rows join the entries of their own run, so a large group of copies is
spread over the runs instead of meeting under one key.

A digest is taken as proof of equality only together with the byte length and a second, independent hash:
entries that agree in the digest but not in these are never merged, in any round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm.common import Staged, id_text, or_empty

#: Runs that meet in a round. Runs are FAN to the power of the number of rounds.
FAN = 8
_KEY = ("digest", "bytes", "check")


def rounds_for(spark: SparkSession) -> int:
    """Enough rounds that there is a run for each shuffle task at least."""
    tasks, rounds = int(spark.conf.get("spark.sql.shuffle.partitions")), 1
    while FAN**rounds < tasks:
        rounds += 1
    return rounds


def mark_duplicates(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max", rounds: int | None = None) -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical; null counts as empty. Of equal texts the row with the largest identifier
    stays (`keep="min"`: the smallest); a null identifier loses to any other, and of rows that share text and
    identifier exactly one stays. An empty table gives an empty result.
    """
    rounds = rounds or rounds_for(spark)
    runs = FAN**rounds
    staged = Staged(spark)
    text = or_empty("text")
    rows = staged.write(
        "rows",
        id_text(docs, id_col, text_col)
        .withColumn("row", F.monotonically_increasing_id())
        .select(
            "doc_id",
            "row",
            F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
            F.octet_length(text).alias("bytes"),
            F.xxhash64(text).alias("check"),
            F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.col("row")), F.lit(runs)).alias("run"),
        ),
    )
    chosen = F.max if keep == "max" else F.min
    rank = F.struct(F.col("doc_id").isNotNull().alias("named") if keep == "max" else F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")
    entries = staged.write("entries", rows.groupBy("run", *_KEY).agg(chosen(rank).alias("stays"), F.count("*").alias("n")))
    merged = entries.withColumnRenamed("run", "at")
    for step in range(rounds):
        place = FAN**step
        own = F.expr(f"at div {place}") % FAN
        new = F.expr(f"pmod(check, {runs}) div {place}") % FAN
        # A run is one partition: it is sorted by digest there, and entries that follow each other are merged.
        merged = merged.withColumn("at", F.col("at") + (new - own) * place).repartition("at")
        merged = merged.sortWithinPartitions("at", *_KEY).groupBy("at", *_KEY).agg(chosen("stays").alias("stays"), F.sum("n").alias("n"))
    merged = staged.write("merged", merged.drop("at"))
    back = entries.select("run", *_KEY).join(merged, [*_KEY])
    return rows.join(back, ["run", *_KEY]).select(
        "doc_id",
        F.col("stays.doc_id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("row") == F.col("stays.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
