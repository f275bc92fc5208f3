"""Session settings that results or plans depend on, and the shared scratch folder."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession

_SHUFFLE_BYTES_PER_TASK = 64 * 1024 * 1024
# Parquet is compressed and encoded; rows that are sorted are neither. Landed lines take 13 bytes stored and 160 in memory.
_ROW_EXPANSION = 12


def tune(
    spark: SparkSession, *input_paths: str, most_partitions: int | None = None
) -> SparkSession:
    """Set what the engine relies on; safe to call again at any time.

    Timestamps carry no zone in the sources, so the session zone is pinned. Joins and
    aggregations rely on adaptive execution to split hot join keys, to merge small shuffle
    partitions and to turn a join into a broadcast once the real size of a side is known.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # Size of a merged or split shuffle partition, and so of a file that is written: compressed bytes, four
        # times as many in memory, which a task sorts without spilling.
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
        # Tasks that read files sort as well, before the shuffle, and rows are ten times as wide there.
        "spark.sql.files.maxPartitionBytes": "32m",
        # Tables and intermediate results are mostly text and numbers in order, which zstd stores in less than snappy.
        "spark.sql.parquet.compression.codec": "zstd",
        # Small shuffles keep all cores busy none the less.
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    if input_paths:
        count = shuffle_partitions(spark, *input_paths, most=most_partitions)
        spark.conf.set("spark.sql.shuffle.partitions", str(count))
    return spark


def shuffle_partitions(spark: SparkSession, *input_paths: str, most: int | None = None) -> int:
    """Enough shuffle tasks for the bytes under `input_paths`, at least one per core.

    This is where adaptive execution starts from: it can merge partitions, but not add any
    except to split a skewed one. The number grows with the input without an end; every map
    task keeps a block per partition, though, so a cluster may set `most`. Gold can then be
    built in passes over groups of months (`run_gold`), whose shuffles stay below it.
    """
    stored = sum(stored_bytes(spark, p) for p in input_paths)
    by_size = math.ceil(stored * _ROW_EXPANSION / _SHUFFLE_BYTES_PER_TASK)
    wanted = max(spark.sparkContext.defaultParallelism, by_size)
    return min(wanted, most) if most else wanted


def broadcasts(df: DataFrame) -> bool:
    """Whether Spark broadcasts `df` in a join, by the size that it knows before anything runs."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return size <= limit


def stored_bytes(spark: SparkSession, path: str) -> int:
    fs, hadoop_path = filesystem(spark, path)
    return fs.getContentSummary(hadoop_path).getLength() if fs.exists(hadoop_path) else 0


def filesystem(spark: SparkSession, path: str):
    """Hadoop file system of `path` and the path itself: local disk, HDFS or object store."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def work_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: `spark.checkpoint.dir`, else one beside the warehouse."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"


def new_work_path(spark: SparkSession, label: str) -> str:
    """A path under the work folder that nothing else uses."""
    return f"{work_dir(spark)}/{label}-{uuid.uuid4().hex}"
