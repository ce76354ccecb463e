"""Sizes known before a job runs, and the settings that follow from them."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession

# Compressed input per shuffle partition. Rows take a few times as much in a shuffle, which keeps
# a partition well within the memory of a task.
INPUT_BYTES_PER_PARTITION = 64 << 20

# Stored input per bucket of facts. A bucket is one task, which nothing splits, and the marts sort or
# group its rows: they then take twenty times and more what they take in a columnar file.
INPUT_BYTES_PER_BUCKET = 8 << 20

# Spark's stand-in for "size unknown" is the largest long.
UNKNOWN_BYTES = 1 << 62


def _known_bytes(plan) -> int:
    leaves = plan.collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(size for size in sizes if size < UNKNOWN_BYTES)


def input_bytes(df: DataFrame) -> int:
    """Sum of the known sizes of the plan's leaf relations; nothing is optimised or run.

    A leaf of unknown size, such as the result of an RDD, adds nothing; nor does a table whose
    partitions the catalog keeps, as their files are listed for a query's own partitions only.
    """
    return _known_bytes(df._jdf.queryExecution().analyzed())


def listed_bytes(df: DataFrame) -> int:
    """As ``input_bytes``, after partitions are pruned and their files listed; no file is read."""
    return _known_bytes(df._jdf.queryExecution().optimizedPlan())


def shuffle_width(spark: SparkSession) -> int:
    """Number of partitions a shuffle starts with."""
    initial = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    return int(initial or spark.conf.get("spark.sql.shuffle.partitions"))


def fit_session(df: DataFrame) -> None:
    """Make the session fit for an input of this size; small inputs change nothing.

    Shuffles get enough partitions, never fewer than the session has: AQE merges partitions that
    turn out small but does not split those that turn out large.
    """
    fit_session_to(df.sparkSession, input_bytes(df))


def fit_session_to(spark: SparkSession, size: int) -> None:
    """``fit_session`` for an input whose size is known."""
    needed = math.ceil(size / INPUT_BYTES_PER_PARTITION)
    if needed > shuffle_width(spark):
        spark.conf.set("spark.sql.shuffle.partitions", str(needed))


def bucket_count(sizes: list[int], per_bucket: int = INPUT_BYTES_PER_PARTITION) -> int:
    """Buckets for tables that are joined by one key: a power of two, so that it seldom changes, by
    the largest of their sizes."""
    largest = max(sizes, default=0)
    return 1 << max(0, math.ceil(math.log2(max(1, largest / per_bucket))))


def fact_buckets(spark: SparkSession, sizes: list[int], least: int = 1) -> int:
    """Buckets for facts of these stored sizes, so small that a task holds one in memory; at least
    ``least``, and no more than the session lets a table have."""
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
    wanted = max(least, bucket_count(sizes, INPUT_BYTES_PER_BUCKET))
    return min(wanted, 1 << (most.bit_length() - 1))
