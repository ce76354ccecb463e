"""Derived keys."""

from pyspark.sql import Column, DataFrame, functions as F


def scd_id(keys: list[str], valid_from: str | Column = "valid_from") -> Column:
    """Surrogate key of one version: SHA-256 of the business key and its start time."""
    start = F.col(valid_from) if isinstance(valid_from, str) else valid_from
    parts = [F.col(k).cast("string") for k in keys] + [start.cast("string")]
    return F.sha2(F.concat_ws("||", *parts), 256)


def row_hash(df: DataFrame) -> Column:
    """64-bit hash of a whole row."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def spread_hash(df: DataFrame) -> Column:
    """A hash that also tells apart identical rows from different partitions.

    It depends on the row and its partition number only, not on row order, so a task that runs
    again after an executor was lost gives the same values.
    """
    return F.xxhash64(row_hash(df), F.spark_partition_id())
