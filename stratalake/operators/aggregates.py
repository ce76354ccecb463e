"""Aggregates over groups; each states its own partial aggregation through ``groupBy``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from stratalake.config import scratch_dir
from stratalake.functions import ratio


def row_volume(df: DataFrame, keys: list, name: str = "row_volume") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def distinct_volume(
    df: DataFrame, keys: list, column: str, name: str = "distinct_volume", approximate: bool = False
) -> DataFrame:
    """Distinct non-NULL values per group, exact unless ``approximate`` asks for a sketch."""
    count = F.approx_count_distinct(column) if approximate else F.countDistinct(column)
    return df.groupBy(*keys).agg(count.alias(name))


def distinct_volume_if(
    df: DataFrame, keys: list[str], column: str, flag: str
) -> DataFrame:
    """Distinct values per group, in total and among flagged rows, in one pass.

    Two distinct counts in one aggregate would expand every row twice. Reducing to one row per
    (group, value) first keeps the shuffle at one row per value.
    """
    per_value = df.groupBy(*keys, column).agg(
        F.max(F.coalesce(F.col(flag), F.lit(False))).alias("_flagged")
    )
    return per_value.groupBy(*keys).agg(
        F.count(column).alias("distinct_volume"),
        F.count(F.when(F.col("_flagged"), F.col(column))).alias("flagged_distinct_volume"),
    )


def summarise(df: DataFrame, keys: list, measures: dict[str, Column]) -> DataFrame:
    """Several named aggregates per group."""
    return df.groupBy(*keys).agg(*[m.alias(name) for name, m in measures.items()])


def pivot_sum(
    df: DataFrame,
    keys: list[str],
    category: str,
    value: Column,
    categories: list[str],
    prefix: str = "total",
) -> DataFrame:
    """Sum per group, in total and for each of a fixed list of categories."""
    picked = [
        F.sum(F.when(F.col(category) == c, value).otherwise(F.lit(0))).alias(f"{prefix}_{c}")
        for c in categories
    ]
    return df.groupBy(*keys).agg(F.sum(value).alias(prefix), *picked)


def max_and_count(df: DataFrame, column: str) -> DataFrame:
    return df.agg(
        F.max(column).alias(f"max_{column}"), F.count(F.lit(1)).alias("total_rows")
    )


def distinct_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Number of distinct keys, NULL counting as a value."""
    return df.select(*keys).distinct().agg(F.count(F.lit(1)).alias("distinct_keys"))


def centroid(df: DataFrame, keys: list[str], lat: str, lng: str, digits: int = 6) -> DataFrame:
    """Mean position per group, rounded.

    Coordinates are summed as decimals with twelve places: the mean of doubles would depend on
    the order in which partial sums arrive.
    """

    def mean(column):
        return F.round(F.avg(F.col(column).cast("decimal(18,12)")), digits).cast("double")

    return df.groupBy(*keys).agg(mean(lat).alias(lat), mean(lng).alias(lng))


def share_of_pane(df: DataFrame, pane: list[str], n: str, name: str = "share") -> DataFrame:
    """Each row's part of its pane's total, for an already aggregated table.

    The window holds one row per mark of a chart, never base rows.
    """
    return df.withColumn(name, ratio(n, F.sum(n).over(Window.partitionBy(*pane))))


def count_report(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its row count."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def newest(df: DataFrame, column: str, n: int, tie_break: list[str]) -> DataFrame:
    """The ``n`` newest rows."""
    return df.orderBy(F.col(column).desc(), *tie_break).limit(n)


def with_positions(df: DataFrame, order_by: list, name: str = "position") -> DataFrame:
    """Each row's place, from 1, in the order of columns that no two rows share.

    Rows are dealt to ranges and sorted there; a row's place is its place in its range after the
    rows of the ranges before. Only one number per range meets in one place. The sorted rows are
    written once, as another run might cut the ranges elsewhere.
    """
    scratch_dir(df.sparkSession)
    ranged = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    # The lower bits of these ids count the rows of a partition.
    in_range = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = ranged.withColumns({"__range": F.spark_partition_id(), "__place": in_range}).checkpoint()
    sizes = placed.groupBy("__range").agg(F.count(F.lit(1)).alias("__size"))
    earlier = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__range", F.coalesce(F.sum("__size").over(earlier), F.lit(0)).alias("__start"))
    # One row per range.
    numbered = placed.join(F.broadcast(starts), "__range")
    return numbered.withColumn(name, F.col("__start") + F.col("__place") + 1).drop("__range", "__place", "__start")


def any_row(df: DataFrame, condition: Column) -> DataFrame:
    """One row saying whether any row meets the condition; stops at the first one found."""
    probe = df.filter(condition).select(F.lit(1).alias("_one")).limit(1)
    return probe.agg((F.count("_one") > 0).alias("found"))
