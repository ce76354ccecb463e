"""One row, or the first n rows, per key.

All are ``row_number`` with a limit: Spark plans a group limit on both sides of the shuffle, so
each map task sends at most n rows per key however many rows a hot key has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from stratalake.operators.joins import lookup_join


def top_n_per_group(
    df: DataFrame, keys: list[str], order: list[Column], n: int = 1, rank: str | None = None
) -> DataFrame:
    """First ``n`` rows of each key in the given order; ``rank`` keeps the position column."""
    position = rank or "_position"
    window = Window.partitionBy(*keys).orderBy(*order)
    kept = df.withColumn(position, F.row_number().over(window)).filter(F.col(position) <= n)
    return kept if rank else kept.drop(position)


def latest_per_key(
    df: DataFrame, keys: list[str], order_by: str, tie_break: list[str]
) -> DataFrame:
    """Newest row per key; rows with the same ``order_by`` are settled by ``tie_break``.

    Before that, of rows loaded together the one from the file that changed last is newer, where
    the table knows the files' times.
    """
    newest = [order_by] + [c for c in ["_source_modified_at"] if c in df.columns and c != order_by]
    order = [F.col(c).desc_nulls_last() for c in newest]
    order += [F.col(c).asc_nulls_last() for c in tie_break]
    return top_n_per_group(df, keys, order)


def first_per_key(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    return top_n_per_group(df, keys, [F.col(c).asc() for c in order_by])


def first_label(df: DataFrame, key: str, label: str) -> DataFrame:
    """Every distinct (key, label) with the alphabetically first label of its key, NULL first.

    The first label is an aggregate and not a window over the key's rows, so a key with very many
    labels is not gathered in one task.
    """
    labels = df.select(key, label).distinct()
    first = labels.groupBy(key).agg(
        F.min(F.struct(F.isnotnull(label).alias("present"), F.col(label).alias("label")))
        .getField("label")
        .alias(f"first_{label}")
    )
    return lookup_join(labels, first, key)
