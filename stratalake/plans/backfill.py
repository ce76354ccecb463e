"""Rebuilding a range of days of a table that is partitioned by month."""

from __future__ import annotations

import calendar
import datetime
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from stratalake.functions import year_month
from stratalake.operators.filters import between_days
from stratalake.sources.tables import columns_ddl, list_dir

PART = "part_month"


def _months(first: datetime.date, last: datetime.date) -> list[str]:
    months, year, month = [], first.year, first.month
    while (year, month) <= (last.year, last.month):
        months.append(f"{year:04d}-{month:02d}")
        year, month = (year, month + 1) if month < 12 else (year + 1, 1)
    return months


def month_bounds(first: str, last: str) -> tuple[datetime.date, datetime.date]:
    """The range widened to whole months."""
    start = datetime.date.fromisoformat(str(first)).replace(day=1)
    end = datetime.date.fromisoformat(str(last))
    return start, end.replace(day=calendar.monthrange(end.year, end.month)[1])


def backfill(
    spark: SparkSession,
    name: str,
    path: str,
    build: Callable[[datetime.date, datetime.date], DataFrame],
    first: str,
    last: str,
    date_column: str,
) -> list[str]:
    """Rebuild the months from ``first`` to ``last``; other months are not read or written.

    ``build`` gets the whole months and returns the table's rows for them; rows outside are cut.
    The rows are written to a fresh folder and each month is then pointed at its part of it. A
    month that has no rows any more is dropped. Returns the months rebuilt.
    """
    start, end = month_bounds(first, last)
    rows = between_days(build(start, end), date_column, str(start), str(end))
    folder = f"{path.rstrip('/')}/backfill_{uuid.uuid4().hex}"
    rows.withColumn(PART, year_month(date_column)).write.partitionBy(PART).parquet(folder)

    if not spark.catalog.tableExists(name):
        spark.sql(
            f"CREATE TABLE {name} ({columns_ddl(rows.schema)}, {PART} STRING) "
            f"USING parquet PARTITIONED BY ({PART}) LOCATION '{path.rstrip('/')}/table'"
        )
    written = set(list_dir(spark, folder))
    months = _months(start, end)
    for month in months:
        part = f"PARTITION ({PART} = '{month}')"
        if f"{PART}={month}" in written:
            target = f"{folder}/{PART}={month}"
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {part} LOCATION '{target}'")
            spark.sql(f"ALTER TABLE {name} {part} SET LOCATION '{target}'")
        else:
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {part}")
    spark.catalog.refreshTable(name)
    return months
