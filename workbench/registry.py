"""Collects the registered queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from workbench.bindings import Roles

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Decimal columns as doubles, the type both engines print alike."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def query(name: str, sql: str | None = None):
    """Register ``build(roles) -> DataFrame`` under a name, with the SQL that checks it."""

    def wrap(build: Callable[[Roles], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = lambda spark, sf_dir: plain(build(Roles(spark, sf_dir)))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return wrap
