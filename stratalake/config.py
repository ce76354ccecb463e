"""Where tables live, what they are called, and the session settings that matter at scale."""

from __future__ import annotations

import tempfile
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

LAYERS = ("bronze", "silver", "gold")

# Settings for a cluster session. The number of shuffle partitions is not among them, as it has
# to follow the data: see ``sizing.fit_session``.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join also where its partitioning would have saved the next shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.cbo.enabled": "true",
    # Shuffle files go when their job ends, and not when the driver happens to collect its garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def apply_session_settings(spark: SparkSession) -> None:
    for key, value in SESSION_SETTINGS.items():
        spark.conf.set(key, value)


def scratch_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session, whose driver and executors are one machine, may fall back to a
    temporary folder; a cluster without the setting is an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="stratalake-"))
    return context.getCheckpointDir().rstrip("/")


@dataclass(frozen=True)
class Layout:
    """Deterministic names and paths: ``{base}/{env}/{layer}/{table}``."""

    base: str
    env: str = "dev"

    def database(self, layer: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}, expected one of {LAYERS}")
        return f"{self.env}_{layer}"

    def name(self, layer: str, table: str) -> str:
        return f"{self.database(layer)}.{table}"

    def path(self, layer: str, table: str) -> str:
        self.database(layer)
        return f"{self.base.rstrip('/')}/{self.env}/{layer}/{table}"

    def state_path(self, kind: str, table: str) -> str:
        return f"{self.base.rstrip('/')}/{self.env}/_state/{kind}/{table}"

    def create_databases(self, spark: SparkSession) -> None:
        for layer in LAYERS:
            location = f"{self.base.rstrip('/')}/{self.env}/{layer}"
            spark.sql(
                f"CREATE DATABASE IF NOT EXISTS {self.database(layer)} LOCATION '{location}'"
            )

    def table(self, spark: SparkSession, layer: str, table: str) -> DataFrame:
        return spark.table(self.name(layer, table))

    def exists(self, spark: SparkSession, layer: str, table: str) -> bool:
        return spark.catalog.tableExists(self.name(layer, table))
