"""Which landing files have been loaded.

A file is known by path, size and modification time, so a changed file of the same name counts as
new. A row is written only after its load succeeded: a load that failed is tried again.

The registry is a log: a load appends the rows of its own files, and the newest row of a file counts.
Once there are many appended parts they are merged into one.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from stratalake.config import Layout
from stratalake.sources.commits import CommittedTable, Manifest, new_load

REGISTRY_SCHEMA = T.StructType(
    [
        T.StructField("source_file", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("file_size", T.LongType()),
        T.StructField("modified_at", T.TimestampType()),
        T.StructField("loaded_at", T.TimestampType()),
        T.StructField("batch_id", T.StringType()),
        T.StructField("row_count", T.LongType()),
        # The columns that the file's header names; NULL for loads that did not look.
        T.StructField("columns", T.ArrayType(T.StringType())),
    ]
)
# Of the rows of a file and table the one with the highest number counts.
NUMBER = "_number"
MERGE_PARTS = 32

# Loads that run at the same time in one driver take turns.
_WRITER = threading.Lock()


def landed(pattern: str) -> str:
    """The pattern for a source's files as they are and gzipped."""
    return f"{pattern}{{,.gz}}"


def list_files(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """Path, size and modification time of the files, gzipped ones too; contents are not read.

    ``source_file`` has the form that a row's metadata has, ``path`` the one that readers take.
    """
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", landed(pattern))
        .load(folder)
        .select(
            F.col("path"),
            F.col("_metadata.file_path").alias("source_file"),
            F.col("length").alias("file_size"),
            F.col("modificationTime").alias("modified_at"),
        )
    )


class Registry:
    """The newest row of each (file, table), as a view over an append-only log."""

    def __init__(self, spark: SparkSession, layout: Layout):
        self.spark = spark
        self.name = layout.name("bronze", "ingestion_registry")
        path = layout.path("bronze", "ingestion_registry")
        self.log = CommittedTable(spark, f"{self.name}_log", path)

    def ensure(self) -> None:
        if self.spark.catalog.tableExists(self.name):
            return
        with _WRITER:
            if self.log.recover() is None:
                schema = T.StructType([*REGISTRY_SCHEMA.fields, T.StructField(NUMBER, T.LongType())])
                first = new_load()
                self.log.stage(self.spark.createDataFrame([], schema), first)
                self.log.append(None, first, "")
            columns = ", ".join(REGISTRY_SCHEMA.fieldNames())
            self.spark.sql(
                f"CREATE OR REPLACE VIEW {self.name} AS SELECT {columns} FROM (SELECT *, row_number() OVER ("
                f"PARTITION BY source_file, table_name ORDER BY {NUMBER} DESC) AS rank FROM {self.log.name}) "
                "WHERE rank = 1"
            )

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def pending(self, files: DataFrame, table: str, target: str, force: bool = False) -> DataFrame:
        """Files to load: all when forced or the target is gone, otherwise the unknown ones."""
        if force or not self.spark.catalog.tableExists(target):
            return files
        known = self.table().filter(F.col("table_name") == table)
        return files.join(known, ["source_file", "file_size", "modified_at"], "left_anti")

    def batches_of(self, files: DataFrame, table: str) -> list[str]:
        """Batches in which earlier states of these files were loaded."""
        known = self.table().filter(F.col("table_name") == table).select("source_file", "batch_id")
        found = known.join(files.select("source_file"), "source_file").select("batch_id").distinct()
        return [r["batch_id"] for r in found.collect()]

    def record(self, loads: DataFrame, load: str | None = None) -> None:
        """Append one row per (file, table) after a successful load.

        Given a ``load``, its rows are appended once, however often this is asked for.
        """
        load = load or new_load()
        with _WRITER:
            manifest = self.log.recover() or Manifest()
            if load in manifest.batches:
                return
            part = new_load()
            self.log.stage(loads.select(*REGISTRY_SCHEMA.fieldNames()).withColumn(NUMBER, F.lit(manifest.commit)), part)
            made = self.log.append(manifest, part, load)
            if len(made.loads) > MERGE_PARTS:
                self._merge(made)

    def _merge(self, manifest: Manifest) -> None:
        """One part with the rows that count, in place of all parts; which loads came is kept."""
        newest = Window.partitionBy("source_file", "table_name").orderBy(F.col(NUMBER).desc())
        rows = self.spark.table(self.log.name).withColumn("rank", F.row_number().over(newest))
        part = new_load()
        self.log.stage(rows.filter("rank = 1").drop("rank"), part)
        # The latest load of each table is among the latest parts: only it can be asked for again.
        self.log.commit(
            Manifest([part], [manifest.batches[-1]], manifest.loads, manifest.commit + 1)
        )

    def columns_seen(self) -> DataFrame:
        """The schema log: when each column of each table was first delivered, and in which batch."""
        spread = self.table().select("table_name", "loaded_at", "batch_id", F.explode("columns").alias("column_name"))
        first = F.min_by("batch_id", F.struct("loaded_at", "batch_id"))
        return spread.groupBy("table_name", "column_name").agg(
            F.min("loaded_at").alias("first_loaded_at"), first.alias("first_batch_id")
        )
