"""Tables as names bound to paths.

Nothing here overwrites a path in place. A replaced table is written to a fresh folder and its
name is pointed there afterwards, so readers and plans that still scan the old files keep working
and a failed write leaves the table as it was.
"""

from __future__ import annotations

import datetime
import re
import uuid
from collections import Counter
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from stratalake.sizing import INPUT_BYTES_PER_BUCKET


# The partition of a table of loads.
LOAD = "_load"


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def make_dir(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _file_system(spark, path)
    fs.mkdirs(hadoop_path)


def list_dir(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; empty when there is none."""
    fs, hadoop_path = _file_system(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(hadoop_path))


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a text file, which may be compressed; the rest is not read."""
    fs, hadoop_path = _file_system(spark, path)
    io, compress = spark._jvm.java.io, spark._jvm.org.apache.hadoop.io.compress
    codec = compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration()).getCodec(hadoop_path)
    stream = fs.open(hadoop_path)
    if codec is not None:
        stream = codec.createInputStream(stream)
    reader = io.BufferedReader(io.InputStreamReader(stream, "UTF-8"))
    try:
        return reader.readLine()
    finally:
        reader.close()


def folder_bytes(spark: SparkSession, path: str) -> dict[str, int]:
    """Size of each file directly below a folder."""
    fs, hadoop_path = _file_system(spark, path)
    return {status.getPath().getName(): status.getLen() for status in fs.listStatus(hadoop_path)}


def columns_ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def table_location(spark: SparkSession, name: str) -> str:
    detail = spark.sql(f"DESCRIBE EXTENDED {name}")
    return detail.filter("col_name = 'Location'").first()["data_type"].rstrip("/")


def _same_columns(a: T.StructType, b: T.StructType) -> bool:
    def shape(schema):
        return [(f.name, f.dataType.simpleString()) for f in schema.fields]

    return shape(a) == shape(b)


@dataclass(frozen=True)
class Buckets:
    """Rows dealt to ``n`` buckets by a hash of ``column``, sorted by it within their files.

    Tables with equal buckets are joined and grouped by the column without a shuffle.
    """

    column: str
    n: int


# A bucket is read by one task, which nothing splits. Beyond this many times the mean size, and
# this size, the buckets are not declared, and readers shuffle as for any other table.
LARGEST_BUCKET = 4
SMALL_BUCKET_BYTES = 4 * INPUT_BYTES_PER_BUCKET

_BUCKET_OF_FILE = re.compile(r"_(\d+)(?:\.c\d+)?\.")


def table_buckets(spark: SparkSession, name: str) -> Buckets | None:
    """The buckets that the catalog knows of a table."""
    wanted = F.col("col_name").isin("Num Buckets", "Bucket Columns")
    detail = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").filter(wanted).collect()}
    if "Num Buckets" not in detail:
        return None
    return Buckets(detail["Bucket Columns"].strip("[]`"), int(detail["Num Buckets"]))


def bind_table(
    spark: SparkSession, name: str, path: str, schema: T.StructType, buckets: Buckets | None = None
) -> None:
    """Make ``name`` read ``path``, creating the table or moving it.

    A table whose columns stay, or that gets more, is moved without ever being absent. When columns
    leave or change their type, or the buckets change, the entry is dropped and created again; the
    files of an external table are not touched.
    """
    if spark.catalog.tableExists(name) and table_buckets(spark, name) != buckets:
        spark.sql(f"DROP TABLE {name}")
    if spark.catalog.tableExists(name):
        known = spark.table(name).schema
        added = T.StructType([f for f in schema.fields if f.name not in known.fieldNames()])
        kept = T.StructType([f for f in schema.fields if f.name in known.fieldNames()])
        if added.fields and _same_columns(known, kept):
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns_ddl(added)})")
        if _same_columns(known, kept):
            if table_location(spark, name).split(":", 1)[-1] != path.split(":", 1)[-1]:
                spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
                spark.catalog.refreshTable(name)
            return
        spark.sql(f"DROP TABLE {name}")
    layout = ""
    if buckets is not None:
        layout = f"CLUSTERED BY (`{buckets.column}`) SORTED BY (`{buckets.column}`) INTO {buckets.n} BUCKETS "
    spark.sql(f"CREATE TABLE {name} ({columns_ddl(schema)}) USING parquet {layout}LOCATION '{path}'")


def replace_table(df: DataFrame, name: str, path: str, **options) -> str:
    """Write all rows to a fresh folder below ``path``, with these options of the writer, and bind
    the name to it."""
    spark = df.sparkSession
    target = f"{path.rstrip('/')}/v_{uuid.uuid4().hex}"
    df.write.options(**options).parquet(target)
    bind_table(spark, name, target, df.schema)
    return target


def is_even(sizes: dict[str, int], buckets: Buckets) -> bool:
    """Whether no bucket of a written folder is too large for one task."""
    per_bucket = Counter()
    for file, size in sizes.items():
        if found := _BUCKET_OF_FILE.search(file):
            per_bucket[int(found[1])] += size
    largest = max(per_bucket.values(), default=0)
    return largest <= max(SMALL_BUCKET_BYTES, LARGEST_BUCKET * sum(per_bucket.values()) / buckets.n)


def replace_bucketed(df: DataFrame, name: str, path: str, buckets: Buckets, **options) -> str:
    """As ``replace_table``, with the rows in buckets.

    Rows are rebalanced by the bucket column into as many partitions as buckets, so a partition is
    a bucket and writes one file. Adaptive execution splits the partition of a hot key over several
    tasks, each with a file of its own. If a bucket is too large to be read by one task all the
    same, the table is bound without buckets: its files are read like any others.
    """
    spark = df.sparkSession
    target = f"{path.rstrip('/')}/v_{uuid.uuid4().hex}"
    staged = f"{name}__{uuid.uuid4().hex[:12]}"
    (
        df.hint("rebalance", buckets.n, buckets.column)
        .write.bucketBy(buckets.n, buckets.column)
        .sortBy(buckets.column)
        .options(path=target, **options)
        .format("parquet")
        .saveAsTable(staged)
    )
    # Only the entry: the files of an external table stay.
    spark.sql(f"DROP TABLE {staged}")
    even = is_even(folder_bytes(spark, target), buckets)
    bind_table(spark, name, target, df.schema, buckets if even else None)
    return target


def ensure_partitioned(
    spark: SparkSession, name: str, path: str, schema: T.StructType, column: str
) -> None:
    """A table partitioned by a text column; columns that ``schema`` adds are added to it.

    A table of that name without the partitions is dropped from the catalog, its files are kept.
    """
    data = T.StructType([f for f in schema.fields if f.name != column])
    if spark.catalog.tableExists(name):
        parts = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
        if parts == [column]:
            known = set(spark.table(name).columns)
            added = T.StructType([f for f in data.fields if f.name not in known])
            if added.fields:
                spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns_ddl(added)})")
            return
        spark.sql(f"DROP TABLE {name}")
    spark.sql(
        f"CREATE TABLE {name} ({columns_ddl(data)}, `{column}` STRING) USING parquet "
        f"PARTITIONED BY (`{column}`) LOCATION '{path.rstrip('/')}/table'"
    )


def partition_values(spark: SparkSession, name: str) -> list[str]:
    """Values of the table's one partition column."""
    rows = spark.sql(f"SHOW PARTITIONS {name}").collect()
    return [unquote(r[0].split("=", 1)[1]) for r in rows]


def point_partition(spark: SparkSession, name: str, column: str, value: str, folder: str) -> None:
    """Make a partition read a folder, adding or moving it."""
    part = f"PARTITION (`{column}` = '{value}')"
    spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {part} LOCATION '{folder}'")
    spark.sql(f"ALTER TABLE {name} {part} SET LOCATION '{folder}'")


def drop_partition(spark: SparkSession, name: str, column: str, value: str) -> None:
    spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (`{column}` = '{value}')")


def live_folders(spark: SparkSession, name: str) -> set[str]:
    """Paths, without their scheme, that the catalog reads for a table, or for a view over loads
    those that its manifest names."""
    if spark.catalog.getTable(name).tableType == "VIEW":
        staged, part = f"{name}__loads", f"PARTITION ({LOAD} = '%s')"
        loads = spark.table(f"{name}__manifest").first()["loads"]
        found = [table_location(spark, staged), *(table_location(spark, f"{staged} {part % x}") for x in loads)]
        return {_bare(path) for path in found}
    found = [table_location(spark, name)]
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        for row in spark.sql(f"SHOW PARTITIONS {name}").collect():
            parts = ", ".join(
                f"`{k}` = '{unquote(v)}'" for k, v in (p.split("=", 1) for p in row[0].split("/"))
            )
            detail = spark.sql(f"DESCRIBE EXTENDED {name} PARTITION ({parts})")
            found.append(detail.filter("col_name = 'Location'").first()["data_type"])
    return {_bare(path) for path in found}


def _bare(path: str) -> str:
    return "/" + path.split(":", 1)[-1].strip("/")


def remove_dead_folders(
    spark: SparkSession, name: str, path: str, older_than: datetime.timedelta
) -> list[str]:
    """Remove the folders directly below a table's path that the catalog reads no more.

    A folder stays if the table or one of its partitions is in it, however old it is, or if it
    changed within ``older_than``: give more than the longest query, which may still read it.
    """
    live = live_folders(spark, name)
    fs, top = _file_system(spark, path)
    limit = (datetime.datetime.now() - older_than).timestamp() * 1000
    removed = []
    for status in fs.listStatus(top) if fs.exists(top) else []:
        folder = _bare(status.getPath().toString())
        used = any(f == folder or f.startswith(f"{folder}/") for f in live)
        if status.isDirectory() and not used and status.getModificationTime() < limit:
            fs.delete(status.getPath(), True)
            removed.append(folder)
    return removed


def append_rows(df: DataFrame, name: str) -> None:
    """Add rows to a bound table, matching columns by name."""
    spark = df.sparkSession
    columns = spark.table(name).columns
    df.select(*columns).write.mode("append").insertInto(name)


def as_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def load_summary(spark: SparkSession, names: list[str]) -> DataFrame:
    """Row count per table name, NULL where the table does not exist."""
    parts = []
    for name in names:
        label = F.lit(name).alias("table_name")
        if spark.catalog.tableExists(name):
            counted = spark.table(name).agg(F.count(F.lit(1)).alias("row_count"))
            parts.append(counted.select(label, "row_count"))
        else:
            missing = F.lit(None).cast("bigint").alias("row_count")
            parts.append(spark.range(1).select(label, missing))
    return reduce(DataFrame.unionByName, parts)
