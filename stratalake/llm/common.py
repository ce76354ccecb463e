"""What the operators of this package share: words, batches, scratch tables, table names."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from stratalake.config import scratch_dir

# What separates words, as a regular expression and as the words' own pattern.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

# Rows and bytes of one batch to a Python worker. Texts may be long, so rows alone bound nothing.
BATCH_ROWS = 2_000
BATCH_BYTES = 8 << 20


# Arguments whose results a worker remembers, in each of two generations; longer arguments rarely
# come again.
REMEMBERED = 100_000
LONGEST_REMEMBERED = 48


class Remembering(dict):
    """A function's results for the arguments met lately: two generations of bounded size."""

    def __init__(self, function, most: int | None = None) -> None:
        super().__init__()
        self.function, self.most, self.older = function, most, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.function(key)
        if len(key) <= LONGEST_REMEMBERED:
            self.make_room()
            self[key] = value
        return value

    def make_room(self) -> None:
        """A full generation becomes the older one, and that one is forgotten."""
        if len(self) >= (self.most or REMEMBERED):
            self.older = dict(self)
            self.clear()

    def put(self, keys: list, values: list) -> None:
        """Remember results until room is made the next time."""
        self.update((k, v) for k, v in zip(keys, values) if len(k) <= LONGEST_REMEMBERED)

    def unknown(self, keys: set) -> list:
        """The keys whose results are not remembered; those of the older generation are renewed.

        Room is made before, so that all keys are at hand once the results are put.
        """
        self.make_room()
        older = self.older
        missing = [k for k in keys if k not in self]
        again = {k: older[k] for k in missing if k in older}
        self.update(again)
        return [k for k in missing if k not in again]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Let the executors' Python workers import this package, however the driver found it."""
    context = spark.sparkContext
    if getattr(context, "_stratalake_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="stratalake-")) / "stratalake.zip"
    with zipfile.ZipFile(target, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, str(source.relative_to(root.parent)))
    context.addPyFile(str(target))
    context._stratalake_shipped = True


def prepare_workers(spark: SparkSession) -> None:
    """Ship the package and keep Arrow batches small, in rows and in bytes, for this session."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def column_udf(spark: SparkSession, step: Callable[[list], list], fields: str, types: list):
    """A vectorised function of one column: ``step`` maps a list of values to a list of columns.

    Marked as not deterministic, so that a filter on its result doesn't make it run twice.
    """
    prepare_workers(spark)
    names = [f.name for f in T._parse_datatype_string(fields)]

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            columns = step(batch.to_pylist())
            yield pa.StructArray.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names
            )

    return F.arrow_udf(run, fields).asNondeterministic()


def with_fields(df: DataFrame, made: Column, names: list[str]) -> DataFrame:
    """Add the fields of a struct as columns; they replace columns of the same names."""
    hidden = "__made"
    out = df.withColumn(hidden, made)
    return out.withColumns({n: F.col(hidden)[n] for n in names}).drop(hidden)


def written(df: DataFrame, what: str) -> DataFrame:
    """The rows as a table in the shared scratch folder, computed once and kept if executors go."""
    path = f"{scratch_dir(df.sparkSession)}/{what}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows, computed now and kept in the shared checkpoint folder; the plan starts there."""
    scratch_dir(df.sparkSession)
    return df.checkpoint()


def held_out(id_column: str = "doc_id", modulus: int = 4, remainder: int = 2) -> Column:
    """Rows kept away from training; a null id is not held out."""
    hashed = F.crc32(F.col(id_column).cast("string").cast("binary"))
    return F.coalesce(hashed % modulus == remainder, F.lit(False))
