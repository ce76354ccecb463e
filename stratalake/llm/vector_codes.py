"""Vectors as short codes: a codebook per part of the vector, trained and applied in whole numbers.

Components become whole numbers, vectors are cut into equal parts, and each part is written as the
number of its nearest codebook entry. The nearest entry is found by equal-average search: entries
are sorted by the sum of their components, the search starts at the part's own sum and goes outward
on both sides. The squared gap of two sums over the number of components is never more than their
squared distance, so the search of a part ends once that bound strictly exceeds the best distance;
entries at the same distance are still met, and the one with the lower number wins.

Training sums parts per entry within each task, then over the tasks; only the entries themselves
come to the driver. All sums are exact, so neither the number of tasks nor a repeated task changes
the result.

Defined results: rows whose vector is null or has null or non-finite components are dropped; all
others are coded, rows of zeros and repeated rows each as often as they come. Shorter vectors are
filled up with zeros to the longest one's length, and all to a multiple of the number of parts; an
empty vector thus is all zeros. Rows with the same id are taken in order of their components, null
ids last. Components beyond +-2^30 over that length are cut to it, so that squared distances fit. With fewer
rows than entries there are as many entries as rows; an empty table gives an empty result. Other
columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from stratalake.llm.common import prepare_workers, written

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
NOWHERE = 1 << 40


def sound(vector: Column) -> Column:
    """Whether all components are there and finite."""
    return F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def whole_vectors(
    vectors: DataFrame, id_column: str, vector_column: str, label_column: str, scale: int = SCALE, parts: int = PARTS
) -> tuple[DataFrame, int]:
    """(id, label, whole: array of long) of the rows that are coded, and the arrays' length."""
    vector = F.col(vector_column).cast(T.ArrayType(T.DoubleType()))
    rows = vectors.select(F.col(id_column).alias("id"), F.col(label_column).alias("label"), vector.alias("v"))
    rows = rows.filter(F.col("v").isNotNull() & sound(F.col("v")))
    longest = rows.agg(F.max(F.size("v"))).first()[0] or 0
    length = max(1, -(-longest // parts)) * parts
    most = (1 << 30) // length
    whole = F.transform("v", lambda x: F.least(F.greatest(F.floor(x * scale), F.lit(-most)), F.lit(most)).cast("long"))
    filled = F.concat(whole, F.array_repeat(F.lit(0).cast("long"), F.lit(length) - F.size("v")))
    return rows.select("id", "label", filled.alias("whole")), length


class Codebooks:
    """Entries of each part, and their order by the sum of their components."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = entries  # parts x entries x components
        sums = entries.sum(axis=2)
        self.order = np.argsort(sums, axis=1, kind="stable")
        self.sums = np.take_along_axis(sums, self.order, axis=1)

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of each part of each row."""
        parts, count, width = self.entries.shape
        cut = rows.reshape(-1, width)
        part = np.tile(np.arange(parts), len(rows))
        total = cut.sum(axis=1)
        up = np.empty(len(cut), np.int64)
        for p in range(parts):
            up[p::parts] = np.searchsorted(self.sums[p], total[p::parts])
        down = up - 1
        best, entry = np.full(len(cut), (1 << 62) // width), np.zeros(len(cut), np.int64)
        left = np.arange(len(cut))
        while len(left):
            p, at_down, at_up = part[left], down[left], up[left]
            gap_down = np.where(at_down >= 0, total[left] - self.sums[p, at_down], NOWHERE)
            gap_up = np.where(at_up < count, self.sums[p, np.minimum(at_up, count - 1)] - total[left], NOWHERE)
            below = gap_down <= gap_up
            gap = np.where(below, gap_down, gap_up)
            on = (gap < NOWHERE) & (np.where(gap < NOWHERE, gap, 0) ** 2 <= best[left] * width)
            left, below, p = left[on], below[on], p[on]
            met = self.order[p, np.where(below, at_down[on], at_up[on])]
            apart = cut[left] - self.entries[p, met]
            distance = (apart * apart).sum(axis=1)
            better = (distance < best[left]) | ((distance == best[left]) & (met < entry[left]))
            best[left[better]], entry[left[better]] = distance[better], met[better]
            down[left[below]] -= 1
            up[left[~below]] += 1
        return entry.reshape(-1, parts), best.reshape(-1, parts)

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.int64).reshape(-1, length)


_SUMS = "part int, entry int, n long, sums array<long>"


def _part_sums(batches: Iterator[pa.RecordBatch], books: Codebooks, length: int) -> Iterator[pa.RecordBatch]:
    """The parts of a task's rows, counted and summed per entry."""
    parts, count, width = books.entries.shape
    n, sums = np.zeros(parts * count, np.int64), np.zeros((parts * count, width), np.int64)
    for batch in batches:
        rows = _matrix(batch.column(0), length)
        entry, _ = books.nearest(rows)
        place = (entry + np.arange(parts) * count).reshape(-1)
        n += np.bincount(place, minlength=len(n))
        np.add.at(sums, place, rows.reshape(-1, width))
    used = np.flatnonzero(n)
    if len(used):
        yield pa.RecordBatch.from_pydict(
            {
                "part": pa.array(used // count, pa.int32()),
                "entry": pa.array(used % count, pa.int32()),
                "n": pa.array(n[used]),
                "sums": pa.array(sums[used].tolist(), pa.list_(pa.int64())),
            }
        )


def train_codebooks(
    rows: DataFrame, length: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> Codebooks | None:
    """Entries start as parts of the rows with the smallest ids, and move to the floor of their
    parts' mean in each round; None without rows."""
    prepare_workers(rows.sparkSession)
    first = rows.orderBy(F.col("id").asc_nulls_last(), "whole").select("whole").limit(entries).collect()
    if not first:
        return None
    start = np.array([r["whole"] for r in first], np.int64).reshape(len(first), parts, length // parts)
    books = Codebooks(np.ascontiguousarray(start.transpose(1, 0, 2)))
    for _ in range(rounds):
        found = rows.select("whole").mapInArrow(lambda b, k=books: _part_sums(b, k, length), _SUMS)
        # One number per entry and component comes back, whatever the number of rows.
        totals = (
            found.select("part", "entry", "n", F.posexplode("sums").alias("place", "value"))
            .groupBy("part", "entry", "place")
            .agg(F.sum("n").alias("n"), F.sum("value").alias("total"))
            .collect()
        )
        moved = books.entries.copy()
        for r in totals:
            moved[r["part"], r["entry"], r["place"]] = r["total"] // r["n"]
        books = Codebooks(moved)
    return books


def with_codes(rows: DataFrame, books: Codebooks, length: int) -> DataFrame:
    """(id, label, code, error): an entry's number per part, and the sum of squared distances."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    digits = max(2, -(-(books.entries.shape[1] - 1).bit_length() // 4))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entry, distance = books.nearest(_matrix(batch.column("whole"), length))
            codes = ["".join([f"{e:0{digits}x}" for e in row]) for row in entry.tolist()]
            made = [pa.array(codes, pa.string()), pa.array(distance.sum(axis=1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), *made], names=["id", "label", "code", "error"]
            )

    return rows.mapInArrow(code, f"id {kinds['id']}, label {kinds['label']}, code string, error long")


def vector_codes(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label"
) -> DataFrame:
    """(id, code, error, label_error, codebooks_sha256) of every row that is coded.

    ``label_error`` is the sum of the errors of all rows with the row's label, nulls together.
    """
    spark = vectors.sparkSession
    whole, length = whole_vectors(vectors, id_column, vector_column, label_column)
    rows = written(whole, "whole-vectors")
    books = train_codebooks(rows, length)
    if books is None:
        coded, digest = rows.select("id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), ""
    else:
        coded, digest = written(with_codes(rows, books, length), "vector-codes"), books.digest()
    # Sums per label are a table of their own, so that Spark knows their size when it joins them.
    sums = coded.groupBy(F.col("label").alias("__label")).agg(F.sum("error").alias("label_error"))
    per_label = spark.createDataFrame([], sums.schema) if books is None else written(sums, "label-errors")
    return coded.join(per_label, F.col("label").eqNullSafe(F.col("__label"))).select(
        F.col("id").alias(id_column), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )
