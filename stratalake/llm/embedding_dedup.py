"""Near-duplicates among embeddings: spherical k-means cells, cosine products within cells.

Equal vectors are one vector with a number of copies. Centres are trained on a bounded sample; each
vector lives in the cell of its nearest centre and visits all cells whose border is near. The border
between two centres is the plane of points equally near to both. Of two vectors on its two sides at
the threshold or closer, one is within half their distance, sqrt((1 - threshold) / 2), of the
plane, so a vector visits each cell whose border with its own is no farther: two vectors that link
always meet, whatever their directions. In a cell residents are compared with residents and visitors
by blocked products in double precision, so the links are those of all pairs.

Residents and visitors of a crowded cell are cut into chunks, and each pair of chunks of residents,
or of residents and visitors, is work of its own. A pair of vectors that meets in both of their cells counts in the one with the smaller number. Blocks return
sums of links per vector and the links that join parts not yet joined, never all pairs.

Defined results: a vector that is null, empty, zero, or has null or non-finite components links
with nothing and is kept; vectors of different lengths don't link; a row whose id is the smallest
of its component is kept, so rows that share that id are all kept; null ids count as links but
never name a component that has another id; an empty table gives an empty result. Vectors are told
apart by a 64-bit hash of their components. Other columns are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from stratalake.llm.common import prepare_workers, written
from stratalake.llm.components import connected_components

THRESHOLD = 0.95
# What rounding may take from a vector's distance to a border.
SLACK = 1e-7
# Vectors (and bytes of them) that train the centres, and the most centres there are.
SAMPLE = 20_000
SAMPLE_BYTES = 64 << 20
MOST_CENTRES = 4096
VECTORS_PER_CENTRE = 8
# Centres for each root of the number of vectors: more centres make cells that few visit.
CENTRES_PER_ROOT = 4
ROUNDS = 10
# Vectors of a chunk of a crowded cell.
CHUNK = 2048
# Vectors whose products with the centres are held at once.
ROWS_AT_ONCE = 512
# Rows of the sample that move between cells at once.
MOVED_AT_ONCE = 64


def unit_rows(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, without overflow on the way."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def train_centres(sample: np.ndarray, count: int) -> np.ndarray:
    """Spherical k-means on unit rows; centres that lose all rows are left out.

    A row moves if that makes the sums of both cells longer together. Its own part in its cell's
    sum, which holds it there in small cells, is thus left out. Few rows move at a time, as cells
    that lose many rows at once would die out.
    """
    centres = sample[np.linspace(0, len(sample) - 1, count).astype(int)]
    home = np.concatenate([(part @ centres.T).argmax(axis=1) for _, part in _row_blocks(sample)])
    sums = np.zeros_like(centres)
    np.add.at(sums, home, sample)
    length = np.sqrt((sums * sums).sum(axis=1))
    for _ in range(ROUNDS):
        for at, part in _row_blocks(sample, MOVED_AT_ONCE):
            each, own = np.arange(len(part)), home[at : at + len(part)]
            products = part @ sums.T
            stay = length[own] - np.sqrt(np.maximum(0, length[own] ** 2 - 2 * products[each, own] + 1))
            gain = np.sqrt(np.maximum(0, length**2 + 2 * products + 1)) - length
            gain[each, own] = stay
            new = gain.argmax(axis=1)
            moved = new != own
            np.subtract.at(sums, own[moved], part[moved])
            np.add.at(sums, new[moved], part[moved])
            home[at : at + len(part)] = new
            touched = np.unique([own[moved], new[moved]])
            length[touched] = np.sqrt((sums[touched] ** 2).sum(axis=1))
    held = np.unique(home)
    sums = np.zeros_like(centres)
    np.add.at(sums, home, sample)
    length = np.sqrt((sums[held] ** 2).sum(axis=1))
    return sums[held][length > 0] / length[length > 0, None]


def _row_blocks(rows: np.ndarray, most: int = 0) -> Iterator[tuple[int, np.ndarray]]:
    """Blocks of rows, whose products with all centres fit in memory, and where they start."""
    most = most or ROWS_AT_ONCE
    for at in range(0, len(rows), most):
        yield at, rows[at : at + most]


def reach(threshold: float, dimension: int) -> float:
    """How far from a border one of two vectors that link over it is at most, in any dimension."""
    return math.sqrt(max(0.0, 1 - threshold) / 2)


Cells = dict[int, tuple[np.ndarray, int, float]]  # by dimension: centres, first number, reach


def assign(rows: np.ndarray, cells: Cells) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(home of each row, row of each visit, cell of each visit); the home is a visit as well."""
    dimension = rows.shape[1]
    if dimension not in cells:  # a length that the sample does not have is one cell
        own = np.full(len(rows), -dimension)
        return own, np.arange(len(rows)), own
    centres, first, far = cells[dimension]
    homes, visitors, visited = [], [], []
    for at, part in _row_blocks(rows):
        near = part @ centres.T
        home = near.argmax(axis=1)
        some, place = np.unique(home, return_inverse=True)
        apart = np.sqrt(np.maximum(0, 2 - 2 * (centres[some] @ centres.T)))
        row, cell = np.nonzero(near[np.arange(len(part)), home][:, None] - near <= far * apart[place] + SLACK)
        homes.append(home)
        visitors.append(row + at)
        visited.append(cell)
    return np.concatenate(homes) + first, np.concatenate(visitors), np.concatenate(visited) + first


def _by_dimension(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, unit rows) of the vectors of each length."""
    ends = np.asarray(column.offsets)
    values = np.asarray(column.values, dtype=np.float64)
    lengths = np.diff(ends)
    for d in np.unique(lengths).tolist():
        places = np.flatnonzero(lengths == d)
        yield places, unit_rows(values[ends[places][:, None] + np.arange(d)])


# --- blocks ------------------------------------------------------------------------------------


def link_block(
    rows: np.ndarray,
    nodes: np.ndarray,
    copies: np.ndarray,
    homes: np.ndarray,
    visits: list[list[int]],
    cell: int,
    threshold: float,
    side: np.ndarray | None = None,
) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Links of one unit of work: their sums per row, and links that join what is connected.

    ``side`` tells the two chunks of a unit apart, whose rows meet across only.
    """
    resident = np.flatnonzero(homes == cell)
    linked = rows[resident] @ rows.T >= threshold
    linked[np.arange(len(resident)), resident] = False
    if side is not None:
        linked &= side[resident][:, None] != side[None, :]
    sums = np.zeros(len(rows), np.int64)
    if not linked.any():
        return sums, []
    # A resident that also visits a visitor's home meets it there: the smaller cell counts.
    others, place = np.unique(homes, return_inverse=True)
    visited = np.zeros((len(resident), len(others)), bool)
    for k in np.flatnonzero(linked.any(axis=1)).tolist():
        visited[k] = np.isin(others, visits[resident[k]])
    counted = linked & ~(visited[:, place] & (homes < cell)[None, :])
    sums[resident] += counted @ copies
    visitor = homes != cell
    sums[visitor] += counted[:, visitor].T @ copies[resident]
    both_ways = np.zeros((len(rows), len(rows)), bool)
    both_ways[resident] = linked
    both_ways |= both_ways.T
    return sums, _spanning(both_ways, nodes.tolist())


def _spanning(linked: np.ndarray, names: list[int]) -> list[tuple[int, int]]:
    """Links that join all rows reachable from each other."""
    left, out = linked.any(axis=1), []
    for seed in np.flatnonzero(left).tolist():
        queue = [seed] if left[seed] else []
        left[seed] = False
        while queue:
            k = queue.pop()
            new = np.flatnonzero(linked[k] & left)
            left[new] = False
            out += [(names[k], names[o]) for o in new.tolist()]
            queue += new.tolist()
    return out


_UNIT = "cell int, i int, j int, node long, copies long, home int, visits array<int>, vector binary"
_UNIT_TYPES = [*[pa.int32()] * 3, *[pa.int64()] * 2, pa.int32(), pa.list_(pa.int32()), pa.binary()]
_LINKS = "a long, b long, links long"


def _batch(rows: list[tuple], types: list, fields: str) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in types]
    names = [f.split()[0] for f in fields.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


_COUNTS = "cell int, n long, residents long"
Chunks = dict[int, tuple[int, int]]  # by crowded cell: chunks of residents and of visitors


def _visit_counts(batches: Iterator[pa.RecordBatch], cells: Cells) -> Iterator[pa.RecordBatch]:
    """(cell, n, residents) of the visits of each batch."""
    for batch in batches:
        for _, rows in _by_dimension(batch.column(2)):
            homes, _, cell = assign(rows, cells)
            found, n = np.unique(cell, return_counts=True)
            own = np.bincount(np.searchsorted(found, homes), minlength=len(found))
            counts = list(zip(found.tolist(), n.tolist(), own.tolist()))
            yield _batch(counts, [pa.int32(), pa.int64(), pa.int64()], _COUNTS)


def _units_of(node: int, resident: bool, chunks: tuple[int, int] | None) -> list[tuple[int, int]]:
    """The units (i, j) of a cell that a vector takes part in; chunks of visitors come last."""
    if chunks is None:
        return [(0, 0)]
    residents, visitors = chunks
    if not resident:
        return [(i, residents + node % visitors) for i in range(residents)]
    mine = node % residents
    return [(min(mine, o), max(mine, o)) for o in range(residents)] + [(mine, residents + k) for k in range(visitors)]


def _units(batches: Iterator[pa.RecordBatch], cells: Cells, chunks: Chunks) -> Iterator[pa.RecordBatch]:
    """A row for each unit that a vector takes part in."""
    for batch in batches:
        node, copies = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        out: list[tuple] = []
        for places, rows in _by_dimension(batch.column(2)):
            homes, row, cell = assign(rows, cells)
            starts = np.searchsorted(row, np.arange(len(rows) + 1)).tolist()
            for k, place in enumerate(places.tolist()):
                visits = cell[starts[k] : starts[k + 1]].tolist()
                vector = rows[k].tobytes()
                for c in visits:
                    resident = c == homes[k]
                    # Only residents are asked where else they are.
                    known = visits if resident else []
                    for unit in _units_of(node[place], resident, chunks.get(c)):
                        out.append((c, *unit, node[place], copies[place], int(homes[k]), known, vector))
                if len(out) >= 4096:
                    yield _batch(out, _UNIT_TYPES, _UNIT)
                    out = []
        if out:
            yield _batch(out, _UNIT_TYPES, _UNIT)


def _links(batches: Iterator[pa.RecordBatch], chunks: Chunks, threshold: float) -> Iterator[pa.RecordBatch]:
    """Links of the units in a sorted stream; a unit may go over several batches."""

    def finish(unit: tuple, held: list) -> pa.RecordBatch:
        cell, i, j = unit
        sums, links = [], []
        lengths = np.array([len(row[4]) for row in held])
        for d in np.unique(lengths).tolist():
            node, copies, home, visits, raw = zip(*(held[k] for k in np.flatnonzero(lengths == d)))
            nodes = np.array(node, np.int64)
            rows = np.frombuffer(b"".join(raw), np.float64).reshape(len(node), -1)
            homes = np.array(home)
            side = None
            if i != j:
                side = nodes % chunks[cell][0] == j if j < chunks[cell][0] else homes == cell
            found, joined = link_block(
                rows, nodes, np.array(copies, np.int64), homes, list(visits), cell, threshold, side
            )
            sums += [(nodes[k], None, found[k]) for k in np.flatnonzero(found)]
            links += [(a, b, None) for a, b in joined]
        return _batch(sums + links, [pa.int64()] * 3, _LINKS)

    unit, held = None, []
    for batch in batches:
        for c, i, j, *row in zip(*(x.to_pylist() for x in batch.columns)):
            if (c, i, j) != unit:
                if len(held) > 1:
                    yield finish(unit, held)
                unit, held = (c, i, j), []
            held.append(row)
    if len(held) > 1:
        yield finish(unit, held)


# --- on Spark ----------------------------------------------------------------------------------


def usable(vector: Column) -> Column:
    """Whether a vector has a direction: finite components, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def train_cells(distinct: DataFrame, threshold: float, most_centres: int = MOST_CENTRES) -> Cells:
    """Centres for each length of vectors in a sample: the vectors with the smallest hashes."""
    n = distinct.count()
    widest = distinct.agg(F.max(F.size("vector"))).first()[0] or 1
    rows = max(1, min(SAMPLE, SAMPLE_BYTES // (8 * widest)))
    sample = distinct.orderBy("node").limit(rows).select("vector").toArrow().column(0).combine_chunks()
    cells, first = {}, 0
    for places, unit in _by_dimension(sample) if len(sample) else ():
        share = n * len(places) / len(sample)
        count = max(1, min(round(CENTRES_PER_ROOT * math.sqrt(share)), len(places) // VECTORS_PER_CENTRE, most_centres))
        centres = train_centres(unit, count)
        cells[unit.shape[1]] = (centres, first, reach(threshold, unit.shape[1]))
        first += len(centres)
    return cells


def vector_links(distinct: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Over distinct vectors (node, copies, vector): rows (a, null, links) are sums of links of a,
    rows (a, b, null) are links that join what is connected."""
    spark = distinct.sparkSession
    prepare_workers(spark)
    cells = train_cells(distinct, threshold)
    rows = distinct.select("node", "copies", "vector")
    # One row per crowded cell comes to the driver, so no more than there are centres.
    crowded = (
        rows.mapInArrow(lambda b: _visit_counts(b, cells), _COUNTS)
        .groupBy("cell")
        .agg(F.sum("n").alias("n"), F.sum("residents").alias("residents"))
        .filter(F.col("n") > CHUNK)
        .collect()
    )
    chunks = {r["cell"]: (-(-r["residents"] // CHUNK), -(-(r["n"] - r["residents"]) // CHUNK)) for r in crowded}
    units = rows.mapInArrow(lambda b: _units(b, cells, chunks), _UNIT)
    order = ["cell", "i", "j"]
    sorted_units = units.repartition(*order).sortWithinPartitions(*order)
    return sorted_units.mapInArrow(lambda b: _links(b, chunks, threshold), _LINKS)


def embedding_groups(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(id, n_links, component_id, kept) per row."""
    vector = F.col(vector_column).cast(T.ArrayType(T.DoubleType()))
    rows = vectors.select(
        F.col(id_column), F.when(usable(vector), vector).alias("vector")
    ).withColumn("node", F.when(F.col("vector").isNotNull(), F.xxhash64("vector")))
    distinct = written(
        rows.filter("node IS NOT NULL")
        .groupBy("node")
        .agg(F.count(F.lit(1)).alias("copies"), F.min(id_column).alias("first"), F.first("vector").alias("vector")),
        "distinct-vectors",
    )
    links = written(vector_links(distinct, threshold), "vector-links")
    sums = links.filter("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    parts = connected_components(links.filter("b IS NOT NULL").select("a", "b"))
    named = written(
        distinct.select("node", "copies", "first")
        .join(parts, "node", "left")
        .join(sums, "node", "left")
        .select(
            "node",
            F.coalesce("component", "node").alias("component"),
            "first",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        ),
        "vector-parts",
    )
    smallest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    results = named.join(smallest, "component").select("node", "n_links", "component_id")
    return (
        rows.select(id_column, "node")
        .join(results, "node", "left")
        .select(
            id_column,
            F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
            F.when(F.col("node").isNull(), F.col(id_column)).otherwise(F.col("component_id")).alias("component_id"),
        )
        .withColumn("kept", F.col(id_column).eqNullSafe(F.col("component_id")))
    )
