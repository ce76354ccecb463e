"""Links and components of embeddings against all pairs."""

import numpy as np
import pytest

from stratalake.llm import embedding_dedup as dedup
from stratalake.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


def plain(rows, threshold=0.95):
    """(id, n_links, component_id, kept) per row, comparing all pairs."""
    good = [v is not None and len(v) and None not in v and np.isfinite(v).all() and any(v) for _, v in rows]
    links = [set() for _ in rows]
    for d in {len(v) for (_, v), g in zip(rows, good) if g}:
        at = [k for k, (_, v) in enumerate(rows) if good[k] and len(v) == d]
        unit = dedup.unit_rows(np.array([rows[k][1] for k in at], float))
        for a, b in np.argwhere(unit @ unit.T >= threshold - 1e-12).tolist():
            if a != b:
                links[at[a]].add(at[b])
    out, done = [None] * len(rows), set()
    for k in range(len(rows)):
        if k in done:
            continue
        group, queue = {k}, [k]
        while queue:
            new = links[queue.pop()] - group
            group |= new
            queue += new
        done |= group
        first = min((rows[g][0] for g in group if rows[g][0] is not None), default=None)
        for g in group:
            out[g] = (rows[g][0], len(links[g]), first, rows[g][0] == first)
    return sorted(map(repr, out))


def noisy(rng, centre, cosine):
    other = rng.normal(size=len(centre))
    other -= other @ centre * centre
    return cosine * centre + np.sqrt(1 - cosine**2) * other / np.linalg.norm(other)


def mixture(rng, groups=60, d=48):
    rows = []
    for _ in range(groups):
        centre = rng.normal(size=d)
        centre /= np.linalg.norm(centre)
        rows += [(noisy(rng, centre, rng.choice([0.951, 0.96, 0.98, 0.999, 0.93])) * rng.uniform(0.1, 9)).tolist() for _ in range(rng.integers(1, 9))]
    big = rng.normal(size=d)
    big /= np.linalg.norm(big)
    rows += [noisy(rng, big, 0.99).tolist() for _ in range(150)] + [rows[0]] * 20
    rows += [rng.normal(size=d).tolist() for _ in range(200)]
    return [(k, v) for k, v in enumerate(rows)]


@pytest.mark.parametrize("chunk", [2048, 37])
def test_groups_equal_all_pairs(spark, monkeypatch, chunk):
    monkeypatch.setattr(dedup, "CHUNK", chunk)
    rng = np.random.default_rng(chunk)
    rows = mixture(rng)
    odd = [
        None, [], [0.0] * 48, [float("nan")] + [1.0] * 47, [None] + [1.0] * 47, [float("inf")] + [1.0] * 47,
        [1.0, 2.0], [2.0, 4.0], [1e300] * 48, [1e-300] * 48, [1.0] * 48,
    ]
    rows += [(10_000 + k, v) for k, v in enumerate(odd)] + [(5, rows[5][1]), (None, rows[0][1]), (None, None)]
    table = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, node string")
    got = dedup.embedding_groups(table).collect()
    assert sorted(repr(tuple(r)) for r in got) == plain(rows)


def test_query_recall(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    got = {r.vec_id: tuple(r) for r in QUERIES["op4_embedding_groups"](spark, SF_DIR).collect()}
    want = plain(rows)
    assert sorted(map(repr, got.values())) == want


def test_borders_are_reached():
    """Pairs at the threshold, over random directions, share a cell in nearly all cases."""
    rng = np.random.default_rng(1)
    base = dedup.unit_rows(rng.normal(size=(4000, 64)))
    pairs = np.array([noisy(rng, b, 0.9501) for b in base])
    cells = {64: (dedup.train_centres(base, 250), 0, dedup.reach(0.95, 64))}
    homes, row, cell = dedup.assign(base, cells)
    homes2, row2, cell2 = dedup.assign(pairs, cells)
    seen, seen2 = set(zip(row.tolist(), cell.tolist())), set(zip(row2.tolist(), cell2.tolist()))
    met = [(k, homes2[k]) in seen or (k, homes[k]) in seen2 for k in range(4000)]
    assert np.mean(met) >= 0.999
    assert len(row) < 4000 * 250 * 0.04


@pytest.mark.parametrize("rank, d", [(8, 64), (8, 384), (16, 384), (384, 384)])
def test_all_pairs_meet_at_any_rank(rank, d):
    """Pairs at the threshold meet, also if the vectors fill few of their dimensions."""
    rng = np.random.default_rng(rank + d)
    basis = np.linalg.qr(rng.normal(size=(d, rank)))[0].T
    base = dedup.unit_rows(rng.normal(size=(3000, rank)))
    pairs = np.array([noisy(rng, b, 0.9505) for b in base]) @ basis
    base = base @ basis
    cells = {d: (dedup.train_centres(base, 200), 0, dedup.reach(0.95, d))}
    homes, row, cell = dedup.assign(base, cells)
    homes2, row2, cell2 = dedup.assign(pairs, cells)
    seen, seen2 = set(zip(row.tolist(), cell.tolist())), set(zip(row2.tolist(), cell2.tolist()))
    assert all((k, homes2[k]) in seen or (k, homes[k]) in seen2 for k in range(3000))


def test_empty_table(spark):
    assert dedup.embedding_groups(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
