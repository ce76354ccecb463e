"""Codes against a plain version that compares every part with every entry."""

import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from stratalake.llm import vector_codes as vc

SF_DIR = "/root/testdata/sf0.001"


def plain(rows):
    """(id, code, error, label_error, digest) per row, over Python numbers."""
    good = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    if not good:
        return []
    width = max(1, -(-max(len(v) for _, v, _ in good) // 16))
    whole = [[math.floor(256 * x) for x in v] + [0] * (16 * width - len(v)) for _, v, _ in good]
    cut = [[w[p * width : (p + 1) * width] for p in range(16)] for w in whole]
    order = sorted(range(len(good)), key=lambda k: (good[k][0] is None, good[k][0] or 0, whole[k]))[:64]
    books = [[cut[k][p] for k in order] for p in range(16)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(book))

    for _ in range(2):
        for p in range(16):
            groups = {}
            for row in cut:
                groups.setdefault(nearest(row[p], books[p])[1], []).append(row[p])
            for k, members in groups.items():
                books[p][k] = [sum(c) // len(members) for c in zip(*members)]
    found = [[nearest(row[p], books[p]) for p in range(16)] for row in cut]
    errors = [sum(d for d, _ in f) for f in found]
    labels = {}
    for (_, _, label), e in zip(good, errors):
        labels[label] = labels.get(label, 0) + e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(
        ((i, "".join(f"{k:02x}" for _, k in f), e, labels[label], digest) for (i, _, label), f, e in zip(good, found, errors)),
        key=str,
    )


def coded(df):
    return sorted((tuple(r) for r in vc.vector_codes(df).collect()), key=str)


SCHEMA = "vec_id long, embedding array<double>, label int"


def test_query_equals_plain_version(spark):
    from stratalake.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = QUERIES["op11_vector_codes"](spark, SF_DIR)
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(rows)


def test_nulls_ties_repeats_and_uneven_lengths(spark):
    rng = np.random.default_rng(5)
    rows = [(int(k), rng.integers(-2, 3, 32).astype(float).tolist(), int(k % 3)) for k in range(150)]
    rows += [(k, [0.0] * 32, None) for k in range(5)] + [(3, rows[3][1], 1)] * 4 + [(None, rows[9][1], None)] * 3
    rows += [(500, None, 1), (501, [1.0, None], 1), (502, [float("nan")] * 32, 1), (503, [float("-inf")], 1)]
    rows += [(504, [], 2), (505, [1.5], 2), (-1, rng.normal(size=30).tolist(), 2)]
    assert coded(spark.createDataFrame(rows, SCHEMA).repartition(5)) == plain(rows)


@pytest.mark.parametrize("count", [0, 1, 5, 64])
def test_few_rows(spark, count):
    rows = [(k, [k / 7, -k / 3, 0.1] * 7, k % 2) for k in range(count)]
    assert coded(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_extreme_components_do_not_overflow(spark):
    rows = [(k, [1e300 * (-1) ** k, 1e-300, 3.4e38, -1e18] * 16, 1) for k in range(70)]
    got = coded(spark.createDataFrame(rows, SCHEMA))
    assert len(got) == 70 and all(e >= 0 for _, _, e, _, _ in got)


def test_clashing_columns_and_float_vectors(spark):
    rows = [(k, [k / 3, k / 7], "x", 5, "c") for k in range(70)]
    df = spark.createDataFrame(rows, "vec_id int, embedding array<float>, label string, error int, code string")
    want = plain([(k, [float(np.float32(x)) for x in v], label) for k, v, label, _, _ in rows])
    assert coded(df) == want


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 5), st.integers(1, 9), st.integers(1, 30), st.integers(0, 10**6))
def test_search_finds_the_first_of_the_nearest(width, count, rows, seed):
    rng = np.random.default_rng(seed)
    books = vc.Codebooks(rng.integers(-4, 5, (3, count, width)))
    data = rng.integers(-5, 6, (rows, 3 * width))
    entry, distance = books.nearest(data)
    apart = ((data.reshape(rows, 3, 1, width) - books.entries[None]) ** 2).sum(axis=3)
    assert (entry == apart.argmin(axis=2)).all() and (distance == apart.min(axis=2)).all()


def test_search_leaves_far_entries_out(monkeypatch):
    books = vc.Codebooks(np.arange(64)[None, :, None] * np.full((16, 1, 4), 1000))
    met = []
    order = books.order
    class Counted:
        def __getitem__(self, at):
            met.append(len(at[0]))
            return order[at]
    books.order = Counted()
    books.nearest(np.full((10, 64), 30_100))
    assert sum(met) <= 10 * 16 * 2  # of 64 entries a part meets two
