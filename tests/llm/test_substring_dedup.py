"""Repeated passages against a plain version that looks up every window as a tuple of words."""

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from stratalake.llm import packing, substring_dedup as sd

SF_DIR = "/root/testdata/sf0.001"


def plain(rows, window):
    """(id, n_words, n_removed, longest, spans, kept) per row, as sorted list."""
    texts = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    last = 1 << 63
    out = []
    lengths = [window]
    while lengths[-1] <= max([len(w) for _, w in texts], default=0):
        lengths.append(lengths[-1] * 2)
    least = {}
    for i, words in texts:
        for n in lengths:
            for k in range(len(words) - n + 1):
                key = tuple(words[k : k + n])
                least[key] = min(least.get(key, last), last if i is None else i)
    for i, words in texts:
        own, longest, gone = last if i is None else i, 0, [False] * len(words)
        for n in lengths:
            for k in range(len(words) - n + 1):
                if least[tuple(words[k : k + n])] < own:
                    longest = max(longest, n)
                    if n == window:
                        gone[k : k + n] = [True] * n
        spans = [tuple(map(int, s)) for s in zip(*packing.run_edges(np.array(gone, bool)))]
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out.append((i, len(words), sum(gone), longest, spans, kept))
    return sorted(out, key=str)


def found(df, window):
    rows = sd.without_repeats(df, window=window).collect()
    return sorted(
        ((r.doc_id, r.n_words, r.n_removed, r.longest_repeat, [tuple(s) for s in r.removed], r.kept_text) for r in rows),
        key=str,
    )


@pytest.mark.parametrize("seed, window", [(0, 1), (1, 3), (2, 13)])
def test_equals_plain_version(spark, seed, window):
    random.seed(seed)
    letters = "ab" if window > 1 else "abcdefghijklmnopqrst"
    shared = [" ".join(random.choice(letters) for _ in range(window * 5)) for _ in range(3)]
    rows = []
    for k in range(40):
        own = " ".join(random.choice("abcdefgh") + str(random.randrange(40)) for _ in range(random.randrange(0, 4 * window)))
        text = random.choice(["", own + " "]) + random.choice([*shared, own, own[: len(own) // 2]]) + random.choice(["", "\n" + own])
        rows.append((random.choice([k, k, 7, None]), text))
    rows += [(None, None), (3, ""), (3, ""), (5, " \t "), (99, rows[0][1]), (99, rows[0][1]), (100, rows[0][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(df, window) == plain(rows, window)


def test_a_passage_of_all_documents_and_large_groups_of_copies(spark):
    passage = " ".join(f"p{k}" for k in range(70))
    rows = [(k, f"start{k} {passage} end{k}") for k in range(300)] + [(k, passage) for k in range(300, 700)]
    got = found(spark.createDataFrame(rows, "doc_id int, text string").repartition(7), 13)
    assert got == plain(rows, 13)
    assert sum(r[2] for r in got) == 299 * 70 + 400 * 70


def test_many_small_buckets(spark, monkeypatch):
    monkeypatch.setattr(sd, "BUCKET_KEYS", 8)
    rows = [(k, " ".join(str((k * 7 + j) % 50) for j in range(40))) for k in range(20)]
    assert found(spark.createDataFrame(rows, "doc_id long, text string"), 13) == plain(rows, 13)


def test_very_long_texts(spark):
    words = [f"w{k * k % 9973}x{k % 31}" for k in range(60_000)]
    rows = [(1, " ".join(words)), (2, " ".join(["other", *words[100:50_000], "end"])), (3, "x" * 300_000)]
    got = {r[0]: r for r in found(spark.createDataFrame(rows, "doc_id long, text string"), 13)}
    assert got[1][2] == 0 and got[2][2] >= 49_900 and got[2][3] == 13 << 11 and got[3][2] == 0
    assert got[2][5] in ("other end", "other", "end", "")


def test_tables_that_are_empty_or_have_clashing_columns(spark):
    schema = "doc_id int, text string, id int, block string, n_words string, kept_text int"
    assert sd.without_repeats(spark.createDataFrame([], schema)).count() == 0
    text = " ".join("abcdefghijklmnop")
    df = spark.createDataFrame([(1, text, 5, "b", "n", 1), (2, text, 6, "b", "n", 2)], schema)
    got = sd.without_repeats(df)
    assert got.schema["doc_id"].dataType.simpleString() == "int"
    assert sorted((r.doc_id, r.n_removed) for r in got.collect()) == [(1, 0), (2, 16)]


def test_query_equals_plain_version(spark):
    from stratalake.llm.queries import QUERIES

    import hashlib

    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op12_substring_dedup"](spark, SF_DIR).collect()
    want = {(i, n, gone, hashlib.sha256(kept.encode()).hexdigest(), most) for i, n, gone, most, _, kept in plain(docs, 13)}
    assert {(r.doc_id, r.n_words, r.n_removed, r.kept_sha256, r.longest_repeat) for r in got} == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=0, max_size=60), st.sampled_from([1, 2, 3, 5, 13]), st.integers(0, 2))
def test_keys_tell_windows_apart(words, window, doublings):
    lanes = np.array([11, 222, 3333, 44444], np.uint64)
    length = window << doublings
    keys = sd.window_keys(lanes[np.array(words, np.int64)], length, 0, window)
    windows = [tuple(words[k : k + length]) for k in range(len(words) - length + 1)]
    assert len(keys) == len(windows)
    assert len(set(zip(keys.tolist(), windows))) == len(set(windows)) == len(set(keys.tolist()))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), max_size=30))
def test_packing_keeps_values(values):
    array = np.array(values, np.uint64)
    assert packing.unpack(packing.pack(array), np.uint64).tolist() == values
    flags = array % np.uint64(2) == 1
    assert packing.unpack_bits(packing.pack_bits(flags), len(flags)).tolist() == flags.tolist()
