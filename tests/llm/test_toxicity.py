"""The chain against sums over all tag sequences, and accuracy on held-out documents."""

import itertools
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from stratalake.llm import toxicity as tox
from stratalake.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


def plain_marginals(odds, moves, start):
    total, toxic = 0.0, np.zeros(len(odds))
    for tags in itertools.product((0, 1), repeat=len(odds)):
        w = start[tags[0]]
        for k, t in enumerate(tags):
            w *= (odds[k] if t else 1.0) * (moves[tags[k - 1], t] if k else 1.0)
        total += w
        toxic += w * np.array(tags)
    return toxic / total


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 7), min_size=1, max_size=12), st.integers(0, 10_000))
def test_marginals_equal_sums_over_all_tags(lengths, seed):
    rng = np.random.default_rng(seed)
    moves, start = rng.uniform(0.1, 3, (2, 2)), rng.uniform(0.1, 3, 2)
    chains = [np.exp(rng.normal(0, 2, n)) for n in lengths]
    first = np.concatenate([np.arange(n) == 0 for n in lengths])
    got = tox.marginals(np.concatenate(chains), first, moves, start)
    want = np.concatenate([plain_marginals(c, moves, start) for c in chains])
    assert np.allclose(got, want)


def test_spans_are_offsets_of_runs():
    scorer = tox.Scorer(tox.Model(constant=0.0))
    p = np.array([0.1, 0.9, 0.8, 0.2, 0.7])
    assert scorer.spans("éa idiot, clown! of moron", p) == [(3, 15), (20, 25)]
    assert scorer.spans("", np.empty(0)) == []


def test_copied_passages_are_no_evidence():
    passage = "alpha beta gamma delta " * 3
    texts = [passage + f"x{k} idiot y{k}" for k in range(20)] + [f"x{k} and y{k}" for k in range(80)]
    docs, names = tox.number_words(texts)
    found = tox.find_evidence(docs, [1] * 20 + [0] * 80, names)
    assert "idiot$" in found and "alpha$" not in found and "gamma$" not in found


def test_near_copies_are_left_out_of_training():
    rng = np.random.default_rng(0)
    base = [f"w{k}" for k in rng.integers(0, 500, 300)]
    copies = []
    for _ in range(50):
        words = list(base)
        for k in rng.integers(0, 300, 15):
            words[k] = f"x{rng.integers(1e6)}"
        copies.append(words)
    others = [[f"w{k}" for k in rng.integers(0, 500, 300)] for _ in range(20)]
    docs, _ = tox.number_words(map(" ".join, copies + others))
    assert tox.without_copies(docs) == [0, *range(50, 70)]
    assert tox.without_copies(tox.number_words(["", "a", "a"])[0]) == [0, 1, 2]


@pytest.fixture(scope="module")
def scored(spark):
    return {r.doc_id: r for r in QUERIES["op5_toxicity"](spark, SF_DIR).collect()}


def test_held_out_accuracy(spark, scored):
    labels = [r for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()]
    held = [r for r in labels if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert all(scored[r.doc_id].held_out for r in held)
    right = sum(scored[r.doc_id].predicted == r.toxic for r in held) / len(held)
    caught = [scored[r.doc_id].predicted for r in held if r.toxic]
    assert right >= 0.95 and sum(caught) / len(caught) >= 0.85


def test_scores_are_bounded_and_whole(spark, scored):
    assert len(scored) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in scored.values())


def test_defined_results(spark):
    docs = spark.createDataFrame(
        [(1, None, "x"), (2, "", "x"), (3, "an idiot", None), (3, "an idiot", None), (None, "a " * 50_000 + "idiot", "x")],
        "doc_id int, text string, toxicity string",
    )
    model = tox.Model({"idiot$": 9.0}, -4.0, np.ones((2, 2)), np.ones(2), (-3.0, 5.0, 0.0, 0.0), None)
    got = tox.with_toxicity(docs, model).collect()
    assert got[0].toxicity == got[1].toxicity < 0.1 and got[0].toxic_spans == []
    assert got[2] == got[3] and [tuple(s) for s in got[2].toxic_spans] == [(3, 8)]
    assert [tuple(s) for s in got[4].toxic_spans] == [(100_000, 100_005)] and got[4].toxicity > 0.8
    assert tox.with_toxicity(docs.limit(0), model).count() == 0


def test_without_labels_the_share_is_the_score(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id int, text string")
    none = spark.createDataFrame([], "doc_id int, toxic int")
    assert tox.fit_toxicity(docs, none).constant == 0.0
    ones = spark.createDataFrame([(1, 1), (2, 1), (None, 1), (7, None)], "doc_id int, toxic int")
    assert tox.fit_toxicity(docs, ones).constant == 1.0
