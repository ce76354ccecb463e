"""Slopes against differences, tables against the network, accuracy on held-out documents."""

import zlib

import numpy as np
import pytest

from stratalake.llm import langid
from stratalake.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


def small():
    rng = np.random.default_rng(0)
    weights = {k: v.astype(float) for k, v in langid._initial(3).items()}
    return weights, rng.integers(0, 256, (5, langid.WINDOW)), rng.integers(0, 3, 5)


def test_slopes_equal_differences():
    weights, rows, labels = small()
    _, slopes = langid.gradients(weights, rows, labels)
    rng = np.random.default_rng(1)
    for name, value in weights.items():
        for _ in range(5):
            at = tuple(rng.integers(0, s) for s in value.shape) if name != "vectors" else (rows[0, 3], 2)
            moved = {k: v.copy() for k, v in weights.items()}
            moved[name][at] += 1e-5
            up = langid.gradients(moved, rows, labels)[0]
            moved[name][at] -= 2e-5
            down = langid.gradients(moved, rows, labels)[0]
            assert np.isclose(slopes[name][at], (up - down) / 2e-5, atol=1e-5)


def test_tables_equal_network():
    weights, rows, labels = small()
    got = langid.Predictor(langid.Network(["a", "b", "c"], weights)).log_probabilities(rows.astype(np.uint8))
    loss, _ = langid.gradients(weights, rows, labels)
    assert np.isclose(-got[np.arange(5), labels].mean(), loss)


def test_chunks_cover_all_bytes():
    texts = ["a" * 64, "", "b" * 65, "é" * 100_000]
    covered = {}
    for rows, owner in langid._chunks(iter(texts)):
        for k in set(owner.tolist()):
            covered[k] = covered.get(k, b"") + rows[owner == k].tobytes()
    assert [covered[k].rstrip(b" ").decode() for k in range(4)] == texts


def test_held_out_accuracy(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    got = QUERIES["op9_language"](spark, SF_DIR).collect()
    assert {r.doc_id for r in got} == set(docs)
    held = [r for r in got if r.held_out]
    assert all((zlib.crc32(str(r.doc_id).encode()) % 4 == 2) == r.held_out for r in got)
    assert all(0 <= r.score <= 1 for r in got)
    right = [r.lang_pred == docs[r.doc_id].lang for r in held if docs[r.doc_id].lang and r.lang_pred != "und"]
    assert sum(right) / len(right) >= 0.95


@pytest.fixture(scope="module")
def network():
    texts = [w * 40 for w in ("the that ", "and of ", "der die ", "und das ")]
    return langid.train(texts, ["en", "en", "de", "de"])


def test_defined_results(spark, network):
    docs = spark.createDataFrame(
        [(1, None, "x"), (2, "", "x"), (3, "12 !? 3", "x"), (4, "the that of and", None), (4, "the that of and", None),
         (None, "der und das " * 20_000, "x"), (6, "𝟘𝟙 漢", "x")],
        "doc_id int, text string, lang_pred string",
    )
    got = [(r.lang_pred, r.lang_score > 0) for r in langid.with_language(docs, network).collect()]
    assert got[:3] == [("und", False)] * 3
    assert got[3:6] == [("en", True), ("en", True), ("de", True)]
    assert got[6][0] in ("en", "de")
    assert langid.with_language(docs.limit(0), network).count() == 0


def test_without_labels_all_is_unknown(spark):
    docs = spark.createDataFrame([(1, "abc", None)], "doc_id int, text string, lang string")
    assert [r.lang_pred for r in langid.with_language(docs, langid.fit_languages(docs)).collect()] == ["und"]


@pytest.fixture
def trained(monkeypatch):
    """What the network would be trained on: (windows, language) of each document."""
    seen = []

    def keep(samples, languages):
        seen.extend(zip(samples, languages))
        return langid.Network(sorted(set(languages)))

    monkeypatch.setattr(langid, "train_windows", keep)
    return seen


def test_every_language_is_learned(spark, trained):
    rows = [(k, f"word{k} of language {k % 230}", f"l{k % 230}") for k in range(5000)] + [(9002, "rare words", "rare")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    wanted = {f"l{k}" for k in range(230)} | {"rare"}
    assert set(langid.fit_languages(docs).languages) == wanted
    trained.clear()
    assert set(langid.fit_languages(docs, sample_documents=460).languages) == wanted
    assert len(trained) <= 460


def test_null_ids_crowd_nothing_out(spark, trained):
    rows = [(None, f"many words {k}", "null") for k in range(4000)] + [(8, f"same id {k}", "same") for k in range(2000)]
    rows += [(k, f"some text {k}", "own") for k in range(100, 400)] + [(None, "a copy", "copies")] * 5000
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    langid.fit_languages(docs, sample_per_language=50)
    counts = {name: sum(language == name for _, language in trained) for name in ("null", "same", "own", "copies")}
    assert counts == {"null": 50, "same": 50, "own": 50, "copies": 1}


def test_only_windows_come_to_the_driver(spark, trained):
    docs = spark.createDataFrame([(1, "long text " * 50_000, "en"), (3, "kurz", "de")], "doc_id long, text string, lang string")
    langid.fit_languages(docs)
    assert sorted(len(w) for w, _ in trained) == [langid.WINDOW, langid.WINDOW * langid.WINDOWS_PER_TEXT]
